"""Slots that the same terms fill are worked on once, and few columns of the unified rows come without their records."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from test_one_deal import COLUMNS, exploded, records

from rollbook.harness import views as V
from rollbook.operators import double_booking as DB
from rollbook.operators import meetings as M
from rollbook.operators import rollups as R
from rollbook.plans import schedule as S
from rollbook.sources.tables import cut_lineage

FLAGS = ("H_db_student_row", "H_db_teacher_row", "H_class_with_db", "H_db_100p_class")


def text(d, *cols):
    return sorted(map(repr, d.select(*cols).collect()))


@pytest.fixture(scope="module")
def whole(spark):
    rows = [*records(5, 200), (1, 7, 1, "NATION_1", "x", None, "A", "1996S1", "Core", "Include", "Exclude", "null"), (4, 9, 1, "NATION_1", "q", "1", "A", "1996S2", "Core", "Include", "Exclude", "off")]
    w = S.weigh(spark.createDataFrame(rows, COLUMNS), V.PR).localCheckpoint()
    return w, {k: v.localCheckpoint() for k, v in S.resolve(w, V.PR).items()}


def test_slots_filled_alike(spark):
    p = M.ScheduleParams(term_weights={"S1": 0.5, "S2": 0.5, "FY": 1.0}, term_expands={"S1": ["Q1", "Q2"], "S2": ["Q3", "NA"], "FY": ["Q1", "Q2", "Q3", "NA"]})
    assert M.slot_groups(p) == {"Q1": ["Q1", "Q2"], "Q3": ["Q3"], "NA": ["NA"]}
    d = spark.createDataFrame([("Q1",), ("Q3",), (None,)], f"{M.TERM} string")
    assert sorted(str(r[0]) for r in M.unfold(d, p).collect()) == ["None", "Q1", "Q2", "Q3"]
    assert [r[0] for r in d.select(M.slots_of(p)).collect()] == [2, 1, 1]


def test_folded_flags_unfold_to_those_of_exploded_rows(spark):
    rows = records(9)
    w = S.weigh(spark.createDataFrame(rows, COLUMNS), V.PR)
    plain = DB.flag_double_bookings(exploded(spark, rows), V.PR).localCheckpoint()
    folded = DB.flag_records(M.engine_columns(w, V.PR).drop("C_class_id"), V.PR, folded=True).localCheckpoint()
    cols = (M.ROW_ID, *DB.SLOT, "C_class_id", DB.ADJ, *FLAGS)
    assert folded.count() < 0.7 * plain.count()
    assert text(M.unfold(folded, V.PR, class_ids=True), *cols) == text(plain, *cols)
    assert folded.agg(F.sum(M.slots_of(V.PR))).first()[0] == plain.count()


def test_final_columns_of_unified_rows(whole):
    w, made = whole
    final = ("D_term", "D_period", "D_rotation", M.PERIOD, "M_student_count_adjusted", "C_class_size_exclude", "C_teacher_load_exclude")
    stored = []
    got = S.unified_fields(w, V.PR, ("D_stu_id", "M_cls_class_weight"), stage=lambda d: stored.append(d.columns) or cut_lineage(d), final=final)
    assert not any(M.ROW_ID in c or "C_class_id" in c for c in stored[:2])
    cols = ("C_class_id", F.bround("M_class_weight", 9), "D_stu_id", "M_cls_class_weight", *final)
    assert text(got, *cols) == text(made["unified"], *cols)
    assert got.filter("C_class_size_exclude = 'Exclude'").count() >= 2


def test_accounts_without_ids(whole):
    w, made = whole
    got, want = S.unified_accounts(w, V.PR), DB.unify_accounts(made["unified"], made["resolved"], w)
    assert got.select(*want.columns).first() == want.first() and got.first()["records_untouched"] > 0


def test_teachers_taken_off_before_the_student_stage(whole):
    w, made = whole
    p = M.ScheduleParams(**{**V.PR.__dict__, "consolidate_max_size": 1})
    ids = lambda d: sorted(str(r[0]) for r in d.select("D_employee_id").distinct().collect())
    assert ids(DB.teachers_off(made["flagged"], made["mapping"], p)) == ids(DB.teacher_loadoff(made["resolved"], p).filter("load_off")) != []


def test_before_and_after_of_folded_rows(whole):
    w, made = whole
    flagged = DB.flag_records(M.engine_columns(w, V.PR).drop("C_class_id"), V.PR, only_flagged=True, folded=True).localCheckpoint()
    folded = DB.resolve_double_bookings(flagged, V.PR.recipe)[0].select(*DB.BEFORE_AFTER).localCheckpoint()
    assert text(DB.before_after(folded, V.PR), "metric", "before", "after") == text(DB.before_after(made["resolved"].select(*DB.BEFORE_AFTER)), "metric", "before", "after")


def test_rollups_store_no_whole_rows(whole):
    w, made = whole
    u = made["unified"].withColumns({c: F.lit("x") for c in ("C_course_subject", "C_course_name", "C_course_credit_type", "C_course_rigor")}).withColumn("D_stu_grade", F.lit(9)).localCheckpoint()
    stored = []
    r = S.roll_up(u, V.PR, stage=lambda d: stored.append(d.columns) or cut_lineage(d))
    assert not any("D_stu_id" in c for c in stored)
    slots = u.filter("C_class_size_exclude = 'Include'").select(*R.CLASS_SLOT, "D_employee_id", "C_teacher_load_exclude").distinct()
    assert r["class"].count() == slots.count()
    seats = R.class_sizes(u, V.PR)
    assert seats.count() == u.select(*R.CLASS_SLOT).distinct().count()
    cols = (*R.CLASS_SLOT, "M_cls_num_stu", "M_cls_class_size")
    assert set(text(r["class"], *cols)) <= set(text(seats, *cols)) and set(text(r["unified"], *cols)) == set(text(seats, *cols))
    assert r["student"].select("D_stu_id", *R.CLASS_SLOT).distinct().count() == u.select("D_stu_id", *R.CLASS_SLOT).distinct().count()
