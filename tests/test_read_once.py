"""Queries that read resolved or unified rows once deal only what they use."""

from __future__ import annotations

from test_one_deal import COLUMNS, records
from test_scale import physical, plain_plans  # noqa: F401

from rollbook.harness import views as V
from rollbook.operators import double_booking as DB
from rollbook.operators import meetings as M
from rollbook.plans import schedule as S


def weighed(spark, seed=6, n=120):
    return S.weigh(spark.createDataFrame(records(seed, n), COLUMNS), V.PR).localCheckpoint()


def same(a, b, cols):
    return sorted(map(repr, a.select(cols).collect())) == sorted(map(repr, b.select(cols).collect()))


def test_unified_once_has_the_same_rows(spark):
    w = weighed(spark)
    whole = S.resolve(w, V.PR)["unified"]
    once, unmarked = S.unified_once(w, V.PR), S.unified_once(w, V.PR, load_off=False)
    cols = sorted(once.columns)
    assert set(cols) <= set(whole.columns) and {"C_class_id", "M_class_weight", "M_student_count_adjusted", "C_teacher_load_exclude", M.ROW_ID} <= set(cols)
    assert same(whole, once, cols) and same(whole, unmarked, [c for c in cols if c != "C_teacher_load_exclude"])


def test_no_whole_record_is_dealt_by_teacher(spark, plain_plans):  # noqa: F811
    w = weighed(spark)
    off = spark.createDataFrame([(7, True), (8, False)], "D_employee_id int, load_off boolean")
    made = S.resolve(w, V.PR)["resolved"].select(M.ROW_ID, "C_class_id_post_teachers", M.TERM, M.PERIOD, M.ROTATION, "M_class_weight_post_student").localCheckpoint()
    u = DB.unify(made, w, off)
    plan = u._jdf.queryExecution().optimizedPlan().toString()
    by_teacher = plan[plan.index("__lks"):]
    assert "D_note" in plan and "D_note" not in by_teacher.split("LogicalRDD")[0]
    assert {r.D_employee_id for r in u.filter("C_teacher_load_exclude = 'Exclude' and C_class_size_exclude = 'Include'").collect()} == {7}


def test_class_ids_are_not_dealt(spark, plain_plans):  # noqa: F811
    flagged = S.resolve(weighed(spark), V.PR)["flagged"].localCheckpoint()
    plain, short = DB.resolve_double_bookings(flagged)[0], DB.resolve_double_bookings(flagged, V.PR.recipe)[0]
    assert same(plain, short, sorted(plain.columns)) and sorted(plain.columns) == sorted(short.columns)
    text = physical(short)
    above = text[:text.index("REPARTITION_BY_NUM")]
    assert "C_class_id_original" in above and "AS C_class_id" in above
