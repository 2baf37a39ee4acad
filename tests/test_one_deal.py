"""Double-booking rows are dealt once: the plan, what travels, and the flags against a plain count."""

from __future__ import annotations

import itertools
import random
from dataclasses import replace

import pytest
from pyspark.sql import functions as F
from test_scale import physical, plain_plans  # noqa: F401

from rollbook.harness import views as V
from rollbook.operators import double_booking as DB
from rollbook.operators import meetings as M
from rollbook.plans import schedule as S

COLUMNS = ("D_stu_id int, D_employee_id int, D_location_id int, D_location_name string, D_course_section_id string, D_period string, D_rotation string, D_term string, "
           "C_course_subject_area string, C_course_time_exclude string, C_class_size_and_teacher_load_exclude string, D_note string")
SMOKE = "/root/testdata/sf0.001"


def records(seed=1, n=400):
    r = random.Random(seed)
    rows = [(r.choice([1, 2, 3, 4, None]), r.choice([7, 8, None]), r.choice([1, 2]), "NATION_1", r.choice("xyz"), r.choice(["1", "2", "NA", "MISC", None]), r.choice(["A", "A-B", "B", None]),
             r.choice(["1996S1", "1996FY", "odd"]), "Core", r.choice(["Include"] * 9 + ["Exclude"]), "Include", None) for _ in range(n)]
    return [(*x[:-1], f"n{i}") for i, x in enumerate(rows)]


def exploded(spark, rows):
    return M.explode_records(S.weigh(spark.createDataFrame(rows, COLUMNS), V.PR), V.PR, new_id=False)


def test_flags_take_one_exchange(spark, plain_plans):  # noqa: F811
    flagged = DB.flag_double_bookings(exploded(spark, records()).localCheckpoint(), V.PR)
    plan = physical(flagged)
    assert plan.count("Exchange") == 1 and "Join" not in plan and "FileScan" not in plan
    narrow = physical(flagged.select("D_stu_id", "H_db_student_row"))
    dealt = narrow[narrow.index("Exchange"):]
    assert "Filter" in dealt and not any(c in dealt.split("Filter")[0] for c in ("D_note", M.ROW_ID, "D_employee_id"))


@pytest.mark.parametrize("by_weight, skip", [(True, False), (False, True)])
def test_flags_match_a_plain_count(spark, by_weight, skip):
    rows = [x.asDict() for x in exploded(spark, records(3)).filter("C_course_time_exclude = 'Include'").collect()]
    text = lambda v: "NA" if v is None else str(v)
    slot = lambda x: tuple(x[c] for c in DB.SLOT)
    for x in rows:
        x["cid"] = "_".join(map(text, (x["D_location_id"], x["D_course_section_id"], *slot(x))))
    group = lambda key, src=rows: {k: list(g) for k, g in itertools.groupby(sorted(src, key=lambda x: repr(key(x))), key=lambda x: repr(key(x)))}
    for g in group(lambda x: (x["cid"], x["D_stu_id"])).values():
        for x in g:
            x["adj"] = None if x[DB.WEIGHT] is None else x[DB.WEIGHT] / len(g)
    known = lambda v: sum(z for z in v if z is not None)
    top = lambda v: max((z for z in v if z is not None), default=0.0)

    def over(g, total):
        if by_weight:
            return any(w is not None and total(s) > w + 1e-9 for w in {x[DB.WEIGHT] for x in g} for s in [[x for x in g if x[DB.WEIGHT] == w]])
        return total(g) > top(x[DB.WEIGHT] for x in g) + 1e-9

    # classes count once for each weight they have
    classes = lambda g: known(top(y["adj"] for y in c) for c in group(lambda x: (x["cid"], x[DB.WEIGHT]), g).values())
    for who, total, out in (("D_stu_id", lambda g: known(x["adj"] for x in g), "s"), ("D_employee_id", classes, "t")):
        for g in group(lambda x: (x["D_location_id"], x[who], slot(x))).values():
            for x in g:
                x[out] = int(over(g, total) and not (skip and out == "t" and x[who] is None))
    want = sorted(repr((x[M.ROW_ID], *slot(x), x["cid"], x["s"], x["t"])) for x in rows)
    for g in group(lambda x: x["cid"]).values():
        for x in g:
            x["c"] = (max(y["t"] for y in g), max(y["s"] for y in g), min(y["s"] for y in g))
    got = DB.flag_double_bookings(exploded(spark, records(3)), V.PR, by_weight=by_weight, skip_missing_teacher=skip).collect()
    assert sorted(repr((x[M.ROW_ID], *(x[c] for c in DB.SLOT), x.C_class_id, x.H_db_student_row, x.H_db_teacher_row)) for x in got) == want
    classes_of = {x["cid"]: x["c"] for x in rows}
    assert {x.C_class_id: (x.H_class_with_teacher_db, x.H_class_with_student_db, x.H_db_100p_class) for x in got} == classes_of
    assert {0, 1} == {x["s"] for x in rows} == {x["t"] for x in rows}


def test_a_class_id_without_the_school_spans_schools(spark):
    p = replace(V.PR, recipe=("D_course_section_id",))
    rows = [(1, 7, 1, "NATION_1", "x", "1", "A", "1996S1", "Core", "Include", "Include", "a"), (1, 7, 1, "NATION_1", "y", "1", "A", "1996S1", "Core", "Include", "Include", "b"),
            (2, 8, 2, "NATION_1", "x", "1", "A", "1996S1", "Core", "Include", "Include", "c")]
    d = M.explode_records(S.weigh(spark.createDataFrame(rows, COLUMNS), p), p, new_id=False)
    got = {(x.D_stu_id, x.D_course_section_id): (x.H_db_student_row, x.H_class_with_db, x.H_db_100p_class) for x in DB.flag_double_bookings(d, p).collect()}
    assert got == {(1, "x"): (1, 1, 0), (1, "y"): (1, 1, 1), (2, "x"): (0, 1, 0)}


def test_wide_schedule_rows_are_not_shuffled(spark, plain_plans):  # noqa: F811
    t = V.Tables(spark, SMOKE)
    plan = V.cs(t)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") and not any("D_expression" in line or "D_course_name" in line for line in plan.splitlines() if "Exchange" in line)
    before = len(V.Tables._kept)
    V.csx(t).count()
    assert len(V.Tables._kept) == before


def test_unified_rows_keep_text_ids(spark):
    w = S.weigh(spark.createDataFrame(records(5, 120), COLUMNS), V.PR)
    out = S.resolve(w, V.PR)
    ids = {x[0] for x in w.select(M.ROW_ID).collect()}
    for name in ("flagged", "resolved", "unified"):
        assert {x[0] for x in out[name].select(M.ROW_ID).collect()} <= ids
    assert {x[0] for x in out["unified"].select(M.ROW_ID).collect()} == ids
    note = dict(w.select(M.ROW_ID, "D_note").collect())
    assert all(note[a] == b for a, b in out["unified"].select(M.ROW_ID, "D_note").collect())


def test_records_are_dealt_as_meetings(spark, plain_plans):  # noqa: F811
    """Flags of unexploded records are those of exploded ones; one exchange, the term slots after it, in a number of parts that Spark does not join."""
    w = S.weigh(spark.createDataFrame(records(5), COLUMNS), V.PR).drop("C_class_id").localCheckpoint()
    cols = [M.ROW_ID, *DB.SLOT, "C_class_id", "C_class_id_original", DB.WEIGHT, DB.ADJ, "H_db_student_row", "H_db_teacher_row", "H_class_with_db", "H_db_100p_class"]
    got = DB.flag_records(w, V.PR).select(*cols)
    want = DB.flag_double_bookings(M.explode_records(w, V.PR, new_id=False), V.PR).select(*cols)
    assert got.count() > 0 and sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
    plan = physical(DB.flag_records(w, V.PR))
    assert plan.count("Exchange") == 1 and "REPARTITION_BY_NUM" in plan
    assert M.TERM not in plan[plan.index("Exchange"):]


@pytest.mark.parametrize("expands, same", [
    ({"S1": ["Q1", "Q2"], "S2": ["Q3", "Q4"], "FY": ["Q1", "Q2", "Q3", "Q4"]}, [{"S1", "S2", "FY"}]),
    ({"S1": ["Q1"], "S2": ["Q3"], "M": ["NA", "Q3"]}, [{"S1"}, {"S2", "M", "odd", None}])])
def test_terms_that_share_slots_stay_together(spark, expands, same):
    p = replace(V.PR, term_weights=dict.fromkeys(expands, 1.0), term_expands=expands)
    names = [*expands, *({n for g in same for n in g} - set(expands))]
    got = {r.D_term: r.g for r in spark.createDataFrame([(n,) for n in names], "D_term string").select("D_term", M.term_group(p).alias("g")).collect()}
    assert [{n for n in got if got[n] == got[next(iter(g))]} for g in same] == same


def test_load_off_is_marked_on_records(spark, plain_plans):  # noqa: F811
    """Same rows as when it is joined to the unified rows, which are wider and more; the resolved rows are dealt in a fixed number of parts."""
    w = S.weigh(spark.createDataFrame(records(6, 120), COLUMNS), V.PR).localCheckpoint()
    out = S.resolve(w, V.PR)
    off = spark.createDataFrame([(7, True), (7, True), (8, False)], "D_employee_id int, load_off boolean")
    made = out["resolved"].drop(*[c for c in out["resolved"].columns if c in w.columns and c not in (M.ROW_ID, "C_class_id")]).localCheckpoint()
    late, early = DB.unify(made.join(w.select(M.ROW_ID, "D_employee_id"), M.ROW_ID), w, off), DB.unify(made, w, off)
    cols = sorted(early.columns)
    assert sorted(late.columns) == cols and sorted(map(repr, early.select(cols).collect())) == sorted(map(repr, late.select(cols).collect()))
    assert {r.D_employee_id for r in early.filter("C_teacher_load_exclude = 'Exclude' and C_class_size_exclude = 'Include'").collect()} == {7}
    dealt = physical(DB.resolve_double_bookings(out["flagged"])[0])
    assert dealt.count("REPARTITION_BY_NUM") == 1
    joins = [line for line in physical(early).splitlines() if "Join" in line]
    assert M.ROW_ID in joins[0] and "__lks" in " ".join(joins[1:])
