"""Stopping gates of the plans: a clean run passes them all, and each one stops on input that breaks it."""

from __future__ import annotations

from dataclasses import replace

import pytest
from pyspark.sql import functions as F
from rollbook.operators.checks import CheckFailed, CheckLog
from rollbook.operators.gated import Gate, keyed, write_gated
from rollbook.plans import transcript as T

P = T.TranscriptParams(schools=("North",), race_map={"A": "Group A", "B": "Group B"}, entry_year=2022, progression={2022: 9, 2023: 10}, duration_min_days=50, snapshot_year=2023, min_coding_match_pct=90,
                       strip_prefix=None, strip_suffix=None)
SPELLS = "D_stu_id int, D_location_id int, D_location_name string, D_stu_grade_level_demo int, D_stu_race string, D_stu_ell int, D_stu_swd int, D_stu_frl int, D_stu_enter_date string, D_stu_exit_date string, D_year int"
COURSES = "D_stu_id int, D_year int, D_course_id string, D_course_name string, D_stu_grade_level_transcript int, D_stu_grade double, D_creds_earn double, D_creds_possible double"
CODING = "D_course_id string, D_course_name string, C_course_id string, C_course_subject_area string"


def spells():
    return [(s, 1, "North", 9 + y - 2022, "AB"[s % 2], 0, 0, 1, f"8/10/{y - 1}", f"6/1/{y}", y) for s in (1, 2, 3) for y in (2022, 2023)]


def courses():
    return [(s, y, c, n, 9 + y - 2022, 80.0, 0.5, 0.5) for s in (1, 2, 3) for y in (2022, 2023) for c, n in (("M1S1", "Math"), ("M1S2", "Math"), ("E1", "English"))]


def coding():
    return [("M1S1", "Math", "M1", "Math"), ("M1S2", "Math", "M1", "Math"), ("E1", "English", "E1", "English")]


def run(spark, sp=None, tr=None, co=None, p=P):
    log = CheckLog(spark)
    made = lambda rows, schema: spark.createDataFrame(rows, schema)
    try:
        out = T.build(made(sp or spells(), SPELLS), made(tr or courses(), COURSES), made(co or coding(), CODING), p, log)
    except CheckFailed as e:
        return log, str(e), None
    return log, None, out


def test_clean_run_logs_every_gate_as_pass(spark):
    log, error, out = run(spark)
    assert error is None
    stops = [r for r in log.rows if r[3] == "stop"]
    assert len(stops) == 29 and {r[4] for r in stops} == {"PASS"} and len({r[2] for r in stops}) == len(stops)
    assert {r[1] for r in log.rows} == {"locations", "enrolment spells", "transcript", "student-years of the transcript", "grades compared", "student-years", "course coding", "cohort criteria", "cohort", "transcript export"}
    assert {r.C_coding_source for r in out["transcript_out"].collect()} == {"id_and_name"} and out["transcript_out"].count() == 18
    assert not [c for c in out["transcript_out"].columns if c.startswith("__") or c == "H_entrant"]


def edited(rows, k, **change):
    names = [x.split()[0] for x in (SPELLS if len(rows[0]) == 11 else COURSES if len(rows[0]) == 8 else CODING).split(", ")]
    return [tuple(change.get(n, v) for n, v in zip(names, r, strict=True)) if i == k else r for i, r in enumerate(rows)]


BROKEN = {
    "every listed location exists": dict(p=replace(P, schools=("North", "South"))),
    "every location has every year": dict(sp=[*spells(), (9, 7, "East", 9, "A", 0, 0, 0, "8/10/2021", "6/1/2022", 2022)]),
    "dates parse: D_stu_enter_date": dict(sp=edited(spells(), 0, D_stu_enter_date="2021-08-10")),
    "dates parse: D_stu_exit_date": dict(sp=edited(spells(), 0, D_stu_exit_date="June 1st")),
    "exit date is not before enter date": dict(sp=edited(spells(), 0, D_stu_exit_date="8/1/2021")),
    "days enrolled are known": dict(sp=edited(spells(), 0, D_stu_enter_date=None)),
    "value map covers all codes: D_stu_race": dict(sp=edited(spells(), 0, D_stu_race="Z")),
    "grades beyond the hard bounds within tolerance": dict(tr=edited(courses(), 0, D_stu_grade=900.0)),
    "student and year are known": dict(tr=edited(courses(), 0, D_stu_id=None)),
    "transcript students found in enrolment": dict(tr=[*courses(), (77, 2022, "E1", "English", 9, 80.0, 0.5, 0.5)]),
    "transcript student-years found in enrolment": dict(tr=[*courses(), (1, 2024, "E1", "English", 11, 80.0, 0.5, 0.5), (2, 2024, "E1", "English", 11, 80.0, 0.5, 0.5)]),
    "grade levels agree": dict(tr=[(*r[:4], 12, *r[5:]) for r in courses()]),
    "grade level is known": dict(sp=edited(spells(), 0, D_stu_grade_level_demo=None), p=replace(P, min_grade_agreement_pct=0)),
    "course coding: keys are unique": dict(co=[*coding(), ("E1", "English", "E2", "Science")]),
    "cohort: at least 1 row(s)": dict(p=replace(P, duration_min_days=5000)),
    "cohort schools are in scope": dict(sp=[(*r[:1], 2, "South", *r[3:8], "8/1/2022", "6/30/2023", 2023) if r[0] == 3 and r[10] == 2023 else r for r in [*spells(), (4, 2, "South", 9, "A", 0, 0, 0, "8/10/2021", "6/1/2022", 2022)]],
                                        p=replace(P, school_rule="in_scope_any_year", min_student_match_pct=0, tolerances={"every location has every year": 100})),
    "course coding match rate": dict(co=coding()[:1], tr=courses()),
}


@pytest.mark.parametrize("gate", list(BROKEN))
def test_gate_stops_and_keeps_its_offenders(spark, gate):
    log, error, out = run(spark, **BROKEN[gate])
    named = "cohort: 0 row(s), need 1" if gate.startswith("cohort: at least") else gate
    assert out is None and named in error, error
    failed = [r[2] for r in log.rows if r[4] == "FAIL"]
    assert gate in failed and log.rows[-1][3] == "stop"
    if not gate.startswith("cohort: at least"):
        offenders = log.offenders(gate)
        assert offenders.count() >= 1 and not [c for c in offenders.columns if c.startswith("__")]
    if gate.startswith("value map"):
        assert [(r.D_stu_race, r.n_rows) for r in log.offenders(gate).collect()] == [("Z", 1)]


def test_declared_gap_and_tolerance_let_a_run_pass(spark):
    more = [*spells(), (9, 7, "East", 9, "A", 0, 0, 0, "8/10/2021", "6/1/2022", 2022)]
    assert run(spark, sp=more, p=replace(P, expected_years={"East": [2022]}))[1] is None
    assert run(spark, tr=edited(courses(), 0, D_stu_grade=900.0), p=replace(P, tolerances={"grades beyond the hard bounds within tolerance": 6}))[1] is None


def test_write_gated_counts_in_the_pass_that_writes(spark):
    log, writes = CheckLog(spark), []

    def store(df):
        from rollbook.sources.tables import cut_lineage
        writes.append(df)
        return cut_lineage(df)

    df = spark.range(100).withColumn("v", F.col("id") % 10)
    out, seen = write_gated(df, "numbers", log, [Gate("tens are few", F.col("v") == 0, 10.0), Gate("even base", F.col("v") > 8, 0.0, base=F.col("v") % 2 == 0)], {"sum": F.sum("v")}, store=store)
    assert len(writes) == 1 and seen == {"rows": 100, "sum": 450} and out.columns == ["id", "v"]
    assert [(r[2], r[4], r[5]) for r in log.rows if r[3] == "stop"] == [("tens are few", "PASS", "10 of 100"), ("even base", "PASS", "0 of 50")]
    with pytest.raises(CheckFailed, match="undecided: 1 of 2"):
        write_gated(spark.createDataFrame([(1,), (None,)], "x int"), "s", log, [Gate("undecided", F.coalesce(F.col("x") > 5, F.lit(True)))])
    assert log.offenders("undecided").collect() == [(None,)]
    empty, seen = write_gated(df.filter("id < 0"), "none", log, [Gate("fine", F.col("v") == 0)], {"sum": F.sum("v")})
    assert empty.count() == 0 and seen == {"rows": 0, "sum": None}
    with pytest.raises(CheckFailed, match="need 1"):
        write_gated(df.filter("id < 0"), "none", log, min_rows=1)
    assert write_gated(df, "quiet", None, [Gate("never", F.lit(True))])[1] == {}


def test_keyed_lookup(spark, tmp_path):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (None, "c")], "k int, v string")
    assert sorted(keyed(df, "k", "lookup", None).collect(), key=str) == [(1, "a"), (None, "c")]
    log = CheckLog(spark, evidence_dir=str(tmp_path))
    with pytest.raises(CheckFailed, match="lookup: keys are unique: 1 of 2"):
        keyed(df, "k", "lookup", log)
    assert [(r.k, r.n_rows) for r in log.offenders("lookup: keys are unique").collect()] == [(1, 1)]
    assert len(list(tmp_path.iterdir())) == 2  # the offenders and the log


def test_repeated_coding_and_null_subjects(spark):
    tr = spark.createDataFrame([("E1", "English"), ("E1", "Eng"), ("M1", "Math")], "D_course_id string, D_course_name string")
    co = spark.createDataFrame([("E1", "English", "E1", None), ("M1", "Math", "M1", "Math")], CODING)
    from rollbook.operators.joins import code_courses
    got = {(r.D_course_id, r.D_course_name): r.C_coding_source for r in code_courses(tr, co, needs="C_course_subject_area").collect()}
    assert got == {("E1", "English"): None, ("E1", "Eng"): None, ("M1", "Math"): "id_and_name"}
