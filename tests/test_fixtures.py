"""Hand-computed cases."""

import pytest
from pyspark.sql import functions as F

from rollbook.functions import dates, ranges, school, text
from rollbook.functions.nullsafe import join_same, n_distinct
from rollbook.operators import addons, analysis, checks, cohort, double_booking as DB, joins, meetings as M, network as N, ordered, scope, student_year
from rollbook.operators.components import connected_components
from rollbook.plans import schedule


def col(df, c):
    return [r[c] for r in df.collect()]


def one(spark, expr, **values):
    d = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()], F.lit(0).alias("z_"))
    return d.select(expr.alias("v")).first()["v"]


def test_keys_and_nulls(spark):
    d = spark.createDataFrame([(1, 2022, 10), (1, 2023, 20), (2, 2022, 30), (3, 2022, None)], "id int, year int, score int")
    assert checks.unique(d, ["id", "year"]).result().first()["result"] == "PASS"
    assert checks.no_nulls(d, ["score"]).result().first()["n_offenders"] == 1
    log = checks.CheckLog(spark)
    with pytest.raises(checks.CheckFailed):
        log.require(checks.no_nulls(d, ["score"], "score known"))
    assert log.offenders("score known").count() == 1 and log.table().count() == 1


def test_null_keys_match_and_count(spark):
    a = spark.createDataFrame([(None, 1), (5, 2)], "k int, x int")
    b = spark.createDataFrame([(None, "n")], "k int, y string")
    assert sorted(map(str, col(join_same(a, b, "k"), "y"))) == ["None", "n"]
    assert a.agg(n_distinct("k").alias("n")).first()["n"] == 2
    with pytest.raises(checks.CheckFailed):
        joins.join_checked(a, b.union(b), "k", log=checks.CheckLog(spark))


def test_dates(spark):
    d = spark.createDataFrame([("7/4/2022",), (" ",), ("2022-07-04",)], "x string")
    out = d.select(dates.parse_date("x", ["M/d/yyyy"]).alias("d"), dates.date_unreadable("x", ["M/d/yyyy"]).alias("bad")).collect()
    assert [str(r["d"]) for r in out] == ["2022-07-04", "None", "None"] and [r["bad"] for r in out] == [False, False, True]
    s = spark.sql("select 2022 as D_year, date'2021-12-12' as D_stu_enter_date, date'2022-06-30' as D_stu_exit_date union all select 2022, date'2021-07-10', date'2021-07-12'")
    rows = dates.enrolment_days(s).orderBy("D_stu_enter_date").collect()
    assert [r["M_days_enrolled"] for r in rows] == [-20, 200] and rows[0]["C_spell_before_window"]
    assert sorted(col(dates.negative_days(dates.enrolment_days(s)), "M_days_enrolled")) == [0, 200]


def test_text(spark):
    assert one(spark, text.clean_location_name("x", r"^\d{2}-\d{2}\s+", r"\s+\d{1,2}-\d{1,2}$"), x="24-25 Pearl-Lake High 9-12") == "Pearl-Lake High"
    assert one(spark, text.base_course_id("x", r"(?:\p{P})?(?:S1|S2)$"), x="ENG1302-S1") == "ENG1302"
    from rollbook.plans.transcript import TERM_RULES
    d = spark.createDataFrame([("ENG1S1", "English S2"), ("ENG1", "English S2 *")], "i string, n string")
    assert col(d.select(text.first_pattern(["i", "n"], TERM_RULES)[0].alias("v")), "v") == ["Semester 1", "Semester 2"]


@pytest.mark.parametrize("names,want", [(["Algebra 1", "Algebra 2"], "Algebra 1 / 2"), (["Phys Ed", "Phys Ed 10"], "Phys Ed 10"), (["Band I", "Band II"], "Band I / II"),
                                        (["Art 10", "Art  9", None], "Art 9 / 10"), (["Choir", "Drama"], "Choir / Drama"), ([None], None), (["A 1 x", "A 2 x"], "A 1 x / 2 x")])
def test_collapsed_names(spark, names, want):
    d = spark.createDataFrame([(names,)], "n array<string>")
    assert text.collapse_names(d, "n", "v").first()["v"] == want


def test_ranges(spark):
    d = spark.createDataFrame([(100.05,), (111.0,)], "g double")
    rows = ranges.two_tier(d, "g", (0, 100), (0, 110), "na", "p", "h").collect()
    assert [(r["g"], r["p"], r["h"]) for r in rows] == [(100.05, True, False), (None, True, True)]
    g = spark.createDataFrame([(90.0,), (89.99,), (0.0,), (-1.0,), (None,)], "x double")
    b = [(90, "90+"), (80, "80-89"), (70, "70-79"), (60, "60-69"), (0, "Below 60")]
    assert col(g.select(ranges.bucket_down("x", b).alias("v")), "v") == ["90+", "80-89", "Below 60", None, None]
    s = spark.createDataFrame([(6.0,), (6.5,), (7.0,), (40.0,), (None,)], "x double")
    assert col(s.select(ranges.bucketize("x", M.ScheduleParams().size_buckets).alias("v")), "v") == ["0-6", "0-6", "7-12", "36+", None]


def test_class_id_writes_missing_as_text(spark):
    d = spark.createDataFrame([(10, "Q1", None, "01")], "D_location_id int, D_term string, D_period string, D_course_section_id string")
    assert col(d.select(school.class_id(d.columns, ["D_location_id", "D_term", "D_period", "D_course_section_id"]).alias("v")), "v") == ["10_Q1_NA_01"]


def _meetings(spark, text_, **kw):
    p = M.ScheduleParams(time_format="expression", **kw)
    d = spark.createDataFrame([(text_,)], "D_expression string")
    return sorted(f"{r[M.PERIOD]}@{r[M.ROTATION]}" for r in M.meeting_crosswalk(d, p).collect())


def test_expressions(spark):
    assert len(_meetings(spark, "1-3(A-B)")) == 6
    assert _meetings(spark, "4(A), 6-5(B)") == ["4@A", "5@B", "6@B"]
    assert _meetings(spark, "3(A,B)") == [] and _meetings(spark, "x") == []
    assert _meetings(spark, "3-4(A)", atoms=("3", "4a", "4b", "5"), expands={"4": ["4a", "4b"]}) == ["3@A", "4a@A", "4b@A"]


def test_serialized_meetings(spark):
    rows = [("x", p, r) for p in "123" for r in "AB"] + [("y", "4", "A"), ("y", "5", "B"), ("y", "6", "B")] + [("z", "HR", "A"), ("z", "2", "A")]
    d = spark.createDataFrame(rows, f"k string, {M.PERIOD} string, {M.ROTATION} string")
    got = {r["k"]: r["merged_expr"] for r in M.serialize_meetings(d, ["k"]).collect()}
    assert got == {"x": "1-3(A-B)", "y": "4(A), 5-6(B)", "z": "2(A), HR(A)"}


TERMS = dict(term_weights={"FY": 1.0, "Q1": 0.25}, term_expands={"FY": ["Q1", "Q2", "Q3", "Q4"]}, rotation_default=0.5)


def test_weights_and_explosion(spark):
    p = M.ScheduleParams(time_format="expression", recipe=("D_location_id", "D_term", "D_expression", "D_course_section_id"), **TERMS)
    d = spark.createDataFrame([(1, 10, "N", "FY", "1-2(A-B)", "01")], "D_stu_id long, D_location_id int, D_location_name string, D_term string, D_expression string, D_course_section_id string")
    w = schedule.weigh(d, p)
    assert w.first()["M_cls_class_weight"] == 2.0
    x = M.explode_records(w, p)
    assert x.count() == 16 and sum(col(x, "M_class_weight_exploded")) == 2.0 and M.explosion_differences(x, w).count() == 0


REC = "D_stu_id long, D_employee_id long, D_location_id int, D_location_name string, D_term string, D_period string, D_rotation string, D_course_section_id string, D_course_id string"


def records(spark, rows):
    d = spark.createDataFrame(rows, REC)
    return d.withColumns({"C_course_time_exclude": F.lit("Include"), "C_class_size_and_teacher_load_exclude": F.lit("Include"), "C_course_subject_area": F.lit("Core")})


PR = M.ScheduleParams(rotation_default=1.0, **{k: v for k, v in TERMS.items() if k != "rotation_default"})


def rec(stu, tch, sec, period="1", rot="A", course="c"):
    return (stu, tch, 10, "N", "Q1", period, rot, sec, course)


def test_student_flags_and_split(spark):
    w = schedule.weigh(records(spark, [rec(1, 501, "X"), rec(1, 502, "Y"), rec(2, 501, "X"), rec(3, 503, "Z", "2", course="a"), rec(3, 503, "Z", "2", course="b")]), PR)
    f = DB.flag_double_bookings(M.explode_records(w, PR), PR)
    flags = {(r["D_stu_id"], r["D_course_section_id"]): r["H_db_student_row"] for r in f.collect()}
    assert flags == {(1, "X"): 1, (1, "Y"): 1, (2, "X"): 0, (3, "Z"): 0}
    assert {r[DB.ADJ] for r in f.filter("D_stu_id = 3").collect()} == {0.125}
    r = schedule.resolve(w, PR)
    got = {(x["D_stu_id"], x["D_course_section_id"]): (x["M_class_weight"], x["M_student_count_adjusted"]) for x in r["unified"].filter("D_stu_id < 3").collect()}
    assert got == {(1, "X"): (0.125, 0.5), (1, "Y"): (0.125, 0.5), (2, "X"): (0.25, 1.0)}
    rolled = schedule.roll_up(r["unified"].withColumns({c: F.lit("x") for c in ("C_course_subject", "C_course_name", "C_course_credit_type", "C_course_rigor")}).withColumn("D_stu_grade", F.lit(9)), PR)
    sizes = {x["D_course_section_id"]: (x["M_cls_num_stu"], x["M_cls_class_size"]) for x in rolled["unified"].filter("D_stu_id < 3").collect()}
    assert sizes == {"X": (2, 1.5), "Y": (1, 0.5)} and rolled["class"].count() == 3


def test_fully_double_booked_split_once(spark):
    w = schedule.weigh(records(spark, [rec(4, 601, "V"), rec(4, 602, "W")]), PR)
    rows = schedule.resolve(w, PR)["resolved"].collect()
    assert {(r["M_class_weight_post_student"], r["M_student_count_adjusted"], r["H_student_count_of_100p_classes"]) for r in rows} == {(0.125, 0.5, 2)}


def test_consolidation_chain_and_missing_teacher(spark):
    w = schedule.weigh(records(spark, [rec(1, 501, "A"), rec(2, 501, "B", rot="A-B"), rec(3, 501, "C", rot="B"), rec(4, None, "D"), rec(5, None, "E")]), PR)
    f = DB.flag_double_bookings(M.explode_records(w, PR), PR)
    m = {r["C_class_id_original"].split("_")[-1]: r for r in DB.consolidate_sections(f).collect()}
    assert len({m[s]["C_class_id_consolidated"] for s in "ABC"}) == 1 and m["A"]["C_class_id_consolidated"] == "CONS_10_501_1(A-B)_Q1"
    assert m["A"]["n_sections"] == 3 and not m["D"]["is_consolidated"] and not m["E"]["is_consolidated"]


def test_long_chain_is_one_component(spark):
    d = spark.createDataFrame([(f"n{i:03d}", g) for i in range(60) for g in (i, i + 1)] + [("z", 999)], "n string, g int")
    c = connected_components(d, "n", "g")
    assert {r["component"] for r in c.collect()} == {"n000", "z"} and c.count() == 61


def test_exclusions_and_snapshot(spark):
    d = spark.createDataFrame([(None,)], "a string")
    out = scope.apply_exclusions(d, {"m1": [{"col": "a", "op": "eq", "val": "Untracked"}], "m2": [{"col": "gone", "op": "eq", "val": 1}], "m3": [{"col": "a", "op": "not_in", "val": ["x"]}],
                                     "m4": [{"col": "a", "op": "odd", "val": 1}]}).first()
    assert (out["m1"], out["m2"], out["m3"], out["m4"]) == ("Include", "Include", "Exclude", "Include")
    s = spark.sql("select 'Q1' as D_term, date'2024-08-05' as D_stu_enter_date, date'2024-09-16' as D_stu_exit_date union all select 'Q1', date'2024-08-05', null")
    assert sorted(col(scope.snapshot_flag(s, {"Q1": "2024-09-16"}), "C_stu_snapshot")) == ["Exclude", "Include"]


def test_home_school_tie(spark):
    d = spark.sql("select 1L as D_stu_id, 2022 as D_year, 10 as C_location_id, 100L as days_at_school, date'2021-08-01' as first_enter, date'2022-01-01' as last_exit, false as in_scope "
                  "union all select 1L, 2022, 20, 100L, date'2021-08-01', date'2022-01-01', true")
    assert student_year.home_school(d).first()["C_home_school_id"] == 20
    assert student_year.home_school(d, tiebreak="lowest_id").first()["C_home_school_id"] == 10


def test_year_rules_and_funnel(spark):
    d = spark.createDataFrame([(1, y) for y in (2022, 2023, 2025)], "D_stu_id long, D_year int")
    got = {r: cohort.year_rule(d, F.lit(True), r, [2022, 2023, 2024, 2025]).first()["passes"] for r in ("all_years", "bookends", "none")}
    assert got == {"all_years": False, "bookends": True, "none": True}
    c = spark.createDataFrame([(i, i < 8, i < 4) for i in range(10)], "D_stu_id int, a boolean, b boolean")
    rows = cohort.funnel_report(c, {"first": F.col("a"), "second": F.col("b")}).orderBy("step").collect()
    assert [(r["students"], r["dropped"], r["pct_of_previous"], r["pct_of_start"]) for r in rows] == [(10, None, None, 100.0), (8, 2, 80.0, 80.0), (4, 4, 50.0, 40.0)]


def test_credit_recovery(spark):
    d = spark.createDataFrame([(1, 2022, "C1S1", "C1", "Semester 1", 0.0, False), (1, 2022, "C1S2", "C1", "Semester 2", 1.0, True)],
                              "D_stu_id int, D_year int, D_course_id string, C_course_id_base string, C_term string, D_creds_earn double, C_creds_earn_exceeds_attempted boolean")
    assert {r["D_course_id"]: r["C_credit_recovery_flag"] for r in cohort.credit_recovery(d).collect()} == {"C1S1": False, "C1S2": True}


def test_coding_fallback(spark):
    t = spark.createDataFrame([("id1", "other"), ("id2", "other"), ("id1", "n")], "D_course_id string, D_course_name string")
    c = spark.createDataFrame([("id1", "n", "K1"), ("id2", "a", "K2"), ("id2", "b", "K3")], "D_course_id string, D_course_name string, C_course_id string")
    got = {(r["D_course_id"], r["D_course_name"]): r["C_coding_source"] for r in joins.code_courses(t, c).collect()}
    assert got == {("id1", "other"): "id_only", ("id2", "other"): None, ("id1", "n"): "id_and_name"}


def test_staff_and_grades(spark):
    s = spark.createDataFrame([(1, 2.0), (2, 3.0)], "D_employee_id long, D_tch_yrs_experience double")
    assert col(addons.hr_experience(s).orderBy("D_employee_id"), "C_tch_novice_indicator") == ["Novice", "Not Novice"]
    g = spark.createDataFrame([("N", 1, 9, "c", "e", "Regular", "English", "B"), ("N", 1, 9, "c", "m", "Regular", "Math", "D")],
                              "D_location_name string, D_stu_id int, D_stu_grade int, D_stu_cohort string, D_course_name string, D_course_category string, D_course_subject string, D_stu_course_grade string")
    coding = spark.createDataFrame([("e", "English", "Graduation Required"), ("m", "Math", "Graduation Required")], "D_course_name string, C_course_subject string, C_course_credit_type string")
    r = addons.student_proficiency(addons.prepare_grades(g, coding)).first()
    assert (r["C_proficiency_ela"], r["C_proficiency_math"], r["C_proficiency"]) == ("Proficient", "Below Proficient", "Partially Proficient")


def roster(spark, classes):
    return spark.createDataFrame([("S", c, s) for c, ss in classes.items() for s in ss], "D_location_name string, C_class_id string, D_stu_id string")


@pytest.mark.parametrize("block", [1, 2, 1024])
def test_pairs_do_not_depend_on_blocks(spark, block):
    classes = {"P": "abc", "Q": "ab", "H": "abcdefghij"}
    want = {}
    for ss in classes.values():
        for i in range(len(ss)):
            for j in range(i + 1, len(ss)):
                want[ss[i], ss[j]] = want.get((ss[i], ss[j]), 0) + 1
    got = {(r["D_stu_id_1"], r["D_stu_id_2"]): r["M_shared_classes"] for r in N.student_pairs(roster(spark, classes), block).collect()}
    assert got == want


def test_two_cliques(spark):
    r = roster(spark, {"L": "abcd", "R": "efgh", "bridge": "de"})
    rows = N.infer_cohorts(r).collect()
    groups = {}
    for x in rows:
        groups.setdefault(x["C_inferred_cohort"], set()).add(x["D_stu_id"])
    assert sorted(map(sorted, groups.values())) == [list("abcd"), list("efgh")]
    assert {round(x["M_school_modularity"], 4) for x in rows} == {0.4231} and len(rows) == 8


def test_purity(spark):
    r = roster(spark, {"k": "abcd"}).withColumns({"C_course_subject": F.lit("s"), "C_course_name": F.lit("n")})
    m = spark.createDataFrame([("S", s, "Cohort 2" if s == "d" else "Cohort 1") for s in "abcd"], "D_location_name string, D_stu_id string, C_inferred_cohort string")
    s = N.section_purity(r, m).first()
    assert (s["M_cls_cohort_purity"], s["C_cls_dominant_cohort"]) == (0.75, "Cohort 1")
    a = N.student_class_purity(r, m).filter("D_stu_id = 'a'").first()
    assert (a["M_stu_num_same_cohort_classmates"], a["M_stu_num_classmates"], round(a["M_stu_class_cohort_purity"], 4)) == (2, 3, 0.6667)


def test_gap_list(spark):
    d = spark.createDataFrame([("own", "p", "a"), ("x", "p", "a"), ("x", "p", "b"), ("y", "p", "b")], "school string, path string, course string")
    assert sorted(r["school"] + r["course"] for r in analysis.gap_list(d, "school", "path", "course", "own", ["p"]).collect()) == ["xb", "yb"]


def test_rank_groups(spark):
    d = spark.createDataFrame([("S", i % 2, f"g{i}") for i in range(9)], "s string, n int, g string")
    assert sorted(int(x.split()[1]) for x in col(ordered.rank_groups(d, ["s"], "n", "g", "Cohort ", "label"), "label")) == list(range(1, 10))
