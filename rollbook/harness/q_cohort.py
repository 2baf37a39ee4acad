"""Student-years, home schools, cohort and snapshot selection, exports."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import aggregates as A
from ..operators import cohort as C
from ..operators import joins as J
from ..operators import ordered as O
from ..operators import student_year as SY
from ..plans import transcript as T
from . import views as V
from .q_checks import clean_sp, clean_tr, read_tr
from .registry import query


def by_school(t):
    return SY.spells_by_school(clean_sp(t))


def student_year(t):
    """The student-year table, stored because the queries read it several times."""
    sp = clean_sp(t)
    return t.stored("student_year", lambda: SY.collapse_years(sp, SY.home_school(SY.spells_by_school(sp))))


def universe(sy):
    return C.entrants(sy, V.TR.entry_year, V.TR.entry_grade)


def crow(sy):
    return C.with_expected_grade(C.cohort_rows(sy, universe(sy), V.TR.years), V.TR.progression)


def built(t):
    return t.stored("transcript_analysis", lambda: T.build(V.sp_raw(t), V.tr_raw(t), V.coding(t), V.TR))


@query("a07_spells_by_school", "bys", "SELECT * FROM bys")
def _(t):
    return by_school(t)


@query("w03_home_school", "home", "SELECT * FROM home")
def _(t):
    return SY.home_school(by_school(t))


@query("w03_home_school_first_spell", "bys", """
SELECT D_stu_id, D_year, C_location_id AS C_home_school_id, days_at_school AS C_home_school_days, in_scope AS C_home_school_in_scope FROM (
  SELECT *, row_number() OVER (PARTITION BY D_stu_id, D_year ORDER BY first_enter, C_location_id) AS rn FROM bys) WHERE rn = 1""")
def _(t):
    return SY.home_school(by_school(t), "first_spell", "lowest_id")


@query("w05_ties_at_max", "bys", """
SELECT D_stu_id, D_year, C_location_id, days_at_school, n AS n_tied FROM (SELECT *, max(days_at_school) OVER p AS m, count(*) OVER (PARTITION BY D_stu_id, D_year, days_at_school) AS n
FROM bys WINDOW p AS (PARTITION BY D_stu_id, D_year)) WHERE days_at_school = m AND n > 1""")
def _(t):
    return O.ties_at_max(by_school(t), ["D_stu_id", "D_year"], "days_at_school").select("D_stu_id", "D_year", "C_location_id", "days_at_school", "n_tied")


@query("a08_c16_student_years", "sy", "SELECT * FROM sy")
def _(t):
    return student_year(t)


@query("a08_flags_from_home_spell", "sp home", """
SELECT D_stu_id, D_year, C_stu_poverty_flag, mg AS C_stu_grade_level FROM (SELECT sp.D_stu_id, sp.D_year, C_stu_poverty_flag,
  row_number() OVER (PARTITION BY sp.D_stu_id, sp.D_year ORDER BY M_days_enrolled DESC, D_stu_enter_date, D_stu_grade_level_demo, C_location_name_canonical, C_stu_ell_flag, C_stu_swd_flag, C_stu_poverty_flag) AS rn
  FROM sp JOIN home ON sp.D_stu_id = home.D_stu_id AND sp.D_year = home.D_year AND C_location_id = C_home_school_id) a
JOIN (SELECT D_stu_id, D_year, max(D_stu_grade_level_demo) AS mg FROM sp GROUP BY 1, 2) b USING (D_stu_id, D_year) WHERE rn = 1""")
def _(t):
    sp = clean_sp(t)
    return SY.collapse_years(sp, SY.home_school(SY.spells_by_school(sp)), "home_school", "max").select("D_stu_id", "D_year", "C_stu_poverty_flag", "C_stu_grade_level")


@query("a09_home_share", "home bys", """
SELECT count(*) AS student_years, round_even(median(s), 3) AS median_share, round_even(100e0 * count(*) FILTER (s >= 999e-3) / count(s), 1) AS pct_home_school_100,
  round_even(100e0 * count(*) FILTER (s < 75e-2) / count(s), 1) AS pct_home_school_lt75 FROM (SELECT CASE WHEN t > 0 THEN C_home_school_days / t::DOUBLE END AS s FROM home
  JOIN (SELECT D_stu_id, D_year, sum(days_at_school) AS t FROM bys GROUP BY 1, 2) USING (D_stu_id, D_year))""")
def _(t):
    b = by_school(t)
    return SY.home_share(SY.home_school(b), b)


@query("c16_student_year_gates", "sy", """
SELECT "check", CASE WHEN n_offenders = 0 THEN 'PASS' ELSE 'FAIL' END AS result, n_offenders FROM (
SELECT 'home school is known' AS "check", count(*) FILTER (C_home_school_id IS NULL) AS n_offenders FROM sy UNION ALL SELECT 'grade level is known', count(*) FILTER (C_stu_grade_level IS NULL) FROM sy
UNION ALL SELECT 'home days within days enrolled', count(*) FILTER (C_home_school_days > M_days_enrolled_year) FROM sy
UNION ALL SELECT 'one row per student-year', count(*) - count(DISTINCT (D_stu_id, D_year)) FROM sy)""")
def _(t):
    return SY.student_year_gates(student_year(t))


@query("a25_student_years_by_year", "sy", """
SELECT D_year, count(*) AS student_years, round_even(100e0 * count(*) FILTER (n_schools > 1) / count(*), 1) AS pct_multischool, median(M_days_enrolled_year) AS median_days,
  round_even(100e0 * count(*) FILTER (C_home_school_in_scope) / count(*), 1) AS pct_in_scope, round_even(100e0 * count(*) FILTER (C_stu_ell_flag = 1) / count(*), 1) AS pct_ell,
  round_even(100e0 * count(*) FILTER (C_stu_swd_flag = 1) / count(*), 1) AS pct_swd, round_even(100e0 * count(*) FILTER (C_stu_poverty_flag = 1) / count(*), 1) AS pct_poverty FROM sy GROUP BY 1""")
def _(t):
    return A.student_years_by_year(student_year(t))


@query("a25_joined_by_year", "tr sy", """
SELECT tr.D_year, count(*) AS n_rows, round_even(100e0 * count(C_home_school_id) / count(*), 2) AS pct_with_school,
  round_even(100e0 * count(*) FILTER (C_home_school_in_scope) / count(C_home_school_in_scope), 1) AS pct_in_scope FROM tr LEFT JOIN sy USING (D_stu_id, D_year) GROUP BY 1""")
def _(t):
    return A.joined_by_year(J.join_checked(read_tr(t).select("D_stu_id", "D_year"), student_year(t).select("D_stu_id", "D_year", "C_home_school_id", "C_home_school_in_scope"), ["D_stu_id", "D_year"]))


@query("w02_mobility", "mob", "SELECT * FROM mob")
def _(t):
    return O.mobility(student_year(t))


@query("c01_year_rule_bookends", "crow", """
SELECT D_stu_id, count(*) = 2 AND count(*) FILTER (M_days_enrolled_year >= 100) = 2 AS passes FROM crow WHERE D_year IN (1996, 1999) GROUP BY 1""")
def _(t):
    return C.year_rule(crow(student_year(t)), C.duration_ok("days", 100), "bookends", V.TR.years)


@query("c02_funnel_report", "crit", """
SELECT * FROM (WITH n AS (SELECT count(*) AS n0, count(*) FILTER (C_met_years) AS n1, count(*) FILTER (C_met_years AND C_met_duration) AS n2, count(*) FILTER (C_met_years AND C_met_duration AND C_met_progression) AS n3,
  count(*) FILTER (C_met_years AND C_met_duration AND C_met_progression AND C_met_school) AS n4 FROM crit),
r AS (SELECT unnest([1, 2, 3, 4, 5]) AS step, unnest(['starting universe', 'enrolled in all years', 'duration', 'grade progression', 'home school in scope']) AS criterion,
  unnest([n0, n1, n2, n3, n4]) AS students, unnest([NULL, n0, n1, n2, n3]) AS prev, n0 FROM n)
SELECT step, criterion, students, prev - students AS dropped, round_even(100e0 * students / prev, 1) AS pct_of_previous, round_even(100e0 * students / n0, 1) AS pct_of_start,
  round_even(round_even(100e0 * students / prev, 1) - 85e0, 1) AS vs_benchmark FROM r)""")
def _(t):
    _, criteria, _ = T.select_cohort(student_year(t), V.TR)
    return C.funnel_report(criteria, {k: F.col(v) for k, v in T.FUNNEL.items()}, benchmark=85)


@query("c03_entrants_in_scope", "ent", "SELECT C_home_school_name, count(*) AS n FROM ent WHERE C_home_school_in_scope GROUP BY 1")
def _(t):
    return C.entrants(student_year(t), 1996, 9, "entry_grade_in_scope").groupBy("C_home_school_name").agg(F.count(F.lit(1)).alias("n"))


@query("c04_presence", "crow", "SELECT years_present, years_present = 4 AS passes, count(*) AS n FROM (SELECT count(DISTINCT D_year) AS years_present FROM crow GROUP BY D_stu_id) GROUP BY 1")
def _(t):
    return C.presence(crow(student_year(t)), 4).groupBy("years_present", "passes").agg(F.count(F.lit(1)).alias("n"))


@query("c05_duration_by_year", "crow", """
SELECT D_year, count(*) AS students, median(M_days_enrolled_year) AS median_days, round_even(100e0 * count(*) FILTER (M_days_enrolled_year / 333e0 >= 25e-2) / count(*), 1) AS pct_meeting FROM crow GROUP BY 1""")
def _(t):
    return C.duration_by_year(crow(student_year(t)), C.duration_ok("share", min_share=0.25))


@query("c06_duration_sensitivity", "crow", """
SELECT threshold_days::INT AS threshold_days, round_even(100e0 * threshold_days / 333, 1) AS pct_of_window, count(*) FILTER (y = 4 AND k = 4) AS students_passing FROM (
  SELECT threshold_days, D_stu_id, count(*) AS y, count(*) FILTER (M_days_enrolled_year >= threshold_days) AS k FROM crow, (VALUES (5), (10), (20), (40), (80)) v(threshold_days) GROUP BY 1, 2) GROUP BY ALL""")
def _(t):
    sy = student_year(t)
    return C.duration_sensitivity(crow(sy), [5, 10, 20, 40, 80], "all_years", V.TR.years, universe(sy))


@query("c07_off_grade", "crow", "SELECT D_year, grade_expected, C_stu_grade_level, count(*) AS n_students FROM crow WHERE NOT on_grade GROUP BY ALL")
def _(t):
    return C.off_grade(crow(student_year(t)))


@query("c08_school_rules", "crow", """
SELECT D_stu_id, count(*) = 4 AND count(*) FILTER (C_home_school_in_scope) = 4 AS all_years, coalesce(bool_or(C_home_school_in_scope) FILTER (D_year = 1996), false) AS entry_year,
  bool_or(C_home_school_in_scope) AS any_year FROM crow GROUP BY 1""")
def _(t):
    from ..functions.nullsafe import flag, join_same
    rows = crow(student_year(t))
    parts = [C.school_rule(rows, r, V.TR.years, 1996, n) for r, n in (("in_scope_all_years", "all_years"), ("in_scope_entry_year", "entry_year"), ("in_scope_any_year", "any_year"))]
    out = join_same(join_same(rows.select("D_stu_id").distinct(), parts[0], "D_stu_id"), parts[1], "D_stu_id")
    return join_same(out, parts[2], "D_stu_id").withColumns({c: flag(c) for c in ("all_years", "entry_year", "any_year")})


@query("c09_school_attribution", "crow", """
SELECT D_stu_id, C_home_school_id AS C_cohort_school_id, C_home_school_name AS C_cohort_school_name, n AS C_multiple_home_schools, n > 1 AS C_multiple_home_schools_flag FROM (
  SELECT *, row_number() OVER (PARTITION BY D_stu_id ORDER BY k DESC, C_home_school_id, C_home_school_name) AS rn, count(*) OVER (PARTITION BY D_stu_id) AS n FROM (
    SELECT D_stu_id, C_home_school_id, C_home_school_name, count(*) AS k FROM crow GROUP BY 1, 2, 3)) WHERE rn = 1""")
def _(t):
    sy = student_year(t)
    return C.attribute_school(sy, universe(sy), V.TR.years, "modal")


@query("c10_cohort_table", "coh", "SELECT * FROM coh")
def _(t):
    return T.select_cohort(student_year(t), V.TR)[2]


@query("c11_criteria_table", "crit", "SELECT * FROM crit")
def _(t):
    return T.select_cohort(student_year(t), V.TR)[1]


@query("c12_cohort_gates", "coh ent scope_ids", """
SELECT "check", CASE WHEN n_offenders = 0 THEN 'PASS' ELSE 'FAIL' END AS result, n_offenders FROM (SELECT 'one cohort row per student' AS "check", count(*) - count(DISTINCT D_stu_id) AS n_offenders FROM coh
UNION ALL SELECT 'cohort students are entrants', count(*) FILTER (D_stu_id NOT IN (SELECT D_stu_id FROM ent)) FROM coh UNION ALL SELECT 'cohort schools are in scope', count(*) FILTER (C_cohort_school_id NOT IN (SELECT id FROM scope_ids)) FROM coh
UNION ALL SELECT 'cohort school is known', count(*) FILTER (C_cohort_school_id IS NULL) FROM coh)""")
def _(t):
    sp = clean_sp(t)
    sy = student_year(t)
    u, _, cohort = T.select_cohort(sy, V.TR)
    return C.cohort_gates(cohort, u, sp.filter("C_school_in_scope").select(F.col("C_location_id").alias("location_id")).distinct())


@query("c13_credit_recovery", "tr", """
SELECT D_stu_id, D_year, D_course_id FROM tr a WHERE C_creds_earn_exceeds_attempted AND C_term = 'Semester 2'
  AND (SELECT CASE WHEN count(*) > 0 AND count(D_creds_earn) = count(*) THEN min(D_creds_earn) END FROM tr b WHERE b.D_stu_id = a.D_stu_id AND b.D_year = a.D_year AND b.C_course_id_base = a.C_course_id_base AND b.C_term = 'Semester 1') = 0""")
def _(t):
    return C.credit_recovery(clean_tr(t)).filter("C_credit_recovery_flag").select("D_stu_id", "D_year", "D_course_id")


@query("j10_companion_status", "tr", """
SELECT s1_status, count(*) AS n_rows, round_even(100e0 * count(*) / sum(count(*)) OVER (), 1) AS pct FROM (SELECT CASE WHEN s IS NULL THEN 'no S1 record' WHEN s = 0 THEN 'S1 earned zero' ELSE 'S1 earned credit' END AS s1_status FROM tr a
LEFT JOIN (SELECT D_stu_id, D_year, C_course_id_base, CASE WHEN count(D_creds_earn) = count(*) THEN min(D_creds_earn) END AS s FROM tr WHERE C_term = 'Semester 1' GROUP BY 1, 2, 3) b
  USING (D_stu_id, D_year, C_course_id_base) WHERE C_creds_earn_exceeds_attempted AND C_term = 'Semester 2') GROUP BY 1""")
def _(t):
    return C.recovery_status(clean_tr(t))


@query("c14_snapshot_selection", "snap", "SELECT * FROM snap")
def _(t):
    return C.snapshot_table(student_year(t), read_tr(t), 1998, [9, 10, 11, 12], "days", 60)


@query("c14_snapshot_by_credits", "sy tr", """
SELECT D_stu_id, C_stu_grade_level IN (9, 10) AS ok_grade, C_home_school_in_scope AS ok_school, coalesce(c >= 2, false) AS ok_load, C_stu_grade_level IN (9, 10) AND C_home_school_in_scope AND coalesce(c >= 2, false) AS selected
FROM sy LEFT JOIN (SELECT D_stu_id, sum(D_creds_possible) AS c FROM tr WHERE D_year = 1998 GROUP BY 1) USING (D_stu_id) WHERE D_year = 1998""")
def _(t):
    return C.snapshot_table(student_year(t), clean_tr(t), 1998, [9, 10], "credits_attempted", credits_min=2.0)


@query("c15_student_year_export", "sy crit mob coh snap", """
SELECT sy.D_stu_id, sy.D_year, C_met_years, C_met_school, C_cohort_exclusion_reason, C_pure_cohort, C_cohort_school_name, coalesce(C_stu_cohort, 'exclude') AS C_stu_cohort,
  crit.D_stu_id IS NOT NULL AS C_entry_cohort_candidate, CASE WHEN selected AND sy.D_year = 1998 THEN 'include' ELSE 'exclude' END AS C_stu_snapshot
FROM sy LEFT JOIN crit USING (D_stu_id) LEFT JOIN mob USING (D_stu_id) LEFT JOIN coh USING (D_stu_id) LEFT JOIN snap USING (D_stu_id)""")
def _(t):
    return built(t)["student_year_export"].select("D_stu_id", "D_year", "C_met_years", "C_met_school", "C_cohort_exclusion_reason", "C_pure_cohort", "C_cohort_school_name",
                                                  "C_stu_cohort", "C_entry_cohort_candidate", "C_stu_snapshot")


@query("transcript_export_summary", "coded sy coh", """
SELECT c.D_year, C_coding_source, coalesce(D_creds_possible > 0 AND D_creds_earn = 0, false) AS C_course_failed, c.D_stu_id IN (SELECT D_stu_id FROM coh) AS C_cohort_include, C_home_school_in_scope, count(*) AS n
FROM coded c LEFT JOIN sy USING (D_stu_id, D_year) GROUP BY ALL""")
def _(t):
    return built(t)["transcript_out"].groupBy("D_year", "C_coding_source", "C_course_failed", "C_cohort_include", "C_home_school_in_scope").agg(F.count(F.lit(1)).alias("n"))


@query("a16_retention_profile", "ent coh", """
SELECT g AS "group", count(*) AS n, round_even(100e0 * count(*) FILTER (k) / count(*), 1) AS pct_retained FROM (
  SELECT unnest(['All entrants', 'Race: ' || C_stu_race, 'ELL: ' || C_stu_ell_flag, 'SWD: ' || C_stu_swd_flag, 'Poverty: ' || C_stu_poverty_flag]) AS g, D_stu_id IN (SELECT D_stu_id FROM coh) AS k FROM ent) GROUP BY 1""")
def _(t):
    from ..operators.scope import member_flag
    u, _, cohort = T.select_cohort(student_year(t), V.TR)
    return A.retention_profile(member_flag(u, cohort, "D_stu_id", "in_cohort"))


@query("a16_retention_by_school", "ent coh", """
SELECT C_home_school_name, count(*) AS entrants, count(*) FILTER (D_stu_id IN (SELECT D_stu_id FROM coh)) AS cohort, round_even(100e0 * count(*) FILTER (D_stu_id IN (SELECT D_stu_id FROM coh)) / count(*), 1) AS pct_retained FROM ent GROUP BY 1""")
def _(t):
    from ..operators.scope import member_flag
    u, _, cohort = T.select_cohort(student_year(t), V.TR)
    return A.retention_by(member_flag(u, cohort, "D_stu_id", "in_cohort"), "C_home_school_name")
