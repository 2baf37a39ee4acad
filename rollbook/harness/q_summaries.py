"""Grouped summaries of transcripts, spells and schedules."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.nullsafe import distinct_counts
from ..operators import aggregates as A
from ..operators import joins as J
from ..plans import transcript as T
from . import views as V
from .q_checks import clean_sp, clean_tr, read_sp, read_tr
from .q_reconcile import orphans
from .registry import query


@query("a01_share_counts", "tr", "SELECT D_creds_possible, D_creds_earn, count(*) AS n_rows, round_even(100e0 * count(*) / sum(count(*)) OVER (PARTITION BY D_creds_possible), 1) AS pct FROM tr GROUP BY 1, 2")
def _(t):
    return A.share_counts(clean_tr(t), ["D_creds_possible", "D_creds_earn"], within=["D_creds_possible"])


@query("a02_conditional_distinct", "tr", "SELECT D_year, count(DISTINCT D_stu_id) AS students, count(DISTINCT D_stu_id) FILTER (D_creds_earn = 0) AS failing FROM tr GROUP BY 1")
def _(t):
    return distinct_counts(clean_tr(t), "D_year", "D_stu_id", {"failing": F.col("D_creds_earn") == 0}, "students")


@query("a03_credit_rates", "tr", """
SELECT *, round_even(100e0 * n_zero_attempted / n_rows, 2) AS pct_zero_attempted, round_even(100e0 * n_zero_earned / n_credit_bearing, 1) AS pct_zero_earned FROM (
  SELECT D_year, count(*) AS n_rows, count(*) FILTER (D_creds_possible = 0) AS n_zero_attempted, count(*) FILTER (D_creds_possible > 0) AS n_credit_bearing,
    count(*) FILTER (D_creds_possible > 0 AND D_creds_earn = 0) AS n_zero_earned FROM tr GROUP BY 1)""")
def _(t):
    return A.credit_rates(clean_tr(t))


@query("a03_excess_by_course", "tr", """
SELECT D_course_id, D_course_name, count(*) AS n_rows, count(*) FILTER (D_creds_earn = 1) AS n_full, round_even(100e0 * count(*) FILTER (D_creds_earn = 1) / count(*), 1) AS pct_full
FROM tr WHERE D_creds_possible = 0.5 GROUP BY 1, 2 HAVING count(*) FILTER (D_creds_earn = 1) > 0""")
def _(t):
    return A.excess_by_course(clean_tr(t))


@query("a04_quantiles", "tr", """
SELECT D_year, quantile_cont(creds_earned, 0.1) AS p10, quantile_cont(creds_earned, 0.25) AS p25, quantile_cont(creds_earned, 0.5) AS p50, quantile_cont(creds_earned, 0.75) AS p75, quantile_cont(creds_earned, 0.9) AS p90
FROM (SELECT D_stu_id, D_year, coalesce(sum(D_creds_earn), 0) AS creds_earned FROM tr GROUP BY 1, 2) GROUP BY 1""")
def _(t):
    d = A.quantiles(A.student_year_load(clean_tr(t)), ["D_year"], "creds_earned")
    return d.select("D_year", *[F.bround(c, 6).alias(c) for c in d.columns if c != "D_year"])


@query("a04_tail_summary", "tr_raw", """
SELECT count(*) AS n_rows, max(g) AS max_value, round_even(quantile_cont(g, 0.99), 2) AS p99, round_even(quantile_cont(g, 0.999), 2) AS p999, count(*) FILTER (g > 100) AS n_above_100, count(*) FILTER (g > 110) AS n_above_110
FROM (SELECT D_stu_grade AS g FROM tr_raw WHERE D_stu_grade IS NOT NULL)""")
def _(t):
    return A.tail_summary(V.tr_raw(t), "D_stu_grade", [100, 110])


@query("a05_student_year_load", "tr", """
SELECT D_stu_id, D_year, count(*) AS courses, count(*) FILTER (D_creds_possible > 0) AS courses_credit_bearing, coalesce(sum(D_creds_possible), 0) AS creds_attempted, coalesce(sum(D_creds_earn), 0) AS creds_earned,
  count(*) FILTER (D_creds_possible > 0 AND D_creds_earn = 0) AS n_failed FROM tr GROUP BY 1, 2""")
def _(t):
    return A.student_year_load(clean_tr(t))


@query("a05_load_by_year", "tr", """
SELECT D_year, count(*) AS students, median(courses) AS median_courses, median(b) AS median_courses_credit_bearing, median(p) AS median_creds_attempted, median(e) AS median_creds_earned, median(f) AS median_n_failed,
  round_even(avg(f), 2) AS mean_failed, round_even(100e0 * count(*) FILTER (e >= p) / count(*), 1) AS pct_earning_all FROM (
  SELECT D_stu_id, D_year, count(*) AS courses, count(*) FILTER (D_creds_possible > 0) AS b, coalesce(sum(D_creds_possible), 0) AS p, coalesce(sum(D_creds_earn), 0) AS e,
    count(*) FILTER (D_creds_possible > 0 AND D_creds_earn = 0) AS f FROM tr GROUP BY 1, 2) GROUP BY 1""")
def _(t):
    return A.load_by_year(A.student_year_load(clean_tr(t)))


@query("a06_orphan_weight", "tr sp", """
SELECT D_year, sum(n)::BIGINT AS n_rows, count(*) AS students, median(n) AS median_courses, round_even(sum(c), 1) AS creds_earned FROM (
  SELECT D_year, D_stu_id, count(*) AS n, coalesce(sum(D_creds_earn), 0) AS c FROM tr ANTI JOIN sp USING (D_stu_id, D_year) GROUP BY 1, 2) GROUP BY 1""")
def _(t):
    return A.orphan_weight(J.anti(read_tr(t), read_sp(t).select("D_stu_id", "D_year").distinct(), ["D_stu_id", "D_year"]))


@query("a10_joined_values", "cs", "SELECT D_employee_id, string_agg(DISTINCT C_course_subject, ' | ' ORDER BY C_course_subject) AS subjects FROM cs GROUP BY 1")
def _(t):
    from ..functions.nullsafe import joined_values
    return V.cs(t).groupBy("D_employee_id").agg(joined_values("C_course_subject", " | ").alias("subjects"))


@query("a11_pivot_counts", "cs", """SELECT D_location_name, count(*) FILTER (D_rotation = 'A') AS "A", count(*) FILTER (D_rotation = 'B') AS "B", count(*) FILTER (D_rotation = 'A-B') AS "A-B" FROM cs GROUP BY 1""")
def _(t):
    return A.pivot_counts(V.cs(t), ["D_location_name"], "D_rotation", ["A", "B", "A-B"])


@query("a13_column_totals", "tr_raw tr", """
SELECT 'before' AS step, sum(D_creds_earn) AS D_creds_earn, sum(D_creds_possible) AS D_creds_possible FROM tr_raw UNION ALL SELECT 'after', sum(D_creds_earn), sum(D_creds_possible) FROM tr""")
def _(t):
    c = ["D_creds_earn", "D_creds_possible"]
    return A.column_totals(V.tr_raw(t), c, "before").unionByName(A.column_totals(clean_tr(t), c, "after"))


@query("a14_term_marker_pairs", "tr", """
SELECT markers, count(*) AS n_student_course_years, round_even(100e0 * count(*) / sum(count(*)) OVER (), 1) AS pct FROM (
  SELECT D_stu_id, D_year, C_course_id_base, string_agg(DISTINCT D_course_id[-2:], '+' ORDER BY D_course_id[-2:]) AS markers FROM tr WHERE regexp_matches(D_course_id, 'D[AB]$') GROUP BY 1, 2, 3) GROUP BY 1""")
def _(t):
    return A.term_marker_pairs(clean_tr(t), r"D[AB]\*?\s*$", "D[AB]")


@query("a14_marker_by_term", "tr", """
SELECT D_course_id[-2:] AS marker, C_term, count(*) AS n_rows, round_even(100e0 * count(*) / sum(count(*)) OVER (PARTITION BY D_course_id[-2:]), 1) AS pct FROM tr WHERE regexp_matches(D_course_id, '(D[AB]|S[12])$') GROUP BY 1, 2""")
def _(t):
    return A.marker_by_term(clean_tr(t), "(D[AB]|S[12])$", "(D[AB]|S[12])$")


@query("a15_starred_profile", "tr", """
SELECT C_course_name_starred, count(*) AS n_rows, round_even(100e0 * count(*) FILTER (C_term = 'Semester 2') / count(C_term), 1) AS pct_second_term, round_even(100e0 * count(*) FILTER (D_creds_earn = 0) / count(D_creds_earn), 1) AS pct_zero_earned,
  median(D_stu_grade) AS median_grade, round_even(100e0 * count(*) FILTER (C_creds_earn_exceeds_attempted) / count(*), 1) AS pct_excess FROM tr GROUP BY 1""")
def _(t):
    return A.starred_profile(clean_tr(t))


@query("a15_starred_variants", "tr", """
SELECT n_variants, count(*) AS n_courses FROM (SELECT count(DISTINCT C_course_name_starred) AS n_variants FROM tr GROUP BY D_course_id, trim(replace(D_course_name, '*', ''))) GROUP BY 1""")
def _(t):
    return A.starred_variants(clean_tr(t))


@query("a17_slots_without_standard", "cs", """
SELECT D_location_name, D_term, D_period, D_rotation, count(*) AS n_records FROM cs GROUP BY 1, 2, 3, 4 HAVING count(*) FILTER (C_course_format = 'Standard') = 0""")
def _(t):
    return A.slots_without(V.cs(t), ["D_location_name", "D_term", "D_period", "D_rotation"])


@query("a17_narrow_slots", "cs", """
SELECT D_location_name, D_term, D_period, C_course_subject, D_course_name, n_records, n_courses FROM (
  SELECT D_location_name, D_term, D_period, C_course_subject, D_course_name, count(*) AS n_records FROM cs WHERE C_course_subject_area NOT IN ('Core', 'Non-Core') GROUP BY ALL)
JOIN (SELECT D_location_name, D_term, D_period, count(DISTINCT D_course_name) AS n_courses FROM cs GROUP BY ALL) USING (D_location_name, D_term, D_period) WHERE n_courses <= 5""")
def _(t):
    return A.narrow_slots(V.cs(t), ["D_location_name", "D_term", "D_period"])


@query("a18_records_by_school", "csx", """
SELECT a.*, avg_records_per_student FROM (SELECT D_location_name, count(DISTINCT D_stu_id) AS n_students, count(DISTINCT D_employee_id) + max((D_employee_id IS NULL)::INT)::BIGINT AS n_teachers,
  string_agg(DISTINCT D_term, ', ' ORDER BY D_term) AS terms, count(DISTINCT (D_period, D_rotation)) AS n_time_slots FROM csx WHERE C_course_time_exclude = 'Include' GROUP BY 1) a
JOIN (SELECT D_location_name, round_even(sum(n) / count(*), 1) AS avg_records_per_student FROM (SELECT D_location_name, D_stu_id, count(*) AS n FROM csx WHERE C_course_time_exclude = 'Include' GROUP BY 1, 2) GROUP BY 1) USING (D_location_name)""")
def _(t):
    return A.records_by_school(V.csx(t).filter("C_course_time_exclude = 'Include'"), ["D_period", "D_rotation"])


@query("a20_uncoded_share", "cs", """
SELECT count(*) AS n_rows, count(*) FILTER (a = 'UNCODED') AS n_uncoded, round_even(100e0 * count(*) FILTER (a = 'UNCODED') / count(a), 1) AS pct_uncoded FROM (SELECT CASE C_course_subject_area WHEN 'Untracked' THEN 'UNCODED' WHEN 'Un-prepped' THEN NULL ELSE C_course_subject_area END AS a FROM cs)""")
def _(t):
    a = F.when(F.col("C_course_subject_area") == "Untracked", "UNCODED").when(F.col("C_course_subject_area") != "Un-prepped", F.col("C_course_subject_area"))
    return A.uncoded_share(V.cs(t).withColumn("C_course_subject_area", a))


@query("a20_subject_distribution", "cs", "SELECT C_course_subject_area, C_course_subject, count(*) AS n_rows, round_even(100e0 * count(*) / sum(count(*)) OVER (), 1) AS pct FROM cs GROUP BY 1, 2")
def _(t):
    return A.share_counts(V.cs(t), ["C_course_subject_area", "C_course_subject"])


@query("a21_coding_coverage", "coded", "SELECT D_year, count(*) AS n_rows, round_even(100e0 * count(C_course_subject_area) / count(*), 3) AS pct_coded FROM coded GROUP BY 1")
def _(t):
    return A.coding_coverage(J.code_courses(clean_tr(t), V.coding(t)), ["D_year"])


@query("a21_flag_rates", "coded", """
SELECT D_year, count(*) AS n_rows, round_even(100e0 * count(*) FILTER (C_course_epso_flag = 1) / count(C_course_epso_flag), 2) AS pct_epso, round_even(100e0 * count(*) FILTER (C_course_ic_flag = 1) / count(C_course_ic_flag), 2) AS pct_ic
FROM coded WHERE C_course_subject_area IS NOT NULL GROUP BY 1""")
def _(t):
    d = J.code_courses(clean_tr(t), V.coding(t)).filter("C_course_subject_area is not null")
    return A.flag_rates(d, ["D_year"], {"epso": "C_course_epso_flag", "ic": "C_course_ic_flag"})


@query("a21_subject_totals", "coded", """
SELECT C_course_subject_area, count(*) AS n_rows, count(DISTINCT D_stu_id) AS students, round_even(sum(D_creds_earn), 0) AS creds_earned FROM coded WHERE C_course_subject_area IS NOT NULL GROUP BY 1""")
def _(t):
    return A.subject_totals(J.code_courses(clean_tr(t), V.coding(t)))


@query("a22_completeness", "tr sp coded", """
SELECT * FROM (WITH n AS (SELECT count(*) AS n, count(DISTINCT D_stu_id) AS s, count(DISTINCT D_year) AS y, round_even(100e0 * count(C_course_subject_area) / count(*), 2) AS c, round_even(100e0 * count(D_stu_grade) / count(*), 2) AS g FROM coded)
SELECT unnest(['rows', 'students', 'years', '% coded', '% graded']) AS measure, unnest([n, s, y, c, g]::DOUBLE[]) AS value FROM n)""")
def _(t):
    d = J.code_courses(clean_tr(t), V.coding(t))
    return A.completeness(d, checks={"% coded": F.col("C_course_subject_area").isNotNull(), "% graded": F.col("D_stu_grade").isNotNull()})


@query("a22_export_by_year", "tr", """
SELECT D_year, count(*) AS n_rows, count(DISTINCT D_stu_id) AS students, round_even(sum(D_creds_earn), 0) AS creds_earned, round_even(count(*) / count(DISTINCT D_stu_id), 1) AS mean_courses FROM tr GROUP BY 1""")
def _(t):
    return A.export_by_year(clean_tr(t))


@query("a24_spells_without_courses", "sp tr", """
SELECT D_year, count(*) AS spells, median(M_days_enrolled) AS median_days, round_even(100e0 * count(*) FILTER (C_school_in_scope) / count(*), 1) AS pct_in_scope, round_even(100e0 * count(*) FILTER (M_days_enrolled >= 200) / count(*), 1) AS pct_full_year
FROM sp ANTI JOIN tr USING (D_stu_id, D_year) GROUP BY 1""")
def _(t):
    return A.spells_without_courses(J.anti(T.clean_spells(V.sp_raw(t), V.TR), read_tr(t), ["D_stu_id", "D_year"]), 200)


@query("a24_spells_by_school", "sp tr", "SELECT C_location_name_canonical, C_school_in_scope, count(*) AS n_rows FROM sp ANTI JOIN tr USING (D_stu_id, D_year) GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2 LIMIT 20")
def _(t):
    from ..operators.ordered import top_counts
    return top_counts(J.anti(clean_sp(t), clean_tr(t), ["D_stu_id", "D_year"]), ["C_location_name_canonical", "C_school_in_scope"], 20)
