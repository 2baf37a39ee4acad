"""Sources, checks, profiling, scope, scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates, ranges, school, text
from ..functions.nullsafe import flag, join_same, matches
from ..operators import checks as Q
from ..operators import joins as J
from ..operators import profile as P
from ..operators import scope as S
from ..plans import transcript as T
from ..sources import tables as IO
from . import views as V
from .registry import query

_RES = "CASE WHEN n_offenders = 0 THEN 'PASS' ELSE 'FAIL' END AS result, n_offenders"


def clean_tr(t):
    return t.stored("tr", lambda: T.clean_transcript(V.tr_raw(t), V.TR))


def clean_sp(t):
    return t.stored("sp", lambda: T.clean_spells(V.sp_raw(t), V.TR))


def read_tr(t):
    """For queries that read few columns of the transcript once: not stored, so only those are made."""
    return T.clean_transcript(V.tr_raw(t), V.TR)


def read_sp(t):
    """The same for the spells; what is derived of locations is only made where it is used."""
    raw = V.sp_raw(t)
    return T.clean_spells(raw, V.TR, T.location_table(raw, V.TR))


# --- sources ---

@query("s01_read_source", "", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def _(t):
    sources = {"orders": {"path": f"{t.path}/orders.parquet"}, "staff": None}
    assert IO.read_source(t.spark, sources, "staff") is None
    return IO.read_source(t.spark, sources, "orders").select("o_orderkey", "o_custkey", "o_totalprice")


@query("s02_normalise_headers", "", "SELECT c_custkey AS customer_key, c_name AS full_name, c_mktsegment AS mkt_segment FROM customer")
def _(t):
    return IO.normalise_headers(t.customer.select(F.col("c_custkey").alias("Customer Key"), F.col("c_name").alias("fullName"), F.col("c_mktsegment").alias("Mkt-Segment")))


@query("s03_rename_project_distinct", "", "SELECT DISTINCT l_suppkey AS D_employee_id, l_linenumber AS D_period, l_returnflag AS D_rotation FROM lineitem")
def _(t):
    return IO.rename_to_standard(t.lineitem, {"D_employee_id": "l_suppkey", "D_period": "l_linenumber", "D_rotation": "l_returnflag", "D_room": "absent"}, keep_only=True)


@query("s04_required_input", "tr_raw", f"SELECT 'transcript has rows' AS \"check\", {_RES} FROM (SELECT (count(*) < 10)::BIGINT AS n_offenders FROM tr_raw)")
def _(t):
    d = IO.require_input(V.tr_raw(t), "transcript", 10)
    return IO.row_floor(d, "transcript has rows", 10).result()


@query("s07_coding_template", "cs", "SELECT DISTINCT D_course_name, D_course_id, 'UNCODED' AS C_course_subject, 'UNCODED' AS C_course_rigor FROM cs")
def _(t):
    return IO.coding_template(V.cs(t), ["D_course_name", "D_course_id"], ["C_course_subject", "C_course_rigor"])


@query("f10_prefix_order_f11_ensure_columns", "coding", "SELECT D_course_id, D_course_name, C_course_id, NULL::VARCHAR AS C_course_pathway, NULL::DOUBLE AS M_hours FROM coding")
def _(t):
    d = V.coding(t).select("C_course_id", "D_course_name", "D_course_id")
    return IO.prefix_order(IO.ensure_columns(d, {"M_hours": "double", "C_course_pathway": "string"}))


# --- checks ---

@query("q01_q02_row_gates", "tr", f"""
SELECT "check", {_RES} FROM (SELECT 'credits known' AS "check", count(*) FILTER (NOT coalesce(D_creds_earn IS NOT NULL, false)) AS n_offenders FROM tr
UNION ALL SELECT 'earned within attempted', count(*) FILTER (NOT coalesce(D_creds_earn <= D_creds_possible, false)) FROM tr
UNION ALL SELECT 'year in range', count(*) FILTER (NOT coalesce(D_year BETWEEN 1995 AND 2002, false)) FROM tr)""")
def _(t):
    return Q.gates(clean_tr(t), {"credits known": F.col("D_creds_earn").isNotNull(), "earned within attempted": F.col("D_creds_earn") <= F.col("D_creds_possible"),
                                 "year in range": F.col("D_year").between(1995, 2002)})


@query("q03_unique_keys", "sp", """
SELECT D_stu_id, D_year, D_location_id, D_stu_enter_date, count(*) AS n_rows FROM sp GROUP BY 1, 2, 3, 4 HAVING count(*) > 1""")
def _(t):
    return Q.unique(clean_sp(t), ["D_stu_id", "D_year", "D_location_id", "D_stu_enter_date"]).offenders


@query("q03_unique_result", "tr", f"""SELECT 'one row per student, year, course' AS "check", {_RES} FROM (
SELECT count(*) AS n_offenders FROM (SELECT 1 FROM tr GROUP BY D_stu_id, D_year, D_course_id HAVING count(*) > 1))""")
def _(t):
    return Q.unique(clean_tr(t), ["D_stu_id", "D_year", "D_course_id"], "one row per student, year, course").result()


@query("q04_no_nulls", "tr_raw", f"""SELECT 'grade and course known' AS "check", {_RES} FROM (SELECT count(*) FILTER (D_stu_grade IS NULL OR D_course_id IS NULL) AS n_offenders FROM tr_raw)""")
def _(t):
    return Q.no_nulls(V.tr_raw(t), ["D_stu_grade", "D_course_id"], "grade and course known").result()


@query("q05_rows_stable", "tr_raw tr", f"""SELECT 'scope keeps every row' AS "check", {_RES} FROM (SELECT ((SELECT count(*) FROM tr_raw) <> (SELECT count(*) FROM tr))::BIGINT AS n_offenders)""")
def _(t):
    return Q.rows_stable(V.tr_raw(t), clean_tr(t), "scope keeps every row").result()


@query("q06_ids_stable", "sy crow", """
SELECT D_stu_id, 'lost' AS direction FROM (SELECT DISTINCT D_stu_id FROM sy EXCEPT SELECT D_stu_id FROM crow)
UNION ALL SELECT D_stu_id, 'gained' FROM (SELECT DISTINCT D_stu_id FROM crow EXCEPT SELECT D_stu_id FROM sy)""")
def _(t):
    from .q_cohort import crow, student_year
    sy = student_year(t)
    return Q.ids_stable(sy, crow(sy), "D_stu_id").offenders


@query("q07_values_in", "cs", "SELECT D_period, count(*) AS n_rows FROM cs WHERE D_period NOT IN ('1', '2', '3') GROUP BY 1")
def _(t):
    return Q.values_in(V.cs(t), "D_period", ["1", "2", "3"]).offenders


@query("q08_n_distinct", "cs", "SELECT count(DISTINCT D_employee_id) + max((D_employee_id IS NULL)::INT)::BIGINT AS n_distinct FROM cs")
def _(t):
    return Q.distinct_values(V.cs(t), "D_employee_id")


@query("q09_badge_result", "", """
SELECT o_orderstatus, CASE o_orderstatus WHEN 'P' THEN 'PASS' WHEN 'F' THEN 'FAIL' ELSE 'REVIEW' END AS result, count(*) AS n FROM orders GROUP BY ALL""")
def _(t):
    badge = F.when(F.col("o_orderstatus") == "P", "PASS").when(F.col("o_orderstatus") == "F", "FAIL").otherwise("CHECK")
    return t.orders.withColumn("result", Q.badge_result(badge)).groupBy("o_orderstatus", "result").agg(F.count(F.lit(1)).alias("n"))


@query("q10_log_summary", "tr", """
SELECT 'stop' AS severity, result, count(*) AS n_checks FROM (SELECT CASE WHEN count(*) FILTER (D_creds_earn IS NULL) = 0 THEN 'PASS' ELSE 'FAIL' END AS result FROM tr
UNION ALL SELECT CASE WHEN count(*) FILTER (D_year IS NULL) = 0 THEN 'PASS' ELSE 'FAIL' END FROM tr) GROUP BY 2""")
def _(t):
    r = Q.gates(clean_tr(t), {"credits": F.col("D_creds_earn").isNotNull(), "year": F.col("D_year").isNotNull()})
    return Q.log_summary(r.withColumn("severity", F.lit("stop")))


# --- profiling ---

@query("q11_profile_columns", "tr_raw", r"""
SELECT c AS "column", ty AS type, count(DISTINCT v) AS n_distinct, count(*) FILTER (v IS NULL) AS n_missing, round_even(100e0 * count(*) FILTER (v IS NULL) / count(*), 1) AS pct_missing,
  CASE WHEN count(*) FILTER (v IS NOT NULL AND try_cast(v AS DOUBLE) IS NULL) = 0 THEN min(try_cast(v AS DOUBLE))::VARCHAR END AS "min",
  CASE WHEN count(*) FILTER (v IS NOT NULL AND try_cast(v AS DOUBLE) IS NULL) = 0 THEN max(try_cast(v AS DOUBLE))::VARCHAR END AS "max",
  CASE WHEN count(DISTINCT v) <= 12 THEN string_agg(DISTINCT v, ', ' ORDER BY v) ELSE array_to_string(list_slice(list_sort(list(DISTINCT v)), 1, 6), ', ') || ', ...' END AS "values"
FROM (""" + " UNION ALL ".join(f"SELECT '{c}' AS c, '{ty}' AS ty, " + (f"CASE WHEN trim({c}) IN ('', 'NA', 'MISSING', 'NULL') THEN NULL ELSE {c} END" if ty == "string" else f"{c}::VARCHAR") + " AS v FROM tr_raw" for c, ty in {
    "D_stu_id": "bigint", "D_year": "int", "D_course_id": "string", "D_course_name": "string", "D_stu_grade_level_transcript": "int", "D_stu_grade": "double", "D_creds_earn": "double", "D_creds_possible": "double"}.items()) + ") GROUP BY 1, 2")
def _(t):
    return P.profile_columns(V.tr_raw(t))


@query("q12_value_counts", "cs", "SELECT D_employee_id, count(*) AS n FROM cs GROUP BY 1 ORDER BY 1 NULLS LAST LIMIT 25")
def _(t):
    return P.value_counts(V.cs(t), "D_employee_id", 25)


@query("q13_duplicate_rows", "sp_raw", "SELECT count(*) AS n_rows, (SELECT count(*) FROM (SELECT DISTINCT * FROM sp_raw)) AS n_distinct_rows, count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM sp_raw)) AS n_copies FROM sp_raw")
def _(t):
    return P.duplicate_rows(V.sp_raw(t))


@query("q14_grain_histogram", "cs", "SELECT size, count(*) AS n_keys FROM (SELECT count(*) AS size FROM cs GROUP BY D_stu_id, D_term, D_period) GROUP BY 1")
def _(t):
    return P.grain_histogram(V.cs(t), ["D_stu_id", "D_term", "D_period"])


@query("q14_names_per_course", "tr", "SELECT size, count(*) AS n_keys FROM (SELECT count(DISTINCT D_course_name) AS size FROM tr GROUP BY D_course_id) GROUP BY 1")
def _(t):
    return P.grain_histogram(clean_tr(t), ["D_course_id"], per="D_course_name")


@query("q15_id_overlap", "tr sp", """
SELECT count(*) FILTER (l AND r) AS n_both, count(*) FILTER (NOT r) AS n_left_only, count(*) FILTER (NOT l) AS n_right_only, max(CASE WHEN l THEN length(k) END)::INT AS left_width,
  max(CASE WHEN r THEN length(k) END)::INT AS right_width FROM (SELECT D_stu_id || '' || D_year AS k, bool_or(s = 'l') AS l, bool_or(s = 'r') AS r
  FROM (SELECT D_stu_id, D_year, 'l' AS s FROM tr UNION ALL SELECT D_stu_id, D_year, 'r' FROM sp) GROUP BY D_stu_id, D_year)""")
def _(t):
    return P.id_overlap(clean_tr(t), clean_sp(t), ["D_stu_id", "D_year"])


@query("q16_string_shape", "tr", r"""
SELECT CASE WHEN regexp_matches(D_course_id, 'S1$') THEN 'first' WHEN regexp_matches(D_course_id, 'S2$') THEN 'second' ELSE 'none' END AS suffix, right(D_course_id, 2) AS last_two,
  length(D_course_id)::INT AS n_chars, count(*) AS n_rows FROM tr GROUP BY ALL""")
def _(t):
    return P.string_shape(clean_tr(t), "D_course_id", {"first": "S1$", "second": "S2$"})


@query("q17_fill_rates", "cs", """
SELECT 'D_employee_id' AS field, true AS present, round_even(100e0 * count(D_employee_id) / count(*), 1) AS pct_filled FROM cs
UNION ALL SELECT 'D_active_flag', true, round_even(100e0 * count(D_active_flag) / count(*), 1) FROM cs UNION ALL SELECT 'D_room', false, NULL""")
def _(t):
    return P.fill_rates(V.cs(t), ["D_employee_id", "D_active_flag", "D_room"])


@query("q18_staff_coverage", "cs", """
SELECT D_stu_grade, count(DISTINCT D_employee_id) AS teachers_in_schedule, count(DISTINCT D_employee_id) FILTER (s_acctbal > 0) AS teachers_with_hr,
  round_even(100e0 * count(DISTINCT D_employee_id) FILTER (s_acctbal > 0) / count(DISTINCT D_employee_id), 1) AS pct_coverage
FROM cs JOIN supplier ON D_employee_id = s_suppkey GROUP BY 1""")
def _(t):
    return P.staff_coverage(V.cs(t), t.supplier.filter("s_acctbal > 0").withColumnRenamed("s_suppkey", "D_employee_id"))


@query("q18_grade_coverage", "cs grades", """
SELECT s.D_stu_grade, C_course_subject, count(DISTINCT s.D_stu_id) AS students_in_schedule, count(DISTINCT g.D_stu_id) AS students_with_grade,
  round_even(100e0 * count(DISTINCT g.D_stu_id) / count(DISTINCT s.D_stu_id), 1) AS pct_coverage
FROM (SELECT DISTINCT D_stu_id, D_stu_grade FROM cs) s CROSS JOIN (VALUES ('English'), ('Math'), ('Science'), ('Social Studies')) v(C_course_subject)
LEFT JOIN (SELECT DISTINCT D_stu_id, D_course_subject FROM grades) g ON g.D_stu_id = s.D_stu_id AND g.D_course_subject = C_course_subject GROUP BY 1, 2""")
def _(t):
    g = V.grades(t).withColumnRenamed("D_course_subject", "C_course_subject")
    return P.grade_coverage(V.cs(t), g, ["English", "Math", "Science", "Social Studies"])


@query("q18_repeated_grades", "grades", """
SELECT sum(n)::BIGINT AS n_rows, count(*) AS n_pairs, count(*) FILTER (n > 1) AS n_repeated FROM (SELECT count(*) AS n FROM grades GROUP BY D_stu_id, D_course_subject)""")
def _(t):
    return P.repeated_pairs(V.grades(t).withColumnRenamed("D_course_subject", "C_course_subject"))


@query("q19_trace", "sp", "SELECT D_stu_id, D_year, C_location_name_canonical, M_days_enrolled FROM sp WHERE D_stu_id IN (3, 17, 41)")
def _(t):
    d = clean_sp(t)
    return P.trace_rows(d, P.trace_ids(d, "D_stu_id", [3, 17, 41]), "D_stu_id", ["D_stu_id", "D_year", "C_location_name_canonical", "M_days_enrolled", "absent"], ["D_stu_id", "D_year"])


@query("q20_pct_true", "cs", "SELECT round_even(100e0 * count(*) FILTER (coalesce(D_active_flag = 1, false)) / count(*), 1) AS pct_true FROM cs")
def _(t):
    return P.pct_true(V.cs(t), "D_active_flag")


@query("o03_sample_rows", "cs", "SELECT D_stu_id, D_course_id, D_term FROM cs ORDER BY md5(D_stu_id::VARCHAR || ':7'), D_stu_id, D_course_id, D_term LIMIT 10")
def _(t):
    return P.sample_rows(V.cs(t).select("D_stu_id", "D_course_id", "D_term"), "D_stu_id", 10, seed=7)


# --- scope ---

_SCOPE = (["D_course_id", "D_creds_earn"], ["D_stu_grade >= 10 OR D_stu_grade IS NULL", "D_year > 1995"])


@query("f01_f02_scope_report", "tr_raw", """
WITH s AS (SELECT *, D_course_id IS NOT NULL AND trim(D_course_id) <> '' AS a, D_creds_earn IS NOT NULL AS b, coalesce(D_stu_grade >= 10 OR D_stu_grade IS NULL, false) AS c, D_year > 1995 AS d FROM tr_raw),
n AS (SELECT count(*) AS n0, count(*) FILTER (a) AS n1, count(*) FILTER (a AND b) AS n2, count(*) FILTER (a AND b AND c) AS n3, count(*) FILTER (a AND b AND c AND d) AS n4,
  count(DISTINCT D_stu_id) AS i0, count(DISTINCT D_stu_id) FILTER (a AND b AND c AND d) AS i1, coalesce(sum(D_creds_earn), 0) AS s0, coalesce(sum(D_creds_earn) FILTER (a AND b AND c AND d), 0) AS s1 FROM s),
r AS (SELECT unnest(['present D_course_id', 'present D_creds_earn', 'filter D_stu_grade >= 10 OR D_stu_grade IS NULL', 'filter D_year > 1995', 'rows', 'ids D_stu_id', 'sum D_creds_earn']) AS item,
  unnest([n0, n1, n2, n3, n0, i0, s0]::DOUBLE[]) AS "before", unnest([n1, n2, n3, n4, n4, i1, s1]::DOUBLE[]) AS "after" FROM n)
SELECT *, "before" - "after" AS removed FROM r""".replace("WITH s AS", "SELECT * FROM (WITH s AS").replace('AS removed FROM r', 'AS removed FROM r)'))
def _(t):
    return S.scope_report(V.tr_raw(t), *_SCOPE, id_col="D_stu_id", sum_cols=["D_creds_earn"])


@query("f01_apply_scope", "tr_raw", "SELECT D_stu_id, D_year, D_course_id FROM tr_raw WHERE trim(D_course_id) <> '' AND D_creds_earn IS NOT NULL AND (D_stu_grade >= 10 OR D_stu_grade IS NULL) AND D_year > 1995")
def _(t):
    return S.apply_scope(V.tr_raw(t), *_SCOPE).select("D_stu_id", "D_year", "D_course_id")


@query("f03_exclusions", "csx", """
SELECT C_course_subject_area, C_course_format, C_course_time_of_day, C_course_time_exclude, C_class_size_and_teacher_load_exclude, count(*) AS n FROM csx GROUP BY ALL""")
def _(t):
    return V.csx(t).groupBy("C_course_subject_area", "C_course_format", "C_course_time_of_day", "C_course_time_exclude", "C_class_size_and_teacher_load_exclude").agg(F.count(F.lit(1)).alias("n"))


@query("f04_exclusion_rates", "csx", """
SELECT 'C_course_time_exclude' AS metric, count(*) FILTER (C_course_time_exclude = 'Exclude') AS n_excluded, count(*) AS n_rows, round_even(100e0 * count(*) FILTER (C_course_time_exclude = 'Exclude') / count(*), 1) AS pct_excluded FROM csx
UNION ALL SELECT 'C_class_size_and_teacher_load_exclude', count(*) FILTER (C_class_size_and_teacher_load_exclude = 'Exclude'), count(*), round_even(100e0 * count(*) FILTER (C_class_size_and_teacher_load_exclude = 'Exclude') / count(*), 1) FROM csx""")
def _(t):
    return S.exclusion_rates(V.csx(t), list(V.EXCLUSIONS))


@query("f04_excluded_courses", "csx", """
SELECT C_course_subject, D_course_name, C_course_time_exclude, C_class_size_and_teacher_load_exclude, count(*) AS n_records FROM csx
WHERE C_course_time_exclude = 'Exclude' OR C_class_size_and_teacher_load_exclude = 'Exclude' GROUP BY ALL""")
def _(t):
    return S.excluded_courses(V.csx(t), list(V.EXCLUSIONS))


@query("f05_snapshot_flag", "cs", """
SELECT D_term, C_stu_snapshot, count(*) AS n FROM (SELECT D_term, CASE WHEN coalesce(D_stu_enter_date <= day AND D_stu_exit_date >= day, false) THEN 'Include' ELSE 'Exclude' END AS C_stu_snapshot
FROM cs LEFT JOIN (VALUES ('1996S1', DATE '1996-10-01'), ('1997S2', DATE '1997-03-15'), ('1998FY', DATE '1998-05-20')) v(term, day) ON D_term = term) GROUP BY ALL""")
def _(t):
    d = S.snapshot_flag(V.cs(t), {"1996S1": "1996-10-01", "1997S2": "1997-03-15", "1998FY": "1998-05-20"})
    return d.groupBy("D_term", "C_stu_snapshot").agg(F.count(F.lit(1)).alias("n"))


@query("f06_f07_fill_and_constants", "cs", "SELECT D_active_flag, 'A' AS D_day, count(*) AS n FROM (SELECT coalesce(D_active_flag, 0) AS D_active_flag FROM cs) GROUP BY ALL")
def _(t):
    d = S.add_constants(S.fill_zero(V.cs(t), ["D_active_flag", "absent"]), {"D_day": "A"})
    return d.groupBy("D_active_flag", "D_day").agg(F.count(F.lit(1)).alias("n"))


@query("f06_null_counts", "cs", """SELECT 'D_active_flag' AS "column", count(*) FILTER (D_active_flag IS NULL) AS n_filled FROM cs UNION ALL SELECT 'D_employee_id', count(*) FILTER (D_employee_id IS NULL) FROM cs""")
def _(t):
    return S.null_counts(V.cs(t), ["D_active_flag", "D_employee_id"])


@query("f08_unmapped_codes", "sp_raw", "SELECT D_stu_race, count(*) AS n_rows FROM sp_raw WHERE D_stu_race NOT IN ('A', 'B', 'F') GROUP BY 1")
def _(t):
    return S.unmapped(V.sp_raw(t), "D_stu_race", {"A": "x", "B": "y", "F": "z"}).offenders


@query("f09_loose_recode", "sp_raw", "SELECT D_stu_race, CASE D_stu_race WHEN 'A' THEN 'one' WHEN 'B' THEN 'two' END AS C_race, count(*) AS n FROM sp_raw GROUP BY ALL")
def _(t):
    return S.recode(V.sp_raw(t), "D_stu_race", {"A": "one", "B": "two"}, "C_race").groupBy("D_stu_race", "C_race").agg(F.count(F.lit(1)).alias("n"))


@query("f12_f13_export_rows", "tr coh snap", """
SELECT D_year, count(*) AS n_rows, count(DISTINCT D_stu_id) AS students FROM tr WHERE (D_stu_id IN (SELECT D_stu_id FROM coh)
  OR (D_stu_id IN (SELECT D_stu_id FROM snap WHERE selected) AND D_year = 1998)) AND D_year BETWEEN 1996 AND 1999 GROUP BY 1""")
def _(t):
    from .q_cohort import built
    b = built(t)
    d = S.export_rows(b["transcript_out"], "cohort_or_snapshot", years=V.TR.years)
    return d.groupBy("D_year").agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("D_stu_id").alias("students"))


@query("f13_member_flag", "tr sp", """
SELECT C_has_enrolment_record, count(*) AS n FROM (SELECT EXISTS (SELECT 1 FROM sp WHERE sp.D_stu_id = tr.D_stu_id AND sp.D_year = tr.D_year) AS C_has_enrolment_record FROM tr) GROUP BY 1""")
def _(t):
    return S.member_flag(clean_tr(t), clean_sp(t), ["D_stu_id", "D_year"], "C_has_enrolment_record").groupBy("C_has_enrolment_record").agg(F.count(F.lit(1)).alias("n"))


@query("f14_location_flags", "sp", "SELECT C_school_in_scope, contains(D_location_name, ' CR ') AS recovery_site, count(*) AS n FROM sp GROUP BY ALL")
def _(t):
    d = clean_sp(t).withColumn("recovery_site", matches("D_location_name", " CR "))
    return d.groupBy("C_school_in_scope", "recovery_site").agg(F.count(F.lit(1)).alias("n"))


# --- scalars ---

@query("x01_x04_spell_dates", "sp", """
SELECT D_stu_id, D_year, D_location_id, D_stu_enter_date, D_stu_exit_date, C_exit_date_imputed, C_spell_before_window, C_spell_after_window, H_enter_clamped, H_exit_clamped, M_days_enrolled FROM sp""")
def _(t):
    return clean_sp(t).select("D_stu_id", "D_year", "D_location_id", "D_stu_enter_date", "D_stu_exit_date", "C_exit_date_imputed", "C_spell_before_window", "C_spell_after_window",
                              "H_enter_clamped", "H_exit_clamped", "M_days_enrolled")


@query("x01_unreadable_dates", "sp_raw", "SELECT D_stu_enter_date, count(*) AS n FROM sp_raw WHERE D_stu_enter_date NOT LIKE '1/%' GROUP BY 1")
def _(t):
    d = V.sp_raw(t).withColumn("as_given", F.when(F.col("D_stu_enter_date").startswith("1/"), F.col("D_stu_enter_date")).otherwise(F.concat(F.lit("on "), "D_stu_enter_date")))
    return d.filter(dates.date_unreadable("as_given", ["M/d/yyyy", "yyyy-MM-dd"])).groupBy("D_stu_enter_date").agg(F.count(F.lit(1)).alias("n"))


@query("x04_negative_days_dropped", "sp_days", "SELECT D_year, count(*) AS n, sum(days_raw)::BIGINT AS days FROM sp_days WHERE days_raw >= 0 GROUP BY 1")
def _(t):
    from dataclasses import replace
    return T.clean_spells(V.sp_raw(t), replace(V.TR, negative_days="drop")).groupBy("D_year").agg(F.count(F.lit(1)).alias("n"), F.sum("M_days_enrolled").alias("days"))


@query("x05_location_names", "sp_loc", "SELECT DISTINCT D_location_name, CASE C_location_name WHEN 'NATION_0 CR' THEN 'NATION_0' ELSE C_location_name END AS C_location_name FROM sp_loc")
def _(t):
    return V.sp_raw(t).select("D_location_name").distinct().withColumn(
        "C_location_name", text.clean_location_name("D_location_name", V.TR.strip_prefix, V.TR.strip_suffix, {"NATION_0 CR": "NATION_0"}))


@query("x06_x08_course_text", "tr", r"""
SELECT D_course_id, D_course_name, C_term, C_term_source, C_course_id_base, C_course_name_trimmed, C_course_name_starred, lower(trim(regexp_replace(replace(D_course_name, '*', ''), '\s+', ' ', 'g'))) AS plain, count(*) AS n
FROM tr GROUP BY ALL""")
def _(t):
    c = ["D_course_id", "D_course_name", "C_term", "C_term_source", "C_course_id_base", "C_course_name_trimmed", "C_course_name_starred"]
    return clean_tr(t).groupBy(*c, text.plain_name("D_course_name").alias("plain")).agg(F.count(F.lit(1)).alias("n"))


@query("x09_range_guard", "tr_raw", """
SELECT 'grade within 5 to 105' AS "check", CASE WHEN 100e0 * n <= 20e0 * m THEN 'PASS' ELSE 'FAIL' END AS result, n AS n_offenders, round_even(100e0 * n / m, 3) AS pct
FROM (SELECT count(*) FILTER (D_stu_grade < 5 OR D_stu_grade > 105) AS n, count(*) AS m FROM tr_raw)""")
def _(t):
    return Q.gate_share(V.tr_raw(t), ranges.outside("D_stu_grade", 5, 105), 20, "grade within 5 to 105")


@query("x10_two_tier_range", "tr", """
SELECT C_grade_above_100, C_grade_not_a_grade, C_creds_out_of_range, count(*) AS n, count(D_stu_grade) AS n_known, max(D_stu_grade) AS max_grade, max(D_stu_grade_raw) AS max_raw FROM tr GROUP BY ALL""")
def _(t):
    return clean_tr(t).groupBy("C_grade_above_100", "C_grade_not_a_grade", "C_creds_out_of_range").agg(
        F.count(F.lit(1)).alias("n"), F.count("D_stu_grade").alias("n_known"), F.max("D_stu_grade").alias("max_grade"), F.max("D_stu_grade_raw").alias("max_raw"))


_TAIL = [100, 100.5, 101, 102, 105, 110, 120]


@query("x11_tail_buckets", "tr_raw", """
SELECT CASE WHEN g < 100.5 THEN '[100,100.5)' WHEN g < 101 THEN '[100.5,101)' WHEN g < 102 THEN '[101,102)' WHEN g < 105 THEN '[102,105)' WHEN g < 110 THEN '[105,110)' WHEN g <= 120 THEN '[110,120]' END AS bucket,
  count(*) AS n_rows, round_even(100e0 * count(*) / (SELECT count(*) FROM tr_raw), 3) AS pct_of_all FROM (SELECT D_stu_grade AS g FROM tr_raw WHERE D_stu_grade > 100) GROUP BY 1""")
def _(t):
    d = V.tr_raw(t).groupBy(ranges.tail_bucket("D_stu_grade", _TAIL).alias("bucket"), flag(F.col("D_stu_grade") > 100).alias("tail")).agg(F.count(F.lit(1)).alias("n_rows"))
    from ..functions.nullsafe import pct
    total = d.agg(F.sum("n_rows").alias("t"))
    return d.join(total, F.lit(True)).filter("tail").select("bucket", "n_rows", pct("n_rows", "t", 3).alias("pct_of_all"))


@query("x12_x13_x14_buckets", "tr", """
SELECT CASE WHEN g < 0 THEN NULL WHEN g <= 25 THEN '[0,25]' WHEN g <= 50 THEN '(25,50]' WHEN g <= 75 THEN '(50,75]' WHEN g <= 110 THEN '(75,110]' END AS cut,
  CASE WHEN g >= 90 THEN '90+' WHEN g >= 80 THEN '80-89' WHEN g >= 70 THEN '70-79' WHEN g >= 60 THEN '60-69' WHEN g >= 0 THEN 'Below 60' END AS top_down,
  CASE WHEN g >= 36 THEN '36+' WHEN g >= 31 THEN '31-35' WHEN g >= 25 THEN '25-30' WHEN g >= 19 THEN '19-24' WHEN g >= 13 THEN '13-18' WHEN g >= 7 THEN '7-12' WHEN g >= 0 THEN '0-6' END AS by_min, count(*) AS n
FROM (SELECT D_stu_grade AS g FROM tr) GROUP BY ALL""")
def _(t):
    g = "D_stu_grade"
    return clean_tr(t).groupBy(ranges.cut_right(g, [0, 25, 50, 75, 110]).alias("cut"), ranges.bucket_down(g, V.TR.grade_buckets).alias("top_down"),
                               ranges.bucketize(g, V.PR.size_buckets).alias("by_min")).agg(F.count(F.lit(1)).alias("n"))


@query("x15_x16_credit_rules", "tr", """
SELECT C_creds_earn_exceeds_attempted, C_creds_impossible, D_creds_earn, CASE WHEN C_creds_earn_exceeds_attempted THEN NULL ELSE D_creds_earn END AS earned_capped,
  coalesce(D_creds_possible > 0 AND D_creds_earn = 0, false) AS failed, count(*) AS n FROM tr GROUP BY ALL""")
def _(t):
    d = clean_tr(t).withColumn("earned_capped", F.col("D_creds_earn"))
    d = ranges.excess_credits(d, "na_earned", earned="earned_capped").withColumn("failed", ranges.course_failed())
    return d.groupBy("C_creds_earn_exceeds_attempted", "C_creds_impossible", "D_creds_earn", "earned_capped", "failed").agg(F.count(F.lit(1)).alias("n"))


@query("x17_x18_class_ids", "cs", """
SELECT D_location_id || '_' || coalesce(D_employee_id::VARCHAR, 'NA') || '_' || D_term AS class_id, count(*) AS n FROM cs GROUP BY 1""")
def _(t):
    d = V.cs(t)
    return d.groupBy(school.class_id(d.columns, ["D_location_id", "D_employee_id", "D_term", "D_absent"]).alias("class_id")).agg(F.count(F.lit(1)).alias("n"))


@query("x19_x20_x21_grades", "grades", """
SELECT letter, CASE WHEN letter IS NOT NULL AND regexp_matches(letter, '^[A-F]') THEN letter[1] END AS grade_letter, CASE letter[1] WHEN 'A' THEN 1 WHEN 'B' THEN 2 WHEN 'C' THEN 3 WHEN 'D' THEN 4 WHEN 'F' THEN 5 END AS rank,
  try_cast(pctg AS DOUBLE) AS pct_value, CASE WHEN try_cast(pctg AS DOUBLE) >= 70 THEN 'Proficient' WHEN try_cast(pctg AS DOUBLE) < 70 THEN 'Below Proficient' END AS prof,
  replace(lower(D_course_subject), ' ', '_') AS subject, count(*) AS n FROM grades GROUP BY ALL""")
def _(t):
    g = school.letter_grade("letter")
    return V.grades(t).groupBy("letter", g.alias("grade_letter"), school.letter_rank(g).alias("rank"), school.pct_grade("pctg").alias("pct_value"),
                               school.proficiency(school.pct_grade("pctg") >= 70).alias("prof"), text.slug("D_course_subject").alias("subject")).agg(F.count(F.lit(1)).alias("n"))


@query("x24_staff_labels", "", """
SELECT s_suppkey, CASE WHEN kind = 'Professional' THEN '1 - Professional' WHEN kind = 'Initial' THEN '2 - Initial' WHEN kind = 'Temporary' THEN '3 - Provisional' WHEN kind IS NULL THEN '5 - Not licensed' END AS label,
  CASE WHEN rank >= 7 THEN 'Novice' WHEN rank < 7 THEN 'Experienced' ELSE 'Not licensed' END AS novice, CASE WHEN s_acctbal / 1000 <= 2 THEN 'Novice' ELSE 'Not Novice' END AS by_years
FROM (SELECT *, CASE WHEN s_acctbal < 0 THEN NULL WHEN s_acctbal < 3000 THEN 'Professional' WHEN s_acctbal < 6000 THEN 'Initial' WHEN s_acctbal < 8000 THEN 'Temporary' ELSE 'Other' END AS kind,
  CASE WHEN s_acctbal >= 0 THEN s_nationkey END AS rank FROM supplier)""")
def _(t):
    b = F.col("s_acctbal")
    d = t.supplier.withColumns({
        "kind": F.when(b < 0, F.lit(None)).when(b < 3000, "Professional").when(b < 6000, "Initial").when(b < 8000, "Temporary").otherwise("Other"),
        "rank": F.when(b >= 0, F.col("s_nationkey"))})
    return d.select("s_suppkey", school.licence_label("kind").alias("label"), school.novice_by_rank("rank").alias("novice"), school.novice_by_years(b / 1000).alias("by_years"))


@query("x25_keywords", "tr", "SELECT D_stu_id, bool_or(contains(lower(D_course_name), 'ring')) AS ring, bool_or(contains(lower(D_course_name), 'bolt')) AS bolt FROM tr GROUP BY 1")
def _(t):
    return clean_tr(t).groupBy("D_stu_id").agg(F.bool_or(text.contains_word("D_course_name", "Ring")).alias("ring"), F.bool_or(text.contains_word("D_course_name", "BOLT")).alias("bolt"))
