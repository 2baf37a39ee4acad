"""Checked joins, crosswalks, coding, cross-file reconciliation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.nullsafe import join_same
from ..operators import aggregates as A
from ..operators import joins as J
from ..operators import ordered as O
from ..plans import transcript as T
from . import views as V
from .q_checks import clean_sp, clean_tr, read_sp, read_tr
from .registry import query


def locations(t):
    return V.sp_raw(t).groupBy("D_location_id", "D_location_name", "D_year").agg(F.count(F.lit(1)).alias("n"))


def named(t):
    from ..functions.text import clean_location_name
    return V.sp_raw(t).withColumn("nm", clean_location_name("D_location_name", V.TR.strip_prefix, V.TR.strip_suffix))


def orphans(t):
    return J.anti(clean_tr(t).select("D_stu_id", "D_year").distinct(), clean_sp(t), ["D_stu_id", "D_year"])


@query("j01_j02_checked_join", "tr", """
SELECT count(*) AS n_rows, count(*) FILTER (p_size < 40) AS n_matched, round_even(100e0 * count(*) FILTER (p_size < 40) / count(*), 2) AS pct_matched FROM tr
JOIN part ON regexp_extract(D_course_id, '(\\d+)', 1)::BIGINT = p_partkey""")
def _(t):
    d = clean_tr(t).withColumn("k", F.regexp_extract("D_course_id", r"(\d+)", 1).cast("long"))
    return J.match_rate(J.join_checked(d, t.part.filter("p_size < 40").select("p_partkey", "p_name"), {"k": "p_partkey"}, keep_marker=True))


@query("j01_unmatched_keys", "", "SELECT p_brand FROM part GROUP BY 1 HAVING p_brand NOT IN (SELECT p_brand FROM part WHERE p_size = 7)")
def _(t):
    j = J.join_checked(t.part, t.part.filter("p_size = 7").select("p_brand").distinct(), "p_brand", keep_marker=True)
    return J.unmatched_keys(j, ["p_brand"])


@query("j03_null_safe_left_join", "cs", """
SELECT a.D_employee_id, n_students, count(*) AS n FROM cs a LEFT JOIN (SELECT D_employee_id, count(DISTINCT D_stu_id) AS n_students FROM cs GROUP BY 1) b ON a.D_employee_id IS NOT DISTINCT FROM b.D_employee_id GROUP BY ALL""")
def _(t):
    d = V.cs(t)
    per = d.groupBy("D_employee_id").agg(F.count_distinct("D_stu_id").alias("n_students"))
    return join_same(d, per, "D_employee_id").groupBy("D_employee_id", "n_students").agg(F.count(F.lit(1)).alias("n"))


@query("j04_inner_join", "tr coding", "SELECT C_course_subject, count(*) AS n FROM tr JOIN coding USING (D_course_id, D_course_name) GROUP BY 1")
def _(t):
    return J.inner(clean_tr(t), V.coding(t), ["D_course_id", "D_course_name"]).groupBy("C_course_subject").agg(F.count(F.lit(1)).alias("n"))


@query("j05_semi_join", "tr sp", "SELECT D_year, count(*) AS n FROM tr SEMI JOIN sp USING (D_stu_id, D_year) GROUP BY 1")
def _(t):
    return J.semi(clean_tr(t), clean_sp(t), ["D_stu_id", "D_year"]).groupBy("D_year").agg(F.count(F.lit(1)).alias("n"))


@query("j06_anti_join", "tr sp", "SELECT DISTINCT D_stu_id, D_year FROM tr ANTI JOIN sp USING (D_stu_id, D_year)")
def _(t):
    return orphans(t)


@query("j11_course_coding", "coded", """
SELECT D_course_id, D_course_name, C_coding_source, C_course_id, C_course_subject_area, C_course_subject, C_course_credit_type, C_course_rigor, C_course_epso_flag, C_course_ic_flag, count(*) AS n FROM coded GROUP BY ALL""")
def _(t):
    d = J.code_courses(clean_tr(t), V.coding(t))
    return d.groupBy("D_course_id", "D_course_name", "C_coding_source", "C_course_id", "C_course_subject_area", "C_course_subject", "C_course_credit_type", "C_course_rigor",
                     "C_course_epso_flag", "C_course_ic_flag").agg(F.count(F.lit(1)).alias("n"))


@query("j12_coding_preview", "tr coding", r"""
SELECT (SELECT count(*) FROM (SELECT DISTINCT D_course_id, D_course_name FROM tr)) AS pairs_transcript, (SELECT count(*) FROM (SELECT DISTINCT D_course_id, D_course_name FROM tr) SEMI JOIN coding USING (D_course_id, D_course_name)) AS pairs_exact,
  count(*) AS n_rows, count(*) FILTER (EXISTS (SELECT 1 FROM coding c WHERE c.D_course_id = tr.D_course_id AND c.D_course_name = tr.D_course_name)) AS rows_exact,
  count(*) FILTER (EXISTS (SELECT 1 FROM coding c WHERE c.D_course_id = tr.D_course_id AND lower(trim(regexp_replace(replace(c.D_course_name, '*', ''), '\s+', ' ', 'g'))) = lower(trim(regexp_replace(replace(tr.D_course_name, '*', ''), '\s+', ' ', 'g'))))) AS rows_folded,
  count(*) FILTER (D_course_id IN (SELECT D_course_id FROM coding)) AS rows_by_id, (SELECT count(*) FROM (SELECT DISTINCT D_course_id, D_course_name FROM coding)) AS pairs_coding FROM tr""")
def _(t):
    return J.coding_preview(clean_tr(t), V.coding(t))


@query("j12_unmatched_pairs", "tr coding", "SELECT D_course_id, D_course_name, count(*) AS n_rows FROM tr ANTI JOIN coding USING (D_course_id, D_course_name) GROUP BY 1, 2")
def _(t):
    return J.unmatched_pairs(clean_tr(t), V.coding(t))


@query("j13_location_crosswalk", "sp_loc", f"""
SELECT *, count(*) OVER (PARTITION BY location_id) AS n_names, count(*) OVER (PARTITION BY location_name) AS n_ids, location_name IN ({V._SCHOOLS}) AS included FROM (
  SELECT C_location_id AS location_id, C_location_name_merged AS location_name, count(*) AS n_rows FROM sp_loc GROUP BY 1, 2)""")
def _(t):
    return J.location_crosswalk(clean_sp(t), "C_location_id", "C_location_name_merged", V.SCHOOLS)


@query("j13_unresolved_names", "sp_loc", "SELECT v.location_name FROM (VALUES ('NATION_3'), ('Nowhere High')) v(location_name) WHERE v.location_name NOT IN (SELECT C_location_name_merged FROM sp_loc)")
def _(t):
    return J.unresolved_names(J.location_crosswalk(clean_sp(t), "C_location_id", "C_location_name_merged"), ["NATION_3", "Nowhere High"]).offenders


@query("j14_canonical_names", "sp", "SELECT C_location_name_merged, C_location_name_canonical, count(*) AS n FROM sp GROUP BY 1, 2")
def _(t):
    d = J.canonical_names(clean_sp(t).drop("C_location_name_canonical"), "C_location_id", "C_location_name_merged")
    return d.groupBy("C_location_name_merged", "C_location_name_canonical").agg(F.count(F.lit(1)).alias("n"))


@query("j14_count_renamed", "sp", "SELECT count(*) FILTER (C_location_name_merged <> C_location_name_canonical) AS n_renamed FROM sp")
def _(t):
    return J.count_renamed(clean_sp(t), "C_location_name_merged")


@query("j15_merge_plan", "sp_loc", """
SELECT 'NATION_23' AS survivor, 'NATION_24' AS absorbed, (SELECT count(*) FROM sp_loc WHERE C_location_name = 'NATION_24') AS rows_remapped,
  (SELECT count(*) FROM (SELECT D_year FROM sp_loc WHERE C_location_name = 'NATION_23' INTERSECT SELECT D_year FROM sp_loc WHERE C_location_name = 'NATION_24'))::INT AS n_shared_years, 'PASS' AS result
UNION ALL SELECT 'NATION_1', 'NATION_2', (SELECT count(*) FROM sp_loc WHERE C_location_name = 'NATION_2'),
  (SELECT count(*) FROM (SELECT D_year FROM sp_loc WHERE C_location_name = 'NATION_1' INTERSECT SELECT D_year FROM sp_loc WHERE C_location_name = 'NATION_2'))::INT, 'FAIL'""")
def _(t):
    p = J.merge_plan(named(t), "D_location_id", "nm", "D_year", [*V.MERGES, {"name": "NATION_1", "absorbs": ["NATION_2"]}])
    return p.select("survivor", "absorbed", "rows_remapped", "n_shared_years", "result")


@query("j15_apply_merges", "sp_loc", "SELECT D_location_id, C_location_id, C_location_name_merged, count(*) AS n FROM sp_loc GROUP BY 1, 2, 3")
def _(t):
    d = named(t)
    p = J.merge_plan(d, "D_location_id", "nm", "D_year", V.MERGES)
    return J.apply_merges(d, p, "D_location_id", "nm").groupBy("D_location_id", "C_location_id", "C_location_name_merged").agg(F.count(F.lit(1)).alias("n"))


@query("j16_related_distinct", "sp_loc", """
SELECT a AS from_name, b AS to_name, a[8:] AS from_ids, b[8:] AS to_ids, CASE WHEN a = b THEN 'FAIL' ELSE 'PASS' END AS result FROM (VALUES ('NATION_5', 'NATION_6'), ('NATION_7', 'NATION_7')) v(a, b)
WHERE a IN (SELECT C_location_name FROM sp_loc)""")
def _(t):
    x = J.location_crosswalk(named(t), "D_location_id", "nm")
    return J.related_distinct(x, [{"from": "NATION_5", "to": "NATION_6"}, {"from": "NATION_7", "to": "NATION_7"}]).select("from_name", "to_name", "from_ids", "to_ids", "result")


@query("j17_year_presence", "sp", """
SELECT C_location_id, C_location_name_canonical, count(*) FILTER (D_year = 1995) AS y1995, count(*) FILTER (D_year = 1996) AS y1996, count(*) FILTER (D_year = 1997) AS y1997, count(*) FILTER (D_year = 1998) AS y1998, count(*) FILTER (D_year = 1999) AS y1999, count(*) FILTER (D_year = 2000) AS y2000, count(*) FILTER (D_year = 2001) AS y2001 FROM sp GROUP BY 1, 2""")
def _(t):
    return J.year_presence(clean_sp(t), "C_location_id", "C_location_name_canonical", "D_year", list(V.YEARS))


@query("j17_year_gaps", "sp", """
SELECT site AS location_id, site AS location_name, D_year AS year, CASE WHEN site = '3-A-9' THEN D_year NOT IN (1996, 1997) ELSE false END AS declared FROM (
  SELECT site, D_year FROM (SELECT DISTINCT D_location_id || '-' || D_stu_race || '-' || D_stu_grade_level_demo AS site FROM sp), (SELECT DISTINCT D_year FROM sp)
  EXCEPT SELECT D_location_id || '-' || D_stu_race || '-' || D_stu_grade_level_demo, D_year FROM sp)""")
def _(t):
    d = clean_sp(t).withColumn("site", F.concat_ws("-", F.col("D_location_id").cast("string"), "D_stu_race", F.col("D_stu_grade_level_demo").cast("string")))
    return J.year_gaps(d, "site", "site", "D_year", {"3-A-9": [1996, 1997]})


@query("j18_span_position", "tr sp", """
SELECT D_stu_id, D_year, first_enrolled, last_enrolled, n_enrolled_years, CASE WHEN first_enrolled IS NULL THEN 'absent from enrolment' WHEN D_year < first_enrolled THEN 'before first enrolled year'
  WHEN D_year > last_enrolled THEN 'after last enrolled year' ELSE 'gap inside enrolled span' END AS position
FROM (SELECT DISTINCT D_stu_id, D_year FROM tr ANTI JOIN sp USING (D_stu_id, D_year)) LEFT JOIN (SELECT D_stu_id, min(D_year) AS first_enrolled, max(D_year) AS last_enrolled, count(DISTINCT D_year) AS n_enrolled_years FROM sp GROUP BY 1) USING (D_stu_id)""")
def _(t):
    return J.span_position(orphans(t), clean_sp(t))


_AGREE = """SELECT a.D_stu_id, a.D_year, grade_tr, n_grade_tr_values, grade_demo, grade_tr - grade_demo AS diff FROM (
  SELECT * FROM (SELECT D_stu_id, D_year, D_stu_grade_level_transcript AS grade_tr, count(*) OVER (PARTITION BY D_stu_id, D_year) AS n_grade_tr_values, row_number() OVER (PARTITION BY D_stu_id, D_year ORDER BY count(*) DESC, D_stu_grade_level_transcript) AS rn
    FROM tr GROUP BY 1, 2, 3) WHERE rn = 1) a
JOIN (SELECT * FROM (SELECT D_stu_id, D_year, D_stu_grade_level_demo AS grade_demo, row_number() OVER (PARTITION BY D_stu_id, D_year ORDER BY M_days_enrolled DESC, D_stu_grade_level_demo) AS rn FROM sp) WHERE rn = 1) b USING (D_stu_id, D_year)"""


@query("j19_w04_grade_agreement", "tr sp", _AGREE)
def _(t):
    return J.grade_agreement(clean_tr(t), clean_sp(t))


@query("j19_difference_table", "tr sp", f"SELECT diff, count(*) AS n_student_years, round_even(100e0 * count(*) / sum(count(*)) OVER (), 2) AS pct FROM ({_AGREE}) GROUP BY 1")
def _(t):
    return J.difference_table(J.grade_agreement(clean_tr(t), clean_sp(t)))


@query("j20_reconcile", "tr sp", f"""
SELECT *, round_even(100e0 * ids_found / n_ids, 2) AS pct_ids_found, round_even(100e0 * id_years_found / n_id_years, 2) AS pct_id_years_found, round_even(100e0 * n_agree / n_compared, 2) AS pct_agree FROM (
  SELECT count(DISTINCT D_stu_id) AS n_ids, count(DISTINCT D_stu_id) FILTER (D_stu_id IN (SELECT D_stu_id FROM sp)) AS ids_found, count(DISTINCT (D_stu_id, D_year)) AS n_id_years,
    count(DISTINCT (D_stu_id, D_year)) FILTER ((D_stu_id, D_year) IN (SELECT (D_stu_id, D_year) FROM sp)) AS id_years_found FROM tr),
  (SELECT count(*) AS n_compared, count(*) FILTER (diff = 0) AS n_agree FROM ({_AGREE}))""")
def _(t):
    tr, sp = clean_tr(t), clean_sp(t)
    return J.reconcile(tr, sp, J.grade_agreement(tr, sp))


@query("j21_schedule_coding", "cs", """
SELECT D_course_id, count(*) AS n, count(*) FILTER (p_size > 5) AS n_coded FROM cs JOIN part ON D_course_id = 'K' || p_partkey GROUP BY 1""")
def _(t):
    coding = t.part.filter("p_size > 5").select(F.concat(F.lit("K"), F.col("p_partkey").cast("string")).alias("D_course_id"), F.col("p_brand").alias("C_course_rigor"))
    d = J.replace_coding(V.cs(t), coding, ["D_course_id"])
    return d.groupBy("D_course_id").agg(F.count(F.lit(1)).alias("n"), F.count("C_course_rigor").alias("n_coded"))


# --- order, picks, sets ---

@query("w01_same_school_overlaps", "sp", """
SELECT D_stu_id, D_year, C_location_id, H_enter_clamped, H_exit_clamped, count(*) AS n_copies, max(n) AS n_spells, count(*) FILTER (coalesce(H_enter_clamped < prev, false)) AS n_overlapping FROM (
  SELECT *, count(*) OVER (PARTITION BY D_stu_id, D_year, C_location_id) AS n, lag(H_exit_clamped) OVER (PARTITION BY D_stu_id, D_year, C_location_id ORDER BY H_enter_clamped, H_exit_clamped) AS prev FROM sp)
WHERE n > 1 GROUP BY 1, 2, 3, 4, 5""")
def _(t):
    return O.same_school_overlaps(clean_sp(t)).select("D_stu_id", "D_year", "C_location_id", "H_enter_clamped", "H_exit_clamped", "n_copies", "n_spells", F.col("n_overlapping").cast("long").alias("n_overlapping"))


@query("w07_rank_groups", "sp", """
SELECT D_location_id, C_location_name, n, 'Name ' || row_number() OVER (PARTITION BY D_location_id ORDER BY n DESC, md5(C_location_name)) AS label FROM (SELECT D_location_id, C_location_name, count(*) AS n FROM sp GROUP BY 1, 2)""")
def _(t):
    n = clean_sp(t).groupBy("D_location_id", "C_location_name").agg(F.count(F.lit(1)).alias("n"))
    return O.rank_groups(n, ["D_location_id"], "n", "C_location_name", "Name ", "label")


@query("w08_dominant_value", "cs", """
SELECT D_employee_id, C_main FROM (SELECT D_employee_id, C_course_subject AS C_main, row_number() OVER (PARTITION BY D_employee_id ORDER BY sum(D_stu_grade) DESC, C_course_subject) AS rn FROM cs GROUP BY 1, 2) WHERE rn = 1""")
def _(t):
    return O.dominant(V.cs(t), ["D_employee_id"], "C_course_subject", "D_stu_grade", "C_main")


@query("o01_sort_nulls_last", "cs", "SELECT D_employee_id, D_location_id, count(*) AS n FROM cs GROUP BY 1, 2 ORDER BY 1 DESC NULLS LAST, 2")
def _(t):
    return O.sort_rows(V.cs(t).groupBy("D_employee_id", "D_location_id").agg(F.count(F.lit(1)).alias("n")), "-D_employee_id", "D_location_id")


@query("o02_top_counts", "tr", "SELECT D_course_id, D_course_name, count(*) AS n_rows FROM tr GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2 LIMIT 20")
def _(t):
    return O.top_counts(clean_tr(t), ["D_course_id", "D_course_name"], 20)


@query("u01_append", "tr sp", "SELECT D_stu_id, D_year, D_course_id, NULL::INT AS D_location_id FROM tr UNION ALL SELECT D_stu_id, D_year, NULL, D_location_id FROM sp")
def _(t):
    return O.append(clean_tr(t).select("D_stu_id", "D_year", "D_course_id"), clean_sp(t).select("D_stu_id", "D_year", "D_location_id"))


@query("u02_distinct_first", "sp", """
SELECT D_stu_id, D_stu_enter_date, D_location_id FROM (SELECT *, row_number() OVER (PARTITION BY D_stu_id ORDER BY D_stu_enter_date, D_location_id) AS rn FROM sp) WHERE rn = 1""")
def _(t):
    return O.distinct_first(clean_sp(t).select("D_stu_id", "D_stu_enter_date", "D_location_id"), ["D_stu_id"], ["D_stu_enter_date"])


@query("u03_set_difference", "tr sp", """
SELECT D_stu_id, D_year, 'left' AS side FROM (SELECT D_stu_id, D_year FROM tr EXCEPT SELECT D_stu_id, D_year FROM sp) UNION ALL SELECT D_stu_id, D_year, 'right' FROM (SELECT D_stu_id, D_year FROM sp EXCEPT SELECT D_stu_id, D_year FROM tr)""")
def _(t):
    return O.set_difference(read_tr(t), read_sp(t), ["D_stu_id", "D_year"])


@query("u04_intersect_ids", "tr sp", "SELECT a.D_year, b.D_year AS later_year, D_stu_id FROM (SELECT DISTINCT D_year, D_stu_id FROM tr) a JOIN (SELECT DISTINCT D_year, D_stu_id FROM sp) b USING (D_stu_id) WHERE b.D_year = a.D_year + 1")
def _(t):
    """Students of each transcript year who are enrolled in the next one."""
    tr, sp = clean_tr(t), clean_sp(t)
    years = range(min(V.YEARS) - 1, max(V.YEARS) + 2)
    one = lambda y: O.keep_ids(tr.filter(F.col("D_year") == y), sp.filter(F.col("D_year") == y + 1), "D_stu_id").select(F.lit(y).alias("D_year"), F.lit(y + 1).alias("later_year"), "D_stu_id")
    return reduce(DataFrame.unionByName, map(one, years))


@query("u05_same_years", "tr sp", """
SELECT n AS n_different, n = 0 AS same FROM (SELECT count(*) AS n FROM ((SELECT D_year FROM tr EXCEPT SELECT D_year FROM sp) UNION ALL (SELECT D_year FROM sp EXCEPT SELECT D_year FROM tr)))""")
def _(t):
    return O.same_values(clean_tr(t), clean_sp(t), "D_year")
