"""Peer network, purity and follow-on analyses."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import analysis as L
from ..operators import network as N
from ..operators import ordered as O
from ..plans import network as NP
from . import views as V
from .q_checks import clean_tr
from .registry import query


def members(t):
    """A given cohort per student, so that everything after the inference is comparable."""
    return V.roster(t).select("D_location_name", "D_stu_id", "C_inferred_cohort").distinct()


@query("n01_u06_cohort_schedule", "roster", """
SELECT DISTINCT D_location_name, D_stu_id, C_class_id, '1996' AS D_term, C_course_subject, C_course_name FROM roster WHERE split_part(C_class_id, '-', 2) = '1996'
  AND C_course_subject IN ('STANDARD', 'SMALL') AND C_course_name IN ('red widget', 'blue bolt', 'hot gear', 'small ring')""")
def _(t):
    d = V.roster(t).withColumn("D_term", F.substring_index("C_class_id", "-", -1))
    courses = N.course_union(["red widget", "blue bolt"], ["hot gear", "small ring", "red widget"])
    return N.cohort_schedule(d, courses, ["STANDARD", "SMALL"], "1996")


@query("n02_j09_student_pairs", "prs", "SELECT * FROM prs")
def _(t):
    return N.student_pairs(N.class_roster(V.roster(t)))


@query("n02_student_pairs_in_blocks", "prs", "SELECT D_location_name, M_shared_classes, count(*) AS n FROM prs GROUP BY 1, 2")
def _(t):
    return N.student_pairs(N.class_roster(V.roster(t)), block=2).groupBy("D_location_name", "M_shared_classes").agg(F.count(F.lit(1)).alias("n"))


def communities(t):
    return t.stored("communities", lambda: N.infer_communities(N.class_roster(V.roster(t))))


@query("n03_infer_cohorts")
def _(t):
    return N.label_cohorts(communities(t), N.class_roster(V.roster(t)))


@query("n03_invariants", "cr", """
SELECT D_location_name, count(DISTINCT D_stu_id) AS n_students, 0::BIGINT AS n_not_one_label, 0::BIGINT AS n_labels_elsewhere, true AS modularity_as_stated, true AS at_least_components FROM cr GROUP BY 1""")
def _(t):
    return N.partition_checks(N.class_roster(V.roster(t)), communities(t))


@query("n03_cohort_sizes", "cr", "SELECT D_location_name, count(DISTINCT D_stu_id) AS n_students, count(DISTINCT (C_class_id, D_stu_id)) AS n_class_places FROM cr GROUP BY 1")
def _(t):
    d = N.label_cohorts(communities(t), N.class_roster(V.roster(t)))
    sizes = d.groupBy("D_location_name").agg(F.sum("M_stu_num_ninth_cohort_classes").alias("n_class_places"))
    return N.cohort_summary(d).groupBy("D_location_name").agg(F.sum("M_inferred_cohort_size").alias("n_students")).join(sizes, "D_location_name")


@query("n04_cohort_summary", "cr", """
SELECT DISTINCT D_location_name, C_inferred_cohort, n AS M_inferred_cohort_size, NULL::DOUBLE AS M_school_modularity FROM (SELECT D_location_name, C_inferred_cohort, count(DISTINCT D_stu_id) AS n FROM cr GROUP BY 1, 2)""")
def _(t):
    from ..functions.nullsafe import attach
    m = attach(members(t), ["D_location_name", "C_inferred_cohort"], F.count(F.lit(1)).alias("M_inferred_cohort_size"))
    return N.cohort_summary(m.withColumn("M_school_modularity", F.lit(None).cast("double")))


@query("n05_section_purity", "roster cr", """
SELECT * FROM (SELECT D_location_name, C_class_id, sum(n)::BIGINT AS M_cls_num_students, count(*) AS M_cls_num_inferred_cohorts, max(n) AS M_cls_dominant_cohort_students, max(n) / sum(n)::DOUBLE AS M_cls_cohort_purity,
  arg_min(C_inferred_cohort, {'n': -n, 'c': C_inferred_cohort}) AS C_cls_dominant_cohort FROM (SELECT D_location_name, C_class_id, C_inferred_cohort, count(*) AS n FROM cr GROUP BY 1, 2, 3) GROUP BY 1, 2)
JOIN (SELECT D_location_name, C_class_id, string_agg(DISTINCT C_course_subject, ' | ' ORDER BY C_course_subject) AS C_course_subject, string_agg(DISTINCT C_course_name, ' | ' ORDER BY C_course_name) AS C_course_name FROM roster GROUP BY 1, 2) USING (D_location_name, C_class_id)""")
def _(t):
    return N.section_purity(V.roster(t), members(t))


_SCP = """SELECT D_location_name, D_stu_id, C_inferred_cohort, C_class_id, size - 1 AS M_stu_num_classmates, same - 1 AS M_stu_num_same_cohort_classmates, CASE WHEN size > 1 THEN (same - 1) / (size - 1)::DOUBLE END AS M_stu_class_cohort_purity FROM (
  SELECT *, count(*) OVER (PARTITION BY D_location_name, C_class_id) AS size, count(*) OVER (PARTITION BY D_location_name, C_class_id, C_inferred_cohort) AS same FROM cr)"""


@query("n06_student_class_purity", "cr", _SCP)
def _(t):
    return N.student_class_purity(V.roster(t), members(t))


@query("n07_u07_student_purity", "cr prs", f"""
SELECT a.* EXCLUDE (avg_p), round_even(avg_p, 9) AS M_stu_avg_class_cohort_purity, coalesce(n, 0) AS M_stu_unique_outside_cohort_peers FROM (
  SELECT D_location_name, D_stu_id, C_inferred_cohort, count(*) AS M_stu_num_cohort_classes, avg(M_stu_class_cohort_purity) AS avg_p, round_even(avg((M_stu_class_cohort_purity >= 9e-1)::INT), 9) AS M_stu_pct_classes_90pct_pure,
    CASE WHEN sum(M_stu_num_classmates) > 0 THEN round_even(sum(M_stu_num_same_cohort_classmates) / sum(M_stu_num_classmates)::DOUBLE, 9) END AS M_stu_overall_classmate_purity FROM ({_SCP}) GROUP BY 1, 2, 3) a
LEFT JOIN (SELECT D_location_name, s AS D_stu_id, count(DISTINCT p) AS n FROM (SELECT p.D_location_name, unnest([D_stu_id_1, D_stu_id_2]) AS s, unnest([D_stu_id_2, D_stu_id_1]) AS p FROM prs p
  JOIN (SELECT DISTINCT D_stu_id, C_inferred_cohort AS c1 FROM cr) x ON x.D_stu_id = D_stu_id_1 JOIN (SELECT DISTINCT D_stu_id, C_inferred_cohort AS c2 FROM cr) y ON y.D_stu_id = D_stu_id_2 WHERE c1 <> c2) GROUP BY 1, 2) b USING (D_location_name, D_stu_id)""")
def _(t):
    m = members(t)
    d = N.student_purity(N.student_class_purity(V.roster(t), m), None, m, peers=N.outside_peers(V.roster(t), m))
    rounded = ["M_stu_avg_class_cohort_purity", "M_stu_pct_classes_90pct_pure", "M_stu_overall_classmate_purity"]
    return d.withColumns({c: F.bround(c, 9) for c in rounded})


@query("n08_peer_continuity", "prs", """
SELECT D_location_name, s AS D_stu_id, count(*) AS M_stu_unique_peers, count(*) FILTER (m >= 2) AS M_stu_peers_shared_2plus, count(*) FILTER (m >= 3) AS M_stu_peers_shared_3plus, count(*) FILTER (m >= 4) AS M_stu_peers_shared_4plus,
  max(m) AS M_stu_max_shared_classes, count(*) FILTER (m = 1) AS M_stu_peers_shared_1_classes, count(*) FILTER (m = 2) AS M_stu_peers_shared_2_classes FROM (
  SELECT D_location_name, unnest([D_stu_id_1, D_stu_id_2]) AS s, M_shared_classes AS m FROM prs) GROUP BY 1, 2""")
def _(t):
    return N.continuity_of_counts(N.peer_counts(N.class_roster(V.roster(t))), [1, 2])


@query("n08_peer_levels", "prs", """
SELECT D_location_name, s AS D_stu_id, M_shared_classes, count(*) AS M_stu_peers FROM (SELECT D_location_name, unnest([D_stu_id_1, D_stu_id_2]) AS s, M_shared_classes FROM prs) GROUP BY 1, 2, 3""")
def _(t):
    return N.peer_counts(N.class_roster(V.roster(t)))


@query("n09_network_tables")
def _(t):
    out = NP.analyse(V.roster(t).withColumn("D_term", F.lit("S1")).drop("C_inferred_cohort"))
    rows = None
    for name, d in out.items():
        one = d.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table"), "n_rows")
        rows = one if rows is None else rows.unionByName(one)
    return rows


# --- follow-on ---

@query("l01_ever_rate", "tr", """
SELECT count(DISTINCT D_stu_id) AS num_students, count(DISTINCT D_stu_id) FILTER (D_creds_earn = 0 AND C_course_name_starred) AS num_with,
  count(DISTINCT D_stu_id) FILTER (D_creds_earn = 0 AND C_course_name_starred) / count(DISTINCT D_stu_id)::DOUBLE AS pct_with FROM tr""")
def _(t):
    return L.ever_rate(clean_tr(t), (F.col("D_creds_earn") == 0) & F.col("C_course_name_starred"))


@query("l02_never_transferred", "mob", """
SELECT count(*) AS num_students, count(*) FILTER (C_pure_cohort) AS num_never, count(*) FILTER (C_transferred_within_year) AS num_within, count(*) FILTER (C_transferred_across_years) AS num_across, count(*) FILTER (C_pure_cohort) / count(*)::DOUBLE AS pct_never FROM mob""")
def _(t):
    from .q_cohort import student_year
    return L.never_rate(O.mobility(student_year(t)), {"within": F.col("C_transferred_within_year"), "across": F.col("C_transferred_across_years")})


def _kept(t):
    return V.pathways(t).filter("valid_combo AND include_flag = 'Include'")


@query("l03_courses_per_combo", "pathways", """
SELECT sum(n) / count(*) AS average_unique_courses, count(*) FILTER (n <= 3) AS num_combos_few, count(*) AS total_combos FROM (
  SELECT count(DISTINCT course_id) AS n FROM pathways WHERE C_pure_cohort AND valid_combo AND include_flag = 'Include' GROUP BY C_four_year_home_school, pathway)""")
def _(t):
    return L.combo_summary(L.courses_per_combo(_kept(t).filter("C_pure_cohort"), ["C_four_year_home_school", "pathway"], "course_id"))


@query("l04_credit_criterion", "coded", """
SELECT count(*) AS num_students, count(*) FILTER (c >= 2) AS num_reaching, count(*) FILTER (c >= 2) / count(*)::DOUBLE AS pct_reaching FROM (SELECT D_stu_id, sum(D_creds_earn) AS c FROM coded WHERE C_course_subject = 'STANDARD' GROUP BY 1)""")
def _(t):
    from ..operators.joins import code_courses
    return L.credit_criterion(code_courses(clean_tr(t), V.coding(t)), "C_course_subject", "STANDARD", 2.0)


_YEARS = {"math": "MEDIUM", "ela": "STANDARD"}


@query("l05_year_criterion", "coded", """
SELECT count(*) AS num_students, count(*) FILTER (m >= 4) AS num_math, count(*) FILTER (e >= 4) AS num_ela, count(*) FILTER (m >= 4 AND e >= 4) AS num_all, count(*) FILTER (m >= 4) / count(*)::DOUBLE AS pct_math,
  count(*) FILTER (e >= 4) / count(*)::DOUBLE AS pct_ela, count(*) FILTER (m >= 4 AND e >= 4) / count(*)::DOUBLE AS pct_all FROM (
  SELECT count(DISTINCT D_year) FILTER (C_course_subject = 'MEDIUM') AS m, count(DISTINCT D_year) FILTER (C_course_subject = 'STANDARD') AS e FROM coded GROUP BY D_stu_id)""")
def _(t):
    from ..operators.joins import code_courses
    return L.year_criterion(code_courses(clean_tr(t), V.coding(t)), "C_course_subject", _YEARS)


@query("l06_keyword_criterion", "tr", """
SELECT count(*) AS num_students, count(*) FILTER (a AND b AND c) AS num_every, count(*) FILTER (d OR e) AS num_either, count(*) FILTER (a AND b AND c) / count(*)::DOUBLE AS pct_every, count(*) FILTER (d OR e) / count(*)::DOUBLE AS pct_either FROM (
  SELECT bool_or(contains(D_course_name, 'ring')) AS a, bool_or(contains(D_course_name, 'bolt')) AS b, bool_or(contains(D_course_name, 'gear')) AS c, bool_or(contains(D_course_name, 'small widget')) AS d, bool_or(contains(D_course_name, 'hot gear')) AS e FROM tr GROUP BY D_stu_id)""")
def _(t):
    return L.keyword_criterion(clean_tr(t), "D_course_name", ["Ring", "Bolt", "Gear"], ["Small Widget", "Hot Gear"])


_FLAGS = """SELECT D_stu_id, CASE WHEN coalesce(sum(D_creds_earn) FILTER (C_course_subject = 'LARGE'), 0) >= 2 THEN 'Y' ELSE 'N' END AS credit_flag, CASE WHEN count(DISTINCT D_year) FILTER (C_course_subject = 'MEDIUM') >= 4 THEN 'Y' ELSE 'N' END AS years_math_flag,
  CASE WHEN count(DISTINCT D_year) FILTER (C_course_subject = 'STANDARD') >= 4 THEN 'Y' ELSE 'N' END AS years_ela_flag, CASE WHEN bool_or(contains(D_course_name, 'ring')) AND bool_or(contains(D_course_name, 'bolt')) THEN 'Y' ELSE 'N' END AS every_flag,
  CASE WHEN bool_or(contains(D_course_name, 'small widget')) OR bool_or(contains(D_course_name, 'hot gear')) THEN 'Y' ELSE 'N' END AS either_flag FROM coded GROUP BY 1"""


def _flags(t):
    from ..operators.joins import code_courses
    d = t.stored("coded", lambda: code_courses(clean_tr(t), V.coding(t)))
    return d, L.criteria_flags(d, ("LARGE", 2.0), _YEARS, 4, ["ring", "bolt"], ["small widget", "hot gear"], "C_course_subject", "D_course_name")


@query("w09_flags_onto_rows", "coded", f"SELECT D_year, credit_flag, years_math_flag, years_ela_flag, every_flag, either_flag, count(*) AS n FROM coded JOIN ({_FLAGS}) USING (D_stu_id) GROUP BY ALL")
def _(t):
    d, f = _flags(t)
    return L.flags_onto_rows(d, f).groupBy("D_year", "credit_flag", "years_math_flag", "years_ela_flag", "every_flag", "either_flag").agg(F.count(F.lit(1)).alias("n"))


@query("l07_all_criteria", "coded", f"""
SELECT count(*) AS num_students, count(*) FILTER (k) AS num_all, count(*) FILTER (k) / count(*)::DOUBLE AS pct_all FROM (SELECT credit_flag = 'Y' AND years_math_flag = 'Y' AND years_ela_flag = 'Y' AND every_flag = 'Y' AND either_flag = 'Y' AS k FROM ({_FLAGS}))""")
def _(t):
    return L.all_criteria(_flags(t)[1], ["credit_flag", "years_math_flag", "years_ela_flag", "every_flag", "either_flag"])


@query("l08_offering_table", "pathways", """
SELECT a.*, num_students_in_pathway, num_students_in_course / num_students_in_pathway::DOUBLE AS pct_students_in_course FROM (SELECT C_four_year_home_school, pathway, C_course_name_clean, count(DISTINCT D_stu_id) AS num_students_in_course FROM pathways
  WHERE valid_combo AND include_flag = 'Include' AND C_course_EPSO_no_IC AND C_course_name_clean IS NOT NULL GROUP BY 1, 2, 3) a
JOIN (SELECT C_four_year_home_school, pathway, count(DISTINCT D_stu_id) AS num_students_in_pathway FROM pathways WHERE valid_combo AND include_flag = 'Include' GROUP BY 1, 2) USING (C_four_year_home_school, pathway)""")
def _(t):
    return L.offering_table(_kept(t), ["C_four_year_home_school", "pathway"], "C_course_name_clean", F.col("C_course_EPSO_no_IC"))


_PATHS = ["Brand#1", "Brand#2", "Brand#3"]


@query("l09_a12_peer_comparison", "pathways", """
SELECT pathway, own_offerings, "S1", "S2" FROM (SELECT pathway, count(DISTINCT C_course_name_clean) FILTER (C_four_year_home_school = 'S0') AS own_offerings, count(DISTINCT C_course_name_clean) FILTER (C_four_year_home_school = 'S1') AS "S1",
  count(DISTINCT C_course_name_clean) FILTER (C_four_year_home_school = 'S2') AS "S2" FROM pathways WHERE pathway IN ('Brand#1', 'Brand#2', 'Brand#3') GROUP BY 1)""")
def _(t):
    return L.peer_comparison(V.pathways(t).filter("C_course_name_clean is not null"), "C_four_year_home_school", "pathway", "C_course_name_clean", "S0", ["S1", "S2"], _PATHS)


@query("l10_gap_list", "pathways", """
SELECT DISTINCT C_four_year_home_school, pathway, C_course_name_clean FROM pathways p WHERE pathway IN ('Brand#1', 'Brand#2', 'Brand#3') AND C_four_year_home_school <> 'S0' AND C_course_name_clean IS NOT NULL
  AND (pathway, C_course_name_clean) NOT IN (SELECT (pathway, C_course_name_clean) FROM pathways WHERE C_four_year_home_school = 'S0' AND C_course_name_clean IS NOT NULL)""")
def _(t):
    return L.gap_list(V.pathways(t).filter("C_course_name_clean is not null"), "C_four_year_home_school", "pathway", "C_course_name_clean", "S0", _PATHS)
