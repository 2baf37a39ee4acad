"""School-shaped views of the supplied tables, once in Spark and once as SQL CTEs.

Whole tables throughout: nothing is filtered to make a comparison cheaper.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import school_year_of
from ..functions.nullsafe import join_same
from ..operators.meetings import ScheduleParams
from ..operators.scope import apply_exclusions
from ..plans.transcript import TranscriptParams
from ..sources.tables import cut_lineage


class Tables:
    """The supplied Parquet tables of one directory."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    _kept: dict = {}

    def stored(self, key: str, build):
        """A table (or a dict of tables) that many queries start from: written once per session and
        directory, then read back. :meth:`forget` drops the references."""
        k = (self.spark.sparkContext.applicationId, self.path, key)
        if k not in Tables._kept:
            made = build()  # the end-to-end plans store their own tables
            Tables._kept[k] = made if isinstance(made, dict) else cut_lineage(made)
        return Tables._kept[k]

    @staticmethod
    def forget() -> None:
        Tables._kept.clear()

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{name}.parquet")


# ---------------------------------------------------------------- parameters

YEARS = range(1995, 2002)
SCHOOLS = tuple(f"NATION_{i}" for i in range(18))
RACES = {"A": "Group A", "B": "Group B", "F": "Group F", "H": "Group H", "M": "Group M"}
MERGES = ({"name": "NATION_23", "absorbs": ["NATION_24"], "allow_overlap": True},)

TR = TranscriptParams(
    strip_suffix=r"\s+9-12$", schools=SCHOOLS, merges=MERGES, race_map=RACES, entry_year=1996, entry_grade=9,
    progression={1996: 9, 1997: 10, 1998: 11, 1999: 12}, duration_min_days=20, school_rule="in_scope_any_year",
    snapshot_year=1998, snapshot_min_days=60)

_SEM = {"S1": ["Q1", "Q2"], "S2": ["Q3", "Q4"], "FY": ["Q1", "Q2", "Q3", "Q4"]}
_TERMS = dict(
    term_weights={f"{y}{t}": (1.0 if t == "FY" else 0.5) for y in YEARS for t in _SEM},
    term_expands={f"{y}{t}": [f"{y}{q}" for q in qs] for y in YEARS for t, qs in _SEM.items()},
    rotation_by_school={"NATION_1": {"1@A": 0.25}}, period_by_period={"MISC": 0.0}, period_by_school={"NATION_2": {"2@B": 2.0}},
    bell_default=48.0, bell_by_school={"NATION_3": {"default": 43.0}, "NATION_4": {"default": 90.0, "overrides": {"1@A": 55.0}}},
    utilization_default=5.0, utilization_by_school={"NATION_5": 4.2}, consolidate_max_size=6, exempt_subjects=("Non-Core",))
PR = ScheduleParams(**_TERMS)
EX = ScheduleParams(time_format="expression", recipe=("D_location_id", "D_term", "D_expression", "D_course_section_id"), **_TERMS)

EXCLUSIONS = {
    "C_course_time_exclude": [
        {"col": "C_course_subject_area", "op": "eq", "val": "Untracked"},
        {"col": "C_course_time_of_day", "op": "ne", "val": "During school"},
        {"col": "C_course_format", "op": "eq", "val": "Virtual"},
        {"col": "C_absent_column", "op": "eq", "val": "x"}],
    "C_class_size_and_teacher_load_exclude": [
        {"col": "C_course_subject_area", "op": "in", "val": ["Un-prepped"]},
        {"col": "C_course_format", "op": "not_in", "val": ["Standard"]}]}

# ---------------------------------------------------------------- Spark views


def stu_first(t: Tables) -> DataFrame:
    return t.orders.groupBy("o_custkey").agg(F.min(school_year_of("o_orderdate")).alias("first_year"))


def tr_raw(t: Tables) -> DataFrame:
    ln = F.col("l_linenumber")
    d = (t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
          .join(t.part, F.col("l_partkey") == F.col("p_partkey")).join(stu_first(t), "o_custkey"))
    suffix = (F.when(ln == 1, "S1").when(ln == 3, "-S1").when(ln.isin(2, 4), "S2").when(ln == 5, "DA").when(ln == 6, "DB").otherwise(""))
    course = F.when(~((ln == 7) & (F.col("l_tax") == 0)), F.concat(F.lit("C"), F.col("l_partkey").cast("string"), suffix))
    name = F.concat("p_name", F.when((ln == 7) & (F.col("l_linestatus") == "F"), " S2").otherwise(""), F.when(F.col("l_returnflag") == "R", " *").otherwise(""))
    earn = F.when(F.col("l_discount") == 0.09, F.lit(None)).when(F.col("l_returnflag") == "A", 0.0).when(F.col("l_returnflag") == "N", 0.5).when(
        F.col("l_tax") == 0.08, 3.0).otherwise(1.0)
    d = d.select(
        F.col("o_custkey").alias("D_stu_id"), school_year_of("l_shipdate").alias("D_year"), course.alias("D_course_id"), name.alias("nm"), "first_year",
        F.when(F.col("l_discount") != 0.1, F.col("l_quantity") * 2.3).alias("g"), earn.alias("e"), F.when(F.col("l_discount") == 0, 0.0).otherwise(0.5).alias("p"))
    return d.groupBy("D_stu_id", "D_year", "D_course_id").agg(
        F.min("nm").alias("D_course_name"), F.greatest(F.lit(9), F.least(F.lit(12), 9 + F.col("D_year") - F.min("first_year"))).cast("int").alias("D_stu_grade_level_transcript"),
        F.min("g").alias("D_stu_grade"), F.min("e").alias("D_creds_earn"), F.min("p").alias("D_creds_possible"))


def sp_raw(t: Tables) -> DataFrame:
    sy = school_year_of("o_orderdate")
    d = (t.orders.withColumn("loc", (F.col("o_orderkey") % 25).cast("int")).join(t.nation, F.col("loc") == F.col("n_nationkey"))
          .join(t.customer, F.col("o_custkey") == F.col("c_custkey")).join(stu_first(t), "o_custkey"))
    d = d.select("*", sy.alias("D_year"), F.to_date("o_orderdate").alias("d0"))
    late = (F.col("o_totalprice") < 20000).cast("int")
    text = lambda c: F.date_format(c, "M/d/yyyy")
    out = F.date_add("d0", (F.floor("o_totalprice") % 300).cast("int"))
    return d.select(
        F.col("o_custkey").alias("D_stu_id"), F.col("loc").alias("D_location_id"),
        F.concat(F.lit("24-25 "), "n_name", F.when(F.col("o_orderpriority") == "5-LOW", " CR").otherwise(""), F.lit(" 9-12")).alias("D_location_name"),
        F.greatest(F.lit(9), F.least(F.lit(12), 9 + F.col("D_year") - F.col("first_year")) - late).cast("int").alias("D_stu_grade_level_demo"),
        F.substring("c_mktsegment", 1, 1).alias("D_stu_race"), (F.col("c_acctbal") < 2000).cast("int").alias("D_stu_ell"),
        (F.col("c_acctbal") > 8000).cast("int").alias("D_stu_swd"), F.col("o_orderpriority").isin("1-URGENT", "2-HIGH").cast("int").alias("D_stu_frl"),
        text("d0").alias("D_stu_enter_date"), F.when(F.col("o_orderstatus") != "O", text(out)).alias("D_stu_exit_date"), "D_year")


def _credit(size):
    return (F.when(size <= 15, "Graduation Required").when(size <= 30, "Support & Enrichment").when(size <= 45, "Elective").otherwise("UNSURE"))


def coding(t: Tables) -> DataFrame:
    """Course coding: sizes of 50 are not coded, sizes of 1 are coded under another name."""
    pairs = tr_raw(t).filter("D_course_id is not null").select("D_course_id", "D_course_name").distinct()
    key = F.regexp_extract("D_course_id", r"^C(\d+)", 1).cast("long")
    d = pairs.withColumn("k", key).join(t.part, F.col("k") == F.col("p_partkey")).filter("p_size < 50")
    return d.select(
        "D_course_id", F.concat("D_course_name", F.when(F.col("p_size") == 1, " X").otherwise("")).alias("D_course_name"),
        F.concat(F.lit("K"), F.col("k").cast("string"), F.when((F.col("p_size") == 1) & F.col("D_course_name").contains("*"), "R").otherwise("")).alias("C_course_id"),
        F.col("p_brand").alias("C_course_subject_area"), F.col("p_type").alias("C_course_subject"), _credit(F.col("p_size")).alias("C_course_credit_type"),
        F.when(F.col("p_retailprice") < 1000, "Standard").otherwise("Advanced").alias("C_course_rigor"),
        (F.col("p_size") > 40).cast("int").alias("C_course_epso_flag"), F.col("p_size").between(20, 25).cast("int").alias("C_course_wbl_flag"),
        F.when(F.col("p_size") != 10, (F.col("p_size") < 5).cast("int")).alias("C_course_ic_flag"))


def cs(t: Tables) -> DataFrame:
    """Class schedule. Rows are made distinct as keys and codes, which fix all other columns, and get their texts afterwards; what describes a course is joined last,
    so a wide row is never shuffled."""
    day, tax, flag = F.to_date("l_shipdate"), F.col("l_tax"), F.col("l_returnflag")
    d = t.lineitem.select(
        "l_orderkey", "l_partkey", "l_suppkey", F.col("l_linenumber").alias("ln"), F.when(flag == "A", 0).when(flag == "N", 1).otherwise(2).alias("rk"),
        F.when(tax == 0, 0).when(tax == 0.02, 1).otherwise(2).alias("tk"), F.coalesce(F.col("l_discount") == 0, F.lit(False)).alias("fy"), day.alias("day"),
        F.when(F.col("l_discount") != 0.1, F.col("l_quantity").cast("int")).alias("stay"), F.when(F.col("l_linestatus") == "F", 1).alias("D_active_flag"))
    d = d.join(t.orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey")).drop("l_orderkey", "o_orderkey")
    d = d.join(t.customer.select("c_custkey", (9 + F.col("c_nationkey") % 4).cast("int").alias("D_stu_grade"), (F.col("c_acctbal") < 2000).cast("int").alias("D_stu_ell_flag"),
                                 (F.col("c_acctbal") > 8000).cast("int").alias("D_stu_swd_flag")), F.col("o_custkey") == F.col("c_custkey")).drop("c_custkey").distinct()
    where = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", "s_nationkey", "n_name").distinct()
    size, kind = F.col("p_size"), F.col("p_type")
    area = (F.when((kind == "ECONOMY") & (size > 45), "Untracked").when((kind == "PROMO") & (size > 45), "Un-prepped")
             .when(kind.isin("STANDARD", "MEDIUM", "LARGE"), "Core").otherwise("Non-Core"))
    subject = (F.when(kind == "STANDARD", "English").when(kind == "MEDIUM", "Math").when(kind == "LARGE", "Science")
                .when(kind == "SMALL", "Social Studies").when(kind == "ECONOMY", "PE/Health").otherwise("Advisory"))
    course = t.part.select("p_partkey", F.concat_ws(" ", "p_name", size.cast("string")).alias("name"), area.alias("C_course_subject_area"), subject.alias("C_course_subject"), _credit(size).alias("C_course_credit_type"),
                           F.col("p_brand").alias("C_course_rigor"), F.when(size != 33, "During school").otherwise("After school").alias("C_course_time_of_day"), F.when(size == 50, "Virtual").otherwise("Standard").alias("C_course_format")).distinct()
    d = d.join(where, F.col("l_suppkey") == F.col("s_suppkey")).join(course, F.col("l_partkey") == F.col("p_partkey"))
    ln, rot = F.col("ln"), F.element_at(F.array(*map(F.lit, ("A", "B", "A-B"))), F.col("rk") + 1)
    n = ln.cast("string")
    expr = (F.when(F.col("tk") == 0, F.lit("HOMEROOM"))
             .when(F.col("tk") == 1, F.concat(n, F.lit("(A), "), (8 - ln).cast("string"), F.lit("-"), n, F.lit("(B)")))
             .otherwise(F.concat(n, F.lit("-"), F.least(ln + 1, F.lit(7)).cast("string"), F.lit("("), rot, F.lit(")"))))
    return d.select(
        F.col("o_custkey").alias("D_stu_id"), F.when(F.col("l_suppkey") % 17 != 0, F.col("l_suppkey")).alias("D_employee_id"),
        F.col("s_nationkey").alias("D_location_id"), F.col("n_name").alias("D_location_name"), F.concat(F.lit("K"), F.col("l_partkey").cast("string")).alias("D_course_id"),
        F.col("name").alias("D_course_name"), F.concat_ws("-", F.col("l_suppkey").cast("string"), (F.col("l_partkey") % 2).cast("string")).alias("D_course_section_id"),
        F.when(ln == 7, "MISC").otherwise(n).alias("D_period"), rot.alias("D_rotation"), expr.alias("D_expression"),
        F.concat(F.year("day").cast("string"), F.when(F.col("fy"), "FY").when(F.month("day") >= 8, "S1").otherwise("S2")).alias("D_term"),
        F.date_sub("day", 30).alias("D_stu_enter_date"), F.date_add("day", "stay").alias("D_stu_exit_date"), "D_active_flag", "D_stu_grade", "D_stu_ell_flag", "D_stu_swd_flag",
        "C_course_subject_area", "C_course_subject", F.col("name").alias("C_course_name"), "C_course_credit_type", "C_course_rigor", "C_course_time_of_day", "C_course_format")


def csx(t: Tables) -> DataFrame:
    return apply_exclusions(cs(t), EXCLUSIONS)


def roster(t: Tables) -> DataFrame:
    """Cohort schedule: students by school, class (course group and year) and course."""
    d = (t.lineitem.join(t.orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
          .join(t.customer, F.col("o_custkey") == F.col("c_custkey")).join(t.part, F.col("l_partkey") == F.col("p_partkey")))
    return d.select(
        F.concat(F.lit("S"), F.col("c_nationkey").cast("string")).alias("D_location_name"),
        F.concat_ws("-", (F.col("l_partkey") % 200).cast("string"), F.year("l_shipdate").cast("string")).alias("C_class_id"),
        F.col("o_custkey").cast("string").alias("D_stu_id"), F.col("p_type").alias("C_course_subject"), F.col("p_name").alias("C_course_name"),
        F.col("c_mktsegment").alias("C_inferred_cohort")).distinct()


def grades(t: Tables) -> DataFrame:
    q = F.col("l_quantity")
    d = (t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
          .join(t.part, F.col("l_partkey") == F.col("p_partkey")))
    letter = F.when(q <= 10, "A").when(q <= 20, "B+").when(q <= 30, "C").when(q <= 38, "D").when(q <= 42, "E").when(q <= 48, "F").otherwise("Pass")
    subject = (F.when(F.col("p_type") == "STANDARD", "English").when(F.col("p_type") == "MEDIUM", "Math").when(F.col("p_type") == "LARGE", "Science")
                .when(F.col("p_type") == "SMALL", "Social Studies").otherwise("Art"))
    return d.select(
        F.col("o_custkey").alias("D_stu_id"), F.concat(F.lit("S"), F.col("c_nationkey").cast("string")).alias("D_location_name"),
        (9 + F.col("c_nationkey") % 4).cast("int").alias("D_stu_grade"), F.col("c_mktsegment").alias("D_stu_cohort"), F.col("p_name").alias("D_course_name"),
        F.when(F.col("l_tax") == 0, "TRN Transfer").when(F.col("l_tax") == 0.01, "Credit Recovery").otherwise("Regular").alias("D_course_category"),
        subject.alias("D_course_subject"), F.when(F.col("l_discount") != 0.1, letter).alias("letter"),
        F.when(q <= 48, (q * 2).cast("int").cast("string")).otherwise("n/a").alias("pctg"))


def name_coding(t: Tables) -> DataFrame:
    """Course coding by name: one subject and credit type per course name."""
    d = t.part.groupBy(F.col("p_name").alias("D_course_name")).agg(F.min("p_type").alias("C_course_subject"), (F.min("p_partkey") % 3).alias("k"))
    return d.select("D_course_name", "C_course_subject", F.when(F.col("k") < 2, "Graduation Required").otherwise("Elective").alias("C_course_credit_type"))


def pathways(t: Tables) -> DataFrame:
    d = (t.lineitem.join(t.orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey")).join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
          .join(t.part, F.col("l_partkey") == F.col("p_partkey")))
    return d.select(
        F.col("o_custkey").alias("D_stu_id"), F.concat(F.lit("S"), F.col("c_nationkey").cast("string")).alias("C_four_year_home_school"), F.col("p_brand").alias("pathway"),
        F.col("l_partkey").alias("course_id"), F.when(F.col("p_size") != 50, F.col("p_name")).alias("C_course_name_clean"),
        (F.col("l_linenumber") < 6).alias("valid_combo"), F.when(F.col("l_tax") < 0.07, "Include").otherwise("Exclude").alias("include_flag"),
        (F.col("p_size") > 30).alias("C_course_EPSO_no_IC"), (F.col("c_acctbal") > 3000).alias("C_pure_cohort"))


# ---------------------------------------------------------------- SQL views

_SY = "(year({0}) + (month({0}) >= 8)::INT)::INT"
_SLOTS = "('S1','Q1'),('S1','Q2'),('S2','Q3'),('S2','Q4'),('FY','Q1'),('FY','Q2'),('FY','Q3'),('FY','Q4')"
_SCHOOLS = ", ".join(f"'{s}'" for s in SCHOOLS)
_CREDIT = ("CASE WHEN p_size <= 15 THEN 'Graduation Required' WHEN p_size <= 30 THEN 'Support & Enrichment' "
           "WHEN p_size <= 45 THEN 'Elective' ELSE 'UNSURE' END")

CTES: dict[str, tuple[tuple, str]] = {}


def cte(name: str, deps: str, body: str) -> None:
    CTES[name] = (tuple(deps.split()), body)


cte("stu_first", "", f"SELECT o_custkey, min({_SY.format('o_orderdate')}) AS first_year FROM orders GROUP BY 1")
cte("tr_raw", "stu_first", f"""
SELECT D_stu_id, D_year, D_course_id, min(nm) AS D_course_name, greatest(9, least(12, 9 + D_year - min(first_year)))::INT AS D_stu_grade_level_transcript,
       min(g) AS D_stu_grade, min(e) AS D_creds_earn, min(p) AS D_creds_possible
FROM (SELECT o_custkey AS D_stu_id, {_SY.format('l_shipdate')} AS D_year, first_year,
        CASE WHEN l_linenumber = 7 AND l_tax = 0 THEN NULL ELSE 'C' || l_partkey || CASE l_linenumber WHEN 1 THEN 'S1' WHEN 3 THEN '-S1' WHEN 2 THEN 'S2'
             WHEN 4 THEN 'S2' WHEN 5 THEN 'DA' WHEN 6 THEN 'DB' ELSE '' END END AS D_course_id,
        p_name || CASE WHEN l_linenumber = 7 AND l_linestatus = 'F' THEN ' S2' ELSE '' END || CASE WHEN l_returnflag = 'R' THEN ' *' ELSE '' END AS nm,
        CASE WHEN l_discount = 0.1::DOUBLE THEN NULL ELSE l_quantity * 2.3::DOUBLE END AS g,
        CASE WHEN l_discount = 0.09::DOUBLE THEN NULL WHEN l_returnflag = 'A' THEN 0e0 WHEN l_returnflag = 'N' THEN 5e-1 WHEN l_tax = 0.08::DOUBLE THEN 3e0 ELSE 1e0 END AS e,
        CASE WHEN l_discount = 0 THEN 0e0 ELSE 5e-1 END AS p
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey JOIN stu_first USING (o_custkey)) GROUP BY 1, 2, 3""")
cte("tr_flagged", "tr_raw", r"""
SELECT * EXCLUDE (D_stu_grade, D_creds_earn),
  CASE WHEN regexp_matches(D_course_id, '(?i)S1\s*\*?\s*$') THEN 'Semester 1' WHEN regexp_matches(D_course_id, '(?i)S2\s*\*?\s*$') THEN 'Semester 2'
       WHEN regexp_matches(D_course_id, '(?i)DA\s*\*?\s*$') THEN 'Semester 1' WHEN regexp_matches(D_course_id, '(?i)DB\s*\*?\s*$') THEN 'Semester 2'
       WHEN regexp_matches(D_course_name, '(?i)S1\s*\*?\s*$') THEN 'Semester 1' WHEN regexp_matches(D_course_name, '(?i)S2\s*\*?\s*$') THEN 'Semester 2'
       WHEN regexp_matches(D_course_name, '(?i)DA\s*\*?\s*$') THEN 'Semester 1' WHEN regexp_matches(D_course_name, '(?i)DB\s*\*?\s*$') THEN 'Semester 2' END AS C_term,
  CASE WHEN regexp_matches(D_course_id, '(?i)(S1|S2|DA|DB)\s*\*?\s*$') THEN 'D_course_id'
       WHEN regexp_matches(D_course_name, '(?i)(S1|S2|DA|DB)\s*\*?\s*$') THEN 'D_course_name' END AS C_term_source,
  regexp_replace(D_course_id, '-?(S1|S2|DA|DB)$', '') AS C_course_id_base, trim(D_course_name) AS C_course_name_trimmed,
  contains(D_course_name, '*') AS C_course_name_starred, D_stu_grade AS D_stu_grade_raw,
  CASE WHEN D_stu_grade > 110 OR D_stu_grade < 0 THEN NULL ELSE D_stu_grade END AS D_stu_grade,
  coalesce(D_stu_grade > 100 OR D_stu_grade < 0, false) AS C_grade_above_100, coalesce(D_stu_grade > 110 OR D_stu_grade < 0, false) AS C_grade_not_a_grade,
  coalesce(D_creds_earn > 2, false) OR coalesce(D_creds_possible > 2, false) AS C_creds_out_of_range,
  coalesce(D_creds_earn > D_creds_possible, false) AS C_creds_earn_exceeds_attempted,
  coalesce(D_creds_earn > 2, false) AS C_creds_impossible, CASE WHEN D_creds_earn > 2 THEN NULL ELSE D_creds_earn END AS D_creds_earn
FROM tr_raw""")
cte("tr", "tr_flagged", "SELECT * FROM tr_flagged WHERE D_course_id IS NOT NULL AND trim(D_course_id) <> ''")
cte("sp_raw", "stu_first", f"""
SELECT o_custkey AS D_stu_id, loc AS D_location_id, '24-25 ' || n_name || CASE WHEN o_orderpriority = '5-LOW' THEN ' CR' ELSE '' END || ' 9-12' AS D_location_name,
  greatest(9, least(12, 9 + D_year - first_year) - (o_totalprice < 20000)::INT)::INT AS D_stu_grade_level_demo, c_mktsegment[1] AS D_stu_race,
  (c_acctbal < 2000)::INT AS D_stu_ell, (c_acctbal > 8000)::INT AS D_stu_swd, (o_orderpriority IN ('1-URGENT', '2-HIGH'))::INT AS D_stu_frl,
  strftime(o_orderdate, '%-m/%-d/%Y') AS D_stu_enter_date,
  CASE WHEN o_orderstatus <> 'O' THEN strftime(o_orderdate::DATE + (floor(o_totalprice)::INT % 300), '%-m/%-d/%Y') END AS D_stu_exit_date, D_year
FROM (SELECT *, (o_orderkey % 25)::INT AS loc, {_SY.format('o_orderdate')} AS D_year FROM orders) o
JOIN nation ON loc = n_nationkey JOIN customer ON o_custkey = c_custkey JOIN stu_first USING (o_custkey)""")
cte("sp_days", "sp_raw", """
SELECT * EXCLUDE (D_stu_exit_date), coalesce(D_stu_exit_date, H_year_end) AS D_stu_exit_date, D_stu_exit_date IS NULL AS C_exit_date_imputed,
  coalesce(D_stu_exit_date, H_year_end) < H_year_start AS C_spell_before_window, D_stu_enter_date > H_year_end AS C_spell_after_window,
  greatest(D_stu_enter_date, H_year_start) AS H_enter_clamped, least(coalesce(D_stu_exit_date, H_year_end), H_year_end) AS H_exit_clamped,
  datediff('day', greatest(D_stu_enter_date, H_year_start), least(coalesce(D_stu_exit_date, H_year_end), H_year_end))::INT AS days_raw
FROM (SELECT * EXCLUDE (D_stu_enter_date, D_stu_exit_date), strptime(D_stu_enter_date, '%-m/%-d/%Y')::DATE AS D_stu_enter_date,
        strptime(D_stu_exit_date, '%-m/%-d/%Y')::DATE AS D_stu_exit_date, make_date(D_year - 1, 8, 1) AS H_year_start, make_date(D_year, 6, 30) AS H_year_end FROM sp_raw)""")
cte("sp_loc", "sp_days", r"""
SELECT *, greatest(days_raw, 0)::INT AS M_days_enrolled, CASE WHEN D_location_id = 24 THEN 23 ELSE D_location_id END AS C_location_id,
  CASE WHEN D_location_id = 24 THEN 'NATION_23' ELSE C_location_name END AS C_location_name_merged
FROM (SELECT *, trim(regexp_replace(regexp_replace(regexp_replace(D_location_name, '^\d{2}-\d{2}\s+', ''), '\s+9-12$', ''), '\s+', ' ', 'g')) AS C_location_name FROM sp_days)""")
cte("canon", "sp_loc", """
SELECT C_location_id AS id, C_location_name_merged AS nm FROM (SELECT C_location_id, C_location_name_merged, row_number() OVER (PARTITION BY C_location_id
  ORDER BY count(*) DESC, C_location_name_merged) AS rn FROM sp_loc GROUP BY 1, 2) WHERE rn = 1""")
cte("scope_ids", "sp_loc", f"SELECT DISTINCT C_location_id AS id FROM sp_loc WHERE C_location_name_merged IN ({_SCHOOLS})")
cte("sp", "sp_loc canon scope_ids", """
SELECT sp_loc.* EXCLUDE (D_stu_ell, D_stu_swd, D_stu_frl, days_raw), canon.nm AS C_location_name_canonical, C_location_id IN (SELECT id FROM scope_ids) AS C_school_in_scope,
  'Group ' || D_stu_race AS C_stu_race, D_stu_ell AS C_stu_ell_flag, D_stu_swd AS C_stu_swd_flag, D_stu_frl AS C_stu_poverty_flag
FROM sp_loc JOIN canon ON C_location_id = canon.id""")
cte("coding", "tr_raw", f"""
SELECT D_course_id, D_course_name || CASE WHEN p_size = 1 THEN ' X' ELSE '' END AS D_course_name,
  'K' || p_partkey || CASE WHEN p_size = 1 AND contains(D_course_name, '*') THEN 'R' ELSE '' END AS C_course_id, p_brand AS C_course_subject_area, p_type AS C_course_subject,
  {_CREDIT} AS C_course_credit_type, CASE WHEN p_retailprice < 1000 THEN 'Standard' ELSE 'Advanced' END AS C_course_rigor,
  (p_size > 40)::INT AS C_course_epso_flag, (p_size BETWEEN 20 AND 25)::INT AS C_course_wbl_flag, CASE WHEN p_size <> 10 THEN (p_size < 5)::INT END AS C_course_ic_flag
FROM (SELECT DISTINCT D_course_id, D_course_name FROM tr_raw WHERE D_course_id IS NOT NULL)
JOIN part ON regexp_extract(D_course_id, '^C(\\d+)', 1)::BIGINT = p_partkey WHERE p_size < 50""")
cte("cs", "", f"""
SELECT DISTINCT o_custkey AS D_stu_id, CASE WHEN l_suppkey % 17 <> 0 THEN l_suppkey END AS D_employee_id, s_nationkey AS D_location_id, n_name AS D_location_name,
  'K' || l_partkey AS D_course_id, p_name || ' ' || p_size AS D_course_name, l_suppkey || '-' || (l_partkey % 2) AS D_course_section_id,
  CASE WHEN l_linenumber = 7 THEN 'MISC' ELSE l_linenumber::VARCHAR END AS D_period, rot AS D_rotation,
  CASE WHEN l_tax = 0 THEN 'HOMEROOM' WHEN l_tax = 0.02::DOUBLE THEN l_linenumber || '(A), ' || (8 - l_linenumber) || '-' || l_linenumber || '(B)'
       ELSE l_linenumber || '-' || least(l_linenumber + 1, 7) || '(' || rot || ')' END AS D_expression,
  year(l_shipdate) || CASE WHEN l_discount = 0 THEN 'FY' WHEN month(l_shipdate) >= 8 THEN 'S1' ELSE 'S2' END AS D_term,
  l_shipdate::DATE - 30 AS D_stu_enter_date, CASE WHEN l_discount <> 0.1::DOUBLE THEN l_shipdate::DATE + l_quantity::INT END AS D_stu_exit_date,
  CASE WHEN l_linestatus = 'F' THEN 1 END AS D_active_flag, (9 + c_nationkey % 4)::INT AS D_stu_grade, (c_acctbal < 2000)::INT AS D_stu_ell_flag, (c_acctbal > 8000)::INT AS D_stu_swd_flag,
  CASE WHEN p_type = 'ECONOMY' AND p_size > 45 THEN 'Untracked' WHEN p_type = 'PROMO' AND p_size > 45 THEN 'Un-prepped' WHEN p_type IN ('STANDARD', 'MEDIUM', 'LARGE') THEN 'Core' ELSE 'Non-Core' END AS C_course_subject_area,
  CASE p_type WHEN 'STANDARD' THEN 'English' WHEN 'MEDIUM' THEN 'Math' WHEN 'LARGE' THEN 'Science' WHEN 'SMALL' THEN 'Social Studies' WHEN 'ECONOMY' THEN 'PE/Health' ELSE 'Advisory' END AS C_course_subject,
  p_name || ' ' || p_size AS C_course_name, {_CREDIT} AS C_course_credit_type, p_brand AS C_course_rigor,
  CASE WHEN p_size <> 33 THEN 'During school' ELSE 'After school' END AS C_course_time_of_day, CASE WHEN p_size = 50 THEN 'Virtual' ELSE 'Standard' END AS C_course_format
FROM (SELECT *, CASE l_returnflag WHEN 'A' THEN 'A' WHEN 'N' THEN 'B' ELSE 'A-B' END AS rot FROM lineitem) l JOIN orders ON l_orderkey = o_orderkey
JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey JOIN part ON l_partkey = p_partkey JOIN customer ON o_custkey = c_custkey""")
cte("csx", "cs", """
SELECT *, CASE WHEN C_course_subject_area = 'Untracked' OR C_course_time_of_day <> 'During school' OR C_course_format = 'Virtual' THEN 'Exclude' ELSE 'Include' END AS C_course_time_exclude,
  CASE WHEN C_course_subject_area = 'Un-prepped' OR C_course_format <> 'Standard' THEN 'Exclude' ELSE 'Include' END AS C_class_size_and_teacher_load_exclude FROM cs""")
cte("terms", "", f"SELECT y::INT || s AS D_term, y::INT || q AS slot, 25e-2 AS tw FROM range(1995, 2002) r(y), (VALUES {_SLOTS}) v(s, q)")
cte("mt_pr", "cs", """
SELECT DISTINCT D_period, D_rotation, D_period AS per, unnest(CASE WHEN D_rotation = 'A-B' THEN ['A', 'B'] ELSE [D_rotation] END) AS rot FROM cs""")
cte("mt_ex", "cs", r"""
SELECT DISTINCT D_expression, unnest(range(least(a, b), greatest(a, b) + 1))::VARCHAR AS per, rot FROM (
  SELECT D_expression, a, b, unnest(CASE WHEN rp = 'A-B' THEN ['A', 'B'] ELSE [rp] END) AS rot FROM (
    SELECT D_expression, regexp_extract(blk, '^(\d+)', 1)::INT AS a, coalesce(nullif(regexp_extract(blk, '^\d+-(\d+)', 1), ''), regexp_extract(blk, '^(\d+)', 1))::INT AS b,
           regexp_extract(blk, '\((.*)\)', 1) AS rp
    FROM (SELECT D_expression, unnest(regexp_split_to_array(D_expression, '[,\s]+')) AS blk FROM (SELECT DISTINCT D_expression FROM cs)) WHERE regexp_matches(blk, '^.+\(.*\)$')))""")
_ROT = "CASE WHEN D_location_name = 'NATION_1' AND per || '@' || rot = '1@A' THEN 25e-2 ELSE 5e-1 END"
_PER = "CASE WHEN per = 'MISC' THEN 0e0 WHEN D_location_name = 'NATION_2' AND per || '@' || rot = '2@B' THEN 2e0 ELSE 1e0 END"
_BELL = "CASE WHEN D_location_name = 'NATION_3' THEN 43e0 WHEN D_location_name = 'NATION_4' THEN CASE WHEN per || '@' || rot = '1@A' THEN 55e0 ELSE 90e0 END ELSE 48e0 END"


def _weighed(tag: str, keys: str, recipe: str) -> None:
    on = " AND ".join(f"m.{k} = x.{k}" for k in keys.split())
    cte(f"wt_{tag}", f"csx mt_{tag}", f"""
SELECT {', '.join('x.' + k for k in keys.split())}, D_location_name, coalesce(sum(CASE WHEN per IS NOT NULL THEN ({_ROT}) * ({_PER}) END), 0e0) AS rp,
  coalesce(sum(CASE WHEN per IS NOT NULL THEN {_BELL} END), 0e0) AS mins
FROM (SELECT DISTINCT {keys.replace(' ', ', ')}, D_location_name FROM csx) x LEFT JOIN mt_{tag} m ON {on} GROUP BY ALL""")
    using = ", ".join(keys.split() + ["D_location_name"])
    cte(f"we_{tag}", f"csx wt_{tag}", f"""
SELECT csx.*, {recipe} AS C_class_id, mins AS M_cls_class_minutes, round_even((CASE WHEN D_term LIKE '%FY' THEN 1e0 ELSE 5e-1 END) * rp, 4) AS M_cls_class_weight,
  row_number() OVER () AS rid FROM csx JOIN wt_{tag} USING ({using})""")
    cte(f"xp_{tag}", f"we_{tag} mt_{tag} terms", f"""
SELECT x.*, per, rot, slot, round_even(tw * ({_ROT}) * ({_PER}), 4) AS w FROM (SELECT * FROM we_{tag}) x LEFT JOIN mt_{tag} m ON {on}
LEFT JOIN terms ON x.D_term = terms.D_term""".replace("({_ROT})", f"(coalesce({_ROT}, 5e-1))"))
    # flags: class id at slot level, same-course adjuster, student and teacher sums
    cte(f"f0_{tag}", f"xp_{tag}", f"""
SELECT *, D_location_id || '_' || D_course_section_id || '_' || slot || '_' || coalesce(per, 'NA') || '_' || coalesce(rot, 'NA') AS cid FROM xp_{tag}
WHERE C_course_time_exclude = 'Include' AND C_class_size_and_teacher_load_exclude = 'Include'""")
    cte(f"f1_{tag}", f"f0_{tag}", f"SELECT *, w / count(*) OVER (PARTITION BY cid, D_stu_id) AS adj FROM f0_{tag}")
    cte(f"fs_{tag}", f"f1_{tag}", f"""
SELECT D_location_id, D_stu_id, slot, rot, per, max((t > w + 1e-9)::INT) AS sf FROM (
  SELECT D_location_id, D_stu_id, slot, rot, per, w, sum(adj) AS t FROM f1_{tag} GROUP BY ALL) GROUP BY ALL""")
    cte(f"ft_{tag}", f"f1_{tag}", f"""
SELECT D_location_id, D_employee_id, slot, rot, per, max((t > w + 1e-9)::INT) AS tf FROM (
  SELECT D_location_id, D_employee_id, slot, rot, per, w, sum(c) AS t FROM (
    SELECT D_location_id, D_employee_id, slot, rot, per, w, cid, max(adj) AS c FROM f1_{tag} GROUP BY ALL) GROUP BY ALL) GROUP BY ALL""")
    same = lambda a, b, ks: " AND ".join(f"{a}.{k} IS NOT DISTINCT FROM {b}.{k}" for k in ks.split())
    cte(f"fl_{tag}", f"f1_{tag} fs_{tag} ft_{tag}", f"""
SELECT *, max(tf) OVER (PARTITION BY cid) AS ct, max(sf) OVER (PARTITION BY cid) AS cst, greatest(max(tf) OVER (PARTITION BY cid), max(sf) OVER (PARTITION BY cid)) AS cdb,
  min(sf) OVER (PARTITION BY cid) AS c100
FROM (SELECT f1_{tag}.*, sf, tf FROM f1_{tag} JOIN fs_{tag} s ON {same(f'f1_{tag}', 's', 'D_location_id D_stu_id slot rot per')}
      JOIN ft_{tag} t ON {same(f'f1_{tag}', 't', 'D_location_id D_employee_id slot rot per')})""")
    cte(f"db_{tag}", f"fl_{tag}", f"SELECT * FROM fl_{tag} WHERE cdb = 1")
    cte(f"pc_{tag}", f"db_{tag}", f"""
SELECT d.*, n100 / n AS tprp, CASE WHEN n100 = n THEN n100 ELSE 1 END AS n_split, adj / CASE WHEN n100 = n THEN n100 ELSE 1 END AS w_class
FROM db_{tag} d JOIN (SELECT D_stu_id, slot, rot, per, count(DISTINCT cid) AS n, count(DISTINCT CASE WHEN c100 = 1 THEN cid END) AS n100 FROM db_{tag} GROUP BY ALL) t
ON {same('d', 't', 'D_stu_id slot rot per')}""")
    # sections of one teacher sharing a slot: transitive closure of the smallest section id
    cte(f"ss_{tag}", f"db_{tag}", f"""
SELECT DISTINCT C_class_id AS sec, D_employee_id AS tch, D_location_id AS loc, D_term AS trm, slot, per, rot,
  CASE WHEN D_employee_id IS NULL THEN 'none|' || C_class_id ELSE D_employee_id || '|' || slot || '|' || coalesce(per, 'NA') || '|' || coalesce(rot, 'NA') END AS sk FROM db_{tag}""")
    cte(f"ed_{tag}", f"ss_{tag}", f"SELECT DISTINCT a.sec AS s, b.sec AS t FROM (SELECT DISTINCT sec, sk FROM ss_{tag}) a JOIN (SELECT DISTINCT sec, sk FROM ss_{tag}) b USING (sk)")
    cte(f"rc_{tag}", f"ed_{tag}", f"SELECT s, t FROM ed_{tag} UNION SELECT r.s, e.t FROM rc_{tag} r JOIN ed_{tag} e ON r.t = e.s")
    cte(f"cm_{tag}", f"rc_{tag}", f"SELECT s AS sec, min(t) AS comp FROM rc_{tag} GROUP BY 1")
    cte(f"mx_{tag}", f"ss_{tag} cm_{tag}", f"""
SELECT comp, string_agg(CASE WHEN a IS NULL THEN t WHEN a = b THEN a::VARCHAR ELSE a || '-' || b END || '(' || label || ')', ', ' ORDER BY (a IS NULL), a, label, t) AS expr FROM (
  SELECT comp, label, min(n) AS a, max(n) AS b, min(per) AS t FROM (
    SELECT *, CASE WHEN n IS NULL THEN 't' || per ELSE (n - row_number() OVER (PARTITION BY comp, label ORDER BY n NULLS LAST))::VARCHAR END AS isl FROM (
      SELECT comp, per, try_cast(per AS INT) AS n, string_agg(DISTINCT rot, '-' ORDER BY rot) AS label FROM ss_{tag} JOIN cm_{tag} USING (sec)
      WHERE per IS NOT NULL AND rot IS NOT NULL GROUP BY 1, 2)) GROUP BY comp, label, isl) GROUP BY comp""")
    cte(f"mp_{tag}", f"ss_{tag} cm_{tag} mx_{tag}", f"""
SELECT cm.sec, cm.comp, n_sections, expr, CASE WHEN n_sections > 1 THEN 'CONS_' || anchor.l || '_' || coalesce(anchor.t::VARCHAR, 'NA') || '_' || coalesce(replace(expr, ', ', '+'), 'NA') || '_' || anchor.r END AS cons
FROM cm_{tag} cm JOIN (SELECT comp, count(*) AS n_sections FROM cm_{tag} GROUP BY 1) USING (comp) LEFT JOIN mx_{tag} USING (comp)
JOIN (SELECT comp, a.l, a.t, a.r FROM (SELECT comp, min({{'l': loc, 't': coalesce(tch, -1), 'r': trm}}) AS a FROM ss_{tag} JOIN cm_{tag} USING (sec) GROUP BY 1)) anchor USING (comp)""")
    cte(f"rs_{tag}", f"pc_{tag} mp_{tag}", f"""
SELECT d.*, CASE WHEN tprp = 1 THEN 1 ELSE n_pt END AS split2, w_class / CASE WHEN tprp = 1 THEN 1 ELSE n_pt END AS w_stu,
  1e0 / CASE WHEN tprp = 1 THEN n_split ELSE n_pt END AS cnt FROM (SELECT p.*, coalesce(cons, sec) AS pt, cons, expr FROM pc_{tag} p JOIN mp_{tag} ON p.C_class_id = sec) d
JOIN (SELECT D_stu_id, slot, rot, per, count(DISTINCT coalesce(cons, sec)) AS n_pt FROM pc_{tag} p JOIN mp_{tag} ON p.C_class_id = sec GROUP BY ALL) n
ON {same('d', 'n', 'D_stu_id slot rot per')}""")
    cte(f"lo_{tag}", f"rs_{tag}", f"""
SELECT pt, D_employee_id, count(DISTINCT D_stu_id) AS n_students, bool_and(C_course_subject_area = 'Non-Core') AS all_exempt,
  count(DISTINCT D_stu_id) > 6 AND NOT bool_and(C_course_subject_area = 'Non-Core') AS load_off FROM rs_{tag} WHERE pt LIKE 'CONS\\_%' ESCAPE '\\' GROUP BY 1, 2""")
    cte(f"un_{tag}", f"rs_{tag} we_{tag} lo_{tag}", f"""
SELECT *, CASE WHEN C_class_size_exclude = 'Exclude' OR D_employee_id IN (SELECT D_employee_id FROM lo_{tag} WHERE load_off AND D_employee_id IS NOT NULL) THEN 'Exclude' ELSE 'Include' END AS C_teacher_load_exclude FROM (
  SELECT true AS resolved, D_stu_id, D_employee_id, D_location_id, D_location_name, D_stu_grade, D_stu_ell_flag, D_stu_swd_flag, C_course_subject_area, C_course_subject, C_course_name, C_course_credit_type, C_course_rigor, C_course_time_exclude,
    pt AS C_class_id, slot AS D_term, coalesce(per, D_period) AS D_period, coalesce(rot, D_rotation) AS D_rotation, per, rot, w_stu AS M_class_weight, M_cls_class_weight, cnt, C_class_size_and_teacher_load_exclude AS C_class_size_exclude FROM rs_{tag}
  UNION ALL SELECT false, D_stu_id, D_employee_id, D_location_id, D_location_name, D_stu_grade, D_stu_ell_flag, D_stu_swd_flag, C_course_subject_area, C_course_subject, C_course_name, C_course_credit_type, C_course_rigor, C_course_time_exclude,
    C_class_id, D_term, D_period, D_rotation, NULL, NULL, M_cls_class_weight, M_cls_class_weight, 1e0, C_class_size_and_teacher_load_exclude FROM we_{tag} WHERE rid NOT IN (SELECT rid FROM rs_{tag}))""")


_weighed("pr", "D_period D_rotation", "D_location_id || '_' || D_term || '_' || D_period || '_' || D_course_section_id")
_weighed("ex", "D_expression", "D_location_id || '_' || D_term || '_' || D_expression || '_' || D_course_section_id")

# names of a class: those that are no whole-word part of another, the words they all begin with, and what follows
cte("class_names", "un_pr", r"SELECT DISTINCT C_class_id, trim(regexp_replace(C_course_name, '\s+', ' ', 'g')) AS nm FROM un_pr WHERE trim(C_course_name) <> ''")
cte("kept_names", "class_names", """
SELECT *, string_split(nm, ' ') AS w FROM class_names a WHERE NOT EXISTS (SELECT 1 FROM class_names b WHERE b.C_class_id = a.C_class_id AND b.nm <> a.nm AND contains(' ' || b.nm || ' ', ' ' || a.nm || ' '))""")
cte("name_ends", "kept_names", """
SELECT k.C_class_id, f, n, array_to_string(w[n + 1:], ' ') AS rest FROM kept_names k JOIN (
  SELECT *, coalesce(list_min(list_filter(range(1, least(len(f), len(l)) + 1), lambda i: f[i] <> l[i])) - 1, least(len(f), len(l))) AS n FROM (SELECT C_class_id, min(w) AS f, max(w) AS l FROM kept_names GROUP BY 1)) e USING (C_class_id)""")

cte("roster", "", """
SELECT DISTINCT 'S' || c_nationkey AS D_location_name, (l_partkey % 200) || '-' || year(l_shipdate) AS C_class_id, o_custkey::VARCHAR AS D_stu_id, p_type AS C_course_subject,
  p_name AS C_course_name, c_mktsegment AS C_inferred_cohort FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN part ON l_partkey = p_partkey""")
cte("cr", "roster", "SELECT DISTINCT D_location_name, C_class_id, D_stu_id, C_inferred_cohort FROM roster")
cte("prs", "cr", """
SELECT a.D_location_name, a.D_stu_id AS D_stu_id_1, b.D_stu_id AS D_stu_id_2, count(*) AS M_shared_classes FROM cr a JOIN cr b
ON a.D_location_name = b.D_location_name AND a.C_class_id = b.C_class_id AND a.D_stu_id < b.D_stu_id GROUP BY ALL""")
cte("grades", "", """
SELECT o_custkey AS D_stu_id, 'S' || c_nationkey AS D_location_name, (9 + c_nationkey % 4)::INT AS D_stu_grade, c_mktsegment AS D_stu_cohort, p_name AS D_course_name,
  CASE WHEN l_tax = 0 THEN 'TRN Transfer' WHEN l_tax = 0.01::DOUBLE THEN 'Credit Recovery' ELSE 'Regular' END AS D_course_category,
  CASE p_type WHEN 'STANDARD' THEN 'English' WHEN 'MEDIUM' THEN 'Math' WHEN 'LARGE' THEN 'Science' WHEN 'SMALL' THEN 'Social Studies' ELSE 'Art' END AS D_course_subject,
  CASE WHEN l_discount <> 0.1::DOUBLE THEN CASE WHEN l_quantity <= 10 THEN 'A' WHEN l_quantity <= 20 THEN 'B+' WHEN l_quantity <= 30 THEN 'C' WHEN l_quantity <= 38 THEN 'D'
    WHEN l_quantity <= 42 THEN 'E' WHEN l_quantity <= 48 THEN 'F' ELSE 'Pass' END END AS letter,
  CASE WHEN l_quantity <= 48 THEN (l_quantity * 2)::INT::VARCHAR ELSE 'n/a' END AS pctg
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN part ON l_partkey = p_partkey""")
cte("name_coding", "", """
SELECT p_name AS D_course_name, min(p_type) AS C_course_subject, CASE WHEN min(p_partkey) % 3 < 2 THEN 'Graduation Required' ELSE 'Elective' END AS C_course_credit_type FROM part GROUP BY 1""")
cte("graded", "grades name_coding", "SELECT g.*, (D_course_category = 'Credit Recovery')::INT AS D_course_credit_recovery, C_course_subject, C_course_credit_type FROM grades g LEFT JOIN name_coding USING (D_course_name)")
cte("pathways", "", """
SELECT o_custkey AS D_stu_id, 'S' || c_nationkey AS C_four_year_home_school, p_brand AS pathway, l_partkey AS course_id, CASE WHEN p_size <> 50 THEN p_name END AS C_course_name_clean,
  l_linenumber < 6 AS valid_combo, CASE WHEN l_tax < 0.07::DOUBLE THEN 'Include' ELSE 'Exclude' END AS include_flag, p_size > 30 AS C_course_EPSO_no_IC, c_acctbal > 3000 AS C_pure_cohort
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN part ON l_partkey = p_partkey""")

# student-year, cohort
cte("bys", "sp", """
SELECT D_stu_id, D_year, C_location_id, sum(M_days_enrolled)::BIGINT AS days_at_school, count(*) AS n_spells, min(D_stu_enter_date) AS first_enter, max(D_stu_exit_date) AS last_exit,
  bool_or(C_school_in_scope) AS in_scope FROM sp GROUP BY 1, 2, 3""")
cte("home", "bys", """
SELECT D_stu_id, D_year, C_location_id AS C_home_school_id, days_at_school AS C_home_school_days, in_scope AS C_home_school_in_scope FROM (
  SELECT *, row_number() OVER (PARTITION BY D_stu_id, D_year ORDER BY days_at_school DESC, in_scope DESC, C_location_id) AS rn FROM bys) WHERE rn = 1""")
cte("hsp", "sp home", """
SELECT D_stu_id, D_year, D_stu_grade_level_demo AS C_stu_grade_level, C_location_name_canonical AS C_home_school_name FROM (
  SELECT sp.*, row_number() OVER (PARTITION BY sp.D_stu_id, sp.D_year ORDER BY M_days_enrolled DESC, D_stu_enter_date, D_stu_grade_level_demo, C_location_name_canonical) AS rn
  FROM sp JOIN home ON sp.D_stu_id = home.D_stu_id AND sp.D_year = home.D_year AND C_location_id = C_home_school_id) WHERE rn = 1""")
cte("sy", "sp home hsp", """
SELECT a.*, home.* EXCLUDE (D_stu_id, D_year), C_stu_grade_level, C_home_school_name FROM (
  SELECT D_stu_id, D_year, sum(M_days_enrolled)::BIGINT AS M_days_enrolled_year, count(*) AS n_spells, count(DISTINCT C_location_id) AS n_schools, min(C_stu_race) AS C_stu_race,
    count(DISTINCT C_stu_race) AS n_races, max(C_stu_ell_flag) AS C_stu_ell_flag, max(C_stu_swd_flag) AS C_stu_swd_flag, max(C_stu_poverty_flag) AS C_stu_poverty_flag,
    bool_and(C_exit_date_imputed) AS C_exit_date_imputed FROM sp GROUP BY 1, 2) a
JOIN home USING (D_stu_id, D_year) JOIN hsp USING (D_stu_id, D_year)""")
cte("ent", "sy", "SELECT * FROM sy WHERE D_year = 1996 AND C_stu_grade_level = 9")
cte("crow", "sy ent", """
SELECT sy.*, 9 + D_year - 1996 AS grade_expected, C_stu_grade_level = 9 + D_year - 1996 AS on_grade FROM sy
WHERE D_year BETWEEN 1996 AND 1999 AND D_stu_id IN (SELECT D_stu_id FROM ent)""")
cte("crit", "crow", """
SELECT *, CASE WHEN C_met_years AND C_met_duration AND C_met_progression AND C_met_school THEN 'include' ELSE 'exclude' END AS C_stu_cohort,
  CASE WHEN NOT C_met_years THEN 'Not enrolled in all required years' WHEN NOT C_met_duration THEN 'Did not meet duration'
       WHEN NOT C_met_progression THEN 'Did not progress on grade' WHEN NOT C_met_school THEN 'Left the in-scope schools' END AS C_cohort_exclusion_reason
FROM (SELECT D_stu_id, count(*) = 4 AS C_met_years, count(*) = 4 AND count(*) FILTER (M_days_enrolled_year >= 20) = 4 AS C_met_duration,
        count(*) = 4 AND count(*) FILTER (on_grade) = 4 AS C_met_progression, bool_or(C_home_school_in_scope) AS C_met_school FROM crow GROUP BY 1)""")
cte("coh", "crow crit ent", """
SELECT s.D_stu_id, s.C_home_school_id AS C_cohort_school_id, s.C_home_school_name AS C_cohort_school_name, n AS C_multiple_home_schools, n > 1 AS C_multiple_home_schools_flag,
  ent.C_stu_race, ent.C_stu_ell_flag, ent.C_stu_swd_flag, ent.C_stu_poverty_flag, 1996 AS C_cohort_entry_year, true AS C_cohort_include
FROM (SELECT D_stu_id, C_home_school_id, C_home_school_name, row_number() OVER (PARTITION BY D_stu_id ORDER BY C_home_school_days DESC, D_year) AS rn FROM crow) s
JOIN (SELECT D_stu_id, count(DISTINCT C_home_school_id) AS n FROM crow GROUP BY 1) USING (D_stu_id) JOIN ent USING (D_stu_id)
WHERE rn = 1 AND D_stu_id IN (SELECT D_stu_id FROM crit WHERE C_stu_cohort = 'include')""")
cte("mob", "sy", """
SELECT D_stu_id, bool_or(n_schools > 1) AS C_transferred_within_year, bool_or(coalesce(prev <> C_home_school_id, false)) AS C_transferred_across_years,
  NOT bool_or(n_schools > 1) AND NOT bool_or(coalesce(prev <> C_home_school_id, false)) AS C_pure_cohort
FROM (SELECT *, lag(C_home_school_id) OVER (PARTITION BY D_stu_id ORDER BY D_year) AS prev FROM sy) GROUP BY 1""")
cte("snap", "sy", """
SELECT D_stu_id, ok_grade, ok_school, ok_load, ok_grade AND ok_school AND ok_load AS selected FROM (
  SELECT D_stu_id, C_stu_grade_level IN (9, 10, 11, 12) AS ok_grade, C_home_school_in_scope AS ok_school, M_days_enrolled_year >= 60 AS ok_load FROM sy WHERE D_year = 1998)""")
cte("coded", "tr coding", """
SELECT tr.*, coalesce(a.C_course_id, b.C_course_id) AS C_course_id, coalesce(a.C_course_subject_area, b.C_course_subject_area) AS C_course_subject_area,
  coalesce(a.C_course_subject, b.C_course_subject) AS C_course_subject, coalesce(a.C_course_credit_type, b.C_course_credit_type) AS C_course_credit_type,
  coalesce(a.C_course_rigor, b.C_course_rigor) AS C_course_rigor, CASE WHEN a.D_course_id IS NOT NULL THEN a.C_course_epso_flag ELSE b.C_course_epso_flag END AS C_course_epso_flag,
  CASE WHEN a.D_course_id IS NOT NULL THEN a.C_course_wbl_flag ELSE b.C_course_wbl_flag END AS C_course_wbl_flag,
  CASE WHEN a.D_course_id IS NOT NULL THEN a.C_course_ic_flag ELSE b.C_course_ic_flag END AS C_course_ic_flag,
  CASE WHEN a.D_course_id IS NOT NULL THEN 'id_and_name' WHEN b.D_course_id IS NOT NULL THEN 'id_only' END AS C_coding_source
FROM tr LEFT JOIN coding a ON tr.D_course_id = a.D_course_id AND tr.D_course_name = a.D_course_name
LEFT JOIN (SELECT * FROM (SELECT *, count(*) OVER (PARTITION BY D_course_id) AS nn, row_number() OVER (PARTITION BY D_course_id ORDER BY D_course_name) AS rn,
   min(C_course_id) OVER (PARTITION BY D_course_id) = max(C_course_id) OVER (PARTITION BY D_course_id) AS one FROM coding) WHERE one AND rn = 1) b ON tr.D_course_id = b.D_course_id""")


def with_views(body: str, views: str) -> str:
    """A statement with the CTEs it needs, dependencies first."""
    order: list[str] = []

    def visit(v: str) -> None:
        if v not in order:
            for d in CTES[v][0]:
                visit(d)
            order.append(v)
    for v in views.split():
        visit(v)
    if not order:
        return body.strip()
    heads = ",\n".join(f"{v} AS {'' if v.startswith('rc_') else 'MATERIALIZED '}({CTES[v][1].strip()})" for v in order)
    return f"WITH RECURSIVE {heads}\n{body.strip()}"
