"""Spells to student-years: home school, flags, grade level."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.nullsafe import attach, count_where, flag, join_same, pct_known, ratio, top_row
from .aggregates import with_medians
from .joins import join_checked

ID_YEAR = ["D_stu_id", "D_year"]
FLAGS = ("C_stu_ell_flag", "C_stu_swd_flag", "C_stu_poverty_flag")


def spells_by_school(spells: DataFrame, days_rule: str = "sum_of_spells") -> DataFrame:
    """Student-school-year: days, spells, first entry, last exit, any spell in scope.

    ``span`` counts first entry to last exit instead of adding the spells.
    """
    out = spells.groupBy(*ID_YEAR, "C_location_id").agg(
        F.sum("M_days_enrolled").alias("days_at_school"), F.count(F.lit(1)).alias("n_spells"), F.min("D_stu_enter_date").alias("first_enter"),
        F.max("D_stu_exit_date").alias("last_exit"), F.bool_or("C_school_in_scope").alias("in_scope"))
    if days_rule == "span":
        return out.withColumn("days_at_school", F.datediff("last_exit", "first_enter").cast("long"))
    if days_rule != "sum_of_spells":
        raise ValueError(f"unknown days rule: {days_rule}")
    return out


def home_school(by_school: DataFrame, rule: str = "most_days", tiebreak: str = "prefer_included") -> DataFrame:
    """One school per student-year.

    ``rule``: most_days | first_spell | last_spell. ``tiebreak``: prefer_included | earliest | lowest_id.
    The last tie key is always the lowest location id.
    """
    first = {"most_days": -F.col("days_at_school"), "first_spell": F.datediff("first_enter", F.lit("1970-01-01")),
             "last_spell": -F.datediff("last_exit", F.lit("1970-01-01"))}
    ties = {"prefer_included": -F.col("in_scope").cast("int"), "earliest": F.datediff("first_enter", F.lit("1970-01-01")), "lowest_id": F.lit(0)}
    if rule not in first or tiebreak not in ties:
        raise ValueError(f"unknown home school rule: {rule}, {tiebreak}")
    return top_row(by_school, ID_YEAR, [first[rule], ties[tiebreak]], ["C_location_id", "days_at_school", "in_scope"]).withColumnsRenamed(
        {"C_location_id": "C_home_school_id", "days_at_school": "C_home_school_days", "in_scope": "C_home_school_in_scope"})


def home_share(home: DataFrame, by_school: DataFrame) -> DataFrame:
    """How much of the year is spent at the home school. One row."""
    total = by_school.groupBy(*ID_YEAR).agg(F.sum("days_at_school").alias("t"))
    s = join_same(home, total, ID_YEAR).withColumn("share", F.when(F.col("t") > 0, ratio("C_home_school_days", "t")))
    out = s.agg(F.count(F.lit(1)).alias("student_years"), pct_known(F.col("share") >= 0.999).alias("pct_home_school_100"), pct_known(F.col("share") < 0.75).alias("pct_home_school_lt75"))
    out = with_medians(out, s, [], {"share": "median_share"})
    return out.select("student_years", F.bround("median_share", 3).alias("median_share"), "pct_home_school_100", "pct_home_school_lt75")


def home_spells(spells: DataFrame, home: DataFrame) -> DataFrame:
    """The longest spell at the home school, per student-year (earliest entry first, then grade)."""
    at_home = join_same(spells, home.select(*ID_YEAR, "C_home_school_id"), ID_YEAR, "inner").filter("C_location_id = C_home_school_id")
    return top_row(at_home, ID_YEAR, [-F.col("M_days_enrolled"), F.col("D_stu_enter_date")],
                   ["D_stu_grade_level_demo", "C_location_name_canonical", *FLAGS])


def collapse_years(spells: DataFrame, home: DataFrame, flag_rule: str = "any", grade_rule: str = "home_school") -> DataFrame:
    """Student-year table. ``flag_rule``: any | home_school. ``grade_rule``: home_school | modal | max.

    Where a student-year has several races the smallest is kept and ``n_races`` says so.
    """
    kinds = lambda c: F.size(F.collect_set(F.struct(c))).cast("bigint")  # a student's values in a year are few; distinct counts would repeat every spell for each of them
    agg = spells.groupBy(*ID_YEAR).agg(
        F.sum("M_days_enrolled").alias("M_days_enrolled_year"), F.count(F.lit(1)).alias("n_spells"), kinds("C_location_id").alias("n_schools"),
        F.min("C_stu_race").alias("C_stu_race"), kinds("C_stu_race").alias("n_races"), *[F.max(f).alias(f) for f in FLAGS],
        F.bool_and("C_exit_date_imputed").alias("C_exit_date_imputed"), F.max("D_stu_grade_level_demo").alias("__max_grade"))
    out = join_checked(agg, home, ID_YEAR, "home school onto student-year")
    hs = home_spells(spells, home).withColumnsRenamed({f: f"__{f}" for f in FLAGS}).withColumnsRenamed(
        {"D_stu_grade_level_demo": "C_stu_grade_level", "C_location_name_canonical": "C_home_school_name"})
    out = join_same(out, hs, ID_YEAR)
    if flag_rule == "home_school":
        out = out.withColumns({f: F.col(f"__{f}") for f in FLAGS})
    elif flag_rule != "any":
        raise ValueError(f"unknown flag rule: {flag_rule}")
    if grade_rule == "max":
        out = out.withColumn("C_stu_grade_level", F.col("__max_grade"))
    elif grade_rule == "modal":
        from .joins import modal_value
        m = modal_value(spells, ID_YEAR, "D_stu_grade_level_demo", "__modal").select(*ID_YEAR, "__modal")
        out = join_same(out, m, ID_YEAR).withColumn("C_stu_grade_level", F.col("__modal")).drop("__modal")
    elif grade_rule != "home_school":
        raise ValueError(f"unknown grade level rule: {grade_rule}")
    return out.drop("__max_grade", *[f"__{f}" for f in FLAGS])


def student_year_gates(sy: DataFrame) -> DataFrame:
    from .checks import gates, unique
    g = gates(sy, {"home school is known": F.col("C_home_school_id").isNotNull(), "grade level is known": F.col("C_stu_grade_level").isNotNull(),
                   "home days within days enrolled": F.col("C_home_school_days") <= F.col("M_days_enrolled_year")})
    return g.unionByName(unique(sy, ID_YEAR, "one row per student-year").result())
