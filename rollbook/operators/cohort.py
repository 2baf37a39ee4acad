"""Longitudinal cohort, snapshot selection, analysis flags and exports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.nullsafe import attach, count_where, flag, is_in, join_same, n_distinct, not_in, pct, pct_where, sum0, top_row
from .aggregates import with_medians
from .joins import companion, join_checked
from .ordered import dominant

ID = "D_stu_id"
YEAR = "D_year"


def required_years(rule: str, years) -> list[int]:
    ys = sorted(set(years))
    if rule == "all_years":
        return ys
    if rule == "bookends":
        return sorted({ys[0], ys[-1]})
    if rule == "none":
        return []
    raise ValueError(f"unknown year rule: {rule}")


def year_rule(by_year: DataFrame, ok, rule: str, years, id_col: str = ID, year_col: str = YEAR, out: str = "passes") -> DataFrame:
    """One verdict per id: present and ok in every required year."""
    need = required_years(rule, years)
    if not need:
        return by_year.select(id_col).distinct().withColumn(out, F.lit(True))
    k = F.lit(len(need))
    return by_year.filter(F.col(year_col).isin(need)).groupBy(id_col).agg(
        (n_distinct(year_col) == k).alias("__p"), (count_where(ok) == k).alias("__o")).select(id_col, (F.col("__p") & F.col("__o")).alias(out))


def funnel_report(criteria: DataFrame, steps: dict[str, Column], start: str = "starting universe", benchmark: float | None = None) -> DataFrame:
    """Attrition per step from one row per id with its verdicts, in one pass.

    Survivors of a step are those that pass it and every step before.
    """
    kept, aggs = F.lit(True), [F.count(F.lit(1)).alias("n0")]
    for i, cond in enumerate(steps.values(), 1):
        kept = kept & flag(cond)
        aggs.append(F.count_if(kept).alias(f"n{i}"))
    one = criteria.agg(*aggs)
    def row(i, name):
        n, prev = F.col(f"n{i}"), F.col(f"n{i - 1}") if i else None
        p = pct(n, prev) if i else F.lit(None).cast("double")
        cols = [F.lit(i + 1).alias("step"), F.lit(name).alias("criterion"), n.alias("students"),
                ((prev - n) if i else F.lit(None).cast("long")).alias("dropped"), p.alias("pct_of_previous"), pct(n, F.col("n0")).alias("pct_of_start")]
        if benchmark is not None:
            cols.append(F.bround(p - F.lit(float(benchmark)), 1).alias("vs_benchmark"))
        return F.struct(*cols)
    return one.select(F.inline(F.array(*[row(i, n) for i, n in enumerate([start, *steps])])))


def entrants(student_year: DataFrame, entry_year: int, entry_grade: int, rule: str = "entry_grade_any_school") -> DataFrame:
    e = student_year.filter((F.col(YEAR) == entry_year) & (F.col("C_stu_grade_level") == entry_grade))
    if rule == "entry_grade_in_scope":
        return e.filter("C_home_school_in_scope")
    if rule != "entry_grade_any_school":
        raise ValueError(f"unknown universe rule: {rule}")
    return e


def cohort_rows(student_year: DataFrame, universe: DataFrame, years) -> DataFrame:
    return join_same(student_year.filter(F.col(YEAR).isin(list(years))), universe.select(ID), ID, "left_semi")


def presence(rows: DataFrame, years_required: int) -> DataFrame:
    return rows.groupBy(ID).agg(n_distinct(YEAR).alias("years_present")).withColumn("passes", F.col("years_present") == years_required)


def duration_ok(basis: str = "days", min_days: float = 200, min_share: float = 0.75, window_days: int = 333) -> Column:
    d = F.col("M_days_enrolled_year")
    if basis == "share":
        return d / F.lit(float(window_days)) >= F.lit(min_share)
    if basis == "days":
        return d >= F.lit(min_days)
    raise ValueError(f"unknown duration basis: {basis}")


def duration_by_year(rows: DataFrame, ok: Column) -> DataFrame:
    out = rows.groupBy(YEAR).agg(F.count(F.lit(1)).alias("students"), pct_where(ok).alias("pct_meeting"))
    return with_medians(out, rows, [YEAR], {"M_days_enrolled_year": "median_days"}).select(YEAR, "students", "median_days", "pct_meeting")


def duration_sensitivity(rows: DataFrame, thresholds, rule: str, years, base: DataFrame, window_days: int = 333) -> DataFrame:
    """How many of ``base`` would pass at each threshold: one conditional count per threshold, one pass."""
    need = required_years(rule, years)
    kept = join_same(rows.filter(F.col(YEAR).isin(need)), base.select(ID), ID, "left_semi")
    per = kept.groupBy(ID).agg(n_distinct(YEAR).alias("y"), *[count_where(F.col("M_days_enrolled_year") >= t).alias(f"t{i}") for i, t in enumerate(thresholds)])
    k = F.lit(len(need))
    one = per.agg(*[F.count_if((F.col("y") == k) & (F.col(f"t{i}") == k)).alias(f"t{i}") for i in range(len(thresholds))])
    return one.select(F.inline(F.array(*[F.struct(F.lit(int(t)).alias("threshold_days"), F.lit(round(100 * t / window_days, 1)).alias("pct_of_window"),
                                                  F.col(f"t{i}").alias("students_passing")) for i, t in enumerate(thresholds)])))


def with_expected_grade(rows: DataFrame, progression: dict[int, int]) -> DataFrame:
    want = F.lit(None).cast("int")
    for y, g in progression.items():
        want = F.when(F.col(YEAR) == y, F.lit(int(g))).otherwise(want)
    out = rows.withColumn("grade_expected", want)
    return out.withColumn("on_grade", F.col("C_stu_grade_level") == F.col("grade_expected"))


def off_grade(rows: DataFrame) -> DataFrame:
    return rows.filter(~F.col("on_grade")).groupBy(YEAR, "grade_expected", "C_stu_grade_level").agg(F.count(F.lit(1)).alias("n_students"))


def school_rule(rows: DataFrame, rule: str, years, entry_year: int, out: str = "passes") -> DataFrame:
    ok = F.col("C_home_school_in_scope")
    if rule == "in_scope_all_years":
        return year_rule(rows, ok, "all_years", years, out=out)
    if rule == "in_scope_entry_year":
        return year_rule(rows, ok, "bookends", [entry_year], out=out)
    if rule == "in_scope_any_year":
        return rows.groupBy(ID).agg(F.bool_or(flag(ok)).alias(out))
    raise ValueError(f"unknown school rule: {rule}")


def verdicts(rows: DataFrame, specs: dict[str, tuple]) -> DataFrame:
    """Several year rules at once: column -> (condition, rule, years), one grouping of the rows.

    ``rows`` holds one row per student and year. ``rule`` may also be ``any``: ok in at least one year.
    """
    aggs = []
    for name, (ok, rule, years) in specs.items():
        need = sorted(set(years)) if rule == "any" else required_years(rule, years)
        inside = F.col(YEAR).isin(need) if need else F.lit(False)
        if rule == "any":
            aggs.append(F.bool_or(flag(ok) & inside).alias(name))
        else:
            aggs.append((F.count_if(inside & flag(ok)) == len(need)).alias(name))
    return rows.groupBy(ID).agg(*aggs)


def criteria_table(universe: DataFrame, met: DataFrame, reasons: dict[str, str]) -> DataFrame:
    """One row per entrant: every verdict (missing is false), include / exclude, first failed criterion.

    ``reasons``: verdict column -> text when it failed, in funnel order.
    """
    out = join_same(universe.select(ID).distinct(), met.select(ID, *reasons), ID).withColumns({c: flag(c) for c in reasons})
    reason = F.lit(None).cast("string")
    for c, why in reversed(list(reasons.items())):
        reason = F.when(~F.col(c), F.lit(why)).otherwise(reason)
    return out.withColumns({"C_stu_cohort": F.when(reason.isNull(), "include").otherwise("exclude"), "C_cohort_exclusion_reason": reason})


def attribute_school(student_year: DataFrame, ids: DataFrame, years, rule: str = "most_days") -> DataFrame:
    """Cohort school per student: most_days (largest single year) | entry_year | final_year | modal."""
    rows = join_same(student_year.filter(F.col(YEAR).isin(list(years))), ids.select(ID), ID, "left_semi")
    days, year = -F.col("C_home_school_days"), F.col(YEAR)
    keep = ["C_home_school_id", "C_home_school_name"]
    if rule == "modal":
        n = rows.groupBy(ID, *keep).agg(F.count(F.lit(1)).alias("n"))
        pick = top_row(n, ID, [-F.col("n")], keep)
    else:
        orders = {"most_days": [days, year], "entry_year": [year, days], "final_year": [-year, days]}
        if rule not in orders:
            raise ValueError(f"unknown school attribution rule: {rule}")
        pick = top_row(rows, ID, orders[rule], keep)
    many = rows.groupBy(ID).agg(n_distinct("C_home_school_id").alias("C_multiple_home_schools"))
    return join_same(pick.withColumnsRenamed({"C_home_school_id": "C_cohort_school_id", "C_home_school_name": "C_cohort_school_name"}), many, ID).withColumn(
        "C_multiple_home_schools_flag", F.col("C_multiple_home_schools") > 1)


ENTRY_FIELDS = ("C_stu_race", "C_stu_ell_flag", "C_stu_swd_flag", "C_stu_poverty_flag")


def cohort_table(schools: DataFrame, universe: DataFrame, entry_year: int) -> DataFrame:
    return join_checked(schools, universe.select(ID, *ENTRY_FIELDS), ID, "entry demographics onto cohort").withColumns(
        {"C_cohort_entry_year": F.lit(entry_year), "C_cohort_include": F.lit(True)})


def cohort_gates(cohort: DataFrame, universe: DataFrame, in_scope: DataFrame) -> DataFrame:
    """One row per student, all entrants, every school known and in scope."""
    from .checks import Check, gates, unique
    from .joins import anti
    return (unique(cohort, [ID], "one cohort row per student").result()
            .unionByName(Check("cohort students are entrants", anti(cohort, universe, ID)).result())
            .unionByName(Check("cohort schools are in scope", anti(cohort, in_scope, {"C_cohort_school_id": "location_id"})).result())
            .unionByName(gates(cohort, {"cohort school is known": F.col("C_cohort_school_id").isNotNull()})))


def credit_recovery(tr: DataFrame) -> DataFrame:
    """Second-term rows with excess credit whose first-term row of the same base course earned nothing."""
    key = [ID, YEAR, "C_course_id_base"]
    d = companion(tr, key, F.col("C_term") == "Semester 1", "D_creds_earn", "s1_creds")
    hit = F.col("C_creds_earn_exceeds_attempted") & (F.col("C_term") == "Semester 2") & F.col("s1_creds_found") & (F.col("s1_creds") == 0)
    return d.withColumn("C_credit_recovery_flag", flag(hit)).drop("s1_creds", "s1_creds_found")


def recovery_status(tr: DataFrame) -> DataFrame:
    """What happened in the first term of second-term rows with excess credit."""
    from .aggregates import share_counts
    key = [ID, YEAR, "C_course_id_base"]
    d = companion(tr, key, F.col("C_term") == "Semester 1", "D_creds_earn", "s1").filter(
        flag(F.col("C_creds_earn_exceeds_attempted") & (F.col("C_term") == "Semester 2")))
    status = F.when(F.col("s1").isNull(), "no S1 record").when(F.col("s1") == 0, "S1 earned zero").otherwise("S1 earned credit")
    return share_counts(d.withColumn("s1_status", status), ["s1_status"])


def snapshot_table(student_year: DataFrame, tr: DataFrame, year: int, grades, basis: str = "days", min_days: float = 200, min_share: float = 0.75,
                   credits_min: float = 2.0, window_days: int = 333) -> DataFrame:
    """One row per student of the snapshot year with a verdict per rule."""
    base = student_year.filter(F.col(YEAR) == year)
    out = base.select(ID, "M_days_enrolled_year", is_in("C_stu_grade_level", grades).alias("ok_grade"), flag("C_home_school_in_scope").alias("ok_school"))
    if basis == "credits_attempted":
        c = tr.filter(F.col(YEAR) == year).groupBy(ID).agg(sum0("D_creds_possible").alias("c"))
        out = join_same(out, c, ID).withColumn("ok_load", flag(F.col("c") >= credits_min)).drop("c")
    else:
        need = min_share * window_days if basis == "share" else min_days
        out = out.withColumn("ok_load", flag(F.col("M_days_enrolled_year") >= need))
    return out.withColumn("selected", F.col("ok_grade") & F.col("ok_school") & F.col("ok_load")).drop("M_days_enrolled_year")


def student_year_export(student_year: DataFrame, criteria: DataFrame, mobility: DataFrame, cohort: DataFrame, snapshot: DataFrame, snapshot_year: int) -> DataFrame:
    """Student-years with criteria, mobility, cohort school and selection flags."""
    out = join_same(student_year, criteria.withColumn("C_entry_cohort_candidate", F.lit(True)), ID)
    out = join_same(out, mobility, ID)
    out = join_same(out, cohort.select(ID, "C_cohort_school_id", "C_cohort_school_name"), ID)
    out = join_same(out, snapshot.filter("selected").select(ID).withColumn("__snap", F.lit(True)), ID)
    snap = flag("__snap") & (F.col(YEAR) == snapshot_year)
    return out.withColumns({"C_stu_cohort": F.coalesce("C_stu_cohort", F.lit("exclude")), "C_entry_cohort_candidate": flag("C_entry_cohort_candidate"),
                            "C_stu_snapshot": F.when(snap, "include").otherwise("exclude")}).drop("__snap")
