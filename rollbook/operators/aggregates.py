"""Grouped summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.nullsafe import (attach, col, count_where, flag, is_in, join_same, joined_values, matches, n_distinct,
                                  n_distinct_if, not_in, pct, pct_known, pct_where, ratio, sum0)
from ..functions.text import base_course_id
from ..sources.tables import cut_lineage


def rows():
    return F.count(F.lit(1))


def share_counts(df: DataFrame, by, within=None, digits: int = 1, name: str = "n_rows") -> DataFrame:
    """Rows per group with the share of the total, or of the ``within`` group.

    Totals come from the counts, never from the rows.
    """
    counts = df.groupBy(*by).agg(rows().alias(name))
    if within:
        counts = attach(counts, within, F.sum(name).alias("__t"))
    else:
        counts = counts.join(counts.agg(F.sum(name).alias("__t")), F.lit(True))
    return counts.withColumn("pct", pct(name, "__t", digits)).drop("__t")


def rank_values(df: DataFrame, by, columns, points) -> DataFrame:
    """Exact interpolated quantiles: ``by`` and ``<column>_<i>`` for the i-th point, one row per group that has a value.

    Values are counted, the counts are range-partitioned by group, column and value, and each partition's total gives the rank at which it starts. Only the slices that
    hold a wanted rank are looked at again, and of them the one or two values beside it are picked. No task holds the values of a group, whatever their number; the ranges are stored, so
    that the ranks of all partitions are of one cut.
    """
    by, columns, points = list(by), list(columns), list(points)
    keys = [f"__b{i}" for i in range(len(by))]
    each = F.explode(F.array(*[F.struct(F.lit(i).alias("c"), F.col(c).cast("double").alias("v")) for i, c in enumerate(columns)]))
    long = df.select(*[F.col(b).alias(k) for b, k in zip(by, keys, strict=True)], each.alias("__x")).select(*keys, "__x.c", "__x.v").filter("v is not null")
    counts = long.groupBy(*keys, "c", "v").agg(rows().alias("n"))
    cut = cut_lineage(counts.repartitionByRange(*keys, "c", "v").withColumn("part", F.spark_partition_id()))
    parts = cut.groupBy(*keys, "c", "part").agg(F.sum("n").alias("size"))
    # one row for each partition that a group reaches
    before = Window.partitionBy(*keys, "c").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*keys, "c")
    parts = parts.withColumns({"start": F.coalesce(F.sum("size").over(before), F.lit(0)), "total": F.sum("size").over(whole)})
    place = lambda p: F.lit(float(p)) * (F.col("total") - 1)
    ranks = [f(place(p)).cast("bigint") for p in points for f in (F.floor, F.ceil)]
    holds = F.exists(F.array(*ranks), lambda r: (r >= F.col("start")) & (r < F.col("start") + F.col("size")))
    wanted = join_same(cut, parts.filter(holds), [*keys, "c", "part"], "inner")
    inside = Window.partitionBy(*keys, "c", "part").orderBy("v").rowsBetween(Window.unboundedPreceding, -1)
    wanted = wanted.withColumn("first", F.col("start") + F.coalesce(F.sum("n").over(inside), F.lit(0)))
    at = lambda r: F.max(F.when((r >= F.col("first")) & (r < F.col("first") + F.col("n")), F.col("v")))
    picks = [x.alias(f"{side}{i}") for i, p in enumerate(points) for side, x in (("lo", at(F.floor(place(p)))), ("hi", at(F.ceil(place(p)))))]
    found = wanted.groupBy(*keys, "c").agg(F.first("total").alias("total"), *picks)
    share = lambda i, p: place(p) - F.floor(place(p))
    value = [(F.col(f"lo{i}") * (F.lit(1.0) - share(i, p)) + F.col(f"hi{i}") * share(i, p)).alias(f"q{i}") for i, p in enumerate(points)]
    found = found.select(*keys, "c", *value)
    wide = found.groupBy(*keys).agg(*[F.max(F.when(F.col("c") == k, F.col(f"q{i}"))).alias(f"{c}_{i}") for k, c in enumerate(columns) for i in range(len(points))])
    return wide.select(*[F.col(k).alias(b) for b, k in zip(by, keys, strict=True)], *[f"{c}_{i}" for c in columns for i in range(len(points))])


def with_medians(grouped: DataFrame, df: DataFrame, by, columns: dict[str, str]) -> DataFrame:
    """Add the exact median of each column (column -> name) to a table of one row per group. Groups without a value get null."""
    by = list(by)
    mid = rank_values(df, by, list(columns), [0.5]).withColumnsRenamed({f"{c}_0": name for c, name in columns.items()})
    return join_same(grouped, mid, by) if by else grouped.join(mid, F.lit(True), "left")


def quantiles(df: DataFrame, by, column: str, points=(0.10, 0.25, 0.50, 0.75, 0.90)) -> DataFrame:
    """Exact interpolated quantiles per group."""
    names = {f"{column}_{i}": "p" + f"{p:.3f}"[2:].rstrip("0").ljust(2, "0") for i, p in enumerate(points)}
    return rank_values(df, by, [column], points).withColumnsRenamed(names)


def tail_summary(df: DataFrame, column: str, above) -> DataFrame:
    """Rows, maximum, far quantiles and rows above each bound."""
    v = F.col(column)
    one = df.filter(v.isNotNull()).agg(rows().alias("n_rows"), F.max(v).alias("max_value"), *[count_where(v > b).alias(f"n_above_{b}") for b in above])
    far = rank_values(df, [], [column], [0.99, 0.999]).select(F.bround(f"{column}_0", 2).alias("p99"), F.bround(f"{column}_1", 2).alias("p999"))
    return one.join(far, F.lit(True), "left").select("n_rows", "max_value", "p99", "p999", *[f"n_above_{b}" for b in above])


def student_year_load(tr: DataFrame, keys=("D_stu_id", "D_year"), attempted="D_creds_possible", earned="D_creds_earn") -> DataFrame:
    """Courses, credit-bearing courses, credits and failures per student-year."""
    p, e = F.col(attempted), F.col(earned)
    return tr.groupBy(*keys).agg(
        rows().alias("courses"), count_where(p > 0).alias("courses_credit_bearing"), sum0(p).alias("creds_attempted"),
        sum0(e).alias("creds_earned"), count_where((p > 0) & (e == 0)).alias("n_failed"))


def load_by_year(load: DataFrame, year="D_year") -> DataFrame:
    known = ["courses", "courses_credit_bearing", "creds_attempted", "creds_earned", "n_failed"]
    out = load.groupBy(year).agg(rows().alias("students"), F.bround(F.avg("n_failed"), 2).alias("mean_failed"),
                                 pct_where(F.col("creds_earned") >= F.col("creds_attempted")).alias("pct_earning_all"))
    medians = {c: f"median_{c}" for c in known}
    return with_medians(out, load, [year], medians).select(year, "students", *medians.values(), "mean_failed", "pct_earning_all")


def credit_rates(tr: DataFrame, year="D_year", attempted="D_creds_possible", earned="D_creds_earn") -> DataFrame:
    """Rows attempted at zero, and credit-bearing rows earning zero, by year."""
    p, e = F.col(attempted), F.col(earned)
    return tr.groupBy(year).agg(
        rows().alias("n_rows"), count_where(p == 0).alias("n_zero_attempted"), count_where(p > 0).alias("n_credit_bearing"),
        count_where((p > 0) & (e == 0)).alias("n_zero_earned")).withColumns({
            "pct_zero_attempted": pct("n_zero_attempted", "n_rows", 2), "pct_zero_earned": pct("n_zero_earned", "n_credit_bearing")})


def excess_by_course(tr: DataFrame, by=("D_course_id", "D_course_name"), attempted="D_creds_possible", earned="D_creds_earn",
                     half=0.5, full=1.0) -> DataFrame:
    """Courses where half-credit rows earn a full credit, and how regular that is."""
    e = F.col(earned)
    return (tr.filter(F.col(attempted) == half).groupBy(*by)
              .agg(rows().alias("n_rows"), count_where(e == full).alias("n_full"))
              .filter("n_full > 0").withColumn("pct_full", pct("n_full", "n_rows")))


def orphan_weight(orphan_rows: DataFrame, student="D_stu_id", year="D_year", earned="D_creds_earn") -> DataFrame:
    """Rows, students, median rows per student and credits, by year."""
    per = cut_lineage(orphan_rows.groupBy(year, student).agg(rows().alias("n"), sum0(earned).alias("c")))
    out = per.groupBy(year).agg(F.sum("n").alias("n_rows"), rows().alias("students"), F.bround(F.sum("c"), 1).alias("creds_earned"))
    return with_medians(out, per, [year], {"n": "median_courses"}).select(year, "n_rows", "students", "median_courses", "creds_earned")


def term_marker_pairs(tr: DataFrame, pattern: str, marker: str, keys=("D_stu_id", "D_year"), course="D_course_id") -> DataFrame:
    """For ids ending in a marker: which markers a student-year has for one base course."""
    hit = tr.filter(matches(course, pattern)).withColumns({
        "marker": F.regexp_extract(F.col(course), marker, 0), "base": F.regexp_replace(F.col(course), pattern, "")})
    per = hit.groupBy(*keys, "base").agg(joined_values("marker", "+").alias("markers"))
    return share_counts(per, ["markers"], name="n_student_course_years")


def marker_by_term(tr: DataFrame, pattern: str, marker: str, term="C_term", course="D_course_id") -> DataFrame:
    hit = tr.filter(matches(course, pattern)).withColumn("marker", F.regexp_extract(F.col(course), marker, 0))
    return share_counts(hit, ["marker", term], within=["marker"])


def starred_profile(tr: DataFrame, star="C_course_name_starred", term="C_term", second="Semester 2") -> DataFrame:
    out = tr.groupBy(star).agg(
        rows().alias("n_rows"), pct_known(F.col(term) == second).alias("pct_second_term"),
        pct_known(F.col("D_creds_earn") == 0).alias("pct_zero_earned"), pct_where("C_creds_earn_exceeds_attempted").alias("pct_excess"))
    return with_medians(out, tr, [star], {"D_stu_grade": "median_grade"}).select(star, "n_rows", "pct_second_term", "pct_zero_earned", "median_grade", "pct_excess")


def starred_variants(tr: DataFrame, course="D_course_id", name="D_course_name", star="C_course_name_starred") -> DataFrame:
    """Courses by the number of asterisk variants of one id and plain name."""
    plain = tr.select(course, F.trim(F.regexp_replace(name, "[*]", "")).alias("name_plain"), star).distinct()
    return (plain.groupBy(course, "name_plain").agg(rows().alias("n_variants"))
                 .groupBy("n_variants").agg(rows().alias("n_courses")))


def retention_profile(entrants: DataFrame, kept="in_cohort", groups: dict | None = None) -> DataFrame:
    """Retention overall and by each attribute in one pass (grouping sets over the attributes)."""
    groups = groups or {"Race": "C_stu_race", "ELL": "C_stu_ell_flag", "SWD": "C_stu_swd_flag", "Poverty": "C_stu_poverty_flag"}
    k = count_where(F.col(kept))
    pair = F.explode(F.array(F.struct(F.lit("All entrants").alias("g")), *[
        F.struct(F.concat(F.lit(f"{n}: "), F.coalesce(F.col(c).cast("string"), F.lit("NA"))).alias("g")) for n, c in groups.items()]))
    tagged = entrants.select(kept, pair.alias("x")).select(kept, F.col("x.g").alias("group"))
    return tagged.groupBy("group").agg(rows().alias("n"), k.alias("n_kept")).withColumn("pct_retained", pct("n_kept", "n")).drop("n_kept")


def retention_by(entrants: DataFrame, by: str, kept="in_cohort") -> DataFrame:
    return (entrants.groupBy(by).agg(rows().alias("entrants"), count_where(F.col(kept)).alias("cohort"))
                    .withColumn("pct_retained", pct("cohort", "entrants")))


def pivot_counts(df: DataFrame, by, column: str, values) -> DataFrame:
    return df.groupBy(*by).pivot(column, list(values)).agg(rows()).fillna(0)


def slots_without(df: DataFrame, slot, column="C_course_format", value="Standard") -> DataFrame:
    """Time slots in which no record has the given value."""
    return df.groupBy(*slot).agg(rows().alias("n_records"), count_where(F.col(column) == value).alias("n_with")).filter("n_with = 0").drop("n_with")


def narrow_slots(df: DataFrame, slot, max_courses: int = 5, skip_areas=("Core", "Non-Core"), course="D_course_name",
                 subject="C_course_subject", area="C_course_subject_area") -> DataFrame:
    """Records of slots with few different courses. The slot totals join back as an aggregate."""
    few = df.groupBy(*slot).agg(n_distinct(course).alias("n_courses")).filter(F.col("n_courses") <= max_courses)
    counts = df.filter(not_in(area, skip_areas)).groupBy(*slot, subject, course).agg(rows().alias("n_records"))
    return join_same(counts, few, list(slot), "inner")


def records_by_school(df: DataFrame, slot, school="D_location_name", student="D_stu_id", teacher="D_employee_id", term="D_term") -> DataFrame:
    """Students, teachers, terms, time slots and mean records per student, by school."""
    wide = df.groupBy(school).agg(n_distinct(student).alias("n_students"), n_distinct(teacher).alias("n_teachers"),
                                  joined_values(term, ", ").alias("terms"), n_distinct(*slot).alias("n_time_slots"))
    per = df.groupBy(school, student).agg(rows().alias("n")).groupBy(school).agg(
        F.bround(F.sum("n") / rows(), 1).alias("avg_records_per_student"))
    return join_same(wide, per, school)


def weight_by_school(df: DataFrame, person: str, weight="M_cls_class_weight", minutes: str | None = None, school="D_location_name",
                     class_col="C_class_id") -> DataFrame:
    """Mean weight (and minutes) per person by school, each person's classes counted once."""
    cols = [school, person, class_col, weight] + ([minutes] if minutes else [])
    per = df.select(*cols).distinct().groupBy(school, person).agg(
        sum0(weight).alias("w"), *([sum0(minutes).alias("m")] if minutes else []))
    return per.groupBy(school).agg(rows().alias("n_people"), F.bround(F.avg("w"), 2).alias("avg_weight"),
                                   *([F.bround(F.avg("m"), 0).alias("avg_minutes")] if minutes else []))


def uncoded_share(df: DataFrame, area="C_course_subject_area") -> DataFrame:
    """Share marked UNCODED among rows with an area."""
    return df.agg(rows().alias("n_rows"), count_where(F.col(area) == "UNCODED").alias("n_uncoded"),
                  pct_known(F.col(area) == "UNCODED").alias("pct_uncoded"))


def coding_coverage(df: DataFrame, by, coded="C_course_subject_area") -> DataFrame:
    return df.groupBy(*by).agg(rows().alias("n_rows"), pct_where(F.col(coded).isNotNull(), 3).alias("pct_coded"))


def subject_totals(df: DataFrame, by="C_course_subject_area", student="D_stu_id", earned="D_creds_earn") -> DataFrame:
    return df.filter(F.col(by).isNotNull()).groupBy(by).agg(
        rows().alias("n_rows"), n_distinct(student).alias("students"), F.bround(sum0(earned), 0).alias("creds_earned"))


def flag_rates(df: DataFrame, by, flags) -> DataFrame:
    """Share of rows with each 0/1 flag set, unknown flags out of the base."""
    return df.groupBy(*by).agg(rows().alias("n_rows"), *[pct_known(F.col(c) == 1, 2).alias(f"pct_{n}") for n, c in flags.items()])


def completeness(df: DataFrame, student="D_stu_id", year="D_year", checks: dict | None = None) -> DataFrame:
    """Rows, students, years and the share of rows with each attribute, as (measure, value)."""
    checks = checks or {}
    one = df.agg(rows().alias("n"), n_distinct(student).alias("s"), n_distinct(year).alias("y"),
                 *[pct_where(c, 2).alias(f"c{i}") for i, c in enumerate(checks.values())])
    v = lambda c: F.col(c).cast("double").alias("value")
    items = [("rows", "n"), ("students", "s"), ("years", "y")] + [(k, f"c{i}") for i, k in enumerate(checks)]
    return one.select(F.inline(F.array(*[F.struct(F.lit(k).alias("measure"), v(c)) for k, c in items])))


def export_by_year(df: DataFrame, student="D_stu_id", year="D_year", earned="D_creds_earn") -> DataFrame:
    return df.groupBy(year).agg(rows().alias("n_rows"), n_distinct(student).alias("students"), F.bround(sum0(earned), 0).alias("creds_earned")).withColumn(
        "mean_courses", F.bround(F.col("n_rows") / F.col("students"), 1))


def spells_without_courses(spells: DataFrame, min_days: int, by=("D_year",)) -> DataFrame:
    spells = cut_lineage(spells.select(*by, "M_days_enrolled", "C_school_in_scope"))
    out = spells.groupBy(*by).agg(rows().alias("spells"), pct_where("C_school_in_scope").alias("pct_in_scope"), pct_where(F.col("M_days_enrolled") >= min_days).alias("pct_full_year"))
    return with_medians(out, spells, by, {"M_days_enrolled": "median_days"}).select(*by, "spells", "median_days", "pct_in_scope", "pct_full_year")


def student_years_by_year(sy: DataFrame, year="D_year") -> DataFrame:
    out = sy.groupBy(year).agg(
        rows().alias("student_years"), pct_where(F.col("n_schools") > 1).alias("pct_multischool"), pct_where("C_home_school_in_scope").alias("pct_in_scope"),
        *[pct_known(F.col(f"C_stu_{f}_flag") == 1).alias(f"pct_{f}") for f in ("ell", "swd", "poverty")])
    return with_medians(out, sy, [year], {"M_days_enrolled_year": "median_days"})


def joined_by_year(tr: DataFrame, year="D_year", home="C_home_school_id", in_scope="C_home_school_in_scope") -> DataFrame:
    return tr.groupBy(year).agg(rows().alias("n_rows"), pct_where(F.col(home).isNotNull(), 2).alias("pct_with_school"),
                                pct_known(F.col(in_scope)).alias("pct_in_scope"))


def column_totals(df: DataFrame, columns, label: str) -> DataFrame:
    return df.agg(*[sum0(c).alias(c) for c in columns]).withColumn("step", F.lit(label))


def utilisation_by_school(teachers: DataFrame, school="C_tch_location_name", value="M_tch_utilization") -> DataFrame:
    return teachers.groupBy(school).agg(rows().alias("n_teachers"), F.bround(F.avg(value), 4).alias("avg_utilization"),
                                        F.count_if(F.col(value).isNull()).alias("n_null"))
