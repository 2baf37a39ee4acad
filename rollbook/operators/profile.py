"""Profiling: columns, shapes of strings, grains, overlap, coverage, traces."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.nullsafe import (any_of, col, count_where, flag, is_in, join_same, matches, n_distinct,
                                  nulls_last, pct, pct_where, top_row)

# Texts that count as missing, and texts that read as true.
MISSING_TEXTS = ("", "NA", "MISSING", "NULL")
TRUE_TEXTS = ("1", "Y", "y", "TRUE")


def _text(df: DataFrame) -> dict[str, Column]:
    out = {}
    for name, kind in df.dtypes:
        t = F.col(f"`{name}`").cast("string")
        out[name] = F.when(~F.trim(t).isin(*MISSING_TEXTS), t) if kind == "string" else t
    return out


def profile_columns(df: DataFrame, max_full: int = 12, n_sample: int = 6) -> DataFrame:
    """One row per column: type, distinct and missing counts, numeric range, and the values
    (all of them up to ``max_full``, else the first ``n_sample`` in text order).

    Rows are unpivoted to (column, value) and counted first, so everything after works on distinct
    values; the value samples come from a top-k by rank, which Spark limits before its shuffle.
    """
    spark_text = _text(df)
    kinds = dict(df.dtypes)
    cells = F.explode(F.array(*[F.struct(F.lit(n).alias("column"), v.alias("value"))
                                for n, v in spark_text.items()])).alias("c")
    counts = (df.select(cells).select("c.column", "c.value")
                .groupBy("column", "value").agg(F.count(F.lit(1)).alias("n")))
    num = F.col("value").try_cast("double")
    stats = counts.groupBy("column").agg(
        F.count("value").alias("n_distinct"),
        F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0)).alias("n_missing"),
        F.sum("n").alias("n_rows"),
        F.min(num).alias("lo"), F.max(num).alias("hi"),
        F.min("value").alias("lo_text"), F.max("value").alias("hi_text"),
        count_where(F.col("value").isNotNull() & num.isNull()).alias("not_numbers"))
    w = Window.partitionBy("column").orderBy("value")
    firsts = (counts.filter(F.col("value").isNotNull()).select("column", "value")
                    .withColumn("rk", F.row_number().over(w)).filter(F.col("rk") <= max_full)
                    .groupBy("column").agg(F.array_sort(F.collect_list("value")).alias("firsts")))
    kind_map = F.create_map(*[F.lit(x) for kv in kinds.items() for x in kv])
    numeric = F.col("not_numbers") == 0
    dated = F.col("type").isin("date", "timestamp")
    short = F.array_join(F.slice(F.col("firsts"), 1, n_sample), ", ")
    return (join_same(stats, firsts, "column")
            .withColumn("type", kind_map[F.col("column")])
            .select("column", "type", "n_distinct", "n_missing",
                    pct("n_missing", "n_rows").alias("pct_missing"),
                    F.when(dated, F.col("lo_text")).when(numeric, F.col("lo").cast("string")).alias("min"),
                    F.when(dated, F.col("hi_text")).when(numeric, F.col("hi").cast("string")).alias("max"),
                    F.when(F.col("n_distinct") == 0, "")
                     .when(F.col("n_distinct") <= max_full, F.array_join("firsts", ", "))
                     .otherwise(F.concat(short, F.lit(", ..."))).alias("values")))


def value_counts(df: DataFrame, column: str, top: int | None = None) -> DataFrame:
    """Counts per value, nulls included, in value order."""
    out = df.groupBy(column).agg(F.count(F.lit(1)).alias("n")).orderBy(nulls_last(column))
    return out.limit(top) if top else out


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Rows, distinct rows and exact copies, from one grouping of the whole row."""
    return (df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("n"))
              .agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"), F.count(F.lit(1)).alias("n_distinct_rows"))
              .withColumn("n_copies", F.col("n_rows") - F.col("n_distinct_rows")))


def grain_histogram(df: DataFrame, keys, per=None) -> DataFrame:
    """How many key combinations have 1, 2, 3, ... rows (or distinct ``per`` values)."""
    rows = df.select(*keys, per).distinct() if per else df
    return (rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("size"))
                .groupBy("size").agg(F.count(F.lit(1)).alias("n_keys")))


def id_overlap(left: DataFrame, right: DataFrame, on) -> DataFrame:
    """Keys in both tables and in one only, with the longest key text on each side."""
    on = [on] if isinstance(on, str) else list(on)
    tagged = left.select(*on, F.lit(1).alias("l"), F.lit(0).alias("r")).unionByName(
        right.select(*on, F.lit(0).alias("l"), F.lit(1).alias("r")))
    keys = tagged.groupBy(*on).agg(F.max("l").alias("l"), F.max("r").alias("r"))
    width = F.length(F.concat_ws("", *[F.col(k).cast("string") for k in on]))
    return keys.agg(
        F.count_if((F.col("l") == 1) & (F.col("r") == 1)).alias("n_both"),
        F.count_if(F.col("r") == 0).alias("n_left_only"),
        F.count_if(F.col("l") == 0).alias("n_right_only"),
        F.max(F.when(F.col("l") == 1, width)).alias("left_width"),
        F.max(F.when(F.col("r") == 1, width)).alias("right_width"))


def string_shape(df: DataFrame, column: str, suffixes: dict[str, str]) -> DataFrame:
    """Rows per (first matching suffix pattern, last two characters, length)."""
    label = F.coalesce(*[F.when(matches(column, p), F.lit(n)) for n, p in suffixes.items()], F.lit("none"))
    return (df.groupBy(label.alias("suffix"), F.right(col(column), F.lit(2)).alias("last_two"),
                       F.length(column).alias("n_chars"))
              .agg(F.count(F.lit(1)).alias("n_rows")))


def fill_rates(df: DataFrame, columns) -> DataFrame:
    """Per named field: present in the table, and % of rows with a value. One pass."""
    have = [c for c in columns if c in df.columns]
    aggs = [F.count(F.col(c)).alias(f"f{i}") for i, c in enumerate(have)]
    counted = df.agg(F.count(F.lit(1)).alias("n"), *aggs)
    rows = [F.struct(F.lit(c).alias("field"), F.lit(c in have).alias("present"),
                     (pct(f"f{have.index(c)}", "n") if c in have else F.lit(None).cast("double")).alias("pct_filled"))
            for c in columns]
    return counted.select(F.inline(F.array(*rows)))


def staff_coverage(schedule: DataFrame, hr: DataFrame, by: str = "D_stu_grade", teacher: str = "D_employee_id") -> DataFrame:
    """Teachers of the schedule found in the HR table, by ``by``."""
    teachers = schedule.filter(F.col(teacher).isNotNull()).select(by, teacher).distinct()
    marked = join_same(teachers, hr.select(teacher).distinct().withColumn("has_hr", F.lit(1)), teacher)
    return (marked.groupBy(by).agg(F.count(F.lit(1)).alias("teachers_in_schedule"),
                                   F.count("has_hr").alias("teachers_with_hr"))
            .withColumn("pct_coverage", pct("teachers_with_hr", "teachers_in_schedule")))


def grade_coverage(schedule: DataFrame, graded: DataFrame, subjects, by: str = "D_stu_grade",
                   student: str = "D_stu_id", subject: str = "C_course_subject") -> DataFrame:
    """Students with a grade in each core subject, by ``by``.

    Every student is paired with every subject of the parameter list (an explode of a literal array).
    """
    students = schedule.filter(F.col(student).isNotNull()).select(student, by).distinct()
    asked = students.withColumn(subject, F.explode(F.array(*[F.lit(s) for s in subjects])))
    have = graded.select(student, subject).distinct().withColumn("has", F.lit(1))
    return (join_same(asked, have, [student, subject]).groupBy(by, subject)
            .agg(n_distinct(student).alias("students_in_schedule"),
                 F.count_distinct(F.when(F.col("has") == 1, F.col(student))).alias("students_with_grade"))
            .withColumn("pct_coverage", pct("students_with_grade", "students_in_schedule")))


def repeated_pairs(graded: DataFrame, student="D_stu_id", subject="C_course_subject") -> DataFrame:
    """Grade rows, distinct student x subject pairs, and pairs with more than one row."""
    return graded.groupBy(student, subject).agg(F.count(F.lit(1)).alias("n")).agg(
        F.sum("n").alias("n_rows"), F.count(F.lit(1)).alias("n_pairs"), F.count_if(F.col("n") > 1).alias("n_repeated"))


def sample_rows(df: DataFrame, key: str, n: int, seed: int = 0) -> DataFrame:
    """``n`` rows in the order of a digest of key and seed: the same rows on every run and any partitioning."""
    rest = [c for c in df.columns if c != key]
    return df.orderBy(F.md5(F.concat_ws(":", F.col(key).cast("string"), F.lit(str(seed)))), key, *rest).limit(n)


def trace_ids(df: DataFrame, key: str, chosen=(), n_random: int = 0, seed: int = 0) -> DataFrame:
    ids = df.select(key).distinct()
    picked = ids.filter(is_in(key, chosen))
    if n_random:
        picked = picked.unionByName(sample_rows(ids, key, n_random, seed)).distinct()
    return picked


def trace_rows(df: DataFrame, ids: DataFrame, key: str, columns, order) -> DataFrame:
    """Every row of the chosen ids through the named columns that exist."""
    present = [c for c in columns if c in df.columns]
    return join_same(df, ids.select(key), key, "left_semi").select(*present).orderBy(*[nulls_last(c) for c in order])


def pct_true(df: DataFrame, column: str, digits: int = 1) -> DataFrame:
    return df.agg(pct_where(is_in(F.col(column).cast("string"), TRUE_TEXTS), digits).alias("pct_true"))
