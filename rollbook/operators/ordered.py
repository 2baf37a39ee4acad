"""Operators that depend on an order: lag, ties, picks, ranks, top-k, sets of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.nullsafe import attach, col, flag, join_same, n_distinct, nulls_last


def same_school_overlaps(spells: DataFrame, keys=("D_stu_id", "D_year", "C_location_id"), enter="H_enter_clamped",
                         exit_="H_exit_clamped") -> DataFrame:
    """Repeat spells of a key and whether each starts before the previous one ended.

    Copies of one (entry, exit) pair are counted before the window, so a window group holds at most the
    day pairs of one school year, however many spells a key has. Within copies the previous spell is
    the copy itself.
    """
    keys = list(keys)
    pairs = spells.groupBy(*keys, enter, exit_).agg(F.count(F.lit(1)).alias("n_copies"))
    w = Window.partitionBy(*keys).orderBy(enter, exit_)
    prev = F.lag(exit_).over(w)
    rows_of_key = F.sum("n_copies").over(Window.partitionBy(*keys))
    first_over = F.when(flag(F.col(enter) < prev), 1).otherwise(0)
    copies_over = F.when(flag(F.col(enter) < F.col(exit_)), F.col("n_copies") - 1).otherwise(0)
    return pairs.withColumns({"prev_exit": prev, "n_spells": rows_of_key, "n_overlapping": first_over + copies_over}).filter("n_spells > 1")


def mobility(student_year: DataFrame, id_col="D_stu_id", year="D_year", school="C_home_school_id", n_schools="n_schools") -> DataFrame:
    """Changed school within a year, between consecutive recorded years, or never.

    Input is one row per student-year, so the window group is a student's years.
    """
    prev = F.lag(school).over(Window.partitionBy(id_col).orderBy(year))
    lagged = student_year.select(id_col, year, school, n_schools).withColumn("prev", prev)
    out = lagged.groupBy(id_col).agg(
        F.bool_or(flag(F.col(n_schools) > 1)).alias("C_transferred_within_year"),
        F.bool_or(flag(F.col("prev") != F.col(school))).alias("C_transferred_across_years"))
    return out.withColumn("C_pure_cohort", ~F.col("C_transferred_within_year") & ~F.col("C_transferred_across_years"))


def ties_at_max(df: DataFrame, keys, value: str) -> DataFrame:
    """Rows that share the largest value of their key with at least one other row."""
    top = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("n_tied")).groupBy(*keys).agg(
        F.max(F.struct(F.col(value), F.col("n_tied"))).alias("t")).select(*keys, F.col(f"t.{value}").alias("__v"), F.col("t.n_tied").alias("n_tied"))
    return join_same(df, top.filter("n_tied > 1"), list(keys), "inner").filter(F.col(value) == F.col("__v")).drop("__v")


def rank_groups(sizes: DataFrame, within, size: str, tie: str, prefix: str, out: str) -> DataFrame:
    """Label the groups of each ``within`` key by falling size; equal sizes in order of the md5 of ``tie``.

    Input is one row per group. Rows are ranked inside slices of the md5 order and shifted by the count of
    the slices before, so a key with very many groups of one size is spread over tasks.
    """
    within = list(within)
    d = sizes.withColumn("__h", F.md5(F.col(tie).cast("string"))).withColumn("__s", F.substring("__h", 1, 2))
    slices = d.groupBy(*within, size, "__s").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(*within).orderBy(F.col(size).desc(), "__s").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    slices = slices.withColumn("__o", F.sum("__n").over(before) - F.col("__n")).drop("__n")
    d = join_same(d, slices, [*within, size, "__s"])
    inside = F.row_number().over(Window.partitionBy(*within, size, "__s").orderBy("__h", tie))
    return d.withColumn(out, F.concat(F.lit(prefix), (F.col("__o") + inside).cast("string"))).drop("__h", "__s", "__o")


def dominant(df: DataFrame, keys, column: str, weight: str, out: str, digits: int = 9) -> DataFrame:
    """Value with the largest summed weight per key; equal sums go to the first in text order, nulls last.

    Sums are compared at a fixed number of digits, so the order in which they were added does not matter.
    """
    sums = df.groupBy(*keys, column).agg(F.coalesce(F.sum(weight), F.lit(0.0)).alias("__w"))
    order = F.struct(-F.bround("__w", digits), F.col(column).isNull(), F.col(column).cast("string"), F.col(column).alias("v"))
    return sums.groupBy(*keys).agg(F.min(order).alias("__m")).select(*keys, F.col("__m.v").alias(out))


def sort_rows(df: DataFrame, *order) -> DataFrame:
    """Multi-key sort with missing values last; ``-name`` sorts descending."""
    return df.orderBy(*[nulls_last(o.lstrip("-"), o.startswith("-")) for o in order])


def top_counts(df: DataFrame, by, k: int, name: str = "n_rows") -> DataFrame:
    """The k most frequent groups; equal counts in key order."""
    counts = df.groupBy(*by).agg(F.count(F.lit(1)).alias(name))
    return counts.orderBy(F.desc(name), *[nulls_last(b) for b in by]).limit(k)


def distinct_first(df: DataFrame, keys, tie) -> DataFrame:
    """One whole row per key: the first by ``tie``, then by every other column."""
    keys, tie = list(keys), list(tie)
    rest = [c for c in df.columns if c not in keys and c not in tie]
    best = df.groupBy(*keys).agg(F.min(F.struct(*tie, *rest)).alias("__m"))
    return best.select(*keys, *[F.col(f"__m.{c}").alias(c) for c in tie + rest]).select(*df.columns)


def append(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.unionByName(b, allowMissingColumns=True)


def set_difference(a: DataFrame, b: DataFrame, columns) -> DataFrame:
    """Distinct rows on one side only, with the side. Each table is read once; nulls are equal."""
    side = lambda d, name: d.select(*columns).distinct().withColumn("side", F.lit(name))
    both = side(a, "left").unionByName(side(b, "right"))
    return both.groupBy(*columns).agg(F.min("side").alias("side"), F.count(F.lit(1)).alias("__n")).filter("__n = 1").drop("__n")


def same_values(a: DataFrame, b: DataFrame, column: str) -> DataFrame:
    """Do two tables hold the same set of values? One row."""
    return set_difference(a, b, [column]).agg(F.count(F.lit(1)).alias("n_different")).withColumn("same", F.col("n_different") == 0)


def keep_ids(a: DataFrame, b: DataFrame, id_col: str) -> DataFrame:
    return a.select(id_col).intersect(b.select(id_col))


def mirror(pairs: DataFrame, a: str, b: str, out_a: str, out_b: str) -> DataFrame:
    """Each undirected pair from both ends, in one scan."""
    rest = [c for c in pairs.columns if c not in (a, b)]
    ends = F.explode(F.array(F.struct(F.col(a).alias(out_a), F.col(b).alias(out_b)), F.struct(F.col(b).alias(out_a), F.col(a).alias(out_b))))
    return pairs.select(*rest, ends.alias("__e")).select(*rest, f"__e.{out_a}", f"__e.{out_b}")
