"""Row scope, exclusions, snapshots, recodes and membership."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.nullsafe import (all_of, any_of, col, count_where, flag, is_in, join_same, lookup, n_distinct_if,
                                  not_in, pct)
from .checks import Check, need_columns


def scope_rules(drop_when_null=(), filters=()) -> dict[str, Column]:
    """Scope as named row predicates: a value in each named column, then each SQL condition."""
    rules = {f"present {c}": F.col(c).isNotNull() & (F.trim(F.col(c).cast("string")) != "") for c in drop_when_null}
    rules.update({f"filter {e}": flag(F.expr(e)) for e in filters})
    return rules


def apply_scope(df: DataFrame, drop_when_null=(), filters=()) -> DataFrame:
    need_columns(df, drop_when_null, "scope columns exist")
    return df.filter(all_of(list(scope_rules(drop_when_null, filters).values())))


def scope_report(df: DataFrame, drop_when_null=(), filters=(), id_col: str | None = None, sum_cols=()) -> DataFrame:
    """What each rule costs, in order, plus rows, ids and column totals before and after.

    One pass: the survivors of each step are a conjunction of predicates, counted together.
    """
    need_columns(df, drop_when_null, "scope columns exist")
    rules = scope_rules(drop_when_null, filters)
    kept = [all_of(list(rules.values())[:i]) for i in range(len(rules) + 1)]
    aggs = [count_where(k).alias(f"k{i}") for i, k in enumerate(kept)]
    if id_col:
        aggs += [n_distinct_if(id_col, F.lit(True)).alias("ids0"), n_distinct_if(id_col, kept[-1]).alias("ids1")]
    for i, c in enumerate(sum_cols):
        aggs += [F.coalesce(F.sum(F.col(c)), F.lit(0)).alias(f"b{i}"),
                 F.coalesce(F.sum(F.when(kept[-1], F.col(c))), F.lit(0)).alias(f"a{i}")]
    one = df.agg(*aggs)

    def row(item, before, after):
        b, a = F.col(before).cast("double"), F.col(after).cast("double")
        return F.struct(F.lit(item).alias("item"), b.alias("before"), a.alias("after"), (b - a).alias("removed"))
    rows = [row(name, f"k{i}", f"k{i + 1}") for i, name in enumerate(rules)]
    rows.append(row("rows", "k0", f"k{len(rules)}"))
    if id_col:
        rows.append(row(f"ids {id_col}", "ids0", "ids1"))
    rows += [row(f"sum {c}", f"b{i}", f"a{i}") for i, c in enumerate(sum_cols)]
    return one.select(F.inline(F.array(*rows)))


def rule_matches(columns, rule: dict) -> Column:
    """One exclusion rule. A rule on an absent column or with an unknown operator never matches."""
    c, op, val = rule["col"], rule["op"], rule["val"]
    if c not in columns:
        return F.lit(False)
    values = val if isinstance(val, (list, tuple)) else [val]
    return {"eq": lambda: flag(F.col(c) == F.lit(val)), "ne": lambda: flag(F.col(c) != F.lit(val)),
            "in": lambda: is_in(c, values), "not_in": lambda: not_in(c, values)}.get(op, lambda: F.lit(False))()


def apply_exclusions(df: DataFrame, rules: dict[str, list[dict]]) -> DataFrame:
    """One Include / Exclude column per metric; any matching rule excludes."""
    return df.withColumns({m: F.when(any_of([rule_matches(df.columns, r) for r in rs]), "Exclude").otherwise("Include")
                           for m, rs in rules.items()})


def exclusion_rates(df: DataFrame, metrics) -> DataFrame:
    one = df.agg(F.count(F.lit(1)).alias("n"), *[count_where(F.col(m) == "Exclude").alias(f"x{i}") for i, m in enumerate(metrics)])
    return one.select(F.inline(F.array(*[
        F.struct(F.lit(m).alias("metric"), F.col(f"x{i}").alias("n_excluded"), F.col("n").alias("n_rows"),
                 pct(f"x{i}", "n").alias("pct_excluded")) for i, m in enumerate(metrics)])))


def excluded_courses(df: DataFrame, metrics, by=("C_course_subject", "D_course_name")) -> DataFrame:
    return (df.filter(any_of([flag(F.col(m) == "Exclude") for m in metrics]))
              .groupBy(*by, *metrics).agg(F.count(F.lit(1)).alias("n_records")))


def snapshot_flag(df: DataFrame, dates: dict[str, str], term="D_term", enter="D_stu_enter_date",
                  exit_="D_stu_exit_date", out="C_stu_snapshot") -> DataFrame:
    """Include when the student was enrolled on the snapshot date of the record's term."""
    df = lookup(df, term, dates, "__day", value_type="date")
    inside = flag((F.col(enter) <= F.col("__day")) & (F.col(exit_) >= F.col("__day")))
    return df.withColumn(out, F.when(inside, "Include").otherwise("Exclude")).drop("__day")


def fill_zero(df: DataFrame, columns) -> DataFrame:
    return df.fillna(0, subset=[c for c in columns if c in df.columns])


def null_counts(df: DataFrame, columns) -> DataFrame:
    """Values a fill would replace, per column, in one pass."""
    have = [c for c in columns if c in df.columns]
    one = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in have])
    return one.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("n_filled")) for c in have])))


def add_constants(df: DataFrame, constants: dict) -> DataFrame:
    return df.withColumns({c: F.lit(v) for c, v in constants.items()})


def recode(df: DataFrame, column: str, mapping: dict, out: str) -> DataFrame:
    """Recode through a parameter map; unmapped codes become null (see :func:`unmapped`)."""
    return lookup(df, column, mapping, out)


def unmapped(df: DataFrame, column: str, mapping: dict, name: str = "value map covers all codes") -> Check:
    """Known codes the map does not cover, with their row counts."""
    bad = df.filter(F.col(column).isNotNull() & not_in(F.col(column).cast("string"), [str(k) for k in mapping]))
    return Check(name, bad.groupBy(column).agg(F.count(F.lit(1)).alias("n_rows")))


def export_rows(df: DataFrame, rule: str = "all", cohort="C_cohort_include", snapshot="C_stu_snapshot_include",
                years=None, year="D_year") -> DataFrame:
    """``all`` | ``cohort_only`` | ``cohort_or_snapshot``, optionally within the cohort years."""
    rules = {"all": F.lit(True), "cohort_only": F.col(cohort), "cohort_or_snapshot": F.col(cohort) | F.col(snapshot)}
    if rule not in rules:
        raise ValueError(f"unknown export rule: {rule}")
    keep = flag(rules[rule])
    return df.filter(keep & is_in(year, years) if years else keep)


def member_flag(df: DataFrame, members: DataFrame, on, out: str) -> DataFrame:
    """Does the row's key occur in ``members``?"""
    on = [on] if isinstance(on, str) else list(on)
    marked = members.select(*on).distinct().withColumn("__in", F.lit(True))
    return join_same(df, marked, on).withColumn(out, flag("__in")).drop("__in")
