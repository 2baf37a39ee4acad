"""Null-aware building blocks.

The analyses treat a missing key as a value (it joins to itself and counts once), treat an
undecided condition as false, and sort missing values last. Spark's defaults differ, so every
operator goes through these helpers.
"""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType


def col(c) -> Column:
    return c if isinstance(c, Column) else F.col(c)


def flag(cond) -> Column:
    """An undecided condition is false."""
    return F.coalesce(col(cond), F.lit(False))


def flag_int(cond) -> Column:
    return flag(cond).cast("int")


def is_in(c, values) -> Column:
    """Set membership that is never null; a null value is not in the set."""
    values = list(values)
    return flag(col(c).isin(values)) if values else F.lit(False)


def not_in(c, values) -> Column:
    """Complement of :func:`is_in`, so null rows pass."""
    return ~is_in(c, values)


def matches(c, pattern: str, ignore_case: bool = False) -> Column:
    return flag(col(c).rlike(("(?i)" if ignore_case else "") + pattern))


def n_distinct(*cols) -> Column:
    """Distinct count where null is one more value."""
    return F.count_distinct(F.struct(*[col(c) for c in cols]))


def n_distinct_if(c, cond) -> Column:
    """Distinct count of ``c`` over the rows where ``cond`` holds."""
    return F.count_distinct(F.when(col(cond), F.struct(col(c))))


def sum0(c) -> Column:
    """Sum of the known values; zero when there are none."""
    return F.coalesce(F.sum(col(c)), F.lit(0))


def count_where(cond) -> Column:
    return F.count_if(flag(cond))


def ratio(num, den) -> Column:
    """Division that gives null on a zero denominator."""
    return F.try_divide(col(num).cast("double"), col(den).cast("double"))


def pct(num, den, digits: int = 1) -> Column:
    return F.bround(F.try_divide(F.lit(100.0) * col(num), col(den).cast("double")), digits)


def pct_where(cond, digits: int = 1) -> Column:
    """Share of rows (as a percentage) where ``cond`` holds; undecided rows stay in the base."""
    return pct(count_where(cond), F.count(F.lit(1)), digits)


def pct_known(cond, digits: int = 1) -> Column:
    """As :func:`pct_where`, but rows where ``cond`` is undecided leave the base."""
    return pct(count_where(cond), F.count(col(cond)), digits)


def paste(sep: str, *cols) -> Column:
    """Join values as text, writing a missing value as ``NA``."""
    return F.concat_ws(sep, *[F.coalesce(col(c).cast("string"), F.lit("NA")) for c in cols])


def joined_values(c, sep: str) -> Column:
    """Sorted distinct known values of a group as one text. The result is as long as the value
    domain of ``c``, so use it on coded columns, not on free identifiers."""
    return F.array_join(F.array_sort(F.collect_set(col(c))), sep)


def all_of(conds) -> Column:
    return reduce(and_, conds, F.lit(True))


def any_of(conds) -> Column:
    return reduce(or_, conds, F.lit(False))


# What stands in for a missing key of each type; a mark beside it tells it from the real value.
STANDS_FOR_NULL = {"string": "", "boolean": False, "tinyint": 0, "smallint": 0, "int": 0, "bigint": 0, "float": 0.0, "double": 0.0, "date": "1970-01-01", "timestamp": "1970-01-01 00:00:00", "binary": b""}
#: Parts that rows without any key are dealt to, where a join is told to split them.
NULL_PARTS = 64


def _stand_ins(df: DataFrame, keys, prefix: str) -> dict[str, Column] | None:
    """Non-null columns that are equal exactly where the keys are (a null equals a null): each key with a stand-in for null, and one number for which keys are null.
    ``None`` if a key's type has no stand-in."""
    types = [df.schema[k].dataType.simpleString() for k in keys]
    kinds = ["decimal" if x.startswith("decimal") else x for x in types]
    if any(k != "decimal" and k not in STANDS_FOR_NULL for k in kinds):
        return None
    out = {f"{prefix}{i}": F.coalesce(F.col(f"`{k}`"), F.lit(STANDS_FOR_NULL.get(kind, 0)).cast(t)) for i, (k, kind, t) in enumerate(zip(keys, kinds, types, strict=True))}
    return out | {f"{prefix}z": sum((F.when(F.col(f"`{k}`").isNull(), 1 << i).otherwise(0) for i, k in enumerate(keys)), F.lit(0))}


def join_same(left: DataFrame, right: DataFrame, on, how: str = "left",
              right_on=None, broadcast: bool = False, split_null: bool = False) -> DataFrame:
    """Equi-join in which a null key matches a null key.

    Both sides get non-null stand-in keys, so Spark sees plain equality: a side that is already dealt by them is not shuffled again, and outer joins can be reduced.
    The right keys are dropped. ``broadcast`` is for lookups built from parameters, whose size
    is bounded by the parameter itself; data-sized sides are left to Spark's size statistics.
    ``split_null`` (left, inner, left_semi, left_anti) is for keys that many left rows lack: rows without any key are dealt to ``NULL_PARTS`` parts, and the few right rows
    without a key are repeated for each of them.
    """
    on = [on] if isinstance(on, str) else list(on)
    right_on = on if right_on is None else ([right_on] if isinstance(right_on, str) else list(right_on))
    a, b = _stand_ins(left, on, "__lk"), _stand_ins(right, right_on, "__rk")
    kind = lambda df, k: "number" if isinstance(df.schema[k].dataType, NumericType) else df.schema[k].dataType.simpleString()
    if a is None or b is None or any(kind(left, x) != kind(right, y) for x, y in zip(on, right_on, strict=True)):
        hidden = [f"__rk{i}" for i in range(len(right_on))]
        r = right.withColumnsRenamed(dict(zip(right_on, hidden)))
        r = F.broadcast(r) if broadcast else r
        out = left.join(r, all_of([left[x].eqNullSafe(r[y]) for x, y in zip(on, hidden)]), how)
        return out if how in ("left_semi", "left_anti") else out.drop(*hidden)
    lefts, rights = left.withColumns(a), right.withColumns(b).drop(*right_on)
    if split_null:
        if how not in ("left", "inner", "left_semi", "left_anti"):
            raise ValueError(f"rows without a key cannot be split in a {how} join")
        lacks = (1 << len(on)) - 1
        lefts = lefts.withColumn("__lks", F.when(F.col("__lkz") == lacks, F.spark_partition_id() % NULL_PARTS).otherwise(0))
        rights = rights.withColumn("__rks", F.explode(F.when(F.col("__rkz") == lacks, F.sequence(F.lit(0), F.lit(NULL_PARTS - 1))).otherwise(F.array(F.lit(0)))))
        a, b = a | {"__lks": None}, b | {"__rks": None}
    rights = F.broadcast(rights) if broadcast else rights
    out = lefts.join(rights, all_of([F.col(x) == F.col(y) for x, y in zip(a, b, strict=True)]), how)
    return out.drop(*a, *b)


def attach(df: DataFrame, keys, *aggs) -> DataFrame:
    """Group totals put back on the rows.

    Aggregation combines on the map side before anything is shuffled and the join back is open to
    Spark's skew-join split, so one hot group does not end up in one task as a window would put it.
    Rows are grouped by the stand-in keys they are joined by, so the totals are dealt once: two exchanges in all.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    stand = _stand_ins(df, keys, "__gk")
    if stand is None:
        return join_same(df, df.groupBy(*keys).agg(*aggs), keys)
    rows = df.withColumns(stand)
    return rows.join(rows.groupBy(*stand).agg(*aggs), list(stand), "left").drop(*stand)


def distinct_counts(df: DataFrame, by, entity: str, flags: dict[str, Column], total: str) -> DataFrame:
    """Distinct entities per group (null is one more), and how many have a row on which each flag holds.

    One row per group and entity first, then plain sums: several distinct counts in one aggregate would repeat every input row for each of them.
    """
    by = [by] if isinstance(by, str) else list(by)
    one = df.groupBy(*by, F.col(entity).alias("__e")).agg(*[F.max(flag_int(c)).alias(name) for name, c in flags.items()] or [F.lit(1).alias("__any")])
    return one.groupBy(*by).agg(F.count(F.lit(1)).alias(total), *[F.sum(name).cast("bigint").alias(name) for name in flags])


def top_row(df: DataFrame, keys, order, keep) -> DataFrame:
    """One row per key: the smallest by ``order`` (negate numbers for descending).

    ``order`` must settle ties through ``keep`` (compared last), which makes the pick repeatable.
    A partial aggregate, not a sort: hot keys are reduced before the shuffle.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    order_fields = [col(o).alias(f"o{i}") for i, o in enumerate(order)]
    best = df.groupBy(*keys).agg(F.min(F.struct(*order_fields, *[col(k) for k in keep])).alias("__best"))
    return best.select(*keys, *[F.col(f"__best.{k}").alias(k) for k in keep])


def nulls_last(c, descending: bool = False):
    c = col(c)
    return c.desc_nulls_last() if descending else c.asc_nulls_last()


def lookup(df: DataFrame, key: str, mapping: dict, out: str, default=None,
           value_type: str = "string") -> DataFrame:
    """Recode ``key`` through a parameter dict as one map expression (no join, no shuffle)."""
    if not mapping:
        return df.withColumn(out, F.lit(default).cast(value_type))
    pairs = [x for k, v in mapping.items() for x in (F.lit(str(k)), F.lit(v).cast(value_type))]
    value = F.try_element_at(F.create_map(*pairs), col(key).cast("string"))
    return df.withColumn(out, F.coalesce(value, F.lit(default).cast(value_type)))
