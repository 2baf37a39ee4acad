"""Bounds, buckets and credit rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .nullsafe import any_of, col, flag


def outside(c, low=None, high=None) -> Column:
    """True only for known values beyond a given bound."""
    tests = []
    if low is not None:
        tests.append(col(c) < F.lit(low))
    if high is not None:
        tests.append(col(c) > F.lit(high))
    return flag(any_of(tests))


def blank_if(c, cond) -> Column:
    return F.when(~flag(cond), col(c))


def two_tier(df: DataFrame, c: str, plausible=(None, None), hard=(None, None), hard_action: str = "flag",
             plausible_flag: str | None = None, hard_flag: str | None = None) -> DataFrame:
    """Flag values outside the plausible and the hard bounds; ``na`` blanks the latter.

    The tolerance gate is a check on the hard flag (see ``operators.checks.gate_share``).
    """
    pf, hf = plausible_flag or f"{c}_outside_plausible", hard_flag or f"{c}_outside_hard"
    df = df.withColumns({pf: outside(c, *plausible), hf: outside(c, *hard)})
    return df.withColumn(c, blank_if(c, hf)) if hard_action == "na" else df


def _num(x) -> str:
    return f"{x:g}"


def tail_bucket(c, breaks) -> Column:
    """Left-closed buckets above the first break; the last bucket also holds its upper end."""
    out = F.lit(None).cast("string")
    last = len(breaks) - 2
    for i in range(last, -1, -1):
        lo, hi = breaks[i], breaks[i + 1]
        closed = i == last
        hit = (col(c) >= lo) & ((col(c) <= hi) if closed else (col(c) < hi))
        out = F.when(hit, F.lit(f"[{_num(lo)},{_num(hi)}{']' if closed else ')'}")).otherwise(out)
    return F.when(col(c) > breaks[0], out)


def cut_right(c, breaks) -> Column:
    """Right-closed buckets; the lowest break belongs to the first bucket."""
    out = F.lit(None).cast("string")
    for i in range(len(breaks) - 2, -1, -1):
        lo, hi = breaks[i], breaks[i + 1]
        hit = ((col(c) >= lo) if i == 0 else (col(c) > lo)) & (col(c) <= hi)
        out = F.when(hit, F.lit(f"{'[' if i == 0 else '('}{_num(lo)},{_num(hi)}]")).otherwise(out)
    return out


def bucket_down(c, buckets) -> Column:
    """``[(min, label), ...]`` tried from the top of the list; below every minimum is null."""
    out = None
    for low, label in buckets:
        hit = col(c) >= F.lit(low)
        out = F.when(hit, F.lit(label)) if out is None else out.when(hit, F.lit(label))
    return out


def bucket_label(low, high) -> str:
    return f"{_num(low)}+" if high is None else f"{_num(low)}-{_num(high)}"


def bucketize(c, buckets) -> Column:
    """``[(min, max), ...]`` ascending; a value takes the last bucket whose minimum it reaches."""
    return bucket_down(c, [(lo, bucket_label(lo, hi)) for lo, hi in reversed(buckets)])


def earned_exceeds(earned="D_creds_earn", attempted="D_creds_possible") -> Column:
    return flag(col(earned) > col(attempted))


def impossible_credits(df: DataFrame, above: float, rule: str = "na", earned="D_creds_earn") -> DataFrame:
    """``na`` blanks the figure and keeps the row; ``drop`` removes the row; ``keep`` does nothing."""
    bad = flag(col(earned) > above)
    if rule == "na":
        return df.withColumn("C_creds_impossible", bad).withColumn(earned, blank_if(earned, "C_creds_impossible"))
    if rule == "drop":
        return df.filter(~bad)
    if rule == "keep":
        return df
    raise ValueError(f"unknown rule for impossible credits: {rule}")


def excess_credits(df: DataFrame, rule: str = "flag", earned="D_creds_earn",
                   marker="C_creds_earn_exceeds_attempted") -> DataFrame:
    if rule == "flag":
        return df
    if rule == "na_earned":
        return df.withColumn(earned, blank_if(earned, marker))
    raise ValueError(f"unknown rule for excess credits: {rule}")


def course_failed(earned="D_creds_earn", attempted="D_creds_possible") -> Column:
    return flag((col(attempted) > 0) & (col(earned) == 0))
