"""Dates and enrolment duration."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .nullsafe import col


def blank_to_null(c) -> Column:
    t = col(c).cast("string")
    return F.when(F.trim(t) == "", F.lit(None)).otherwise(t)


def parse_date(c, formats) -> Column:
    """First format that reads the text; null when blank or unreadable."""
    raw = blank_to_null(c)
    return F.coalesce(*[F.try_to_date(raw, f) for f in formats])


def date_unreadable(c, formats) -> Column:
    return blank_to_null(c).isNotNull() & parse_date(c, formats).isNull()


def fill_date(c, fallback) -> Column:
    return F.coalesce(col(c), col(fallback))


def year_date(year, month: int, day: int, offset: int = 0) -> Column:
    return F.make_date(col(year) + F.lit(offset), F.lit(month), F.lit(day))


def school_year_of(d, first_month: int = 8) -> Column:
    """The calendar year in which the school year containing ``d`` ends."""
    return (F.year(col(d)) + (F.month(col(d)) >= first_month).cast("int")).cast("int")


def enrolment_days(df, year="D_year", enter="D_stu_enter_date", exit_="D_stu_exit_date",
                   start=(8, 1), end=(6, 30), clamp: bool = True):
    """School-year window, window flags, clamped dates and days enrolled (last day not counted; unknown where a date is)."""
    df = df.withColumns({
        "H_year_start": year_date(year, *start, offset=-1),
        "H_year_end": year_date(year, *end),
    })
    # greatest and least skip nulls, so an unknown date is kept unknown first
    lo = F.when(col(enter).isNotNull(), F.greatest(col(enter), F.col("H_year_start"))) if clamp else col(enter)
    hi = F.when(col(exit_).isNotNull(), F.least(col(exit_), F.col("H_year_end"))) if clamp else col(exit_)
    return df.withColumns({
        "C_spell_before_window": col(exit_) < F.col("H_year_start"),
        "C_spell_after_window": col(enter) > F.col("H_year_end"),
        "H_enter_clamped": lo,
        "H_exit_clamped": hi,
        "M_days_enrolled": F.datediff(hi, lo),
    })


def negative_days(df, rule: str = "floor_zero", days="M_days_enrolled"):
    """``floor_zero`` | ``drop`` | ``keep``."""
    if rule == "floor_zero":
        return df.withColumn(days, F.when(col(days) < 0, F.lit(0)).otherwise(col(days)))
    if rule == "drop":
        return df.filter(col(days) >= 0)
    if rule == "keep":
        return df
    raise ValueError(f"unknown rule for negative days: {rule}")
