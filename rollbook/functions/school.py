"""Fields specific to classes, staff and grades."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .nullsafe import col, paste

TIME_COLUMNS = ("D_expression", "D_period", "D_rotation", "D_term")
SLOT = ("C_term_exploded", "C_period_exploded", "C_rotation_exploded")

# Grade letters from best to worst, and the licence label of each licence type.
GRADE_LETTERS = ("A", "B", "C", "D", "F")
LICENCE_LABELS = {
    "Professional": "1 - Professional",
    "Initial - Extension": "2 - Initial",
    "Initial": "2 - Initial",
    "Provisional": "3 - Provisional",
    "Preliminary-Extension": "3 - Provisional",
    "Preliminary": "3 - Provisional",
    "Temporary": "3 - Provisional",
    "Emergency-Extension II": "4 - Emergency",
}
NO_LICENCE = "5 - Not licensed"


def class_id(columns, recipe, sep: str = "_") -> Column:
    """Id from the recipe columns that exist; null when none does."""
    present = [c for c in recipe if c in columns]
    return paste(sep, *present) if present else F.lit(None).cast("string")


def slot_class_id(columns, recipe, sep: str = "_") -> Column:
    """Class id at time-slot level: the recipe's time columns give way to the slot columns."""
    return class_id(columns, [c for c in recipe if c not in TIME_COLUMNS] + list(SLOT), sep)


def letter_grade(c) -> Column:
    letter = F.regexp_extract(col(c), r"^[A-F]", 0)
    return F.when(letter != "", letter)


def letter_rank(c) -> Column:
    """1 for the best letter; letters without a rank give null."""
    return F.nullif(F.array_position(F.array(*[F.lit(x) for x in GRADE_LETTERS]), col(c)), F.lit(0)).cast("int")


def pct_grade(c) -> Column:
    return col(c).try_cast("double")


def proficiency(cond) -> Column:
    cond = col(cond)
    return F.when(cond, F.lit("Proficient")).when(~cond, F.lit("Below Proficient"))


def combined_proficiency(ela, math) -> Column:
    """Both known: equal labels stand, different ones are partial. One known: that one."""
    e, m = col(ela), col(math)
    return (F.when(e.isNull() | m.isNull(), F.coalesce(e, m))
             .when(e == m, e).otherwise(F.lit("Partially Proficient")))


def licence_label(c) -> Column:
    pairs = F.create_map(*[F.lit(x) for kv in LICENCE_LABELS.items() for x in kv])
    return F.when(col(c).isNull(), F.lit(NO_LICENCE)).otherwise(F.try_element_at(pairs, col(c)))


def novice_by_rank(rank, threshold: int = 7) -> Column:
    r = col(rank)
    return (F.when(r.isNull(), F.lit("Not licensed"))
             .when(r >= threshold, F.lit("Novice")).otherwise(F.lit("Experienced")))


def novice_by_years(years, threshold: float = 2) -> Column:
    y = col(years)
    return F.when(y <= threshold, F.lit("Novice")).when(y > threshold, F.lit("Not Novice"))


def share_bucket(c) -> Column:
    """Share of a class in a group, in three bands."""
    x = col(c)
    return (F.when(x <= 0.2, F.lit("0-20%")).when(x < 0.5, F.lit("20-50%"))
             .when(x <= 1, F.lit(">50%")).otherwise(F.lit("Error")))
