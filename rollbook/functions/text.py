"""Names, course ids, patterns and labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .nullsafe import col, flag, matches


def squish(c) -> Column:
    return F.trim(F.regexp_replace(col(c), r"\s+", " "))


def clean_header(name: str) -> str:
    """Lower snake case for one column header."""
    import re
    s = re.sub(r"([a-z0-9])([A-Z])", r"\1_\2", name.strip())
    s = re.sub(r"[^A-Za-z0-9]+", "_", s).strip("_").lower()
    return s or "x"


def clean_location_name(c, strip_prefix=None, strip_suffix=None, aliases=None) -> Column:
    """Strip a year stamp and a grade span, collapse blanks, then apply declared aliases."""
    out = col(c).cast("string")
    if strip_prefix:
        out = F.regexp_replace(out, strip_prefix, "")
    if strip_suffix:
        out = F.regexp_replace(out, strip_suffix, "")
    out = squish(out)
    if aliases:
        pairs = F.create_map(*[F.lit(x) for kv in aliases.items() for x in kv])
        out = F.coalesce(F.try_element_at(pairs, out), out)
    return out


def first_pattern(sources, rules, ignore_case: bool = True) -> tuple[Column, Column]:
    """(value, source name) of the first rule that hits, trying each source in turn."""
    value, where = [], []
    for name in sources:
        for pattern, label in rules:
            hit = matches(F.col(name).cast("string"), pattern, ignore_case)
            value.append(F.when(hit, F.lit(label)))
            where.append(F.when(hit, F.lit(name)))
    return F.coalesce(*value), F.coalesce(*where)


def base_course_id(c, strip_suffix: str) -> Column:
    """Course id without its term suffix. Only the first hit of the pattern is removed."""
    return F.regexp_replace(col(c), f"^(.*?)(?:{strip_suffix})", "$1")


def starred(c) -> Column:
    return flag(col(c).contains("*"))


def plain_name(c) -> Column:
    """Name folded for matching: no asterisks, single blanks, lower case."""
    return F.lower(squish(F.regexp_replace(col(c), r"\*", "")))


def slug(c) -> Column:
    return F.replace(F.lower(col(c)), F.lit(" "), F.lit("_"))


def contains_word(c, word: str) -> Column:
    """Case-insensitive substring test; null stays null."""
    return F.contains(F.lower(col(c)), F.lit(word.lower()))


def natural_key(c) -> Column:
    """Sort key that orders digit runs of any length as numbers: the count of digits without leading zeros stands before them."""
    number = lambda x: F.ltrim(x, F.lit("0"))
    runs = F.regexp_extract_all(col(c), F.lit(r"\d+|\D+"), F.lit(0))
    return F.array_join(F.transform(runs, lambda x: F.when(x.rlike(r"^\d"), F.concat(F.lpad(F.length(number(x)).cast("string"), 10, "0"), number(x))).otherwise(x)), "")


def natural_sort(arr) -> Column:
    keyed = F.transform(arr, lambda x: F.struct(natural_key(x).alias("k"), x.alias("v")))
    return F.transform(F.array_sort(keyed), lambda s: s["v"])


def collapse_names(df, names: str, out: str):
    """One label from an array column of course names, which is replaced by ``out``.

    Names that are whole-word parts of another are dropped; a shared leading run of words is written
    once, followed by the differing endings joined with `` / ``. Each stage is its own column, so Spark
    evaluates it once per row.
    """
    pad = lambda x: F.concat(F.lit(" "), x, F.lit(" "))
    df = df.withColumn("__u", F.array_distinct(F.filter(F.transform(names, squish), lambda x: x.isNotNull() & (x != ""))))
    df = df.withColumn("__k", natural_sort(F.filter("__u", lambda a: ~F.exists("__u", lambda b: (a != b) & F.contains(pad(b), pad(a))))))
    df = df.withColumn("__w", F.transform("__k", lambda x: F.split(x, " ")))
    df = df.withColumn("__s", F.coalesce(F.array_min(F.transform("__w", F.size)), F.lit(0)))
    first = F.get("__w", F.lit(0))
    agree = F.filter(F.sequence(F.lit(1), F.greatest("__s", F.lit(1))), lambda n: F.forall("__w", lambda w: F.slice(w, F.lit(1), n) == F.slice(first, F.lit(1), n)))
    df = df.withColumn("__n", F.least(F.size(agree), F.col("__s")))
    ends = F.filter(F.transform("__w", lambda w: F.array_join(F.slice(w, F.col("__n") + 1, F.greatest(F.size(w) - F.col("__n"), F.lit(0))), " ")), lambda x: x != "")
    label = (F.when(F.size("__k") == 0, F.lit(None).cast("string"))
              .when(F.size("__k") == 1, F.get("__k", F.lit(0)))
              .when(F.col("__n") == 0, F.array_join("__k", " / "))
              .otherwise(squish(F.concat(F.array_join(F.slice(first, F.lit(1), F.col("__n")), " "), F.lit(" "), F.array_join(natural_sort(ends), " / ")))))
    return df.withColumn(out, label).drop(names, "__u", "__k", "__w", "__s", "__n")
