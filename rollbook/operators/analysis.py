"""Graduation criteria, pathway offerings, peer comparison, gaps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.nullsafe import any_of, col, count_where, flag, is_in, join_same, n_distinct, n_distinct_if, nulls_last, ratio
from ..functions.text import contains_word

ID = "D_stu_id"


def ever_rate(df: DataFrame, cond, prefix: str = "students", id_col: str = ID) -> DataFrame:
    """Distinct ids, those with at least one row where ``cond`` holds, and the share."""
    return df.agg(n_distinct(id_col).alias("num_students"), n_distinct_if(id_col, flag(cond)).alias("num_with")).withColumn(
        "pct_with", ratio("num_with", "num_students"))


def never_rate(df: DataFrame, conds: dict[str, Column], id_col: str = ID) -> DataFrame:
    """Share of ids for which none of the conditions ever held, and ids per condition."""
    per = df.groupBy(id_col).agg(*[F.max(flag(c).cast("int")).alias(n) for n, c in conds.items()])
    none = sum((F.col(n) for n in conds), F.lit(0)) == 0
    return per.agg(F.count(F.lit(1)).alias("num_students"), F.count_if(none).alias("num_never"),
                   *[F.count_if(F.col(n) == 1).alias(f"num_{n}") for n in conds]).withColumn("pct_never", ratio("num_never", "num_students"))


def courses_per_combo(df: DataFrame, by, course: str) -> DataFrame:
    return df.groupBy(*by).agg(n_distinct(course).alias("num_unique_courses"))


def combo_summary(combos: DataFrame, few: int = 3) -> DataFrame:
    return combos.agg((F.sum("num_unique_courses") / F.count(F.lit(1))).alias("average_unique_courses"),
                      F.count_if(F.col("num_unique_courses") <= few).alias("num_combos_few"), F.count(F.lit(1)).alias("total_combos"))


def credit_criterion(df: DataFrame, subject_col: str, subject: str, at_least: float = 2.0, earned="D_creds_earn", id_col: str = ID) -> DataFrame:
    """Of the ids with any row in the subject, how many reach the credits."""
    per = df.filter(F.col(subject_col) == subject).groupBy(id_col).agg(F.sum(earned).alias("c"))
    return per.agg(F.count(F.lit(1)).alias("num_students"), count_where(F.col("c") >= at_least).alias("num_reaching")).withColumn(
        "pct_reaching", ratio("num_reaching", "num_students"))


def year_criterion(df: DataFrame, subject_col: str, subjects: dict[str, str], at_least: int = 4, year="D_year", id_col: str = ID) -> DataFrame:
    """Ids with rows in each subject over at least ``at_least`` years, and in all of them."""
    per = df.groupBy(id_col).agg(*[n_distinct_if(year, flag(F.col(subject_col) == s)).alias(n) for n, s in subjects.items()])
    reach = {n: F.col(n) >= at_least for n in subjects}
    both = None
    for c in reach.values():
        both = c if both is None else both & c
    out = per.agg(F.count(F.lit(1)).alias("num_students"), *[F.count_if(c).alias(f"num_{n}") for n, c in reach.items()], F.count_if(both).alias("num_all"))
    return out.withColumns({f"pct_{n}": ratio(f"num_{n}", "num_students") for n in [*subjects, "all"]})


def keyword_criterion(df: DataFrame, name_col: str, all_of, any_of_words, id_col: str = ID) -> DataFrame:
    """Ids that took courses matching every word of the first list, and at least one of the second."""
    words = list(dict.fromkeys([*all_of, *any_of_words]))
    per = df.groupBy(id_col).agg(*[F.bool_or(flag(contains_word(name_col, w))).alias(f"w{i}") for i, w in enumerate(words)])
    at = lambda w: F.col(f"w{words.index(w)}")
    every = F.lit(True)
    for w in all_of:
        every = every & at(w)
    return per.agg(F.count(F.lit(1)).alias("num_students"), F.count_if(every).alias("num_every"),
                   F.count_if(any_of([at(w) for w in any_of_words])).alias("num_either")).withColumns(
        {"pct_every": ratio("num_every", "num_students"), "pct_either": ratio("num_either", "num_students")})


def criteria_flags(df: DataFrame, credit: tuple[str, float], years: dict[str, str], years_min: int, every, either, subject_col: str,
                   name_col: str, id_col: str = ID, year="D_year", earned="D_creds_earn") -> DataFrame:
    """All criteria per id in one grouping: credits in a subject, years per subject, keyword sets."""
    subject, amount = credit
    yes = lambda c: F.when(flag(c), "Y").otherwise("N")
    words = [*every, *either]
    per = df.groupBy(id_col).agg(
        F.coalesce(F.sum(F.when(F.col(subject_col) == subject, F.col(earned))), F.lit(0.0)).alias("c"),
        *[n_distinct_if(year, flag(F.col(subject_col) == s)).alias(f"y_{n}") for n, s in years.items()],
        *[F.bool_or(flag(contains_word(name_col, w))).alias(f"w{i}") for i, w in enumerate(words)])
    e = F.lit(True)
    for i in range(len(every)):
        e = e & F.col(f"w{i}")
    o = any_of([F.col(f"w{i}") for i in range(len(every), len(words))])
    return per.select(id_col, yes(F.col("c") >= amount).alias("credit_flag"), *[yes(F.col(f"y_{n}") >= years_min).alias(f"years_{n}_flag") for n in years],
                      yes(e).alias("every_flag"), yes(o).alias("either_flag"))


def flags_onto_rows(df: DataFrame, flags: DataFrame, id_col: str = ID) -> DataFrame:
    return join_same(df, flags, id_col)


def all_criteria(flags: DataFrame, columns) -> DataFrame:
    every = F.lit(True)
    for c in columns:
        every = every & flag(F.col(c) == "Y")
    return flags.agg(F.count(F.lit(1)).alias("num_students"), F.count_if(every).alias("num_all")).withColumn("pct_all", ratio("num_all", "num_students"))


def offering_table(df: DataFrame, by, course: str, offered, id_col: str = ID) -> DataFrame:
    """Students per offered course against students in the pathway, by school and pathway."""
    total = df.groupBy(*by).agg(n_distinct(id_col).alias("num_students_in_pathway"))
    counts = df.filter(flag(offered) & F.col(course).isNotNull()).groupBy(*by, course).agg(n_distinct(id_col).alias("num_students_in_course"))
    return join_same(counts, total, list(by)).withColumn("pct_students_in_course", ratio("num_students_in_course", "num_students_in_pathway"))


def peer_comparison(df: DataFrame, school_col: str, pathway_col: str, course: str, school: str, peers, pathways) -> DataFrame:
    """Distinct courses per pathway: the chosen school, then one column per peer."""
    d = df.filter(is_in(pathway_col, pathways))
    own = d.filter(F.col(school_col) == school).groupBy(pathway_col).agg(n_distinct(course).alias("own_offerings"))
    wide = d.filter(flag(F.col(school_col) != school)).groupBy(pathway_col).pivot(school_col, list(peers)).agg(n_distinct(course))
    return join_same(own, wide, pathway_col)


def gap_list(df: DataFrame, school_col: str, pathway_col: str, course: str, school: str, pathways) -> DataFrame:
    """Courses of a pathway offered elsewhere and not at the chosen school, with where."""
    d = df.filter(is_in(pathway_col, pathways))
    own = d.filter(F.col(school_col) == school).select(pathway_col, course).distinct()
    others = d.filter(flag(F.col(school_col) != school)).select(school_col, pathway_col, course).distinct()
    return join_same(others, own, [pathway_col, course], "left_anti")
