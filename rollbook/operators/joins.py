"""Checked joins, crosswalks, course coding, cross-file reconciliation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.nullsafe import (attach, col, count_where, flag, is_in, join_same, lookup, n_distinct, n_distinct_if,
                                  nulls_last, pct, pct_where, top_row)
from ..functions.text import plain_name
from .checks import Check, CheckFailed, need_columns, unique

MATCHED = "H_matched"


def _keys(on):
    """``on`` as ([left names], [right names]); a dict gives differing names."""
    if isinstance(on, dict):
        return list(on), list(on.values())
    on = [on] if isinstance(on, str) else list(on)
    return on, on


def join_checked(left: DataFrame, right: DataFrame, on, name: str = "join", log=None,
                 allow_expansion: bool = False, min_match_pct: float | None = None,
                 keep_marker: bool = False) -> DataFrame:
    """Left join that stops on missing keys, repeated right keys or a low match rate.

    Unique right keys imply an unchanged row count, so the count is not taken twice. With a ``log`` the
    gates run as actions; without one only the key columns are verified and the join stays lazy.
    The match rate reads a literal marker, so a matched row with null attributes counts as matched.
    """
    lk, rk = _keys(on)
    need_columns(left, lk, f"{name}: left keys")
    need_columns(right, rk, f"{name}: right keys")
    if log is not None and not allow_expansion:
        log.require(unique(right, rk, f"{name}: right keys are unique"))
    out = join_same(left, right.withColumn(MATCHED, F.lit(True)), lk, right_on=rk)
    if log is not None:
        r = match_rate(out).first()
        log.info(f"{name}: match rate", f"{r['pct_matched']}% of {r['n_rows']} rows")
        if min_match_pct is not None:
            low = r["pct_matched"] is None or r["pct_matched"] < min_match_pct
            log.require(Check(f"{name}: match rate at least {min_match_pct}%",
                              unmatched_keys(out, lk) if low else unmatched_keys(out, lk).limit(0)))
    return out if keep_marker else out.drop(MATCHED)


def match_rate(joined: DataFrame, digits: int = 2) -> DataFrame:
    return joined.agg(F.count(F.lit(1)).alias("n_rows"), F.count(MATCHED).alias("n_matched")).withColumn(
        "pct_matched", pct("n_matched", "n_rows", digits))


def unmatched_keys(joined: DataFrame, keys) -> DataFrame:
    return joined.filter(F.col(MATCHED).isNull()).select(*keys).distinct()


def semi(left: DataFrame, right: DataFrame, on) -> DataFrame:
    lk, rk = _keys(on)
    return join_same(left, right.select(*rk), lk, "left_semi", right_on=rk)


def anti(left: DataFrame, right: DataFrame, on) -> DataFrame:
    lk, rk = _keys(on)
    return join_same(left, right.select(*rk), lk, "left_anti", right_on=rk)


def inner(left: DataFrame, right: DataFrame, on) -> DataFrame:
    lk, rk = _keys(on)
    return join_same(left, right, lk, "inner", right_on=rk)


def companion(df: DataFrame, keys, is_source, value: str, out: str) -> DataFrame:
    """Put a companion row's value on every row of the same key.

    The companion is the row of the key where ``is_source`` holds; of several, the smallest value
    counts. A conditional aggregate replaces the self join.
    """
    source = df.filter(flag(is_source)).groupBy(*keys).agg(
        F.min(F.struct(F.col(value))).alias("__s")).select(*keys, F.col(f"__s.{value}").alias(out), F.lit(True).alias(f"{out}_found"))
    joined = join_same(df, source, keys)
    return joined.withColumn(f"{out}_found", flag(f"{out}_found"))


def code_courses(transcript: DataFrame, coding: DataFrame, id_col="D_course_id", name_col="D_course_name",
                 coded_id="C_course_id", fallback: bool = True, needs: str | None = None) -> DataFrame:
    """Coded fields by id and name, then by id alone where an id stands for a single coded course.

    Coding keys should be unique (``gated.keyed``): a repeated one multiplies rows. ``needs``: a coded field without which a match does not count as coded; such a row
    goes on to the fallback, as one without a match does.

    ``C_coding_source`` says which: ``id_and_name`` / ``id_only`` / null. The id-only row is the one with
    the smallest course name. Pairs of id and name are coded, not rows, so the rows are joined once.
    """
    rows, transcript = transcript, transcript.select(id_col, name_col).distinct()
    fields = [c for c in coding.columns if c not in (id_col, name_col)]
    if needs is not None:
        need_columns(coding, [needs], "course coding")
    coded = flag(F.col(needs).isNotNull()) if needs is not None else F.lit(True)
    exact = coding.filter(coded).select(id_col, name_col, F.struct(*fields).alias("__exact"))
    out = join_same(transcript, exact, [id_col, name_col])
    if fallback:
        single = coding.groupBy(id_col).agg(
            n_distinct(coded_id).alias("__n"),
            F.min(F.struct(F.col(name_col), F.struct(*fields).alias("f"))).alias("__m"))
        single = single.filter("__n = 1").filter(F.col(f"__m.f.{needs}").isNotNull() if needs is not None else F.lit(True)).select(id_col, F.col("__m.f").alias("__single"))
        out = join_same(out, single, id_col)
    else:
        out = out.withColumn("__single", F.lit(None).cast(coding.select(F.struct(*fields)).schema[0].dataType))
    chosen = F.coalesce("__exact", "__single")
    source = F.when(F.col("__exact").isNotNull(), "id_and_name").when(F.col("__single").isNotNull(), "id_only")
    coded_pairs = out.select(id_col, name_col, source.alias("C_coding_source"), chosen.alias("__c"))
    return join_same(rows, coded_pairs, [id_col, name_col]).select("*", *[F.col(f"__c.{f}").alias(f) for f in fields]).drop("__c")


def coding_preview(transcript: DataFrame, coding: DataFrame, id_col="D_course_id", name_col="D_course_name") -> DataFrame:
    """How well a coding table would join: pairs, exact pairs, and rows matched exactly, after folding
    the names, and on the id alone. The transcript is reduced to pairs with row counts first."""
    pair = [id_col, name_col]
    t = transcript.groupBy(*pair).agg(F.count(F.lit(1)).alias("n"))
    c = coding.select(*pair).distinct()
    fold = lambda d: d.withColumns({"k_id": F.trim(id_col), "k_name": plain_name(name_col)})
    t = join_same(t, c.withColumn("exact", F.lit(1)), pair)
    t = join_same(fold(t), fold(c).select("k_id", "k_name").distinct().withColumn("folded", F.lit(1)), ["k_id", "k_name"])
    t = join_same(t, c.select(id_col).distinct().withColumn("by_id", F.lit(1)), id_col)
    rows = lambda m: F.coalesce(F.sum(F.when(F.col(m) == 1, F.col("n"))), F.lit(0))
    left = t.agg(F.count(F.lit(1)).alias("pairs_transcript"), F.count("exact").alias("pairs_exact"), F.sum("n").alias("n_rows"),
                 rows("exact").alias("rows_exact"), rows("folded").alias("rows_folded"), rows("by_id").alias("rows_by_id"))
    return left.join(c.agg(F.count(F.lit(1)).alias("pairs_coding")), F.lit(True))


def unmatched_pairs(transcript: DataFrame, coding: DataFrame, pair=("D_course_id", "D_course_name")) -> DataFrame:
    t = transcript.groupBy(*pair).agg(F.count(F.lit(1)).alias("n_rows"))
    return anti(t, coding, list(pair)).orderBy(F.desc("n_rows"), *[nulls_last(c) for c in pair])


# --- locations ---------------------------------------------------------------

def location_crosswalk(df: DataFrame, id_col: str, name_col: str, include=None) -> DataFrame:
    """Rows per (location id, name), with the number of names of the id, of ids of the name, and
    whether the name is in scope. A table without the id column uses the name as the key."""
    if id_col not in df.columns:
        df = df.withColumn(id_col, F.col(name_col))
    x = df.groupBy(F.col(id_col).alias("location_id"), F.col(name_col).alias("location_name")).agg(
        F.count(F.lit(1)).alias("n_rows"))
    x = attach(x, "location_id", F.count(F.lit(1)).alias("n_names"))
    x = attach(x, "location_name", F.count(F.lit(1)).alias("n_ids"))
    return x.withColumn("included", is_in("location_name", include) if include is not None else F.lit(True))


def unresolved_names(crosswalk: DataFrame, include) -> Check:
    """Every listed name must occur. The list is a parameter, so it becomes a literal table."""
    spark = crosswalk.sparkSession
    wanted = spark.createDataFrame([(n,) for n in include], "location_name string")
    return Check("every listed location exists", anti(wanted, crosswalk, "location_name"))


def included_ids(crosswalk: DataFrame) -> DataFrame:
    return crosswalk.filter("included").select("location_id").distinct()


def canonical_names(df: DataFrame, id_col: str, name_col: str, out: str = "C_location_name_canonical", weight: str | None = None) -> DataFrame:
    """Give each id its most frequent name; equal counts go to the first name in text order.

    ``weight`` is the number of rows each input row stands for, when the input is already counted.
    """
    counts = df.groupBy(id_col, name_col).agg((F.sum(weight) if weight else F.count(F.lit(1))).alias("n"))
    best = top_row(counts, id_col, [-F.col("n")], [name_col]).withColumnRenamed(name_col, out)
    return join_same(df, best, id_col)


def count_renamed(df: DataFrame, name_col: str, canonical: str = "C_location_name_canonical") -> DataFrame:
    return df.agg(count_where(F.col(name_col) != F.col(canonical)).alias("n_renamed"))


def merge_plan(df: DataFrame, id_col: str, name_col: str, year_col: str, merges, weight: str | None = None) -> DataFrame:
    """One row per absorbed name: survivor ids, absorbed ids, shared years, rows remapped.

    ``merges``: ``[{"name", "absorbs": [...], "allow_overlap"}]``. ``result`` is FAIL when the survivor is
    not exactly one id, the absorbed name does not occur, or years overlap without permission.
    """
    pairs = [(m["name"], a, bool(m.get("allow_overlap", False))) for m in merges for a in m["absorbs"]]
    plan = df.sparkSession.createDataFrame(pairs, "survivor string, absorbed string, allow_overlap boolean")
    names = sorted({x for p in pairs for x in p[:2]})
    seen = df.filter(is_in(name_col, names)).groupBy(F.col(name_col).alias("nm"), F.col(id_col).alias("id"), F.col(year_col).alias("yr")).agg(
        (F.sum(weight) if weight else F.count(F.lit(1))).alias("n"))
    per_name = seen.groupBy("nm").agg(F.array_sort(F.collect_set("id")).alias("ids"),
                                      F.array_sort(F.collect_set("yr")).alias("years"), F.sum("n").alias("n"))
    s = per_name.select(F.col("nm").alias("survivor"), F.col("ids").alias("s_ids"), F.col("years").alias("s_years"))
    a = per_name.select(F.col("nm").alias("absorbed"), F.col("ids").alias("a_ids"), F.col("years").alias("a_years"),
                        F.col("n").alias("rows_remapped"))
    out = plan.join(s, "survivor", "left").join(a, "absorbed", "left")
    shared = F.coalesce(F.size(F.array_intersect("s_years", "a_years")), F.lit(0))
    ok = (F.coalesce(F.size("s_ids"), F.lit(0)) == 1) & F.col("a_ids").isNotNull() & (F.col("allow_overlap") | (shared == 0))
    return out.withColumns({"n_shared_years": shared, "result": F.when(flag(ok), "PASS").otherwise("FAIL")})


def apply_merges(df: DataFrame, plan: DataFrame, id_col: str, name_col: str) -> DataFrame:
    """Remap absorbed ids to the survivor; the reported id and name stay. Rows follow the id, so a site
    variant of an absorbed name moves too. A merge that fails its rules raises."""
    failed = [f"{r['absorbed']} into {r['survivor']}" for r in plan.filter("result <> 'PASS'").select("absorbed", "survivor").collect()]  # one row per declared merge
    if failed:
        raise CheckFailed("merges that fail their rules: " + "; ".join(sorted(failed)))
    moves = plan.select(F.explode("a_ids").alias("from_id"), F.col("s_ids")[0].alias("to_id"),
                                                   F.col("survivor").alias("to_name"))
    out = join_same(df, moves, id_col, right_on="from_id")
    return out.withColumns({"C_location_id": F.coalesce("to_id", id_col),
                            "C_location_name_merged": F.coalesce("to_name", name_col)}).drop("to_id", "to_name")


def related_distinct(crosswalk: DataFrame, related) -> DataFrame:
    """Declared related pairs with their ids; FAIL where a pair meant to stay apart shares its ids."""
    pairs = [(r["from"], r["to"], bool(r.get("merge", False))) for r in related]
    plan = crosswalk.sparkSession.createDataFrame(pairs, "from_name string, to_name string, merge boolean")
    ids = crosswalk.filter(is_in("location_name", sorted({x for p in pairs for x in p[:2]}))).groupBy("location_name").agg(
        F.array_join(F.array_sort(F.collect_set(F.col("location_id").cast("string"))), "/").alias("ids"))
    pick = lambda n: ids.select(F.col("location_name").alias(f"{n}_name"), F.col("ids").alias(f"{n}_ids"))
    out = plan.join(pick("from"), "from_name", "left").join(pick("to"), "to_name", "left")
    clash = flag(~F.col("merge") & (F.col("from_ids") == F.col("to_ids")))
    return out.withColumn("result", F.when(clash, "FAIL").otherwise("PASS"))


def year_presence(df: DataFrame, id_col: str, name_col: str, year_col: str, years) -> DataFrame:
    """Rows per location, one column per year."""
    return (df.groupBy(id_col, name_col).pivot(year_col, list(years)).agg(F.count(F.lit(1)))
              .fillna(0).withColumnsRenamed({str(y): f"y{y}" for y in years}))


def year_gaps(df: DataFrame, id_col: str, name_col: str, year_col: str, expected: dict | None = None) -> DataFrame:
    """Missing location-years. ``declared`` is true for a year that an override left out of the
    expected years of that name. Years come from the data; locations x years is a small table."""
    seen = df.select(F.col(id_col).alias("location_id"), F.col(name_col).alias("location_name"), F.col(year_col).alias("year")).distinct()
    years = seen.select("year").distinct().agg(F.array_sort(F.collect_set("year")).alias("years"))
    asked = seen.select("location_id", "location_name").distinct().join(years, F.lit(True)).select(
        "location_id", "location_name", F.explode("years").alias("year"))
    missing = anti(asked, seen, ["location_id", "year"])
    want = F.lit(None).cast("array<int>")
    for name, ys in (expected or {}).items():
        want = F.when(F.col("location_name") == name, F.array(*[F.lit(int(y)) for y in ys])).otherwise(want)
    return missing.withColumn("declared", flag(~F.array_contains(want, F.col("year").cast("int"))))


# --- two files of one population -------------------------------------------------

def span_position(missing: DataFrame, enrolled: DataFrame, id_col="D_stu_id", year_col="D_year") -> DataFrame:
    """Where an unmatched year lies against the id's first and last enrolled year."""
    span = enrolled.groupBy(id_col).agg(F.min(year_col).alias("first_enrolled"), F.max(year_col).alias("last_enrolled"),
                                        n_distinct(year_col).alias("n_enrolled_years"))
    y = F.col(year_col)
    return join_same(missing, span, id_col).withColumn("position", (
        F.when(F.col("first_enrolled").isNull(), "absent from enrolment")
         .when(y < F.col("first_enrolled"), "before first enrolled year")
         .when(y > F.col("last_enrolled"), "after last enrolled year")
         .otherwise("gap inside enrolled span")))


def modal_value(df: DataFrame, keys, column: str, out: str) -> DataFrame:
    """Most frequent value per key (smallest of equals) and the number of different values."""
    n = df.groupBy(*keys, column).agg(F.count(F.lit(1)).alias("n"))
    best = n.groupBy(*keys).agg(F.min(F.struct(-F.col("n"), F.col(column).isNull(), F.col(column).alias("v"))).alias("m"), F.count(F.lit(1)).alias(f"n_{out}_values"))
    return best.select(*keys, F.col("m.v").alias(out), f"n_{out}_values")


def grade_agreement(transcript: DataFrame, spells: DataFrame, keys=("D_stu_id", "D_year"),
                    t_grade="D_stu_grade_level_transcript", s_grade="D_stu_grade_level_demo", days="M_days_enrolled") -> DataFrame:
    """Modal transcript grade against the grade of the longest spell, per student-year."""
    keys = list(keys)
    a = modal_value(transcript, keys, t_grade, "grade_tr")
    b = top_row(spells, keys, [-F.col(days)], [s_grade]).withColumnRenamed(s_grade, "grade_demo")
    return inner(a, b, keys).withColumn("diff", F.col("grade_tr") - F.col("grade_demo"))


def difference_table(cmp: DataFrame) -> DataFrame:
    from .aggregates import share_counts
    return share_counts(cmp, ["diff"], digits=2, name="n_student_years")


def reconcile(transcript: DataFrame, spells: DataFrame, agreement: DataFrame, id_col="D_stu_id", year_col="D_year") -> DataFrame:
    """% of transcript ids and id-years found in enrolment, and % of student-years whose grade agrees."""
    t = transcript.select(id_col, year_col).distinct()
    s = spells.select(id_col, year_col).distinct().withColumn("y", F.lit(1))
    ids = spells.select(id_col).distinct().withColumn("i", F.lit(1))
    m = join_same(join_same(t, s, [id_col, year_col]), ids, id_col)
    a = m.agg(n_distinct(id_col).alias("n_ids"), n_distinct_if(id_col, F.col("i") == 1).alias("ids_found"),
              F.count(F.lit(1)).alias("n_id_years"), F.count("y").alias("id_years_found"))
    b = agreement.agg(F.count(F.lit(1)).alias("n_compared"), count_where(F.col("diff") == 0).alias("n_agree"))
    return a.join(b, F.lit(True)).select(
        "*", pct("ids_found", "n_ids", 2).alias("pct_ids_found"),
        pct("id_years_found", "n_id_years", 2).alias("pct_id_years_found"), pct("n_agree", "n_compared", 2).alias("pct_agree"))


def replace_coding(df: DataFrame, coding: DataFrame, keys) -> DataFrame:
    """Drop coded columns already there, then attach the coding table by ``keys``."""
    fields = [c for c in coding.columns if c not in keys]
    return join_checked(df.drop(*fields), coding, list(keys), "course coding")
