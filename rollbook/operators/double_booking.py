"""Double bookings: detect, resolve by class, teacher and student, and bring the table back together."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.nullsafe import (attach, col, count_where, distinct_counts, flag, flag_int, is_in, join_same, n_distinct, n_distinct_if,
                                  paste, pct)
from ..functions.school import SLOT, class_id, slot_class_id
from ..sources.tables import cut_lineage, deal
from .checks import Check
from .components import dealt_components
from .meetings import PERIOD, ROTATION, ROW_ID, TERM, ScheduleParams, serialize_meetings, slot_rows, term_group, unfold, with_meetings

# Sums of split weights may differ from the whole in the last bits.
EPS = 1e-9
ADJ = "M_class_weight_adj_same_course"
WEIGHT = "M_class_weight_exploded"
EXCLUDES = ("C_course_time_exclude", "C_class_size_and_teacher_load_exclude")


def _sorted_by(df: DataFrame, near: tuple, *keys: str) -> tuple[DataFrame, tuple]:
    """Where rows are sorted in place, they are compared by a hash of their keys first: most keys are texts, and these are then compared only where they are equal.

    Gives the rows and the columns to put before the keys."""
    return (df.withColumn("__h", F.xxhash64(*keys)), ("__h", *near)) if near else (df, ())


def same_course_adjuster(df: DataFrame, near: tuple = ()) -> DataFrame:
    """A student listed n times in one class counts each row at 1/n.

    ``near``, here and below: columns the rows are already dealt by and that every group shares; the rows are then sorted where they are and not shuffled.
    """
    df, by = _sorted_by(df, near, "C_class_id", "D_stu_id")
    n = F.count(F.lit(1)).over(Window.partitionBy(*by, "C_class_id", "D_stu_id")).cast("int")
    return df.withColumn("H_student_adjuster_same_course", n).withColumn(ADJ, F.col(WEIGHT) / F.col("H_student_adjuster_same_course"))


def _slot_flag(df: DataFrame, who: list[str], amount: Column, by_weight: bool, out: str) -> DataFrame:
    """1 on all rows of a person's slot where the amounts add up to more than one class."""
    slot = Window.partitionBy(*who, *SLOT)
    if by_weight:
        over = flag_int(F.sum(amount).over(Window.partitionBy(*who, *SLOT, WEIGHT)) > F.col(WEIGHT) + F.lit(EPS))
        return df.withColumn("__over", over).withColumn(out, F.max("__over").over(slot)).drop("__over")
    return df.withColumn(out, flag_int(F.sum(amount).over(slot) > F.max(WEIGHT).over(slot) + F.lit(EPS)))


def flag_students(df: DataFrame, by_weight: bool = True, near: tuple = ()) -> DataFrame:
    """A student's adjusted weights in a slot add up to more than one class.

    Sums are kept apart per weight value; ``by_weight=False`` compares the slot total with its largest
    single weight instead.
    """
    df, by = _sorted_by(df, near, "D_location_id", "D_stu_id", *SLOT)
    return _slot_flag(df, [*by, "D_location_id", "D_stu_id"], F.col(ADJ), by_weight, "H_db_student_row")


def flag_teachers(df: DataFrame, by_weight: bool = True, skip_missing: bool = False, near: tuple = ()) -> DataFrame:
    """As for students, after reducing each class to its largest adjusted weight.

    Rows without a teacher form one group unless ``skip_missing``.
    """
    df, by = _sorted_by(df, near, "D_location_id", "D_employee_id", *SLOT)
    who = [*by, "D_location_id", "D_employee_id"]
    rows = Window.partitionBy(*who, *SLOT, WEIGHT, "C_class_id").orderBy("C_class_id")
    first = F.when(F.row_number().over(rows) == 1, F.max(ADJ).over(rows.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    out = _slot_flag(df.withColumn("__class", first), who, F.col("__class"), by_weight, "H_db_teacher_row").drop("__class")
    return out.withColumn("H_db_teacher_row", F.when(F.col("D_employee_id").isNotNull(), F.col("H_db_teacher_row")).otherwise(0)) if skip_missing else out


def flag_people(df: DataFrame, by_weight: bool = True, skip_missing: bool = False, near: tuple = ()) -> DataFrame:
    return flag_teachers(flag_students(df, by_weight, near), by_weight, skip_missing, near)


def class_flags(df: DataFrame, near: tuple = ()) -> DataFrame:
    """Does the class hold any flagged row, and are all its student rows flagged?"""
    df, by = _sorted_by(df, near, "C_class_id")
    w = Window.partitionBy(*by, "C_class_id")
    t, s = F.max("H_db_teacher_row").over(w), F.max("H_db_student_row").over(w)
    return df.withColumns({"H_class_with_teacher_db": t, "H_class_with_student_db": s, "H_class_with_db": F.greatest(t, s), "H_db_100p_class": F.min("H_db_student_row").over(w)})


def _counted(df: DataFrame) -> DataFrame:
    """The rows that count in both metrics, without the columns that say so."""
    return df.filter(is_in(EXCLUDES[0], ["Include"]) & is_in(EXCLUDES[1], ["Include"])).drop(*EXCLUDES)


def _school(df: DataFrame, p: ScheduleParams) -> list[str]:
    """As the class id writes it, so that rows of one class meet; a class without the school in its id may span schools."""
    return [c for c in ("D_location_id",) if c in p.recipe and c in df.columns]


def _deal_at(df: DataFrame, at: Column) -> DataFrame:
    """Rows dealt by ``at``, which is not shuffled with them: it is worked out again on the other side, as ``__at``."""
    return deal(df, at).withColumn("__at", at)


def _flags(dealt: DataFrame, p: ScheduleParams, only_flagged: bool, by_weight: bool, skip_missing_teacher: bool) -> DataFrame:
    """All flags on rows that are dealt by ``__at``."""
    df = dealt.withColumns({c: F.lit("Include") for c in EXCLUDES})
    df = df.withColumn("C_class_id_original", F.col("C_class_id") if "C_class_id" in df.columns else class_id(df.columns, p.recipe)).withColumn("C_class_id", slot_class_id(df.columns, p.recipe))
    near = ("__at",)
    df = class_flags(flag_people(same_course_adjuster(df, near), by_weight, skip_missing_teacher, near), near).drop("__at", "__h")
    return df.filter("H_class_with_db = 1") if only_flagged else df


def flag_double_bookings(exploded: DataFrame, p: ScheduleParams, only_flagged: bool = False, by_weight: bool = True,
                         skip_missing_teacher: bool = False) -> DataFrame:
    """Flags for the rows that count in both metrics. ``only_flagged`` keeps the classes with a flag.

    A class at slot level, a student's slot and a teacher's slot all lie in one slot of one school. So the rows are dealt once, by school and slot, and
    every step is a window inside: a window holds what one school has in one slot at most. Columns that the caller does not use are never shuffled.
    """
    df = _counted(exploded)
    df = _deal_at(df, F.xxhash64(paste("_", *_school(df, p), *SLOT)))
    return _flags(df, p, only_flagged, by_weight, skip_missing_teacher)


def flag_records(records: DataFrame, p: ScheduleParams, only_flagged: bool = False, by_weight: bool = True, skip_missing_teacher: bool = False, folded: bool = False) -> DataFrame:
    """:func:`flag_double_bookings` of records that are not exploded yet, with the same rows.

    Rows are dealt as meetings, by school, meeting and group of terms that share slots, and get their term slots and weights where they are then: a record is shuffled once
    for each meeting and not for each of its slots. Slots that the same terms fill hold the same rows, so the flags are found once for all of them; ``folded`` leaves the
    rows so, with the first slot for all (:func:`unfold`).
    """
    df = with_meetings(_counted(records), p)
    df = _deal_at(df, F.xxhash64(paste("_", *_school(df, p), term_group(p), PERIOD, ROTATION)))
    df = _flags(slot_rows(df, p, folded=True), p, only_flagged, by_weight, skip_missing_teacher)
    return df if folded else unfold(df, p, class_ids=True)


def people_flags(flagged: DataFrame, *by: str) -> DataFrame:
    """One row per group, student and teacher: flagged on any row, and sums over the rows. Distinct counts start from here, so exploded rows are never repeated for them."""
    s, t = F.col("H_db_student_row") == 1, F.col("H_db_teacher_row") == 1
    return flagged.groupBy(*by, "D_stu_id", "D_employee_id").agg(F.max(flag_int(s)).alias("s"), F.max(flag_int(t)).alias("t"), F.count(F.lit(1)).alias("n"),
                                                                 count_where(s).alias("rs"), count_where(t).alias("rt"), *[F.sum(c).alias("w") for c in (WEIGHT,) if c in flagged.columns])


def flag_totals(flagged: DataFrame) -> DataFrame:
    """Students, teachers and rows flagged, as (metric, n_flagged, n_total, pct)."""
    f = people_flags(flagged).agg(
        n_distinct("D_stu_id").alias("st"), n_distinct_if("D_stu_id", F.col("s") == 1).alias("sf"),
        n_distinct("D_employee_id").alias("te"), n_distinct_if("D_employee_id", F.col("t") == 1).alias("tf"),
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n", "rs", "rt")])
    row = lambda name, a, b: F.struct(F.lit(name).alias("metric"), F.col(a).alias("n_flagged"), F.col(b).alias("n_total"), pct(a, b).alias("pct"))
    return f.select(F.inline(F.array(row("students", "sf", "st"), row("teachers", "tf", "te"),
                                     row("student rows", "rs", "n"), row("teacher rows", "rt", "n"))))


def flags_by_school(flagged: DataFrame, school: str = "D_location_name") -> DataFrame:
    """Share of known students and teachers flagged, and total weight, by school."""
    d = people_flags(flagged, school)
    students = distinct_counts(d.filter("D_stu_id is not null"), school, "D_stu_id", {"students_flagged": F.col("s") == 1}, "students")
    teachers = distinct_counts(d.filter("D_employee_id is not null"), school, "D_employee_id", {"teachers_flagged": F.col("t") == 1}, "teachers")
    weight = d.groupBy(school).agg(F.bround(F.sum("w"), 4).alias("total_weight"))
    out = join_same(join_same(weight, students, school), teachers, school)
    counts = [F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in ("students", "students_flagged", "teachers", "teachers_flagged")]
    return out.select(school, *counts, "total_weight").withColumn("pct_students", pct("students_flagged", "students"))


# --- resolution ------------------------------------------------------------------

TPR = ["D_stu_id", *SLOT]
#: What resolved rows are dealt by: a student's slots of one term lie together, and so do the rows that are summed by student, class and term slot afterwards.
NEAR_TPR = ["D_stu_id", TERM]


def resolve_classes(flagged: DataFrame) -> DataFrame:
    """Class stage: where every class of a student's slot is fully double-booked, split by their number.

    Classes of a student's slot are numbered, the fully double-booked ones first; the largest numbers are the two counts.
    """
    d = flagged if "H_db_100p_class" in flagged.columns else attach(flagged, "C_class_id", F.min("H_db_student_row").alias("H_db_100p_class"))
    tpr, full = Window.partitionBy(*TPR), flag(F.col("H_db_100p_class") == 1)
    d = d.withColumn("__full", full).withColumn("__i", F.dense_rank().over(tpr.orderBy(F.desc("__full"), "C_class_id")))
    d = d.withColumns({"__n": F.max("__i").over(tpr), "__n100": F.coalesce(F.max(F.when(F.col("__full"), F.col("__i"))).over(tpr), F.lit(0))})
    d = d.withColumns({"H_tpr_100p_percent": F.col("__n100") / F.col("__n"),
                       "H_student_count_of_100p_classes": F.when((F.col("__n100") == F.col("__n")) & (F.col("__n100") > 0), F.col("__n100")).otherwise(F.lit(1)).cast("int")}).drop("__full", "__i", "__n", "__n100")
    return d.withColumn("M_class_weight_post_class", F.col(ADJ) / F.col("H_student_count_of_100p_classes"))


def _has_teacher(c="D_employee_id") -> Column:
    return F.col(c).isNotNull() & ~is_in(F.col(c).cast("string"), ["NULL", ""])


def consolidate_sections(flagged: DataFrame) -> DataFrame:
    """Teacher stage: sections of one teacher that share a slot, directly or by a chain, become one class.

    One row per section: component, number of sections, merged time expression, consolidated id (null
    when untouched) and resolved id. Sections without a teacher link to nothing.
    """
    sec = "C_class_id_original"
    alone = F.when(~_has_teacher(), F.col(sec)).alias("__alone")
    slots = dealt_components(flagged.select(sec, "D_employee_id", "D_location_id", "D_term", *SLOT, alone), sec, ["D_employee_id", "__alone"], paste("|", *SLOT))
    comp = slots.groupBy(sec, "component").agg(F.min(F.struct("D_location_id", "D_employee_id", "D_term")).alias("a"))
    sizes = comp.groupBy("component").agg(F.count(F.lit(1)).alias("n_sections"), F.min("a").alias("a"))
    info = join_same(sizes, serialize_meetings(slots, ["component"]), "component")
    cons = paste("_", F.lit("CONS"), "a.D_location_id", "a.D_employee_id", F.replace(F.col("merged_expr"), F.lit(", "), F.lit("+")), "a.D_term")
    info = info.select("component", "n_sections", "merged_expr", F.when(F.col("n_sections") > 1, cons).alias("C_class_id_consolidated"))
    return join_same(comp.drop("a"), info, "component").select(
        sec, "component", "n_sections", "merged_expr", "C_class_id_consolidated",
        F.coalesce("C_class_id_consolidated", sec).alias("C_class_id_resolved"),
        F.col("C_class_id_consolidated").isNotNull().alias("is_consolidated"))


def consolidation_collisions(mapping: DataFrame) -> Check:
    """Two components must not share a consolidated id."""
    one = mapping.filter("is_consolidated").select("component", "C_class_id_consolidated").distinct()
    return Check("consolidated ids belong to one component",
                 one.groupBy("C_class_id_consolidated").agg(F.count(F.lit(1)).alias("n_components")).filter("n_components > 1"))


def consolidation_sizes(mapping: DataFrame) -> DataFrame:
    kind = F.when(F.col("n_sections") == 1, "untouched").when(F.col("n_sections") == 2, "pair").otherwise("chain (3+)")
    return (mapping.select("component", "n_sections").distinct().groupBy("n_sections").agg(F.count(F.lit(1)).alias("n_components"))
                   .withColumn("kind", kind))


def largest_consolidations(mapping: DataFrame, k: int = 10) -> DataFrame:
    return (mapping.filter("is_consolidated").select("n_sections", "merged_expr", "C_class_id_consolidated").distinct()
                   .orderBy(F.desc("n_sections"), "C_class_id_consolidated").limit(k))


def consolidation_totals(mapping: DataFrame) -> DataFrame:
    return mapping.agg(F.count(F.lit(1)).alias("sections_total"), count_where("is_consolidated").alias("sections_consolidated"),
                       F.count_distinct("C_class_id_consolidated").alias("consolidated_classes"))


def _with_consolidated(flagged: DataFrame, mapping: DataFrame) -> DataFrame:
    """The rows with the consolidated id and the merged expression of their section, null where it was left alone."""
    return join_same(flagged, mapping.filter("is_consolidated").select("C_class_id_original", "C_class_id_consolidated", "merged_expr"), "C_class_id_original")


def _relabelled(rows: DataFrame) -> DataFrame:
    if "D_expression" in rows.columns:
        own = F.col("D_expression")
    elif {"D_period", "D_rotation"} <= set(rows.columns):
        own = F.concat(F.coalesce(F.col("D_period").cast("string"), F.lit("NA")), F.lit("("), F.coalesce("D_rotation", F.lit("NA")), F.lit(")"))
    else:
        own = F.lit(None).cast("string")
    return rows.withColumns({
        "C_class_id_post_teachers": F.coalesce("C_class_id_consolidated", "C_class_id_original"),
        "C_class_expression": F.coalesce("merged_expr", own)}).drop("C_class_id_consolidated", "merged_expr")


def apply_consolidation(flagged: DataFrame, mapping: DataFrame) -> DataFrame:
    """Re-label rows; never adds one. The class expression is the merged one, else the record's own time."""
    return _relabelled(_with_consolidated(flagged, mapping))


def teacher_loadoff(resolved: DataFrame, p: ScheduleParams, subject="C_course_subject_area") -> DataFrame:
    """Consolidated classes above the size limit, unless every row is in an exempt subject."""
    c = resolved.filter(F.col("C_class_id_post_teachers").startswith("CONS_"))
    out = c.groupBy("C_class_id_post_teachers", "D_employee_id").agg(
        n_distinct("D_stu_id").alias("n_students"), F.bool_and(is_in(subject, p.exempt_subjects)).alias("all_exempt"))
    return out.withColumn("load_off", (F.col("n_students") > p.consolidate_max_size) & ~F.col("all_exempt"))


def resolve_students(applied: DataFrame) -> DataFrame:
    """Student stage: split what the class stage left by the number of classes in the slot, and keep the
    head count share of whichever split applied."""
    tpr, handled = Window.partitionBy(*TPR), F.col("H_tpr_100p_percent") == 1
    d = applied.withColumn("__i", F.dense_rank().over(tpr.orderBy("C_class_id_post_teachers"))).withColumn("N_pt", F.max("__i").over(tpr).cast("int")).drop("__i")
    return d.withColumns({
        "student_adjuster_post_student": F.when(handled, 1).otherwise(F.col("N_pt")),
        "M_student_count_adjusted": F.lit(1.0) / F.when(handled, F.col("H_student_count_of_100p_classes")).otherwise(F.col("N_pt")),
    }).withColumn("M_class_weight_post_student", F.col("M_class_weight_post_teachers") / F.col("student_adjuster_post_student"))


def teachers_off(flagged: DataFrame, mapping: DataFrame, p: ScheduleParams) -> DataFrame:
    """Teachers with a class that takes them off the load count (:func:`teacher_loadoff`), from the flagged rows: nothing of the student stage counts there."""
    taught = flagged.groupBy("C_class_id_original", "D_employee_id", "D_stu_id").agg(F.bool_and(is_in("C_course_subject_area", p.exempt_subjects)).alias("__exempt"))
    ids = mapping.filter(F.col("C_class_id_resolved").startswith("CONS_")).select("C_class_id_original", F.col("C_class_id_resolved").alias("__cons"))
    taught = join_same(taught, ids, "C_class_id_original", "inner").groupBy("__cons", "D_employee_id", "D_stu_id").agg(F.bool_and("__exempt").alias("__exempt"))
    size = taught.groupBy("__cons", "D_employee_id").agg(F.count(F.lit(1)).alias("n"), F.bool_and("__exempt").alias("__exempt"))
    return size.filter((F.col("n") > p.consolidate_max_size) & ~F.col("__exempt")).select("D_employee_id").distinct()


def resolve_double_bookings(flagged: DataFrame, recipe: tuple = (), mapping: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(resolved rows, section mapping): class stage, teacher stage, student stage.

    ``flagged`` should be a stored table, folded or not; the mapping is stored here unless it is given. Only the student's slot counts in the class and the student stage, so both
    follow the join of the mapping with one deal of the rows. With the ``recipe`` that the class ids were made by, the ids are not dealt but written again afterwards.
    """
    mapping = cut_lineage(consolidate_sections(flagged)) if mapping is None else mapping
    rows = _relabelled(_with_consolidated(flagged, mapping))
    if recipe and set(recipe) <= set(rows.columns):
        rows = deal(rows.drop("C_class_id", "C_class_id_original"), *NEAR_TPR)
        rows = rows.withColumns({"C_class_id_original": class_id(rows.columns, recipe), "C_class_id": slot_class_id(rows.columns, recipe)}).select(*flagged.columns, "C_class_id_post_teachers", "C_class_expression")
    else:
        rows = deal(rows, *NEAR_TPR)
    post_class = resolve_classes(rows)
    return resolve_students(post_class.withColumn("M_class_weight_post_teachers", F.col("M_class_weight_post_class"))), mapping


# --- unification ------------------------------------------------------------------

def unify(resolved: DataFrame, records: DataFrame, loadoff: DataFrame | None = None, load_col: str = EXCLUDES[1], keep_mark: bool = False) -> DataFrame:
    """Resolved slot rows plus the records that needed no resolution, with one set of final columns; ``keep_mark`` adds ``H_resolved``, which tells them apart.

    One left join by row id gives both: a record with resolved rows is represented by them and lends them the columns they did
    not carry; a record without any keeps its own. Where the resolved rows do not carry the teacher, the records of load-off teachers are found as row ids, and
    these are joined to rows that are already dealt by them: a whole record is never dealt by its teacher.
    """
    off = None if loadoff is None else loadoff.filter("load_off").select("D_employee_id").distinct().withColumn("__off", F.lit(True))
    by_record = off is not None and "D_employee_id" not in resolved.columns and "D_employee_id" in records.columns
    as_text = lambda d: d.withColumns({c: F.col(c).cast("string") for c in ("D_term", "D_period", "D_rotation") if c in d.columns})
    both = [c for c in resolved.columns if c in records.columns and c != ROW_ID]
    slots = as_text(resolved).withColumnsRenamed({c: f"__s_{c}" for c in both}).withColumn("__hit", F.lit(True))
    u = as_text(records).join(slots, ROW_ID, "left")
    if by_record:
        u = u.join(join_same(records.select(ROW_ID, "D_employee_id"), off, "D_employee_id", "inner", split_null=True).select(ROW_ID, "__off"), ROW_ID, "left")
    u = u.withColumns({c: F.when(F.col("__hit"), F.col(f"__s_{c}")).otherwise(F.col(c)) for c in both})
    u = (u.withColumn("H_resolved", flag("__hit")) if keep_mark else u).drop("__hit", *[f"__s_{c}" for c in both])
    pick = lambda new, old: F.coalesce(new, old) if old in u.columns else F.col(new)
    u = u.withColumns({
        "D_term": pick(TERM, "D_term"), "D_period": pick(PERIOD, "D_period"), "D_rotation": pick(ROTATION, "D_rotation"),
        "M_class_weight": F.coalesce("M_class_weight_post_student", "M_cls_class_weight"),
        "C_class_id": F.coalesce("C_class_id_post_teachers", "C_class_id")})
    if not by_record:
        u = u.withColumn("__off", F.lit(False)) if off is None else join_same(u, off, "D_employee_id", split_null=True)
    out = F.when(is_in(load_col, ["Exclude"]) | flag("__off"), "Exclude").otherwise("Include")
    return u.withColumn("C_teacher_load_exclude", out).drop("__off").withColumnRenamed(load_col, "C_class_size_exclude")


def unify_accounts(unified: DataFrame, resolved: DataFrame, records: DataFrame) -> DataFrame:
    """Row accounting of the unification, one row."""
    ids = resolved.select(ROW_ID).distinct().withColumn("m", F.lit(1))
    rec = join_same(records.select(ROW_ID), ids, ROW_ID).agg(F.count("m").alias("records_matched"), F.count_if(F.col("m").isNull()).alias("records_untouched"))
    res = resolved.agg(F.count(F.lit(1)).alias("resolved_rows"))
    uni = unified.agg(F.count(F.lit(1)).alias("unified_rows"), count_where(F.col("C_teacher_load_exclude") == "Exclude").alias("load_excludes"),
                      count_where(F.col("C_class_size_exclude") == "Exclude").alias("size_excludes"))
    return res.join(rec, F.lit(True)).join(uni, F.lit(True)).withColumn(
        "accounted", F.col("unified_rows") == F.col("resolved_rows") + F.col("records_untouched"))


def stage_gates(resolved: DataFrame) -> DataFrame:
    """Weights only shrink from stage to stage; one teacher per consolidated class."""
    from .checks import gates
    le = lambda a, b: F.col(a) >= F.col(b) - F.lit(EPS)
    shrink = gates(resolved, {"class stage shrinks": le(ADJ, "M_class_weight_post_class"),
                              "teacher stage shrinks": le("M_class_weight_post_class", "M_class_weight_post_teachers"),
                              "student stage shrinks": le("M_class_weight_post_teachers", "M_class_weight_post_student")})
    return shrink.unionByName(one_teacher(resolved).result())


def one_teacher(resolved: DataFrame) -> Check:
    multi = resolved.filter(F.col("C_class_id_post_teachers").startswith("CONS_")).groupBy("C_class_id_post_teachers").agg(
        n_distinct("D_employee_id").alias("n")).filter("n > 1")
    return Check("one teacher per consolidated class", multi)


def weight_by_stage(resolved: DataFrame, school="D_location_name") -> DataFrame:
    """Mean weight per double-booked student at each stage, by school."""
    cols = {"exploded": WEIGHT, "post_class": "M_class_weight_post_class", "post_teachers": "M_class_weight_post_teachers",
            "post_student": "M_class_weight_post_student"}
    per = resolved.filter(is_in(EXCLUDES[0], ["Include"])).groupBy(school, "D_stu_id").agg(*[F.sum(c).alias(n) for n, c in cols.items()])
    return per.groupBy(school).agg(F.count(F.lit(1)).alias("n_db_students"), *[F.bround(F.avg(n), 2).alias(n) for n in cols])


#: The columns of resolved rows that :func:`before_after` reads.
BEFORE_AFTER = ("D_stu_id", "D_employee_id", "D_location_id", *SLOT, WEIGHT, "C_class_id_original", "C_class_id_post_teachers", "M_class_weight_post_student",
                "M_student_count_adjusted", "H_db_student_row", "H_db_teacher_row")


def before_after(resolved: DataFrame, folded: ScheduleParams | None = None) -> DataFrame:
    """Headline figures before and after, with the flags raised again on the resolved weights. ``resolved`` should be a stored table of the columns ``BEFORE_AFTER``.

    Every figure is an aggregate, combined before it is shuffled; of folded rows (``folded``: their parameters) totals are unfolded, not rows."""
    each = lambda d: unfold(d, folded) if folded else d
    def flagged_before():
        d = people_flags(resolved).withColumnsRenamed({"s": "H_db_student_row", "t": "H_db_teacher_row"})
        return d.agg(n_distinct_if("D_stu_id", F.col("H_db_student_row") == 1).alias("s"), n_distinct_if("D_employee_id", F.col("H_db_teacher_row") == 1).alias("t"))
    def over(rows, who):
        sums = rows.groupBy("D_location_id", who, *SLOT, WEIGHT).agg(F.sum("c").alias("c")).filter(F.col("c") > F.col(WEIGHT) + F.lit(EPS))
        return sums.select(who).distinct().agg(F.count(F.lit(1)).alias("n"))
    def flagged_after():
        weight = F.col("M_class_weight_post_student")
        classes = resolved.groupBy("D_location_id", "D_employee_id", *SLOT, WEIGHT, "C_class_id_post_teachers").agg(F.max(weight).alias("c"))
        students = over(resolved.withColumn("c", weight), "D_stu_id").withColumnRenamed("n", "s")
        return students.join(over(classes, "D_employee_id").withColumnRenamed("n", "t"), F.lit(True))
    def load(class_col):
        per = each(resolved.select("D_employee_id", class_col, *SLOT, WEIGHT).distinct()).groupBy("D_employee_id").agg(F.sum(WEIGHT).alias("w"))
        return per.agg(F.avg("w").alias("load"), )
    def weight(c):
        per = each(resolved.groupBy("D_stu_id", TERM).agg(F.sum(c).alias("w"))).groupBy("D_stu_id").agg(F.sum("w").alias("w"))
        return per.agg(F.avg("w").alias("weight"))
    size_b = each(resolved.groupBy("C_class_id_original", *SLOT).agg(n_distinct("D_stu_id").alias("z"))).agg(F.avg("z").alias("size"))
    size_a = each(resolved.groupBy("C_class_id_post_teachers", *SLOT).agg(F.sum("M_student_count_adjusted").alias("z"))).agg(F.avg("z").alias("size"))
    def side(tag, flags, sections, w, l, z):
        n = resolved.agg(n_distinct(sections).alias("sections"))
        one = flags.join(n, F.lit(True)).join(weight(w), F.lit(True)).join(load(l), F.lit(True)).join(z, F.lit(True))
        v = lambda c: F.col(c).cast("double").alias(tag)
        rows = [("students double-booked", v("s")), ("teachers double-booked", v("t")), ("distinct sections", v("sections")),
                ("mean weight per student", F.bround("weight", 2).alias(tag)), ("mean teacher load", F.bround("load", 2).alias(tag)),
                ("mean class size per slot", F.bround("size", 1).alias(tag))]
        return one.select(F.inline(F.array(*[F.struct(F.lit(m).alias("metric"), x) for m, x in rows])))
    b = side("before", flagged_before(), "C_class_id_original", WEIGHT, "C_class_id_original", size_b)
    a = side("after", flagged_after(), "C_class_id_post_teachers", "M_class_weight_post_student", "C_class_id_post_teachers", size_a)
    return b.join(a, "metric")
