"""Class, teacher and student rollups of the unified schedule."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.nullsafe import attach, col, count_where, flag, is_in, join_same, joined_values, n_distinct, n_distinct_if, not_in, nulls_last, paste, ratio
from ..functions.ranges import bucketize
from ..functions.school import share_bucket
from .names import collapse_names
from ..sources.tables import cut_lineage, ensure_columns
from .meetings import PERIOD, ROTATION, ScheduleParams, meeting_minutes
from .ordered import dominant

# Credit types in order of priority; any other comes after.
CREDIT_PRIORITY = ("Graduation Required", "Support & Enrichment", "Elective", "UNSURE")

CLASS_PRIMARIES = {
    "D_location_id": "C_cls_location_id", "D_location_name": "C_cls_location_name", "D_stu_grade": "C_cls_grade",
    "C_course_subject": "C_cls_course_subject", "C_course_subject_area": "C_cls_course_subject_area",
    "C_course_rigor": "C_cls_course_rigor", "C_course_rigor_detail": "C_cls_course_rigor_detail"}
TEACHER_PRIMARIES = {  # field -> (output, leave advisory out)
    "C_course_subject": ("C_tch_course_subject", True), "C_course_subject_area": ("C_tch_course_subject_area", True),
    "C_course_credit_type": ("C_tch_course_credit_type", True), "D_stu_grade": ("C_tch_grade", False)}


def teacher_primary(u: DataFrame, field: str, out: str, skip_advisory: bool = False) -> DataFrame:
    """Per teacher, the value that carries the most class weight, each class counted once."""
    if skip_advisory and "C_course_subject" in u.columns:
        u = u.filter(not_in("C_course_subject", ["Advisory"]))
    per = u.groupBy("D_employee_id", "C_class_id", field).agg(F.max("M_class_weight").alias("__h"))
    return dominant(per, ["D_employee_id"], field, "__h", out)


def add_minutes(u: DataFrame, p: ScheduleParams, use_default: bool = False) -> DataFrame:
    """Minutes of one meeting; only exploded rows have one."""
    m = F.when(F.col(PERIOD).isNotNull(), meeting_minutes(p, use_default=use_default))
    return u.drop("M_meeting_minutes").withColumn("M_meeting_minutes", m)


SLOT_TIME = ["D_term", "D_period", "D_rotation"]
CLASS_SLOT = ["C_class_id", *SLOT_TIME]


def class_sizes(u: DataFrame, p: ScheduleParams, *largest: str) -> DataFrame:
    """Head count and adjusted size, one row per class-slot; each student counts once, at the largest share. ``largest``: columns whose largest value is kept."""
    per = u.groupBy(*CLASS_SLOT, "D_stu_id").agg(F.max(F.coalesce("M_student_count_adjusted", F.lit(1.0))).alias("a"), *[F.max(c).alias(c) for c in largest])
    size = per.groupBy(*CLASS_SLOT).agg(F.count(F.lit(1)).alias("M_cls_num_stu"), F.sum(F.when(F.col("D_stu_id").isNotNull(), F.col("a"))).alias("s"), *[F.max(c).alias(c) for c in largest])
    size = size.select(*CLASS_SLOT, "M_cls_num_stu", F.coalesce("s", F.lit(0.0)).alias("M_cls_class_size"), *largest)
    return size.withColumns({"M_cls_class_size_diff": F.col("M_cls_num_stu") - F.col("M_cls_class_size"),
                             "C_cls_class_size_bucket": bucketize(F.bround("M_cls_class_size", 9), p.size_buckets)})


def add_class_size(u: DataFrame, p: ScheduleParams) -> DataFrame:
    u = u.withColumn("M_student_count_adjusted", F.coalesce("M_student_count_adjusted", F.lit(1.0)))
    return join_same(u, class_sizes(u, p), CLASS_SLOT)


def teacher_metrics(u: DataFrame, p: ScheduleParams) -> DataFrame:
    """Primary school, periods, utilisation, load and load bucket, one row per teacher.

    A teacher has a single primary school, so the school follows the teacher.
    """
    load = u.groupBy("D_employee_id").agg(n_distinct_if("D_stu_id", F.col("C_teacher_load_exclude") == "Include").alias("M_tch_load"))
    per = join_same(teacher_utilization(u, p), load, "D_employee_id")
    return per.withColumn("M_tch_load_bucket", bucketize("M_tch_load", p.load_buckets))


def teacher_utilization(u: DataFrame, p: ScheduleParams) -> DataFrame:
    """The part of :func:`teacher_metrics` that takes no students: primary school, periods and utilisation. The rows are read once, into a small stored table of teacher, class and school."""
    u = cut_lineage(u.groupBy("D_employee_id", "C_class_id", "D_location_name").agg(F.max("M_class_weight").alias("M_class_weight"), F.max("M_cls_class_weight").alias("M_cls_class_weight")))
    school = teacher_primary(u, "D_location_name", "C_tch_location_name")
    periods = u.groupBy("D_employee_id", "C_class_id").agg(F.max("M_cls_class_weight").alias("w")).groupBy("D_employee_id").agg(
        F.coalesce(F.sum("w"), F.lit(0.0)).alias("M_tch_num_periods"))
    total = F.lit(p.utilization_default).cast("double")
    for name, v in p.utilization_by_school.items():
        total = F.when(F.col("C_tch_location_name") == name, F.lit(float(v))).otherwise(total)
    per = join_same(school, periods, "D_employee_id").withColumn("C_school_total_periods", total)
    return per.withColumn("M_tch_utilization", ratio("M_tch_num_periods", "C_school_total_periods"))


def add_teacher_metrics(u: DataFrame, p: ScheduleParams) -> DataFrame:
    return join_same(u.drop("C_tch_location_name"), teacher_metrics(u, p), "D_employee_id", split_null=True)


def class_primaries(u: DataFrame) -> DataFrame:
    """One row per class with its dominant values. The rows are read once, into a small stored table of class and field values; the
    per-class tables are joined to each other, so the wide table takes a single join."""
    todo = {f: o for f, o in CLASS_PRIMARIES.items() if f in u.columns and o not in u.columns}
    u = cut_lineage(u.groupBy("C_class_id", *todo).agg(F.sum("M_class_weight").alias("M_class_weight")))
    parts = [dominant(u, ["C_class_id"], f, "M_class_weight", o) for f, o in todo.items()]
    return reduce(lambda a, b: join_same(a, b, "C_class_id"), parts)


def add_class_primaries(u: DataFrame) -> DataFrame:
    return join_same(u, class_primaries(u), "C_class_id")


def class_credit_type(u: DataFrame) -> DataFrame:
    """Most common credit type (then by priority) per class; a class without one has null."""
    rank = F.lit(len(CREDIT_PRIORITY))
    for i, c in reversed(list(enumerate(CREDIT_PRIORITY))):
        rank = F.when(F.col("C_course_credit_type") == c, F.lit(i)).otherwise(rank)
    n = u.groupBy("C_class_id", "C_course_credit_type").agg(F.count(F.lit(1)).alias("n"))
    known = F.when(F.col("C_course_credit_type").isNotNull(), F.struct(-F.col("n"), rank, F.col("C_course_credit_type").alias("v")))
    return n.groupBy("C_class_id").agg(F.min(known).alias("m")).select("C_class_id", F.col("m.v").alias("C_cls_course_credit_type"))


def class_fields(u: DataFrame) -> DataFrame:
    """Collapsed course name and most common credit type per class."""
    return join_same(collapse_names(u, "C_class_id", "C_course_name", "C_cls_course_name"), class_credit_type(u), "C_class_id")


def add_class_fields(u: DataFrame) -> DataFrame:
    return join_same(u.drop("C_cls_course_name"), class_fields(u), "C_class_id")


def class_demographics(u: DataFrame) -> DataFrame:
    """Students with each support flag, their share and its band, per class."""
    s = u.select("C_class_id", "D_stu_id", "D_stu_ell_flag", "D_stu_swd_flag").distinct()
    c = s.groupBy("C_class_id").agg(F.count(F.lit(1)).alias("n"), F.sum("D_stu_ell_flag").alias("M_cls_num_ell"), F.sum("D_stu_swd_flag").alias("M_cls_num_swd"))
    c = c.withColumns({"M_cls_pct_ell": ratio("M_cls_num_ell", "n"), "M_cls_pct_swd": ratio("M_cls_num_swd", "n")}).drop("n")
    return c.withColumns({"C_cls_ell_bucket": share_bucket("M_cls_pct_ell"), "C_cls_swd_bucket": share_bucket("M_cls_pct_swd")})


def add_class_demographics(u: DataFrame) -> DataFrame:
    if not {"D_stu_ell_flag", "D_stu_swd_flag"} <= set(u.columns):
        return u
    return join_same(u, class_demographics(u), "C_class_id")


def add_class_shares(taught: DataFrame, u: DataFrame) -> DataFrame:
    """The class shares of :func:`class_demographics` of ``u`` on rows of classes."""
    return join_same(taught, class_demographics(u).select("C_class_id", "M_cls_pct_ell", "M_cls_pct_swd"), "C_class_id")


def weight_times_size(u: DataFrame) -> DataFrame:
    return u.groupBy("C_class_id").agg((F.max("M_cls_class_weight") * F.max("M_cls_class_size")).alias("M_cls_class_weight_times_class_size"))


def add_weight_times_size(u: DataFrame) -> DataFrame:
    return join_same(u, weight_times_size(u), "C_class_id")


def class_table(u: DataFrame, sizes: DataFrame) -> DataFrame:
    """Everything derived per class, one row per class. ``u`` should be a stored table, ``sizes`` is :func:`class_sizes` with the largest ``M_cls_class_weight``."""
    parts = [class_primaries(u), class_fields(u), weight_times_size(sizes)]
    if {"D_stu_ell_flag", "D_stu_swd_flag"} <= set(u.columns):
        parts.append(class_demographics(u))
    return reduce(lambda a, b: join_same(a, b, "C_class_id"), parts)


def teacher_primaries(u: DataFrame) -> DataFrame:
    """One row per teacher with its dominant values, from a small stored table of teacher, class and field values."""
    todo = [(f, o, s) for f, (o, s) in TEACHER_PRIMARIES.items() if f in u.columns and o not in u.columns]
    fields = dict.fromkeys([*[t[0] for t in todo], *[c for c in ("C_course_subject",) if c in u.columns]])
    u = cut_lineage(u.groupBy("D_employee_id", "C_class_id", *fields).agg(F.max("M_class_weight").alias("M_class_weight")))
    return reduce(lambda a, t: join_same(a, teacher_primary(u, *t), "D_employee_id"), todo, u.select("D_employee_id").distinct())


def add_teacher_primaries(u: DataFrame) -> DataFrame:
    return join_same(u, teacher_primaries(u), "D_employee_id", split_null=True)


def teacher_table(u: DataFrame, classes: DataFrame, p: ScheduleParams) -> DataFrame:
    """Everything derived per teacher, one row per teacher. ``classes`` is :func:`class_table`."""
    out = add_teacher_flags(join_same(teacher_metrics(u, p), teacher_primaries(u), "D_employee_id"))
    if "M_cls_pct_ell" in classes.columns:
        taught = u.select("D_employee_id", "C_class_id").distinct()
        out = join_same(out, teacher_support(join_same(taught, classes.select("C_class_id", "M_cls_pct_ell", "M_cls_pct_swd"), "C_class_id")), "D_employee_id")
    return out


def teacher_support(u: DataFrame) -> DataFrame:
    """Mean class share of each support flag per teacher, flags and a combined label."""
    per = u.select("D_employee_id", "C_class_id", "M_cls_pct_ell", "M_cls_pct_swd").distinct().groupBy("D_employee_id").agg(
        F.avg("M_cls_pct_ell").alias("C_tch_percent_ell_classes"), F.avg("M_cls_pct_swd").alias("C_tch_percent_swd_classes"))
    e, s = F.col("C_tch_percent_ell_classes") > 0.5, F.col("C_tch_percent_swd_classes") > 0.5
    label = lambda c, t: F.when(c, F.lit(f"{t} teacher")).when(~c, F.lit(f"Not {t} teacher"))
    both = (F.when(e & s, "ELL and SWD teacher").when(e & ~s, "ELL teacher").when(~e & s, "SWD teacher").when(~e & ~s, "Gen Ed teacher"))
    return per.withColumns({"C_tch_ell_flag": label(e, "ELL"), "C_tch_swd_flag": label(s, "SWD"), "C_tch_ell_swd_flag": both})


def add_teacher_support(u: DataFrame) -> DataFrame:
    if not {"M_cls_pct_ell", "M_cls_pct_swd"} <= set(u.columns):
        return u
    return join_same(u, teacher_support(u), "D_employee_id", split_null=True)


def add_teacher_flags(u: DataFrame) -> DataFrame:
    """Teachers with advisory only get its subject and area; ninth-grade teachers are marked."""
    new = {}
    if "C_tch_course_subject" in u.columns:
        new["C_tch_course_subject"] = F.coalesce("C_tch_course_subject", F.lit("Advisory"))
    if "C_tch_course_subject_area" in u.columns:
        new["C_tch_course_subject_area"] = F.coalesce("C_tch_course_subject_area", F.lit("Support & Enrichment"))
    if "C_tch_grade" in u.columns:
        nine = F.col("C_tch_grade") == 9
        new["C_tch_ninth_grade_flag"] = F.when(nine, "Ninth grade teacher").when(~nine, "Not Ninth grade teacher")
    return u.withColumns(new) if new else u


_T = "string"
STUDENT_COLUMNS = {
    "D_location_name": _T, "D_stu_id": "long", "D_stu_grade": "int", "D_stu_swd_flag": "int", "D_stu_ell_flag": "int", "D_stu_poverty_flag": "int",
    "D_stu_demographic_flag": _T, "C_class_id": _T, "D_employee_id": "long", "D_term": _T, "C_course_time_of_day": _T, "C_course_subject": _T,
    "C_course_name": _T, "C_course_rigor": _T, "C_course_rigor_detail": _T, "C_course_subject_area": _T, "C_course_credit_type": _T,
    "C_course_intervention": _T, "M_meeting_minutes": "double", "M_cls_pct_ell": "double", "M_cls_pct_swd": "double", "M_class_weight": "double",
    "M_cls_num_stu": "long", "M_cls_class_size": "double", "C_cls_class_size_bucket": _T, "C_proficiency_ela": _T, "C_proficiency_math": _T, "C_proficiency": _T}
TEACHER_COLUMNS = {
    "D_employee_id": "long", "C_tch_course_subject": _T, "C_tch_course_subject_area": _T, "C_tch_course_credit_type": _T, "C_tch_grade": "int",
    "C_tch_location_name": _T, "C_tch_percent_ell_classes": "double", "C_tch_percent_swd_classes": "double", "C_tch_ell_swd_flag": _T,
    "C_tch_ell_flag": _T, "C_tch_swd_flag": _T, "C_tch_novice_indicator": _T, "D_employee_license_type_rank": "int", "D_employee_license_type": _T,
    "D_employee_license_subject_concat": _T, "C_tch_ninth_grade_flag": _T, "C_teacher_load_exclude": _T, "M_tch_num_periods": "double",
    "M_tch_utilization": "double", "M_tch_load": "long", "M_tch_load_bucket": _T}
CLASS_COLUMNS = {
    "C_cls_location_id": "int", "C_cls_location_name": _T, "C_class_id": _T, "D_term": _T, "C_teacher_load_exclude": _T, "C_class_size_exclude": _T,
    "D_employee_id": "long", "C_cls_course_subject": _T, "C_cls_course_subject_area": _T, "C_cls_course_name": _T, "C_cls_course_credit_type": _T,
    "C_cls_grade": "int", "C_cls_course_rigor": _T, "C_cls_course_rigor_detail": _T, "M_cls_num_ell": "long", "M_cls_num_swd": "long",
    "M_cls_pct_ell": "double", "M_cls_pct_swd": "double", "C_cls_ell_bucket": _T, "C_cls_swd_bucket": _T, "M_cls_num_stu": "long",
    "M_cls_class_size": "double", "C_cls_class_size_bucket": _T}
CLASS_FROM_TEACHER = ("C_tch_ell_swd_flag", "C_tch_location_name", "C_tch_course_subject", "C_tch_grade", "D_employee_license_type",
                      "C_tch_novice_indicator", "M_tch_num_periods", "M_tch_utilization", "M_tch_load", "M_tch_load_bucket", "M_tch_num_preps")


def _tracked(u: DataFrame) -> DataFrame:
    return u.filter(flag(F.col("C_course_subject_area") != "Untracked"))


def _own(u: DataFrame, wanted, *others: DataFrame) -> list[str]:
    """The wanted columns that the rows have themselves and do not get from the tables joined to them."""
    return [c for c in wanted if c in u.columns and not any(c in d.columns for d in others)]


def student_rollup(u: DataFrame, p: ScheduleParams, sizes: DataFrame, classes: DataFrame, students: DataFrame | None = None) -> DataFrame:
    """Distinct student-class rows of tracked courses, always with the full column list.

    The rows are made distinct in their own columns before they get what is known of their class-slot, class and student."""
    cols = {**STUDENT_COLUMNS, **{c: _T for c in p.time_cols}}
    sizes, classes = sizes.select(*CLASS_SLOT, *[c for c in cols if c in sizes.columns and c not in CLASS_SLOT]), classes.select(*[c for c in cols if c in classes.columns])
    d = _tracked(u).select(*dict.fromkeys((*CLASS_SLOT, "D_stu_id", *_own(u, cols, *[x.drop(*CLASS_SLOT) for x in (sizes, classes)])))).distinct()
    d = join_same(join_same(d, sizes, CLASS_SLOT), classes, "C_class_id")
    d = ensure_columns(d if students is None else join_same(d, students, "D_stu_id"), cols).select(*cols)
    return d if set(CLASS_SLOT) <= set(cols) else d.distinct()


def teacher_rollup(u: DataFrame, p: ScheduleParams, teachers: DataFrame, skip_term: str = "S2") -> DataFrame:
    """One row per set of teacher attributes: preparations, meetings, course names, times. ``teachers`` is :func:`teacher_table`.

    What follows from the teacher is joined to the totals, and the joined texts are reduced to distinct values before they are collected.
    """
    d = _tracked(u)
    if "D_meeting" not in d.columns:
        d = d.withColumn("D_meeting", paste("@", PERIOD, ROTATION))
    d = ensure_columns(d, p.time_cols)
    mine = teachers.select("D_employee_id", *[c for c in TEACHER_COLUMNS if c in teachers.columns and c != "D_employee_id"])
    own = ["D_employee_id", *_own(u, TEACHER_COLUMNS, mine)]
    d = d.groupBy(*own).agg(
        F.size(F.collect_set(F.struct("C_course_name"))).cast("long").alias("M_tch_num_preps"),
        joined_values(F.when(F.col("D_term") != skip_term, F.coalesce("D_meeting", F.lit("NA"))), " | ").alias("M_tch_meetings_in_s1"),
        joined_values(F.coalesce("C_course_name", F.lit("NA")), " | ").alias("C_tch_course_names"),
        *[joined_values(c, " | ").alias(c) for c in p.time_cols], F.lit(1).alias("M_tch_weight"))
    made = [c for c in d.columns if c not in own]
    return ensure_columns(join_same(d, mine, "D_employee_id"), TEACHER_COLUMNS).select(*TEACHER_COLUMNS, *made)


def class_rollup(u: DataFrame, teachers: DataFrame, p: ScheduleParams, sizes: DataFrame, classes: DataFrame) -> DataFrame:
    """Class-slot rows that count for class size, with what is known of the class and the teacher's fields. Where a teacher has several
    rollup rows, the smallest by its fields is used. Student rows become class-slot rows before anything is joined."""
    keys = {**CLASS_COLUMNS, **{c: _T for c in p.time_cols}}
    measures = {m: "double" for m in ("M_cls_class_weight", "M_meeting_minutes", "M_cls_class_weight_times_class_size")}
    sizes = sizes.select(*CLASS_SLOT, *[c for c in keys if c in sizes.columns and c not in CLASS_SLOT])
    classes = classes.select("C_class_id", *[c for c in (*keys, *measures) if c in classes.columns and c not in CLASS_SLOT])
    given = [x.drop(*CLASS_SLOT) for x in (sizes, classes)]
    d = _tracked(u).filter(is_in("C_class_size_exclude", ["Include"]))
    d = d.groupBy(*dict.fromkeys((*CLASS_SLOT, *_own(u, keys, *given)))).agg(*[F.max(m).alias(m) for m in _own(u, measures, *given)])
    base = ensure_columns(join_same(join_same(d, sizes, CLASS_SLOT), classes, "C_class_id"), {**keys, **measures})
    if not set(CLASS_SLOT) <= set(keys):
        base = base.groupBy(*keys).agg(*[F.max(m).alias(m) for m in measures])
    t = ensure_columns(teachers, {c: TEACHER_COLUMNS.get(c, "long") for c in CLASS_FROM_TEACHER})
    one = t.groupBy("D_employee_id").agg(F.min(F.struct(*CLASS_FROM_TEACHER)).alias("f")).select("D_employee_id", "f.*")
    return join_same(base.select(*keys, *measures), one, "D_employee_id", split_null=True)


def rollup_checks(classes: DataFrame, teachers: DataFrame) -> DataFrame:
    """Size within head count, every class bucketed, every load bucketed, every utilisation known."""
    from .checks import gates
    a = gates(classes, {"class size within head count": F.col("M_cls_class_size") <= F.col("M_cls_num_stu") + F.lit(1e-9),
                        "class size bucket known": F.col("C_cls_class_size_bucket").isNotNull()})
    b = gates(teachers, {"load bucket known": F.col("M_tch_load_bucket").isNotNull(), "utilisation known": F.col("M_tch_utilization").isNotNull()})
    return a.unionByName(b)


def size_distribution(classes: DataFrame, p: ScheduleParams) -> DataFrame:
    """Class-slots per size bucket, one column per bucket, by school."""
    from ..functions.ranges import bucket_label
    from .aggregates import pivot_counts
    labels = [bucket_label(lo, hi) for lo, hi in p.size_buckets]
    return pivot_counts(classes, ["C_cls_location_name"], "C_cls_class_size_bucket", labels)
