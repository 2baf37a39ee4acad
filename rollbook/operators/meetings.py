"""Class times as atomic meetings, and what each meeting weighs.

Times are expanded on their own row with array expressions, and weights and minutes are sums over that array. Rules come
from parameters and are applied as literal maps: nothing is joined, so no row is shuffled to learn its meetings.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.nullsafe import any_of, col, flag, join_same, paste
from ..functions.school import slot_class_id
from .scope import rule_matches

PERIOD, ROTATION, TERM = "C_period_exploded", "C_rotation_exploded", "C_term_exploded"


@dataclass(frozen=True)
class ScheduleParams:
    """Everything a district declares about its schedule."""
    time_format: str = "period_rotation"                       # or "expression"
    recipe: tuple = ("D_location_id", "D_term", "D_period", "D_course_section_id")
    atoms: tuple = ()
    expands: dict = field(default_factory=dict)
    rotations: dict = field(default_factory=lambda: {"A": ["A"], "B": ["B"], "A-B": ["A", "B"]})
    term_weights: dict = field(default_factory=dict)
    term_expands: dict = field(default_factory=dict)
    rotation_default: float = 0.5
    rotation_by_school: dict = field(default_factory=dict)     # school -> meeting -> weight
    period_default: float = 1.0
    period_by_period: dict = field(default_factory=dict)       # period -> weight
    period_by_school: dict = field(default_factory=dict)       # school -> meeting -> weight
    bell_default: float | None = None
    bell_by_school: dict = field(default_factory=dict)         # school -> {"default", "overrides"}
    utilization_default: float | None = None
    utilization_by_school: dict = field(default_factory=dict)
    size_buckets: tuple = ((0, 6), (7, 12), (13, 18), (19, 24), (25, 30), (31, 35), (36, None))
    load_buckets: tuple = ((0, 34), (35, 74), (75, 124), (125, 199), (200, None))
    consolidate_max_size: int = 35
    exempt_subjects: tuple = ()
    sizing_filters: tuple = ()                                 # rules {"col", "op", "val"}: what-if only

    @property
    def time_cols(self) -> list[str]:
        return ["D_period", "D_rotation"] if self.time_format == "period_rotation" else ["D_expression"]


def _map(d: dict, value) -> Column | None:
    return F.create_map(*[x for k, v in d.items() for x in (F.lit(str(k)), value(v))]) if d else None


def _get(m: Column | None, key: Column, kind: str) -> Column:
    return F.lit(None).cast(kind) if m is None else F.try_element_at(m, key)


def _texts(values) -> Column:
    return F.array(*[F.lit(str(v)) for v in values])


def _token_atoms(token: Column, p: ScheduleParams) -> Column:
    return F.coalesce(_get(_map(p.expands, _texts), token, "array<string>"), F.array(token))


def _period_atoms(part: Column, p: ScheduleParams) -> Column:
    """A token, or a range over the configured atoms, or a range of whole numbers."""
    none = F.array().cast("array<string>")
    ends = F.split(part, "-", 2)
    lo, hi = F.trim(ends[0]), F.trim(F.get(ends, F.lit(1)))
    digits = lo.rlike("^[0-9]+$") & hi.rlike("^[0-9]+$")
    a, b = lo.try_cast("int"), hi.try_cast("int")
    numbers = F.when(digits, F.transform(F.sequence(F.least(a, b), F.greatest(a, b)), lambda x: x.cast("string")))
    ranged = F.coalesce(numbers, none)
    if p.atoms:
        order = _texts(p.atoms)
        at = F.transform(F.concat(_token_atoms(lo, p), _token_atoms(hi, p)), lambda x: F.array_position(order, x))
        first, last = F.array_min(at), F.array_max(at)
        ranged = F.when(first > 0, F.slice(order, first.cast("int"), (last - first + 1).cast("int"))).otherwise(ranged)
    return F.when(part.contains("-"), ranged).otherwise(_token_atoms(part, p))


def _rotation_set(part: Column, p: ScheduleParams) -> Column:
    """A configured token, else each listed token, else single characters."""
    known = _map(p.rotations, _texts)
    parts = F.filter(F.split(part, r"[,\s]+"), lambda x: x != "")
    split_up = F.flatten(F.transform(parts, lambda x: F.coalesce(_get(known, x, "array<string>"), F.split(x, ""))))
    return F.coalesce(_get(known, part, "array<string>"), F.array_sort(F.array_distinct(split_up)))


BLOCK = r"^(.+)\(([^)]*)\)$"


def _blocks(c) -> Column:
    t = F.trim(col(c))
    return F.when(t.isNotNull() & (t != ""), F.split(t, r"[,\s]+"))


def skipped_blocks(df: DataFrame, column: str = "D_expression") -> DataFrame:
    """Blocks of a time expression that do not read as ``periods(rotations)``, with row counts."""
    return (df.select(column, F.explode(_blocks(column)).alias("block")).filter(~F.col("block").rlike(BLOCK))
              .groupBy(column, "block").agg(F.count(F.lit(1)).alias("n_rows")))


def row_meetings(p: ScheduleParams) -> Column:
    """The distinct meetings of a row's time: array<struct<period, rotation>>, empty or null without any."""
    pair = lambda period, rotation: F.struct(period.cast("string").alias(PERIOD), rotation.cast("string").alias(ROTATION))
    if p.time_format == "period_rotation":
        rots = F.coalesce(_get(_map(p.rotations, _texts), F.col("D_rotation"), "array<string>"), F.array(F.col("D_rotation").cast("string")))
        return F.when(F.col("D_period").isNotNull() & F.col("D_rotation").isNotNull(), F.array_distinct(F.transform(rots, lambda r: pair(F.col("D_period"), r))))
    part = lambda b, i: F.trim(F.regexp_extract(b, BLOCK, i))
    of_block = lambda b: F.flatten(F.transform(_period_atoms(part(b, 1), p), lambda a: F.transform(_rotation_set(part(b, 2), p), lambda r: pair(a, r))))
    return F.array_distinct(F.flatten(F.transform(F.filter(_blocks("D_expression"), lambda b: b.rlike(BLOCK)), of_block)))


def meeting_crosswalk(df: DataFrame, p: ScheduleParams) -> DataFrame:
    """Distinct time values -> their (period, rotation) rows."""
    return df.select(*p.time_cols).distinct().select(*p.time_cols, F.explode(row_meetings(p)).alias("m")).select(*p.time_cols, f"m.{PERIOD}", f"m.{ROTATION}")


def with_meetings(df: DataFrame, p: ScheduleParams) -> DataFrame:
    """One row per meeting of each row; a row without meetings stays once, with nulls."""
    return df.withColumn("__m", F.explode_outer(row_meetings(p))).withColumns({PERIOD: F.col(f"__m.{PERIOD}"), ROTATION: F.col(f"__m.{ROTATION}")}).drop("__m")


def meeting_lists(df: DataFrame, p: ScheduleParams) -> DataFrame:
    """Distinct time values with their meetings as ``period@rotation``, in period order."""
    pos = F.array_position(_texts(p.atoms), F.col(PERIOD)) if p.atoms else F.lit(0)
    order = F.struct((pos == 0), pos, F.col(PERIOD).try_cast("double").isNull(), F.col(PERIOD).try_cast("double"), F.col(PERIOD), F.col(ROTATION))
    return meeting_crosswalk(df, p).groupBy(*p.time_cols).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(order)), lambda s: F.concat(s[PERIOD], F.lit("@"), s[ROTATION])), " | ").alias("meetings"))


def term_slots(p: ScheduleParams) -> list[tuple[str, str, float]]:
    out = []
    for term, w in p.term_weights.items():
        slots = p.term_expands.get(term, [term])
        out += [(str(term), str(s), float(w) / len(slots)) for s in slots]
    return out


def slot_groups(p: ScheduleParams) -> dict[str, list[str]]:
    """First slot -> the slots that are filled alike, by the same terms with the same shares: whatever meets in one of them meets in all. The slot ``NA`` stands alone,
    as class ids write a missing slot so."""
    filled: dict = {}
    for term, slot, share in term_slots(p):
        filled.setdefault(slot, []).append((term, share))
    groups: dict = {}
    for slot, by in filled.items():
        groups.setdefault("NA" if slot == "NA" else tuple(sorted(by)), []).append(slot)
    return {slots[0]: slots for slots in groups.values()}


def term_crosswalk(spark, p: ScheduleParams) -> DataFrame:
    """Term -> finest slots, each with its share of the term's weight. As long as the parameter."""
    return spark.createDataFrame(term_slots(p), f"D_term string, {TERM} string, C_term_weight_exploded double")


def _meeting(period=PERIOD, rotation=ROTATION) -> Column:
    return F.concat_ws("@", F.coalesce(col(period), F.lit("NA")), F.coalesce(col(rotation), F.lit("NA")))


def _by_school(table: dict, school, meeting: Column) -> Column:
    """The entry of a school's meeting. Rows of schools that have none are not looked up: most rows, and no text is made for them."""
    flat = {f"{s}|{m}": float(w) for s, ms in table.items() for m, w in ms.items()}
    found = _get(_map(flat, F.lit), F.concat_ws("|", col(school), meeting), "double")
    return F.when(col(school).isin(*map(str, table)), found) if flat else found


def rotation_weight(p: ScheduleParams, school="D_location_name", period=PERIOD, rotation=ROTATION) -> Column:
    return F.coalesce(_by_school(p.rotation_by_school, school, _meeting(period, rotation)), F.lit(float(p.rotation_default)))


def period_weight(p: ScheduleParams, school="D_location_name", period=PERIOD, rotation=ROTATION) -> Column:
    return F.coalesce(_get(_map({k: float(v) for k, v in p.period_by_period.items()}, F.lit), col(period), "double"),
                      _by_school(p.period_by_school, school, _meeting(period, rotation)), F.lit(float(p.period_default)))


def meeting_minutes(p: ScheduleParams, school="D_location_name", use_default: bool = True, period=PERIOD, rotation=ROTATION) -> Column:
    """Clock length of one meeting: school override, school default, then the district default."""
    overrides = {s: b["overrides"] for s, b in p.bell_by_school.items() if b.get("overrides")}
    defaults = {s: float(b["default"]) for s, b in p.bell_by_school.items() if b.get("default") is not None}
    last = F.lit(p.bell_default if use_default else None).cast("double")
    return F.coalesce(_by_school(overrides, school, _meeting(period, rotation)), _get(_map(defaults, F.lit), col(school), "double"), last)


def weight_crosswalk(meetings: DataFrame, p: ScheduleParams, school="D_location_name") -> DataFrame:
    """Distinct (school, period, rotation) with rotation and period weight."""
    return meetings.select(school, PERIOD, ROTATION).distinct().withColumns(
        {"C_rotation_weight_exploded": rotation_weight(p, school), "C_period_weight_exploded": period_weight(p, school)})


def meeting_breakdown(df: DataFrame, p: ScheduleParams, school="D_location_name") -> DataFrame:
    """Worked example: each distinct (school, time) with its meetings, weights and minutes."""
    times = df.select(school, *p.time_cols).distinct()
    return join_same(times, meeting_crosswalk(times, p), p.time_cols, "inner").select(
        school, *p.time_cols, _meeting().alias("meeting"), rotation_weight(p, school).alias("rotation_wt"),
        period_weight(p, school).alias("period_wt"), meeting_minutes(p, school).alias("minutes"))


def class_weight_minutes(df: DataFrame, p: ScheduleParams, school="D_location_name", term="D_term") -> DataFrame:
    """Class weight = term x sum(rotation x period); minutes = sum of bell minutes.

    Sums over the row's own meetings. No meetings gives zero for both; a meeting without a length gives no minutes.
    """
    d = df.withColumn("__m", F.coalesce(row_meetings(p), F.array().cast(f"array<struct<{PERIOD}:string,{ROTATION}:string>>")))
    total = lambda values: F.aggregate(values, F.lit(0.0), lambda z, x: z + x)
    weights = F.transform("__m", lambda m: rotation_weight(p, school, m[PERIOD], m[ROTATION]) * period_weight(p, school, m[PERIOD], m[ROTATION]))
    minutes = F.transform("__m", lambda m: meeting_minutes(p, school, True, m[PERIOD], m[ROTATION]))
    term_w = _get(_map({k: float(v) for k, v in p.term_weights.items()}, F.lit), col(term).cast("string"), "double")
    return d.withColumns({"M_cls_class_minutes": total(minutes), "M_cls_class_weight": F.bround(term_w * total(weights), 4)}).drop("__m")


ROW_ID = "H_row_id_before_explosions"


def with_row_id(df: DataFrame, distinct_rows: bool = False) -> DataFrame:
    """Give each row an id made from its content; equal rows all stay and are numbered within their kind.

    A content hash is the same on every recomputation, on any executor; a running number over the table is not.
    Equal rows are counted, not sorted out, so a row that occurs very often meets as one count.
    ``distinct_rows`` says there are no equal rows, which saves a shuffle of whole rows.
    """
    content = F.to_json(F.struct(*[F.col(c) for c in df.columns]), {"ignoreNullFields": "false"})
    if distinct_rows:
        return df.withColumn(ROW_ID, F.md5(content))
    rows = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("__copies")).withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("bigint"), "__copies")))
    number = F.when(F.col("__copy") == 1, F.lit("")).otherwise(F.concat(F.lit("#"), F.col("__copy").cast("string")))
    return rows.withColumn(ROW_ID, F.md5(F.concat(content, number))).drop("__copies", "__copy")


ENGINE_COLUMNS = (ROW_ID, "D_stu_id", "D_employee_id", "D_location_id", "D_location_name", "C_class_id", "D_term", "D_period", "D_rotation", "D_expression",
                  "C_course_subject_area", "C_course_time_exclude", "C_class_size_and_teacher_load_exclude", "M_cls_class_weight")


def engine_columns(df: DataFrame, p: ScheduleParams) -> DataFrame:
    """The columns double-booking work needs. The others stay with the record and are joined back by row
    id at the end, so the exploded rows that get shuffled are narrow."""
    return df.select(*[c for c in df.columns if c in ENGINE_COLUMNS or c in p.recipe])


def slot_rows(df: DataFrame, p: ScheduleParams, school="D_location_name", folded: bool = False) -> DataFrame:
    """Meeting rows (:func:`with_meetings`) -> one row per term slot, with the slot's weight. ``folded``: only the first of slots that are filled alike (:func:`unfold` adds the others)."""
    slots: dict = {}
    firsts = slot_groups(p)
    for term, slot, share in term_slots(p):
        if not folded or slot in firsts:
            slots.setdefault(term, []).append(F.struct(F.lit(slot).alias("slot"), F.lit(share).alias("share")))
    out = df.withColumn("D_term", F.col("D_term").cast("string"))
    out = out.withColumn("__t", F.explode_outer(_get(_map(slots, lambda v: F.array(*v)), F.col("D_term"), "array<struct<slot:string,share:double>>")))
    out = out.withColumns({TERM: F.col("__t.slot"), "C_term_weight_exploded": F.col("__t.share")}).drop("__t")
    out = out.withColumns({"C_rotation_weight_exploded": rotation_weight(p, school), "C_period_weight_exploded": period_weight(p, school)})
    return out.withColumn("M_class_weight_exploded", F.bround(F.col("C_term_weight_exploded") * F.col("C_rotation_weight_exploded") * F.col("C_period_weight_exploded"), 4))


def unfold(df: DataFrame, p: ScheduleParams, class_ids: bool = False) -> DataFrame:
    """Folded slot rows -> a row for each slot. ``class_ids``: ``C_class_id`` is that of the slot and is written again, from the columns of the recipe."""
    many = {first: slots for first, slots in slot_groups(p).items() if len(slots) > 1}
    if not many:
        return df
    out = df.withColumn(TERM, F.explode(F.coalesce(_get(_map(many, _texts), F.col(TERM), "array<string>"), F.array(TERM))))
    return out.withColumn("C_class_id", slot_class_id(out.columns, p.recipe)) if class_ids else out


def slots_of(p: ScheduleParams) -> Column:
    """How many slots a folded row stands for."""
    return F.coalesce(_get(_map({first: len(slots) for first, slots in slot_groups(p).items()}, F.lit), F.col(TERM), "int"), F.lit(1))


def term_group(p: ScheduleParams, term="D_term") -> Column:
    """A label that terms share if they have a slot in common, directly or through other terms. A term without slots counts as the slot ``NA``, as class ids write it.

    Worked out on the parameter: a literal map."""
    groups: list[tuple[set, set]] = [(set(), {"NA"})]
    for name, slot, _ in term_slots(p):
        near = [g for g in groups if name in g[0] or slot in g[1]]
        groups = [g for g in groups if g not in near] + [({name}.union(*[g[0] for g in near]), {slot}.union(*[g[1] for g in near]))]
    label = {name: min(slots) for names, slots in groups for name in names}
    other = next(min(slots) for _, slots in groups if "NA" in slots)
    return F.coalesce(_get(_map(label, F.lit), col(term).cast("string"), "string"), F.lit(other))


def explode_records(df: DataFrame, p: ScheduleParams, school="D_location_name", new_id: bool = True) -> DataFrame:
    """Record -> one row per meeting and term slot, with the slot's weight. Needs :func:`with_row_id`.

    ``new_id`` adds an id per exploded row; the resolution does without it.
    """
    out = slot_rows(with_meetings(df, p), p, school)
    return out.withColumn("H_new_record_id", paste("|", ROW_ID, TERM, PERIOD, ROTATION)) if new_id else out


def explosion_sums(exploded: DataFrame) -> DataFrame:
    """One row per record: the sum of its slot weights beside its class weight, which every exploded row carries. No record is left out: one without meetings or slots stays as a row.

    One aggregate, combined before the shuffle: the rows of a record are made in one task."""
    return exploded.groupBy(ROW_ID).agg(F.bround(F.sum("M_class_weight_exploded"), 4).alias("exploded_sum"), F.bround(F.max("M_cls_class_weight"), 4).alias("class_weight"))


def _unequal(tolerance: float) -> Column:
    return F.abs(F.col("exploded_sum") - F.col("class_weight")) >= tolerance


def explosion_differences(exploded: DataFrame, records: DataFrame | None = None, tolerance: float = 1e-6) -> DataFrame:
    """Records whose slot weights do not add up to the class weight: that of ``records``, else the one that the exploded rows carry."""
    if records is None:
        return explosion_sums(exploded).filter(_unequal(tolerance))
    s = exploded.groupBy(ROW_ID).agg(F.bround(F.sum("M_class_weight_exploded"), 4).alias("exploded_sum"))
    return join_same(s, records.select(ROW_ID, F.bround("M_cls_class_weight", 4).alias("class_weight")), ROW_ID).filter(_unequal(tolerance))


def explosion_accounts(exploded: DataFrame, tolerance: float = 1e-6) -> DataFrame:
    """Records, and those whose slot weights do not add up, in one pass over the exploded rows."""
    return explosion_sums(exploded).agg(F.count(F.lit(1)).alias("n_records"), F.count_if(_unequal(tolerance)).alias("n_different"))


def serialize_meetings(df: DataFrame, keys, out: str = "merged_expr", period=PERIOD, rotation=ROTATION) -> DataFrame:
    """Meetings of each key as compact text such as ``1-3(A-B), 5(A)``.

    Periods with the same rotations form runs of consecutive numbers; periods that are not numbers are
    written singly, last. A key has at most as many rows here as there are period values.
    """
    keys = list(keys)
    per = df.select(*keys, period, rotation).distinct().filter(F.col(period).isNotNull() & F.col(rotation).isNotNull()).groupBy(*keys, period).agg(
        F.array_join(F.array_sort(F.collect_set(rotation)), "-").alias("label"))
    per = per.withColumn("n", F.col(period).try_cast("int"))
    rn = F.row_number().over(Window.partitionBy(*keys, "label").orderBy(F.col("n").asc_nulls_last()))
    run = per.withColumn("island", F.when(F.col("n").isNotNull(), (F.col("n") - rn).cast("string")).otherwise(F.concat(F.lit("t"), F.col(period))))
    seg = run.groupBy(*keys, "label", "island").agg(F.min("n").alias("a"), F.max("n").alias("b"), F.min(period).alias("t"))
    text = F.concat(F.when(F.col("a").isNull(), F.col("t")).when(F.col("a") == F.col("b"), F.col("a").cast("string"))
                     .otherwise(F.concat_ws("-", F.col("a").cast("string"), F.col("b").cast("string"))), F.lit("("), F.col("label"), F.lit(")"))
    one = F.struct(F.col("a").isNull().alias("last"), F.col("a"), F.col("label"), F.col("t"), text.alias("x"))
    return seg.groupBy(*keys).agg(F.array_join(F.transform(F.array_sort(F.collect_list(one)), lambda s: s["x"]), ", ").alias(out))


def conflict_keys(df: DataFrame, p: ScheduleParams) -> DataFrame:
    """One row per record and conflict key ``period@rotation|term slot``; records without a meeting keep a null key."""
    m = with_meetings(df, p)
    slots = _get(_map(p.term_expands, _texts), F.col("D_term").cast("string"), "array<string>")
    m = m.withColumn("__slot", F.explode(F.coalesce(slots, F.array(F.col("D_term").cast("string")))))
    return m.withColumn("M_conflict_key", F.when(F.col(PERIOD).isNotNull(), F.concat(_meeting(), F.lit("|"), F.col("__slot")))).drop("__slot", PERIOD, ROTATION)


def conflicting(long: DataFrame, entity: str, class_col: str = "C_class_id") -> DataFrame:
    """Entities with more than one class at a conflict key."""
    from ..functions.nullsafe import n_distinct
    return long.filter(F.col("M_conflict_key").isNotNull()).groupBy(entity, "M_conflict_key").agg(
        n_distinct(class_col).alias("n_classes")).filter("n_classes > 1")


def conflict_sizes(df: DataFrame, p: ScheduleParams, entities=("D_stu_id", "D_employee_id"), class_col: str = "C_class_id") -> DataFrame:
    """How many entities are double-booked before anything is resolved, and how many would be without the rows that ``p.sizing_filters`` match.

    One row per entity column and scenario: all rows, without the rows of each rule alone, without those of any rule; null is one entity and one class more. The data stay as they
    are. A class carries one bit for each scenario that it has a row in, so all scenarios share one deal of narrow rows by entity and key.
    """
    matches = [rule_matches(df.columns, r) for r in p.sizing_filters]
    keep = {"all rows": F.lit(True)} | {f"without {r['col']} {r['op']} {', '.join(map(str, r['val'] if isinstance(r['val'], (list, tuple)) else [r['val']]))}": ~m for r, m in zip(p.sizing_filters, matches, strict=True)}
    if len(matches) > 1:
        keep["without any"] = ~any_of(matches)
    n = range(len(keep))
    marked = df.withColumns({f"__keep{i}": k for i, k in enumerate(keep.values())})
    long = conflict_keys(marked, p)
    mask = sum((F.when(F.col(f"__keep{i}"), 1 << i).otherwise(0) for i in n), F.lit(0))
    has = lambda i: F.col("__mask").bitwiseAND(1 << i) != 0
    sizes = []
    for entity in entities:
        rows = long.select(F.col(entity).alias("__e"), "M_conflict_key", F.col(class_col).alias("__c"), mask.alias("__mask")).repartition("__e", "M_conflict_key")
        cls = rows.groupBy("__e", "M_conflict_key", "__c").agg(F.bit_or("__mask").alias("__mask"))
        per = cls.groupBy("__e", "M_conflict_key").agg(*[F.count_if(has(i)).alias(f"__k{i}") for i in n])
        two = lambda i: F.col("M_conflict_key").isNotNull() & (F.col(f"__k{i}") > 1)
        one = per.groupBy("__e").agg(*[F.max(F.col(f"__k{i}") > 0).alias(f"__in{i}") for i in n], *[F.max(two(i)).alias(f"__two{i}") for i in n])
        total = one.agg(*[F.count_if(F.col(f"__in{i}")).alias(f"n{i}") for i in n], *[F.count_if(F.col(f"__two{i}")).alias(f"d{i}") for i in n])
        sizes.append(total.select(F.inline(F.array(*[F.struct(F.lit(entity).alias("entity"), F.lit(name).alias("scenario"), F.col(f"n{i}").alias("n_entities"), F.col(f"d{i}").alias("n_double_booked"),
                                                              F.try_divide(F.lit(100.0) * F.col(f"d{i}"), F.col(f"n{i}")).alias("pct_double_booked")) for i, name in enumerate(keep)]))))
    return reduce(DataFrame.unionByName, sizes)
