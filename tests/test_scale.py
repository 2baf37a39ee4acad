"""Operators that must hold with one hot key or very many values: rank selection, null keys, distinct counts, sinks."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from rollbook.functions import nullsafe as N
from rollbook.operators import aggregates as A
from rollbook.operators import double_booking as DB
from rollbook.operators.checks import CheckFailed, CheckLog
from rollbook.sources.sinks import Sink


@pytest.fixture
def plain_plans(spark):
    """Sort-merge joins and plans as they are, so that their exchanges can be counted."""
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


# ---------------------------------------------------------------- quantiles

def test_rank_values_match_numpy(spark):
    r = random.Random(4)
    rows = [(g, None if r.random() < 0.1 else round(r.gauss(0, 9), r.choice([0, 3])), r.choice([None, 1, 2, 3])) for g in ["a", "b", None] for _ in range(r.choice([1, 2, 700]))]
    rows += [("c", None, 5), ("d", 7.5, None)]
    df = spark.createDataFrame(rows, "g string, v double, w int").repartition(7)
    points = [0.0, 0.1, 0.5, 0.99, 1.0]
    got = {x.g: x for x in A.rank_values(df, ["g"], ["v", "w"], points).collect()}
    assert set(got) == {x[0] for x in rows}
    for g, x in got.items():
        for k, c in enumerate(("v", "w"), 1):
            known = [row[k] for row in rows if row[0] == g and row[k] is not None]
            for i, p in enumerate(points):
                assert x[f"{c}_{i}"] == (pytest.approx(np.quantile(known, p)) if known else None)
    whole = A.rank_values(df, [], ["v"], [0.5]).collect()
    assert whole[0].v_0 == pytest.approx(np.median([row[1] for row in rows if row[1] is not None]))
    assert A.rank_values(df.limit(0), ["g"], ["v"], [0.5]).collect() == []


def test_rank_values_touch_only_the_slices_they_need(spark):
    df = spark.range(200_000).select(F.lit(1).alias("g"), (F.col("id") * 7919 % 200_003).cast("double").alias("v"))
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        out = A.rank_values(df, ["g"], ["v"], [0.25, 0.5])
        assert [tuple(x) for x in out.collect()] == [(1, *np.quantile(np.arange(200_000) * 7919 % 200_003, [0.25, 0.5]))]
        plan = out._jdf.queryExecution().optimizedPlan().toString().lower()
        assert "percentile" not in plan and "median" not in plan and "collect_list" not in plan
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


# ---------------------------------------------------------------- null keys

LEFT = [(1, "x", 1.5), (1, None, 2.5), (None, "x", 3.5), (None, None, 4.5), (None, None, 5.5), (2, "", 6.5), (0, "y", 7.5)]
RIGHT = [(1, "x", "A"), (None, None, "B"), (None, "x", "C"), (2, None, "D"), (0, None, "E"), (2, "", "F"), (2, "", "G")]


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti", "right", "full"])
@pytest.mark.parametrize("split", [False, True])
def test_null_keys_match_null_keys(spark, how, split):
    left, right = spark.createDataFrame(LEFT, "a int, b string, v double"), spark.createDataFrame(RIGHT, "c bigint, d string, w string")
    if split and how in ("right", "full"):
        with pytest.raises(ValueError):
            N.join_same(left, right, ["a", "b"], how, right_on=["c", "d"], split_null=True)
        return
    hits = [(x, y) for x in LEFT for y in RIGHT if x[:2] == y[:2]]
    want = {"inner": [(*x, y[2]) for x, y in hits], "left_semi": [x for x in LEFT if any(x == h[0] for h in hits)], "left_anti": [x for x in LEFT if not any(x == h[0] for h in hits)]}
    want["left"] = want["inner"] + [(*x, None) for x in want["left_anti"]]
    want["right"] = want["inner"] + [(None, None, None, y[2]) for y in RIGHT if not any(y == h[1] for h in hits)]
    want["full"] = want["left"] + want["right"][len(want["inner"]):]
    out = N.join_same(left, right, ["a", "b"], how, right_on=["c", "d"], split_null=split)
    assert out.columns == (["a", "b", "v"] if how.startswith("left_") else ["a", "b", "v", "w"])
    assert sorted(map(tuple, out.collect()), key=str) == sorted(want[how], key=str)


def test_keys_of_other_types(spark):
    when = "timestamp'2020-01-01 00:00:00'"
    df = spark.sql(f"select * from values (date'1970-01-01', {when}, true, X'00', array(1), 1), (null, null, null, null, null, 2), (date'2020-02-02', {when}, false, X'', array(2), 3) t(d, t, b, x, l, v)")
    for c in ("d", "t", "b", "x", "l"):
        assert N.join_same(df, df.select(c, F.col("v").alias("w")), c, "inner").filter("v = w").count() == 3
        assert N.attach(df, c, F.max("v").alias("m")).filter("m >= v").count() == 3


def test_attach_deals_totals_once(spark, plain_plans):
    df = spark.range(1000).select((F.when(F.col("id") % 3 > 0, F.col("id") % 5)).alias("k"), F.when(F.col("id") % 7 > 0, F.lit("s")).alias("s"), "id")
    out = N.attach(df, ["k", "s"], F.count(F.lit(1)).alias("n"))
    assert physical(out).count("Exchange hashpartitioning") == 2
    assert out.columns == ["k", "s", "id", "n"] and out.filter("k is null and s = 's'").select("n").distinct().collect()[0].n == 286


def test_rows_without_a_key_are_split(spark, plain_plans):
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        left = spark.range(0, 20_000, 1, 16).select(F.when(F.col("id") % 4 == 0, F.col("id")).alias("k"), "id")
        right = spark.range(0, 20_000, 4).select(F.col("id").alias("k"), F.lit("r").alias("w")).unionByName(spark.createDataFrame([(None, "none")], "k bigint, w string"))
        sizes = lambda df: [r["count"] for r in df.filter("k is null").groupBy(F.spark_partition_id().alias("p")).count().collect()]
        whole, split = (N.join_same(left, right, "k", split_null=s) for s in (False, True))
        assert len(sizes(whole)) == 1 and max(sizes(split)) < 15_000 / 3 and sum(sizes(split)) == 15_000
        assert split.filter("(k is null and w = 'none') or (k is not null and w = 'r')").count() == 20_000
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


# ---------------------------------------------------------------- distinct counts

def test_distinct_counts_on_two_levels(spark):
    rows = [(g, e, v) for g in (1, None) for e in ("a", "b", None) for v in (0, 1, None)] + [(2, "a", 0)]
    df = spark.createDataFrame(rows, "g int, e string, v int")
    out = N.distinct_counts(df, "g", "e", {"ones": F.col("v") == 1, "nulls": F.col("v").isNull()}, "n")
    assert sorted(map(tuple, out.collect()), key=str) == sorted([(1, 3, 3, 3), (None, 3, 3, 3), (2, 1, 0, 0)], key=str)
    assert "Expand" not in physical(out)


def test_flag_totals_never_expand_the_rows(spark):
    rows = [("N", 1, 10, 1, 0, 0.5), ("N", 1, 10, 0, 0, 0.5), ("N", 2, None, 0, 1, 0.5), ("S", 2, 11, 0, 0, 1.0), ("S", None, 11, 1, 1, 1.0)]
    df = spark.createDataFrame(rows, f"D_location_name string, D_stu_id int, D_employee_id int, H_db_student_row int, H_db_teacher_row int, {DB.WEIGHT} double")
    got = {r.metric: (r.n_flagged, r.n_total) for r in DB.flag_totals(df).collect()}
    assert got == {"students": (2, 3), "teachers": (2, 3), "student rows": (2, 5), "teacher rows": (2, 5)}
    plan = physical(DB.flag_totals(df))
    assert plan.index("Expand") < plan.index("HashAggregate(keys=[D_stu_id") if "Expand" in plan else True  # only above the pre-grouped level
    by = DB.flags_by_school(df)
    assert "Expand" not in physical(by)
    assert {r.D_location_name: (r.students, r.students_flagged, r.teachers, r.teachers_flagged, r.total_weight) for r in by.collect()} == {"N": (2, 1, 1, 0, 1.5), "S": (1, 0, 1, 1, 2.0)}


# ---------------------------------------------------------------- sinks

def test_sink_publishes_whole_runs_once(spark, tmp_path):
    sink, log = Sink(spark, str(tmp_path)), CheckLog(spark)
    df = spark.createDataFrame([(1, "a"), (2, None)], "k int, v string")
    first = sink.publish(df, "table", "run-1", log, {"k": "int"})
    assert first["rows"] == 2 and sink.publish(df.unionAll(df), "table", "run-1", log) == first
    assert sorted(map(tuple, sink.read("table").collect())) == [(1, "a"), (2, None)]
    sink.publish(df.withColumn("more", F.lit(1.5)).limit(1), "table", "run-2", log)
    assert sink.read("table").columns == ["k", "v", "more"] and sink.read("table", every_run=True).groupBy("run_id").count().count() == 2
    assert [m["run"] for m in sink.runs("table")] == ["run-1", "run-2"]
    assert sink.publish(df.limit(0), "table", "run-3", log) is None and sink.publish(None, "table", "run-4", log) is None and len(sink.runs("table")) == 2
    assert [r[2] for r in log.rows if "skipped" in r[2]] == ["output skipped, empty: table"] * 2
    with pytest.raises(ValueError):
        sink.publish(df, "table", "../run")


def test_failed_run_leaves_nothing_visible(spark, tmp_path):
    sink = Sink(spark, str(tmp_path))
    df = spark.range(10).select(F.col("id").alias("k"))
    broken = df.select(F.when(F.col("k") < 9, F.col("k")).otherwise(F.raise_error(F.lit("lost"))).alias("k"))
    with pytest.raises(Exception, match="lost"):
        sink.publish(broken, "table", "run-1")
    assert sink.runs("table") == []
    with pytest.raises(CheckFailed, match="nothing published"):
        sink.read("table")
    with pytest.raises(CheckFailed, match="missing or of another type: v"):
        sink.publish(df, "table", "run-1", CheckLog(spark), {"k": "bigint", "v": "string"})
    assert sink.publish(df, "table", "run-1")["rows"] == 10 and sink.read("table").count() == 10


def test_check_log_is_published_once_a_run(spark, tmp_path):
    sink, log = Sink(spark, str(tmp_path)), CheckLog(spark)
    log.begin("stage")
    log.info("rows", 5)
    log.add_gate("fine", True)
    assert log.write(sink, "r1", "North", {"a": 1})["rows"] == 2 and log.write(sink, "r1", "North", {"a": 2})["rows"] == 2
    got = sink.read("check_log").orderBy("seq").collect()
    assert [(r.stage, r.check, r.severity, r.result, r.value, r.district) for r in got] == [("stage", "rows", "info", "INFO", "5", "North"), ("stage", "fine", "stop", "PASS", None, "North")]
    assert len({r.config_hash for r in got}) == 1 and len(got[0].config_hash) == 12
