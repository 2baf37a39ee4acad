"""Course names of a group collapsed as tables, against the expression that works on one array."""

from __future__ import annotations

import random
import time

from pyspark.sql import functions as F
from rollbook.functions import text
from rollbook.operators import names


def both(spark, rows):
    df = spark.createDataFrame(rows, "c string, n string")
    want = text.collapse_names(df.groupBy("c").agg(F.collect_set("n").alias("ns")), "ns", "label")
    return {r.c: r.label for r in names.collapse_names(df, "c", "n", "label").collect()}, {r.c: r.label for r in want.collect()}


def test_labels_match_the_array_form(spark):
    r = random.Random(2)
    vocabulary = ["Algebra", "I", "II", "Honors", "10", "9", "09", "Math", "Math", "A.P."]
    rows = [(f"c{k}", " ".join(r.choice(vocabulary) for _ in range(r.randint(1, 4)))) for k in range(120) for _ in range(r.choice([1, 2, 2, 6]))]
    rows += [("null", None), ("blank", "  "), ("spaces", " Algebra   I "), ("spaces", "Algebra I"), (None, "x"), (None, "x y"), ("same", "b"), ("same", "b")]
    got, want = both(spark, rows)
    assert got == want and got["null"] is None and got["spaces"] == "Algebra I" and got[None] == "x y"


def test_parts_of_other_names(spark):
    rows = [("a", x) for x in ("Art", "Art History", "World Art History", "Smart", "History World", "art")] + [("b", "Art")]
    df = spark.createDataFrame(rows, "key string, name string")
    assert sorted(r.name for r in names.contained_names(df).collect()) == ["Art", "Art History"]


def test_a_class_of_very_many_names(spark):
    words = [f"w{k}" for k in range(230)]
    df = spark.range(50_000).select(F.lit("big").alias("c"), F.concat_ws(" ", F.lit("Course"), F.element_at(F.array(*[F.lit(w) for w in words]), (F.col("id") % 230 + 1).cast("int")), (F.col("id") / 230).cast("int").cast("string")).alias("n"))
    df = df.unionByName(spark.createDataFrame([("big", "Course w1"), ("big", "Course"), ("big", "w5 17")], "c string, n string"))
    start = time.time()
    label = names.collapse_names(df, "c", "n", "label").first().label
    assert label.startswith("Course w0 0 / w0 1 / w0 2 ") and label.count(" / ") == 49_999 and time.time() - start < 120


def test_names_are_dealt_once(spark):
    """Keys whose names have the same number of words need no search, and the label takes one exchange of the stored names."""
    rows = [("a", "red bolt 1"), ("a", "red bolt 2"), ("a", "red ring 10"), ("b", None), ("c", " "), ("d", "hot gear"), (None, "x y"), (None, "x z")]
    got = names.collapse_names(spark.createDataFrame(rows, "k string, n string"), "k", "n", "label")
    assert {r["k"]: r["label"] for r in got.collect()} == {"a": "red bolt 1 / bolt 2 / ring 10", "b": None, "c": None, "d": "hot gear", None: "x y / z"}
    plan = got._jdf.queryExecution().sparkPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan and got._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1].count("Exchange") == 1
