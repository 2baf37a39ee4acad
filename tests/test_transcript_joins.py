"""Wide transcript rows are joined once for what is known of a course and once for what is known of a student's year; peers are counted without pairs."""

from __future__ import annotations

import os
import random
import subprocess
import sys
from collections import Counter

import pytest
from pyspark import cloudpickle
from test_pairs import SCHEMA, brute
from test_scale import physical, plain_plans  # noqa: F401

from rollbook.operators import joins as J
from rollbook.operators import network as N


def test_coding_deals_the_rows_once(spark, plain_plans):  # noqa: F811
    tr = spark.createDataFrame([("A1", "x", "r1"), ("A1", "y", "r2"), ("A1", "y", "r3"), ("B", None, "r4"), (None, None, "r5")], "D_course_id string, D_course_name string, note string")
    coding = spark.createDataFrame([("A1", "x", "K1"), ("B", "z", "K2")], "D_course_id string, D_course_name string, C_course_id string")
    out = J.code_courses(tr, coding)
    assert {(r.note, r.C_course_id, r.C_coding_source) for r in out.collect()} == {
        ("r1", "K1", "id_and_name"), ("r2", "K1", "id_only"), ("r3", "K1", "id_only"), ("r4", "K2", "id_only"), ("r5", None, None)}
    assert out.columns == [*tr.columns, "C_coding_source", "C_course_id"]
    wide = 0  # exchanges whose rows carry the note
    node = [out._jdf.queryExecution().executedPlan()]
    while node:
        x = node.pop()
        wide += x.nodeName() == "Exchange" and "note" in x.output().toString()
        node += [x.children().apply(i) for i in range(x.children().size())]
    assert wide == 1


@pytest.mark.parametrize("block", [1, 3, 4096])
def test_peer_counts_equal_brute_force(spark, block):
    rng = random.Random(9)
    rows = {(loc, f"c{rng.randrange(12)}", f"s{rng.randrange(40)}") for loc in ("North", None) for _ in range(200)}
    rows |= {("North", None, f"s{k}") for k in range(6)} | {("North", "big", f"s{k}") for k in range(40)} | {("South", "alone", "s1"), ("South", "x", None), ("South", "x", "s2")}
    counts = N.peer_counts(spark.createDataFrame(sorted(rows, key=str), SCHEMA), block)
    want = Counter((loc, s, m) for (loc, a, b), m in brute(rows).items() for s in (a, b))
    assert {(r.D_location_name, r.D_stu_id, r.M_shared_classes): r.M_stu_peers for r in counts.collect()} == want
    d = spark.createDataFrame(sorted(rows, key=str), SCHEMA)
    assert sorted(map(str, N.continuity_of_counts(counts, [1, 2]).collect())) == sorted(map(str, N.peer_continuity(N.student_pairs(d), [1, 2]).collect()))


def test_peer_counts_hold_no_pairs(spark):
    d = spark.createDataFrame([("North", f"c{k % 5}", f"s{k % 30}") for k in range(150)], SCHEMA)
    plan = physical(N.peer_counts(d, 8))
    assert "FlatMapGroupsInPandas" in plan and "explode(__as" not in plan and "collect_list" not in plan
    assert N.peer_counts(d.limit(0)).collect() == []


def test_peer_function_needs_no_package_on_executors(spark, monkeypatch, tmp_path):
    sent = []
    monkeypatch.setattr("pyspark.sql.pandas.group_ops.PandasGroupedOpsMixin.applyInPandas", lambda self, f, schema: sent.append(f) or spark.createDataFrame([], schema))
    N.peer_counts(spark.createDataFrame([("North", "c", "s")], SCHEMA))
    (tmp_path / "f").write_bytes(cloudpickle.dumps(sent[0]))
    load = "import pickle, sys; assert callable(pickle.load(open('f', 'rb'))); assert 'rollbook' not in sys.modules"
    assert subprocess.run([sys.executable, "-c", load], cwd=tmp_path, env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"}, check=False).returncode == 0
