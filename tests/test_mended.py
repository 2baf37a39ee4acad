"""Hand-computed cases for records that are equal, merges that fail, evidence, natural order and the community search."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from rollbook.functions.text import natural_sort
from rollbook.operators import joins as J
from rollbook.operators import meetings as M
from rollbook.operators import network as N
from rollbook.operators.checks import Check, CheckFailed, CheckLog


def test_equal_records_keep_their_own_ids(spark):
    d = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (1, "a")], "x int, y string")
    ids = M.with_row_id(d).groupBy("x", "y").agg(F.count(F.lit(1)).alias("n"), F.count_distinct(M.ROW_ID).alias("k")).collect()
    assert sorted((r.x, r.n, r.k) for r in ids) == [(1, 3, 3), (2, 1, 1)]
    alone = M.with_row_id(spark.createDataFrame([(1, "a")], d.schema)).first()[M.ROW_ID]
    assert alone in {r[M.ROW_ID] for r in M.with_row_id(d).collect()}
    assert alone == M.with_row_id(spark.createDataFrame([(1, "a")], d.schema), distinct_rows=True).first()[M.ROW_ID]


def test_failed_merge_stops(spark):
    d = spark.createDataFrame([(1, "A", 1996), (2, "B", 1997)], "id int, nm string, yr int")
    ok = J.merge_plan(d, "id", "nm", "yr", [{"name": "A", "absorbs": ["B"]}])
    assert {(r.id, r.C_location_id) for r in J.apply_merges(d, ok, "id", "nm").collect()} == {(1, 1), (2, 1)}
    bad = J.merge_plan(d, "id", "nm", "yr", [{"name": "A", "absorbs": ["B", "nowhere"]}])
    with pytest.raises(CheckFailed, match="nowhere into A"):
        J.apply_merges(d, bad, "id", "nm")


def test_evidence_of_checks_with_a_common_start(spark, tmp_path):
    log = CheckLog(spark, evidence_dir=str(tmp_path))
    name = "the same sixty characters at the start of two different checks: "
    for k in (1, 2):
        with pytest.raises(CheckFailed):
            log.require(Check(name + str(k), spark.range(k)))
    found = [p for p in tmp_path.iterdir() if p.name.startswith("the_same")]
    assert sorted(spark.read.parquet(str(p)).count() for p in found) == [1, 2]


def test_natural_order_of_long_numbers(spark):
    names = ["x10", "x9", "x0009", "x123456789012345678", "x99999999999999", "x", "y1 b", "y1 a", "y01 a"]
    got = spark.createDataFrame([(names,)], "v array<string>").select(natural_sort("v").alias("v")).first().v
    assert [x for x in got if x.startswith("x")][-3:] == ["x10", "x99999999999999", "x123456789012345678"]
    assert {got.index("x9"), got.index("x0009")} == {got.index("x10") - 1, got.index("x10") - 2}
    assert got.index("y1 a") < got.index("y1 b")


def roster(spark, classes):
    rows = [("S", c, s) for c, ss in classes.items() for s in ss]
    return spark.createDataFrame(rows, "D_location_name string, C_class_id string, D_stu_id string")


def test_planted_groups_are_found_and_blocks_do_not_matter(spark, monkeypatch):
    groups = [[f"{g}{i}" for i in range(6)] for g in "abc"]
    classes = {f"{g[0]}{k}": g for g in groups for k in range(2)} | {f"bridge{k}": [groups[k][5], groups[(k + 1) % 3][0]] for k in range(3)}
    found = []
    for block in (1024, 2):
        monkeypatch.setattr(N, "BLOCK", block)
        by = {}
        for r in N.infer_communities(roster(spark, classes)).collect():
            by.setdefault(r.community, set()).add(r.D_stu_id)
        found.append(sorted(map(sorted, by.values())))
    assert found[0] == found[1] == [sorted(g) for g in groups]
