"""Nearest neighbours from the forest of hash prefixes against brute force, and on awkward input."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F
from rollbook.llm import prefix_forest, queries


def plain(rows, k=5, asks=lambda i: i % 50 == 0):
    """The exact answer: query id to (score, id) of its nearest others."""
    good = {(i, tuple(v)) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)}
    out = {}
    for i, v in good:
        if asks(i):
            a = np.array(v, dtype=float)
            scores = [(float(np.dot(a, w) / (np.linalg.norm(a) * np.linalg.norm(w))), j) for j, w in good if j != i and len(w) == len(v)]
            out[i] = sorted(scores, key=lambda x: (-round(x[0], 12), x[1]))[:k]
    return out


def found(df):
    out: dict[int, list] = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.score, r.vec_id))
        assert r["rank"] == len(out[r.query_id])
    return out


def recall(got, want) -> float:
    return sum(len({j for _, j in got.get(q, [])} & {j for _, j in w}) for q, w in want.items()) / sum(map(len, want.values()))


def check(got, rows, want):
    vectors = dict(rows)
    assert set(got) == {q for q, w in want.items() if w}
    for q, answers in got.items():
        assert len(answers) == len(want[q]) and len({j for _, j in answers}) == len(answers) and q not in {j for _, j in answers}
        assert answers == sorted(answers, key=lambda x: (-x[0], x[1]))
        for s, j in answers:
            a, b = np.array(vectors[q], dtype=float), np.array(vectors[j], dtype=float)
            assert s == pytest.approx(a @ b / (np.linalg.norm(a) * np.linalg.norm(b)), abs=1e-12)


@pytest.mark.parametrize(("folder", "blocks"), [("sf0.01", 1), ("sf0.1", 1), ("sf0.1", 7)])
def test_query_recall(spark, monkeypatch, folder, blocks):
    if blocks > 1:
        monkeypatch.setattr(prefix_forest, "VALUES", 2000 * 64 // blocks)
    path = f"/root/testdata/{folder}"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{path}/embeddings.parquet").collect()]
    want, got = plain(rows), found(queries.op12_hash_prefix_forest(spark, path))
    check(got, rows, want)
    assert recall(got, want) >= 0.9


def test_clusters_end_deep(spark):
    r = np.random.default_rng(1)
    centres = r.standard_normal((40, 32))
    x = (centres[r.integers(0, 40, 6000)] + 0.2 * r.standard_normal((6000, 32))).astype(np.float32)
    rows = list(enumerate(x.tolist()))
    want, got = plain(rows), found(prefix_forest.nearest(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>"), F.col("vec_id") % 50 == 0))
    check(got, rows, want)
    assert recall(got, want) >= 0.9
    forest = prefix_forest.Forest(np.arange(6000), np.arange(6000), x.astype(float), 32, 62, 0.05)
    asked = x[::50].astype(float)
    seen = []
    compare = forest.compare
    forest.compare = lambda v, low, high, n: seen.append((high - low).sum()) or compare(v, low, high, n)
    assert len(list(forest.search(asked, np.full(len(asked), -1), 6))) == len(asked)
    assert len(seen) / len(asked) < 4 and np.median(seen) < 6000 * 32 / 10  # most comparisons see a small part of the trees


def test_copies_and_ties(spark):
    same, near = [0.5, 0.5, 0.1], [0.5, 0.5, 0.11]
    rows = [(i, same) for i in range(300)] + [(i, near) for i in range(300, 320)] + [(320 + i, [1.0, float(i), -1.0]) for i in range(50)]
    got = found(prefix_forest.nearest(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>"), F.col("vec_id") % 50 == 0))
    assert [j for _, j in got[0]] == [1, 2, 3, 4, 5] and [j for _, j in got[250]] == [0, 1, 2, 3, 4] and [j for _, j in got[300]] == [301, 302, 303, 304, 305]
    check(got, rows, plain(rows))


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (50, [1.0, 0.1]), (50, [1.0, 0.1]), (1, [0.0, 0.0]), (2, None), (3, []), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]), (None, [1.0, 0.0]), (7, [1.0, 2.0, 3.0]),
            (100, [3.0, 2.0, 1.0]), (150, [0.0, 0.0, 0.0]), (8, [-1.0, 0.0]), (200, [1.0])]
    docs = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").withColumn("row", F.lit("x")).withColumn("score", F.lit(None).cast("string"))
    got = found(prefix_forest.nearest(docs, F.col("vec_id") % 50 == 0))
    assert {q: [j for _, j in a] for q, a in got.items()} == {0: [50, 8], 50: [0, 8], 100: [7]}
    assert prefix_forest.nearest(docs.limit(0), F.col("vec_id") % 50 == 0).collect() == []
    assert prefix_forest.nearest(docs, F.lit(None).cast("boolean")).collect() == []


def test_enough():
    x = prefix_forest.enough(np.array([1.0, 0.9, 0.4, -1.0]), 32, 62, 0.05)
    assert x[0] == 62 and x[3] == 0 and 62 > x[1] > x[2] > 0
    for score, n in zip((0.9, 0.4), x[1:3], strict=True):
        p = 1 - math.acos(score) / math.pi
        assert (1 - p ** int(n)) ** 32 <= 0.05 < (1 - p ** (int(n) + 1)) ** 32
