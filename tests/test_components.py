"""Connected components by contraction."""

from __future__ import annotations

import random

import pytest
from rollbook.operators import components


def plain(rows):
    root = {n: n for n, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    first: dict = {}
    for n, g in rows:
        a, b = find(n), find(first.setdefault(g, n))
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in root}


def shape(kind: str):
    r = random.Random(kind)
    if kind == "chain":
        return [(k + d, k) for k in range(300) for d in (0, 1)]
    if kind == "falling chain":
        return [(300 - k - d, k) for k in range(300) for d in (0, 1)]
    if kind == "star":
        return [(0, k) for k in range(200)] + [(k + 1, k) for k in range(200)]
    if kind == "one group":
        return [(k, 7) for k in range(500)]
    if kind == "alone":
        return [(k, k) for k in range(20)]
    return [(r.randrange(400), r.randrange(300)) for _ in range(450)]


@pytest.mark.parametrize("kind", ["chain", "falling chain", "star", "one group", "alone", "random"])
def test_components(spark, monkeypatch, kind):
    stored, keep = [], components.cut_lineage

    def store(df):
        out = keep(df)
        if out.columns in (["n", "g"], ["g", "n"]):
            stored.append(out.count())
        return out
    monkeypatch.setattr(components, "cut_lineage", store)
    rows = shape(kind)
    df = spark.createDataFrame(rows + rows[:5], "n int, g int")
    assert {r.n: r.component for r in components.connected_components(df, "n", "g").collect()} == plain(rows)
    assert stored[-1] == 0 and all(b < a for a, b in zip(stored, stored[1:])) and len(stored) <= 12  # every round holds less than the one before


def test_null_and_text_nodes(spark):
    df = spark.createDataFrame([("b", 1), ("a", 1), ("c", None), ("d", None), ("e", 9), (None, 5)], "sec string, slot int")
    got = {r.sec: r.component for r in components.connected_components(df, "sec", "slot").collect()}
    assert {k: got[k] for k in ("a", "b", "e", None)} == {"a": "a", "b": "a", "e": "e", None: None}
    assert components.connected_components(df.limit(0), "sec", "slot").collect() == []
