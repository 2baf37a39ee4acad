"""Periodic runs against a plain search of every period, and on awkward input."""

from __future__ import annotations

import hashlib
import random
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from rollbook.llm import periodic_runs, queries

DIR = "/root/testdata/sf0.001"


def plain_runs(w: list, shortest: int = 24, times: int = 3) -> list[tuple[int, int, int]]:
    found: dict[tuple[int, int], int] = {}
    for q in range(1, len(w) // times + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j > i and j + q - i >= max(shortest, times * q):
                found.setdefault((i, j + q - i), q)  # the smallest period comes first
            i = max(j, i + 1)
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 3), min_size=1, max_size=14), st.integers(1, 60)), max_size=8), st.sampled_from([(24, 3), (12, 3), (8, 2), (6, 2)]))
def test_runs_match_brute_force(parts, limits):
    words = [b"%d" % unit[k % len(unit)] for unit, n in parts for k in range(n)]
    assert periodic_runs.runs_of(words, *limits) == plain_runs(words, *limits)


def test_squares_are_primitive_and_all_found():
    r = random.Random(3)
    for _ in range(200):
        w = [r.randrange(2) for _ in range(60)]
        got = {(d, i) for d, a, b in periodic_runs.squares(w) for i in range(a, b + 1)}
        root = lambda u: all(u != u[:k] * (len(u) // k) for k in range(1, len(u)) if len(u) % k == 0)
        want = {(d, i) for i in range(60) for d in range(1, 31) if i + 1 >= 2 * d and w[i + 1 - d: i + 1] == w[i + 1 - 2 * d: i + 1 - d] and root(w[i + 1 - d: i + 1])}
        assert got == want


def test_long_periodic_text_is_one_run():
    assert periodic_runs.runs_of([b"w%d" % (k % 5) for k in range(50_000)]) == [(0, 50_000, 5)]
    assert periodic_runs.runs_of([b"w%d" % (k % 9_001) for k in range(30_000)]) == [(0, 30_000, 9_001)]
    assert periodic_runs.runs_of([b"w%d" % k for k in range(30_000)]) == []


def test_stretches_hold_every_run():
    w = [b"a", *[b"%d" % (k % 8) for k in range(24)], b"b", *[b"x%d" % k for k in range(50)]]
    assert periodic_runs.runs_of(w) == [(1, 24, 8)] and periodic_runs.runs_of(w[:-51][:-1]) == []


def test_collapsed_words_and_odd_rows(spark):
    loop = " ".join(["ta", "re", "mi"] * 9)
    texts = [None, "", " \n\t ", "one", loop, "a  b\n" + loop + " z é", loop, "\x00 naïve 😀", "x" * 5000, " ".join(f"w{k}" for k in range(20_000))]
    docs = spark.createDataFrame([(i, t, "r", "c", 1) for i, t in enumerate(texts)] + [(None, loop, None, None, None), (4, loop, None, None, None)], "doc_id bigint, text string, start string, period string, words int")
    got = periodic_runs.find_runs(docs, keep=("doc_id", "start")).collect()
    assert len(got) == len(texts) + 2
    by = {r.doc_id: r for r in got}
    assert [(by[i].n_words, by[i].runs, by[i].collapsed) for i in range(3)] == [(0, [], "")] * 3
    assert [tuple(x) for x in by[4].runs] == [(0, 27, 3)] and by[4].collapsed == "ta re mi" and by[None].collapsed == "ta re mi"
    assert [tuple(x) for x in by[5].runs] == [(2, 27, 3)] and by[5].collapsed == "a b ta re mi z é" and by[5].start == "r"
    assert by[7].collapsed == texts[7] and by[8].n_words == 1 and by[9].n_words == 20_000 and by[9].collapsed == texts[9]
    assert periodic_runs.find_runs(docs.limit(0)).collect() == []


def planted(doc_id: int, words: list[bytes]) -> list[bytes]:
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    g = h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


@pytest.mark.parametrize("folder", [DIR])
def test_query_matches_brute_force(spark, folder):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()}
    sha = lambda b: hashlib.sha256(b).hexdigest()
    n = 0
    for r in queries.op13_periodic_runs(spark, folder).collect():
        words = planted(r.doc_id, (texts[r.doc_id] or "").encode().split())
        runs = plain_runs(words)
        drop = {k for s, m, q in runs for k in range(s + q, s + m)}
        best = min(runs, key=lambda x: (-x[1] / x[2], x[0], x[2]), default=None)
        assert (r.n_runs, r.runs_sha256) == (len(runs), sha("".join(f"{s},{m},{q}\n" for s, m, q in runs).encode()))
        assert r.collapsed_sha256 == sha(b" ".join(w for k, w in enumerate(words) if k not in drop))
        assert (r.start, r.length, r.period, r.exponent_milli) == ((*best, 1000 * best[1] // best[2]) if best else (None,) * 4)
        n += bool(runs)
    assert n > 5 and len(texts) == queries.op13_periodic_runs(spark, folder).filter(F.col("runs_sha256").isNotNull()).count()
