"""Helpers that several operators share: word cutting, hashing and bit fields in numpy, stored tables, prefix sums."""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.tables import cut_lineage

#: Words are runs of anything but space and the five ASCII control blanks.
WORD = re.compile(r"[^\x20\x09-\x0D]+")
A_Z = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def stored(df: DataFrame, compression: str | None = None, level: int | None = None) -> DataFrame:
    """Write to the shared folder of ``spark.checkpoint.dir`` and read back."""
    return cut_lineage(df, compression, level)


def small_batches(df: DataFrame, rows: int = 1000) -> None:
    """Texts are large rows: batches between Spark and Python hold at most ``rows`` of them from now on in this session. Results do not depend on it."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(df.sparkSession.conf.get(name)) > rows:
        df.sparkSession.conf.set(name, str(rows))


def lower_ascii(text: Column) -> Column:
    return F.translate(text, A_Z, A_Z.lower())


def mix64(x: np.ndarray) -> np.ndarray:
    """Spread all bits of 64-bit values (the finaliser of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    p = np.full(n, base, dtype=np.uint64)
    if n:
        p[0] = 1
    return np.cumprod(p, dtype=np.uint64)


class Powers:
    """Powers of the hash base and of its inverse, grown when a longer text comes."""

    def __init__(self):
        self.up, self.down = _powers(_BASE, 0), _powers(_BASE_INV, 0)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 1 << 16)
            self.up, self.down = _powers(_BASE, size), _powers(_BASE_INV, size)
        return self.up[:n], self.down[:n]


def hash_runs(raw: np.ndarray, apart: np.ndarray, powers: Powers) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of each run of bytes that ``apart`` (a table of 256 flags) does not set apart, in order, and where it starts. No loop over runs."""
    edge = np.flatnonzero(np.diff(np.concatenate(([True], apart[raw], [True])).view(np.int8)))
    start, end = edge[::2], edge[1::2]
    if not len(start):
        return np.empty(0, dtype=np.uint64), start
    up, down = powers.get(len(raw) + 1)
    sums = np.zeros(len(raw) + 1, dtype=np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[: len(raw)], out=sums[1:])
    return mix64((sums[end] - sums[start]) * down[start]), start


def word_hashes(text: str | None, powers: Powers, lower: bool = True) -> np.ndarray:
    """A 64-bit hash of each word of ``text``, in order. Works on the UTF-8 bytes."""
    raw = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), dtype=np.uint8)
    return hash_runs(_LOWER[raw] if lower else raw, _BLANK, powers)[0]


def shingle_hashes(words: np.ndarray, size: int = 5) -> np.ndarray:
    """Sorted distinct hashes of all runs of ``size`` words; the whole sequence as one when it is shorter."""
    if not len(words):
        return words
    n = max(1, len(words) - size + 1)
    h = np.zeros(n, dtype=np.uint64)
    for i in range(min(size, len(words))):
        h = (h ^ words[i: i + n]) * np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(29)
    return np.unique(mix64(h))


def running_sums(lengths: Column, chunk: int = 128) -> Column:
    """Sums of all earlier entries of an integer array, for each entry. The array is taken in chunks, so the work is not quadratic in its size."""
    n = F.size(lengths)
    chunks = F.when(n > 0, F.transform(F.sequence(F.lit(0), F.floor((n - 1) / chunk).cast("int")), lambda i: F.slice(lengths, i * chunk + 1, chunk))).otherwise(
        F.array().cast("array<array<bigint>>"))
    none = F.array().cast("array<bigint>")

    def inside(c: Column) -> Column:
        return F.aggregate(c, F.struct(none.alias("a"), F.lit(0).cast("bigint").alias("s")),
                           lambda z, x: F.struct(F.concat(z["a"], F.array(z["s"])).alias("a"), (z["s"] + x.cast("bigint")).alias("s")))

    total = F.aggregate(F.transform(chunks, inside), F.struct(F.array().cast("array<array<bigint>>").alias("a"), F.lit(0).cast("bigint").alias("s")),
                        lambda z, c: F.struct(F.concat(z["a"], F.array(F.transform(c["a"], lambda x: x + z["s"]))).alias("a"), (z["s"] + c["s"]).alias("s")))
    return F.flatten(total["a"])


def let(value: Column, body) -> Column:
    """``body(value)`` with the value worked out once, also inside lambdas."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def match_spans(text: Column, pattern: Column) -> Column:
    """All leftmost, non-overlapping matches of a pattern that matches no empty text: array<struct<start, end, hit>>, in code points."""
    def spans(hits: Column, gaps: Column) -> Column:
        lengths = F.zip_with(gaps, hits, lambda g, h: F.length(g).cast("bigint") + F.coalesce(F.length(h), F.lit(0)))
        starts = let(lengths, lambda x: running_sums(x))
        return F.zip_with(F.zip_with(F.slice(starts, 1, F.size(hits)), F.slice(gaps, 1, F.size(hits)), lambda s, g: s + F.length(g)), hits,
                          lambda s, h: F.struct(s.alias("start"), (s + F.length(h)).alias("end"), h.alias("hit")))

    return let(F.regexp_extract_all(text, pattern, F.lit(0)), lambda hits: let(F.split(text, pattern, -1), lambda gaps: spans(hits, gaps)))
