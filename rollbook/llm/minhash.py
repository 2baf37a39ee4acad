"""Near-duplicates by an inverted join of MinHash signature coordinates.

1. Every text becomes a set of word shingles, a signature of ``K`` coordinates and a fingerprint of the set. Documents of one
   fingerprint are one class; from here on only one row per class is used, so thousands of exact copies cost one.
2. Each coordinate and its value is a posting key. A pair at the wanted similarity shares at least ``MATCHES`` keys but for about three pairs in a
   million that lie exactly on the limit. Keys are ordered by how many classes post them, rarest first (one order for all), so such a pair must
   share one of the first ``K - MATCHES + 1`` keys of both (prefix merging): only these are posted, and frequent keys, such as those of
   a passage that many texts hold, stay out of the lists (skip merging) unless a text has little else.
3. In lists of up to ``SHORT`` classes, matching coordinates are counted for the pairs inside the task; pairs at or over ``MATCHES`` are confirmed on full sets.
4. Longer lists (groups of near copies) are cut into blocks, and each pair of blocks is compared on full sets inside a task, which gives back
   only a spanning forest of the true links: never more rows than members.
5. Connected components over the confirmed links.

Cases: a null text or one without words has an empty set and is linked with nothing; rows that share an id count as one document; a row
with a null id is not linked, has a null component and is kept; an empty table gives an empty table; only the named columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.window import Window

from .common import Powers, mix64, shingle_hashes, small_batches, stored, word_hashes
from .components import components

K, MATCHES, SHINGLE, SIMILARITY = 64, 40, 5, 85
#: Longest list that is compared by signatures; classes of a block of a longer one.
SHORT, BLOCK = 64, 512
#: Keys with at least this many classes have their count in the common order; a fixed bound on how many such counts are sent to the tasks (the rest count as rare).
FREQUENT, FREQUENT_KEYS = 16, 1_000_000
COLUMNS_AT_ONCE = 8192

_A = np.random.default_rng(20240229).integers(1, 2**63, K, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SALT = mix64(np.arange(1, K + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def shingle_set(text: str | None, powers: Powers) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of a text."""
    return shingle_hashes(word_hashes(text, powers), SHINGLE)


def signature(shingles: np.ndarray) -> np.ndarray:
    """The keys of a set: for each coordinate, the smallest permuted hash, mixed with the coordinate's number."""
    low = np.full(K, np.iinfo(np.uint64).max, dtype=np.uint64)
    for i in range(0, len(shingles), 4096):
        low = np.minimum(low, (shingles[i: i + 4096, None] * _A[None, :]).min(axis=0))
    return mix64(low ^ _SALT)


def describe(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``id, n, print, keys``: set size, fingerprint of the set and its signature, of every row."""
    @pandas_udf("n long, print binary, keys binary")
    def described(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        powers = Powers()
        for b in batches:
            rows = []
            for t in b:
                s = shingle_set(t, powers)
                rows.append((len(s), hashlib.blake2b(s.tobytes(), digest_size=16).digest(), signature(s).tobytes() if len(s) else b""))
            yield pd.DataFrame(rows, columns=["n", "print", "keys"])

    return docs.select(F.col(doc_id).alias("id"), described(F.col(text)).alias("d")).select("id", "d.*")


def _keys(column) -> np.ndarray:
    return np.frombuffer(b"".join(x.as_py() for x in column), dtype=np.uint64).reshape(-1, K)


def _frequent(classes: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent keys and their numbers of classes, counted over all classes; at most ``FREQUENT_KEYS``."""
    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array(_keys(b.column("keys")).ravel().view(np.int64))], ["key"])

    counts = classes.select("keys").mapInArrow(keys, "key long").groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= FREQUENT)
    counts = stored(counts)
    level, low, total = F.floor(F.log2("n") * 8), float("inf"), 0
    for r in sorted(counts.groupBy(level.alias("level")).count().collect(), reverse=True):  # a few hundred levels
        if total + r["count"] > FREQUENT_KEYS:
            break
        low, total = r["level"], total + r["count"]
    got = counts.filter(level >= low).toArrow()
    key, n = got["key"].to_numpy().astype(np.int64).view(np.uint64), got["n"].to_numpy().astype(np.int64)
    order = np.argsort(key)
    return key[order], n[order]


def postings(classes: DataFrame) -> DataFrame:
    """``key, rep, n``: every class under the first ``K - MATCHES + 1`` of its keys in the common order."""
    shared = classes.sparkSession.sparkContext.broadcast(_frequent(classes))  # at most FREQUENT_KEYS pairs of numbers

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, count = shared.value
        for b in batches:
            keys = _keys(b.column("keys"))
            n = np.zeros(keys.shape, dtype=np.int64)
            if len(key):
                at = np.minimum(np.searchsorted(key, keys), len(key) - 1)
                n = np.where(key[at] == keys, count[at], 0)
            order = np.lexsort((keys, n), axis=1)[:, : K - MATCHES + 1]
            width = order.shape[1]
            yield pa.RecordBatch.from_arrays([pa.array(np.take_along_axis(keys, order, axis=1).ravel().view(np.int64)),
                                              pa.array(np.repeat(b.column("rep").to_numpy(zero_copy_only=False), width)), pa.array(np.repeat(b.column("n").to_numpy(), width))], ["key", "rep", "n"])

    return classes.select("rep", "n", "keys").mapInArrow(post, f"key long, rep {dict(classes.dtypes)['rep']}, n long")


def _linked(inter, n_a, n_b, similarity: int):
    return 100 * inter >= similarity * (n_a + n_b - inter)


def short_pairs(members: DataFrame, similarity: int) -> DataFrame:
    """Pairs ``a, b`` of the short lists with ``MATCHES`` or more equal coordinates. ``members``: key, rep, n, short (16 bits of each coordinate).

    Lists are read from sorted partitions one after another; those of one length are compared together."""
    kind = dict(members.dtypes)["rep"]

    def compare(key, rep, n, sig):
        edge = np.flatnonzero(np.diff(key)) + 1
        start, size = np.concatenate(([0], edge)), np.diff(np.concatenate(([0], edge, [len(key)])))
        for c in np.unique(size[size > 1]):
            i, j = np.triu_indices(c, 1)
            s = start[size == c]
            step = max(1, 200_000 // len(i))
            for k in range(0, len(s), step):
                a, b = (s[k: k + step, None] + i).ravel(), (s[k: k + step, None] + j).ravel()
                ok = np.flatnonzero(100 * np.minimum(n[a], n[b]) >= similarity * np.maximum(n[a], n[b]))
                a, b = a[ok], b[ok]
                ok = (sig[a] == sig[b]).sum(axis=1) >= MATCHES
                yield np.minimum(rep[a[ok]], rep[b[ok]]), np.maximum(rep[a[ok]], rep[b[ok]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for b in batches:
            now = (b.column("key").to_numpy(), b.column("rep").to_numpy(), b.column("n").to_numpy(), np.frombuffer(b"".join(x.as_py() for x in b.column("short")), dtype=np.uint16).reshape(-1, K))
            now = now if held is None else tuple(np.concatenate(x) for x in zip(held, now, strict=True))
            cut = int(np.searchsorted(now[0], now[0][-1])) if len(now[0]) else 0  # the last list may go on in the next batch
            held = tuple(x[cut:] for x in now)
            for x, y in compare(*[x[:cut] for x in now]) if cut else ():
                yield pa.RecordBatch.from_arrays([pa.array(x), pa.array(y)], ["a", "b"])
        if held is not None:
            for x, y in compare(*held):
                yield pa.RecordBatch.from_arrays([pa.array(x), pa.array(y)], ["a", "b"])

    return members.repartition("key").sortWithinPartitions("key").mapInArrow(run, f"a {kind}, b {kind}").distinct()


def long_links(members: DataFrame, similarity: int) -> DataFrame:
    """A spanning forest of the true links of each pair of blocks. ``members``: key, block, blocks, rep, set."""
    kind = dict(members.dtypes)["rep"]
    each = members.select("key", "block", "rep", "set", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    each = each.select("key", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "block", "rep", "set")

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("rep", kind="stable")
        sets = [np.frombuffer(s, dtype=np.uint64) for s in group["set"]]
        rep, block, size = group["rep"].to_numpy(), group["block"].to_numpy(), np.array([len(s) for s in sets])
        row = np.repeat(np.arange(len(sets)), size)
        _, col, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        number = np.cumsum(count > 1) - 1  # a shingle of one member is in no intersection
        shared = count[col] > 1
        row, col = row[shared], number[col[shared]]
        inter = np.zeros((len(sets), len(sets)), dtype=np.float64)
        order = np.argsort(col, kind="stable")
        row, col = row[order], col[order]
        for c in range(0, int((count > 1).sum()), COLUMNS_AT_ONCE):
            lo, hi = np.searchsorted(col, [c, c + COLUMNS_AT_ONCE])
            m = np.zeros((len(sets), COLUMNS_AT_ONCE), dtype=np.float32)
            m[row[lo:hi], col[lo:hi] - c] = 1
            inter += m @ m.T
        ok = _linked(inter, size[:, None], size[None, :], similarity)
        if len(set(block)) > 1:
            ok &= block[:, None] != block[None, :]
        root = list(range(len(sets)))

        def find(x: int) -> int:
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        out = []
        for i, j in zip(*np.nonzero(np.triu(ok, 1)), strict=True):
            a, b = find(int(i)), find(int(j))
            if a != b:
                root[max(a, b)] = min(a, b)
                out.append((rep[i], rep[j]))
        return pd.DataFrame(out, columns=["a", "b"])

    return each.groupBy("key", "lo", "hi").applyInPandas(compare, f"a {kind}, b {kind}")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", similarity: int = SIMILARITY) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every row. Linked: 100 x intersection >= similarity x union of the shingle sets."""
    small_batches(docs)
    rows = stored(describe(docs, doc_id, text))
    some = rows.filter("n > 0 and id is not null")
    classes = stored(some.groupBy("print", "n", "keys").agg(F.min("id").alias("rep")))
    key = Window.partitionBy("key")
    members = postings(classes).withColumn("c", F.count(F.lit(1)).over(key)).filter("c > 1")
    members = stored(members.withColumn("at", F.row_number().over(key.orderBy("rep")) - 1))

    @pandas_udf("binary")
    def low_bits(keys: pd.Series) -> pd.Series:
        return keys.map(lambda k: np.frombuffer(k, dtype=np.uint64).astype(np.uint16).tobytes())

    short = members.filter(F.col("c") <= SHORT).select("key", "rep", "n")
    pairs = stored(short_pairs(short.join(classes.select("rep", low_bits("keys").alias("short")), "rep"), similarity))
    long = members.filter(F.col("c") > SHORT).select("key", "rep", F.floor(F.col("at") / BLOCK).cast("int").alias("block"), F.ceil(F.col("c") / BLOCK).cast("int").alias("blocks"))

    @pandas_udf("binary")
    def full_set(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        powers = Powers()
        for b in batches:
            yield pd.Series([shingle_set(t, powers).tobytes() for t in b])

    need = pairs.select(F.explode(F.array("a", "b")).alias("rep")).unionByName(long.select("rep")).distinct()
    texts = docs.select(F.col(doc_id).alias("rep"), F.col(text).alias("_text"))
    sets = stored(texts.join(need, "rep", "left_semi").select("rep", full_set("_text").alias("set")))

    @pandas_udf("boolean")
    def confirmed(a: pd.Series, b: pd.Series) -> pd.Series:
        def one(x, y):
            x, y = np.frombuffer(x, dtype=np.uint64), np.frombuffer(y, dtype=np.uint64)
            return bool(_linked(len(np.intersect1d(x, y, assume_unique=True)), len(x), len(y), similarity))
        return pd.Series([one(x, y) for x, y in zip(a, b, strict=True)], dtype=bool)

    a, b = (sets.select(F.col("rep").alias(c), F.col("set").alias(f"set_{c}")) for c in "ab")
    links = pairs.join(a, "a").join(b, "b").filter(confirmed("set_a", "set_b")).select("a", "b")
    links = links.unionByName(long_links(long.join(sets, "rep"), similarity))
    labels = components(links)
    named = classes.select("print", "rep").join(labels.withColumnRenamed("node", "rep"), "rep", "left").select("print", F.coalesce("component", "rep").alias("component"))
    named = named.groupBy("print").agg(F.min("component").alias("component"))
    found = some.select("id", "n", "print").join(named, "print").select("id", "n", "component")
    rest = rows.filter("n = 0 or id is null").select("id", "n", F.col("id").alias("component"))
    return found.unionByName(rest).select(F.col("id").alias(doc_id), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"),
                                          F.coalesce(F.col("id") == F.col("component"), F.lit(True)).alias("kept"))
