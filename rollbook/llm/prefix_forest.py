"""Approximate nearest neighbours by cosine with a forest of hash prefixes.

Each tree names every vector by a long string of bits, the sides of its own random planes on which the vector lies, and is no more than the array of these strings in order.

1. Equal vectors are one class: the forest holds a class once, and a class answers with its ``k + 1`` smallest ids.
2. The rows are dealt by hash to blocks of about ``VALUES`` components. A task keeps one block with the sorted arrays of all its trees.
3. Descent: the entries of a sorted array beside the place of a query's string share its longest prefixes, of another length in each tree.
4. Synchronous ascent: from the longest prefix on, all trees shorten it by the same bit; what shares it in any tree is a candidate. Whenever there are enough new candidates
   they are compared on the original vectors. It ends at the first length ``x`` at which a vector as near as the last of the best is missed by all trees with a probability
   of at most ``MISS``: ``(1 - p ** x) ** trees <= MISS``, where p is the share of planes that do not part two vectors of that angle. Close neighbours end it deep; vectors
   without structure end it near the root, as they must.
5. A query is searched in its own block first. Its best there bound the length for all other blocks, which it visits next. The best of all blocks are merged.

Cases: a vector that is null, empty, zero or holds a null or non-finite component, and a row with a null id, take no part; rows of equal id and vector count once; vectors
of one length only are compared; fewer than ``k`` candidates are all returned; equal scores go by the smaller id, null is never one; an empty table, or one without queries, gives an
empty table; only the two named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StructType
from pyspark.sql.window import Window

from .common import stored

TREES, BITS, MISS = 32, 62, 0.05
#: Components of a block, candidates of the first comparison, growth until the next, queries worked on at once, seed of the planes.
VALUES, FIRST, GROWTH, AT_ONCE, SEED = 1 << 22, 64, 4, 256, 7


def enough(score: np.ndarray, trees: int, bits: int, miss: float) -> np.ndarray:
    """The longest prefix at which all trees miss a vector of this cosine with a probability of at most ``miss``."""
    same = 1 - np.arccos(np.clip(score, -1, 1)) / np.pi
    with np.errstate(divide="ignore"):
        x = np.log1p(-(miss ** (1 / trees))) / np.log(np.clip(same, 0, 1 - 1e-12))
    return np.clip(np.floor(x), 0, bits).astype(np.int64)


class Forest:
    """The vectors of a block and the sorted strings of each tree."""

    def __init__(self, rows: np.ndarray, ids: np.ndarray, vectors: np.ndarray, trees: int, bits: int, miss: float):
        self.rows, self.ids, self.vectors, self.bits, self.miss = rows, ids, vectors, bits, miss
        self.planes = np.random.default_rng([SEED, vectors.shape[1]]).standard_normal((trees, vectors.shape[1], bits))
        self.norms = np.sqrt(np.einsum("ij,ij->i", vectors, vectors))
        codes = self.strings(vectors)
        self.order = np.argsort(codes, axis=1, kind="stable")
        self.codes = np.take_along_axis(codes, self.order, axis=1)

    def strings(self, vectors: np.ndarray) -> np.ndarray:
        weight = np.int64(1) << np.arange(self.bits - 1, -1, -1, dtype=np.int64)
        out = np.empty((len(self.planes), len(vectors)), dtype=np.int64)
        for t, planes in enumerate(self.planes):
            for s in range(0, len(vectors), 8192):
                out[t, s: s + 8192] = (vectors[s: s + 8192] @ planes > 0) @ weight
        return out

    def sharing(self, strings: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Where the entries that share a prefix of this length start and end, in each tree for each query."""
        step = np.int64(1) << np.int64(self.bits - length)
        low = strings // step * step
        return tuple(np.stack([np.searchsorted(c, s) for c, s in zip(self.codes, x, strict=True)]) for x in (low, low + step))

    def depth(self, strings: np.ndarray) -> np.ndarray:
        """The longest prefix that a query shares with any entry, over all trees."""
        best = np.zeros(strings.shape[1], dtype=np.int64)
        for c, s in zip(self.codes, strings, strict=True):
            at = np.searchsorted(c, s)
            for x in (np.maximum(at - 1, 0), np.minimum(at, len(c) - 1)):
                best = np.maximum(best, self.bits - np.frexp((c[x] ^ s).astype(np.float64))[1])
        return np.maximum(best, 0)

    def compare(self, vector: np.ndarray, low: np.ndarray, high: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``n`` nearest of the candidates and their cosines; equal ones by id."""
        found = np.zeros(len(self.rows), dtype=bool)
        for order, a, b in zip(self.order, low, high, strict=True):
            found[order[a:b]] = True
        at = np.flatnonzero(found)
        score = self.vectors[at] @ vector / (self.norms[at] * np.sqrt(vector @ vector))
        if len(at) > n:
            keep = score >= np.partition(score, len(at) - n)[len(at) - n]
            at, score = at[keep], score[keep]
        best = np.lexsort((self.ids[at], -score))[:n]
        return at[best], score[best]

    def search(self, vectors: np.ndarray, length: np.ndarray, n: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, int]]:
        """Number of the query, entries, cosines, and the length that would be enough. ``length``: the one to stop at, or -1 to find it."""
        strings = self.strings(vectors)
        deep = np.where(length < 0, self.depth(strings), length)
        need = np.full(len(vectors), FIRST)
        open_ = np.ones(len(vectors), dtype=bool)
        for x in range(int(deep.max(initial=-1)), -1, -1):
            now = np.flatnonzero(open_ & (deep >= x))
            if not len(now):
                continue
            low, high = self.sharing(strings[:, now], x)
            size = (high - low).sum(axis=0)
            for k in np.flatnonzero((size >= need[now]) | (length[now] == x) | (x == 0)):
                q = now[k]
                at, score = self.compare(vectors[q], low[:, k], high[:, k], n)
                stop = int(enough(score[-1:], len(strings), self.bits, self.miss)[0]) if len(at) == n else 0
                if length[q] >= 0 or stop >= x:
                    open_[q] = False
                    yield q, at, score, stop
                else:
                    need[q] = size[k] * GROWTH
                    if x - stop <= 2:
                        length[q] = stop  # close to the end: the next comparison is the last


def _visit(rows: DataFrame, n: int, trees: int, bits: int, miss: float) -> DataFrame:
    """``query, row, id, score, length`` of the ``n`` nearest of each query in each block it visits. ``rows``: dim, part, kind (0: entry, 1: query), row, id, vector, length."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held, forest = None, [], None
        for b in batches:
            dim, part, kind, row, ids, length = (b.column(c).to_numpy(zero_copy_only=False) for c in ("dim", "part", "kind", "row", "id", "length"))
            edges = np.flatnonzero(np.diff(dim) | np.diff(part) | np.diff(kind)) + 1
            for a, e in zip([0, *edges], [*edges, len(b)], strict=True):
                if a == e:
                    continue
                if block != (dim[a], part[a]):
                    block, held, forest = (dim[a], part[a]), [], None
                vectors = b.column("vector").slice(a, e - a).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(e - a, dim[a])
                if kind[a] == 0:
                    held.append((row[a:e], ids[a:e], vectors))
                    continue
                if forest is None:
                    forest, held = Forest(*map(np.concatenate, zip(*held, strict=True)), trees, bits, miss), []
                for s in range(a, e, AT_ONCE):
                    t = min(s + AT_ONCE, e)
                    found = list(forest.search(vectors[s - a: t - a], length[s:t].astype(np.int64), n))
                    size = [len(x[1]) for x in found]
                    at, score = (np.concatenate([x[i] for x in found]) for i in (1, 2))
                    yield pa.RecordBatch.from_arrays([pa.array(np.repeat(row[s:t][[x[0] for x in found]], size)), pa.array(forest.rows[at]), pa.array(forest.ids[at]), pa.array(score),
                                                      pa.array(np.repeat([x[3] for x in found], size).astype(np.int32))], ["query", "row", "id", "score", "length"])

    kind = StructType().add("query", LongType()).add("row", LongType()).add("id", LongType()).add("score", DoubleType()).add("length", IntegerType())
    return rows.repartition("dim", "part").sortWithinPartitions("dim", "part", "kind").mapInArrow(run, kind)


def _blocks(values: int, cores: int) -> int:
    """Blocks of at most ``VALUES`` components; one for each core as long as that leaves them an eighth of it."""
    return max(-(-values // VALUES), min(cores, -(-values // max(1, VALUES // 8))))


def _first(n: int, *keys: str):
    """Rows of the first ``n`` places; Spark drops the others before it shuffles, so a hot key is no hot task."""
    return lambda df, *order: df.withColumn("_nth", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col("_nth") <= n)


def usable(vector: Column) -> Column:
    """Whether a vector has a direction: finite numbers only, one of them not zero."""
    x = vector.cast("array<double>")
    return F.coalesce(F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists(x, lambda v: v != 0), F.lit(False))


def nearest(vectors: DataFrame, query: Column, k: int = 5, row_id: str = "vec_id", vector: str = "embedding", trees: int = TREES, bits: int = BITS, miss: float = MISS) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the ``k`` nearest others of every row that ``query`` marks."""
    rows = vectors.select(F.col(row_id).cast("bigint").alias("id"), F.col(vector).alias("vector"), F.coalesce(query, F.lit(False)).alias("asks")).filter(F.col("id").isNotNull() & usable(F.col("vector")))
    same = (F.xxhash64("vector"), F.xxhash64(F.lit(1), "vector"))  # equal if both agree
    rows = rows.select("id", "asks", "vector", same[0].alias("h1"), same[1].alias("h2"))
    classes = rows.groupBy("h1", "h2").agg(F.first("vector").alias("vector"), F.min("id").alias("id"), F.max("asks").alias("asks"))
    classes = stored(classes.withColumn("row", F.monotonically_increasing_id()).withColumn("dim", F.size("vector")))
    blocks = {r.dim: _blocks(r.dim * r["count"], vectors.sparkSession.sparkContext.defaultParallelism) for r in classes.groupBy("dim").count().collect()}  # a row for each length of vectors
    n_blocks = F.create_map(*[F.lit(x) for d, n in blocks.items() for x in (d, n)])[F.col("dim")] if blocks else F.lit(1)
    entries = classes.withColumn("part", F.pmod(F.xxhash64("row"), n_blocks))
    names = _first(k + 1, "h1", "h2")(rows.select("h1", "h2", "id").distinct(), "id").join(classes.select("h1", "h2", "row"), ["h1", "h2"]).select("row", F.col("id").alias("name"))

    shown = lambda df, kind, length: df.select("dim", "part", F.lit(kind).alias("kind"), "row", "id", "vector", length.cast("int").alias("length"))
    held, asking = shown(entries, 0, F.lit(-1)), entries.filter("asks")
    home = stored(_visit(held.unionByName(shown(asking, 1, F.lit(-1))), k + 1, trees, bits, miss))
    bound = home.groupBy(F.col("query").alias("row")).agg(F.min("length").alias("stop"))
    away = asking.join(bound, "row").withColumn("home", F.col("part")).withColumn("part", F.explode(F.sequence(F.lit(0).cast("bigint"), n_blocks - F.lit(1).cast("bigint")))).filter("part != home")
    found = home.unionByName(_visit(held.unionByName(shown(away, 1, F.col("stop"))), k + 1, trees, bits, miss))
    best = _first(k + 1, "query")(found, F.desc("score"), "id").select("query", "row", "score")
    named = _first(k + 1, "query")(best.join(names, "row").select("query", "name", "score"), F.desc("score"), "name")
    answers = named.groupBy("query").agg(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("minus"), "name", "score"))).alias("found"))  # k + 1 of each
    asked = rows.filter("asks").select("h1", "h2", F.col("id").alias("query_id")).distinct().join(classes.select("h1", "h2", F.col("row").alias("query")), ["h1", "h2"])
    others = F.slice(F.filter("found", lambda x: x["name"] != F.col("query_id")), 1, k)
    out = asked.join(answers, "query").select("query_id", F.posexplode(others).alias("place", "x"))
    return out.select("query_id", (F.col("place") + 1).alias("rank"), F.col("x.name").alias("vec_id"), "x.score")
