"""Exact removal of repeated byte strings, by a prefix-free parse of the corpus.

A byte goes if it is covered by a string of ``LENGTH`` bytes that also starts earlier in the corpus (smaller id, or the same text at a smaller offset).

1. Parse. In every string of ``LENGTH`` bytes, the gram with the smallest rolling hash is the trigger. Strings next to each other that share a trigger
   form a phrase; its context is all their bytes. Trigger and phrase depend on the string alone, so equal strings fall into phrases cut alike.
2. Dictionary. Equal contexts are one entry, known by its first occurrence; every later occurrence is a repeat as a whole, and is
   settled here. That is most of a highly repetitive corpus.
3. Entries that share at least ``HALF`` bytes at their trigger with another entry (to its right, or to its left and over it) may share single strings. Only
   their contexts are read again, and dealt out by the shared bytes.
4. Each task builds the suffix array of its part of the dictionary, to the depth of ``LENGTH``: all suffixes that start a string are sorted, and the parse gives each
   the place of its entry's first occurrence. Neighbours in that order with a common prefix of ``LENGTH`` are equal strings; all but the earliest are repeats.
   Entries of a shared key over ``HOT`` entries are dealt out by the string itself instead, so no task holds a large group.
5. Spans are joined to the texts.

Two different contexts count as equal only if two independent 64-bit hashes agree; strings in step 4 are compared byte by byte.

Cases: a null text is empty; texts under ``LENGTH`` bytes lose nothing; rows that share an id count as one text (equal rows keep the same bytes); a row
with a null id is not searched and keeps all bytes; texts of up to 2 ** 30 bytes; an empty table gives an empty table; only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, BooleanType, LongType, StructType
from pyspark.sql.window import Window

from .common import Powers, mix64, small_batches, stored

#: Length of the strings that count as repeats, of the rolling-hash window, and of the contexts that candidates must share.
LENGTH, GRAM, HALF = 100, 12, 50
#: Entries of one shared key that a task sorts; texts of a batch of the parse.
HOT, PHRASES_AT_ONCE = 4096, 200_000
_AT = np.uint64(2**30 - 1)


class Text:
    """Rolling hashes of one text: ``hash(start, end)`` of any of its byte strings, from sums of the bytes times powers of the base."""

    def __init__(self, raw: np.ndarray, powers: Powers):
        self.up, self.down = powers.get(len(raw) + 1)
        self.sums = np.zeros(len(raw) + 1, dtype=np.uint64)
        np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * self.up[: len(raw)], out=self.sums[1:])

    def hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix64((self.sums[end] - self.sums[start]) * self.down[start])


def triggers(raw: np.ndarray, text: Text, length: int = LENGTH, gram: int = GRAM) -> np.ndarray:
    """For every string of ``length`` bytes, where the smallest rolling hash of its grams stands (the leftmost of equals). It depends on that string alone and never moves back."""
    n, wide = len(raw) - gram + 1, length - gram + 1
    at = np.arange(n)
    value = (text.hash(at, at + gram) & ~_AT) | at.astype(np.uint64)
    blocks = np.full(-(-n // wide) * wide, np.iinfo(np.uint64).max, dtype=np.uint64)
    blocks[:n] = value
    blocks = blocks.reshape(-1, wide)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return (np.minimum(behind[: n - wide + 1], ahead[wide - 1: n]) & _AT).astype(np.int64)


def phrases(raw: np.ndarray, text: Text, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The parse: ``trigger, first, last`` of each phrase; the strings of ``length`` bytes that start at ``first`` to ``last`` share the trigger."""
    if len(raw) < length:
        none = np.empty(0, dtype=np.int64)
        return none, none, none
    t = triggers(raw, text, length, gram)
    first = np.concatenate(([0], np.flatnonzero(np.diff(t)) + 1))
    return t[first], first, np.append(first[1:] - 1, len(t) - 1)


def _pack(t, first, last):
    return (first << 14) | ((last - first) << 7) | (t - first)


def _unpack(pack):
    first = pack >> 14
    return first + (pack & 127), first, first + ((pack >> 7) & 127)


def parse(texts: DataFrame) -> DataFrame:
    """``key, context, id, place, left, settled`` for every phrase of ``id, raw``: the hash of the shared bytes to deal by, of the context, the packed place, of the
    bytes left of the trigger (null if no string needs them), and whether the context stands earlier in the same batch of texts.

    Such repeats are settled before the shuffle: they get a key of their own, so a context that fills a third of a corpus meets as one row a batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, held, n = Powers(), [], 0

        def out():
            ids = pa.concat_arrays([x[0] for x in held])
            key, context, place, left, has_left = (np.concatenate([x[i] for x in held]) for i in range(1, 6))
            _, rank = np.unique(ids.to_numpy(zero_copy_only=False), return_inverse=True)
            order = np.lexsort((place, rank, context, key))
            new = np.concatenate(([True], (np.diff(key[order]) != 0) | (np.diff(context[order]) != 0)))
            head = order[np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))]
            settled = np.zeros(len(key), dtype=bool)
            settled[order] = (rank[order] != rank[head]) | (place[order] != place[head])
            key = np.where(settled, mix64(context + mix64(place.astype(np.uint64) ^ (rank.astype(np.uint64) << np.uint64(40)))), key)
            return pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(context.view(np.int64)), ids, pa.array(place), pa.array(left.view(np.int64), mask=~has_left | settled), pa.array(settled)],
                                              ["key", "context", "id", "place", "left", "settled"])

        for b in batches:
            for i, raw in enumerate(b.column("raw")):
                raw = np.frombuffer(raw.as_py() or b"", dtype=np.uint8)
                if len(raw) < LENGTH:
                    continue
                text = Text(raw, powers)
                t, first, last = phrases(raw, text)
                right, left = t - last <= HALF, t - first > HALF
                left_hash = mix64(text.hash(np.maximum(t - HALF, 0), t + GRAM) + np.uint64(1))
                key = np.where(right, text.hash(t, np.minimum(t + HALF, len(raw))), left_hash)
                context = mix64(text.hash(first, last + LENGTH) ^ (((t - first) << 8) | (last - first)).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
                held.append((pa.repeat(b.column("id")[i], len(t)), key, context, _pack(t, first, last), left_hash, left))
                n += len(t)
                if n >= PHRASES_AT_ONCE:
                    yield out()
                    held, n = [], 0
        if held:
            yield out()

    return texts.mapInArrow(run, StructType().add("key", LongType()).add("context", LongType()).add("id", texts.schema["id"].dataType).add("place", LongType()).add("left", LongType()).add("settled", BooleanType()))


def contexts(texts: DataFrame) -> DataFrame:
    """``key, n, id, start, bytes`` of the candidate entries of each text. ``texts``: id, packed, wanted (array of key, n, place, side)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_ = zstandard.ZstdDecompressor()
        for b in batches:
            rows = []
            for i in range(len(b)):
                raw = open_.decompress(b.column("packed")[i].as_py())
                for w in b.column("wanted")[i].as_py():
                    t, first, last = _unpack(w["place"])
                    first, last = (max(first, t - HALF), last) if w["side"] == 0 else (first, min(last, t - HALF - 1))
                    if last >= first and last + LENGTH <= len(raw):
                        rows.append((w["key"], w["n"], i, first, raw[first: last + LENGTH]))
            if rows:
                key, n, i, start, data = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(key, pa.int64()), pa.array(n, pa.int64()), b.column("id").take(pa.array(i, pa.int64())), pa.array(start, pa.int64()), pa.array(data, pa.binary())],
                                                 ["key", "n", "id", "start", "bytes"])

    return texts.mapInArrow(run, StructType().add("key", LongType()).add("n", LongType()).add("id", texts.schema["id"].dataType).add("start", LongType()).add("bytes", BinaryType()))


def _repeats(ids: np.ndarray, start: np.ndarray, data: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, start and end of the repeated strings of a part of the dictionary, from its suffix array; runs of starts in one entry are one span."""
    size = np.array([len(x) for x in data])
    raw, count = np.frombuffer(b"".join(data), dtype=np.uint8), size - LENGTH + 1
    entry = np.repeat(np.arange(len(data)), count)
    inside = np.arange(len(entry)) - np.repeat(np.cumsum(count) - count, count)
    suffix = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(raw, LENGTH)[(np.cumsum(size) - size)[entry] + inside]).view(f"S{LENGTH}").ravel()
    _, rank = np.unique(ids, return_inverse=True)
    place = start[entry] + inside
    order = np.lexsort((place, rank[entry]))
    order = order[np.argsort(suffix[order], kind="stable")]
    s, r, p = suffix[order], rank[entry][order], place[order]
    new = np.concatenate(([True], s[1:] != s[:-1]))
    head = np.maximum.accumulate(np.where(new, np.arange(len(s)), 0))
    again = np.sort(order[(r != r[head]) | (p != p[head])])  # not the earliest place of its string
    if not len(again):
        return again, again, again
    cut = np.flatnonzero((np.diff(again) != 1) | (np.diff(entry[again]) != 0))
    lo, hi = again[np.concatenate(([0], cut + 1))], again[np.append(cut, len(again) - 1)]
    return entry[lo], place[lo], place[hi] + LENGTH


def repeated_suffixes(entries: DataFrame) -> DataFrame:
    """``id, start, end`` of the repeats among dictionary entries ``key, n, id, start, bytes``."""
    kind = entries.schema["id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for b in batches:
            t = pa.Table.from_batches([b] if held is None else [held, b]).combine_chunks()
            key = t["key"].to_numpy()
            cut = int(np.searchsorted(key, key[-1])) if len(key) else 0  # the last key may go on in the next batch
            if cut:
                yield from found(t.slice(0, cut))
            rest = t.slice(cut).combine_chunks().to_batches()
            held = rest[0] if rest else None
        if held is not None and len(held):
            yield from found(pa.Table.from_batches([held]))

    def found(t: pa.Table):
        row, start, end = _repeats(t["id"].to_numpy(), t["start"].to_numpy(), t["bytes"].to_pylist())
        if len(row):
            ids = t["id"].combine_chunks().take(pa.array(row))
            yield pa.RecordBatch.from_arrays([ids.combine_chunks() if isinstance(ids, pa.ChunkedArray) else ids, pa.array(start), pa.array(end)], ["id", "start", "end"])

    few = entries.filter(F.col("n") <= HOT).repartition("key").sortWithinPartitions("key").mapInArrow(run, StructType().add("id", kind).add("start", LongType()).add("end", LongType()))
    # a key of very many entries: one row a string, reduced to its earliest place before and after the shuffle
    each = entries.filter(F.col("n") > HOT).select("id", "start", "bytes", F.explode(F.sequence(F.lit(0), F.length("bytes") - LENGTH)).alias("at"))
    each = each.select("id", (F.col("start") + F.col("at")).alias("start"), F.substring("bytes", F.col("at") + 1, F.lit(LENGTH)).alias("string"))
    first = each.groupBy("string").agg(F.min(F.struct("id", "start")).alias("first"))
    many = each.join(first, "string").filter(F.struct("id", "start") != F.col("first")).select("id", "start", (F.col("start") + LENGTH).alias("end"))
    return few.unionByName(many)


def repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``id, start, end``: spans of bytes to remove; they may overlap."""
    raw = docs.select(F.col(doc_id).alias("id"), F.col(text).cast("binary").alias("raw")).filter("id is not null")
    entry = Window.partitionBy("key", "context").orderBy("id", "place")
    parsed = parse(raw).repartition("key").withColumn("nth", F.rank().over(entry))
    parsed = parsed.withColumn("again", F.col("settled") | (F.col("nth") > 1))
    fresh = F.when(~F.col("again"), F.col("context"))
    among = Window.partitionBy("key")
    parsed = parsed.withColumn("n", F.count(fresh).over(among)).withColumn("low", F.min(fresh).over(among)).withColumn("high", F.max(fresh).over(among))
    split = F.col("low") != F.col("high")  # the key has more than one entry
    parsed = stored(parsed.filter(F.col("again") | split | F.col("left").isNotNull()).select(
        "id", "place", "again", F.when(~F.col("again") & split, F.struct("key", "n")).alias("right"), F.when(~F.col("again"), F.col("left")).alias("left")))
    first, last = F.shiftright("place", 14), F.shiftright("place", 14) + F.shiftright("place", 7).bitwiseAND(127)
    settled = parsed.filter("again").select("id", first.alias("start"), (last + LENGTH).alias("end"))
    by_left = parsed.filter("left is not null").select(F.col("left").alias("key"), "id", "place")
    by_left = by_left.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("key"))).filter("n > 1")
    wanted = parsed.filter("right is not null").select("id", F.struct("right.key", "right.n", "place", F.lit(0).alias("side")).alias("w")).unionByName(
        by_left.select("id", F.struct("key", "n", "place", F.lit(1).alias("side")).alias("w")))
    wanted = wanted.groupBy("id").agg(F.collect_list("w").alias("wanted"))  # at most the phrases of a text
    return settled.unionByName(repeated_suffixes(contexts(packed(raw).join(wanted, "id"))))


def packed(raw: DataFrame) -> DataFrame:
    """``id, packed``: the bytes, compressed for the shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shut = zstandard.ZstdCompressor(level=3)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array([shut.compress(x.as_py() or b"") for x in b.column("raw")], pa.binary())], ["id", "packed"])

    return raw.mapInArrow(run, StructType().add("id", raw.schema["id"].dataType).add("packed", BinaryType()))


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``id, kept, n_bytes, spans`` of every row: the remaining bytes, the size of the text, and its maximal removed runs (array<struct<start, end>>)."""
    small_batches(docs)
    raw = docs.select(F.col(doc_id).alias("id"), F.coalesce(F.col(text).cast("binary"), F.lit(b"")).alias("raw"))
    spans = repeats(docs, doc_id, text).groupBy("id").agg(F.collect_list(F.struct("start", "end")).alias("found"))
    joined = packed(raw).join(spans, "id", "left")
    kind = ArrayType(StructType().add("start", LongType()).add("end", LongType()))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_ = zstandard.ZstdDecompressor()
        for b in batches:
            kept, size, runs = [], [], []
            for x, found in zip(b.column("packed"), b.column("found"), strict=True):
                data = open_.decompress(x.as_py())
                merged: list[list[int]] = []
                for s, e in sorted((f["start"], min(f["end"], len(data))) for f in found.as_py() or ()):
                    if merged and s <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], e)
                    elif e > s:
                        merged.append([s, e])
                at, parts = 0, []
                for s, e in merged:
                    parts.append(data[at:s])
                    at = e
                kept.append(b"".join([*parts, data[at:]]))
                size.append(len(data))
                runs.append([{"start": s, "end": e} for s, e in merged])
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(kept, pa.binary()), pa.array(size, pa.int64()), pa.array(runs, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))],
                                             ["id", "kept", "n_bytes", "spans"])

    return joined.mapInArrow(cut, StructType().add("id", raw.schema["id"].dataType).add("kept", BinaryType()).add("n_bytes", LongType()).add("spans", kind))
