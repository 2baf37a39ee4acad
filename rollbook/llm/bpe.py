"""Byte-level BPE by a given rank file: encoding and decoding of whole texts.

A text is cut by the tokenizer's pattern in Spark; each distinct piece of an Arrow batch is encoded once. ``merge_pieces`` takes all of them side by side: in every round each piece
merges its neighbouring pair of lowest rank, leftmost first, until no piece has a pair left, so a round is a few array operations for the whole batch. Long pieces keep their
pairs in a heap over a linked list instead, so one unbroken piece costs n log n. Nothing is shuffled. Decoding concatenates the byte pieces of the ids.

A pair of ids names the token that it makes: the pairs are every split of a token into two tokens, as tiktoken looks up the joined bytes of two neighbours.

Cases: a null or empty text has no ids and decodes to no bytes; repeated rows are encoded each; null ids of documents are carried; an empty table gives an empty table;
the columns kept are those named, so others cannot clash.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, StructType

from .common import small_batches

#: Pieces put together at once, and bytes above which a piece is merged by itself.
AT_ONCE, LONG = 400_000, 64
#: Pieces whose ids a Python worker keeps for its next batches (about 40 MB); the others are merged again. Results do not depend on it.
KEPT = 200_000
#: White space as Unicode has it; Java's \s knows ASCII only.
SPACES = r"\x09-\x0D\x20\x85\xA0\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def java_pattern(pattern: str) -> str:
    """The tokenizer's pattern with its white-space classes spelled out for Java."""
    return pattern.replace(r"[^\s", f"[^{SPACES}").replace(r"\S", f"[^{SPACES}]").replace(r"\s", f"[{SPACES}]")


def pieces(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(java_pattern(pattern)), F.lit(0))


#: Above every rank: no such pair.
NONE = 1 << 40


class Merges:
    """What the merges need: the id of each byte and of each whole token, and the rank of the token that a pair of ids makes, in a table hashed by ``left * size + right``."""

    def __init__(self, ranks: dict[bytes, int]):
        self.size, self.whole = max(ranks.values(), default=0) + 1, ranks
        self.byte = np.array([ranks.get(bytes([x]), -1) for x in range(256)], dtype=np.int64)
        pairs = sorted((ranks[t[:i]] * self.size + ranks[t[i:]], rank) for t, rank in ranks.items() for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks) or [(-1, NONE)]
        key, rank = (np.array(x, dtype=np.int64) for x in zip(*pairs, strict=True))
        self.shift = 64 - max(3, int(4 * len(key)).bit_length())
        self.key, self.rank = np.full(1 << (64 - self.shift), -2, dtype=np.int64), np.full(1 << (64 - self.shift), NONE, dtype=np.int64)
        at = self._first(key)
        while len(key):  # a key whose place is taken goes to the next one
            free = self.key[at] == -2
            self.key[at[free]] = key[free]
            self.rank[at[free]] = rank[free]
            left = self.key[at] != key
            self.rank[at[~left]] = rank[~left]  # of two that wanted one place, that of the key which has it
            key, rank, at = key[left], rank[left], (at[left] + 1) & (len(self.key) - 1)
        self._by_key: dict[int, int] = {}
        self._known: dict[bytes, bytes] = {}

    def ids_of(self, data: bytes) -> np.ndarray:
        ids = self.byte[np.frombuffer(data, dtype=np.uint8)]
        if len(ids) and ids.min() < 0:
            raise ValueError("a byte of the text has no rank")
        return ids

    def _first(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(self.shift)).astype(np.int64)

    def look_up(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left * self.size + right
        at = self._first(key)
        found = self.key[at]
        out = self.rank[at]
        far = np.flatnonzero((found != key) & (found != -2))  # another key's place: look further
        out[found != key] = NONE
        key, at = key[far], at[far]
        while len(far):
            at = (at + 1) & (len(self.key) - 1)
            found = self.key[at]
            hit = found == key
            out[far[hit]] = self.rank[at[hit]]
            more = ~hit & (found != -2)
            far, key, at = far[more], key[more], at[more]
        return out

    def encode(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """:func:`merge_pieces`; what was merged before in this worker is remembered."""
        told = [self._known.get(p) for p in pieces]
        new = [i for i, x in enumerate(told) if x is None]
        values, at = merge_pieces([pieces[i] for i in new], self)
        data, at = values.astype(np.int32).tobytes(), (at * 4).tolist()
        room = KEPT - len(self._known)
        for k, (i, s, e) in enumerate(zip(new, at[:-1], at[1:], strict=True)):
            told[i] = data[s:e]
            if k < room and len(pieces[i]) <= LONG:
                self._known[pieces[i]] = told[i]
        return np.frombuffer(b"".join(told), dtype=np.int32), np.concatenate(([0], np.cumsum(np.fromiter(map(len, told), dtype=np.int64, count=len(told)) // 4))).astype(np.int64)

    def by_key(self) -> dict[int, int]:
        """The pairs as a dict, made when the first long piece comes."""
        if not self._by_key:
            used = self.key >= 0
            self._by_key.update(zip(self.key[used].tolist(), self.rank[used].tolist(), strict=True))
        return self._by_key


def merge_long(piece: bytes, merges: Merges) -> list[int]:
    """Ids of one piece: pairs in a heap by rank and place, neighbours in a linked list."""
    ids, known = merges.ids_of(piece).tolist(), merges.by_key()
    n = len(ids)
    before, after = list(range(-1, n - 1)), [*range(1, n), -1]
    heap = [(r, i, ids[i], ids[i + 1]) for i in range(n - 1) if (r := known.get(ids[i] * merges.size + ids[i + 1])) is not None]
    heapq.heapify(heap)
    while heap:
        rank, i, a, b = heapq.heappop(heap)
        j = after[i]
        if ids[i] != a or j < 0 or ids[j] != b:
            continue  # one of the two was merged since
        ids[i], ids[j], after[i] = rank, -1, after[j]
        if after[j] >= 0:
            before[after[j]] = i
        for x, y in ((before[i], i), (i, after[i])):
            if x >= 0 and y >= 0 and (r := known.get(ids[x] * merges.size + ids[y])) is not None:
                heapq.heappush(heap, (r, x, ids[x], ids[y]))
    return [x for x in ids if x >= 0]


def merge_pieces(pieces: list[bytes], merges: Merges) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all pieces one after another, and where each piece's begin (and the last one's end)."""
    done: dict[int, list[int]] = {}
    short = []
    for i, p in enumerate(pieces):
        if (r := merges.whole.get(p)) is not None:
            done[i] = [r]
        elif len(p) > LONG:
            done[i] = merge_long(p, merges)
        else:
            short.append(i)
    length = np.array([len(pieces[i]) for i in short], dtype=np.int64)
    ids = merges.ids_of(b"".join([pieces[i] for i in short]))
    of = np.repeat(np.arange(len(short)), length)
    out_ids, out_of = [], []
    inner = of[1:] == of[:-1]
    rank = np.full(len(ids), NONE, dtype=np.int64)  # of the pair that starts here
    rank[:-1][inner] = merges.look_up(ids[:-1][inner], ids[1:][inner])
    while len(ids):
        first = np.flatnonzero(np.concatenate(([True], of[1:] != of[:-1])))
        best = np.minimum.reduceat(rank, first)
        per = np.diff(np.concatenate((first, [len(ids)])))
        live = np.repeat(best < NONE, per)
        if not live.all():  # pieces without a pair leave
            out_ids.append(ids[~live])
            out_of.append(of[~live])
            ids, of, rank, per, best = ids[live], of[live], rank[live], per[best < NONE], best[best < NONE]
            if not len(ids):
                break
        hit = np.flatnonzero(rank == np.repeat(best, per))
        hit = hit[np.concatenate(([True], of[hit][1:] != of[hit][:-1]))]  # the leftmost of each piece
        ids[hit] = best
        stay = np.ones(len(ids), dtype=bool)
        stay[hit + 1] = False
        place = np.cumsum(stay)[hit] - 1
        ids, of, rank = ids[stay], of[stay], rank[stay]
        for left in (place[place > 0] - 1, place):
            pair = left[left + 1 < len(ids)]
            pair, apart = pair[of[pair] == of[pair + 1]], left[(left + 1 >= len(ids)) | (of[left] != of[np.minimum(left + 1, len(ids) - 1)])]
            rank[apart] = NONE
            rank[pair] = merges.look_up(ids[pair], ids[pair + 1])
    told = np.concatenate(out_ids) if out_ids else np.empty(0, dtype=np.int64)
    whose = np.array(short, dtype=np.int64)[np.concatenate(out_of)] if out_of else np.empty(0, dtype=np.int64)
    if done:
        told = np.concatenate([told, np.array([x for v in done.values() for x in v], dtype=np.int64)])
        whose = np.concatenate([whose, np.repeat(np.array(list(done), dtype=np.int64), [len(v) for v in done.values()])])
    told = told[np.argsort(whose, kind="stable")]
    return told, np.concatenate(([0], np.cumsum(np.bincount(whose, minlength=len(pieces))))).astype(np.int64)


def _flat_lists(x) -> tuple[np.ndarray, np.ndarray]:
    """Values and offsets (from 0) of a list array."""
    x = x.combine_chunks() if isinstance(x, pa.ChunkedArray) else x
    if isinstance(x, pa.ChunkedArray):
        x = pa.concat_arrays(x.chunks) if x.num_chunks else pa.array([], type=x.type)
    if not len(x):
        return x.values.slice(0, 0), np.zeros(1, dtype=np.int64)
    offsets = x.offsets.to_numpy(zero_copy_only=False).astype(np.int64)
    return x.values.slice(offsets[0], offsets[-1] - offsets[0]), offsets - offsets[0]


def _values(x: pa.Array) -> list[bytes]:
    """The bytes of each text of an array without nulls."""
    x = x.cast(pa.binary())
    if not len(x):
        return []
    _, offsets, data = x.buffers()
    at = np.frombuffer(offsets, dtype=np.int32)[x.offset: x.offset + len(x) + 1].tolist()
    data = data.to_pybytes() if data is not None else b""
    return [data[s:e] for s, e in zip(at[:-1], at[1:], strict=True)]


def _gather(values: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The runs ``values[start: start + length]`` one after another."""
    end = np.cumsum(length)
    return values[np.repeat(start - (end - length), length) + np.arange(end[-1] if len(end) else 0)]


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str, text: str = "text", keep=("doc_id",), width: int | None = None) -> DataFrame:
    """The columns of ``keep`` and ``ids``: array<int> of the whole text, for every row; with a ``width``, binary of so many bytes an id (little-endian)."""
    if width is not None and max(ranks.values(), default=0) >= 256**width:
        raise ValueError(f"ids do not fit {width} bytes")
    small_batches(docs)
    shared = docs.sparkSession.sparkContext.broadcast(Merges(ranks))  # the vocabulary

    def parts(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        """Slices of whole rows with about ``AT_ONCE`` pieces each (a longer row alone), so that what is worked out at once stays small."""
        size = pc.list_value_length(b.column("_pieces")).to_numpy(zero_copy_only=False).astype(np.int64)
        for x in np.split(np.arange(len(b)), np.flatnonzero(np.diff(np.cumsum(size) // AT_ONCE)) + 1):
            if len(x):
                yield b.slice(int(x[0]), len(x))
        pa.default_memory_pool().release_unused()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (s for b in batches for s in parts(b)):
            flat, offsets = _flat_lists(b.column("_pieces"))
            coded = flat.dictionary_encode()
            values, at = shared.value.encode(_values(coded.dictionary))
            row = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
            length = (at[1:] - at[:-1])[row]
            ids = _gather(values, at[:-1][row], length)
            end = np.concatenate(([0], np.cumsum(length)))[offsets]
            if width is None:
                out = pa.ListArray.from_arrays(pa.array(end.astype(np.int32)), pa.array(ids, type=pa.int32()))
            else:
                out = pa.Array.from_buffers(pa.binary(), len(b), [None, pa.py_buffer((end * width).astype(np.int32)), pa.py_buffer(ids.astype(f"<u{width}"))])
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in keep], out], [*keep, "ids"])

    kept = docs.select(*keep).schema
    return docs.select(*keep, pieces(F.col(text), pattern).alias("_pieces")).mapInArrow(run, StructType([*kept.fields]).add("ids", ArrayType(IntegerType()) if width is None else BinaryType()))


def decode(encoded: DataFrame, ranks: dict[bytes, int], ids: str = "ids", keep=("doc_id",)) -> DataFrame:
    """The columns of ``keep`` and ``decoded``: the bytes that the ids stand for."""
    spark = encoded.sparkSession
    tokens = [b""] * (max(ranks.values(), default=-1) + 1)
    for token, rank in ranks.items():
        tokens[rank] = token
    size = np.array([len(t) for t in tokens], dtype=np.int64)
    shared = spark.sparkContext.broadcast((np.frombuffer(b"".join(tokens), dtype=np.uint8), np.cumsum(size) - size, size))  # the vocabulary

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        data, start, length = shared.value
        for b in batches:
            flat, offsets = _flat_lists(b.column(ids))
            flat = flat.to_numpy(zero_copy_only=False)
            out = []
            for s, e in zip(offsets[:-1], offsets[1:], strict=True):
                x = flat[s:e]
                out.append(_gather(data, start[x], length[x]).tobytes())
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in keep], pa.array(out, type=pa.binary())], [*keep, "decoded"])

    return encoded.select(*keep, *([] if ids in keep else [ids])).mapInArrow(join, StructType([*encoded.select(*keep).schema.fields]).add("decoded", BinaryType()))
