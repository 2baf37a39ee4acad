"""Alignment of two tokenizers over the same text: which tokens of A lie over which tokens of B, and how common each pair of ids is.

A is a byte-level BPE (a ``tokenizers`` JSON file; where its ids are shown to suffice as ranks it is run by them), B a piece model with byte fallback (``sentencepiece``); A reads a space and the text, B adds that space itself.
Tokens are ranges of bytes. Ranges that overlap, directly or through others, are one group; groups end where a token of A and one of B both end.

1. Every token points to its farthest-right overlapping token of the other side: the one that holds its last byte. Where both end together, the token of A points to
   itself. Ends never move back, so each chain ends in such a token, the last of its group.
2. Pointer jumping: all successors are replaced by their successors' successors at once until nothing changes. That takes the logarithm of the longest chain,
   whatever the number of texts, and leaves every token with the terminal token of its group.
3. The links of a text are the A-B pairs of each group. Its distinct id pairs and how often each occurs are kept as arrays.
4. Corpus counts: texts per id pair, and whether a pair has the highest count of its A id.
5. Scores go back to the texts. The pairs of the highest counts (at most ``FREQUENT``, a fixed bound) are sent to the tasks and settle
   nearly all links there. The rest are joined by pair: each of those stands in less than one of ``FREQUENT`` parts of all pairs, so no key is hot.

Long texts are cut into parts of about ``PART`` characters between a character that is no space and a space before a letter. A's pattern always cuts there, and B does if no piece has a space after
another character (else texts stay whole). Such a cut ends a group, so nothing changes, and memory does not grow with the text but for what a row returns.

Cases: a text that is null, empty or whose tokens do not give back its bytes (also one that is no UTF-8) has no tokens: zeros and empty lists; strings of special tokens
inside a text are plain text; repeated rows count as so many texts; an empty table gives an empty table; only the columns named in ``keep`` are
carried, which may not be called as those that are added (``NEW``), ``_row``, ``pair`` or ``times``.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, LongType, StringType, StructType

from .common import small_batches, stored

#: Characters of a part, bytes and links worked on at once, and links of a group above which equal ids are put together first.
PART, BYTES_AT_ONCE, LINKS_AT_ONCE, LARGE = 1 << 17, 1 << 19, 1 << 20, 1 << 10
#: Bound of the table of pairs that every task gets.
FREQUENT = 400_000
NEW = ("n_a", "n_b", "n_groups", "n_links", "groups", "pairs", "counts")
_CUT = re.compile(r"(?<=\S) (?=[^\W\d_])")


def _entry_bytes(entry: str) -> bytes:
    return bytes(map(_BYTE.__getitem__, entry))


_SHOWN = [*range(33, 127), *range(161, 173), *range(174, 256)]  # the bytes that stand for themselves in a byte-level entry
_BYTE = {chr(x): x for x in _SHOWN} | {chr(256 + k): x for k, x in enumerate(x for x in range(256) if x not in _SHOWN)}


def ranks_suffice(a_file: bytes) -> bool:
    """Whether A's merges follow from the ids alone: then merging the pair whose bytes have the lowest id gives its tokens on every text.

    A merge inside a token depends on nothing outside it, as what crosses its edges would keep it from being made. So it is enough that each token, merged by
    lower ids only, ends in the very pair that the file lists for it."""
    spec = json.loads(a_file)
    model, before = spec["model"], spec.get("pre_tokenizer") or {}
    if model.get("type") != "BPE" or spec.get("normalizer") or before.get("type") != "ByteLevel" or before.get("add_prefix_space") or not before.get("use_regex", True):
        return False
    if any(model.get(x) for x in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback")):
        return False
    special = {x["content"] for x in spec.get("added_tokens", ())}
    rank = {_entry_bytes(entry): i for entry, i in model["vocab"].items() if entry not in special}
    listed = [tuple(map(_entry_bytes, m.split(" ") if isinstance(m, str) else m)) for m in model["merges"]]
    made = [rank.get(x + y, -1) for x, y in listed]
    if any(bytes([x]) not in rank for x in range(256)) or len(rank) != 256 + len(listed) or made != sorted(set(made)) or made[:1] == [-1]:
        return False
    for (x, y), top in zip(listed, made, strict=True):
        parts = [bytes([c]) for c in x + y]
        while len(parts) > 2:
            low, k = min((rank.get(parts[k] + parts[k + 1], top), k) for k in range(len(parts) - 1))
            if low >= top:
                return False
            parts[k: k + 2] = [parts[k] + parts[k + 1]]
        if parts != [x, y]:
            return False
    return True


class Tokenizers:
    """Both tokenizers, from the contents of their files, with the bytes of every id. With a ``pattern`` A is run by its ids as ranks (see :func:`ranks_suffice`), which is several times as fast."""

    def __init__(self, a_file: bytes, b_file: bytes, pattern: str | None = None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        a = Tokenizer.from_str(a_file.decode())
        a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_file)
        special = {x.content for x in a.get_added_tokens_decoder().values()}
        entries = {entry: i for entry, i in a.get_vocab(with_added_tokens=False).items() if entry not in special}
        self.a_bytes = [b""] * (max(entries.values()) + 1)
        for entry, i in entries.items():
            self.a_bytes[i] = _entry_bytes(entry)
        if pattern is None:
            self.encode_a = lambda texts: [e.ids for e in a.encode_batch_fast(texts, add_special_tokens=False)]
        else:
            by_rank = tiktoken.Encoding("A", pat_str=pattern, mergeable_ranks={self.a_bytes[i]: i for i in entries.values()}, special_tokens={})
            self.encode_a = lambda texts: [by_rank.encode_ordinary(t) for t in texts]
        pieces = [self.b.id_to_piece(i) for i in range(self.b.vocab_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.cuts = not any(re.search("[^▁]▁", p) for p in pieces)
        self.a_size, self.b_size = (np.array([len(x) for x in y], dtype=np.int64) for y in (self.a_bytes, self.b_bytes))
        n = max(len(self.a_bytes), len(self.b_bytes))
        self.told = np.array([f"{i}{sep}" for sep in ",|;" for i in range(n)], dtype=object)
        self.n = n

    def parts(self, text: str) -> list[str]:
        """The text without the spaces at the cuts; a space before each part gives it back."""
        out, at = [], 0
        while self.cuts and len(text) - at > PART:
            cut = _CUT.search(text, at + PART)
            if cut is None:
                break
            out.append(text[at: cut.start()])
            at = cut.end()
        return [*out, text[at:]]


def terminals(a_end: np.ndarray, b_end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every token of A and of B the A token that ends its group. Ends ascend, and both sides end together."""
    n = len(a_end)
    over_a, over_b = np.searchsorted(b_end, a_end), np.searchsorted(a_end, b_end)
    after = np.concatenate([np.where(b_end[over_a] == a_end, np.arange(n), n + over_a), over_b]) if n else np.empty(0, dtype=np.int64)
    while True:
        further = after[after]
        if np.array_equal(further, after):
            return after[:n], after[n:]
        after = further


def link_pairs(a: np.ndarray, b: np.ndarray, a_at: np.ndarray, b_at: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``text, pair, times`` of the distinct id pairs of each text. Group g has the tokens ``a[a_at[g]: a_at[g + 1]]`` and ``b[b_at[g]: b_at[g + 1]]`` and belongs to ``text[g]``."""
    n_a, n_b = np.diff(a_at), np.diff(b_at)
    links = n_a * n_b
    wide_a, wide_b = (int(x.max(initial=0)) + 1 for x in (a, b))
    if (int(text.max(initial=0)) + 1) * wide_a * wide_b >= 1 << 63:
        raise ValueError("too many texts at once for these vocabularies")
    keys, times = [], []
    small = np.flatnonzero(links <= LARGE)
    total = np.cumsum(links[small])
    for part in np.split(small, np.flatnonzero(np.diff(total // LINKS_AT_ONCE)) + 1):
        size = links[part]
        k = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        wide = np.repeat(n_b[part], size)
        left = np.repeat(text[part] * wide_a, size) + a[np.repeat(a_at[part], size) + k // wide]
        key, n = np.unique(left * wide_b + b[np.repeat(b_at[part], size) + k % wide], return_counts=True)
        keys.append(key)
        times.append(n)
    for g in np.flatnonzero(links > LARGE):
        ia, ka = np.unique(a[a_at[g]: a_at[g + 1]], return_counts=True)
        ib, kb = np.unique(b[b_at[g]: b_at[g + 1]], return_counts=True)
        rows = max(1, LINKS_AT_ONCE // len(ib))
        for s in range(0, len(ia), rows):
            keys.append((((text[g] * wide_a + ia[s: s + rows, None]) * wide_b) + ib).ravel())
            times.append((ka[s: s + rows, None] * kb).ravel())
    key, k = (keys[0], times[0]) if len(keys) == 1 else _added(np.concatenate(keys), np.concatenate(times))
    key, right = np.divmod(key, wide_b)
    t, left = np.divmod(key, wide_a)
    return t, left << 32 | right, k


def _added(key: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and the sums of their times."""
    if not len(key):
        return key, times
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.flatnonzero(np.concatenate(([True], np.diff(key) != 0)))
    return key[first], np.add.reduceat(times[order], first)


class Row:
    """What is known of one text while its parts are worked on."""

    def __init__(self):
        self.n, self.groups, self.pairs, self.counts = np.zeros(4, dtype=np.int64), [], [], []

    def done(self) -> tuple[np.ndarray, str, np.ndarray, np.ndarray]:
        pairs, counts = (x[0] if len(x) == 1 else np.concatenate([np.empty(0, dtype=np.int64), *x]) for x in (self.pairs, self.counts))
        if len(self.pairs) > 1:
            pairs, counts = _added(pairs, counts)
        return self.n, ";".join(self.groups), pairs, counts


def align_parts(tok: Tokenizers, rows: list[Row], parts: list[tuple[int, str]]) -> None:
    """Add the parts (row, text) to their rows. All parts are worked on in one go, end to end."""
    texts = [p for _, p in parts]
    ids_a = tok.encode_a([" " + t for t in texts])
    ids_b = tok.b.encode(texts, num_threads=1)
    same = [k for k, t in enumerate(texts) if (raw := (" " + t).encode()) == b"".join(map(tok.a_bytes.__getitem__, ids_a[k])) and raw == b"".join(map(tok.b_bytes.__getitem__, ids_b[k]))]
    for k in set(range(len(texts))) - set(same):
        rows[parts[k][0]] = None
    if not same:
        return  # no part with tokens
    n_a, n_b = (np.array([len(ids[k]) for k in same], dtype=np.int64) for ids in (ids_a, ids_b))
    a, b = (np.fromiter(chain.from_iterable([ids[k] for k in same]), dtype=np.int32, count=int(n.sum())) for ids, n in ((ids_a, n_a), (ids_b, n_b)))
    a_end, b_end = np.cumsum(tok.a_size[a]), np.cumsum(tok.b_size[b])
    last_a, last_b = terminals(a_end, b_end)
    ends = last_a == np.arange(len(a))
    number = np.cumsum(ends) - 1
    group_a, group_b = number[last_a], number[last_b]
    n = int(ends.sum())
    a_at, b_at = np.searchsorted(group_a, np.arange(n + 1)), np.searchsorted(group_b, np.arange(n + 1))
    part = np.repeat(np.arange(len(same)), n_a)[ends]  # of each group
    n_groups, links = np.bincount(part, minlength=len(same)), np.diff(a_at) * np.diff(b_at)
    n_links = np.add.reduceat(links, np.cumsum(n_groups) - n_groups)
    seq = np.empty(len(a) + len(b), dtype=np.int64)
    seq[np.arange(len(a)) + b_at[group_a]] = a + tok.n * ends
    closes = np.zeros(len(b), dtype=np.int64)
    closes[b_at[1:] - 1] = 2
    seq[np.arange(len(b)) + a_at[group_b + 1]] = b + tok.n * closes
    told = tok.told[seq].tolist()
    to = np.cumsum(n_a + n_b)
    of, pair, times = link_pairs(a, b, a_at, b_at, part)
    cut = np.searchsorted(of, np.arange(len(same) + 1))
    for j, k in enumerate(same):
        row = rows[parts[k][0]]
        if row is not None:
            row.n += (n_a[j], n_b[j], n_groups[j], n_links[j])
            row.groups.append("".join(told[to[j] - n_a[j] - n_b[j]: to[j]])[:-1])
            row.pairs.append(pair[cut[j]: cut[j + 1]])
            row.counts.append(times[cut[j]: cut[j + 1]])


def align(docs: DataFrame, a_path: str, b_path: str, a_pattern: str | None = None, text: str = "text", keep=("doc_id",)) -> DataFrame:
    """The columns of ``keep`` and ``NEW``: numbers of tokens, groups and links, the groups as ``a1,a2|b1;a3|b2``, the distinct linked id pairs (A id in the upper 32 bits, B id in the lower)
    and how often each is linked. The files are read by the driver and sent to the tasks. ``a_pattern``: the pattern of A's byte-level cutting, where the caller knows it; it is used if A's ids suffice as ranks."""
    with open(a_path, "rb") as fa, open(b_path, "rb") as fb:
        a_file, b_file = fa.read(), fb.read()
    files = docs.sparkSession.sparkContext.broadcast((a_file, b_file, a_pattern if a_pattern and ranks_suffice(a_file) else None))
    small_batches(docs)
    kept = docs.select(*keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = Tokenizers(*files.value)
        for b in batches:
            done, rows, parts, held, size = 0, [], [], 0, 0
            for i, raw in enumerate(b.column("_raw")):
                raw = raw.as_py() or b""
                whole = raw.decode("utf-8", "replace")
                rows.append(Row() if whole and whole.encode() == raw else None)
                for p in tok.parts(whole) if rows[-1] is not None else ():
                    parts.append((len(rows) - 1, p))
                    held += len(p)
                    if held >= BYTES_AT_ONCE:
                        align_parts(tok, rows, parts)
                        parts, held = [], 0
                size += len(raw)
                if size >= BYTES_AT_ONCE or i == len(b) - 1:
                    align_parts(tok, rows, parts)
                    yield out(b, done, rows)
                    done, rows, parts, held, size = i + 1, [], [], 0, 0
            pa.default_memory_pool().release_unused()

    def out(b: pa.RecordBatch, start: int, rows: list[Row | None]) -> pa.RecordBatch:
        n, groups, pairs, counts = zip(*[(r or Row()).done() for r in rows], strict=True)
        n = np.stack(n)
        at = pa.array(np.concatenate(([0], np.cumsum([len(p) for p in pairs]))).astype(np.int32))
        lists = [pa.ListArray.from_arrays(at, pa.array(np.concatenate(x), pa.int64())) for x in (pairs, counts)]
        return pa.RecordBatch.from_arrays([*[b.column(c).slice(start, len(rows)) for c in keep], *[pa.array(n[:, k]) for k in range(4)], pa.array(groups, pa.string()), *lists], [*keep, *NEW])

    kind = StructType([*kept.schema.fields])
    for c in NEW[:4]:
        kind.add(c, LongType())
    kind.add("groups", StringType()).add("pairs", ArrayType(LongType())).add("counts", ArrayType(LongType()))
    return docs.select(*keep, docs[text].cast("binary").alias("_raw")).mapInArrow(run, kind)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """``pair, n, best``: the texts that hold an id pair linked, and whether no pair of its A id has more. One row for each pair of the corpus."""
    n = stored(aligned.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("n")))
    first = F.shiftright("pair", 32)
    most = n.groupBy(first.alias("_a")).agg(F.max("n").alias("_most"))
    return n.withColumn("_a", first).join(most, "_a").select("pair", "n", (F.col("n") == F.col("_most")).alias("best"))


def frequent(counts: DataFrame, bound: int | None = None) -> tuple[DataFrame, Column]:
    """The pairs of the highest counts, at most ``bound``, and the condition that picks them. Ties at the limit stay out."""
    bound = FREQUENT if bound is None else bound
    # counts above 64 are put together by powers of 2 ** (1/8), so a few hundred rows reach the driver
    level = F.when(F.col("n") <= 64, F.col("n").cast("double")).otherwise(F.floor(F.log2("n") * 8) + 17)
    low, total = float("inf"), 0
    for value, size in sorted(((r["level"], r["count"]) for r in counts.groupBy(level.alias("level")).count().collect()), reverse=True):
        if total + size > bound:
            break
        low, total = value, total + size
    return counts.filter(level >= low), level >= low


def score(aligned: DataFrame, counts: DataFrame, keep=("doc_id",)) -> DataFrame:
    """The columns of ``keep`` (``aligned`` is a stored table), ``n_best`` and ``count_sum``: links whose pair is the most common one of its A id, and the sum of the counts over all links."""
    spark = aligned.sparkSession
    hot, is_hot = frequent(counts)
    table = hot.toArrow().combine_chunks()
    order = np.argsort(table["pair"].to_numpy(), kind="stable")
    shared = spark.sparkContext.broadcast(tuple(np.ascontiguousarray(table[c].to_numpy()[order]) for c in ("pair", "n", "best")))  # at most FREQUENT rows

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, n, best = shared.value
        for b in batches:
            lists = b.column("pairs")
            at = lists.offsets.to_numpy().astype(np.int64) if len(lists) else np.zeros(1, dtype=np.int64)
            pair, times = (b.column(c).flatten().to_numpy() for c in ("pairs", "counts"))
            row = np.repeat(np.arange(len(b)), np.diff(at))
            where = np.minimum(np.searchsorted(known, pair), max(len(known) - 1, 0))
            found = known[where] == pair if len(known) else np.zeros(len(pair), dtype=bool)
            w, r, t = where[found], row[found], times[found]
            n_best, total = np.zeros(len(b), dtype=np.int64), np.zeros(len(b), dtype=np.int64)
            np.add.at(n_best, r, t * best[w])
            np.add.at(total, r, t * n[w])
            rest = pa.array(np.concatenate(([0], np.cumsum(np.bincount(row[~found], minlength=len(b))))).astype(np.int32))
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in ("_row", *keep)], pa.array(n_best), pa.array(total), *[pa.ListArray.from_arrays(rest, pa.array(x[~found])) for x in (pair, times)]],
                                             ["_row", *keep, "n_best", "count_sum", "pair", "times"])

    rows = aligned.select("_row", *keep, "pairs", "counts")
    kind = StructType([*rows.select("_row", *keep).schema.fields]).add("n_best", LongType()).add("count_sum", LongType()).add("pair", ArrayType(LongType())).add("times", ArrayType(LongType()))
    settled = stored(rows.mapInArrow(settle, kind), "zstd")
    rest = settled.filter(F.size("pair") > 0).select("_row", F.explode(F.arrays_zip("pair", "times")).alias("x")).select("_row", "x.pair", "x.times")
    rest = rest.join(counts.filter(~is_hot), "pair").groupBy("_row").agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(F.lit(0))).alias("_best"), F.sum(F.col("times") * F.col("n")).alias("_sum"))
    return settled.join(rest, "_row", "left").select(*keep, *[(F.col(c) + F.coalesce(F.col(x), F.lit(0))).alias(c) for c, x in (("n_best", "_best"), ("count_sum", "_sum"))])


def with_row_numbers(aligned: DataFrame) -> DataFrame:
    """A stored table with a number for each row, as rows may share an id or have none."""
    return stored(aligned.withColumn("_row", F.monotonically_increasing_id()), "zstd")
