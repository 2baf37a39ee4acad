"""Benchmark decontamination: a BM25 inverted index of test items, asked with every passage of every document by block-max WAND.

Items are cut into units of at most ``UNIT_WORDS`` words. A term's impact on a unit is its BM25 weight divided by the unit's own total, so a passage
that holds the whole unit scores about 1 and one threshold fits all units. Units lie in blocks; the index keeps, for each term, the largest impact in each block.
A document is read in overlapping passages over its whole length. Upper bounds from block maxima are added up for all
passages at once, and only the blocks that can reach the threshold are scored from their postings: all pairs at or over the threshold
are found. What is found is verified: the runs of three words of the question and of the answer (of all its words, if a part has one or two) must both be
found in the passage.

The index is built for shards of items that keep within ``SHARD_ITEMS`` and ``SHARD_CHARS``, each sent to the tasks; further shards are
further passes over the same batch of texts, so the size of the benchmark is not limited and no larger object is ever sent.

Cases: a null or empty text, and an item without words, match nothing; repeated items count as one more unit each and are all reported; repeated documents are
read each; null ids are carried; empty tables give no leaks; the result column ``leaks`` replaces one of that name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from .common import Powers, hash_runs, small_batches

#: Terms are runs of letters and digits; every byte of a character outside ASCII counts as a letter.
_APART = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
#: Words of a unit, of half a passage (passages are two halves long and start at every half, so a unit of up to half a passage lies whole in one).
UNIT_WORDS, HALF = 64, 64
K1, B, THRESHOLD, OVERLAP, RUN = 1.2, 0.75, 0.6, 0.5, 3
#: Block columns of the bound table; the commonest terms of the index whose share is a constant of the bound.
BLOCKS, COMMON = 32, 64
SHARD_ITEMS, SHARD_CHARS, CHARS_AT_ONCE = 20_000, 32_000_000, 1_000_000


def terms_of(texts: list[str | None], powers: Powers) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lower-cased terms of all texts, one after another, and how many each text has."""
    raw = [(t or "").lower().encode("utf-8", "surrogatepass") + b"\n" for t in texts]
    hashes, start = hash_runs(np.frombuffer(b"".join(raw), dtype=np.uint8), _APART, powers)
    end = np.cumsum([len(r) for r in raw])
    return hashes, np.diff(np.searchsorted(start, end), prepend=0)


def _runs(words: np.ndarray, n: int = RUN) -> set:
    w = words.tolist()
    return {tuple(w[i: i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


class Index:
    """Units, impacts and block maxima of one shard of items: rows ``(item, question, answer)``."""

    def __init__(self, items: list[tuple], common: int = COMMON, blocks: int = BLOCKS):
        self.item, self.at, parts, self.question, self.answer, powers = [], [], [], [], [], Powers()
        for item, question, answer in items:
            words, (n_question, n_answer) = terms_of([question, answer], powers)
            if answer is None:  # no column of its own: the last third of the terms is the answer
                n_question = len(words) - len(words) // 3
            q = words[:n_question]
            count = -(-len(words) // UNIT_WORDS)
            for k in range(count):
                lo, hi = k * len(words) // count, (k + 1) * len(words) // count
                self.item.append(item)
                self.at.append(lo)
                parts.append(words[lo:hi])
                self.question.append(_runs(words[lo: min(hi, len(q))]) if lo < len(q) else set())
                self.answer.append(_runs(words[max(lo, len(q)): hi]) if hi > len(q) else set())
        self.terms: dict[int, int] = {w: i for i, w in enumerate(np.unique(np.concatenate(parts)).tolist(), 1)} if parts else {}  # 0: not in the index
        self.sorted = np.array(sorted(self.terms) or [0], dtype=np.uint64)
        term, unit, tf = [], [], []
        for u, words in enumerate(parts):
            seen: dict[int, int] = {}
            for w in words.tolist():
                t = self.terms[w]
                seen[t] = seen.get(t, 0) + 1
            term += seen.keys()
            unit += [u] * len(seen)
            tf += seen.values()
        term, unit, tf = np.array(term, dtype=np.int64), np.array(unit, dtype=np.int64), np.array(tf, dtype=np.float64)
        n, size = len(parts), np.array([len(p) for p in parts], dtype=np.float64)
        df = np.bincount(term, minlength=len(self.terms) + 1)
        idf = np.log1p((n - df + 0.5) / (df + 0.5))
        weight = idf[term] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * size[unit] / max(1.0, size.mean() if n else 1.0))) if n else tf
        impact = weight / np.bincount(unit, weights=weight, minlength=max(1, n))[unit] if n else weight
        order = np.argsort(term, kind="stable")
        self.unit, self.impact = unit[order], impact[order]
        self.first = np.searchsorted(term[order], np.arange(len(self.terms) + 2))
        self.n, self.block = n, np.arange(n) * blocks // max(1, n)
        self.bound = np.zeros((len(self.terms) + 1, blocks), dtype=np.float32)
        np.maximum.at(self.bound, (term, self.block[unit] if n else unit), impact)
        # the commonest terms stand in nearly every passage, often twice: their share is bounded once, by the unit that has most of it
        often = np.argsort(-df[1:], kind="stable")[:common] + 1
        share = np.bincount(unit, weights=impact * np.isin(term, often), minlength=max(1, n))
        self.constant = np.zeros(blocks, dtype=np.float32)
        if n:
            np.maximum.at(self.constant, self.block, share[:n].astype(np.float32))
        self.bound[often] = 0

    def search(self, hashes: np.ndarray, size: np.ndarray, threshold: float) -> list[tuple[int, int, int, float]]:
        """(document, first term of the passage, unit, score) of all passages and units at or over the threshold. ``size``: terms of each document."""
        at = np.minimum(np.searchsorted(self.sorted, hashes), len(self.sorted) - 1)
        ids = np.where(self.sorted[at] == hashes, at + 1, 0) if self.terms else np.zeros(len(hashes), dtype=np.int64)
        halves = -(-size // HALF)
        doc_start, doc_half = np.cumsum(size) - size, np.cumsum(halves) - halves
        doc = np.repeat(np.arange(len(size)), halves)
        if not len(doc):
            return []
        k = np.arange(len(doc)) - doc_half[doc]
        start = doc_start[doc] + k * HALF
        bound = np.add.reduceat(self.bound[ids], start, axis=0)
        last = k == halves[doc] - 1
        both = bound + np.where(last[:, None], 0, np.vstack([bound[1:], bound[:1]])) + self.constant
        passage, block = np.nonzero((both >= threshold - 1e-4) & (~last | (k == 0))[:, None])
        found = []
        rows, first = np.unique(passage, return_index=True)
        for p, lo, hi in zip(rows, first, np.append(first[1:], len(passage))[: len(rows)], strict=True):
            d = doc[p]
            end = min(start[p] + 2 * HALF, doc_start[d] + size[d])
            t = np.unique(ids[start[p]: end])
            t = t[t > 0]
            length = self.first[t + 1] - self.first[t]
            at = np.repeat(self.first[t] - (np.cumsum(length) - length), length) + np.arange(length.sum())
            unit = self.unit[at]
            at = at[np.isin(self.block[unit], block[lo:hi])] if self.n > BLOCKS * 64 else at
            score = np.bincount(self.unit[at], weights=self.impact[at], minlength=1)
            found += [(int(d), int(k[p]) * HALF, int(u), float(score[u])) for u in np.flatnonzero(score >= threshold)]
        return found

    def verified(self, words: np.ndarray, start: int, unit: int) -> tuple[float, float]:
        """Shares of the runs of the unit's question and of its answer that the passage has; a part that the unit lacks counts as found."""
        passage = words[start: start + 2 * HALF]
        share = lambda want: len(want & _runs(passage, len(next(iter(want))))) / len(want) if want else 1.0  # a part's runs are all of one length
        return share(self.question[unit]), share(self.answer[unit])


def shards(items: DataFrame, item_id: str, question: str, answer: str | None) -> list[list[tuple]]:
    """The items in lists that keep within the bounds of a shard (an item over the bound alone has a shard of its own share)."""
    rows = items.select(F.col(item_id).alias("i"), F.col(question).alias("q"), (F.col(answer) if answer else F.lit(None).cast("string")).alias("a"))
    n, chars = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.length(F.concat(F.coalesce("q", F.lit("")), F.coalesce("a", F.lit(""))))), F.lit(0))).first()
    count = max(1, -(-n // SHARD_ITEMS), -(-chars // SHARD_CHARS))
    out = []
    for k in range(count):
        part = rows if count == 1 else rows.filter(F.pmod(F.xxhash64("i", "q"), F.lit(count)) == k)
        got = sorted((tuple(r) for r in part.collect()), key=lambda r: (r[0] is None, r[0] if r[0] is not None else 0, r[1] or "", r[2] or ""))
        out.append(got)
    return out


def add_leaks(docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", question: str = "text", answer: str | None = None,
              threshold: float = THRESHOLD, overlap: float = OVERLAP) -> DataFrame:
    """Add ``leaks`` to every row: array<struct<item_id, unit_start, passage_start, score, question_overlap, answer_overlap>>, empty for a clean document.

    One entry for each unit found and verified, from the passage that scores highest (the first of equals)."""
    small_batches(docs)
    spark, kind = docs.sparkSession, dict(items.dtypes)[item_id]
    one = f"array<struct<item_id:{kind},unit_start:bigint,passage_start:bigint,score:double,question_overlap:double,answer_overlap:double>>"

    def finder(index):
        @pandas_udf(one)
        def find(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            ix, powers = index.value, Powers()
            for b in batches:
                out: list[list[dict]] = [[] for _ in range(len(b))]
                part = np.cumsum([len(t or "") for t in b]) // CHARS_AT_ONCE
                for rows in np.split(np.arange(len(b)), np.flatnonzero(np.diff(part)) + 1):
                    hashes, size = terms_of([b.iloc[i] for i in rows], powers)
                    first, best = np.cumsum(size) - size, {}
                    for d, start, unit, score in ix.search(hashes, size, threshold):
                        q, a = ix.verified(hashes[first[d]: first[d] + size[d]], start, unit)
                        if q >= overlap and a >= overlap:
                            best[d, unit] = max(best.get((d, unit), (-1.0,)), (score, -start, q, a))
                    for (d, unit), (score, start, q, a) in sorted(best.items()):
                        out[rows[d]].append({"item_id": ix.item[unit], "unit_start": ix.at[unit], "passage_start": -start, "score": score, "question_overlap": q, "answer_overlap": a})
                yield pd.Series(out)
        return find(F.col(text))

    parts = [finder(spark.sparkContext.broadcast(Index(s))) for s in shards(items, item_id, question, answer)]
    return docs.withColumn("leaks", F.concat(*parts) if len(parts) > 1 else parts[0])
