"""Periodic runs of words in every text, by a suffix automaton whose suffix links form a link-cut tree.

A run is a stretch of words that repeats with smallest period ``q`` over at least ``max(shortest, times * q)`` words and cannot be longer on either side.

1. Words are appended one by one to a suffix automaton. The new prefix and all its suffixes are the path from its state to the root of the suffix links.
2. Accessing that path in the link-cut tree shows it as segments of one colour each: the end of the last occurrence of these suffixes. A segment whose longest
   suffix has at least as many words as lie between that end and the new one is a square: two equal neighbours of ``d`` words each.
   Then the path is recoloured to the new end. Each access is O(log n) amortised, so periodic texts are no worse than others.
3. The squares of one ``d`` that end at consecutive words are a run with smallest period ``d``. A square of a multiple of ``d`` never shows up inside it, as its half
   occurs again ``d`` words before; the first square ends ``2 * d`` words after the run's start, so both ends are known without comparing words.

Only stretches that can hold a run are fed: every word of a run lies in a window of ``shortest - shortest // times`` words that stands again in its text. Windows are compared by hash, so a stretch too
many can be fed but none too few; the automaton itself compares words.

Cases: a null or empty text has no words, no runs and an empty collapsed text; a text shorter than ``shortest`` has no runs; of a very long text a task holds the words and
about 300 bytes for each word of its longest stretch, whatever its periods; repeated rows are each searched; an empty table gives an
empty table; only the columns named in ``keep`` are carried, which may not be called ``n_words``, ``runs`` or ``collapsed``.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, LongType, StringType, StructType

#: A run has at least this many words, and at least this many times its period.
SHORTEST, TIMES = 24, 3
#: Bytes of text worked on between two batches of results.
BYTES_AT_ONCE = 4 << 20


def squares(words: list[int]) -> list[tuple[int, int, int]]:
    """``period, first, last`` for every maximal row of consecutive ends at which a primitive square of that period ends. ``words``: numbers from 0."""
    room = 2 * len(words) + 2
    zero, none = bytes(4 * room), b"\xff" * (4 * room)
    # the automaton: length, suffix link, one outgoing edge in two arrays, further edges in a map
    length, link, by, to = array("i", zero), array("i", zero), array("i", none), array("i", zero)
    more: dict[int, dict[int, int]] = {}
    # the link-cut tree: 0 is no node, so the root state stands apart; the colour is kept at the top of each splay tree
    left, right, up, colour = array("i", zero), array("i", zero), array("i", zero), array("i", none)
    active: dict[int, list[int]] = {}
    out = []

    def turn(x: int, p: int) -> None:
        """Rotate ``x`` above ``p``."""
        g = up[p]
        if left[p] == x:
            b = left[p] = right[x]
            right[x] = p
        else:
            b = right[p] = left[x]
            left[x] = p
        if b:
            up[b] = p
        up[p], up[x] = x, g
        if g and left[g] == p:
            left[g] = x
        elif g and right[g] == p:
            right[g] = x
        else:
            colour[x] = colour[p]

    def splay(x: int) -> None:
        while True:
            p = up[x]
            if not p or (left[p] != x and right[p] != x):
                return
            g = up[p]
            if g and (left[g] == p or right[g] == p):
                turn(p, g) if (left[g] == p) == (left[p] == x) else turn(x, p)
                turn(x, up[x])
            else:
                turn(x, p)

    link[0] = -1
    states, last = 1, 0
    for i, c in enumerate(words):
        cur = states
        states += 1
        length[cur] = length[last] + 1
        p = last
        q = -1
        while p >= 0:
            if by[p] == c:
                q = to[p]
                break
            m = more.get(p)
            if m is None:
                if by[p] < 0:
                    by[p], to[p] = c, cur
                else:
                    more[p] = {c: cur}
            else:
                q = m.get(c, -1)
                if q >= 0:
                    break
                m[c] = cur
            p = link[p]
        if q < 0:
            parent = 0
        elif length[p] + 1 == length[q]:
            parent = q
        else:
            parent = states
            states += 1
            length[parent], link[parent], by[parent], to[parent] = length[p] + 1, link[q], by[q], to[q]
            if q in more:
                more[parent] = more[q].copy()
            while p >= 0:
                if by[p] == c:
                    if to[p] != q:
                        break
                    to[p] = parent
                else:
                    m = more[p]
                    if m[c] != q:
                        break
                    m[c] = parent
                p = link[p]
            link[q] = parent
            splay(q)  # the copy goes right above it, in the same segment
            b = left[parent] = left[q]
            if b:
                up[b] = parent
            left[q], up[parent] = parent, q
        link[cur] = up[cur] = parent
        y, x = cur, parent
        while x:
            splay(x)
            end = colour[x]
            r = right[x]
            if r:
                colour[r] = end
            d = i - end
            if d <= length[x]:
                run = active.get(d)
                if run is not None and run[1] == i - 1:
                    run[1] = i
                else:
                    if run is not None:
                        out.append((d, run[0], run[1]))
                    active[d] = [i, i]
            right[x] = y
            y, x = x, up[x]
        colour[y] = i
        last = cur
    return out + [(d, a, b) for d, (a, b) in active.items()]


def stretches(codes: np.ndarray, window: int) -> list[tuple[int, int]]:
    """Maximal stretches of words covered by windows that stand more than once, by hash."""
    n = len(codes) - window + 1
    if n < 2:
        return []
    h, size = codes.astype(np.uint64), 1
    for bit in bin(window)[3:]:  # windows of the leading bits of the size, doubled and lengthened by one
        h = (h[:-size] ^ (h[:-size] >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93) + h[size:]
        size *= 2
        if bit == "1":
            h = (h[:-1] ^ (h[:-1] >> np.uint64(29))) * np.uint64(0x94D049BB133111EB) + codes[size:].astype(np.uint64)
            size += 1
    order = np.argsort(h, kind="stable")
    same = np.flatnonzero(np.diff(h[order]) == 0)
    if not len(same):
        return []
    again = np.zeros(n, dtype=bool)
    again[order[same]] = again[order[same + 1]] = True
    cover = np.zeros(len(codes) + 1, dtype=np.int64)
    at = np.flatnonzero(again)
    np.add.at(cover, at, 1)
    np.add.at(cover, at + window, -1)
    edge = np.flatnonzero(np.diff(np.concatenate(([False], np.cumsum(cover)[:-1] > 0, [False])).view(np.int8)))
    return list(zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True))


def runs_of(words: list[bytes], shortest: int = SHORTEST, times: int = TIMES) -> list[tuple[int, int, int]]:
    """``start, length, period`` of every run, by start, then period."""
    if len(words) < shortest:
        return []
    codes = np.fromiter(map(hash, words), dtype=np.int64, count=len(words))
    out = []
    for a, b in stretches(codes, shortest - shortest // times):
        names: dict[bytes, int] = {}
        for d, first, last in squares([names.setdefault(w, len(names)) for w in words[a:b]]):
            start = first - 2 * d + 1
            size = last - start + 1
            if size >= shortest and size >= times * d:
                out.append((a + start, size, d))
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words joined by one space, without those that stand in a run after its first period."""
    if runs:
        drop = np.zeros(len(words) + 1, dtype=np.int64)
        for start, size, d in runs:
            drop[start + d] += 1
            drop[start + size] -= 1
        words = [words[k] for k in np.flatnonzero(np.cumsum(drop)[:-1] == 0)]
    return b" ".join(words)


def find_runs(docs: DataFrame, text: str = "text", keep=("doc_id",), shortest: int = SHORTEST, times: int = TIMES) -> DataFrame:
    """The columns of ``keep``, ``n_words``, ``runs`` (array<struct<start, length, period>> in words, by start, then period) and ``collapsed``, for every row."""
    kind = ArrayType(StructType().add("start", LongType()).add("length", LongType()).add("period", LongType()))
    kept = docs.select(*keep)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, runs, texts, size, done = [], [], [], 0, 0
            for i, raw in enumerate(b.column("_raw")):
                raw = raw.as_py() or b""
                words = raw.split()  # at bytes 9 to 13 and 32
                found = runs_of(words, shortest, times)
                n.append(len(words))
                runs.append([{"start": s, "length": k, "period": d} for s, k, d in found])
                texts.append(collapsed(words, found))
                size += len(raw)
                if size >= BYTES_AT_ONCE or i == len(b) - 1:
                    yield pa.RecordBatch.from_arrays([*[b.column(c).slice(done, len(n)) for c in keep], pa.array(n, pa.int64()), pa.array(runs, pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))),
                                                      pa.array(texts, pa.binary()).cast(pa.string())], [*keep, "n_words", "runs", "collapsed"])
                    done, n, runs, texts, size = i + 1, [], [], [], 0

    rows = docs.select(*keep, docs[text].cast("binary").alias("_raw"))
    return rows.mapInArrow(search, StructType([*kept.schema.fields]).add("n_words", LongType()).add("runs", kind).add("collapsed", StringType()))
