"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages (64 words each, the whole text). Every passage is encoded: square roots of the shares of byte-class pairs
and a few repetition figures go through a learned layer. A gated attention, learned from document labels alone, weighs the passages, and
the weighted sum is scored. Only the text is an input.

Cases: a null or empty text is one passage without words and gets a score like any other; rows are scored one by one, so repeated rows
get equal scores and null ids are carried; an empty table gives an empty table; labels that are null, or whose document is missing, are
not learned from; a document labelled more than once counts with its lowest label; without both classes the score is the smoothed share
of label 1 (0.5 without labels). The columns ``score`` and ``predicted`` replace any columns of these names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from .common import _BLANK, Powers, mix64, small_batches, word_hashes

PASSAGE_WORDS = 64
FIGURES = 7
N_CLASSES = 16
N_FEATURES = N_CLASSES * N_CLASSES + FIGURES
#: Bounds of the training sample: labelled documents, and evenly spread passages of one document.
TRAIN_DOCS, TRAIN_PASSAGES = 3000, 256
HIDDEN, GATE, EPOCHS, BATCH, RATE, DECAY, SEED = 24, 12, 40, 128, 0.01, 1e-4, 7


def _classes() -> np.ndarray:
    c = np.full(256, 15, dtype=np.uint8)  # other control bytes
    c[ord("a"):ord("z") + 1] = 0
    c[[ord(x) for x in "aeiou"]] = 1
    c[ord("A"):ord("Z") + 1] = 2
    c[ord("0"):ord("9") + 1] = 3
    c[0x20], c[0x0A] = 4, 5
    c[[ord(x) for x in ".,;:!?"]] = 6
    c[[ord(x) for x in "'\"()-"]] = 7
    c[[ord(x) for x in "#*"]] = 8
    c[[ord(x) for x in "$%&"]] = 9
    c[[ord(x) for x in "|<>"]] = 10
    c[[ord(x) for x in "/\\_=+@~^`[]{}"]] = 11
    c[0x80:0xC0], c[0xC0:0xE0], c[0xE0:] = 12, 13, 14
    return c


_CLASS = _classes()


def _again(h: np.ndarray) -> np.ndarray:
    """1 where a value stood earlier."""
    out = np.ones(len(h), dtype=np.float32)
    if len(h):
        out[np.unique(h, return_index=True)[1]] = 0
    return out


def encode_passages(text: str | None, powers: Powers) -> np.ndarray:
    """One row of features for each passage of a text."""
    raw = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), dtype=np.uint8)
    words = word_hashes(text, powers, lower=False)
    if not len(words):
        return np.zeros((1, N_FEATURES), dtype=np.float32)
    blank = _BLANK[raw]
    edge = np.flatnonzero(np.diff(np.concatenate(([True], blank, [True])).astype(np.int8)))
    start, end = edge[::2], edge[1::2]
    first = np.arange(0, len(start), PASSAGE_WORDS)
    if len(first) > 1 and len(start) - first[-1] < PASSAGE_WORDS // 2:
        first = first[:-1]  # a short end joins the passage before it
    m, cut = len(first), start[first]
    cut[0] = 0
    of_byte = np.repeat(np.arange(m), np.diff(np.append(cut, len(raw))))
    kind = _CLASS[raw].astype(np.int64)
    pair = of_byte[1:] * (N_CLASSES * N_CLASSES) + kind[:-1] * N_CLASSES + kind[1:]
    count = np.bincount(pair, minlength=m * N_CLASSES * N_CLASSES).reshape(m, -1).astype(np.float32)
    of_word = np.repeat(np.arange(m), np.diff(np.append(first, len(start))))
    per = np.bincount(of_word, minlength=m).astype(np.float32)
    share = lambda x: np.bincount(of_word, weights=x, minlength=m).astype(np.float32) / per
    inside = 1 - _again(mix64(words ^ (of_word.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))))
    three = np.zeros(len(words), dtype=np.float32)
    if len(words) > 2:
        three[2:] = _again(mix64(mix64(words[:-2] * np.uint64(3) + words[1:-1]) * np.uint64(5) + words[2:]))
    long = (end - start).astype(np.float32)
    figures = np.stack([share(inside), share(_again(words)), share(three), share(long) / 10, share((long > 20).astype(np.float32)), np.log1p(per) / 5,
                        np.full(m, np.log1p(len(words)) / 10, dtype=np.float32)], axis=1)
    return np.hstack([np.sqrt(count / np.maximum(1, count.sum(axis=1, keepdims=True))), figures]).astype(np.float32)


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class AttentionModel:
    """``p(label 1) = sigmoid(z c + d)`` with ``z`` the attention-weighted sum of ``h = tanh(x W + b)`` over the passages of a document."""

    def __init__(self, constant: float | None = None):
        rng = np.random.default_rng(SEED)
        shape = {"W": (N_FEATURES, HIDDEN), "b": (HIDDEN,), "V": (HIDDEN, GATE), "U": (HIDDEN, GATE), "w": (GATE,), "c": (HIDDEN,), "d": ()}
        self.p = {k: rng.normal(0, 0.3 / np.sqrt(max(1, s[0] if s else 1)) * 3, s) if k not in "bd" else np.zeros(s) for k, s in shape.items()}
        self.constant = constant

    def forward(self, x: np.ndarray, starts: np.ndarray):
        p, sizes = self.p, np.diff(np.append(starts, len(x)))
        of = np.repeat(np.arange(len(starts)), sizes)
        h = np.tanh(x @ p["W"] + p["b"])
        t, s = np.tanh(h @ p["V"]), _sigmoid(h @ p["U"])
        e = (t * s) @ p["w"]
        e = np.exp(e - np.maximum.reduceat(e, starts)[of])
        a = e / np.add.reduceat(e, starts)[of]
        z = np.add.reduceat(a[:, None] * h, starts, axis=0)
        return of, h, t, s, a, z, _sigmoid(z @ p["c"] + p["d"])

    def score(self, x: np.ndarray, starts: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(starts), self.constant)
        return self.forward(x, starts)[-1]

    def gradients(self, x, starts, y) -> dict:
        p = self.p
        of, h, t, s, a, z, out = self.forward(x, starts)
        g = (out - y) / len(y)
        dz = g[:, None] * p["c"]
        da = (dz[of] * h).sum(axis=1)
        de = a * (da - np.add.reduceat(a * da, starts)[of])
        dt, ds = de[:, None] * p["w"] * s * (1 - t * t), de[:, None] * p["w"] * t * s * (1 - s)
        dh = (a[:, None] * dz[of] + dt @ p["V"].T + ds @ p["U"].T) * (1 - h * h)
        return {"W": x.T @ dh + DECAY * p["W"], "b": dh.sum(axis=0), "V": h.T @ dt, "U": h.T @ ds, "w": (t * s).T @ de, "c": z.T @ g, "d": g.sum()}

    def fit(self, bags: list[np.ndarray], y: np.ndarray) -> "AttentionModel":
        rng = np.random.default_rng(SEED)
        first = {k: np.zeros_like(v) for k, v in self.p.items()}
        second, step = {k: np.zeros_like(v) for k, v in self.p.items()}, 0
        for _ in range(EPOCHS):
            order = rng.permutation(len(bags))
            for i in range(0, len(order), BATCH):
                part = order[i: i + BATCH]
                sizes = np.array([len(bags[j]) for j in part])
                g, step = self.gradients(np.vstack([bags[j] for j in part]), np.cumsum(sizes) - sizes, y[part]), step + 1
                for k, v in g.items():
                    first[k] = 0.9 * first[k] + 0.1 * v
                    second[k] = 0.999 * second[k] + 0.001 * v * v
                    self.p[k] = self.p[k] - RATE * (first[k] / (1 - 0.9 ** step)) / (np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-8)
        return self


def held_out(doc_id):
    """Rows kept for testing: a quarter, by a checksum of the id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality", max_docs: int = TRAIN_DOCS) -> AttentionModel:
    """Fit on at most ``max_docs`` labelled documents outside the held-out quarter, taken in the order of a hash of the id."""
    known = labels.select(F.col(doc_id).alias("_id"), F.col(label).cast("double").alias("_y")).filter("_id is not null and _y is not null").filter(~held_out(F.col("_id")))
    known = known.groupBy("_id").agg(F.min("_y").alias("_y"))
    known = known.orderBy(F.xxhash64("_id"), "_id").limit(max_docs)
    texts = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text"))

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        powers = Powers()
        for b in batches:
            bags = [encode_passages(t, powers) for t in b["_text"]]
            bags = [x[np.linspace(0, len(x) - 1, TRAIN_PASSAGES).astype(int)] if len(x) > TRAIN_PASSAGES else x for x in bags]
            yield pd.DataFrame({"_id": b["_id"], "_y": b["_y"], "_x": [x.astype(np.float32).tobytes() for x in bags]})

    # at most max_docs rows of two numbers: a bounded side
    sample = texts.join(F.broadcast(known), "_id").select("_id", "_y", "_text").mapInPandas(encode, f"_id {dict(texts.dtypes)['_id']}, _y double, _x binary")
    rows = sorted({(r["_id"], r["_y"], bytes(r["_x"])) for r in sample.collect()})
    y = np.array([r[1] for r in rows])
    if len(set(y)) < 2:
        return AttentionModel(constant=float((y.sum() + 1) / (len(y) + 2)))
    return AttentionModel().fit([np.frombuffer(r[2], dtype=np.float32).reshape(-1, N_FEATURES).astype(np.float64) for r in rows], y)


def score(docs: DataFrame, model: AttentionModel, text: str = "text", threshold: float = 0.7) -> DataFrame:
    """Add ``score`` (0 to 1) and ``predicted`` (1 where the score is at least ``threshold``) to every row."""
    small_batches(docs)
    @pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        powers = Powers()
        for b in batches:
            out = np.zeros(len(b))
            for i, t in enumerate(b):
                out[i] = model.score(encode_passages(t, powers).astype(np.float64), np.zeros(1, dtype=np.int64))[0]
            yield pd.Series(out)

    return docs.withColumn("score", scored(F.col(text))).withColumn("predicted", (F.col("score") >= threshold).cast("int"))
