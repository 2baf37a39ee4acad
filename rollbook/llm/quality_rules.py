"""Quality rules with an isolation forest over the rule statistics.

``rule_statistics`` measures every whole text. ``fit_forest`` grows random trees on a bounded sample; a document that random splits
isolate on a short path is an anomaly. ``calibrate`` takes the lowest cut of the anomaly score that gives up at most a stated share of the
documents that the labels call good, over all labelled rows. A document is kept if the fixed limits hold and its score is under the cut.

Cases: a null or empty text has no words, so the fixed limits reject it; repeated rows get equal verdicts; null ids are carried; an empty
table gives an empty table; without labelled rows nothing is an anomaly; columns with the names of the results are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from .common import WORD, small_batches
from .quality_classifier import held_out

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_chars_seen", "n_lines", "n_unique_words", "n_upper", "longest_word")
FEATURES = ("symbols", "dup_lines", "repeats", "unique", "upper", "longest")
SYMBOLS = "#*$%&|<>"
#: Bounds of the forest: rows drawn on, trees, rows and levels of a tree. CLEAN_LOSS: share of good labelled documents that the cut may reject.
SAMPLE_ROWS, TREES, TREE_ROWS, LEVELS, SEED, CLEAN_LOSS, GRID = 8192, 100, 1024, 8, 11, 0.005, 4096


def text_counts(text: str | None) -> tuple:
    t = text or ""
    words, lines = WORD.findall(t), t.split("\n")
    n, repeats, seen, dup = len(words), 0, set(), 0
    known: dict[str, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in words), dtype=np.int64, count=n)
    if n > 3:
        pair = np.unique(ids[:-1] * len(known) + ids[1:], return_inverse=True)[1]
        _, of, count = np.unique(pair[:-1] * len(known) + ids[2:], return_inverse=True, return_counts=True)
        twice = np.flatnonzero(count[of] > 1)
        mark = np.zeros(n, dtype=bool)
        for k in range(3):
            mark[twice + k] = True
        repeats = int(mark.sum())
    for line in lines:
        if line in seen:
            dup += 1
        elif WORD.search(line):
            seen.add(line)
    raw = np.bincount(np.frombuffer(t.encode("utf-8", "surrogatepass"), dtype=np.uint8), minlength=256)
    lengths = list(map(len, words))
    return (n, sum(lengths), int(raw[[ord(c) for c in SYMBOLS]].sum()), dup, repeats, len(t), len(lines), len(known), int(raw[65:91].sum()), max(lengths, default=0))


def rule_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add the counts of ``COUNTS`` to every row."""
    small_batches(docs)
    @pandas_udf(", ".join(f"{c} long" for c in COUNTS))
    def counted(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame([text_counts(t) for t in b], columns=list(COUNTS), dtype="int64")

    return docs.withColumn("_counts", counted(F.col(text))).withColumns({c: F.col(f"_counts.{c}") for c in COUNTS}).drop("_counts")


def failed_limits() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def features(counts: pd.DataFrame) -> np.ndarray:
    c = {k: counts[k].to_numpy(dtype=np.float64) for k in COUNTS}
    words, chars, lines = np.maximum(1, c["n_words"]), np.maximum(1, c["n_chars_seen"]), np.maximum(1, c["n_lines"])
    return np.stack([c["n_symbols"] / chars, c["n_dup_lines"] / lines, c["n_repeat_words"] / words, c["n_unique_words"] / words, c["n_upper"] / chars,
                     np.log1p(c["longest_word"])], axis=1)


def _mean_path(n: float) -> float:
    """Mean path of an unsuccessful search in a binary tree of ``n`` rows."""
    return 0.0 if n <= 1 else 1.0 if n == 2 else 2 * (np.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n


class Forest:
    """Trees of random splits as arrays: node k has children 2k+1 and 2k+2; ``depth`` holds the path length of a leaf.

    Trees grow on rows that the labels call good. A split value is uniform over the node's box, not over its rows: the box starts as the range
    of all labelled rows and is cut by the splits above. A part of the box that good rows leave empty is so cut off on a short path."""

    def __init__(self, x: np.ndarray, low: np.ndarray, high: np.ndarray, trees: int = TREES, rows: int = TREE_ROWS, levels: int = LEVELS, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.rows, self.levels = min(rows, len(x)), levels
        size = 2 ** (levels + 1) - 1
        self.feature, self.cut, self.depth = np.full((trees, size), -1), np.zeros((trees, size)), np.zeros((trees, size))
        for t in range(trees):
            self._grow(rng, t, 0, 0, x[rng.choice(len(x), self.rows, replace=False)], low, high)

    def _grow(self, rng, t: int, node: int, level: int, x: np.ndarray, low: np.ndarray, high: np.ndarray) -> None:
        wide = np.flatnonzero(high > low)
        if level == self.levels or len(x) <= 1 or not len(wide):
            self.depth[t, node] = level + _mean_path(len(x))
            return
        f = int(rng.choice(wide))
        at = rng.uniform(low[f], high[f])
        self.feature[t, node], self.cut[t, node] = f, at
        left, low_right, high_left = x[:, f] < at, low.copy(), high.copy()
        low_right[f] = high_left[f] = at
        self._grow(rng, t, 2 * node + 1, level + 1, x[left], low, high_left)
        self._grow(rng, t, 2 * node + 2, level + 1, x[~left], low_right, high)

    def score(self, x: np.ndarray) -> np.ndarray:
        """Anomaly score, 0 to 1: near 1 for short paths."""
        total, rows = np.zeros(len(x)), np.arange(len(x))
        for t in range(len(self.feature)):
            node = np.zeros(len(x), dtype=np.int64)
            for _ in range(self.levels):
                f = self.feature[t, node]
                go = 2 * node + 1 + (x[rows, np.maximum(f, 0)] >= self.cut[t, node])
                node = np.where(f >= 0, go, node)
            total += self.depth[t, node]
        return 2 ** (-total / len(self.feature) / max(1e-9, _mean_path(self.rows)))


def fit_forest(labelled: DataFrame, doc_id: str = "doc_id", label: str = "quality", max_rows: int = SAMPLE_ROWS) -> Forest | None:
    """Grow the forest on at most ``max_rows`` labelled rows (those with the smallest hash of the id) that pass the fixed limits."""
    rows = labelled.filter(~failed_limits()).orderBy(F.xxhash64(doc_id), *COUNTS).select(label, *COUNTS).limit(max_rows).toPandas()
    good = rows[rows[label] == 1]
    if len(good) < 2:
        return None
    x = features(rows)
    return Forest(features(good), x.min(axis=0), x.max(axis=0))


def add_anomaly(stats: DataFrame, forest: Forest | None) -> DataFrame:
    if forest is None:
        return stats.withColumn("anomaly", F.lit(0.0))

    @pandas_udf("double")
    def scored(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        for b in batches:
            yield pd.Series(forest.score(features(b)))

    return stats.withColumn("anomaly", scored(F.struct(*COUNTS)))


def calibrate(scored: DataFrame, label: str = "quality", clean_loss: float = CLEAN_LOSS) -> float:
    """The lowest grid cut at or over which at most ``clean_loss`` of the good labelled rows lie. Counted over all rows given, on a grid of ``GRID`` steps."""
    counts = scored.filter(~failed_limits()).filter(F.col(label) == 1).groupBy(F.floor(F.col("anomaly") * GRID).alias("bin")).count().collect()  # at most GRID + 1 rows
    n = np.zeros(GRID + 2)
    for r in counts:
        n[r["bin"]] += r["count"]
    over = np.cumsum(n[::-1])[::-1]  # rows at or over each bin
    return float(np.flatnonzero(over <= clean_loss * n.sum())[0] / GRID) if n.sum() else 2.0


def apply_rules(docs: DataFrame, labels: DataFrame, keep_table, doc_id: str = "doc_id", text: str = "text", label: str = "quality", clean_loss: float = CLEAN_LOSS) -> DataFrame:
    """Statistics, ``anomaly``, ``base_failed`` and ``kept`` of every document. Forest and cut come from labelled rows outside the held-out quarter.

    ``keep_table`` stores the small statistics table, which is read three times."""
    stats = keep_table(rule_statistics(docs.select(F.col(doc_id), F.col(text)), text).drop(text))
    known = labels.select(F.col(doc_id), F.col(label).cast("int").alias("_label")).filter(F.col(doc_id).isNotNull() & F.col("_label").isNotNull()).filter(~held_out(F.col(doc_id)))
    labelled = stats.join(known.groupBy(doc_id).agg(F.min("_label").alias("_label")), doc_id)
    forest = fit_forest(labelled, doc_id, "_label")
    cut = calibrate(add_anomaly(labelled, forest), "_label", clean_loss)
    return (add_anomaly(stats, forest).withColumn("base_failed", failed_limits())
            .withColumn("kept", ~F.col("base_failed") & (F.col("anomaly") < cut)))
