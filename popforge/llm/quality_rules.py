"""Quality rules with an isolation forest over their statistics.

Rule statistics come from each whole text. Two rules are fixed (base_failed); beyond them an isolation forest
finds documents whose statistics are anomalous: trees split random features at random values, and documents
that few splits isolate score high. Forests are grown on at most SAMPLE_DOCS documents (those with the smallest
id hashes), one for each number in SUBSAMPLES of rows a tree: small trees see through clusters of anomalies, large
ones tell finer differences. The forest, and the score above which a document goes, are calibrated on all labelled
rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from popforge.llm.shared import map_rows, thinned, written
from popforge.llm.textarrays import encode

SAMPLE_DOCS, TREES, SUBSAMPLES, SEED = 20_000, 100, (256, 128, 64, 32), 11
MOST_GOOD_LOST, GOOD_WEIGHT = 0.002, 10
#: Score histogram bins of the calibration.
BINS = 1000
_SPACES, _SYMBOLS = " \t\n\v\f\r", "#*$%&|<>"
STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_stops"]
_FIELDS = ", ".join(f"{c} long" for c in STATS)


def repeat_words(words: list[bytes]) -> int:
    """Words that lie in a 3-word window found at least twice."""
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    counts = Counter(windows)
    total = upto = 0
    for i, w in enumerate(windows):
        if counts[w] > 1:
            total += i + 3 - max(i, upto)
            upto = i + 3
    return total


def statistics(text: str | None) -> tuple[int, ...]:
    """STATS of a text; null is empty."""
    text = text or ""
    words = encode(text).split()
    lines = [line for line in text.split("\n") if line.strip(_SPACES)]
    return (
        len(words),
        len(text) - sum(text.count(c) for c in _SPACES),
        sum(text.count(c) for c in _SYMBOLS),
        len(lines) - len(set(lines)),
        repeat_words(words),
        len(lines),
        text.count(".") + text.count(","),
    )


def feature_matrix(stats: pd.DataFrame) -> np.ndarray:
    """Scale-free forest features of the statistics: shares a word or a line, square roots of those that are
    mostly small, r / (r + 0.5) of the stops a word, which have a long tail: each grows with its share everywhere.
    Documents without words are all zeros."""
    n = np.maximum(stats["n_words"].to_numpy(float), 1)
    lines = np.maximum(stats["n_lines"].to_numpy(float), 1)
    ratio = lambda c, d: stats[c].to_numpy(float) / d
    stops = ratio("n_stops", n)
    return np.stack([ratio("word_chars", n), np.sqrt(ratio("n_symbols", n)), np.sqrt(ratio("n_dup_lines", lines)), np.sqrt(ratio("n_repeat_words", n)), stops / (stops + 0.5)], axis=1)


def average_path(n: float) -> float:
    """Mean path length of an unsuccessful search in a binary tree of n."""
    return 0.0 if n < 2 else 1.0 if n < 3 else 2 * (np.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n


class IsolationForest:
    """Trees as heap-ordered arrays: feature and cut of inner nodes, path length of leaves (inner: -1)."""

    def __init__(self, rows: np.ndarray, trees: int = TREES, subsample: int = SUBSAMPLES[0], seed: int = SEED):
        rng = np.random.default_rng(seed)
        size = min(subsample, len(rows))
        self.depth = max(1, int(np.ceil(np.log2(max(size, 2)))))
        self.norm = max(average_path(size), 1e-9)
        nodes = 2 ** (self.depth + 1) - 1
        self.feature, self.cut, self.path = np.zeros((trees, nodes), int), np.zeros((trees, nodes)), np.full((trees, nodes), -1.0)
        for t in range(trees):
            self._grow(rng, rows[rng.choice(len(rows), size, replace=False)], t, 0, 0)

    def _grow(self, rng: np.random.Generator, rows: np.ndarray, t: int, node: int, depth: int) -> None:
        low, high = (rows.min(0), rows.max(0)) if len(rows) else (np.zeros(1), np.zeros(1))
        split = np.flatnonzero(high > low)
        if depth == self.depth or len(rows) < 2 or not len(split):
            self.path[t, node] = depth + average_path(len(rows))
            return
        f = rng.choice(split)
        self.feature[t, node], self.cut[t, node] = f, rng.uniform(low[f], high[f])
        left = rows[:, f] < self.cut[t, node]
        self._grow(rng, rows[left], t, 2 * node + 1, depth + 1)
        self._grow(rng, rows[~left], t, 2 * node + 2, depth + 1)

    def scores(self, rows: np.ndarray) -> np.ndarray:
        """Anomaly scores 2**(-mean path / expected path), 0 to 1."""
        total = np.zeros(len(rows))
        at = np.arange(len(rows))
        for t in range(len(self.path)):
            node = np.zeros(len(rows), int)
            for _ in range(self.depth):
                inner = self.path[t, node] < 0
                node = np.where(inner, 2 * node + 1 + (rows[at, self.feature[t, node]] >= self.cut[t, node]), node)
            total += self.path[t, node]
        return 2.0 ** (-total / len(self.path) / self.norm)


def _stats(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        yield pd.concat([pdf[["doc_id"]], pd.DataFrame([statistics(t) for t in pdf["text"]], columns=STATS, index=pdf.index)], axis=1)


def measured(docs: DataFrame) -> DataFrame:
    """doc_id and STATS of each row of docs(doc_id, text), written; the texts are read this once."""
    return written(map_rows(docs.select("doc_id", "text"), _stats, f"doc_id long, {_FIELDS}"))


def fit(stats: DataFrame, sample_docs: int = SAMPLE_DOCS) -> list[IsolationForest]:
    """Forests from measured(), one for each of SUBSAMPLES; none where no document has a word."""
    rows = thinned(stats.where("n_words > 0"), sample_docs, "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id", *STATS).limit(sample_docs).toPandas()
    return [IsolationForest(feature_matrix(rows), subsample=n) for n in SUBSAMPLES] if len(rows) else []


def scored(rows: DataFrame, forests: list[IsolationForest]) -> DataFrame:
    """rows of measured(), their other columns kept, with `scores`, one for each forest; 0 without words."""
    shared = rows.sparkSession.sparkContext.broadcast(forests)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            x, some = feature_matrix(pdf), (pdf["n_words"] > 0).to_numpy()
            yield pdf.assign(scores=list(np.stack([np.where(some, f.scores(x), 0.0) for f in shared.value], axis=1)) if shared.value else [[]] * len(pdf))

    fields = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in rows.columns)
    return map_rows(rows, run, f"{fields}, scores array<double>")


def base_failed():
    return (F.col("n_words") < 50) | (F.lit(100) * F.col("n_repeat_words") > F.lit(50) * F.col("n_words"))


def best_cut(good: np.ndarray, bad: np.ndarray, most_good_lost: float) -> tuple[float, float]:
    """Worth and score of the best cut through histograms of scores: of the cuts that lose at most that share of good
    documents, those with the most caught, a good one lost counting as GOOD_WEIGHT; of equals the middle."""
    lost, caught = good[::-1].cumsum()[::-1], bad[::-1].cumsum()[::-1]
    value = np.where(lost <= most_good_lost * good.sum(), caught - GOOD_WEIGHT * lost, 0)
    best = np.flatnonzero(value == value.max())
    return float(value.max()), float(best[len(best) // 2]) / BINS


def calibrated(stats: DataFrame, labels: DataFrame, forests: list[IsolationForest], most_good_lost: float = MOST_GOOD_LOST) -> tuple[int, float]:
    """The forest that parts good from bad labelled documents (quality 1 and 0) that pass the base rules best, the first
    of equals, and its cut. Infinite (keep all) without labels of both sorts or where no cut catches more than it loses."""
    labelled = labels.where(F.col("quality").isNotNull()).groupBy("doc_id").agg(F.max("quality").cast("int").alias("quality"))
    rows = scored(stats.where(~base_failed()).join(labelled, "doc_id"), forests)
    bins = rows.select("quality", F.posexplode("scores").alias("forest", "score")).groupBy("forest", F.floor(F.col("score") * BINS).alias("bin"), "quality").count().toPandas()
    counts = np.zeros((len(forests), 2, BINS + 2))
    for forest, score_bin, quality, n in bins.itertuples(index=False):
        counts[forest, int(quality == 1), int(score_bin)] += n
    if not len(forests) or not (counts.sum(axis=(0, 2)) > 0).all():
        return 0, float("inf")
    cuts = [best_cut(good, bad, most_good_lost) for bad, good in counts]
    first = max(range(len(cuts)), key=lambda k: (cuts[k][0], -k))
    return first, cuts[first][1] if cuts[first][0] > 0 else float("inf")


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, STATS, score, base_failed, kept for each row of docs(doc_id, text); labels(doc_id, quality).

    Null and empty texts have no words and fail. Repeated rows fare alike. Without labels only the base rules judge.
    """
    stats = measured(docs)
    forests = fit(stats)
    forest, cut = calibrated(stats, labels, forests)
    rows = scored(stats, forests[forest : forest + 1])
    score = F.coalesce(F.get("scores", F.lit(0)), F.lit(0.0))
    rows = rows.select("doc_id", *STATS, score.alias("score"), base_failed().alias("base_failed"))
    return rows.withColumn("kept", ~F.col("base_failed") & (F.col("score") < F.lit(cut)))
