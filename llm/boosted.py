"""Operator 9: a quality classifier of histogram gradient-boosted trees.

Features are numbers about one whole text (shares, lengths, repeats); language, source, id and labels are
no inputs.  Training takes at most ``MAX_TRAIN`` labelled documents (a bounded sample in the order of a hash of
the id; only their features reach the driver), cuts each feature into at most ``BINS`` bins at quantiles, and
grows each tree level by level from histograms of gradients and second derivatives.  A grown forest is a few
flat arrays with a row per tree; scoring walks all trees of a batch of documents at once in numpy,
``DEPTH`` steps each.

Defined cases: null and empty texts have features (zeros) and so a score; repeated rows score alike; an id in several
rows trains with one of them (the least hash of its text); labels
with a null id or label are left out, and an id labelled twice takes the mean, at least one half being 1;
with no labels, or labels of one kind only, every score is the smoothed share of label 1; an empty table gives
no rows; other columns are not read, and ``classifier_filter`` keeps them.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from llm.shared import bounded_batches
from llm.textstats import char_features, text_stats

MAX_TRAIN = 20_000        # bound of the training sample
TREES, DEPTH, BINS = 60, 4, 64
RATE, RIDGE, LEAST_WEIGHT = 0.15, 2.0, 5.0
KEEP_AT = 0.3             # predicted 1 from this score on
FOLDS = 5                 # crc32(id as text) mod 5 = 0 is held out


def features(text: str | None) -> list[float]:
    """Numbers about one text; none depends on the order of rows or on other texts."""
    n, chars, symbols, lines, dup, again, unique, adjacent = text_stats(text)
    words = max(n, 1)
    return [float(np.log1p(n)), chars / words, symbols / max(chars, 1), dup / max(lines, 1), again / words,
            unique / words, unique / words ** 0.75, adjacent / words, n / max(lines, 1), *char_features(text)]


def feature_matrix(texts) -> np.ndarray:
    return np.asarray([features(t) for t in texts], np.float64) if len(texts) else np.empty((0, len(features(None))))


@dataclass
class Forest:
    """Complete binary trees, a row each: node ``i`` has children ``2i+1`` and ``2i+2``; a node without a split
    sends everything left."""
    base: float
    feature: np.ndarray       # trees x inner nodes
    cut: np.ndarray           # trees x inner nodes: left if value <= cut
    value: np.ndarray         # trees x leaves

    def raw(self, x: np.ndarray) -> np.ndarray:
        if not len(self.feature):
            return np.full(len(x), self.base)
        tree = np.arange(len(self.feature))[None, :]
        node = np.zeros((len(x), len(self.feature)), np.int64)
        row = np.arange(len(x))[:, None]
        for _ in range(DEPTH):
            node = 2 * node + 1 + (x[row, self.feature[tree, node]] > self.cut[tree, node])
        return self.base + self.value[tree, node - self.feature.shape[1]].sum(axis=1)

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.raw(x)))


def train(x: np.ndarray, y: np.ndarray, trees: int = TREES, bins: int = BINS) -> Forest:
    """Logistic loss, second-order gains, level by level."""
    n, inner = len(y), 2 ** DEPTH - 1
    base = float(np.log((y.sum() + 1) / (n - y.sum() + 1))) if n else 0.0
    empty = Forest(base, np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, inner + 1)))
    if n == 0 or y.min() == y.max():
        return empty
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1], method="lower")) for j in range(x.shape[1])]
    width = max(map(len, cuts)) + 1
    binned = np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)], axis=1)
    cells = binned + np.arange(x.shape[1]) * width
    feature, cut = np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf)
    value, raw = np.zeros((trees, inner + 1)), np.full(n, base)
    size = x.shape[1] * width
    for t in range(trees):
        p = 1 / (1 + np.exp(-raw))
        g, h = p - y, np.maximum(p * (1 - p), 1e-6)
        node = np.zeros(n, np.int64)
        for level in range(DEPTH):
            first, count = 2 ** level - 1, 2 ** level
            at = ((node - first)[:, None] * size + cells).ravel()
            hist = [np.bincount(at, np.repeat(w, x.shape[1]), count * size).reshape(count, -1, width) for w in (g, h)]
            gl, hl = (np.cumsum(a, axis=2) for a in hist)
            gt, ht = gl[:, :1, -1:], hl[:, :1, -1:]
            gain = gl ** 2 / (hl + RIDGE) + (gt - gl) ** 2 / (ht - hl + RIDGE) - gt ** 2 / (ht + RIDGE)
            gain[(hl < LEAST_WEIGHT) | (ht - hl < LEAST_WEIGHT)] = 0
            best = gain.reshape(count, -1).argmax(axis=1)
            for k, b in enumerate(best):
                j, at_bin = divmod(int(b), width)
                if gain[k, j, at_bin] > 1e-9 and at_bin < len(cuts[j]):
                    feature[t, first + k], cut[t, first + k] = j, cuts[j][at_bin]
            node = 2 * node + 1 + (x[np.arange(n), feature[t, node]] > cut[t, node])
        leaf = node - inner
        value[t] = -RATE * np.bincount(leaf, g, inner + 1) / (np.bincount(leaf, h, inner + 1) + RIDGE)
        raw = raw + value[t][leaf]
    return Forest(base, feature, cut, value)


def held_out(key: str) -> Column:
    return F.crc32(F.col(f"`{key}`").cast("string")) % FOLDS == 0


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality",
        most: int = MAX_TRAIN) -> Forest:
    """Train on at most ``most`` labelled documents that are not held out.  Only the ids of the sample (a bounded
    number, broadcast) reach the scan of the documents, and only features and labels reach the driver, a row an id."""
    spark = docs.sparkSession
    bounded_batches(spark)
    known = (labels.filter(F.col(f"`{key}`").isNotNull() & F.col(f"`{label}`").isNotNull() & ~held_out(key))
             .groupBy(F.col(f"`{key}`").cast("long").alias("_k"))
             .agg((F.avg(F.col(f"`{label}`")) >= 0.5).cast("int").alias("_y")))
    sample = known.orderBy(F.xxhash64("_k"), "_k").limit(most)      # at most ``most`` narrow rows
    vector = F.pandas_udf(lambda s: pd.Series(list(feature_matrix(s))), "array<double>")
    rows = (docs.select(F.col(f"`{key}`").cast("long").alias("_k"), F.col(f"`{text}`").cast("string").alias("_t"))
            .join(F.broadcast(sample), "_k").select("_k", "_y", vector("_t").alias("_x"), F.xxhash64("_t").alias("_h")))
    # one row an id, however many rows of the table repeat it
    one = rows.groupBy("_k").agg(F.min_by(F.struct("_y", "_x"), "_h").alias("_one")).select("_k", "_one.*")
    found = sorted(one.collect(), key=lambda r: r["_k"])
    x = np.asarray([r["_x"] for r in found], np.float64) if found else feature_matrix([])
    return train(x, np.asarray([r["_y"] for r in found], np.float64))


def scorer(forest: Forest):
    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(forest.score(feature_matrix(texts)) if len(texts) else [], dtype="float64")
    return score


def score_documents(docs: DataFrame, forest: Forest, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, held_out, score, predicted`` of every document; the forest (a few KB) goes with the task."""
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col(f"`{key}`"), F.coalesce(held_out(key), F.lit(False)).alias("held_out"),
                       scorer(forest)(F.col(f"`{text}`").cast("string")).alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= KEEP_AT).cast("int"))


def classifier_filter(docs: DataFrame, forest: Forest, text: str = "text") -> DataFrame:
    """The documents predicted 1, with all their columns."""
    bounded_batches(docs.sparkSession)
    return docs.filter(scorer(forest)(F.col(f"`{text}`").cast("string")) >= KEEP_AT)


def is_held_out(key) -> bool:
    """``held_out`` of one id, for tests."""
    return zlib.crc32(str(key).encode()) % FOLDS == 0
