"""Quality classifier: histogram gradient-boosted trees over document statistics (op 8).

The statistics of a text come from its byte histogram and its words and lines.
Trees are fitted on a bounded sample of labelled rows, flattened into arrays and
traversed for a whole Arrow batch at a time.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ship_package, text_or_empty

#: Most labelled rows that are collected to fit the trees; they are the rows
#: with the smallest hash of doc_id, so the choice is stable.
MAX_TRAIN_ROWS = 20_000
BINS, DEPTH, TREES, RATE, L2, MIN_LEAF = 48, 4, 60, 0.15, 1.0, 20.0
THRESHOLD = 0.3

_BYTE_CLASSES = [
    b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" ", b"\n", b"\t\r",
    b".", b",", b"!?", b"#", b"$", b"%", b"&", b"*", b"|", b"'\"`", b"()[]{}<>", b"-_/\\", b"@+=~^:;",
    bytes(range(128, 192)), bytes(range(192, 256)),
]
_CLASS = np.zeros((256, len(_BYTE_CLASSES)))
for _i, _b in enumerate(_BYTE_CLASSES):
    _CLASS[np.frombuffer(_b, np.uint8), _i] = 1.0
N_FEATURES = len(_BYTE_CLASSES) + 9


def statistics(texts) -> np.ndarray:
    """One row of document statistics per text; NULL counts as empty."""
    out = np.zeros((len(texts), N_FEATURES))
    hist = np.zeros((len(texts), 256))
    for i, t in enumerate(texts):
        if not t:
            continue
        raw = np.frombuffer(t.encode("utf-8", "replace"), np.uint8)
        hist[i] = np.bincount(raw, minlength=256)
        words, lines = t.split(), t.split("\n")
        n, distinct = max(len(words), 1), set(words)
        lens = list(map(len, words)) or [0]
        out[i, :9] = (
            np.log1p(len(t)), sum(lens) / n, max(lens), len(distinct) / n, len(distinct) / n**0.75,
            sum(map(str.isalpha, distinct)) / max(len(distinct), 1), len(t) / len(lines),
            len(set(lines)) / len(lines), sum(map(str.isupper, distinct)) / max(len(distinct), 1),
        )
    total = np.maximum(hist.sum(axis=1, keepdims=True), 1.0)
    out[:, 9:] = hist @ _CLASS / total
    return out


@dataclass
class Trees:
    """Flattened complete trees: node i of a tree has children 2i+1 and 2i+2;
    a node that isn't split has an infinite threshold and passes its rows left."""

    base: float
    feature: np.ndarray  # trees x (2**DEPTH - 1)
    threshold: np.ndarray
    leaf: np.ndarray  # trees x 2**DEPTH

    def score(self, x: np.ndarray) -> np.ndarray:
        margin = np.full(len(x), self.base)
        rows, inner = np.arange(len(x)), self.feature.shape[1]
        for f, t, leaf in zip(self.feature, self.threshold, self.leaf):
            node = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (x[rows, f[node]] > t[node])
            margin += leaf[node - inner]
        return 1.0 / (1.0 + np.exp(-margin))


def fit_trees(x: np.ndarray, y: np.ndarray) -> Trees:
    """Boosted trees by logistic loss on binned features, grown level by level.
    Without rows the score is 0.5; with one class it is that class's smoothed rate."""
    inner, leaves = 2**DEPTH - 1, 2**DEPTH
    p = (y.sum() + 1.0) / (len(y) + 2.0)
    base = float(np.log(p / (1 - p)))
    if len(y) == 0 or y.min() == y.max():
        return Trees(base, np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, leaves)))
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
    binned = np.stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T)], axis=1)
    k = x.shape[1]
    offset = binned + np.arange(k) * BINS
    margin = np.full(len(y), base)
    feats, cuts, outs = [], [], []
    for _ in range(TREES):
        prob = 1 / (1 + np.exp(-margin))
        g, h = prob - y, prob * (1 - prob)
        feature, cut = np.zeros(inner, np.int64), np.full(inner, np.inf)
        node = np.zeros(len(y), np.int64)
        for depth in range(DEPTH):
            first, width = 2**depth - 1, 2**depth
            at = ((node - first)[:, None] * (k * BINS) + offset).ravel()
            gs = np.bincount(at, np.repeat(g, k), width * k * BINS).reshape(width, k, BINS).cumsum(axis=2)
            hs = np.bincount(at, np.repeat(h, k), width * k * BINS).reshape(width, k, BINS).cumsum(axis=2)
            ns = np.bincount(at, minlength=width * k * BINS).reshape(width, k, BINS).cumsum(axis=2)
            gt, ht, nt = gs[:, :, -1:], hs[:, :, -1:], ns[:, :, -1:]
            gain = gs**2 / (hs + L2) + (gt - gs) ** 2 / (ht - hs + L2) - gt**2 / (ht + L2)
            gain[(ns < MIN_LEAF) | (nt - ns < MIN_LEAF)] = 0.0
            best = gain.reshape(width, -1).argmax(axis=1)
            for j in range(width):
                f, b = divmod(int(best[j]), BINS)
                if gain[j, f, b] > 1e-6 and b < len(edges[f]):
                    feature[first + j], cut[first + j] = f, edges[f][b]
            node = 2 * node + 1 + (x[np.arange(len(y)), feature[node]] > cut[node])
        leaf = node - inner
        value = -RATE * np.bincount(leaf, g, leaves) / (np.bincount(leaf, h, leaves) + L2)
        margin += value[leaf]
        feats.append(feature)
        cuts.append(cut)
        outs.append(value)
    return Trees(base, np.array(feats), np.array(cuts), np.array(outs))


def held_out(doc_id: str = "doc_id") -> Column:
    """True for the fifth of ids that no fit may use; a NULL id is held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(True))


def fit_quality(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
                label: str = "quality", max_rows: int = MAX_TRAIN_ROWS) -> Trees:
    """Trees fitted on at most ``max_rows`` labelled rows that aren't held out.

    NULL ids and labels are skipped. The label sample (two numbers a row, at
    most ``max_rows``) is broadcast, so texts aren't shuffled; the statistics
    are computed on the executors and only they come to the driver."""
    ship_package(docs.sparkSession)
    order = F.xxhash64("i", "y")
    sample = (
        labels.select(F.col(doc_id).alias("i"), F.col(label).cast("int").alias("y"))
        .where(F.col("i").isNotNull() & F.col("y").isNotNull() & ~held_out("i"))
        .orderBy(order, "i", "y").limit(max_rows)
    )
    d = docs.select(F.col(doc_id).alias("i"), text_or_empty(text).alias("t"))
    stats = d.join(F.broadcast(sample), "i").select("i", "y", _statistics_udf()("t").alias("x"))
    rows = stats.orderBy(order, "i", "y", F.xxhash64("x")).limit(max_rows).toPandas()
    x = np.array(rows["x"].tolist(), dtype=float).reshape(len(rows), N_FEATURES)
    return fit_trees(x, (rows["y"].to_numpy(dtype=float) > 0).astype(float))


def _statistics_udf():
    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def stats(texts: pd.Series) -> pd.Series:
        return pd.Series(list(statistics(texts.tolist())))

    return stats


def score_udf(trees: Trees):
    """Column function text -> score; only the text goes to the Python workers."""

    @F.pandas_udf(T.DoubleType())
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(trees.score(statistics(texts.tolist())))

    return score


def score_quality(docs: DataFrame, trees: Trees, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` for every row, NULL and empty texts too."""
    ship_package(docs.sparkSession)
    d = docs.select(F.col(doc_id).alias("doc_id"), held_out(doc_id).alias("held_out"),
                    score_udf(trees)(text_or_empty(text)).alias("score"))
    return d.withColumn("predicted", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0))


def keep_quality(docs: DataFrame, trees: Trees, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` (all columns as they are) that score at least ``threshold``."""
    ship_package(docs.sparkSession)
    kept = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"),
                       score_udf(trees)(text_or_empty(docs[text])).alias("score"))
    return kept.where(F.col("score") >= threshold).select("row.*")
