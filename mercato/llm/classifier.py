"""Quality classifier: histogram gradient-boosted trees over statistics of the text.

The statistics of every whole text are computed once on the executors. A sample
of labelled rows of bounded size (``SAMPLE_ROWS``, chosen by a hash of the id)
trains the trees: features are binned by quantiles, each level's histograms of
gradients are one ``bincount``, and the finished trees are complete binary heaps
in flat arrays, which numpy traverses for many rows and all trees at once.

Null and empty texts have statistics of zero and a score of their own. Without
labels every score is 0.5. Rows that repeat are scored each.
"""

from __future__ import annotations

from collections.abc import Iterator
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, slices, staged, texts_of

#: Labelled rows that train the trees, about: the sample's bound.
SAMPLE_ROWS = 20_000
TREES, DEPTH, BINS = 60, 4, 64
RATE, PENALTY = 0.2, 1.0
THRESHOLD = 0.3

_UPPER, _LOWER_CASE, _DIGIT = (np.array([chr(b) in s for b in range(256)]) for s in (
    "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"))
_CLASSES = np.stack(
    [
        _UPPER, _LOWER_CASE, _DIGIT, np.arange(256) >= 0x80,
        *(np.isin(np.arange(256), [ord(c) for c in s]) for s in (" ", "\n", ".", ",", "!", "|", "#*$%&", "?;:", "<>{}[]()/\\=_", "\"'-")),
    ], axis=1,
).astype(np.float64)
N_FEATURES = _CLASSES.shape[1] + 10


def statistics(text: str | None) -> np.ndarray:
    """Shares of character classes, and shapes of words and lines."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    out = np.zeros(N_FEATURES)
    if not raw:
        return out
    k = _CLASSES.shape[1]
    out[:k] = np.bincount(np.frombuffer(raw, np.uint8), minlength=256) @ _CLASSES / len(raw)
    words = raw.split()
    lines = [x for x in raw.split(b"\n") if x.strip()]
    if not words:
        return out
    n = len(words)
    sizes = np.fromiter(map(len, words), np.int64, n)
    out[k:] = (
        np.log1p(n), sizes.mean(), sizes.max(), sizes.std(),
        len(set(words)) / n ** 0.9, sum(map(eq, words, words[1:])) / n,
        len(lines) / n, 1 - len(set(lines)) / len(lines),
        raw.count(b". ") / n, raw.count(b"\n") / n,
    )
    return out


def measured(docs: DataFrame) -> DataFrame:
    """Staged ``doc_id, features array<double>`` for each row of ``docs``."""
    bounded_batches(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            values = np.concatenate([statistics(t) for t in texts_of(batch)])
            at = pa.array(np.arange(len(batch) + 1) * N_FEATURES, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.ListArray.from_arrays(at, pa.array(values))], names=["doc_id", "features"]
            )

    return staged(docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, features array<double>"), "features")


def fit(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, bins: int = BINS) -> dict:
    """Boosted trees for labels 0 and 1: node i of a tree has its children at 2 i + 1 and 2 i + 2."""
    n, k = x.shape
    prior = float(np.clip(y.mean(), 1e-3, 1 - 1e-3))
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(k)]
    binned = np.stack([np.searchsorted(e, x[:, f], "left") for f, e in enumerate(edges)], axis=1)
    inner, leaves = 2**depth - 1, 2**depth
    model = {
        "base": np.log(prior / (1 - prior)), "depth": depth,
        "feature": np.zeros((trees, inner), np.int32), "threshold": np.full((trees, inner), np.inf),
        "value": np.zeros((trees, leaves)),
    }
    score = np.full(n, model["base"])
    column = np.arange(k) * bins
    for t in range(trees):
        p = 1 / (1 + np.exp(-score))
        grad, hess = y - p, p * (1 - p)
        node = np.zeros(n, np.int64)
        for level in range(depth):
            width = 2**level
            cell = (node[:, None] * (k * bins) + column + binned).ravel()
            g, h = (
                np.bincount(cell, np.repeat(v, k), width * k * bins).reshape(width, k, bins).cumsum(axis=2)
                for v in (grad, hess)
            )
            whole_g, whole_h = g[:, :1, -1:], h[:, :1, -1:]
            gain = g**2 / (h + PENALTY) + (whole_g - g) ** 2 / (whole_h - h + PENALTY) - whole_g**2 / (whole_h + PENALTY)
            gain[(h < 1e-3) | (whole_h - h < 1e-3)] = 0
            best = gain.reshape(width, -1).argmax(axis=1)
            good = gain.reshape(width, -1)[np.arange(width), best] > 1e-6
            f, b = best // bins, best % bins
            cut = np.array([edges[i][j] if ok and j < len(edges[i]) else np.inf for i, j, ok in zip(f, b, good)])
            first = width - 1
            model["feature"][t, first : first + width], model["threshold"][t, first : first + width] = f, cut
            node = 2 * node + (x[np.arange(n), f[node]] > cut[node])
        total_g, total_h = np.bincount(node, grad, leaves), np.bincount(node, hess, leaves)
        model["value"][t] = RATE * total_g / (total_h + PENALTY)
        score += model["value"][t][node]
    return model


def score(model: dict | None, x: np.ndarray) -> np.ndarray:
    """Probability of label 1 of each row."""
    if model is None:
        return np.full(len(x), 0.5)
    trees = np.arange(len(model["value"]))
    at = np.zeros((len(x), len(trees)), np.int64)
    for _ in range(model["depth"]):
        f, cut = model["feature"][trees, at], model["threshold"][trees, at]
        at = 2 * at + 1 + (np.take_along_axis(x, f, axis=1) > cut)
    leaf = at - (2 ** model["depth"] - 1)
    return 1 / (1 + np.exp(-(model["base"] + model["value"][trees, leaf].sum(axis=1))))


def train(measures: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> dict | None:
    """Trees from labelled rows, about ``rows`` of them, by the hash of their id; null labels are left out."""
    known = labels.where("doc_id is not null and quality is not null").select(
        "doc_id", F.col("quality").cast("double").alias("label")
    )
    n = known.count()
    if not n:
        return None
    place = F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    chosen = known.where(place < rows / n)
    found = measures.join(chosen, "doc_id").select("features", "label").limit(2 * rows).collect()
    if not found:
        return None
    return fit(np.array([r["features"] for r in found]), np.array([r["label"] for r in found]))


def scored(measures: DataFrame, model: dict | None) -> DataFrame:
    """``doc_id, score`` from statistics."""
    shared = measures.sparkSession.sparkContext.broadcast(model)
    kind = measures.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("features").flatten().to_numpy().reshape(-1, N_FEATURES)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(score(shared.value, x))], names=["doc_id", "score"]
            )

    return measures.select("doc_id", "features").mapInArrow(run, f"doc_id {kind}, score double")


def remainder(mod: int):
    """crc32 of the id's decimal text modulo ``mod``; null ids count as empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % mod


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted``; rows with remainder 0 of 5 are held out."""
    measures = measured(docs)
    model = train(measures, labels.where(remainder(5) != 0))
    return scored(measures, model).select(
        "doc_id", (remainder(5) == 0).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )
