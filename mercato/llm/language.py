"""Language identification: the family first, then one-versus-one linear SVMs inside it.

Features are counts of byte trigrams of the lower-cased letters, hashed to
``DIMENSIONS`` and square-rooted shares of the text's total, so every character
of the whole text counts. Training takes a bounded sample (``PER_LANGUAGE`` rows
of each language, chosen by a hash of the id); everything else runs over all
rows on the executors.

A null text, or one without letters, is ``und`` with score 0. Without any
labelled row all texts are ``und``. Rows that repeat are predicted each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, slices

DIMENSIONS = 4096
#: Training rows of each language, about: the sample's bound.
PER_LANGUAGE = 600
UNKNOWN = "und"
#: Families of languages; a language not named here is its own family.
FAMILIES = {
    "germanic": ("en", "de", "nl", "sv", "da", "no", "is"),
    "romance": ("fr", "es", "it", "pt", "ca", "ro"),
    "slavic": ("pl", "cs", "sk", "ru", "uk", "bg"),
}

_CLEAN = bytes(b if b >= 0x80 or chr(b).isalpha() else 32 for b in range(256))


def family_of(lang: str) -> str:
    return next((f for f, members in FAMILIES.items() if lang in members), lang)


def has_letter(text: str | None) -> bool:
    return any(c.isalpha() for c in text or "")


def features(text: str) -> np.ndarray:
    raw = b" " + text.lower().encode("utf-8", "surrogatepass").translate(_CLEAN) + b" "
    b = np.frombuffer(b" ".join(raw.split()) + b"  ", np.uint8).astype(np.uint32)
    code = (b[:-2] << np.uint32(16)) | (b[1:-1] << np.uint32(8)) | b[2:]
    slot = (code * np.uint32(2654435761)) >> np.uint32(20)
    counts = np.bincount(slot, minlength=DIMENSIONS).astype(np.float32)
    return np.sqrt(counts / counts.sum())


def train_svm(x: np.ndarray, y: np.ndarray, penalty: float = 1e-4, rounds: int = 300) -> tuple[np.ndarray, float]:
    """Weights and bias of a linear SVM (squared hinge loss) by accelerated gradient descent; y is -1 or 1."""
    share = np.where(y > 0, 0.5 / max((y > 0).sum(), 1), 0.5 / max((y < 0).sum(), 1)).astype(np.float32)
    w, b = np.zeros(x.shape[1], np.float32), 0.0
    v, c = w.copy(), 0.0
    step = 0.2
    for k in range(rounds):
        gap = np.maximum(0, 1 - y * (x @ v + c)).astype(np.float32)
        pull = 2 * share * gap * y
        w_new = v + step * (x.T @ pull - penalty * v)
        b_new = c + step * float(pull.sum())
        pace = k / (k + 3)
        v, c = w_new + pace * (w_new - w), b_new + pace * (b_new - b)
        w, b = w_new, b_new
    return w, b


def pairwise(x: np.ndarray, labels: np.ndarray) -> dict:
    """One-versus-one SVMs between all labels."""
    names = sorted(set(labels.tolist()))
    weights, bias, pairs = [], [], []
    for i, a in enumerate(names):
        for j in range(i + 1, len(names)):
            rows = np.isin(labels, [a, names[j]])
            w, b = train_svm(x[rows], np.where(labels[rows] == a, 1.0, -1.0).astype(np.float32))
            weights.append(w)
            bias.append(b)
            pairs.append((i, j))
    return {"names": names, "weights": np.array(weights).T, "bias": np.array(bias), "pairs": pairs}


def vote(model: dict, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Winning label number of each row and its score: its mean pairwise confidence."""
    n, k = len(x), len(model["names"])
    if k == 1:
        return np.zeros(n, int), np.ones(n)
    margin = x @ model["weights"] + model["bias"]
    sure = 1 / (1 + np.exp(-3 * margin.astype(np.float64)))
    total = np.zeros((n, k))
    votes = np.zeros((n, k))
    for p, (i, j) in enumerate(model["pairs"]):
        total[:, i] += sure[:, p]
        total[:, j] += 1 - sure[:, p]
        votes[:, i] += margin[:, p] > 0
        votes[:, j] += margin[:, p] <= 0
    best = np.argmax(votes * k + total, axis=1)  # most votes, then most confidence
    return best, total[np.arange(n), best] / (k - 1)


def train(x: np.ndarray, langs: np.ndarray) -> dict:
    families = np.array([family_of(x) for x in langs.tolist()])
    return {
        "family": pairwise(x, families),
        "within": {f: pairwise(x[families == f], langs[families == f]) for f in sorted(set(families.tolist()))},
    }


def predict(model: dict, x: np.ndarray) -> tuple[list[str], np.ndarray]:
    family, score = vote(model["family"], x)
    out = [UNKNOWN] * len(x)
    score = score.copy()
    for f, name in enumerate(model["family"]["names"]):
        rows = np.flatnonzero(family == f)
        if len(rows):
            inside = model["within"][name]
            best, sure = vote(inside, x[rows])
            score[rows] *= sure
            for r, b in zip(rows.tolist(), best.tolist()):
                out[r] = inside["names"][b]
    return out, score


def remainder(mod: int):
    """crc32 of the id's decimal text modulo ``mod``; null ids count as empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % mod


def sample(docs: DataFrame, training, per_language: int = PER_LANGUAGE) -> tuple[np.ndarray, np.ndarray]:
    """Features and languages of the training sample."""
    rows = docs.where(training & F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return np.zeros((0, DIMENSIONS), np.float32), np.zeros(0, str)
    share = F.create_map(*(F.lit(v) for k, n in counts.items() for v in (k, min(1.0, per_language / n))))
    place = F.pmod(F.xxhash64(F.col("doc_id"), F.lit(7)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    chosen = rows.where(place < share[F.col("lang")]).select("lang", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            out = [
                (lang, features(text).astype(np.float16).tobytes())
                for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist())
                if has_letter(text)
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array([x for x, _ in out], pa.string()), pa.array([x for _, x in out], pa.binary())],
                names=["lang", "features"],
            )

    found = chosen.mapInArrow(run, "lang string, features binary").limit(2 * per_language * len(counts)).collect()
    x = np.frombuffer(b"".join(r["features"] for r in found), np.float16).reshape(-1, DIMENSIONS)
    return x.astype(np.float32), np.array([r["lang"] for r in found])


def identify(docs: DataFrame, training, per_language: int = PER_LANGUAGE) -> DataFrame:
    """``doc_id, lang_pred, score`` for each row; the model learns from rows where ``training`` holds."""
    spark = docs.sparkSession
    bounded_batches(spark)
    x, langs = sample(docs, training, per_language)
    shared = spark.sparkContext.broadcast(train(x, langs) if len(x) else None)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in slices(batches, "text"):
            for at in range(0, len(batch), 256):
                part = batch.slice(at, 256)
                texts = part.column("text").to_pylist()
                some = [i for i, t in enumerate(texts) if model is not None and has_letter(t)]
                langs, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
                if some:
                    found, score = predict(model, np.stack([features(texts[i]) for i in some]))
                    for i, lang, s in zip(some, found, score.tolist()):
                        langs[i], scores[i] = lang, s
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                    names=["doc_id", "lang_pred", "score"],
                )

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, lang_pred string, score double")


def report(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, lang_pred, score``; rows with remainder 1 of 3 are held out."""
    found = identify(docs, remainder(3) != 1)
    return found.select("doc_id", (remainder(3) == 1).alias("held_out"), "lang_pred", "score")
