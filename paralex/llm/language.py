"""Language of whole texts by nearest centroid.

A text becomes a vector of byte n-grams of its lower-cased letters, hashed to a
fixed number of dimensions, weighted by TF-IDF and scaled to length one.  Each
language has several centroids, found by spherical k-means.  The language of
the nearest centroid by cosine is predicted.  A text whose distance from that
centroid is beyond the centroid's limit is rejected; the limit lies well
outside the distances of the texts learned from, and further out for texts with
few different n-grams.

Fitting reads at most ``per_language`` labelled documents of each language, and
gathers one vector of fixed length for each of them.  Null texts and texts
without a letter are ``und`` with score 0 and are rejected; so is every text if
nothing was learned.  Ties go to the language first in alphabetical order.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paralex.llm.common import sample_texts, text_function

PER_LANGUAGE = 600
DIMENSIONS = 4096
ORDERS = (2, 3, 4)
CENTROIDS = 4
SLACK = 0.6  # a text is rejected below this share of the lowest usual cosine
USUAL_GRAMS = 400  # a text with fewer different n-grams cannot come as near
SHARPNESS = 12.0
UNKNOWN = "und"
_LETTER = regex.compile(r"\p{L}")
_PLAIN = np.full(256, 32, np.uint8)
_PLAIN[97:123] = np.arange(97, 123)
_PLAIN[128:] = np.arange(128, 256)
_STEPS = [np.uint32(m) for m in (2654435761, 2246822519, 3266489917, 668265263)]
_CHUNK = 1 << 20


def gram_counts(text: str) -> np.ndarray:
    """Counts of hashed n-grams; anything but letters is one space."""
    data = _PLAIN[np.frombuffer(f" {text.lower()} ".encode(), np.uint8)]
    space = data == 32
    data = data[~(space & np.concatenate([[False], space[:-1]]))].astype(np.uint32)
    counts = np.zeros(DIMENSIONS, np.int64)
    for at in range(0, len(data), _CHUNK):
        part = data[at : at + _CHUNK + max(ORDERS) - 1]
        for n in ORDERS:
            m = min(_CHUNK, len(part) - n + 1)
            if m <= 0:
                continue
            h = np.full(m, n * 0x9E3779B9 & 0xFFFFFFFF, np.uint32)
            for i in range(n):
                h = (h ^ (part[i : i + m] * _STEPS[i])) * _STEPS[0]
                h ^= h >> np.uint32(15)
            counts += np.bincount(h & np.uint32(DIMENSIONS - 1), minlength=DIMENSIONS)
    return counts


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    idf: np.ndarray
    centroids: np.ndarray  # languages x centroids x dimensions
    limits: np.ndarray  # lowest cosine accepted by each centroid


def vector(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    v = np.log1p(counts) * idf
    return v / max(float(np.sqrt(v @ v)), 1e-12)


def _reach(counts: np.ndarray) -> float:
    """How near a text with so many different n-grams can come, 1 for usual texts."""
    return min(1.0, float(np.sqrt(max(1, np.count_nonzero(counts)) / USUAL_GRAMS)))


def _clusters(points: np.ndarray, k: int) -> np.ndarray:
    """Spherical k-means from points far apart; repeats a centroid if there are few points."""
    chosen = [points.mean(0)]
    for _ in range(1, k):
        chosen.append(points[np.argmin((points @ np.array(chosen).T).max(1))])
    centers = np.array(chosen)
    for _ in range(15):
        centers /= np.maximum(np.linalg.norm(centers, axis=1, keepdims=True), 1e-12)
        near = (points @ centers.T).argmax(1)
        centers = np.array([points[near == i].mean(0) if (near == i).any() else centers[i] for i in range(k)])
    return centers / np.maximum(np.linalg.norm(centers, axis=1, keepdims=True), 1e-12)


def fit(docs: DataFrame, per_language: int = PER_LANGUAGE, lang: str = "lang") -> LanguageModel:
    """Learn from documents that have a language and are not held out."""
    kind = T.StructType([T.StructField("counts", T.BinaryType())])
    counted = text_function(lambda: lambda text: {"counts": gram_counts(text).astype(np.uint32).tobytes()}, kind)
    sample = sample_texts(docs, docs, lang, per_language).filter(F.col("text").rlike(r"\p{L}"))
    rows = sample.select("label", "doc_id", counted("text")["counts"]).collect()
    rows.sort(key=lambda r: (r[0], str(r[1])))
    names = tuple(sorted({r[0] for r in rows}))
    if not names:
        return LanguageModel((), np.zeros(DIMENSIONS), np.zeros((0, CENTROIDS, DIMENSIONS)), np.zeros((0, CENTROIDS)))
    counts = np.array([np.frombuffer(r[2], np.uint32) for r in rows], np.float32)
    idf = np.log((1 + len(rows)) / (1 + (counts > 0).sum(0))) + 1.0
    points = np.log1p(counts) * idf.astype(np.float32)
    points /= np.maximum(np.linalg.norm(points, axis=1, keepdims=True), 1e-12)
    label = np.array([r[0] for r in rows])
    centroids = np.array([_clusters(points[label == n], CENTROIDS) for n in names])
    limits = np.zeros((len(names), CENTROIDS))
    for i, n in enumerate(names):
        cosine = points[label == n] @ centroids[i].T
        reach = np.array([_reach(c) for c in counts[label == n]])
        limits[i] = SLACK * np.quantile(cosine.max(1) / reach, 0.005)
    return LanguageModel(names, idf, centroids.astype(np.float32), limits)


ANSWER = T.StructType([
    T.StructField("lang", T.StringType()), T.StructField("score", T.DoubleType()),
    T.StructField("distance", T.DoubleType()), T.StructField("rejected", T.BooleanType()),
])


def predict(model: LanguageModel, text: str | None) -> dict:
    """Language, score (0 to 1), cosine distance, and whether it is rejected."""
    if not text or not model.languages or not _LETTER.search(text):
        return {"lang": UNKNOWN, "score": 0.0, "distance": 1.0, "rejected": True}
    counts = gram_counts(text)
    cosine = model.centroids @ vector(counts, model.idf).astype(np.float32)
    best = cosine.max(1).astype(float)
    at = int(best.argmax())
    odds = np.exp(SHARPNESS * (best - best[at]))
    near = int(cosine[at].argmax())
    return {
        "lang": model.languages[at], "score": float(1 / odds.sum()), "distance": float(np.clip(1 - best[at], 0, 1)),
        "rejected": bool(best[at] < model.limits[at, near] * _reach(counts)),
    }


def language_of(spark, model: LanguageModel):
    """A column function: text to the struct of :func:`predict`.  The model has a
    fixed size per language and is broadcast."""
    shared = spark.sparkContext.broadcast(model)

    def make():
        learned = shared.value
        return lambda text: predict(learned, text)

    return text_function(make, ANSWER)
