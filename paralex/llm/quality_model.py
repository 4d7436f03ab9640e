"""Quality score from compression.

Two zstandard dictionaries are filled with passages of texts labelled good and
bad.  A text is compressed in blocks with either of them and with none; the
difference of the two sizes, normalised by the text's length, is
calibrated to a probability by a logistic regression that also sees how far the
text compresses by itself (a text of repetitions leaves no room for a
difference).

Fitting reads at most ``per_label`` labelled documents of each kind; scoring
reads every text whole.  Null and empty texts are scored as an empty block.
Without labelled rows of both kinds every score is the share of label 1 among
labelled rows, or 0.5 without any.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paralex.llm.common import class_counts, logistic, sample_texts, text_function

PER_LABEL = 2000
DICTIONARY = 110_000  # bytes
BLOCK = 1024
LEVEL = 3
LEAST_PASSAGE = 300


class Sizer:
    def __init__(self, good: bytes, bad: bytes):
        plain = {"level": LEVEL, "write_checksum": False, "write_content_size": False, "write_dict_id": False}
        self.without = zstandard.ZstdCompressor(**plain).compress
        self.sized = []
        for content in (good, bad):
            words = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            words.precompute_compress(level=LEVEL)
            self.sized.append(zstandard.ZstdCompressor(dict_data=words, **plain).compress)

    def __call__(self, text: str | None) -> tuple[float, float]:
        """The normalised difference, and the text's own compressed share."""
        data = (text or "").encode()
        good = bad = none = 0
        for at in range(0, max(1, len(data)), BLOCK):
            block = data[at : at + BLOCK]
            good += len(self.sized[0](block))
            bad += len(self.sized[1](block))
            none += len(self.without(block))
        return (good - bad) / (len(data) + 20), none / (len(data) + 20)


@dataclass(frozen=True)
class QualityModel:
    good: bytes
    bad: bytes
    weights: tuple[float, ...]  # of the two features and a constant


def _passages(sample: DataFrame, label: int, rows: int) -> bytes:
    """Up to ``DICTIONARY`` bytes: equal shares from the first ``rows`` texts."""
    share = max(LEAST_PASSAGE, DICTIONARY // max(1, rows))
    room = F.greatest(F.lit(1), F.length("text") - share)
    cut = F.substring(F.col("text"), 1 + F.pmod(F.xxhash64("doc_id"), room).cast("int"), F.lit(share))
    found = sample.filter((F.col("label") == label) & (F.col("rank") <= rows)).orderBy("rank", "doc_id")
    return b" ".join(r[0].encode() for r in found.select(cut).limit(DICTIONARY // LEAST_PASSAGE).collect())[:DICTIONARY]


def sizes(good: bytes, bad: bytes):
    kind = T.StructType([T.StructField("difference", T.DoubleType()), T.StructField("share", T.DoubleType())])

    def make():
        sizer = Sizer(good, bad)
        return lambda text: dict(zip(("difference", "share"), sizer(text)))

    return text_function(make, kind)


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", per_label: int = PER_LABEL) -> QualityModel:
    """Learn from labelled documents that are not held out."""
    counts = class_counts(labels, label)
    known = sum(counts.values())
    prior = counts.get(1, 0) / known if known else 0.5
    flat = QualityModel(b"", b"", (0.0, 0.0, float(np.log(max(prior, 1e-6) / max(1 - prior, 1e-6)))))
    if not counts.get(0) or not counts.get(1):
        return flat
    sample = sample_texts(docs, labels, label, per_label)
    have = {int(r[0]): r[1] for r in sample.groupBy("label").count().collect()}
    if len(have) < 2:
        return flat
    most = DICTIONARY // LEAST_PASSAGE
    used = {k: max(1, min(most, n // 2)) for k, n in have.items()}  # the other half calibrates
    good, bad = (_passages(sample, k, used[k]) for k in (1, 0))
    others = sample.filter(F.col("rank") > F.when(F.col("label") == 1, used[1]).otherwise(used[0]))
    rows = others.select("label", sizes(good, bad)("text").alias("s")).select("label", "s.*").collect()
    if len({r[0] for r in rows}) < 2:
        return flat
    y = np.array([float(r[0]) for r in rows])
    x = np.array([[r[1], r[2]] for r in rows])
    weight = np.where(y == 1, counts[1] / max(1, (y == 1).sum()), counts[0] / max(1, (y == 0).sum()))
    return QualityModel(good, bad, tuple(float(w) for w in logistic(x, y, weight)))


def score(model: QualityModel):
    """A column function: text to a struct with its ``score``."""

    def make():
        sizer, (a, b, c) = Sizer(model.good, model.bad), model.weights

        def row(text):
            difference, share = sizer(text)
            return {"score": float(1 / (1 + np.exp(-np.clip(a * difference + b * share + c, -30, 30))))}

        return row

    return text_function(make, T.StructType([T.StructField("score", T.DoubleType())]))
