"""Toxicity by a small recurrent network, trained here in numpy.

Every word is an input of a few numbers, from the word and from its characters:
log odds of the word, and of its four- and six-byte pieces, between toxic and
other documents.  A bidirectional gated recurrent network reads windows of
words, attention pools its states, and a window gets a logit.  All overlapping
windows of a text are scored; the highest one is calibrated to the score.

Learning uses at most ``per_label`` labelled documents of each kind.  Log odds
are counted in two halves, so that the network is trained on windows whose
words were counted elsewhere; other texts get the mean of both.  What the driver gathers has a fixed size per
task or sampled document: count tables, and a few windows' inputs.

Null texts and texts without a letter or digit score 0.  Without labelled
documents of both kinds every text scores 0.  Texts are read whole.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paralex.llm import bytewords as W
from paralex.llm.common import batches_of, class_counts, column_function, logistic, sample_texts, schema_of

PER_LABEL = 2500
BUCKET_BITS = 17
WINDOW, STRIDE = 24, 12
HIDDEN, POOL = 8, 8
INPUTS = 5
EPOCHS, RATE, BATCH = 25, 0.02, 256
SMOOTH = 2.0  # documents added to either side of the odds
TASKS = 8  # tasks that count and cut windows of the sample
KINDS = 3  # tables: words, pieces of four bytes, pieces of six bytes
AT_ONCE = 4096  # windows scored at once

_SOLID = np.zeros(256, bool)
_SOLID[48:58] = _SOLID[97:123] = _SOLID[128:] = True


def _pieces(data: np.ndarray, inside: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of the ``n`` bytes at each place, and whether they lie in one
    word with at most the space on either side."""
    m = len(data) - n + 1
    if m <= 0:
        return np.empty(0, np.int64), np.empty(0, bool)
    h = np.zeros(m, np.uint64)
    for i in range(n):
        h = h * np.uint64(257) + data[i : i + m]
    whole = inside[n - 1 : n - 1 + m] - inside[1 : 1 + m] == n - 2
    return (W.mix(h, n) >> np.uint64(64 - BUCKET_BITS)).astype(np.int64), whole


@dataclass
class Buckets:
    """Hashed words and pieces of several texts."""

    counts: np.ndarray  # words of each text
    word: np.ndarray
    first: np.ndarray  # place of the space before each word
    length: np.ndarray
    pieces: list[tuple[np.ndarray, np.ndarray]]

    def document_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.counts)), self.counts)


def buckets(texts: list[str]) -> Buckets:
    joined = [f" {t.lower()} ".encode() for t in texts]
    data = np.frombuffer(b"".join(joined), np.uint8)
    solid = _SOLID[data]
    data = np.where(solid, data, 32).astype(np.uint8)
    ends = np.cumsum([0, *map(len, joined)])
    start = np.flatnonzero(solid[1:] & ~solid[:-1]) + 1
    end = np.flatnonzero(solid[:-1] & ~solid[1:]) + 1
    counts = np.diff(np.searchsorted(start, ends))
    word = (W._hashes(data, start, end) >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)
    inside = np.concatenate([[0], np.cumsum(solid)])
    wide = data.astype(np.uint64)
    return Buckets(counts, word, start - 1, end - start, [_pieces(wide, inside, n) for n in (4, 6)])


def inputs(b: Buckets, odds: np.ndarray) -> np.ndarray:
    """The numbers of every word, from the log odds of the three tables."""
    out = np.zeros((len(b.word), INPUTS), np.float32)
    if not len(b.word):
        return out
    out[:, 0] = odds[0][b.word]
    for k, (piece, whole) in enumerate(b.pieces):
        if not len(piece):
            continue
        value = np.where(whole, odds[k + 1][piece], np.float32(0))
        value = np.append(value, np.zeros(max(0, b.first[-1] + 1 - len(value)), np.float32))
        out[:, 1 + 2 * k] = np.maximum.reduceat(value, b.first)
        if k == 0:
            out[:, 2] = np.add.reduceat(value, b.first) / b.length
    out[:, 4] = np.minimum(b.length, 20) / 20
    return out


def windows(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers of all windows (-1 beyond the text), and the text of each."""
    per = np.where(counts > 0, 1 + np.maximum(0, -(-(counts - WINDOW) // STRIDE)), 0)
    text = np.repeat(np.arange(len(counts)), per)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(per) - per, per)
    before = np.cumsum(counts) - counts
    at = nth[:, None] * STRIDE + np.arange(WINDOW)[None, :]
    return np.where(at < counts[text][:, None], at + before[text][:, None], -1), text


def _sigmoid(x):
    return 0.5 * (1 + np.tanh(0.5 * x))


class Network:
    """Parameters ``p`` by name; ``f`` reads forwards and ``b`` backwards."""

    def __init__(self, p: dict[str, np.ndarray]):
        self.p = p

    @staticmethod
    def fresh(seed: int = 5) -> Network:
        rng, p = np.random.default_rng(seed), {}
        for d in "fb":
            p[f"x{d}"] = rng.normal(0, 0.4, (INPUTS, 3 * HIDDEN))
            p[f"h{d}"] = rng.normal(0, 0.3, (HIDDEN, 3 * HIDDEN))
            p[f"c{d}"] = np.zeros(3 * HIDDEN)
        p["pool"], p["ask"] = rng.normal(0, 0.3, (2 * HIDDEN, POOL)), rng.normal(0, 0.3, POOL)
        p["out"], p["bias"] = rng.normal(0, 0.3, 2 * HIDDEN), np.zeros(1)
        return Network({k: v.astype(np.float32) for k, v in p.items()})

    def _read(self, d: str, projected, mask, keep: list | None):
        """States of one direction; ``projected`` holds the input part of the gates."""
        steps, n = len(projected), len(projected[0])
        h, states = np.zeros((n, HIDDEN), np.float32), [None] * steps
        weights = self.p[f"h{d}"]
        for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
            part = h @ weights
            zr = _sigmoid(projected[t][:, : 2 * HIDDEN] + part[:, : 2 * HIDDEN])
            z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
            new = np.tanh(projected[t][:, 2 * HIDDEN :] + r * part[:, 2 * HIDDEN :])
            if keep is not None:
                keep[t] = (h, z, r, new, part[:, 2 * HIDDEN :])
            h = h + mask[t][:, None] * (1 - z) * (new - h)
            states[t] = h
        return states

    def _pool(self, states, mask):
        h = np.stack(states, 1)  # windows x steps x both directions
        a = np.tanh(h @ self.p["pool"])
        e = np.where(mask.T > 0, a @ self.p["ask"], -1e9)
        w = np.exp(e - e.max(1, keepdims=True))
        w /= w.sum(1, keepdims=True)
        pooled = (w[:, :, None] * h).sum(1)
        return h, a, w, pooled, pooled @ self.p["out"] + self.p["bias"][0]

    def logits(self, words: np.ndarray, index: np.ndarray) -> np.ndarray:
        """A logit per window, given the inputs of all words."""
        out = np.empty(len(index), np.float32)
        sides = [np.vstack([words @ self.p[f"x{d}"] + self.p[f"c{d}"], np.zeros((1, 3 * HIDDEN), np.float32)]) for d in "fb"]
        for at in range(0, len(index), AT_ONCE):
            part = index[at : at + AT_ONCE].T
            mask = (part >= 0).astype(np.float32)
            f, b = ([side[part[t]] for t in range(WINDOW)] for side in sides)
            forward, backward = self._read("f", f, mask, None), self._read("b", b, mask, None)
            states = [np.concatenate(s, 1) for s in zip(forward, backward)]
            out[at : at + AT_ONCE] = self._pool(states, mask)[-1]
        return out

    def gradients(self, x: np.ndarray, mask: np.ndarray, y: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
        """Of the weighted log loss; ``x`` is steps x windows x inputs."""
        p, keep = self.p, {d: [None] * WINDOW for d in "fb"}
        read = {d: self._read(d, [x[t] @ p[f"x{d}"] + p[f"c{d}"] for t in range(WINDOW)], mask, keep[d]) for d in "fb"}
        h, a, w, pooled, logit = self._pool([np.concatenate(s, 1) for s in zip(read["f"], read["b"])], mask)
        g = {k: np.zeros_like(v) for k, v in p.items()}
        d_logit = weight * (_sigmoid(logit) - y)
        g["out"], g["bias"] = pooled.T @ d_logit, d_logit.sum(keepdims=True)
        d_pooled = d_logit[:, None] * p["out"]
        d_w = (h * d_pooled[:, None, :]).sum(2)
        d_e = w * (d_w - (w * d_w).sum(1, keepdims=True))
        g["ask"] = np.einsum("nt,ntk->k", d_e, a)
        d_a = d_e[:, :, None] * p["ask"] * (1 - a * a)
        g["pool"] = np.einsum("nth,ntk->hk", h, d_a)
        d_h = w[:, :, None] * d_pooled[:, None, :] + d_a @ p["pool"].T
        for side, d in enumerate("fb"):
            carry = np.zeros((x.shape[1], HIDDEN), np.float32)
            for t in range(WINDOW - 1, -1, -1) if d == "f" else range(WINDOW):
                before, z, r, new, part = keep[d][t]
                m = mask[t][:, None]
                carry = carry + d_h[:, t, side * HIDDEN : (side + 1) * HIDDEN]
                d_new = carry * m * (1 - z) * (1 - new * new)
                d_z = -carry * m * (new - before) * z * (1 - z)
                d_r = d_new * part * r * (1 - r)
                gates_in = np.concatenate([d_z, d_r, d_new], 1)
                gates_h = np.concatenate([d_z, d_r, d_new * r], 1)
                g[f"x{d}"] += x[t].T @ gates_in
                g[f"c{d}"] += gates_in.sum(0)
                g[f"h{d}"] += before.T @ gates_h
                carry = carry * (1 - m * (1 - z)) + gates_h @ p[f"h{d}"].T
        return g

    def train(self, x: np.ndarray, mask: np.ndarray, y: np.ndarray, weight: np.ndarray) -> None:
        """Adam over shuffled batches; ``x`` is windows x steps x inputs."""
        rng = np.random.default_rng(9)
        first = {k: np.zeros_like(v) for k, v in self.p.items()}
        second = {k: np.zeros_like(v) for k, v in self.p.items()}
        step = 0
        for epoch in range(EPOCHS):
            order = rng.permutation(len(x))
            for at in range(0, len(x), BATCH):
                pick = order[at : at + BATCH]
                share = (weight[pick] / len(pick)).astype(np.float32)
                g = self.gradients(x[pick].transpose(1, 0, 2), mask[pick].T, y[pick], share)
                step += 1
                rate = RATE * (1 - epoch / EPOCHS) + 1e-3
                for k, v in g.items():
                    first[k] = 0.9 * first[k] + 0.1 * v
                    second[k] = 0.999 * second[k] + 0.001 * v * v
                    size = np.sqrt(second[k] / (1 - 0.999**step)) + 1e-7
                    self.p[k] = (self.p[k] - rate * first[k] / (1 - 0.9**step) / size).astype(np.float32)


@dataclass(frozen=True)
class ToxicityModel:
    odds: np.ndarray | None  # three tables of log odds
    network: dict[str, np.ndarray] | None
    slope: float = 1.0
    shift: float = 0.0


def log_odds(counts: np.ndarray, documents: np.ndarray) -> np.ndarray:
    """Smoothed log odds per bucket from documents of each class (other, toxic)."""
    scale = documents.min() / np.maximum(documents, 1)
    other, toxic = (counts[c] * scale[c] for c in (0, 1))
    return np.clip(np.log((toxic + SMOOTH) / (other + SMOOTH)), -3, 6).astype(np.float32)


def _half():
    return F.pmod(F.xxhash64("doc_id"), F.lit(2)).cast("int").alias("half")


def _count(sample: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Documents that hold a bucket: half x table x class x bucket, and documents by half and class."""
    shape = (2, KINDS, 2, 1 << BUCKET_BITS)
    kind = T.StructType([T.StructField("counts", T.BinaryType()), T.StructField("documents", T.BinaryType())])

    def count(batches):
        counts, documents = np.zeros(shape, np.int32), np.zeros((2, 2), np.int64)
        for batch in batches:
            for half, label, text in zip(*(c.to_pylist() for c in batch.columns)):
                b = buckets([text])
                documents[half, label] += 1
                for k, found in enumerate([b.word, *[piece[whole] for piece, whole in b.pieces]]):
                    counts[half, k, label, np.unique(found)] += 1
        yield pa.RecordBatch.from_arrays([pa.array([counts.tobytes()], pa.binary()), pa.array([documents.tobytes()], pa.binary())], schema=schema_of(kind))

    counts, documents = np.zeros(shape, np.int64), np.zeros((2, 2), np.int64)
    spread = sample.select(_half(), F.col("label").cast("int"), "text").repartition(TASKS)
    for a, b in spread.mapInArrow(count, kind).toLocalIterator():
        counts += np.frombuffer(a, np.int32).reshape(shape)
        documents += np.frombuffer(b, np.int64).reshape(2, 2)
    return counts, documents


def _cut(sample: DataFrame, odds: np.ndarray):
    """Inputs of the three most suspicious windows and of one other of each
    sampled document, its words judged by the log odds of the other half."""
    kind = T.StructType([
        T.StructField("doc_id", sample.schema["doc_id"].dataType), T.StructField("label", T.IntegerType()),
        T.StructField("nth", T.IntegerType()), T.StructField("x", T.BinaryType()), T.StructField("words", T.IntegerType()),
    ])
    shared = sample.sparkSession.sparkContext.broadcast(odds)

    def make():
        tables = shared.value

        def work(batch):
            rows = []
            for doc_id, half, label, text in zip(*(c.to_pylist() for c in batch.columns)):
                b = buckets([text])
                words = inputs(b, tables[1 - half])
                index, _ = windows(b.counts)
                if not len(index):
                    continue
                total = np.vstack([words, np.zeros((1, INPUTS), np.float32)])[index]
                worst = np.argsort(-np.maximum(total[:, :, :4], 0).sum((1, 2)), kind="stable")
                for nth, i in enumerate([*worst[:3], worst[len(worst) // 2]]):
                    rows.append((doc_id, label, nth, total[i].tobytes(), int((index[i] >= 0).sum())))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(schema_of(kind))], schema=schema_of(kind))

        return work

    columns = sample.select("doc_id", _half(), F.col("label").cast("int"), "text").repartition(TASKS)
    rows = columns.mapInArrow(batches_of(make), kind).collect()
    rows.sort(key=lambda r: (str(r[0]), r[2]))
    x = np.array([np.frombuffer(r[3], np.float32).reshape(WINDOW, INPUTS) for r in rows])
    mask = (np.arange(WINDOW)[None, :] < np.array([r[4] for r in rows])[:, None]).astype(np.float32)
    _, document = np.unique([str(r[0]) for r in rows], return_inverse=True)
    return x, mask, np.array([r[1] for r in rows], np.float32), np.array([r[2] for r in rows]), document


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", per_label: int = PER_LABEL) -> ToxicityModel:
    """Learn from labelled documents that are not held out."""
    known = class_counts(labels, label)
    if not known.get(0) or not known.get(1):
        return ToxicityModel(None, None)
    sample = sample_texts(docs, labels, label, per_label)
    counts, documents = _count(sample)
    if not documents.sum(0).all():
        return ToxicityModel(None, None)
    halves = np.array([[log_odds(counts[h, k], np.maximum(documents[h], 1)) for k in range(KINDS)] for h in (0, 1)])
    x, mask, y, nth, document = _cut(sample, halves)
    if len(set(y.tolist())) < 2:
        return ToxicityModel(None, None)
    learn = (nth == 0) | (y == 0)  # only the most suspicious window of a toxic document is taken for toxic
    network = Network.fresh()
    positive = max(1.0, float((y[learn] == 1).sum()))
    weight = np.where(y == 1, (y[learn] == 0).sum() / positive, 1.0).astype(np.float32)
    network.train(x[learn], mask[learn], y[learn], weight[learn])
    index = np.arange(x.shape[0] * WINDOW).reshape(-1, WINDOW)
    logit = network.logits(x.reshape(-1, INPUTS), np.where(mask > 0, index, -1))
    best = np.full(document.max() + 1, -np.inf)
    np.maximum.at(best, document, logit)
    truth = np.zeros(len(best))
    truth[document] = y
    weight = np.where(truth == 1, known[1] / max(1, truth.sum()), known[0] / max(1, (truth == 0).sum()))
    slope, shift = logistic(best[:, None].astype(float), truth, weight)
    return ToxicityModel(halves.mean(0), network.p, float(slope), float(shift))


def score_texts(model: ToxicityModel, texts: list[str | None]) -> np.ndarray:
    """Scores of texts, which are read in runs of about a chunk of bytes."""
    out = np.zeros(len(texts))
    if model.odds is None:
        return out
    network, run, size = Network(model.network), [], 0
    for i, text in enumerate(texts):
        if text:
            run.append(i)
            size += len(text)
        if run and (size >= W.CHUNK or i == len(texts) - 1):
            b = buckets([texts[j] for j in run])
            index, text_of = windows(b.counts)
            best = np.full(len(run), -np.inf)
            np.maximum.at(best, text_of, network.logits(inputs(b, model.odds), index))
            out[run] = np.where(b.counts > 0, 1 / (1 + np.exp(-np.clip(model.slope * best + model.shift, -30, 30))), 0.0)
            run, size = [], 0
    return out


def toxicity(spark, model: ToxicityModel):
    """A column function: text to its score.  The model has a fixed size and is broadcast."""
    shared = spark.sparkContext.broadcast(model)

    def make():
        learned = shared.value
        return lambda texts: pa.array(score_texts(learned, texts.to_pylist()), pa.float64())

    return column_function(make, T.DoubleType())
