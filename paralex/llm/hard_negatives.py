"""Hard negatives by a secondary sort of pair scores.

For each anchor and each of its first positives (other rows of its label, by
descending inner product, then id), the first negatives (rows of another label)
whose score is at most that of the positive and at least a share of it.

Anchors are a stated set of rows, in chunks; they are scored against blocks of
all rows.  A task, which has one part of the rows and one chunk, hands on no
pair that cannot be in the result: in a first pass its first positives of each
anchor, in a second, when the positives of all parts are known, its first
negatives below each of them.  These pairs, packed into keys of anchor,
descending score and id, are sorted within partitions.  An iterator reads them
in that order: a positive opens a window, a negative is given to all windows
that are open, and a window closes when it is full or the scores fall below it.
It holds the open windows of one anchor and no rows.

Rows with a null id, label or vector, or with a null or non-finite component,
take no part.  Components are scaled and rounded down to whole numbers; scores
beyond the range of 64 bits count as its ends.  Only vectors of equal length
meet.  A row with the anchor's id is not its partner; of several rows with an
anchor's id the smallest (by label, then vector) is the anchor.  Repeated rows
are partners as often as they occur; rows equal in score and id come in any
order.  Labels are whole numbers.  Empty tables give empty results.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paralex.llm.common import schema_of, stored

POSITIVES, NEGATIVES = 5, 5
BLOCK = 4096  # vectors of a block
PART_BLOCKS = 32  # blocks of all rows searched by one task
CHUNK = 8192  # anchors searched by one task
AT_ONCE = 256  # anchors scored at once
LEAST, MOST = np.iinfo(np.int64).min + 1, np.iinfo(np.int64).max  # the least number that has a negative
FARTHEST = 1e300  # of a component, in double columns


def usable(rows: DataFrame, vec_id: Column, label: Column, vector: Column) -> DataFrame:
    """``vec_id``, ``label`` and ``v`` of the rows that take part."""
    fine = F.forall("v", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")), F.lit(False)))
    kept = rows.select(vec_id.cast("bigint").alias("vec_id"), label.cast("bigint").alias("label"), vector.alias("v"))
    return kept.filter("vec_id IS NOT NULL AND label IS NOT NULL AND v IS NOT NULL").filter(fine)


BLOCKS = T.StructType([
    T.StructField("at", T.LongType()), T.StructField("size", T.IntegerType()), T.StructField("kind", T.StringType()),
    T.StructField("ids", T.BinaryType()), T.StructField("labels", T.BinaryType()), T.StructField("vectors", T.BinaryType()),
    T.StructField("positives", T.BinaryType()),
])


def _narrowest(v: np.ndarray) -> str:
    """The narrowest type that holds whole numbers given as doubles."""
    most = np.abs(v).max(initial=0)
    return "<i2" if most < 1 << 15 else "<i4" if most < 1 << 31 else "<f8"


def _blocks(rows: DataFrame, scale: float, most: int) -> DataFrame:
    """Rows packed into blocks of at most ``most`` vectors of one length.

    ``positives``, where the rows have them, are lists of ``POSITIVES`` scores."""
    schema, known = schema_of(BLOCKS), "positives" in rows.columns

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = TaskContext.get().partitionId() << 32
        for batch in batches:
            lengths = batch.column("v").value_lengths().to_numpy(zero_copy_only=False)
            for n in np.unique(lengths).tolist():
                found = np.flatnonzero(lengths == n)
                for begin in range(0, len(found), most):
                    some = batch.take(pa.array(found[begin : begin + most]))
                    v = some.column("v").flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(some), n)
                    v = np.floor(np.clip(v * scale, -FARTHEST, FARTHEST))
                    ids, labels = (some.column(c).to_numpy(zero_copy_only=False) for c in ("vec_id", "label"))
                    order, kind = np.argsort(ids, kind="stable"), _narrowest(v)
                    scores = b""
                    if known:
                        scores = some.column("positives").flatten().to_numpy(zero_copy_only=False).reshape(len(some), -1)[order].tobytes()
                    row = (at, n, kind, ids[order].tobytes(), labels[order].tobytes(), v[order].astype(kind).tobytes(), scores)
                    yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(row, schema)], schema=schema)
                    at += 1

    return rows.mapInArrow(pack, BLOCKS)


def _scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whole-number inner products, exactly; beyond 64 bits the nearest."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    if most < 2**53:
        return (a.astype(float) @ b.astype(float).T).astype(np.int64)
    if most < 2**62:
        return a.astype(np.int64) @ b.astype(np.int64).T
    whole = [np.array([[int(x) for x in row] for row in m.tolist()], object).reshape(m.shape) for m in (a, b)]
    return np.clip(whole[0] @ whole[1].T, LEAST + 1, MOST).astype(np.int64)


def _unpacked(table: pa.Table) -> dict[int, list[tuple[np.ndarray, ...]]]:
    """Blocks by the length of their vectors: ids, labels, vectors, positives."""
    out: dict[int, list] = {}
    for r in table.to_pylist():
        ids, labels = (np.frombuffer(r[c], np.int64) for c in ("ids", "labels"))
        v = np.frombuffer(r["vectors"], r["kind"]).reshape(len(ids), r["size"])
        scores = np.frombuffer(r["positives"], np.int64).reshape(len(ids), -1)
        out.setdefault(r["size"], []).append((ids, labels, v, scores))
    return out


class _Pairs:
    """Pairs of the anchors that are scored at once, in the order of anchor,
    descending score and id."""

    def __init__(self):
        self.anchor, self.id, self.score = (np.empty(0, np.int64) for _ in range(3))

    def add(self, anchor: np.ndarray, ids: np.ndarray, score: np.ndarray) -> None:
        anchor, ids, score = (np.concatenate(x) for x in ((self.anchor, anchor), (self.id, ids), (self.score, score)))
        order = np.lexsort((ids, -score, anchor))
        self.anchor, self.id, self.score = anchor[order], ids[order], score[order]

    def ranks(self, among: np.ndarray) -> np.ndarray:
        """For each pair its place, from 1, among the marked ones of its anchor."""
        so_far = np.cumsum(among)
        first = np.searchsorted(self.anchor, self.anchor, "left")
        return so_far - np.where(first > 0, so_far[first - 1], 0)

    def keep(self, which: np.ndarray) -> None:
        self.anchor, self.id, self.score = self.anchor[which], self.id[which], self.score[which]


def _first_positives(blocks: list[tuple], ids: np.ndarray, labels: np.ndarray, v: np.ndarray, _: np.ndarray) -> _Pairs:
    pairs = _Pairs()
    cut = np.full(len(ids), LEAST)  # the last score that still matters
    for row_ids, row_labels, rows, _ in blocks:
        among = (row_labels[None, :] == labels[:, None]) & (row_ids[None, :] != ids[:, None])
        scores = np.where(among, _scores(v, rows), LEAST)
        if scores.shape[1] > POSITIVES:
            least = -np.partition(-scores, POSITIVES - 1, axis=1)[:, POSITIVES - 1 : POSITIVES]
            level = scores == least
            room = POSITIVES - (scores > least).sum(1, keepdims=True)
            among &= (scores > least) | (level & (np.cumsum(level, axis=1) <= room))  # ids ascend
        a, r = np.nonzero(among & (scores >= cut[:, None]))
        pairs.add(a, row_ids[r], scores[a, r])
        rank = pairs.ranks(np.ones(len(pairs.id), bool))
        pairs.keep(rank <= POSITIVES)
        full = pairs.ranks(np.ones(len(pairs.id), bool)) == POSITIVES
        cut[pairs.anchor[full]] = pairs.score[full]
    return pairs


def _first_negatives(blocks: list[tuple], ids: np.ndarray, labels: np.ndarray, v: np.ndarray, positives: np.ndarray) -> _Pairs:
    pairs = _Pairs()
    lowest = np.where(positives >= 0, positives - positives // 5, MOST)  # of each window; below 0 none is open
    cut = lowest.copy()
    for row_ids, row_labels, rows, _ in blocks:
        scores = _scores(v, rows)
        near = (scores <= positives[:, :1]) & (scores >= cut.min(1)[:, None])
        near &= (row_labels[None, :] != labels[:, None]) & (row_ids[None, :] != ids[:, None])
        a, r = np.nonzero(near)
        if not len(a):
            continue
        pairs.add(a, row_ids[r], scores[a, r])
        needed = np.zeros(len(pairs.id), bool)
        for i in range(POSITIVES):
            inside = (pairs.score <= positives[pairs.anchor, i]) & (pairs.score >= lowest[pairs.anchor, i])
            rank = pairs.ranks(inside)
            needed |= inside & (rank <= NEGATIVES)
            full = inside & (rank == NEGATIVES)
            cut[pairs.anchor[full], i] = pairs.score[full]
        pairs.keep(needed)
    return pairs


FOUND = T.StructType([
    T.StructField("anchor_id", T.LongType()), T.StructField("id", T.LongType()), T.StructField("score", T.LongType()),
])


def _met(blocks: DataFrame, parts: int, anchors: DataFrame, chunks: int, search) -> DataFrame:
    """``search`` of every chunk of anchors in every part of the rows."""
    schema = schema_of(FOUND)

    def meet(rows: pa.Table, asked: pa.Table) -> pa.Table:
        by_size, out = _unpacked(rows), [pa.Table.from_pylist([], schema)]
        for n, chunk in _unpacked(asked).items():
            for ids, labels, v, scores in chunk:
                for at in range(0, len(ids), AT_ONCE):
                    cut = slice(at, at + AT_ONCE)
                    pairs = search(by_size.get(n, []), ids[cut], labels[cut], v[cut], scores[cut])
                    out.append(pa.table([ids[cut][pairs.anchor], pairs.id, pairs.score], schema=schema))
        return pa.concat_tables(out).combine_chunks()

    numbers = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    rows = blocks.withColumn("part", F.pmod(F.xxhash64("at"), F.lit(parts)).cast("int")).withColumn("chunk", numbers(chunks))
    asked = anchors.withColumn("chunk", F.shiftright("at", 32).cast("int")).withColumn("part", numbers(parts))
    return rows.groupBy("part", "chunk").cogroup(asked.groupBy("part", "chunk")).applyInArrow(meet, FOUND)


KEY = struct.Struct(">QQBQ")  # anchor, score from the top, positives before negatives, id
SHIFT = 1 << 63


def packed(anchor: int, score: int, negative: bool, row: int) -> bytes:
    """A key whose order as bytes is that of anchor, descending score and id; a
    positive stands before the negatives of its score."""
    return KEY.pack(anchor + SHIFT, MOST - score, negative, row + SHIFT)


def windows(keys: Iterator[tuple[bytes, None]]) -> Iterator[tuple[int, int, int, int, int, int]]:
    """Triples of sorted keys: anchor, positive, rank, negative and both scores."""
    anchor, opened = None, []
    for key, _ in keys:
        a, down, negative, row = KEY.unpack(key)
        if a != anchor:
            anchor, opened = a, []
        score = MOST - down
        if not negative:
            if score >= 0:  # below 0 a share of the score is above it
                opened.append([row - SHIFT, score, 0])
            continue
        opened = [w for w in opened if w[2] < NEGATIVES and 80 * w[1] <= 100 * score]
        for w in opened:
            w[2] += 1
            yield anchor - SHIFT, w[0], w[2], row - SHIFT, w[1], score


TRIPLES = T.StructType([
    T.StructField("anchor_id", T.LongType()), T.StructField("positive_id", T.LongType()), T.StructField("rank", T.IntegerType()),
    T.StructField("negative_id", T.LongType()), T.StructField("positive_score", T.LongType()), T.StructField("negative_score", T.LongType()),
])


def mine(rows: DataFrame, is_anchor: Column, scale: float) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id``,
    ``positive_score`` and ``negative_score`` for rows of :func:`usable`."""
    spark = rows.sparkSession
    blocks = stored(_blocks(rows, scale, BLOCK), "blocks")
    count = blocks.count()
    parts = max(1, -(-count // PART_BLOCKS), min(count, spark.sparkContext.defaultParallelism))
    once = rows.filter(is_anchor).groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("first"))
    anchors = stored(once.select("vec_id", "first.label", "first.v"), "anchors")
    chunks = max(1, -(-anchors.count() // CHUNK))

    asked = stored(_blocks(anchors.repartition(chunks), scale, CHUNK), "chunks")
    near = _met(blocks, parts, asked, chunks, _first_positives)
    order = Window.partitionBy("anchor_id").orderBy(F.desc("score"), "id")
    near = near.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= POSITIVES)
    positives = stored(near.drop("rank"), "positives")

    # Missing positives count as scores that open no window.
    padded = F.slice(F.concat(F.sort_array(F.collect_list("score"), False), F.array_repeat(F.lit(-1).cast("bigint"), POSITIVES)), 1, POSITIVES)
    scores = positives.groupBy(F.col("anchor_id").alias("vec_id")).agg(padded.alias("positives"))
    known = stored(_blocks(anchors.join(scores, "vec_id").repartition(chunks), scale, CHUNK), "chunks")
    negatives = _met(blocks, parts, known, chunks, _first_negatives)

    pairs = positives.withColumn("negative", F.lit(False)).unionByName(negatives.withColumn("negative", F.lit(True)))
    keys = pairs.select("anchor_id", "score", "negative", "id").rdd.map(lambda r: (packed(*r), None))
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    in_order = keys.repartitionAndSortWithinPartitions(tasks, lambda key: crc32(key[:8]))
    return spark.createDataFrame(in_order.mapPartitions(windows), TRIPLES)
