"""Exact top-k search by inner product with a pivot-distance index.

Every vector is keyed by its nearest pivot and its distance from it.  Sorted by
this key, vectors are stored in blocks: an annulus around a pivot each, with
its distances and its largest norm.  A block of queries looks at annuli from
the most promising one on, and leaves out those that cannot hold a better
vector: ``d(q, x) >= |d(q, p) - d(x, p)|`` bounds the distance, and the distance
and the norms bound the product.

Pivots are a bounded sample of the vectors (and the origin); they steer the
order of work, never the result.  Vectors are scaled and rounded down to whole
numbers first, which are kept as doubles where 32 bits do not hold them.  Rows
with a null id, and vectors that are null or hold null or non-finite components,
take no part.  Products are exact; those beyond 64 bits count as the ends of
that range.  Only vectors of equal length meet.  Ties go to the smaller id.
Query rows with the same id count once, with the shortest vector, of equally
long ones the first by its bytes; a row with the query's id is not its
neighbour.  Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator
from operator import mul

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paralex.llm.common import schema_of, stored

PIVOTS = 64
ANNULUS = 512  # vectors in a block
GROUP = 1 << 16  # vectors searched by one task, in blocks
QUERIES_AT_ONCE = 256
CHUNK_BLOCKS = 256  # blocks of queries searched by one task


def whole_numbers(vectors: DataFrame, scale: float, name: str = "embedding") -> DataFrame:
    """``vec_id`` and ``v``, the vectors times ``scale`` rounded down, as doubles.
    What scaling takes beyond the range of doubles counts as its end."""
    most = float(np.finfo(float).max)

    def floor(x: Column) -> Column:
        y = x.cast("double") * scale
        return F.when(F.abs(y) < 2.0**53, F.floor(y).cast("double")).otherwise(F.greatest(F.least(y, F.lit(most)), F.lit(-most)))

    infinite = float("inf")
    fine = F.forall(
        F.col(name), lambda x: F.coalesce(~F.isnan(x) & (F.abs(x.cast("double")) < infinite), F.lit(False))
    )
    usable = vectors.filter(F.col("vec_id").isNotNull() & F.col(name).isNotNull()).filter(fine)
    return usable.select(F.col("vec_id").cast("bigint"), F.transform(F.col(name), floor).alias("v"))


def _narrow(v: np.ndarray) -> np.ndarray:
    """Whole numbers in 32 bits if they fit, else as doubles."""
    return v.astype(np.int32) if np.abs(v).max(initial=0) < 1 << 31 else v.astype(float)


def _matrix(data: bytes, rows: int, size: int) -> np.ndarray:
    return np.frombuffer(data, np.int32 if len(data) == 4 * rows * size else float).reshape(rows, size)


def _pivots(vectors: DataFrame, most: int) -> dict[int, np.ndarray]:
    """Pivots by vector length: the origin and up to ``most`` vectors in all."""
    rows = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(most).select("v").collect()
    found: dict[int, list] = {}
    for (v,) in rows:
        found.setdefault(len(v), [np.zeros(len(v))]).append(np.array(v, float))
    return {n: np.array(p) for n, p in found.items()}


def _distances(v: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    square = (v * v).sum(1)[:, None] + (pivots * pivots).sum(1)[None, :] - 2 * (v @ pivots.T)
    return np.sqrt(np.maximum(square, 0))


KEYED = T.StructType([
    T.StructField("vec_id", T.LongType()), T.StructField("size", T.IntegerType()), T.StructField("pivot", T.IntegerType()),
    T.StructField("distance", T.DoubleType()), T.StructField("v", T.BinaryType()),
])


def _keyed(vectors: DataFrame, pivots: dict[int, np.ndarray]) -> DataFrame:
    """Vectors with their key: length, nearest pivot and distance."""
    schema = schema_of(KEYED)

    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, vectors = batch.column(0), batch.column(1)
            lengths = vectors.value_lengths().to_numpy(zero_copy_only=False)
            for n in np.unique(lengths).tolist():
                rows = pa.array(np.flatnonzero(lengths == n))
                v = vectors.take(rows).flatten().to_numpy(zero_copy_only=False).reshape(len(rows), n)
                to = _distances(v, pivots.get(n, np.zeros((1, n))))
                near = to.argmin(1)
                columns = [
                    ids.take(rows), pa.array(np.full(len(v), n), pa.int32()), pa.array(near, pa.int32()),
                    pa.array(to[np.arange(len(v)), near]), pa.array([_narrow(row).tobytes() for row in v], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return vectors.select("vec_id", "v").mapInArrow(key, KEYED)


BLOCK = T.StructType([
    T.StructField("part", T.LongType()), T.StructField("size", T.IntegerType()), T.StructField("pivot", T.IntegerType()),
    T.StructField("low", T.DoubleType()), T.StructField("high", T.DoubleType()), T.StructField("norm", T.DoubleType()),
    T.StructField("ids", T.BinaryType()), T.StructField("vectors", T.BinaryType()),
])


def _blocks(keyed: DataFrame, parts: int, rows: int, by_pivot: bool) -> DataFrame:
    """Annuli of at most ``rows`` vectors, sorted by key; with ``by_pivot`` each
    lies around one pivot.  A range may hold any part of one pivot's vectors."""
    key = ["size", "pivot", "distance", "vec_id"]
    schema = schema_of(BLOCK)

    def block(held: list[tuple]) -> tuple:
        held = sorted(held)
        v = _narrow(np.concatenate([_matrix(h[4], 1, h[1]) for h in held]))
        distance = [h[3] for h in held]
        norm = float(np.sqrt((v.astype(float) ** 2).sum(1).max(initial=0)))
        ids = np.array([h[0] for h in held], np.int64)
        return (*held[0][1:3], min(distance), max(distance), norm, ids.tobytes(), v.tobytes())

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held, same = TaskContext.get().partitionId(), [], None

        def out():
            values = (part, *block(held))
            return pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(values, schema)], schema=schema)

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                now = row[1:3] if by_pivot else row[1:2]
                if held and (len(held) == rows or now != same):
                    yield out()
                    held = []
                held.append(row)
                same = now
        if held:
            yield out()

    return keyed.repartitionByRange(parts, *key).sortWithinPartitions(*key).mapInArrow(build, BLOCK)


FOUND = T.StructType([
    T.StructField("query_id", T.LongType()), T.StructField("ids", T.ArrayType(T.LongType(), False)),
    T.StructField("scores", T.ArrayType(T.LongType(), False)),
])
LEAST = np.iinfo(np.int64).min + 1  # the least number that has a negative


def _unpacked(table: pa.Table) -> Iterator[tuple]:
    for row in table.to_pylist():
        ids = np.frombuffer(row["ids"], np.int64)
        yield row, ids, _matrix(row["vectors"], len(ids), row["size"])


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whole-number products, exactly: in floating point where that is exact."""
    a, b = a.astype(float), b.astype(float)
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    if most < 2**53:
        return (a @ b.T).astype(np.int64)
    if most < 2**62:
        return a.astype(np.int64) @ b.T.astype(np.int64)
    left, right = ([[int(x) for x in row] for row in m.tolist()] for m in (a, b))
    exact = [[min(max(sum(map(mul, x, y)), LEAST + 1), -LEAST) for y in right] for x in left]
    return np.array(exact, np.int64).reshape(len(left), len(right))


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``k`` of every row by score, then id; ids are ascending."""
    if scores.shape[1] > k:
        least = -np.partition(-scores, k - 1, axis=1)[:, k - 1 : k]
        # Above the k-th score all are kept; at it, the smallest ids fill up.
        above, level = scores > least, scores == least
        room = k - above.sum(1, keepdims=True)
        pick = above | (level & (np.cumsum(level, axis=1) <= room))
        columns = np.nonzero(pick)[1].reshape(len(scores), k)
        return np.take_along_axis(scores, columns, 1), ids[columns]
    return scores, np.broadcast_to(ids, scores.shape)


def _search(annuli: list[tuple], q: np.ndarray, q_ids: np.ndarray, pivots: np.ndarray, k: int):
    """Best scores and ids among the annuli, padded with the least number."""
    top, top_ids = np.full((len(q), k), LEAST), np.full((len(q), k), np.iinfo(np.int64).max)
    to, square = _distances(q.astype(float), pivots), (q.astype(float) ** 2).sum(1)
    bounds = np.empty((len(q), len(annuli)))
    for i, (block, _, _) in enumerate(annuli):
        d = to[:, block["pivot"]]
        apart = np.maximum(0, np.maximum(d - block["high"], block["low"] - d))
        by_distance = (square + block["norm"] ** 2 - apart**2) / 2
        terms = 1 + square + block["norm"] ** 2 + (pivots[block["pivot"]] ** 2).sum()
        bounds[:, i] = np.minimum(by_distance, np.sqrt(square) * block["norm"]) + 1e-6 * terms  # for rounding
    bounds = np.maximum(np.nan_to_num(bounds, nan=np.inf, posinf=np.inf), float(LEAST))  # as scores are
    for i in np.argsort(-bounds.max(0), kind="stable"):
        rows = np.flatnonzero(bounds[:, i] >= top[:, -1])
        if not len(rows):
            continue
        _, ids, v = annuli[i]
        scores = _products(q[rows], v)
        scores[ids[None, :] == q_ids[rows][:, None]] = LEAST
        scores, found = _best(scores, ids, k)
        scores, found = np.concatenate([top[rows], scores], 1), np.concatenate([top_ids[rows], found], 1)
        found = np.where(scores == LEAST, np.iinfo(np.int64).max, found)
        order = np.lexsort((found, -scores), axis=1)[:, :k]
        top[rows], top_ids[rows] = np.take_along_axis(scores, order, 1), np.take_along_axis(found, order, 1)
    return top, top_ids


def _numbered(blocks: DataFrame, most: int) -> DataFrame:
    """Blocks, in place of their ``part``, with a ``chunk``: a run of at most
    ``most`` blocks.  They are written, since they are numbered by where they lie."""
    rows = stored(blocks.withColumn("nth", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))), "queries")
    parts = rows.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy(F.lit(0)).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = parts.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    chunk = F.call_function("div", F.col("before") + F.col("nth"), F.lit(most))
    return rows.join(before, "part").withColumn("chunk", chunk).drop("part", "nth", "before")


def _meetings(index: DataFrame, queries: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Annuli and blocks of queries such that each group of annuli meets each
    chunk of queries that has vectors of its lengths, once: annuli by ``part``
    and ``by``, queries by ``to`` and ``chunk``."""
    chunks = queries.select(F.col("chunk").alias("by"), "size").distinct()
    groups = index.select(F.col("part").alias("to"), "size").distinct()
    return index.join(chunks, "size"), queries.join(groups, "size")


def top_k(vectors: DataFrame, is_query: Column, k: int, most_pivots: int = PIVOTS, group: int = GROUP) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id`` and ``score`` of the ``k`` best rows for
    each query, for ``vectors`` with ``vec_id`` and whole-number ``v``.

    A task searches one group of annuli for one chunk of queries; both have a
    bounded number of vectors."""
    pivots = _pivots(vectors, most_pivots)
    keyed = stored(_keyed(vectors, pivots), "keyed")
    parts = max(1, -(-keyed.count() // group))
    index = stored(_blocks(keyed, parts, ANNULUS, True), "annuli")
    first = F.min(F.struct("size", "v", "pivot", "distance")).alias("x")
    asked = keyed.filter(is_query).groupBy("vec_id").agg(first).select("vec_id", "x.size", "x.pivot", "x.distance", "x.v")
    queries = _numbered(_blocks(asked, parts, QUERIES_AT_ONCE, False), CHUNK_BLOCKS)
    annuli, sent = _meetings(index, queries)
    schema = schema_of(FOUND)

    def search(annuli: pa.Table, asked: pa.Table) -> pa.Table:
        rows = []
        by_size: dict[int, list] = {}
        for block in _unpacked(annuli):
            by_size.setdefault(block[0]["size"], []).append(block)
        for block, ids, q in _unpacked(asked):
            n = block["size"]
            top, found = _search(by_size[n], q, ids, pivots.get(n, np.zeros((1, n))), k)
            for i, scores, near in zip(ids.tolist(), top, found):
                some = scores > LEAST
                rows.append((i, near[some], scores[some]))
        columns = list(zip(*rows)) if rows else [[], [], []]
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    found = annuli.groupBy("part", "by").cogroup(sent.groupBy("to", "chunk")).applyInArrow(search, FOUND)
    each = found.select("query_id", F.explode(F.arrays_zip("ids", "scores")).alias("x"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    ranked = each.select("query_id", F.col("x.ids").alias("vec_id"), F.col("x.scores").alias("score")).withColumn("rank", rank)
    return ranked.filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
