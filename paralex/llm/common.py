"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from contextlib import suppress
from functools import reduce
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType, StructType

from paralex.session import scratch

SLICE = 256
ROWS_PER_BATCH = 1000


def bounded_batches(spark: SparkSession) -> None:
    """Hand texts to Python in Arrow batches of at most ``ROWS_PER_BATCH`` rows.

    Spark's usual 10,000 rows are for narrow rows; of whole texts they are tens
    of megabytes, several times over in the JVM and in Python.  A lower setting
    of the session is left as it is.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= ROWS_PER_BATCH:
        spark.conf.set(key, ROWS_PER_BATCH)


def give_back() -> None:
    """Return freed memory to the system.  Python workers are kept for later
    tasks of other stages, and would hold what their largest task needed."""
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):  # another C library has no malloc_trim
        ctypes.CDLL(None).malloc_trim(0)


def column_function(make: Callable[[], Callable[..., pa.Array]], returns: StructType) -> Callable[..., Column]:
    """A column function whose work is done on short Arrow slices.

    ``make`` builds the slice function once per task.  Slices keep results from
    piling up for a whole incoming batch.
    """

    def run(batches):
        work = make()
        for columns in batches:
            columns = columns if isinstance(columns, tuple) else (columns,)
            for at in range(0, max(1, len(columns[0])), SLICE):
                yield work(*(c.slice(at, SLICE) for c in columns))
        del work
        give_back()

    def apply(*columns) -> Column:
        bounded_batches(SparkSession.active())
        return F.arrow_udf((_one if len(columns) == 1 else _several)(run), returns)(*columns)

    return apply


def text_function(make: Callable[[], Callable[..., dict]], returns: StructType) -> Callable[..., Column]:
    """As :func:`column_function` with a function of one row that returns the
    fields of the struct."""
    kind = to_arrow_type(returns)

    def slices():
        row = make()
        return lambda *cut: pa.array([row(*(v.as_py() for v in values)) for values in zip(*cut)], kind)

    return column_function(slices, returns)


def _one(run):
    def f(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        return run(batches)

    f.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return f


def _several(run):
    def f(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        return run(batches)

    f.__annotations__ = {"batches": Iterator[tuple[pa.Array, ...]], "return": Iterator[pa.Array]}
    return f


def batches_of(make: Callable[[], Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]]]):
    """A function for ``mapInArrow`` whose batch function is built once per task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = make()
        for batch in batches:
            yield from f(batch)
        del f
        give_back()

    return run


def schema_of(returns: StructType) -> pa.Schema:
    return pa.schema([(f.name, to_arrow_type(f.dataType)) for f in returns.fields])


def held_out(doc_id: str | Column = "doc_id") -> Column:
    """Rows kept from learning: crc32 of the id as text leaves no remainder by 5.
    A null id counts as held out."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(c.cast("string")) % 5 == 0, F.lit(True))


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage: later steps re-read files that every executor sees, and
    a lost executor costs only the tasks it was running.
    """
    spark = df.sparkSession
    path = scratch(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def sample_texts(docs: DataFrame, labelled: DataFrame, label: str, per_label: int) -> DataFrame:
    """``doc_id``, ``label``, ``rank`` and ``text`` of at most ``per_label``
    labelled documents of each label value.

    The rows with the smallest hashes of their ids are taken, so the sample is
    spread over the table and any run draws it again.  Only ids are sorted, and
    no task passes on more than it keeps.  Label values are few (a language, a
    class), so at most ``per_label`` ids for each of them are broadcast.  The
    sample is written once; a repeated id counts with its first text.
    """
    rows = labelled.filter(~held_out("doc_id") & F.col(label).isNotNull()).select("doc_id", F.col(label).alias("label"))
    values = sorted(r[0] for r in rows.select("label").distinct().collect())
    order = [F.xxhash64("doc_id"), "doc_id"]
    first = [rows.filter(F.col("label") == v).orderBy(*order).limit(per_label) for v in values]
    ids = reduce(DataFrame.union, first, rows.limit(0))
    ids = ids.withColumn("rank", F.row_number().over(Window.partitionBy("label").orderBy(*order)))
    found = docs.filter(F.col("text").isNotNull()).select("doc_id", "text").join(F.broadcast(ids), "doc_id")
    once = found.groupBy("doc_id", "label", "rank").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    return stored(once, "sample")


def logistic(features, labels, weights, ridge: float = 1e-3):
    """Weights (the last is the constant) of a weighted logistic regression, by
    Newton steps on standardised features."""
    mean, spread = features.mean(0), features.std(0) + 1e-9
    x = np.c_[(features - mean) / spread, np.ones(len(features))]
    w = np.zeros(x.shape[1])
    weights = weights / weights.sum()
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (weights * (p - labels)) + ridge * np.r_[w[:-1], 0]
        bend = (x * (weights * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(bend, slope)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return np.r_[w[:-1] / spread, w[-1] - (w[:-1] * mean / spread).sum()]


def class_counts(labelled: DataFrame, label: str) -> dict[int, int]:
    """Rows learned from, by label value 0 and 1."""
    rows = labelled.filter(~held_out("doc_id") & F.col(label).isNotNull()).groupBy(label).count().collect()
    return {int(r[0]): r[1] for r in rows}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
