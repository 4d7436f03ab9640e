"""Each id once for ever, whatever time lies between its copies.

A watermark bounds what a stream remembers, so copies behind it come through.
Here the ids are remembered in a table, and the stream itself holds no state:
a micro-batch looks its ids up in the table and adds those that are new.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paralex.streaming.jobs import _run

SEEN_BUCKETS = 64


def _keyed(rows: DataFrame, keys: Sequence[str], buckets: int) -> tuple[DataFrame, list[str]]:
    """Whole rows as ``_row``, their keys as ``k0, k1, ...``, and the bucket of these."""
    names = [f"k{i}" for i in range(len(keys))]
    packed = rows.select(F.struct(*rows.columns).alias("_row"))
    packed = packed.select("_row", *[F.col("_row")[k].alias(n) for k, n in zip(keys, names)])
    return packed.withColumn("bucket", F.pmod(F.xxhash64(*names), F.lit(buckets)).cast("int")), names


def first_ever(rows: DataFrame, seen: DataFrame | None, keys: Sequence[str], order: Sequence[str], buckets: int) -> DataFrame:
    """The first row by ``order`` of each key that ``seen`` does not hold.

    Copies inside ``rows`` are thinned out per task before the shuffle.  ``seen``
    holds each key once, so the outer join adds no rows, and Spark may prune
    its buckets and filter its keys by those of the batch.
    """
    packed, names = _keyed(rows, keys, buckets)
    # Rows equal in ``order`` are told apart by their hash, so a repeated batch keeps the same ones.
    first = Window.partitionBy(*names).orderBy(*[F.col("_row")[c] for c in order], F.xxhash64("_row"))
    new = packed.withColumn("_rank", F.row_number().over(first)).filter("_rank = 1").drop("_rank")
    if seen is not None:
        old = seen.select("bucket", *names, F.col("round").alias("_round")).withColumnRenamed("bucket", "_bucket")
        old = old.withColumnsRenamed({n: f"__{n}" for n in names})
        same = F.col("bucket") == F.col("_bucket")
        for n in names:
            same = same & F.col(n).eqNullSafe(F.col(f"__{n}"))
        new = new.join(old, same, "left").filter("_round IS NULL")
    return new.select("_row.*")


def once_batch(
    batch: DataFrame, number: int, keys: Sequence[str], order: Sequence[str], ledger: str, sink: str, buckets: int = SEEN_BUCKETS
) -> None:
    """Append the rows of one micro-batch whose keys never came before to
    ``sink``, in a folder of the batch's number, and their keys to ``ledger``.

    Batch ``n`` looks only at rounds before it, so one that is repeated writes
    the same rows and keys again in place of its own.  Keys lie in ``buckets``
    by their hash; null is a key.  The ledger belongs to the checkpoint of its
    stream and gets at most one file per bucket and round.
    """
    spark = batch.sparkSession
    ids = [T.StructField(f"k{i}", batch.schema[k].dataType) for i, k in enumerate(keys)]
    seen = None
    if number:
        schema = T.StructType([*ids, T.StructField("round", T.LongType()), T.StructField("bucket", T.IntegerType())])
        seen = spark.read.schema(schema).parquet(ledger).filter(F.col("round") < number)
    here = f"{sink}/batch={number}"
    first_ever(batch, seen, keys, order, buckets).write.mode("overwrite").parquet(here)
    written, names = _keyed(spark.read.schema(batch.schema).parquet(here), keys, buckets)
    (
        written.select(*names, "bucket").repartition("bucket")
        .write.mode("overwrite").partitionBy("bucket").parquet(f"{ledger}/round={number}")
    )


def once_to(
    rows: DataFrame, keys: Sequence[str], order: Sequence[str], ledger: str, sink: str, checkpoint: str,
    trigger: dict | None = None, buckets: int = SEEN_BUCKETS,
) -> None:
    """Each key of a stream once for ever: the first row that came, and of those
    that came together the first by ``order``."""

    def write(batch: DataFrame, number: int) -> None:
        once_batch(batch, number, keys, order, ledger, sink, buckets)

    _run(rows.writeStream.foreachBatch(write), checkpoint, trigger)
