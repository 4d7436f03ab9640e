"""Structured Streaming jobs over arriving files and job states.

Every job is a function of a streaming DataFrame; ``run`` starts it with a
checkpoint and stops when the available input is consumed.  A deployment passes
its own trigger.  Results of updating jobs are kept as a table of changes, one
folder per micro-batch, so that a repeated batch overwrites itself.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from paralex.operators.relational import ledger_upsert, pending
from paralex.operators.responses import parse_labelled
from paralex.operators.predicates import add_provenance, running_jobs
from paralex.operators.sharding import admit_top_k
from paralex.sources.results import decode_results, read_results


def arriving_files(
    spark: SparkSession, path: str, schema: str, fmt: str = "parquet", per_trigger: int | None = None, **options
) -> DataFrame:
    """Rows of files that appear below ``path``; the checkpoint remembers which
    files are done, oldest first."""
    reader = spark.readStream.format(fmt).schema(schema).options(**options)
    if per_trigger:
        reader = reader.option("maxFilesPerTrigger", per_trigger)
    return reader.load(path)


def _run(writer: DataStreamWriter, checkpoint: str, trigger: dict | None) -> None:
    query = (
        writer.option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
    query.awaitTermination()


def append_to(rows: DataFrame, sink: str, checkpoint: str, trigger: dict | None = None) -> None:
    """Append the rows of a stream to a parquet table, each input file once."""
    _run(rows.writeStream.outputMode("append").format("parquet").option("path", sink), checkpoint, trigger)


def changes_to(rows: DataFrame, sink: str, checkpoint: str, trigger: dict | None = None) -> None:
    """Write the changed rows of each micro-batch to its own folder."""

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{sink}/batch={number}")

    _run(rows.writeStream.outputMode("update").foreachBatch(write), checkpoint, trigger)


def latest_changes(spark: SparkSession, sink: str, keys: Sequence[str]) -> DataFrame:
    """Current rows of a table of changes: the last change of each key."""
    rows = spark.read.parquet(sink)
    last = Window.partitionBy(*keys).orderBy(F.desc("batch"))
    return rows.withColumn("_rank", F.row_number().over(last)).filter("_rank = 1").drop("_rank", "batch")


def _converted(answers: DataFrame, codes: Sequence[str], dataset: str) -> DataFrame:
    rows = parse_labelled(answers, codes)
    return add_provenance(rows, dataset, "id").select("file_name", *codes, "dataset", "uuid", "metadata")


def stream_convert(lines: DataFrame, dialect: str, codes: Sequence[str], dataset: str) -> DataFrame:
    """Result lines to parallel rows with their provenance; lines without an
    answer are left out (:func:`convert_to` keeps them)."""
    return _converted(read_results(lines, dialect).select("file_name", "id", "answer"), codes, dataset)


def convert_batch(
    batch: DataFrame, number: int, dialect: str, codes: Sequence[str], dataset: str, sink: str, rejected: str
) -> None:
    """Write one micro-batch of result lines to two tables, in folders of its
    number: parallel rows, and the lines without an answer with the ``reason``.

    The lines are read and decoded once.  A batch that is repeated replaces what
    it wrote before, on both sides.
    """
    decoded = decode_results(batch, dialect).persist()
    try:
        good = decoded.filter("reason IS NULL").select("file_name", "id", "answer")
        _converted(good, codes, dataset).write.mode("overwrite").parquet(f"{sink}/batch={number}")
        decoded.filter("reason IS NOT NULL").drop("id", "answer").write.mode("overwrite").parquet(f"{rejected}/batch={number}")
    finally:
        decoded.unpersist()


def convert_to(
    lines: DataFrame, dialect: str, codes: Sequence[str], dataset: str, sink: str, rejected: str, checkpoint: str,
    trigger: dict | None = None,
) -> None:
    """Convert a stream of result lines; every line that comes ends up in
    ``sink`` or in ``rejected``, once."""

    def write(batch: DataFrame, number: int) -> None:
        convert_batch(batch, number, dialect, codes, dataset, sink, rejected)

    _run(lines.writeStream.foreachBatch(write), checkpoint, trigger)


def stream_job_state(events: DataFrame, fields: Sequence[str], key: str = "file_name", seq: str = "seq") -> DataFrame:
    """Latest state per job; the state store holds one record per job."""
    latest = F.max_by(F.struct(*fields), F.col(seq)).alias("_latest")
    return events.groupBy(key).agg(latest, F.max(seq).alias(seq)).select(key, seq, "_latest.*")


def stream_cutoff(events: DataFrame, after_date: str, delay: str, time: str = "created_at") -> DataFrame:
    """Events since the cutoff, with a watermark that bounds later state and
    lets stateful steps ignore rows that come later than ``delay``."""
    return events.filter(F.col(time) >= F.lit(after_date).cast("timestamp")).withWatermark(time, delay)


def stream_progress(
    rows: DataFrame, sums: dict[str, Column], time: str = "ts", width: str = "1 hour", delay: str = "1 hour"
) -> DataFrame:
    """Counters per time window: rows, and the sum of each given column."""
    totals = [F.sum(c).alias(name) for name, c in sums.items()]
    return (
        rows.withWatermark(time, delay)
        .groupBy(F.window(time, width).alias("_w"))
        .agg(F.count(F.lit(1)).alias("rows"), *totals)
        .select(F.col("_w.start").alias("window_start"), "rows", *sums)
    )


def stream_dedupe(rows: DataFrame, keys: Sequence[str], time: str, delay: str) -> DataFrame:
    """Each key once across triggers, as long as its copies arrive within ``delay``."""
    return rows.withWatermark(time, delay).dropDuplicatesWithinWatermark(list(keys))


def stream_admission(
    events: DataFrame,
    files: DataFrame,
    most: int | Column,
    ledger: str,
    admitted: str,
    checkpoint: str,
    trigger: dict | None = None,
    whole_every: int = 20,
) -> None:
    """Each round: fold the state events into the ledger, count running jobs and
    admit pending files up to ``most``.

    A round writes the files whose state it changed, under its number, and every
    ``whole_every``-th round the whole ledger.  Round ``n`` reads the rounds
    before it from the last whole one on, so a repeated round gives the same rows.
    """
    spark = events.sparkSession
    schema = "file_name string, status string, seq bigint"

    def one(batch: DataFrame, number: int) -> None:
        base = (number - 1) // whole_every * whole_every
        rounds = [f"{ledger}/round={n}" for n in range(base, number)]
        old = spark.read.schema(schema).parquet(*rounds) if number else spark.createDataFrame([], schema)
        new = batch.select("file_name", "status", "seq")
        known = ledger_upsert(old, new, ["file_name"])
        fresh = admit_top_k(pending(files, known), running_jobs(known), most, ["file_name"])
        fresh.write.mode("overwrite").parquet(f"{admitted}/round={number}")
        created = spark.read.schema("file_name string").parquet(f"{admitted}/round={number}").select(
            "file_name", F.lit("validating").alias("status"), F.lit(0).cast("bigint").alias("seq")
        )
        changed = known if number % whole_every == 0 else ledger_upsert(new.limit(0), new, ["file_name"])
        changed.unionByName(created).write.mode("overwrite").parquet(f"{ledger}/round={number}")

    _run(events.writeStream.foreachBatch(one), checkpoint, trigger)
