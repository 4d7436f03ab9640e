"""Writers, each with a reader that reports what was written.

Shards are one folder per file and shard, so they are many small files.  On a
mounted file system (``file:``) tasks write, list and read them themselves:
Spark's writer starts processes for every file there, to set modes, and its
reader keeps every folder on the driver.  Other stores go through Spark's writer and
reader; the folders are named alike.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from paralex.session import ship_code


LINE_END = "\n"
END = LINE_END.encode()
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"  # folder of null or empty values
ESCAPED = re.compile(r"""[\x01-\x1f\x7f"#%'*/:=?\\{\[\]^]""")  # in names of folders, as Spark does


def write_sharded(df: DataFrame, path: str, line: str = "line", order: str = "line_no") -> DataFrame:
    """Write text lines as one folder per file and shard; returns the manifest.

    Shards are bounded in rows and bytes before they get here, so grouping the
    rows of a shard in one task is bounded too, whatever file they come from.
    A null line, or one that holds a line end, cannot be one line of a file:
    such rows are set aside, whole, as Parquet under ``path`` with ``-rejected``.
    """
    fits = F.coalesce(~F.contains(F.col(line), F.lit(LINE_END)), F.lit(False))
    df.filter(~fits).write.mode("overwrite").parquet(f"{path.rstrip('/')}-rejected")
    _write_lines(df.filter(fits), path, line, order)
    return shard_manifest(df.sparkSession, path)


def _hadoop(spark: SparkSession, path: str) -> tuple:
    """Hadoop's file system of ``path``, and the whole path."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    store = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return store, store.makeQualified(at)


def _mounted(spark: SparkSession, path: str) -> str | None:
    """The plain path of a folder that all machines have mounted, else null."""
    uri = _hadoop(spark, path)[1].toUri()
    return uri.getPath() if uri.getScheme() == "file" else None


def _write_lines(df: DataFrame, path: str, line: str, order: str) -> None:
    """One file per file name and shard, in place as soon as it is whole.  A task
    that is repeated writes the same names."""
    rows = (
        df.select("file_name", "shard", F.col(order).alias("_order"), F.col(line).alias("value"))
        .repartition("file_name", "shard")
        .sortWithinPartitions("file_name", "shard", "_order")
        .drop("_order")
    )
    root = _mounted(df.sparkSession, path)
    if root is None:
        (
            rows.write.mode("overwrite")
            .partitionBy("file_name", "shard")
            .option("lineSep", LINE_END)
            .option("mapreduce.fileoutputcommitter.algorithm.version", "2")
            .text(path)
        )
        return
    ship_code(df.sparkSession)
    store, at = _hadoop(df.sparkSession, path)
    store.delete(at, True)
    store.mkdirs(at)
    plain = rows.select("file_name", F.col("shard").cast("string").alias("shard"), F.col("value").cast("binary").alias("value"))
    plain.mapInArrow(_file_writer(root), "file_name string").write.mode("overwrite").format("noop").save()
    store.create(df.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(at, "_SUCCESS")).close()


def _folder(column: str, value: str | None) -> str:
    return f"{column}={ESCAPED.sub(lambda c: f'%{ord(c[0]):02X}', value) if value else NO_VALUE}"


def _value(folder: str) -> str | None:
    shown = folder.partition("=")[2]
    return None if shown == NO_VALUE else re.sub("%([0-9A-Fa-f]{2})", lambda c: chr(int(c[1], 16)), shown)


def _file_writer(root: str) -> Callable:
    """Writes sorted ``file_name, shard, value``, one file after another; only
    that of the current shard is open.  A file gets its name when it is whole."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        now, out, names = None, None, ()

        def close() -> None:
            if out is not None:
                out.close()
                os.replace(*names)

        try:
            for batch in batches:
                files, shards, values = batch.columns
                begin = 0
                for end in sorted({e for c in (files, shards) for e in pc.run_end_encode(c).run_ends.to_pylist()}):
                    key = files[begin].as_py(), shards[begin].as_py()
                    if out is None or key != now:
                        close()
                        now, out = key, None
                        folder = os.path.join(root, _folder("file_name", key[0]), _folder("shard", key[1]))
                        os.makedirs(folder, exist_ok=True)
                        # Null and empty names share folders, not files.
                        name = f"part-{task.partitionId():05d}{'-empty' if key[0] == '' else ''}.txt"
                        names = os.path.join(folder, f".{name}-{task.taskAttemptId()}"), os.path.join(folder, name)
                        out = open(names[0], "wb")
                    out.writelines((v or b"") + END for v in values[begin:end].to_pylist())
                    begin = end
            close()
        finally:
            if out is not None:
                out.close()
        yield from ()

    return write


def _inside(folder: str, folders: bool) -> list[str]:
    """Paths of the folders, or of the files, that Spark would see in a folder."""
    with os.scandir(folder) as found:
        return sorted(e.path for e in found if e.is_dir() == folders and e.name[0] != "." and (e.name[0] != "_" or "=" in e.name))


def _folders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``path`` of the folders in folders."""
    for batch in batches:
        for folder in batch.column(0).to_pylist():
            yield pa.RecordBatch.from_pydict({"path": pa.array(_inside(folder, True), pa.string())})


def _read_files(spark: SparkSession, root: str, columns: dict[str, pa.DataType], read: Callable) -> DataFrame:
    """``file_name, shard, size`` and the ``columns`` that ``read`` gives for the
    lines of a file.  Tasks list folders and read files; none passes through the
    driver.  Files without lines are left out."""
    ship_code(spark)
    schema = pa.schema({"file_name": pa.string(), "shard": pa.int64(), "size": pa.int64()} | columns)
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)
    files = spark.createDataFrame([(root,)], "path string").mapInArrow(_folders, "path string")
    shards = files.repartition(parts).mapInArrow(_folders, "path string").repartition(parts)

    def read_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for folder in batch.column(0).to_pylist():
                file_name, shard = map(_value, folder.split("/")[-2:])
                for path in _inside(folder, False):
                    with open(path, "rb") as lines:
                        if size := os.fstat(lines.fileno()).st_size:
                            found.append((file_name, shard and int(shard), size, *read(lines)))
            yield pa.RecordBatch.from_pydict({n: [f[i] for f in found] for i, n in enumerate(schema.names)}, schema)

    return shards.mapInArrow(read_all, from_arrow_schema(schema))


def _shard_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("value string, file_name string, shard bigint").option("lineSep", LINE_END).text(path)


def _counts(lines: Iterator[bytes]) -> tuple[int, int]:
    """Rows, and their bytes with a line end each."""
    sizes = [len(line) + (line[-1:] != END) for line in lines]
    return len(sizes), sum(sizes)


def shard_manifest(spark: SparkSession, path: str) -> DataFrame:
    """``file_name, shard, rows, bytes`` of written shards, line ends included."""
    root = _mounted(spark, path)
    if root is not None:
        counted = _read_files(spark, root, {"rows": pa.int64(), "bytes": pa.int64()}, _counts)
        return counted.groupBy("file_name", "shard").agg(F.sum("rows").alias("rows"), F.sum("bytes").alias("bytes"))
    return _shard_lines(spark, path).groupBy("file_name", "shard").agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(F.octet_length("value").cast("bigint") + 1).alias("bytes"),
    )


def _custom_id(line: bytes) -> str | None:
    try:
        request = json.loads(line.decode("utf-8", "replace"))
    except ValueError:
        return None
    found = request.get("custom_id") if isinstance(request, dict) else None
    return None if found is None else str(found)


def _requests(lines: Iterator[bytes]) -> tuple[int, str | None, str | None]:
    """Rows, and the ids of the first and the last row by the number in the id."""
    ids = [_custom_id(line) for line in lines]
    row = lambda i: int(i.rpartition("-")[2])
    given = [i for i in ids if i is not None]
    return len(ids), min(given, key=row, default=None), max(given, key=row, default=None)


def write_requests(rolled: DataFrame, path: str) -> DataFrame:
    """Write request lines that carry their shard; returns what the files hold:
    ``file_name, shard, files, rows, file_bytes, first_id, last_id``.  JSON text
    holds no line ends, so no line has to be set aside."""
    _write_lines(rolled, path, "line", "row_in_shard")
    spark = rolled.sparkSession
    root = _mounted(spark, path)
    if root is not None:
        per_file = _read_files(spark, root, {"rows": pa.int64(), "first_id": pa.string(), "last_id": pa.string()}, _requests)
    else:
        lines = _shard_lines(spark, path).select(
            "file_name", "shard", F.get_json_object("value", "$.custom_id").alias("id"),
            F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("size"),
        )
        row = F.substring_index("id", "-", -1).cast("bigint")
        per_file = lines.groupBy("file_name", "shard", "path", "size").agg(
            F.count(F.lit(1)).alias("rows"), F.min_by("id", row).alias("first_id"), F.max_by("id", row).alias("last_id")
        )
    return per_file.groupBy("file_name", "shard").agg(
        F.count(F.lit(1)).alias("files"), F.sum("rows").alias("rows"), F.sum("size").alias("file_bytes"),
        F.min("first_id").alias("first_id"), F.max("last_id").alias("last_id"),
    )


def write_counted(df: DataFrame, path: str, counters: dict[str, Column], keep: Column | None = None) -> dict:
    """Write the rows for which ``keep`` holds (null does not) as Parquet, and
    return ``counters``, aggregates of all rows, from the same pass.

    Counters are those of the tasks whose output was committed; no second scan
    and no cache.  They must be plain aggregates such as counts and sums.
    """
    seen = Observation()
    counted = df.observe(seen, *[c.alias(name) for name, c in counters.items()])
    rows = counted if keep is None else counted.filter(F.coalesce(keep, F.lit(False)))
    rows.write.mode("overwrite").parquet(path)
    return {name: seen.get[name] for name in counters}


def write_jsonl(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_report(report: DataFrame, path: str, fmt: str = "parquet") -> DataFrame:
    """Write the usage report in order of finish time and read it back."""
    writer = report.orderBy("finish_time", "file_name").write.mode("overwrite")
    if fmt == "csv":
        writer.option("header", True).csv(path)
        return report.sparkSession.read.schema(report.schema).option("header", True).csv(path)
    writer.parquet(path)
    return report.sparkSession.read.parquet(path)


def write_vocabulary(vocabulary: DataFrame, path: str) -> DataFrame:
    """Write ``char count`` lines, most frequent first, and read them back."""
    ordered = vocabulary.orderBy(F.desc("cnt"), "first_line", "first_pos")
    ordered.select(F.concat_ws(" ", "char", "cnt").alias("value")).write.mode("overwrite").text(path)
    return vocabulary.sparkSession.read.text(path).withColumnRenamed("value", "line")
