"""Part files of several configurations, read through their ledgers.

A configuration has a folder of parts and a ledger, a JSON object whose names
are the parts that are complete.  The names are resolved against a listing of
the folders first, which opens no file; then only the files of complete parts
are read.  A part is a file, or a folder of files, directly below the folder of
its configuration.  As in any scan, the paths to be read pass through the
driver; file contents do not.
"""

from __future__ import annotations

import re
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paralex.sources.jsonl import read_jsonl

NO_ROOT = re.compile(r"^[a-zA-Z][a-zA-Z0-9+.-]*:(//[^/]*)?")
GLOB = re.compile(r"([\\*?\[\]{}])")


def read_ledgers(spark: SparkSession, paths: Mapping[str, str], suffix: str = "jsonl") -> DataFrame:
    """``config, name`` of the complete parts: the names in the JSON object at
    each configuration's path that end in ``suffix``, once each."""
    ledgers = [
        spark.read.text(path, wholetext=True).select(F.lit(config).alias("config"), F.explode(F.json_object_keys("value")).alias("name"))
        for config, path in paths.items()
    ]
    return reduce(DataFrame.union, ledgers).filter(F.endswith("name", F.lit(suffix))).distinct()


def list_parts(spark: SparkSession, folders: Mapping[str, str]) -> DataFrame:
    """``config, name, path, uri, bytes`` of all files below the folders of the
    configurations; ``name`` is that of the part.  Files are not opened, and
    hidden ones (``_`` or ``.`` first) not listed."""

    def one(config: str, folder: str) -> DataFrame:
        below = f"/{NO_ROOT.sub('', folder).strip('/')}/"
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
        place = F.expr("path")
        rest = F.substring(place, F.instr(place, F.lit(below)) + len(below), F.length(place))
        return files.select(
            F.lit(config).alias("config"), F.split_part(rest, F.lit("/"), F.lit(1)).alias("name"), "path",
            F.col("_metadata.file_path").alias("uri"), F.col("length").alias("bytes"),
        )

    return reduce(DataFrame.union, [one(*item) for item in folders.items()])


def missing_parts(listing: DataFrame, ledger: DataFrame) -> DataFrame:
    """Ledger rows without any file."""
    return ledger.join(listing, ["config", "name"], "left_anti")


def completed_lines(listing: DataFrame, ledger: DataFrame) -> DataFrame:
    """``config, file_name, line`` of all files of complete parts; parts of the
    same name in two configurations stay apart."""
    spark = listing.sparkSession
    wanted = listing.join(ledger.select("config", "name").distinct(), ["config", "name"], "left_semi").select("config", "name", "path", "uri")
    found = wanted.collect()  # paths only
    kinds = "config string, name string, path string, uri string"
    if not found:
        return spark.createDataFrame([], "config string, file_name string, line string")
    lines = spark.read.option("recursiveFileLookup", True).text([GLOB.sub(r"\\\1", r.path) for r in found])
    named = spark.createDataFrame(found, kinds).select("config", F.col("name").alias("file_name"), "uri")
    rows = lines.select(F.col("value").alias("line"), F.col("_metadata.file_path").alias("uri"))
    return rows.join(named, "uri").select("config", "file_name", "line")


def read_completed(
    spark: SparkSession, folders: Mapping[str, str], ledger: DataFrame, schema: T.StructType
) -> tuple[DataFrame, DataFrame]:
    """Rows of the complete parts, with ``config`` and ``file_name``, and the
    lines that are no JSON object of the schema."""
    return read_jsonl(completed_lines(list_parts(spark, folders), ledger), schema)
