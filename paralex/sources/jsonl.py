"""JSON-lines sources that survive malformed rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paralex.functions.core import with_kept

CORRUPT = "_corrupt"


def _with_corrupt(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])


def decode_jsonl(lines: DataFrame, schema: T.StructType, column: str = "line") -> DataFrame:
    """Add struct ``row`` and flag ``bad`` to a table of text lines.

    One pass, no row lost: a line that is no JSON object of the schema keeps
    its text and is flagged instead of failing the job.
    """
    parsed = F.from_json(
        column, _with_corrupt(schema), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    )
    return lines.withColumn("row", parsed).withColumn(
        "bad", F.col("row").isNull() | F.col(f"row.{CORRUPT}").isNotNull()
    )


def read_jsonl(
    lines: DataFrame, schema: T.StructType, column: str = "line"
) -> tuple[DataFrame, DataFrame]:
    """``(good rows, bad lines)`` of a table of text lines."""
    row = F.struct(F.from_json(
        column, _with_corrupt(schema), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    ).alias("v"))
    is_bad = lambda r: r["v"].isNull() | r["v"][CORRUPT].isNotNull()
    others = [c for c in lines.columns if c != column]
    good = with_kept(lines, "_row", row, lambda r: ~is_bad(r))
    bad = with_kept(lines, "_row", row, is_bad)
    return good.select(*others, *[F.col(f"_row.v.{f.name}") for f in schema.fields]), bad.select(*others, column)


def read_jsonl_files(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """File variant: the corrupt-record column holds the text of bad lines."""
    return (
        spark.read.schema(_with_corrupt(schema))
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .json(path)
    )
