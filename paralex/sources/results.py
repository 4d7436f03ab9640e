"""Batch-endpoint result rows in their two dialects, as one table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paralex.functions.core import with_kept

_MESSAGES = "array<struct<role:string,content:string>>"
_USAGE = "struct<prompt_tokens:bigint,completion_tokens:bigint,total_tokens:bigint>"
_CHOICES = "array<struct<message:struct<content:string>>>"

CHAT_SCHEMA = (
    f"custom_id string, response struct<body:struct<choices:{_CHOICES},usage:{_USAGE},created:bigint>>"
)
ROLE_SCHEMA = (
    f"id string, messages {_MESSAGES}, output struct<created:bigint,choices:{_CHOICES},usage:{_USAGE}>"
)


def read_results(lines: DataFrame, dialect: str, column: str = "line") -> DataFrame:
    """``file_name, id, answer, *_tokens, created, messages`` from result lines.

    ``dialect`` is ``chat`` or ``role``.  A line that does not decode to an
    answer is left out here (see :func:`rejected_results`) instead of losing
    the counters of its whole file.  Only the chat dialect drops empty answers.
    """
    if dialect == "chat":
        schema, body, key = CHAT_SCHEMA, lambda r: r["response"]["body"], "custom_id"
    elif dialect == "role":
        schema, body, key = ROLE_SCHEMA, lambda r: r["output"], "id"
    else:
        raise ValueError(f"unknown dialect: {dialect}")

    def usable(row: Column) -> Column:
        answer = _answer(body(row))
        known = row[key].isNotNull() & answer.isNotNull()
        return known & (answer != "") if dialect == "chat" else known

    out = with_kept(lines, "_row", F.from_json(column, schema), usable)
    row = F.col("_row")
    messages = row["messages"] if dialect == "role" else F.lit(None).cast(_MESSAGES)
    return out.select(
        "file_name",
        row[key].alias("id"),
        _answer(body(row)).alias("answer"),
        body(row)["usage"]["prompt_tokens"].alias("prompt_tokens"),
        body(row)["usage"]["completion_tokens"].alias("completion_tokens"),
        body(row)["usage"]["total_tokens"].alias("total_tokens"),
        body(row)["created"].alias("created"),
        messages.alias("messages"),
    )


def _answer(body: Column) -> Column:
    return F.get(body["choices"], 0)["message"]["content"]


def rejected_results(lines: DataFrame, dialect: str, column: str = "line") -> DataFrame:
    """The lines :func:`read_results` cannot decode, for inspection."""
    schema, path, key = (
        (CHAT_SCHEMA, "row.response.body.choices", "row.custom_id")
        if dialect == "chat"
        else (ROLE_SCHEMA, "row.output.choices", "row.id")
    )
    answer = F.get(F.col(path), 0)["message"]["content"]
    return (
        lines.withColumn("row", F.from_json(column, schema))
        .filter(F.col(key).isNull() | answer.isNull())
        .drop("row")
    )


def decode_results(lines: DataFrame, dialect: str, column: str = "line") -> DataFrame:
    """Lines with ``reason``, why :func:`read_results` leaves them out
    (``undecodable``, or ``empty`` for an empty answer of the chat dialect), null
    for the others, whose ``id`` and ``answer`` are given."""
    if dialect not in ("chat", "role"):
        raise ValueError(f"unknown dialect: {dialect}")
    schema, key = (CHAT_SCHEMA, "custom_id") if dialect == "chat" else (ROLE_SCHEMA, "id")
    row = F.col("_row")
    body = row["response"]["body"] if dialect == "chat" else row["output"]
    decoded = lines.withColumn("_row", F.from_json(column, schema)).select(
        *lines.columns, row[key].alias("id"), _answer(body).alias("answer")
    )
    empty = F.lit(dialect == "chat") & (F.col("answer") == "")
    return decoded.withColumn(
        "reason", F.when(F.col("id").isNull() | F.col("answer").isNull(), "undecodable").when(empty, "empty")
    )
