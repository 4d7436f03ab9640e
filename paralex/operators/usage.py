"""Token, character and line usage per result file."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paralex import fixed_values as V
from paralex.functions.core import epoch_to_local
from paralex.functions.labels import ALL_LABELS, labelled_map
from paralex.operators.sharding import join_null_safe


TOKENS = ["total_tokens", "send_tokens", "receive_tokens", "send_chars", "receive_chars"]


def chat_send_chars(text: str = "answer") -> Column:
    """Chat dialect: characters sent = length of the answer's English column."""
    return F.coalesce(F.length(labelled_map(text, ALL_LABELS).getItem("en")), F.lit(0))


def role_send_chars(messages: str = "messages") -> Column:
    """Role dialect: characters sent = length of all messages."""
    return F.aggregate(
        messages, F.lit(0), lambda acc, m: acc + F.coalesce(F.length(m["content"]), F.lit(0))
    )


def usage_by_file(results: DataFrame, send_chars: Column, created: str | None = None, keys: Sequence[str] = ()) -> DataFrame:
    """Counters per file, and per ``keys`` before it, such as a configuration; a partial aggregate per input split, so a file that
    holds most rows costs no more than any other.

    Rows whose answer cannot be parsed, or that a later gate rejects, count.
    ``created`` adds the latest creation time of a file as ``create_time``.
    """
    times = [F.max(created).alias("create_time")] if created else []
    return results.groupBy(*keys, "file_name").agg(
        *times,
        F.sum("prompt_tokens").alias("send_tokens"),
        F.sum("completion_tokens").alias("receive_tokens"),
        F.sum("total_tokens").alias("total_tokens"),
        F.sum(send_chars.cast("bigint")).alias("send_chars"),
        F.sum(F.length("answer").cast("bigint")).alias("receive_chars"),
        F.count(F.lit(1)).alias("lines"),
    )


def join_stats_state(stats: DataFrame, state: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Finish time of each file from the job ledger, epoch 0 when unknown.

    ``keys``, such as a configuration, tell files of the same name apart; they
    are columns of both sides, and null keys meet.  Of several states of a file
    the latest finish time counts, so no file comes out twice.  The join strategy
    is left to AQE.
    """
    on = [*keys, "file_name"]
    finished = state.groupBy(*on).agg(F.max("completed_at").alias("completed_at"))
    return join_null_safe(stats, finished, on, "left").withColumn(
        "completed_at", F.coalesce("completed_at", F.lit(0).cast("bigint"))
    )


def usage_report(stats: DataFrame) -> DataFrame:
    """Ratios per file, with zero divisors replaced by one.

    ``tokens_chars_ratio`` divides by all characters;
    ``tokens_chars_ratio_compat`` divides by received characters plus sent
    tokens, as older reports did.  Columns of ``stats`` besides the counters,
    such as the configuration and ``create_time``, are kept.
    """
    counters = {"completed_at", "file_name", "lines", *TOKENS}
    lines = F.greatest("lines", F.lit(1))
    sent = F.greatest("send_tokens", F.lit(1))
    ratio = lambda a, b: a.cast("double") / F.greatest(b, F.lit(1)).cast("double")
    return stats.select(
        epoch_to_local("completed_at", V.LOCAL_ZONE, V.LOCAL_TIME_FORMAT).alias("finish_time"),
        *[c for c in stats.columns if c not in counters],
        "file_name",
        lines.alias("lines"),
        "total_tokens",
        sent.alias("send_tokens"),
        "receive_tokens",
        "send_chars",
        "receive_chars",
        ratio(F.col("total_tokens"), lines).alias("tokens_per_line"),
        ratio(F.col("receive_tokens"), sent).alias("receive_send_ratio"),
        ratio(F.col("total_tokens"), F.col("send_chars") + F.col("receive_chars")).alias(
            "tokens_chars_ratio"
        ),
        ratio(F.col("total_tokens"), F.col("receive_chars") + sent).alias("tokens_chars_ratio_compat"),
    )
