"""Counts over rows, files and blocks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paralex import fixed_values as V
from paralex.functions.core import col, let, with_kept
from paralex.operators.text import strip_label


def lang_coverage(df: DataFrame, langs: Sequence[str]) -> DataFrame:
    """``lang, cells``: non-empty cells per language, counted before cleaning."""
    counted = df.agg(*[F.count_if(F.col(c) != "").alias(c) for c in langs])
    return counted.unpivot([], list(langs), "lang", "cells")


def validity_counts(df: DataFrame, valid: Column, by: str) -> DataFrame:
    """``total, valid, invalid`` per input; a null verdict is invalid."""
    ok = F.coalesce(valid, F.lit(False))
    return df.groupBy(by).agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(ok).alias("valid"),
        F.count_if(~ok).alias("invalid"),
    )


def job_state_counts(df: DataFrame) -> DataFrame:
    """Jobs per status, and whether that status occupies a slot."""
    busy = F.col("status").isin("in_progress", "validating")
    return df.groupBy("status").agg(F.count(F.lit(1)).alias("jobs")).withColumn("busy", busy)


def distinct_subtasks(df: DataFrame, prefix: str, path: str = "path") -> DataFrame:
    """Distinct first path segment below ``prefix``, hidden ones excluded, sorted."""
    head = prefix.rstrip("/") + "/"
    segment = F.substring_index(F.substr(F.col(path), F.lit(len(head) + 1)), "/", 1)
    return (
        df.filter(F.startswith(F.col(path), F.lit(head)))
        .select(segment.alias("sub_task"))
        .filter((F.col("sub_task") != "") & ~F.startswith("sub_task", F.lit(".")))
        .distinct()
        .orderBy("sub_task")
    )


def min_langs_gate(
    df: DataFrame,
    anchor: str = "zh-cn",
    at_least: int = V.MIN_BLOCK_LANGS,
    lines: str = "lines",
) -> DataFrame:
    """Keep blocks of ``ARRAY<STRUCT<line, lang>>`` with enough languages.

    Lines before the first one in the anchor language are cut off first; a
    block without the anchor has no lines left.
    """

    def from_anchor(rows: Column) -> Column:
        first = F.array_position(F.transform(rows, lambda x: x["lang"] == anchor), True).cast("int")
        return F.when(first > 0, F.slice(rows, first, F.size(rows)))

    def enough(rows: Column) -> Column:
        return F.size(F.array_distinct(F.transform(rows, lambda x: x["lang"]))) >= at_least

    return with_kept(df, lines, let(col(lines), from_anchor), enough)


def concat_by_lang(
    df: DataFrame, langs: Sequence[str] = tuple(V.CORPUS_LANGS), lines: str = "lines"
) -> DataFrame:
    """One column per language: its lines in order, labels removed, no separator.

    A line's ``text_lang`` is the language of what follows its label.  Lines in
    other languages are dropped.
    """

    def joined(code: str) -> Column:
        own = F.filter(F.col(lines), lambda x: x["text_lang"] == code)
        return F.array_join(F.transform(own, lambda x: strip_label(x["line"])), "")

    return df.withColumns({c: joined(c) for c in langs}).drop(lines)
