"""Row filters, column completion and routing. All plans here are narrow
except :func:`deep_merge`."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paralex import fixed_values as V
from paralex.functions.core import alternation, blank_to_null, col, let, strip, with_kept


def project_required(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Keep rows that have every key of ``mapping`` and rename to its values.

    A key counts as present when it is not null; an empty string is present.
    """
    return df.dropna(subset=list(mapping)).select(*[F.col(a).alias(b) for a, b in mapping.items()])


def is_valid_pair(
    source: str, target: str, path: str, char_class: str = V.HAN
) -> Column:
    return (
        F.col(source).isNotNull()
        & F.coalesce(~F.col(target).rlike(rf"[\n\r{char_class}]"), F.lit(False))
        & F.coalesce(strip(path) != "", F.lit(False))
    )


def filter_valid_pair(
    df: DataFrame, source: str, target: str, path: str, char_class: str = V.HAN
) -> DataFrame:
    """Keep rows with all three keys, a one-line target without characters of
    ``char_class`` and a path that is not blank."""
    return df.filter(is_valid_pair(source, target, path, char_class))


def flag_punctuation(
    df: DataFrame, text: str = "text", allowed: Sequence[str] = tuple(V.ALLOWED_PUNCTUATION)
) -> DataFrame:
    """Rows using punctuation outside ``allowed``, with the offending marks.

    Punctuation is any character that is no letter, number, underscore or
    white space.  ``marks`` lists each one once, sorted.
    """
    fine = "".join(re.escape(mark) for mark in allowed)
    others = F.regexp_replace(col(text), rf"[\p{{L}}\p{{N}}_{V.SPACE}{fine}]+", "")
    marks = F.array_join(F.array_sort(F.array_distinct(F.split(others, ""))), "")
    return with_kept(df, "marks", marks, lambda x: x != "")


def filter_noise_lines(
    df: DataFrame,
    body: str = "body",
    labels: Sequence[str] = tuple(V.LINE_LABELS),
    phrases: Sequence[str] = tuple(V.BOILERPLATE_PHRASES),
    stop: Sequence[str] = tuple(V.APOLOGY_PHRASES),
    min_lines: int = V.MIN_BLOCK_LINES,
) -> DataFrame:
    """Add ``lines``, the usable lines of a block; drop blocks without any.

    Blocks with fewer than ``min_lines`` raw lines go.  Blank lines, lines that
    are only a label or only ASCII punctuation, and lines with a boilerplate
    phrase are removed; the block ends at its first remaining line with a stop
    phrase.
    """
    noise = rf"^(?:[!-/:-@\[-`{{-~]*|{alternation(labels)})$"
    boiler = alternation(p.lower() for p in phrases)
    stops = alternation(stop)

    def usable(lines: Column) -> Column:
        kept = F.filter(lines, lambda x: ~x.rlike(noise) & ~F.lower(x).rlike(boiler))

        def until_stop(rows: Column) -> Column:
            first = F.array_position(F.transform(rows, lambda x: x.rlike(stops)), True).cast("int")
            return F.when(first > 0, F.slice(rows, F.lit(1), first - 1)).otherwise(rows)

        return F.when(F.size(lines) >= min_lines, let(kept, until_stop))

    return with_kept(df, "lines", let(F.split(col(body), "\n"), usable), lambda x: F.size(x) > 0)


def fill_langs(df: DataFrame, langs: Sequence[str], id_col: str = "id") -> DataFrame:
    """Missing language columns become ``''``; the id is copied to ``uuid``."""
    cells = {
        c: F.coalesce(F.col(c), F.lit("")) if c in df.columns else F.lit("") for c in langs
    }
    return df.withColumns(cells | {"uuid": F.col(id_col)})


def _is_blank(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit("")) == ""


def missing_langs(df: DataFrame, langs: Sequence[str]) -> DataFrame:
    """Add ``missing`` (codes in the order given) and ``lacks_language``."""
    codes = [F.when(_is_blank(c) if c in df.columns else F.lit(True), F.lit(c)) for c in langs]
    return df.withColumn("missing", F.array_compact(F.array(*codes))).withColumn(
        "lacks_language", F.size("missing") > 0
    )


def pivot_lang(
    df: DataFrame, langs: Sequence[str], first: Sequence[str] = ("zh-cn", "en")
) -> DataFrame:
    """Add ``pivot_lang`` and ``pivot_text``: the preferred languages in turn,
    else the last non-empty one in the order of ``langs``."""
    order = [c for c in first if c in langs] + [c for c in reversed(langs) if c not in first]
    lang = F.coalesce(*[F.when(~_is_blank(c), F.lit(c)) for c in order])
    text = F.coalesce(*[blank_to_null(c) for c in order])
    return df.withColumn("pivot_lang", lang).withColumn("pivot_text", text)


def rewrite_paths(df: DataFrame, old: str, new: str, path: str = "path") -> DataFrame:
    """``new_path`` with the mount replaced, the ``object_key`` without leading
    slashes, the ``base_name``, and the table and dataset identifiers."""
    p = F.col(path)
    moved = F.replace(p, F.lit(old), F.lit(new))
    base = F.substring_index(p, "/", -1)
    table_id = F.replace(
        F.replace(F.replace(base, F.lit(".jsonl"), F.lit("")), F.lit(".json"), F.lit("")),
        F.lit("."), F.lit("-"),
    )
    return df.withColumns(
        {
            "new_path": moved,
            "object_key": F.regexp_replace(moved, "^/+", ""),
            "base_name": base,
            "table_id": table_id,
            "dataset_id": F.translate(base, "-.", "__"),
        }
    )


def route_jobs(df: DataFrame, after_date: str | None = None) -> DataFrame:
    """Add ``route`` to live jobs: ``download``, ``skip``, ``wait`` or ``cancel``.

    Cancelled and failed jobs go, and so do jobs created before ``after_date``,
    a plain predicate that a date-partitioned source prunes by.  A job without a
    file name has lost its metadata and is to be cancelled; one without a status
    waits.
    """
    live = df.filter(~F.coalesce(F.col("status").isin("cancelling", "cancelled", "failed"), F.lit(False)))
    if after_date:
        live = live.filter(F.col("created_at") >= F.lit(after_date).cast("timestamp"))
    finished = F.col("status").isin("completed", "expired")
    gone = F.coalesce(F.col("file_status") == "Deleted", F.lit(False))
    return live.withColumn(
        "route",
        F.when(F.col("file_name").isNull(), "cancel").when(finished & gone, "skip")
        .when(finished, "download").otherwise("wait"),
    )


def unfailed_jobs(df: DataFrame) -> DataFrame:
    return df.filter(F.col("status") != "failed")


def failed_jobs(df: DataFrame) -> DataFrame:
    return df.filter(F.col("status") == "failed")


def running_jobs(df: DataFrame) -> DataFrame:
    """Jobs that occupy a slot and can be cancelled."""
    return df.filter(F.col("status").isin("in_progress", "validating"))


def add_provenance(
    df: DataFrame, dataset: str, id_col: str = "custom_id", deterministic: bool = True
) -> DataFrame:
    """Add ``dataset``, ``uuid`` and ``metadata`` (the request id).

    The deterministic uuid is a digest of dataset and id, so that a recomputed
    task writes the same rows; the random one changes on every run.
    """
    key = F.md5(F.concat_ws("/", F.lit(dataset), F.col(id_col))) if deterministic else F.uuid()
    return df.withColumns({"dataset": F.lit(dataset), "uuid": key, "metadata": F.col(id_col)})


def deep_merge(old: DataFrame, new: DataFrame, keys: Sequence[str], value: str = "value") -> DataFrame:
    """Merge two ledgers held as one row per leaf; ``keys`` is the leaf's path.

    A leaf of ``new`` wins even when its value is null.  Leaf paths are unique
    on each side, so no key can be hot.
    """
    left = old.select(*keys, F.struct(value).alias("_old"))
    right = new.select(*keys, F.struct(value).alias("_new"))
    return left.join(right, list(keys), "full").select(
        *keys, F.coalesce("_new", "_old").getField(value).alias(value)
    )


def deep_merge_maps(old: str | Column, new: str | Column) -> Column:
    """Two-level ledgers held as ``MAP<key, MAP<field, value>>`` columns."""

    def inner(_: Column, a: Column, b: Column) -> Column:
        both = F.map_zip_with(a, b, lambda k, x, y: F.when(F.map_contains_key(b, k), y).otherwise(x))
        return F.when(a.isNull(), b).when(b.isNull(), a).otherwise(both)

    return F.map_zip_with(col(old), col(new), inner)


def filter_inventory(
    df: DataFrame, depth: int, suffix: str, root: str = "", path: str = "path"
) -> DataFrame:
    """Files at most ``depth`` folders below ``root`` with ``suffix``, not hidden."""
    relative = F.substr(F.col(path), F.lit(len(root.rstrip("/")) + 2))
    parts = F.split(relative, "/")
    name = F.element_at(parts, -1)
    return df.filter(
        F.startswith(F.col(path), F.lit(root.rstrip("/") + "/"))
        & (F.size(parts) <= depth + 1)
        & F.endswith(name, F.lit(suffix))
        & ~F.startswith(name, F.lit("."))
    )


def list_files(spark, path: str) -> DataFrame:
    """Recursive listing with path, size and modification time; no content is read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(path)
        .select("path", "length", "modificationTime")
    )
