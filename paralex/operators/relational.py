"""Joins, set differences, ledgers and deduplication.

No join here is forced to broadcast: the smaller side is a listing or ledger
whose size depends on the data, so the choice is left to statistics and AQE,
whose skew handling also splits a hot key of the large side.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from paralex.operators.sharding import join_null_safe
from paralex.sources.parts import completed_lines, list_parts


def _first(df: DataFrame, keys: Sequence[str], *order: str | Column) -> DataFrame:
    """First row per key.  The rank filter also runs before the shuffle (each
    task sends one row per key), so copies of a hot key never meet in one task."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


def join_supplement(
    orig: DataFrame,
    sup: DataFrame,
    langs: Sequence[str],
    id_col: str = "id",
    order: str = "line_no",
    only_missing: bool = False,
) -> DataFrame:
    """Original rows with the languages of their supplement.

    A matched row takes every listed language from it, missing ones included;
    ``only_missing=True`` keeps non-empty cells.  The last supplement of a uuid
    counts.  The id is copied to ``uuid``.
    """
    latest = _first(sup.filter("uuid IS NOT NULL"), ["uuid"], F.desc(order))
    build = latest.select(F.col("uuid").alias("_uuid"), F.struct(*langs).alias("_sup"))
    joined = orig.join(build, F.col(id_col) == F.col("_uuid"), "left")
    matched = F.col("_uuid").isNotNull()

    def cell(c: str) -> Column:
        old = F.col(c) if c in orig.columns else F.lit(None).cast("string")
        new = F.col("_sup").getField(c)
        if only_missing:
            return F.when(matched & (F.coalesce(old, F.lit("")) == ""), new).otherwise(old)
        return F.when(matched, new).otherwise(old)

    return joined.withColumns({c: cell(c) for c in langs} | {"uuid": F.col(id_col)}).drop("_uuid", "_sup")


def pending(files: DataFrame, ledger: DataFrame, key: str | Sequence[str] = "file_name") -> DataFrame:
    """Files without a ledger entry: what a resumed run still has to do."""
    keys = [key] if isinstance(key, str) else list(key)
    return files.join(ledger.select(*keys), keys, "left_anti")


def set_diff_pending(
    files: DataFrame, done: Sequence[DataFrame], locked: DataFrame, key: str = "file_name"
) -> DataFrame:
    """Distinct sorted names, minus those completed in any ledger, minus locked ones."""
    completed = reduce(DataFrame.union, [d.select(key) for d in done]).distinct()
    return files.select(key).subtract(completed).subtract(locked.select(key)).orderBy(key)


def existing_only(df: DataFrame, inventory: DataFrame, key: str = "path") -> DataFrame:
    """Rows whose path exists in a file inventory."""
    return df.join(inventory.select(key), key, "left_semi")


def existence_report(df: DataFrame, inventory: DataFrame, key: str = "path", by: str = "file_name") -> DataFrame:
    """``total, valid, missing`` per list, from one join."""
    known = inventory.select(key).distinct().withColumn("_known", F.lit(True))
    return (
        df.select(by, key).join(known, key, "left").groupBy(by).agg(
            F.count(F.lit(1)).alias("total"),
            F.count("_known").alias("valid"),
            F.count_if(F.col("_known").isNull()).alias("missing"),
        )
    )


def union_parts(parts: Sequence[DataFrame]) -> DataFrame:
    """All parts by column name; a column missing in a part is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def read_completed(spark: SparkSession, folder: str, ledger: DataFrame, schema) -> DataFrame:
    """Rows of the completed part files of a folder, with their ``file_name``;
    other files are not opened."""
    named = ledger.select(F.lit("").alias("config"), F.col("file_name").alias("name"))
    lines = completed_lines(list_parts(spark, {"": folder}), named.filter(F.endswith("name", F.lit("jsonl"))))
    return lines.select("file_name", F.from_json("line", schema).alias("_row")).select("file_name", "_row.*")


def _above(path: str) -> Column:
    """The paths that a path goes on from, the empty one first."""
    steps = F.sequence(F.lit(0), F.size(path) - 1)
    return F.when(F.size(path) > 0, F.transform(steps, lambda n: F.slice(path, 1, n)))


def deep_merge_leaves(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Merge ledgers of any depth held as one row per leaf: ``keys`` of the
    ledger, ``path`` and ``value``, as JSON text (``json_leaves``).

    Objects merge, anything else of ``new`` replaces what ``old`` has there.  So
    an old leaf goes if ``new`` has a leaf at its path, a path that goes on from
    it, or a leaf above it.  An empty object above it merges; one of ``new`` goes
    itself if the old ledger has leaves below it, one of ``old`` if the new one
    has.  Leaf paths are unique on each side; null keys are keys.

    Paths above a leaf are made distinct before they meet the other side, so a
    ledger, or an object in it, with most of the leaves sends each path once.
    Both sides of all joins are shuffled, as leaves are many more than ledgers.
    """
    join = partial(join_null_safe, shuffled=True)
    on = [*keys, "path"]
    empty = F.col("value") == "{}"
    beneath = lambda df: df.select(*keys, F.explode(_above("path")).alias("path")).distinct()
    # All paths of the new ledger, of leaves and of objects.
    there = new.select(*on).unionByName(beneath(new))
    kept = join(old, there, on, "left_anti")
    # New leaves, but no empty objects, above old ones: all below them goes.
    replaced = join(beneath(old), new.filter(~empty).select(*on), on, "left_semi")
    gone = join(
        kept.select(*on, F.explode(_above("path")).alias("_above")).withColumnRenamed("path", "_leaf_path").withColumnRenamed("_above", "path"),
        replaced, on, "left_semi",
    ).select(*keys, F.col("_leaf_path").alias("path")).distinct()
    kept = join(kept, gone, on, "left_anti")
    # Empty new objects that the old ledger fills.
    filled = join(new.filter(empty).select(*on), beneath(old), on, "left_semi")
    return kept.select(*on, "value").unionByName(join(new, filled, on, "left_anti").select(*on, "value"))


def ledger_upsert(old: DataFrame, new: DataFrame, keys: Sequence[str], seq: str = "seq") -> DataFrame:
    """Ledger with one row per key, the latest record of either side; a new
    record replaces an old one of the same ``seq``."""
    sides = old.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)))
    return _first(sides, keys, F.desc(seq), F.desc("_new")).drop("_new")


def ready_to_process(ledger: DataFrame, done: DataFrame, key: str = "file_name") -> DataFrame:
    """Downloaded files that have not been processed yet."""
    return pending(ledger.filter(F.col("status") == "downloaded"), done, key)


def dedupe_first(
    df: DataFrame, id_col: str = "id", order: Sequence[str] = ("line_no",), scope: str = "file"
) -> DataFrame:
    """First row of each id within its file, or of all files (``scope='global'``)."""
    if scope == "file":
        return _first(df, ["file_name", id_col], *order)
    if scope == "global":
        return _first(df, [id_col], "file_name", *order)
    raise ValueError(f"unknown scope: {scope}")


def dedupe_basename(df: DataFrame, suffix: str, path: str = "path") -> DataFrame:
    """The first path of each file name with ``suffix``."""
    base = F.substring_index(path, "/", -1)
    return (
        df.filter(F.endswith(F.col(path), F.lit(suffix)))
        .groupBy(base.alias("base_name"))
        .agg(F.min(path).alias("path"))
    )


def drop_cancelled(ledger: DataFrame, cancelled: DataFrame) -> DataFrame:
    """Ledger rows whose file, job and input file match no cancelled job."""
    return pending(ledger, cancelled, ["file_name", "batch_id", "file_id"])
