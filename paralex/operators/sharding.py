"""Positions, shards and admission.

One file may hold a large share of all rows, so no task sees a whole file.
Rows are sorted once over all files, written, and numbered by where they lie:
counts per file and sorted part are summed up separately, and a row's position
is the sum of the parts before it and its place in its own part.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from functools import partial, reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paralex import fixed_values as V
from paralex.functions.core import int_div
from paralex.session import stored

PART_BITS = 33  # low bits of a row id that count rows inside a part
CHUNK_ROWS = 1 << 16
SPLITTERS = 64  # ranges of the order in which first rows are looked for


def join_null_safe(
    left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner", shuffled: bool = False
) -> DataFrame:
    """Equi-join in which null keys meet; the keys come from ``left``.

    ``shuffled`` is for sides that hold many more rows than the size of their
    source tells, as generators give them: neither is broadcast.
    """
    renamed = right.withColumnsRenamed({c: f"__{c}" for c in on})
    if shuffled:
        renamed = renamed.hint("merge")
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in on])
    return left.join(renamed, same, how).drop(*[f"__{c}" for c in on])


def number_rows(
    df: DataFrame,
    order: str | Sequence[str] = "line_no",
    keys: Sequence[str] = ("file_name",),
    value: Column | None = None,
) -> DataFrame:
    """Add ``pos`` (0-based) and ``total`` within ``keys``, by ``order``.

    With ``value`` the position is the sum of values of earlier rows.  Null keys
    are a key of their own; null orders come first; rows equal in ``order`` are
    numbered in any order.
    """
    order = [order] if isinstance(order, str) else list(order)
    weight = F.lit(1).cast("bigint") if value is None else F.coalesce(value.cast("bigint"), F.lit(0).cast("bigint"))
    ordered = df.withColumn("_w", weight).orderBy(*keys, *order)
    rows = stored(ordered.withColumn("_id", F.monotonically_increasing_id()), "numbered")
    rows = rows.withColumn("_part", F.shiftright("_id", PART_BITS))
    sums = rows.groupBy(*keys, "_part").agg(F.min("_id").alias("_first"), F.sum("_w").alias("_s"))
    parts = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    earlier = F.sum("_s").over(parts.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    sums = sums.withColumns({"_before": F.coalesce(earlier, F.lit(0)), "total": F.sum("_s").over(parts)}).drop("_s")
    placed = join_null_safe(rows.drop("total"), sums, [*keys, "_part"])
    if value is None:
        inside = F.col("_id") - F.col("_first")
    else:
        inside = F.coalesce(
            F.sum("_w").over(Window.partitionBy(*keys, "_part").orderBy("_id").rowsBetween(Window.unboundedPreceding, -1)),
            F.lit(0),
        )
    return placed.withColumn("pos", F.col("_before") + inside).drop("_w", "_id", "_part", "_first", "_before")


def shard_by_rows(df: DataFrame, rows: int = V.SHARD_ROWS, order: str = "line_no", first: int = 0) -> DataFrame:
    """Add ``shard``, ``row_in_shard``, ``shard_name`` (three digits) and ``custom_id``."""
    n = number_rows(df, order)
    shard = int_div("pos", rows) + first
    return n.withColumn("shard", shard).withColumn("row_in_shard", F.col("pos") % rows).withColumns(
        {
            "shard_name": F.concat_ws(
                "_", F.regexp_replace("file_name", r"\.[^.]*$", ""),
                F.when(F.col("shard") < 1000, F.lpad(F.col("shard").cast("string"), 3, "0"))
                .otherwise(F.col("shard").cast("string")),
            ),
            "custom_id": F.concat_ws("-", "file_name", "shard", "row_in_shard"),
        }
    ).drop("pos", "total")


def _next_starts(size: np.ndarray, max_bytes: int, max_rows: int) -> np.ndarray:
    """For each row, the row after a shard that starts there."""
    ends = np.cumsum(size)
    full = np.searchsorted(ends, ends - size + max_bytes, "left") + 1
    rows = np.arange(len(size))
    return np.maximum(rows + 1, np.minimum(np.minimum(full, rows + max_rows), len(size)))


def _next_starts_written(size: np.ndarray, max_bytes: int, max_rows: int, digits: int) -> np.ndarray:
    """As :func:`_next_starts` for lines that also hold the number of their
    shard, of ``digits`` digits, and their row in it.

    ``m`` rows, numbered from 0, with at most ``w`` digits each hold ``w * m``
    digits less a constant, so sums with ``w`` digits more for every row tell
    where a shard ends that has numbers of up to ``w`` digits.
    """
    ends = np.concatenate([[0], np.cumsum(size)])
    rows, after = np.arange(len(size)), np.full(len(size), len(size))
    open_rows = np.ones(len(size), bool)
    for width in range(1, len(str(max_rows)) + 1):
        fewer = (10**width - 10) // 9
        sums = ends + np.arange(len(ends)) * (digits + width)
        end = np.searchsorted(sums, sums[rows] + max_bytes + fewer, "left")
        fits = open_rows & (end - rows <= 10**width) & (end < len(ends))
        after[fits] = end[fits]
        open_rows &= ~fits
    return np.maximum(rows + 1, np.minimum(np.minimum(after, rows + max_rows), len(size)))


def _leap(rows: pd.DataFrame, next_starts: Callable, chunk_rows: int) -> tuple[pd.DataFrame, np.ndarray, int]:
    """Sorted rows of a chunk and those after it, next starts, and the chunk's length."""
    rows = rows.sort_values("pos")
    own = int((rows["pos"] // chunk_rows == rows["_chunk"]).sum())
    return rows, next_starts(rows["_size"].to_numpy(np.int64)), own


def _followed(placed: DataFrame, starts: DataFrame, next_starts: Callable, max_rows: int, chunk_rows: int) -> DataFrame:
    """``file_name, pos, _nth, _begin``: for rows of files from ``starts`` on,
    which shard since then they lie in (from 1) and the row where it begins.

    ``placed`` has ``file_name, pos, total, _size``; ``next_starts`` gives for
    sizes of rows one after another the row after a shard that starts there.
    """
    chunk_rows = max(chunk_rows, max_rows)
    pos = F.col("pos")
    chunk = int_div("pos", chunk_rows)
    chunks = F.when((chunk > 0) & (pos % chunk_rows < max_rows), F.array(chunk, chunk - 1)).otherwise(F.array(chunk))
    sizes = placed.withColumn("_chunk", F.explode(chunks))
    key = placed.schema["file_name"]
    longs = lambda *names: [T.StructField(n, T.LongType()) for n in names]

    def pointers(rows: pd.DataFrame) -> pd.DataFrame:
        rows, to, own = _leap(rows, next_starts, chunk_rows)
        while (inside := to[:own] < own).any():  # each turn doubles the shards stepped over
            to[:own][inside] = to[to[:own][inside]]
        most = min(own, max_rows)
        at = rows["pos"].to_numpy()[:most]
        out = pd.DataFrame({"file_name": rows["file_name"].iloc[:most], "pos": at, "to": rows["pos"].iloc[0] + to[:most]})
        return out[out["to"] < rows["total"].iloc[0]]

    spanned = placed.agg(F.max(chunk) - F.min(chunk) + 1).first()[0] or 1
    steps = math.ceil(math.log2(spanned))
    reached = starts
    if steps:
        leap = stored(sizes.groupBy("file_name", "_chunk").applyInPandas(pointers, T.StructType([key, *longs("pos", "to")])), "leaps")
        for _ in range(steps):
            more = join_null_safe(reached, leap, ["file_name", "pos"]).select("file_name", F.col("to").alias("pos"))
            reached = stored(reached.union(more), "starts")
            then = leap.select("file_name", F.col("to").alias("_then"), F.col("pos").alias("to"))
            leap = stored(join_null_safe(leap, then, ["file_name", "to"]).select("file_name", "pos", F.col("_then").alias("to")), "leaps")
    entries = reached.select("file_name", int_div("pos", chunk_rows).alias("_chunk"), F.col("pos").alias("_entry"))

    def mark(rows: pd.DataFrame) -> pd.DataFrame:
        rows, after, own = _leap(rows, next_starts, chunk_rows)
        first = int(rows["pos"].iloc[0])
        opens, at = np.zeros(own, bool), rows["_entry"].iloc[0]
        at = own if pd.isna(at) else int(at) - first
        while at < own:
            opens[at] = True
            at = after[at]
        count = np.cumsum(opens)
        begin = np.maximum.accumulate(np.where(opens, first + np.arange(own), -1))
        return pd.DataFrame({
            "file_name": rows["file_name"].iloc[:own], "pos": rows["pos"].iloc[:own], "_chunk": rows["_chunk"].iloc[:own],
            "_nth": count, "_begin": begin,
        })

    marked = stored(
        join_null_safe(sizes, entries, ["file_name", "_chunk"], "left")
        .groupBy("file_name", "_chunk").applyInPandas(mark, T.StructType([key, *longs("pos", "_chunk", "_nth", "_begin")])),
        "shards",
    )
    earlier = Window.partitionBy("file_name").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    ends = marked.groupBy("file_name", "_chunk").agg(F.max("_nth").alias("_n"), F.max("_begin").alias("_last")).select(
        "file_name", "_chunk", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"),
        F.max("_last").over(earlier).alias("_open"),
    )
    return join_null_safe(marked, ends, ["file_name", "_chunk"]).select(
        "file_name", "pos", (F.col("_before") + F.col("_nth")).alias("_nth"),
        F.when(F.col("_begin") >= 0, F.col("_begin")).otherwise(F.col("_open")).alias("_begin"),
    )


def _sized(placed: DataFrame, size: Column) -> DataFrame:
    return placed.select("file_name", "pos", "total", F.coalesce(size.cast("bigint"), F.lit(0).cast("bigint")).alias("_size"))


def shard_by_bytes(
    df: DataFrame,
    size: str = "bytes",
    max_bytes: int = V.SHARD_BYTES,
    max_rows: int = V.SHARD_ROWS,
    order: str = "line_no",
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Add ``shard`` and ``row_in_shard``: a shard of a file ends with the row
    that brings it to ``max_bytes`` or to ``max_rows`` rows.

    Where a shard ends depends on all shards before it.  A file is looked at in
    chunks, each with the rows a shard may reach beyond it.  A chunk tells, for
    every row a shard of the chunk before can lead to, the first start in the
    next chunk; these pointers are followed from the first row in doubling
    steps.  Then each chunk marks its own starts.  ``chunk_rows`` sets the work
    of a task, never the result.  Null sizes count as 0.
    """
    placed = stored(number_rows(df, order), "positions")
    next_starts = partial(_next_starts, max_bytes=max_bytes, max_rows=max_rows)
    first = placed.filter("pos = 0").select("file_name", "pos")
    named = _followed(_sized(placed, F.col(size)), first, next_starts, max_rows, chunk_rows)
    out = join_null_safe(placed.drop("shard"), named, ["file_name", "pos"])
    return out.withColumns(
        {"shard": (F.col("_nth") - 1).cast("int"), "row_in_shard": (F.col("pos") - F.col("_begin")).cast("int")}
    ).drop("pos", "total", "_nth", "_begin")


def shard_by_written_bytes(
    df: DataFrame,
    size: str = "bytes",
    max_bytes: int = V.SHARD_BYTES,
    max_rows: int = V.SHARD_ROWS,
    order: str = "line_no",
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """As :func:`shard_by_bytes` for lines that hold ``shard`` and
    ``row_in_shard`` as decimal numbers: ``size`` is the length of a line without
    these digits, and a shard ends with the row that brings the written lines to
    ``max_bytes`` or to ``max_rows`` rows.

    How long a line gets depends on where it falls.  The digits of the row
    follow from the shard's first row; those of the shard are the same for the
    shards 0 to 9, 10 to 99, and so on.  So starts are followed for one such run
    of shards after another, from the row where the run before ended, over the
    rows that the run can reach.
    """
    # Rows are written once, as they come; only sizes are sorted and followed.
    rows = stored(df.drop("shard", "row_in_shard").withColumn("_row", F.monotonically_increasing_id()), "rows")
    narrow = rows.select("file_name", F.col(order).alias("_order"), "_row", F.col(size).alias("_bytes"))
    placed = stored(number_rows(narrow, ["_order", "_row"]).drop("_order"), "positions")
    sizes = _sized(placed, F.col("_bytes"))
    starts, digits, named = placed.filter("pos = 0").select("file_name", "pos"), 1, []
    while True:
        first = 0 if digits == 1 else 10 ** (digits - 1)
        shards = 10**digits - first
        from_row = starts.withColumnRenamed("pos", "_from")
        inside = join_null_safe(sizes, from_row, ["file_name"]).filter(
            (F.col("pos") >= F.col("_from")) & (F.col("pos") - F.col("_from") <= shards * max_rows)
        ).drop("_from")
        next_starts = partial(_next_starts_written, max_bytes=max_bytes, max_rows=max_rows, digits=digits)
        marks = stored(_followed(inside, starts, next_starts, max_rows, chunk_rows), "rolled")
        named.append(
            marks.filter(F.col("_nth") <= shards).withColumn("_shard", F.col("_nth") - 1 + first)
        )
        starts = stored(marks.filter((F.col("_nth") == shards + 1) & (F.col("pos") == F.col("_begin"))).select("file_name", "pos"), "starts")
        if starts.isEmpty():
            break
        digits += 1
    found = join_null_safe(placed, reduce(DataFrame.union, named), ["file_name", "pos"]).select(
        "_row", F.col("_shard").alias("shard"), (F.col("pos") - F.col("_begin")).alias("row_in_shard")
    )
    return rows.join(found, "_row").drop("_row")


def shard_by_bytes_approx(
    df: DataFrame, size: str = "bytes", max_bytes: int = V.SHARD_BYTES, order: str = "line_no"
) -> DataFrame:
    """Shards cut at multiples of ``max_bytes`` of the running size of the file:
    near-even, with no dependence between shards."""
    n = number_rows(df, order, value=F.col(size))
    return n.withColumn("shard", int_div("pos", max_bytes)).drop("pos", "total")


def file_number(name: str | Column) -> Column:
    """The number before a file's extension, 0 without one."""
    name = F.col(name) if isinstance(name, str) else name
    digits = F.regexp_extract(name, V.FILE_NUMBER, 1)
    return F.when(digits == "", F.lit(0).cast("bigint")).otherwise(digits.cast("bigint"))


def group_files_by_suffix(
    files: DataFrame, task: str, size: int = V.FILES_PER_TASK, name: str = "file_name"
) -> DataFrame:
    """Order files by their trailing number, in groups of ``size`` per task."""
    n = number_rows(files.withColumn("_number", file_number(name)), ["_number", name], ())
    k = int_div("pos", size)
    return n.withColumn("task_name", F.concat_ws("_", F.lit(task), k)).drop("pos", "total", "_number")


def assign_even(df: DataFrame, parts: int, order: Sequence[str]) -> DataFrame:
    """Add ``part``: contiguous runs of the sorted list, the first ones one longer."""
    n = number_rows(df, order, ())
    size, longer = int_div("total", parts), F.col("total") % parts
    head = longer * (size + 1)
    part = F.when(F.col("pos") < head, int_div("pos", size + 1)).otherwise(
        longer + int_div(F.col("pos") - head, F.greatest(size, F.lit(1)))
    )
    return n.withColumn("part", part).drop("pos", "total")


def chunk_fixed(df: DataFrame, order: Sequence[str], size: int = V.TOPICS_PER_FILE) -> DataFrame:
    """Add ``chunk`` and ``row_in_chunk`` for runs of ``size`` rows of the sorted list."""
    n = number_rows(df, order, ())
    return n.withColumn("chunk", int_div("pos", size)).withColumn(
        "row_in_chunk", F.col("pos") % size
    ).drop("pos", "total")


def _first_ranges(rows: DataFrame, order: Sequence[str], wanted: Column) -> DataFrame:
    """Rows of the leading ranges of the order that hold the first ``wanted`` rows."""
    return _ranges_between(rows, order, F.lit(0), wanted)[0]


def _ranges_between(rows: DataFrame, order: Sequence[str], start: Column, stop: Column) -> tuple[DataFrame, int]:
    """Rows of the ranges of the order that hold positions ``[start, stop)``, and
    how many rows lie before them.

    Ranges lie between a few rows drawn by hash.  Rows per range are counted
    (partial sums, one row a range), and ranges before that of the first wanted
    row, or behind that of the last, are left out before anything is sorted.
    The drawn rows steer how much is left out, never which rows are wanted.
    """
    key = F.struct(*order)
    drawn = rows.select(key.alias("k")).orderBy(F.xxhash64("k"), "k").limit(SPLITTERS)
    splitters = drawn.agg(F.collect_set("k").alias("ks")).scalar()
    ranged = rows.withColumn("_ks", splitters).withColumn("_range", F.size(F.filter("_ks", lambda s: s <= key))).drop("_ks")
    upto = F.sum("n").over(Window.partitionBy(F.lit(0)).orderBy("_range"))
    counts = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("n")).withColumn("upto", upto)
    before = F.col("upto") <= start
    last, skipped, first = counts.agg(
        F.min(F.when(F.col("upto") >= stop, F.col("_range"))), F.max(F.when(before, F.col("upto"))),
        F.max(F.when(before, F.col("_range"))),
    ).first()
    inside = F.col("_range").between(0 if first is None else first + 1, SPLITTERS if last is None else last)
    return ranged.filter(inside).drop("_range"), skipped or 0


def admit_top_k(pending: DataFrame, running: DataFrame, most: int | Column, order: Sequence[str]) -> DataFrame:
    """The first pending files that fit the free slots ``most`` - running.

    ``most`` may be a scalar subquery.  Only the ranges of the order that reach
    the last free slot are sorted and numbered, by parts as in
    :func:`number_rows`, so any number of slots is filled.
    """
    used = running.agg(F.count(F.lit(1)).alias("n")).scalar()
    # The struct keeps columns of the files from meeting those of the numbering.
    rows = pending.select(F.struct(*pending.columns).alias("_file"))
    free = (F.lit(most) if isinstance(most, int) else most) - used
    by = [f"_file.{c}" for c in order]
    numbered = number_rows(_first_ranges(rows, by, free), by, ())
    return numbered.filter(F.col("pos") < free).select("_file.*", (F.col("pos") + 1).cast("int").alias("slot"))


def order_oldest_first(
    files: DataFrame, done: DataFrame, locked: DataFrame, time: str, name: str = "file_name"
) -> DataFrame:
    """Files neither done nor locked, oldest modification first."""
    out = files.join(done.select(name), name, "left_anti").join(locked.select(name), name, "left_anti")
    return out.orderBy(time, name)


def slice_sorted(df: DataFrame, order: Sequence[str], start: int, stop: int) -> DataFrame:
    """Positions ``[start, stop)`` of the rows sorted by ``order``, in that order.

    Only the ranges of the order that reach these positions are sorted and
    numbered, so a slice far into the rows, or a long one, ends in no single
    task.  Null orders come first; of rows equal in ``order`` any may be in.
    """
    rows = df.select(F.struct(*df.columns).alias("_file"))
    by = [f"_file.{c}" for c in order]
    ranged, skipped = _ranges_between(rows, by, F.lit(start), F.lit(stop))
    pos = F.col("pos") + skipped
    return number_rows(ranged, by, ()).filter((pos >= start) & (pos < stop)).orderBy("pos").select("_file.*")


def preview(df: DataFrame, rows: int = 5) -> DataFrame:
    return df.limit(rows)


def sequence_ids(df: DataFrame, order: str = "line_no", width: int = 4) -> DataFrame:
    """Add ``key``: the zero-padded position in the file."""
    n = number_rows(df, order)
    digits = F.col("pos").cast("string")
    return n.withColumn(
        "key", F.lpad(digits, F.greatest(F.length(digits), F.lit(width)), F.lit("0"))
    ).drop("pos", "total")
