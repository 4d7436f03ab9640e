"""Plain-text sources: id-text lists, marked blocks, keyed prompts, run logs,
word alignments and label trees."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from paralex import fixed_values as V
from paralex.functions.core import alternation, col, strip, with_kept
from paralex.session import stored


def parse_list(
    df: DataFrame, dedupe: str = "none", line: str = "line", order: str = "line_no"
) -> DataFrame:
    """``id<white space>text`` lines as ``id, text``; other lines go.

    ``dedupe='last'`` keeps the last line of an id within its file.  The rank
    filter is pushed below the shuffle, so a hot id sends one row per task.
    """
    parts = F.split(strip(line), f"[{V.SPACE}]+", 2)
    out = (
        with_kept(df, "_parts", parts, lambda p: F.size(p) == 2)
        .withColumn("id", F.get("_parts", 0))
        .withColumn("text", F.get("_parts", 1))
        .drop(line, "_parts")
    )
    if dedupe == "none":
        return out
    if dedupe != "last":
        raise ValueError(f"unknown dedupe: {dedupe}")
    latest = Window.partitionBy("file_name", "id").orderBy(F.desc(order))
    return out.withColumn("_rank", F.row_number().over(latest)).filter("_rank = 1").drop("_rank")


def read_blocks(
    df: DataFrame, marker: str = V.BLOCK_MARKER, body: str = "body", keep: Sequence[str] = ()
) -> DataFrame:
    """One row per non-empty block of a text column: ``block_no, block``.

    ``block_no`` is 0 for the first block after a leading marker.
    """
    return df.select(
        *keep, F.posexplode(F.split(col(body), alternation([marker]))).alias("block_no", "block")
    ).withColumn("block_no", F.col("block_no") - 1).filter("block <> ''")


def read_numbered_lines(spark: SparkSession, path: str, line_sep: str = "\n", schema: str = "value string") -> DataFrame:
    """Lines of text files with ``file_path`` and their 0-based place in the file,
    ``pos``; ``schema`` may name partition columns.

    Nothing is sorted.  A row id grows within a split of a file, so the place is
    what the splits before it hold, by a first pass that counts without keeping
    text, and the distance to the split's smallest id.  Both passes read one
    listing of the files, which gives them the same splits.
    """
    lines = spark.read.schema(schema).option("lineSep", line_sep).text(path).select(
        "*", F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_block_start").alias("_split"),
        F.monotonically_increasing_id().alias("_id"),
    )
    splits = lines.groupBy("file_path", "_split").agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy("file_path").orderBy("_split").rowsBetween(Window.unboundedPreceding, -1)
    before = splits.select("file_path", "_split", "_first", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    placed = lines.join(before, ["file_path", "_split"])
    return placed.withColumn("pos", F.col("_before") + F.col("_id") - F.col("_first")).drop("_split", "_id", "_first", "_before")


def read_block_files(spark: SparkSession, path: str, marker: str = V.BLOCK_MARKER) -> DataFrame:
    """File variant, ``file_name, block_no, block``: the marker is the record
    separator, so a large file is still split among tasks."""
    return (
        read_numbered_lines(spark, path, marker)
        .select(F.col("file_path").alias("file_name"), (F.col("pos") - 1).alias("block_no"), F.col("value").alias("block"))
        .filter("block <> ''")
    )


def mark_blocks(block: str | Column, marker: str = V.RECORD_MARK) -> Column:
    """Prefix a record with its marker, for writing with :func:`read_blocks`' rules."""
    return F.concat(F.lit(marker), col(block))


def read_keyed_prompts(df: DataFrame, line: str = "line") -> DataFrame:
    """First value of a one-entry JSON object per line; other lines go."""
    entries = F.from_json(line, "map<string,string>")
    return (
        with_kept(df, "_entries", entries, lambda m: F.size(m) > 0)
        .withColumn("key", F.get(F.map_keys("_entries"), 0))
        .withColumn("prompt", F.get(F.map_values("_entries"), 0))
        .drop(line, "_entries")
    )


def _alignment(df: DataFrame, line: str) -> tuple[DataFrame, list[str], Column]:
    """One row per entry, or one with null ``pos`` for a line without any; the
    kept columns, and whether an entry is well formed."""
    entries = F.from_json(
        line, "struct<tiers:struct<words:struct<entries:array<array<string>>>>>"
    )["tiers"]["words"]["entries"]
    kept = [c for c in df.columns if c != line]
    ms = lambda i: F.floor(F.get("_e", i).try_cast("double") * 1000).try_cast("int")
    rows = df.withColumn("_entries", entries).select(
        *kept, line, F.col("_entries").isNull().alias("_none"), F.posexplode_outer("_entries").alias("pos", "_e")
    ).select(
        *kept, line, "_none", "pos", F.get("_e", 2).alias("word"), ms(0).alias("start_ms"), ms(1).alias("end_ms"),
        F.to_json("_e").alias("entry"),
    )
    good = F.col("start_ms").isNotNull() & F.col("end_ms").isNotNull() & F.col("word").isNotNull()
    return rows, kept, good


def read_alignment(df: DataFrame, line: str = "line") -> DataFrame:
    """``pos, word, start_ms, end_ms`` per entry of a word-alignment object.

    Seconds become whole milliseconds, cut not rounded.  Entries without a word
    or with a time that is no number, and lines that are no such object, are
    returned by :func:`bad_alignment`.
    """
    rows, kept, good = _alignment(df, line)
    return rows.filter(F.col("pos").isNotNull() & good).select(*kept, "pos", "word", "start_ms", "end_ms")


def bad_alignment(df: DataFrame, line: str = "line") -> DataFrame:
    """What :func:`read_alignment` cannot read: ``pos`` and ``entry`` of a
    malformed entry, or the whole ``line`` where it is no alignment object.  (An
    object with an empty list has no entries and is not bad.)"""
    rows, kept, good = _alignment(df, line)
    bad = rows.filter(F.col("_none") | (F.col("pos").isNotNull() & ~good))
    return bad.select(*kept, "pos", F.when(F.col("_none"), F.col(line)).otherwise(F.col("entry")).alias("entry"))


COUNTERS = ["lines", "total_tokens", "send_tokens", "receive_tokens", "send_chars", "receive_chars"]


def _run_logs(df: DataFrame, line: str, order: str) -> DataFrame:
    """Counters of the successful runs, null where missing or no number, and the
    two last lines of each log.

    The rank filter runs before the shuffle as well, so a log holding most of
    the rows still sends two lines per task.
    """
    last = Window.partitionBy("file_name").orderBy(F.desc(order))
    tail = (
        df.filter(strip(line) != "")
        .withColumn("_rank", F.row_number().over(last))
        .filter("_rank <= 2")
        .groupBy("file_name")
        .agg(
            F.max(F.when(F.col("_rank") == 1, F.col(line))).alias("_last"),
            F.max(F.when(F.col("_rank") == 2, F.col(line))).alias("_before"),
        )
    )
    fields = F.filter(F.transform(F.split("_last", r"\|"), strip), lambda x: x != "")
    counter = lambda i: F.substring_index(F.get("_f", i), ": ", -1).try_cast("bigint")
    number = lambda c, p: F.regexp_extract(c, p, 1).try_cast("bigint")
    rows = tail.withColumn("_f", fields).filter(
        (F.get("_f", 1) == "SUCCESS") & F.col("_before").rlike(V.LOG_LINES)
    )
    return rows.select(
        F.col("file_name").alias("log_name"), "_before", "_last",
        F.get("_f", 0).alias("finish_time"),
        F.regexp_extract(F.get("_f", 2), V.LOG_FILE, 1).alias("file_name"),
        number("_before", V.LOG_LINES).alias("lines"),
        counter(4).alias("total_tokens"),
        number(F.get("_f", 2), V.LOG_PROMPT_TOKENS).alias("send_tokens"),
        counter(3).alias("receive_tokens"),
        counter(5).alias("send_chars"),
        counter(6).alias("receive_chars"),
    )


def read_run_logs(df: DataFrame, line: str = "line", order: str = "line_no") -> DataFrame:
    """Counters and rates of the successful runs; logs with a counter that is
    missing or no number are left to :func:`bad_run_logs`."""
    total, sent, chars = F.col("total_tokens"), F.col("send_tokens"), F.col("send_chars")
    div = lambda a, b: a.cast("double") / F.greatest(b, F.lit(1)).cast("double")
    rows = _run_logs(df, line, order).dropna(subset=COUNTERS).drop("log_name", "_before", "_last")
    return rows.withColumns(
        {
            "tokens_per_line": div(total, F.col("lines")),
            "receive_send_ratio": div(F.col("receive_tokens"), sent),
            "tokens_chars_ratio": div(total, chars + F.col("receive_chars")),
        }
    ).orderBy("finish_time", "file_name")


def bad_run_logs(df: DataFrame, line: str = "line", order: str = "line_no") -> DataFrame:
    """``file_name`` and the last two lines of logs set aside by :func:`read_run_logs`."""
    whole = F.coalesce(*[F.when(F.col(c).isNull(), True) for c in COUNTERS], F.lit(False))
    return _run_logs(df, line, order).filter(whole).select(
        F.col("log_name").alias("file_name"), F.col("_before").alias("line_before"), F.col("_last").alias("last_line")
    )


def flatten_tree(df: DataFrame, tree: str = "tree", sep: str = "-") -> DataFrame:
    """Root-to-leaf paths of a ``MAP<k, MAP<k, ARRAY<leaf>>>`` column, in order."""
    kept = [c for c in df.columns if c != tree]
    first = df.select(*kept, F.posexplode(tree).alias("_i", "_a", "_t"))
    second = first.select(*kept, "_i", "_a", F.posexplode("_t").alias("_j", "_b", "_l"))
    third = second.select(*kept, "_i", "_a", "_j", "_b", F.posexplode("_l").alias("_k", "_c"))
    return third.select(*kept, "_i", "_j", "_k", F.concat_ws(sep, "_a", "_b", "_c").alias("topic"))


def json_depth(json: str | Column) -> Column:
    """How deep the brackets of a JSON text are nested; those in strings do not count."""
    bare = F.regexp_replace(col(json), r'"(?:[^"\\]|\\.)*+"', "")
    step = lambda s, b: F.struct(
        (s["now"] + F.when(b.isin("{", "["), 1).otherwise(-1)).alias("now"),
        F.greatest(s["most"], s["now"] + F.when(b.isin("{", "["), 1).otherwise(0)).alias("most"),
    )
    zero = F.struct(F.lit(0).alias("now"), F.lit(0).alias("most"))
    return F.aggregate(F.regexp_extract_all(bare, F.lit(r"[\[\]{}]"), 0), zero, step, lambda s: s["most"])


def _opened(df: DataFrame, json: str, holds: Column, depth: int) -> DataFrame:
    """Every value of JSON trees that ``holds`` (of its type ``kind``) does not
    say to open: ``row`` (the other columns), ``v``, ``kind``, ``place`` and ``path``.

    One level is one generator over the rows of its own task, so there is no
    exchange.
    """
    kept = [c for c in df.columns if c != json]
    row = F.struct(*kept) if kept else F.struct(F.lit(0).alias("_"))
    walk = df.select(
        row.alias("row"), F.try_parse_json(json).alias("v"), F.array().cast("array<int>").alias("place"),
        F.array().cast("array<string>").alias("path"),
    ).filter("v IS NOT NULL").withColumn("kind", F.schema_of_variant("v"))
    for _ in range(depth):
        here = walk.select("*", F.when(holds, F.col("v")).alias("inner")).alias("t")
        inside = df.sparkSession.tvf.variant_explode_outer(F.col("t.inner").outer()).alias("e")
        found = F.col("e.pos").isNotNull()
        walk = here.lateralJoin(inside).filter(F.col("t.inner").isNull() | found).select(
            F.col("t.row").alias("row"), F.when(found, F.col("e.value")).otherwise(F.col("t.v")).alias("v"),
            F.when(found, F.concat("t.place", F.array("e.pos"))).otherwise(F.col("t.place")).alias("place"),
            F.when(F.col("e.key").isNotNull(), F.concat("t.path", F.array("e.key"))).otherwise(F.col("t.path")).alias("path"),
        ).withColumn("kind", F.schema_of_variant("v"))
    return walk


def flatten_json(df: DataFrame, json: str = "tree", sep: str = "-") -> DataFrame:
    """Root-to-leaf paths of JSON trees of any and mixed depth.

    Objects add the name of a member to the path, lists nothing; a leaf that is
    a string is the last part, other leaves (numbers, null) add nothing.  Paths
    without a part, and empty objects and lists, give no row.  ``place`` holds
    the position on every level: members by name (VARIANT keeps no other order),
    list elements in theirs.  Text that is no JSON is returned by
    :func:`bad_trees`.

    The plan has as many levels as the deepest tree, which one pass finds first.
    """
    kept = [c for c in df.columns if c != json]
    holds = F.col("kind").rlike("^(OBJECT|ARRAY)<")
    walk = _opened(df, json, holds, df.agg(F.max(json_depth(json))).first()[0] or 0)
    text = F.when(F.col("kind") == "STRING", F.array(F.col("v").cast("string"))).otherwise(F.array().cast("array<string>"))
    # Only empty objects and lists are left unopened.
    parts = walk.filter(~holds).select("row", "place", F.concat("path", text).alias("parts")).filter(F.size("parts") > 0)
    return parts.select(*[F.col(f"row.`{c}`") for c in kept], "place", F.array_join("parts", sep).alias("topic"))


def json_leaves(df: DataFrame, json: str = "ledger") -> DataFrame:
    """``path`` (names from the root) and ``value`` (JSON text) of every leaf of
    JSON objects of any depth.  Lists, null and empty objects are leaves.  Text
    that is no JSON is returned by :func:`bad_trees`."""
    kept = [c for c in df.columns if c != json]
    holds = F.col("kind").startswith("OBJECT<") & (F.col("kind") != EMPTY_OBJECT)
    walk = _opened(df, json, holds, df.agg(F.max(json_depth(json))).first()[0] or 0)
    return walk.select(*[F.col(f"row.`{c}`") for c in kept], "path", F.to_json("v").alias("value"))


EMPTY_OBJECT = "OBJECT<>"


def bad_trees(df: DataFrame, json: str = "tree") -> DataFrame:
    """Rows whose text is null or no JSON (or repeats a name in an object)."""
    return df.filter(F.try_parse_json(json).isNull())


def _ends(edges: DataFrame) -> DataFrame:
    """``node`` and ``end`` of every node that has a parent: all ends of its ways
    up, ``root`` and ``orphan`` (a missing parent).  A node that has none leads
    into a cycle only.

    Pointers are doubled: after each turn they lead twice as far up.  Every node
    on a way to an end lies closer to it, so a turn in which no node meets an end
    it did not know leaves none to be met, and cycles cost no turns of their
    own.  A turn writes the pointers that still move and the ends just met.
    """
    nodes = edges.select(F.col("node").alias("up")).filter("up IS NOT NULL").distinct().withColumn("_listed", F.lit(True))
    first = edges.select("node", F.col("parent").alias("up")).filter("node IS NOT NULL").distinct().join(nodes, "up", "left").select(
        "node", "up", F.when(F.col("up").isNull(), "root").when(F.col("_listed").isNull(), "orphan").alias("end")
    )
    first = stored(first, "pointers")
    ends = first.filter("end IS NOT NULL").select("node", "end")
    moving = _unrooted(first.filter("end IS NULL").select("node", "up"), ends)
    while True:
        # What a pointer leads to: the ends met so far from there, and pointers that go on.
        above = ends.select(F.col("node").alias("up"), F.lit(None).cast(edges.schema["node"].dataType).alias("_up"), "end").unionByName(
            moving.select(F.col("node").alias("up"), F.col("up").alias("_up"), F.lit(None).cast("string").alias("end"))
        )
        # Pointers that go on have no end yet, so none of them is among the known ones.
        turn = moving.join(above, "up").select("node", F.col("_up").alias("up"), "end").distinct()
        turn = stored(turn.join(ends, ["node", "end"], "left_anti").select("node", "up", "end"), "pointers")
        met = turn.filter("end IS NOT NULL").select("node", "end")
        if met.isEmpty():
            return ends
        ends = ends.unionByName(met)
        moving = _unrooted(turn.filter("end IS NULL").select("node", "up"), met)


def _unrooted(pointers: DataFrame, ends: DataFrame) -> DataFrame:
    """Pointers of nodes that no way to a root is known of; no better end can be met."""
    return pointers.join(ends.filter("end = 'root'").select("node"), "node", "left_anti")


def _rooted(edges: DataFrame) -> DataFrame:
    """``edges`` with what they hang on as ``ends``: a ``root``, else a missing
    parent (``orphan``), else a ``cycle``."""
    rank = F.when(F.col("end") == "root", 0).otherwise(1)
    best = _ends(edges).groupBy("node").agg(F.min_by("end", rank).alias("_end"))
    listed = edges.select("node").filter("node IS NOT NULL").distinct()
    above = listed.join(best, "node", "left").select(F.col("node").alias("parent"), F.coalesce("_end", F.lit("cycle")).alias("_end"))
    return edges.join(above, "parent", "left").withColumn(
        "ends", F.when(F.col("parent").isNull(), "root").otherwise(F.coalesce("_end", F.lit("orphan")))
    ).drop("_end")


def tree_paths(df: DataFrame, sep: str = "-") -> tuple[DataFrame, DataFrame]:
    """Leaves, as ``node, topic``, of a tree of any depth held as ``node,
    parent, label`` rows, and the rows that hang on no root, with ``reason``
    ``orphan`` or ``cycle``.

    A root has no parent.  Paths are put together by doubling, so the number of
    joins is the logarithm of the depth, not the depth.  A node listed more than
    once has a path for each way up.
    """
    rows = stored(df.select("node", "parent", "label"), "edges")
    edges = stored(_rooted(rows), "ends")
    rejected = edges.filter("ends <> 'root'").select("node", "parent", "label", F.col("ends").alias("reason"))
    paths = stored(edges.filter("ends = 'root'").select("node", F.col("parent").alias("up"), F.col("label").alias("topic")), "paths")
    while not paths.filter("up IS NOT NULL").isEmpty():
        above = paths.select(F.col("node").alias("up"), F.col("up").alias("_up"), F.col("topic").alias("_topic"))
        longer = paths.filter("up IS NOT NULL").join(above, "up").select(
            "node", F.col("_up").alias("up"), F.concat_ws(sep, "_topic", "topic").alias("topic")
        )
        paths = stored(paths.filter("up IS NULL").unionByName(longer), "paths")
    inner = rows.select(F.col("parent").alias("node")).filter("node IS NOT NULL")
    return paths.select("node", "topic").join(inner, "node", "left_anti"), rejected


def flatten_paths(df: DataFrame, sep: str = "-") -> DataFrame:
    """The leaves of :func:`tree_paths`."""
    return tree_paths(df, sep)[0]
