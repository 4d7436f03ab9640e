"""Times for text segments from character or word timestamps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paralex import fixed_values as V
from paralex.functions.core import let, strip
from paralex.operators.sharding import number_rows
from paralex.operators.text import normalize


def align_by_length(segs: DataFrame, chars: DataFrame) -> DataFrame:
    """``utt, seg_no, transcription, start_ms, end_ms``: each segment covers as
    many character timestamps as it has characters, clamped to the last one.

    An empty segment has no times, nor have those of an utterance without
    timestamps; of several timestamps of one position the earliest start and
    the latest end count.  Offsets come from a two-step running sum, and both
    times from one equi join on (utterance, position), so one very long
    utterance spreads over tasks like many short ones.  Timestamps are shuffled
    once and never broadcast: a small table of texts may hold many of them, which
    its size does not tell.  Their last positions are counted by partial sums.
    """
    placed = number_rows(segs.withColumn("_seg", F.monotonically_increasing_id()), "seg_no", ["utt"], F.length("transcription"))
    last = chars.groupBy("utt").agg(F.max("pos").cast("bigint").alias("_last"))
    size = F.length("transcription")
    ends = F.when(size > 0, F.array(F.col("pos"), F.col("pos") + size - 1))
    wanted = placed.join(last, "utt", "left").select(
        "_seg", "utt", "seg_no", "transcription",
        F.posexplode_outer(F.transform(ends, lambda p: F.least(p, F.col("_last")))).alias("_side", "pos"),
    )
    times = chars.select("utt", F.col("pos").cast("bigint").alias("pos"), "start_ms", "end_ms")
    return (
        wanted.join(times.hint("merge"), ["utt", "pos"], "left")
        .groupBy("_seg", "utt", "seg_no", "transcription")
        .agg(
            F.min(F.when(F.col("_side") == 0, F.col("start_ms"))).alias("start_ms"),
            F.max(F.when(F.col("_side") == 1, F.col("end_ms"))).alias("end_ms"),
        )
        .drop("_seg")
    )


def align_by_search(
    df: DataFrame, segments: str = "segments", tokens: str = "tokens"
) -> DataFrame:
    """Add ``aligned ARRAY<STRUCT<transcription, start_ms, end_ms>>``.

    One row is one utterance with ``segments ARRAY<STRUCT<transcription>>`` and
    ``tokens ARRAY<STRUCT<word, start_ms, end_ms>>``.  Both sides are compared
    without punctuation, white space and case.  A segment is searched from the
    end of the one before it: as is, then without one character on the left or
    right, then without two.  One that is not found starts at the cursor, ends
    with the last token and leaves the cursor; one that is empty after
    normalising has no times.  Blank segments are removed.

    The cursor makes an utterance sequential; it is folded inside its row, so
    nothing is shuffled.
    """

    def search(words: Column) -> Column:
        return let(
            F.struct(
                F.array_join(words, "").alias("text"),
                F.flatten(F.transform(words, lambda w, i: F.array_repeat(i, F.length(w)))).alias("owner"),
                F.transform(tokens, lambda t: t["start_ms"].cast("bigint")).alias("start"),
                F.transform(tokens, lambda t: t["end_ms"].cast("bigint")).alias("end"),
            ),
            fold,
        )

    def fold(full: Column) -> Column:
        text, owner = full["text"], full["owner"]
        last = F.size(full["start"]) - 1

        def found(at: Column, size: Column) -> Column:
            return F.struct(
                (at - 1 + size).alias("cursor"),
                F.get(owner, at - 1).alias("first"),
                F.get(owner, at + size - 2).alias("last"),
            )

        def attempt(cursor: Column, needle: Column, guard: Column, otherwise: Column) -> Column:
            at = F.when(guard, F.call_function("locate", needle, text, cursor + 1)).otherwise(0)
            return let(
                F.struct(at.alias("at")),
                lambda hit: F.when(hit["at"] > 0, found(hit["at"], F.length(needle))).otherwise(otherwise),
            )

        def step(acc: Column, s: Column) -> Column:
            needle, cursor = s["needle"], acc["cursor"]
            size = F.length(needle)
            result = F.struct(
                cursor.alias("cursor"),
                F.when(cursor < F.size(owner), F.get(owner, cursor)).otherwise(last).alias("first"),
                last.alias("last"),
            )
            for cut in (2, 1):
                for part in (F.left(needle, size - cut), F.substr(needle, F.lit(cut + 1))):
                    result = attempt(cursor, part, size > cut, result)
            result = attempt(cursor, needle, size > 0, result)
            nothing = F.struct(
                cursor.alias("cursor"),
                F.lit(None).cast("int").alias("first"),
                F.lit(None).cast("int").alias("last"),
            )
            placed = F.when(size == 0, nothing).otherwise(result)

            def append(r: Column) -> Column:
                times = F.struct(
                    s["transcription"].alias("transcription"),
                    F.get(full["start"], r["first"]).alias("start_ms"),
                    F.get(full["end"], r["last"]).alias("end_ms"),
                )
                return F.struct(
                    r["cursor"].alias("cursor"), F.concat(acc["out"], F.array(times)).alias("out")
                )

            return let(placed, append)

        wanted = F.transform(
            F.filter(segments, lambda s: strip(s["transcription"]) != ""),
            lambda s: F.struct(
                s["transcription"].alias("transcription"),
                normalize(s["transcription"], "search").alias("needle"),
            ),
        )
        start = F.struct(
            F.lit(0).alias("cursor"),
            F.array().cast("array<struct<transcription:string,start_ms:bigint,end_ms:bigint>>").alias("out"),
        )
        return F.aggregate(wanted, start, step, lambda acc: acc["out"])

    words = F.transform(tokens, lambda t: normalize(t["word"], "search"))
    return df.withColumn("aligned", let(words, search))


def attach_punctuation(tokens: DataFrame) -> DataFrame:
    """``utt, pos, word, start_ms, end_ms`` with full-width marks glued to the
    word before them; they lose their own time.

    ASCII marks are ordinary tokens.  Marks before the first word are dropped.
    A word and its marks are the only rows that meet in a group.
    """
    glued = F.col("word").rlike(V.GLUED_PUNCTUATION)
    own = F.when(glued, 0).otherwise(1)
    numbered = number_rows(
        tokens.withColumn("_at", F.col("pos")).drop("pos"), "_at", ["utt"], own
    ).withColumn("_word", F.col("pos") + own)
    parts = F.array_sort(F.collect_list(F.struct("_at", "word")))
    return (
        numbered.filter("_word > 0")
        .groupBy("utt", (F.col("_word") - 1).alias("pos"))
        .agg(
            F.array_join(F.transform(parts, lambda p: p["word"]), "").alias("word"),
            F.min(F.when(~glued, F.col("start_ms"))).alias("start_ms"),
            F.max(F.when(~glued, F.col("end_ms"))).alias("end_ms"),
        )
    )
