"""Character vocabularies of a corpus."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paralex import fixed_values as V
from paralex.functions.core import col, with_kept
from paralex.operators.text import char_counts


def char_vocabulary(
    df: DataFrame,
    text: str = "text",
    char_class: str = V.HAN,
    size: int = V.VOCABULARY_SIZE,
    order: str | Sequence[str] = "line_no",
) -> DataFrame:
    """``char, cnt, first_line, first_pos`` of the ``size`` most frequent characters.

    Ties go to the character that appears first in ``order``; of several columns,
    such as file and line, ``first_line`` is a struct.  Counting keeps two longs per
    character and task, so the shuffle carries the alphabet, not the corpus.
    Positions are only looked up in the first lines of characters.  That table
    has one row per distinct character, about a million at the very most, so it
    is broadcast and the text stays where it is.
    """
    line = (F.col(order) if isinstance(order, str) else F.struct(*order)).alias("first_line")
    chars = df.select(
        line,
        F.explode(F.split(F.regexp_replace(col(text), f"[^{char_class}]+", ""), "")).alias("char"),
    ).filter("char <> ''")
    counts = chars.groupBy("char").agg(
        F.count(F.lit(1)).alias("cnt"), F.min("first_line").alias("first_line")
    )
    lines = df.select(line, col(text).alias("_text"))
    places = lines.join(F.broadcast(counts), "first_line").select(
        "char", "cnt", "first_line", F.instr("_text", F.col("char")).alias("first_pos")
    )
    # Lines may share a number; the character is in one of them.
    first = F.min(F.when(F.col("first_pos") > 0, F.col("first_pos"))).alias("first_pos")
    placed = places.groupBy("char", "cnt", "first_line").agg(first)
    return placed.orderBy(F.desc("cnt"), "first_line", "first_pos").limit(size)


def vocabulary_string(vocabulary: DataFrame) -> Column:
    """The vocabulary as one scalar string (at most its ``size`` characters)."""
    return vocabulary.agg(F.array_join(F.collect_list("char"), "")).scalar()


def vocabulary_filter(
    df: DataFrame,
    text: str = "text",
    char_class: str = V.HAN,
    size: int = V.VOCABULARY_SIZE,
    max_missing: float = V.OUT_OF_VOCABULARY_RATIO,
    order: str | Sequence[str] = "line_no",
) -> DataFrame:
    """Keep rows with characters of the class, few of them rare in the corpus."""
    known = vocabulary_string(char_vocabulary(df, text, char_class, size, order))
    rates = ["n_class", "n_missing", "missing_ratio"]
    counted = char_counts(text, F.col("_known"), char_class)
    few = lambda r: (r["n_class"] > 0) & (r["missing_ratio"] <= max_missing)
    return with_kept(df.withColumn("_known", known), "_r", counted, few).select(*df.columns, *[F.col(f"_r.{c}") for c in rates])
