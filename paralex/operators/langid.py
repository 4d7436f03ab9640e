"""Language of lines: scripts by character class, the rest by trigram profiles.

Profiles are trained from labelled text.  Scores are whole numbers, so sums do
not depend on the order in which partitions are added up.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paralex.functions.core import col

SCALE = 1_000_000
COMMON = 200_000  # grams of a profile that are broadcast
SALTS = 8  # tasks over which the texts with one gram are dealt
# Scripts that settle the language; kana is asked before Han.
SCRIPTS = [
    ("ja", r"[\p{IsHiragana}\p{IsKatakana}]"),
    ("ko", r"\p{IsHangul}"),
    ("zh-cn", r"\p{IsHan}"),
    ("th", r"\p{IsThai}"),
    ("ar", r"\p{IsArabic}"),
]


# Script classes are slow to test; only text with letters beyond these blocks is.
BEYOND = r"[\u0590-\x{10FFFF}]"


def script_index(text: str | Column) -> Column:
    """Position in ``SCRIPTS`` of the script that settles the language, else null."""
    hits = F.coalesce(*[F.when(col(text).rlike(p), F.lit(i)) for i, (_, p) in enumerate(SCRIPTS)])
    return F.when(col(text).rlike(BEYOND), hits)


def trigrams(text: str | Column) -> Column:
    """Overlapping letter trigrams, words set apart by single spaces."""
    letters = F.lower(F.regexp_replace(col(text), r"[^\p{L}]+", " "))
    return F.regexp_extract_all(letters, F.lit("(?s)(?=(...))"), F.lit(1))


def fit_lang_profiles(
    df: DataFrame, langs: Sequence[str], path: str, text: str = "text", lang: str = "lang", most: int | None = None
) -> DataFrame:
    """Write ``gram`` and one weight per language (scaled log of the smoothed
    share) below ``path`` and return that table.

    The profile keeps every gram; a caller may ask for the ``most`` frequent ones.

    Counts are combined before the shuffle, so it carries distinct grams.  They are
    written before they are weighed, which needs their totals: the text is
    read once.  The profile is a table because every detection reads it and
    needs its totals.
    """
    grams = df.filter(F.col(lang).isin(list(langs))).select(lang, F.explode(trigrams(text)).alias("gram"))
    counts = grams.groupBy("gram").agg(*[F.count_if(F.col(lang) == c).alias(c) for c in langs])
    counts.write.mode("overwrite").parquet(f"{path}/counts")
    counts = df.sparkSession.read.parquet(f"{path}/counts")
    totals = counts.agg(
        F.struct(*[F.sum(c).alias(c) for c in langs], F.count(F.lit(1)).alias("grams"))
    ).scalar()
    rows = counts.withColumn("_t", totals)

    def weight(c: str) -> Column:
        share = (F.col(c) + 1).cast("double") / (F.col("_t")[c] + F.col("_t")["grams"]).cast("double")
        return F.round(F.log(share) * SCALE).cast("bigint")

    if most is not None:
        rows = rows.orderBy(F.desc(sum(F.col(c) for c in langs)), "gram").limit(most)
    rows.select("gram", *[weight(c).alias(c) for c in langs]).write.mode("overwrite").parquet(f"{path}/weights")
    return df.sparkSession.read.parquet(f"{path}/weights")


def detect_lang(df: DataFrame, profiles: DataFrame, keys: Sequence[str], text: str = "line") -> DataFrame:
    """``keys`` and ``detected`` per row; ``unknown`` without evidence.

    Profiles have any size.  Their ``COMMON`` weightiest grams are broadcast, so
    most grams of a text are scored and added up where they are.  The others are
    counted per row and meet the whole profile under one of ``SALTS`` numbers
    taken from the row's keys, which deals rows with the same gram to several
    tasks.  Both constants change the work alone.  The text itself is never
    shuffled.  Ties go to the first language.

    Profiles of no more than ``COMMON`` grams have no others, so the rows are
    added up at once.
    """
    langs = [c for c in profiles.columns if c != "gram"]
    # The script is settled per row, below the explode.
    rows = df.select(*keys, script_index(text).alias("_script"), col(text).alias("_text"))
    grams = rows.select(
        *keys, "_script", F.explode_outer(F.when(F.col("_script").isNull(), trigrams("_text"))).alias("gram")
    )
    if profiles.count() <= COMMON:
        sums = grams.join(F.broadcast(profiles), "gram", "left").groupBy(*keys).agg(
            F.max("_script").alias("_script"), *[F.sum(c).alias(c) for c in langs]
        )
        return _settled(sums, langs, keys)
    weightiest = profiles.orderBy(F.desc(F.greatest(*langs)), "gram").limit(COMMON)
    near = grams.join(F.broadcast(weightiest), "gram", "left")
    other = F.when(F.col(langs[0]).isNull(), F.col("gram"))
    counts = near.groupBy(*keys, other.alias("gram")).agg(
        F.max("_script").alias("_script"), F.count(F.lit(1)).alias("_n"), *[F.sum(c).alias(f"_near_{c}") for c in langs]
    )
    # Rows without other grams meet nothing; they are dealt by their keys alone.
    salt = F.xxhash64(*keys)
    salted = counts.withColumn("_salt", F.when(F.col("gram").isNull(), salt).otherwise(F.pmod(salt, F.lit(SALTS))))
    copies = profiles.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint"))))
    scored = salted.join(copies, ["gram", "_salt"], "left")
    sums = scored.groupBy(*keys).agg(
        F.max("_script").alias("_script"),
        *[F.sum(F.coalesce(F.col(f"_near_{c}"), F.col(c) * F.col("_n"))).alias(c) for c in langs],
    )
    return _settled(sums, langs, keys)


def _settled(sums: DataFrame, langs: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """``keys`` and ``detected`` from the script of a row and its scores."""
    best = F.greatest(*[F.col(c) for c in langs])
    guess = F.coalesce(*[F.when(F.col(c) == best, F.lit(c)) for c in langs], F.lit("unknown"))
    codes = F.array(*[F.lit(code) for code, _ in SCRIPTS])
    return sums.select(*keys, F.coalesce(F.get(codes, F.col("_script")), guess).alias("detected"))
