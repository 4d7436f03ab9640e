"""Cleaning of a corpus: language, toxicity, near copies, repeated passages, packing.

Every stage calls one operator of the training-data library, works on all that
the stage before it kept, and is written as Parquet and read again.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paralex.llm import language, packing, passages, simhash, toxicity
from paralex.llm.common import stored, table

SHINGLE, MAX_BITS = 4, 4
WINDOW = 20
TOXIC = 0.5
END, SEQUENCE = 1, 4096


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; without letters, or far from
    every language learned, they go."""
    answer = language.language_of(spark, language.fit(docs))
    return docs.withColumn("__answer", answer("text")).filter(~F.col("__answer.rejected")).drop("__answer")


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the limit of toxicity."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    scored = docs.withColumn("__toxic", toxicity.toxicity(spark, model)("text"))
    return scored.filter(F.col("__toxic") < TOXIC).drop("__toxic")


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return simhash.one_of_each(docs, SHINGLE, MAX_BITS)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages found earlier; the words left of a changed
    text are joined by single spaces, other texts stay as they are."""
    cut = passages.remove_repeats(docs, WINDOW, "__repeats")
    changed = F.col("__repeats.n_removed") > 0
    columns = {"text": F.when(changed, F.col("__repeats.kept")).otherwise(F.col("text"))}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        columns["n_chars"] = F.when(changed, F.length("__repeats.kept").cast(kind)).otherwise(F.col("n_chars"))
    return cut.withColumns(columns).drop("__repeats")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces placed in sequences."""
    pieces = packing.token_pieces(docs, public_tokenizers.path("word_bpe_49k.json"), END, SEQUENCE)
    narrow = pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return packing.best_fit(narrow, SEQUENCE)


STAGES = [
    ("language", known_language),
    ("toxicity", not_toxic),
    ("near_copies", one_of_near_copies),
    ("repeats", without_repeats),
    ("packing", packed),
]
ORACLE_SQL = None  # learned models and packing are not SQL; tested against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs


def queries() -> dict:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
