"""Queries of the near-duplicate and repeated-passage operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from paralex.llm import passages, simhash
from paralex.llm.common import table

SHINGLE, MAX_BITS = 4, 4


def op5_simhash(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = simhash.near_duplicates(docs, SHINGLE, MAX_BITS)
    return found.select("doc_id", simhash.hex_digits("fp").alias("fingerprint"), "component_id")


WINDOW = 20


def op7_passages(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return passages.remove_repeats(docs, WINDOW).select(
        "doc_id", "repeats.n_words", "repeats.n_removed", F.sha2("repeats.kept", 256).alias("kept_sha256")
    )


QUERIES = {"op5_simhash": op5_simhash, "op7_passages": op7_passages}
ORACLE: dict[str, str] = {}
