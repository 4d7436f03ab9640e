"""Queries of the row-wise operators."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from paralex.llm import bpe, language, mixture, packing, quality_model, quality_rules, token_counts, toxicity
from paralex.llm.common import held_out, table


def op1_bpe(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = docs.select("doc_id", bpe.bpe_round_trip(public_tokenizers.path("byte_bpe_50k.json"))("text").alias("t"))
    return coded.select(
        "doc_id", F.size("t.ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("t.ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("t.decoded", 256).alias("decoded_sha256"),
    )


END, SEQUENCE = 1, 4096


def op3_packing(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    pieces = packing.token_pieces(docs, public_tokenizers.path("word_bpe_49k.json"), END, SEQUENCE)
    narrow = pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return packing.best_fit(narrow, SEQUENCE)


MIXED = 2048


def op11_mixture(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    queues = mixture.token_queues(docs, public_tokenizers.path("word_bpe_49k.json"), END)
    return mixture.mix(queues, MIXED).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "source",
    )


def op2_quality_rules(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    judged = docs.select("doc_id", quality_rules.quality()("text").alias("q"))
    shown = [*quality_rules.COUNTS, "base_failed", "kept", *quality_rules.FAULTS]
    return judged.select("doc_id", *[f"q.{c}" for c in shown])


def op4_language(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    answer = language.language_of(spark, language.fit(docs))
    return docs.select("doc_id", answer("text").alias("a")).select(
        "doc_id", held_out().alias("held_out"), F.col("a.lang").alias("lang_pred"), "a.score", "a.distance", "a.rejected"
    )


def op6_token_counts(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = token_counts.token_counts(public_tokenizers.path("byte_bpe_50k.json"))("text")
    return docs.select("doc_id", counted.alias("t")).select("doc_id", "t.n_words", "t.n_tokens")


def op8_quality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality_model.fit(docs, table(spark, sf_dir, "labels"))
    scored = docs.select("doc_id", quality_model.score(model)("text").alias("s"))
    return scored.select(
        "doc_id", held_out().alias("held_out"), "s.score", (F.col("s.score") >= 0.3).cast("int").alias("predicted")
    )


def op10_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    scored = docs.select("doc_id", toxicity.toxicity(spark, model)("text").alias("score"))
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


QUERIES = {
    "op1_bpe": op1_bpe, "op2_quality_rules": op2_quality_rules, "op3_packing": op3_packing, "op4_language": op4_language,
    "op6_token_counts": op6_token_counts, "op8_quality": op8_quality, "op10_toxicity": op10_toxicity,
    "op11_mixture": op11_mixture,
}
ORACLE: dict[str, str] = {}
