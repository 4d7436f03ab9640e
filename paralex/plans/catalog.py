"""All registered queries and their checking SQL."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

from paralex.plans.fixtures import with_inputs

SECTIONS = [
    "sources", "predicates", "text", "requests", "responses", "relational", "aggregates",
    "sharding", "alignment", "streams", "enrichment",
]


# Columns whose whole-number type the checking engine widens.
WIDENED = {
    "INTEGER": {
        "scan_marked_blocks": ["block_no"], "scan_word_alignment": ["pos"], "scan_topic_tree": ["leaf"],
        "filter_noise_lines": ["block_no", "pos"], "split_clauses": ["pos"], "pack_sentences": ["para", "pos"],
        "char_class_ratio": ["n_class", "n_missing"], "post_topic": ["pos"], "parse_sst_pairs": ["pos"],
        "parse_sst_incremental": ["pos"], "vocab_filter": ["n_class", "n_missing"],
        "min_langs_gate": ["block_no", "pos"], "concat_by_lang": ["block_no"],
        "shard_by_bytes": ["shard", "row_in_shard"], "admit_top_k": ["slot"], "align_by_search": ["seg"],
        "stream_admission": ["slot"],
    },
    "BIGINT": {"align_by_length": ["start_ms", "end_ms"], "attach_punctuation": ["pos"]},
}


def _typed(key: str, sql: str) -> str:
    casts = [f"CAST({c} AS {t}) AS {c}" for t, keys in WIDENED.items() for c in keys.get(key, [])]
    return f"SELECT * REPLACE ({', '.join(casts)}) FROM ({sql})" if casts else sql


def _sections() -> list:
    return [import_module(f"paralex.plans.{name}_queries") for name in SECTIONS]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {key: run for section in _sections() for key, run in section.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {key: _typed(key, with_inputs(sql)) for section in _sections() for key, sql in section.ORACLE.items()}
