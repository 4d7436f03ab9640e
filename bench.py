"""Times registered queries and prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local cores.  The text
tables are first written again in as many files as a cluster would find, since
one small file is one task; that is not timed.  Each query runs once to warm up
and three times for the clock, and the median counts.  Results go to a null
sink, so every row is computed and nothing is collected.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from paralex.plans import catalog
from paralex.plans.fixtures import TABLES
from paralex.session import local_session, scratch

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = 3

HEADLINE = [
    "usage_report", "parse_labelled_response", "post_translation", "scan_batch_results",
    "split_clauses", "pack_sentences", "clean_translation", "edit_distance_gate",
    "filter_noise_lines", "language_id", "concat_by_lang", "vocab_filter", "char_frequency_topn",
    "render_translation", "request_envelope", "join_supplement", "ledger_upsert", "dedupe_first_id",
    "shard_by_rows", "shard_by_bytes", "align_by_length", "align_by_search", "attach_punctuation",
    "parse_sst_incremental", "enrich_with_retry",
]


def laid_out(spark) -> str:
    """A copy of the tables with the long texts in two files per core."""
    folder = scratch(spark, "bench")
    files = 2 * spark.sparkContext.defaultParallelism
    for name in TABLES:
        rows = spark.read.parquet(f"{SF_DIR}/{name}.parquet")
        rows = rows.repartition(files) if name in ("documents", "conversations") else rows
        rows.write.parquet(f"{folder}/{name}.parquet")
    return folder


def main() -> None:
    spark = local_session(CPUS)
    tables = laid_out(spark)
    runs = catalog.queries()
    names = sys.argv[1:] or HEADLINE
    names = list(runs) if names == ["all"] else names
    seconds = {}
    for name in names:
        taken = []
        for _ in range(1 + RUNS):
            start = time.perf_counter()
            runs[name](spark, tables).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(taken[1:]), 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    total = round(sum(seconds.values()), 3)
    sf = os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "total_warm_seconds", "value": total, "unit": "sec", "queries": seconds, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
