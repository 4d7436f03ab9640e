"""File variants of the sources and sinks."""

import os

from pyspark.sql import functions as F
from pyspark.sql import types as T

from paralex.operators import predicates as P
from paralex.operators import relational as J
from paralex.plans.tasks import run_task
from paralex.session import scratch
from paralex.sources import jsonl, sinks
from paralex.sources import text as S


def write(path, name, text):
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/{name}", "w", encoding="utf-8") as f:
        f.write(text)


def test_block_files(spark):
    path = scratch(spark, "blocks")
    write(path, "a.multi", "test48:one\ntwotest48:three")
    assert sorted(r.block for r in S.read_block_files(spark, path).collect()) == ["one\ntwo", "three"]


def test_jsonl_files_keep_bad_lines(spark):
    path = scratch(spark, "lines")
    write(path, "a.jsonl", '{"k": 1}\n{"k": \n')
    rows = jsonl.read_jsonl_files(spark, path, T.StructType([T.StructField("k", T.LongType())])).collect()
    assert sorted((r.k, r._corrupt) for r in rows if r.k) == [(1, None)]
    assert [r._corrupt for r in rows if r._corrupt] == ['{"k": ']


def test_listing_reads_names_only(spark):
    path = scratch(spark, "tree")
    for folder, name in (("", "a_punc_train.list"), ("/x/y", "b_punc_train.list"), ("/x/y/z", "c_punc_train.list"),
                         ("/x", "d.txt")):
        write(path + folder, name, "x")
    files = P.list_files(spark, path).withColumn("path", F.regexp_replace("path", "^file:", ""))
    kept = P.filter_inventory(files, 2, "_punc_train.list", path).collect()
    assert sorted(os.path.basename(r.path) for r in kept) == ["a_punc_train.list", "b_punc_train.list"]


def test_only_completed_parts_are_read(spark):
    path = scratch(spark, "parts")
    write(path, "a.jsonl", '{"en": "1"}\n')
    write(path, "b.jsonl", '{"en": "2"}\n')
    ledger = spark.createDataFrame([("a.jsonl",), ("gone.jsonl",)], "file_name string")
    assert [r.en for r in J.read_completed(spark, path, ledger, "en string").collect()] == ["1"]


def test_shards_join_up_to_the_input(spark):
    rows = [("f.txt", i, f"line {i} é") for i in range(57)]
    df = spark.createDataFrame(rows, "file_name string, line_no bigint, line string").withColumn(
        "shard", F.floor(F.col("line_no") / 10))
    path = scratch(spark, "shards")
    manifest = sinks.write_sharded(df, path).orderBy("shard").collect()
    assert [r.rows for r in manifest] == [10] * 5 + [7]
    assert sum(r.bytes for r in manifest) == sum(len(r[2].encode()) + 1 for r in rows)
    back = spark.read.text(path).orderBy("shard").collect()
    assert sorted(r.value for r in back) == sorted(r[2] for r in rows)


def test_keyed_prompt_round_trip(spark):
    df = spark.createDataFrame([('{"0001": "p\\nq"}',), ("{}",), ("x",)], "line string")
    assert [(r.key, r.prompt) for r in S.read_keyed_prompts(df).collect()] == [("0001", "p\nq")]


def test_failed_and_rejected_rows_are_set_aside(spark):
    import pandas as pd

    def fn(batch, attempt):
        if attempt == 1:
            raise RuntimeError("busy")
        ok = batch[batch["user"] != "never"]
        return pd.DataFrame({"answer": ok["user"]})

    rows = [("f", 1, "a", "x"), ("f", 2, "a", "y"), ("f", 3, "b", "never"), ("f", 4, "c", None), ("f", 5, None, "z")]
    df = spark.createDataFrame(rows, "file_name string, line_no int, utt string, text string")
    out = run_task(df, "norm", fn, {"src_lang": "en"}, max_attempts=2, first_delay=0.0)
    assert [(r.utt, r.text) for r in out.results.collect()] == [("a", "x")]
    rest = sorted((str(r.id), r.outcome) for r in out.rest.collect())
    assert rest == [("None", "rejected"), ("b", "failed"), ("c", "rejected")]
