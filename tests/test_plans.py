"""What the plans must and must not contain, and behaviour under skew."""

import random

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paralex.operators import langid as L
from paralex.operators.aggregates import concat_by_lang
from paralex.operators.align import align_by_length
from paralex.operators.enrich import enrich
from paralex.operators.vocabulary import char_vocabulary
from paralex.operators import relational as J
from paralex.operators import sharding as S
from paralex.plans import catalog
from paralex.session import scratch
from paralex.sources import text as ST

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


# Row-wise work: no exchange at all.
NARROW = [
    "parse_labelled_response", "parse_labelled_inline", "split_clauses", "pack_sentences", "clean_translation",
    "filter_noise_lines", "post_translation", "post_norm", "post_extract", "parse_sst_pairs", "parse_sst_incremental",
    "align_by_search", "render_translation", "request_envelope", "edit_distance_gate", "fill_missing_from_response",
    "scan_batch_results", "scan_marked_blocks", "detect_missing_langs", "choose_pivot_lang", "route_job_state",
]


@pytest.mark.parametrize("key", NARROW)
def test_row_wise_work_does_not_shuffle(spark, key):
    text = plan(catalog.queries()[key](spark, SF))
    assert "Exchange" not in text


@pytest.mark.parametrize("key", sorted(set(catalog.queries()) - {"enrich_with_retry", "task_registry", "shard_by_bytes"}))
def test_no_python_in_the_plan(spark, key):
    if key.startswith("stream_") or key.startswith("sink_"):
        pytest.skip("runs a job to build its result")
    text = plan(catalog.queries()[key](spark, SF))
    assert "Python" not in text and "InPandas" not in text and "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text


@pytest.mark.parametrize(
    "build",
    [
        lambda df: ST.parse_list(df, "last"),
        lambda df: J.dedupe_first(df.withColumnRenamed("line", "id")),
        lambda df: J.ledger_upsert(df, df, ["file_name"], "line_no"),
        lambda df: ST.read_run_logs(df),
    ],
)
def test_first_per_key_is_limited_before_the_shuffle(spark, build):
    df = spark.createDataFrame([("f", 1, "a b")], "file_name string, line_no bigint, line string")
    assert "Partial" in plan(build(df)) and "WindowGroupLimit" in plan(build(df))


def test_profile_is_bounded_and_broadcast(spark):
    docs = spark.createDataFrame([("en", "the cat"), ("fr", "le chat")], "lang string, text string")
    profiles = L.fit_lang_profiles(docs, ["en", "fr"], scratch(spark, "p"))
    rows = spark.createDataFrame([(1, "the cat sat"), (2, "le chat"), (3, "你好"), (4, "12"), (5, "か漢")], "id int, line string")
    found = L.detect_lang(rows, profiles, ["id"])
    expected = {1: "en", 2: "fr", 3: "zh-cn", 4: "unknown", 5: "ja"}
    assert {r.id: r.detected for r in found.collect()} == expected
    assert "BroadcastHashJoin" in plan(found)
    few = L.fit_lang_profiles(docs, ["en", "fr"], scratch(spark, "p"), most=3)
    assert few.count() == 3 and L.detect_lang(rows, few, ["id"]).count() == 5


def test_profile_keeps_every_gram(spark, monkeypatch):
    """One language has more grams than a profile used to keep; the other's, all rarer, still tell it."""
    letters = "abcdefghijklmnopqrstuvwxyzàáâãäåæçèéêëìíîïðñòóôõöøùúûüýþāăąćĉċčď"
    grams = [a + b + c for a in letters for b in letters for c in letters]
    assert len(grams) > 200_000
    words = [("en", " ".join(grams[at : at + 500])) for at in range(0, len(grams), 500)] * 2
    docs = spark.createDataFrame([*words, ("fr", "жук")], "lang string, text string")
    profiles = L.fit_lang_profiles(docs, ["en", "fr"], scratch(spark, "p"))
    assert profiles.filter("gram = 'жук'").count() == 1 and profiles.count() >= len(grams)
    rows = spark.createDataFrame([(1, "жук"), (2, "жук жук"), (None, "12")], "id int, line string")
    for common in (1, L.COMMON):
        monkeypatch.setattr(L, "COMMON", common)
        found = L.detect_lang(rows, profiles, ["id"])
        assert {r.id: r.detected for r in found.collect()} == {1: "fr", 2: "fr", None: "unknown"}


def test_positions_in_a_file_with_most_rows(spark):
    """One file holds two thirds of the rows and spans several sorted parts; order keys have gaps."""
    rng = random.Random(7)
    keys = {"big": sorted(rng.sample(range(100_000), 4000)), "a": sorted(rng.sample(range(100_000), 1500)), "b": [5]}
    rows = [(f, k) for f, ks in keys.items() for k in ks]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "file_name string, line_no bigint").repartition(5)
    numbered = S.number_rows(df)
    got = {(r.file_name, r.line_no): (r.pos, r.total) for r in numbered.collect()}
    assert got == {(f, k): (i, len(ks)) for f, ks in keys.items() for i, k in enumerate(ks)}
    sums = S.number_rows(df, value=F.col("line_no")).filter("file_name = 'a'").collect()
    assert {r.line_no: r.pos for r in sums} == {k: sum(keys["a"][:i]) for i, k in enumerate(keys["a"])}


def test_positions_of_names(spark):
    names = [f"n{i:05d}" for i in range(0, 3000, 3)] + ["n00000"]
    df = spark.createDataFrame([(n, i) for i, n in enumerate(names)], "file_name string, i int")
    got = sorted((r.file_name, r.i, r.pos) for r in S.number_rows(df, ["file_name", "i"], ()).collect())
    assert [p for _, _, p in got] == list(range(len(names)))


@pytest.mark.parametrize("n, parts", [(7, 3), (3, 5), (10, 5), (1, 1)])
def test_even_parts(spark, n, parts):
    df = spark.range(n).select(F.format_string("f%03d", "id").alias("file_name"))
    sizes = [r["count"] for r in S.assign_even(df, parts, ["file_name"]).groupBy("part").count().orderBy("part").collect()]
    assert sum(sizes) == n and sizes == sorted(sizes, reverse=True) and max(sizes) - min(sizes) <= 1


def brute_shards(sizes, max_bytes, max_rows):
    out, shard, used, count = [], 0, 0, 0
    for size in sizes:
        out.append(shard)
        used, count = used + size, count + 1
        if used >= max_bytes or count >= max_rows:
            shard, used, count = shard + 1, 0, 0
    return out


@pytest.mark.parametrize("max_bytes, max_rows", [(50, 10), (1, 10), (10**9, 7), (120, 10**6)])
def test_byte_shards_against_brute_force(spark, max_bytes, max_rows):
    rng = random.Random(max_bytes)
    sizes = [rng.randrange(1, 40) for _ in range(500)]
    df = spark.createDataFrame([("f", i, s) for i, s in enumerate(sizes)], "file_name string, line_no bigint, bytes bigint")
    for chunk_rows in (1, 64, 1 << 20):
        got = S.shard_by_bytes(df, max_bytes=max_bytes, max_rows=max_rows, chunk_rows=chunk_rows).orderBy("line_no").collect()
        assert [r.shard for r in got] == brute_shards(sizes, max_bytes, max_rows)
        assert [r.row_in_shard for r in got] == [i - [g.shard for g in got].index(r.shard) for i, r in enumerate(got)]


def test_no_row_is_lost_to_null_keys(spark):
    rows = [("f", 1, 5), (None, 2, 5), ("f", None, 5), (None, None, None), ("f", 2, 30), (None, 1, 30)]
    df = spark.createDataFrame(rows, "file_name string, line_no bigint, bytes bigint")
    assert S.shard_by_rows(df, 2).count() == S.sequence_ids(df).count() == len(rows)
    got = S.shard_by_bytes(df, max_bytes=30, max_rows=10, chunk_rows=1).collect()
    assert sorted((str(r.file_name), str(r.line_no), r.shard, r.row_in_shard) for r in got) == [
        ("None", "1", 0, 1), ("None", "2", 1, 0), ("None", "None", 0, 0), ("f", "1", 0, 1), ("f", "2", 0, 2), ("f", "None", 0, 0),
    ]


def test_admission_respects_the_quota(spark):
    pending = spark.createDataFrame([(f"f{i}",) for i in range(9)], "file_name string")
    running = spark.range(3).toDF("n")
    assert [r.file_name for r in S.admit_top_k(pending, running, 5, ["file_name"]).collect()] == ["f0", "f1"]
    assert S.admit_top_k(pending, running, 3, ["file_name"]).count() == 0


def test_admission_fills_all_slots(spark):
    pending = spark.range(25_000).select(F.format_string("f%05d", "id").alias("file_name"), F.lit("x").alias("total"))
    running = spark.range(10_000).toDF("n")
    got = S.admit_top_k(pending, running, 30_000, ["file_name"])
    assert got.columns == ["file_name", "total", "slot"]
    assert [(r.file_name, r.slot) for r in got.orderBy("slot").collect()] == [(f"f{i:05d}", i + 1) for i in range(20_000)]


def test_equal_sequence_numbers_take_the_new_record(spark):
    old = spark.createDataFrame([("f", "old", 3), ("g", "old", 5)], "file_name string, status string, seq bigint")
    new = spark.createDataFrame([("f", "new", 3), ("g", "new", 4)], "file_name string, status string, seq bigint")
    got = {r.file_name: r.status for r in J.ledger_upsert(old, new, ["file_name"]).collect()}
    assert got == {"f": "new", "g": "old"}


def test_trees_of_any_depth(spark):
    rows = [("r", None, "r")] + [(f"n{i}", f"n{i - 1}" if i else "r", f"{i}") for i in range(40)] + [("leaf", "r", "x")]
    got = {r.node: r.topic for r in ST.flatten_paths(spark.createDataFrame(rows, "node string, parent string, label string")).collect()}
    assert got == {"leaf": "r-x", "n39": "r-" + "-".join(map(str, range(40)))}


def test_a_malformed_log_is_set_aside(spark):
    tail = "t | SUCCESS | job - /log/a.json Total prompt tokens: {} | completion tokens: 3 |total tokens: 10 | num_prompt: 4 | num_response: 2 |"
    rows = [(f, n, x) for f, p in (("good", "7"), ("bad", "7x")) for n, x in ((1, "t | INFO | Processed 5/9 lines.|"), (2, tail.format(p)))]
    rows[3] = ("bad", 2, "t | SUCCESS | job - /log/a.json Total prompt tokens: 7 | completion tokens: three |")
    df = spark.createDataFrame(rows, "file_name string, line_no bigint, line string")
    assert [(r.lines, r.send_tokens, r.receive_chars) for r in ST.read_run_logs(df).collect()] == [(5, 7, 2)]
    assert [r.file_name for r in ST.bad_run_logs(df).collect()] == ["bad"]


def test_characters_of_several_files_with_the_same_lines(spark):
    rows = [("a", 1, "xyz"), ("b", 1, "yzq"), ("b", 2, "zz")]
    df = spark.createDataFrame(rows, "file_name string, line_no bigint, text string")
    got = [(r.char, r.cnt) for r in char_vocabulary(df, "text", "a-z", 10, ["file_name", "line_no"]).collect()]
    assert got == [("z", 4), ("y", 2), ("x", 1), ("q", 1)]
    assert sorted(r.char for r in char_vocabulary(df, "text", "a-z", 10).collect()) == ["q", "x", "y", "z"]


def test_segments_without_timestamps_stay(spark):
    segs = spark.createDataFrame([("u", 0, "ab"), ("v", 0, "cd")], "utt string, seg_no int, transcription string")
    chars = spark.createDataFrame([("u", 0, 0, 5), ("u", 1, 5, 9)], "utt string, pos int, start_ms int, end_ms int")
    got = sorted((r.utt, r.start_ms, r.end_ms) for r in align_by_length(segs, chars).collect())
    assert got == [("u", 0, 9), ("v", None, None)]


def test_one_poison_row_fails_alone(spark):
    def fn(batch, attempt):
        if (batch["n"] == 500).any():
            raise ValueError("poison")
        if (batch["n"] == 7).any() and len(batch) > 1:
            return batch[["n"]]  # not the columns asked for
        return pd.DataFrame({"answer": batch["n"].astype(str)})

    df = spark.range(1000).withColumnRenamed("id", "n")
    out = enrich(df, fn, T.StructType([T.StructField("answer", T.StringType())]), max_attempts=2, first_delay=0)
    assert {(r.n, r.attempts) for r in out.collect() if r.outcome != "ok"} == {(500, 2)}


def test_labels_go_before_the_language_is_asked(spark):
    lines = "array<struct<pos:int,line:string,lang:string,text_lang:string>>"
    df = spark.createDataFrame([(1, [(0, "英文：Good morning my friend", "zh-cn", "en"), (1, "你好", "zh-cn", "zh-cn")])], f"id int, lines {lines}")
    row = concat_by_lang(df).first()
    assert row["en"] == "Good morning my friend" and row["zh-cn"] == "你好"


def test_timestamps_of_a_small_table_are_not_broadcast(spark):
    """Texts of a small table hold many characters; the join would send all of them to the driver."""
    text = plan(catalog.queries()["align_by_length"](spark, SF))
    assert "SortMergeJoin [utt#" in text


def test_lines_without_a_label_are_scored_once(spark, monkeypatch):
    """Only what a label hides is scored a second time."""
    from paralex.plans import aggregates_queries as A

    blocks = spark.createDataFrame([("f", 1, 0, ["hello there", "英文：Good morning", None])], "file_name string, doc_id int, block_no int, lines array<string>")
    seen = []

    def detected(spark, sf, rows, keys):
        seen.extend(r.line for r in rows.collect())
        return rows.select(*keys, F.concat(F.lit("of "), F.coalesce("line", F.lit("-"))).alias("detected"))

    monkeypatch.setattr(A, "usable_blocks", lambda s, d: blocks)
    monkeypatch.setattr(A, "detected", detected)
    lines = A.block_lines(spark, "").first().lines
    assert sorted(filter(None, seen)) == ["Good morning", "hello there", "英文：Good morning"]
    assert [(x.lang, x.text_lang) for x in lines] == [("of hello there", "of hello there"), ("of 英文：Good morning", "of Good morning"), ("of -", "of -")]


def test_small_profiles_are_met_once(spark):
    docs = spark.createDataFrame([("en", "the cat"), ("fr", "le chat")], "lang string, text string")
    profiles = L.fit_lang_profiles(docs, ["en", "fr"], scratch(spark, "p"))
    text = plan(L.detect_lang(spark.createDataFrame([(1, "the cat")], "id int, line string"), profiles, ["id"]))
    assert text.count("BroadcastHashJoin") == 1 and "SortMergeJoin" not in text and "_salt" not in text
