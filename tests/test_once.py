"""Each id once for ever, over micro-batches far apart, repeated and skewed."""

import random

from pyspark.sql import functions as F

from paralex.session import scratch
from paralex.streaming import jobs as S
from paralex.streaming import once as O

SCHEMA = "id string, ts bigint, round string, bucket string, _row string"


def rows_of(rng, n):
    ids = ["hot" if rng.random() < 0.3 else rng.choice([None, "", *map(str, range(40))]) for _ in range(n)]
    return [(i, rng.randrange(10), rng.choice("xy"), None, rng.choice("pq")) for i in ids]


def test_batches_against_a_plain_loop(spark):
    rng, seen, want = random.Random(5), set(), {}
    ledger, sink = scratch(spark, "seen"), scratch(spark, "first")
    for number in range(5):
        rows = [] if number == 2 else rows_of(rng, 60)
        batch = spark.createDataFrame(rows, SCHEMA)
        want[number] = {i: min(r[1] for r in rows if r[0] == i) for i in {r[0] for r in rows} - seen}
        seen |= {r[0] for r in rows}
        for _ in range(2):  # a batch that fails after its writes is run again
            O.once_batch(batch, number, ["id"], ["ts"], ledger, sink, 4)
            got = spark.read.schema(SCHEMA).parquet(f"{sink}/batch={number}").collect()
            assert {r.id: r.ts for r in got} == want[number] and len(got) == len(want[number])
    kept = spark.read.schema("k0 string, round bigint, bucket int").parquet(ledger)
    assert kept.count() == len(seen) == kept.select("k0").distinct().count()


def test_a_repeated_batch_does_not_see_later_rounds(spark):
    ledger, sink = scratch(spark, "seen"), scratch(spark, "first")
    one = spark.createDataFrame([("a", 1), ("b", 2)], "id string, ts bigint")
    two = spark.createDataFrame([("b", 0), ("c", 2)], "id string, ts bigint")
    for number, batch in ((0, one), (1, two), (0, one), (1, two)):
        O.once_batch(batch, number, ["id"], ["ts"], ledger, sink)
    got = spark.read.parquet(sink).select("id", "ts", "batch").collect()
    assert sorted(map(tuple, got)) == [("a", 1, 0), ("b", 2, 0), ("c", 2, 1)]


def test_copies_behind_any_watermark_and_a_restart(spark):
    path, ledger, sink, mark = (scratch(spark, x) for x in ("in", "seen", "first", "cp"))
    for rows in ([(1, 100), (2, 100)], [(1, 10**9), (3, 5)], [(2, 0), (3, 0), (4, 0), (4, 0)]):
        spark.createDataFrame(rows, "id bigint, ts bigint").write.mode("append").parquet(path)
        O.once_to(S.arriving_files(spark, path, "id bigint, ts bigint"), ["id"], ["ts"], ledger, sink, mark)
    assert sorted((r.id, r.ts) for r in spark.read.parquet(sink).collect()) == [(1, 100), (2, 100), (3, 5), (4, 0)]


def test_several_keys_with_nulls(spark):
    ledger, sink = scratch(spark, "seen"), scratch(spark, "first")
    rows = [(None, 1, 0), (None, None, 0), (None, 1, 1), ("a", 1, 0)]
    for number in range(2):
        O.once_batch(spark.createDataFrame(rows, "a string, b int, t int"), number, ["a", "b"], ["t"], ledger, sink)
    got = spark.read.parquet(sink).select("a", "b", "t", "batch").collect()
    assert sorted(map(tuple, got), key=str) == sorted([(None, 1, 0, 0), (None, None, 0, 0), ("a", 1, 0, 0)], key=str)


def test_only_buckets_of_the_batch_are_looked_up(spark):
    ledger, sink = scratch(spark, "seen"), scratch(spark, "first")
    O.once_batch(spark.range(5000).select("id", F.col("id").alias("ts")), 0, ["id"], ["ts"], ledger, sink, 16)
    seen = spark.read.schema("k0 bigint, round bigint, bucket int").parquet(ledger).filter("round < 1")
    plan = O.first_ever(spark.range(3).select("id", F.col("id").alias("ts")), seen, ["id"], ["ts"], 16)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in text.lower() and "Cartesian" not in text and "NestedLoop" not in text
