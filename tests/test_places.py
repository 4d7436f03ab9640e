"""Numbers by place in a file, counts of a written pass, first rows without a full sort."""

import random
import re

import pytest
from pyspark.sql import functions as F

from paralex.operators import sharding as S
from paralex.session import scratch
from paralex.sources import sinks
from paralex.sources import text as ST


@pytest.fixture
def tiny_splits(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "7", "spark.sql.files.openCostInBytes": "3"}
    old = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def test_places_with_splits_of_a_few_bytes(spark, tiny_splits, tmp_path):
    rng = random.Random(3)
    want = []
    for f in range(3):
        lines = ["".join(rng.choices("abé ", k=rng.choice([0, 1, 2, 30]))) for _ in range(40)]
        (tmp_path / f"f{f}.txt").write_text("\n".join(lines) + ("\n" if f else ""), encoding="utf-8")
        if not f and not lines[-1]:
            lines.pop()
        want += [(f"f{f}.txt", i, x) for i, x in enumerate(lines)]
    rows = ST.read_numbered_lines(spark, str(tmp_path))
    assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 30
    got = rows.select(F.regexp_extract("file_path", "[^/]+$", 0), "pos", "value").collect()
    assert sorted(map(tuple, got)) == sorted(want)


def test_block_numbers_of_files_equal_those_of_columns(spark, tiny_splits, tmp_path):
    body = "<B>one\ntwo<B><B>three<B>" + "x" * 40 + "<B>\n<B>last"
    (tmp_path / "blocks.txt").write_text(body)
    got = ST.read_block_files(spark, str(tmp_path), "<B>").select("block_no", "block").collect()
    column = ST.read_blocks(spark.createDataFrame([(body,)], "body string"), re.escape("<B>")).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, column)) and len(got) == 5


def test_counts_of_the_written_pass(spark):
    rows = spark.range(100).withColumn("ok", F.when(F.col("id") % 10 != 0, F.col("id") % 3 == 0))
    counters = {"total": F.count(F.lit(1)), "good": F.count_if("ok"), "ids": F.sum("id")}
    path = scratch(spark, "counted")
    assert sinks.write_counted(rows, path, counters, F.col("ok")) == {"total": 100, "good": 30, "ids": 4950}
    assert spark.read.parquet(path).count() == 30
    none = rows.filter("id < 0")
    assert sinks.write_counted(none, path, counters) == {"total": 0, "good": 0, "ids": None}


@pytest.mark.parametrize("slots", [0, 1, 37, 500, 10_000])
def test_first_rows_with_ties_nulls_and_a_hot_key(spark, slots):
    rng = random.Random(slots)
    names = [None] * 5 + ["hot"] * 300 + [f"f{rng.randrange(400)}" for _ in range(600)]
    rng.shuffle(names)
    pending = spark.createDataFrame([(n, i) for i, n in enumerate(names)], "name string, pos int").repartition(4)
    running = spark.createDataFrame([("r",)] * 2, "name string")
    got = S.admit_top_k(pending, running, slots, ["name", "pos"]).collect()
    order = sorted(((n, i) for i, n in enumerate(names)), key=lambda x: (x[0] is not None, x[0] or "", x[1]))
    want = [(*x, k + 1) for k, x in enumerate(order[: max(0, slots - 2)])]
    assert sorted(map(tuple, got), key=lambda x: x[2]) == want


def test_few_rows_are_sorted_for_few_slots(spark):
    rows = spark.range(50_000).select(F.format_string("part-%07d", "id").alias("name")).repartition(4)
    kept = S._first_ranges(rows, ["name"], F.lit(10))
    assert 10 <= kept.count() < 10_000
    assert sorted(r.name for r in kept.collect())[:10] == [f"part-{i:07d}" for i in range(10)]


@pytest.mark.parametrize("start,stop", [(0, 5), (7, 60), (390, 400), (395, 900), (500, 600), (3, 3), (0, 400)])
def test_slices_with_ties_nulls_and_a_hot_key(spark, start, stop):
    rng = random.Random(11)
    names = ["hot" if rng.random() < 0.4 else rng.choice([None, *(f"n{i:03}" for i in range(300))]) for _ in range(400)]
    rows = spark.createDataFrame([(n, i) for i, n in enumerate(names)], "name string, pos int").repartition(5)
    got = [(r.name, r.pos) for r in S.slice_sorted(rows, ["name", "pos"], start, stop).collect()]
    want = sorted(((n, i) for i, n in enumerate(names)), key=lambda r: (r[0] is not None, r))
    assert got == want[start:stop]


def test_a_slice_far_into_the_rows_sorts_few(spark):
    rows = spark.range(20000).select(F.sha2(F.col("id").cast("string"), 256).alias("name"))
    kept, skipped = S._ranges_between(rows, ["name"], F.lit(15000), F.lit(15010))
    assert kept.count() < 3000 and 13000 < skipped <= 15000


def test_slices_of_an_empty_table(spark):
    assert S.slice_sorted(spark.range(0), ["id"], 2, 9).collect() == []
