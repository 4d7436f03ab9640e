"""Shards on mounted folders: written, listed and read by tasks."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from paralex.operators import requests as R
from paralex.sources import sinks

NAMES = [None, "a b.txt", "".join(map(chr, range(1, 64))), "".join(map(chr, range(64, 128))), "%41", "x=y", "..", "_a", ".b"]


def tree(path):
    """Folders of shards, each with its lines."""
    found = {}
    for part in glob.glob(f"{path}/*/*/part-*", include_hidden=True):
        with open(part, "rb") as f:
            found.setdefault(os.path.relpath(os.path.dirname(part), path), []).append(f.read())
    return found


def in_order(df):
    return sorted(map(tuple, df.collect()), key=repr)


def by_spark(monkeypatch):
    """As on a store that is not mounted."""
    monkeypatch.setattr(sinks, "_mounted", lambda spark, path: None)


def test_folders_lines_and_manifest_are_those_of_sparks_writer(spark, tmp_path, monkeypatch):
    rows = [(n, s, i, f"{n!r}\\ {s} {i} é" if i else "") for n in NAMES for s in (None, 0, 12, -3) for i in range(3)]
    df = spark.createDataFrame(rows, "file_name string, shard bigint, line_no bigint, line string").repartition(3)
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    got = in_order(sinks.write_sharded(df, a))
    assert os.path.exists(f"{a}/_SUCCESS")
    by_spark(monkeypatch)
    assert got == in_order(sinks.write_sharded(df, b)) == in_order(sinks.shard_manifest(spark, a))
    assert tree(a) == tree(b) and len(got) == len(tree(a)) == 4 * len(NAMES)


def test_requests_are_reported_as_by_sparks_reader(spark, tmp_path, monkeypatch):
    rows = [(n, i, "sys", "x" * (i % 50) + '"é\n') for n in NAMES for i in range(90)]
    df = spark.createDataFrame(rows, "file_name string, line_no bigint, system string, user string").repartition(3)
    rolled = R.roll_requests(df, R.RenderConfig(), 2000, 10**6)
    got = sinks.write_requests(rolled, str(tmp_path / "a"))
    kinds, got = got.dtypes, in_order(got)
    by_spark(monkeypatch)
    again = sinks.write_requests(rolled, str(tmp_path / "b"))
    assert got == in_order(again) and kinds == again.dtypes
    assert sum(r[3] for r in got) == len(rows) and len(got) > 5 * len(NAMES)


def test_small_files_have_no_side_files_and_are_not_listed_by_the_driver(spark, tmp_path):
    rows = [(f"f{n}", s, i, "x") for n in range(3) for s in range(40) for i in range(2)]
    df = spark.createDataFrame(rows, "file_name string, shard bigint, line_no bigint, line string")
    rolled = df.withColumns({"row_in_shard": F.col("line_no"), "line": F.lit('{"custom_id": "f-0-1"}')})
    for path, manifest in ((tmp_path / "a", sinks.write_sharded(df, str(tmp_path / "a"))), (tmp_path / "b", sinks.write_requests(rolled, str(tmp_path / "b")))):
        assert len(glob.glob(f"{path}/*/*/*", include_hidden=True)) == 120
        assert "FileScan" not in manifest._jdf.queryExecution().executedPlan().toString()
        assert manifest.count() == 120


def test_null_and_empty_names_share_folders_not_files(spark, tmp_path):
    rows = [(n, s, i, f"{n}{s}{i}") for n in (None, "") for s in (0, 1) for i in range(3)]
    df = spark.createDataFrame(rows, "file_name string, shard bigint, line_no bigint, line string").coalesce(1)
    path = str(tmp_path / "a")
    assert in_order(sinks.write_sharded(df, path)) == [(None, 0, 6, 30), (None, 1, 6, 30)]
    found = tree(path)
    assert [len(v) for v in found.values()] == [2, 2]
    assert sorted(x for v in found.values() for f in v for x in f.decode().split()) == sorted(r[3] for r in rows)


def test_a_new_run_replaces_the_old_and_leftovers_are_not_read(spark, tmp_path):
    path = str(tmp_path / "a")
    kinds = "file_name string, shard bigint, line_no bigint, line string"
    sinks.write_sharded(spark.createDataFrame([("old", 0, 0, "x")], kinds), path)
    manifest = sinks.write_sharded(spark.createDataFrame([("f", 0, 1, "b"), ("f", 0, 0, "a"), ("f", 1, 2, "c")], kinds), path)
    for name in (".part-00000.txt-7", "_part"):
        with open(f"{path}/file_name=f/shard=0/{name}", "w") as f:
            f.write("left\n")
    assert in_order(manifest) == [("f", 0, 2, 4), ("f", 1, 1, 2)]
    assert tree(path) == {"file_name=f/shard=0": [b"a\nb\n"], "file_name=f/shard=1": [b"c\n"]}
    empty = sinks.write_requests(spark.createDataFrame([], "file_name string, shard bigint, row_in_shard bigint, line string"), path)
    assert empty.collect() == [] and not tree(path)


def test_a_failing_task_leaves_no_file_under_a_final_name(spark, tmp_path):
    rows = [("f", 0, 0, "a"), ("f", 0, 1, "b")]
    df = spark.createDataFrame(rows, "file_name string, shard bigint, line_no bigint, line string")
    bad = df.withColumn("line", F.when(F.col("line_no") == 1, F.raise_error(F.lit("no line"))).otherwise(F.col("line")))
    with pytest.raises(Exception, match="no line"):
        sinks._write_lines(bad, str(tmp_path / "a"), "line", "line_no")
    assert not tree(str(tmp_path / "a")) and not os.path.exists(tmp_path / "a" / "_SUCCESS")
