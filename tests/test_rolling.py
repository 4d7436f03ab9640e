"""Request files rolled by their written bytes, against a plain loop."""

import glob
import json
import os
import random

import numpy as np
import pytest
from paralex.operators import requests as R
from paralex.operators import sharding as S
from paralex.sources import sinks
from pyspark.sql import functions as F

CFG = R.RenderConfig(model="m", max_tokens=9)


def plain_shards(sizes, max_bytes, max_rows):
    """Shard, row and bytes of every line, written one after another."""
    out, shard, row, full = [], 0, 0, 0
    for size in sizes:
        written = size + len(str(shard)) + len(str(row))
        out.append((shard, row, written))
        full, row = full + written, row + 1
        if full >= max_bytes or row == max_rows:
            shard, row, full = shard + 1, 0, 0
    return out


def sizes_of(seed, n):
    rng = random.Random(seed)
    return [rng.choice([1, 5, 9, rng.randint(1, 40)]) for _ in range(n)]


@pytest.mark.parametrize("max_bytes, max_rows", [(1, 5), (60, 7), (700, 150), (2500, 10_000)])
def test_next_starts_equal_a_plain_sum(max_bytes, max_rows):
    sizes = np.array(sizes_of(3, 1500))
    for digits in (1, 2, 5):
        got = S._next_starts_written(sizes, max_bytes, max_rows, digits)
        for at in range(0, len(sizes), 37):
            full, row = 0, 0
            while at + row < len(sizes) and full < max_bytes and row < max_rows:
                full, row = full + sizes[at + row] + digits + len(str(row)), row + 1
            assert got[at] == at + row


@pytest.mark.parametrize("chunk_rows", [1, 40, 1 << 16])
@pytest.mark.parametrize("max_bytes, max_rows", [(60, 12), (30, 5), (900, 130)])
def test_shards_equal_a_plain_loop(spark, max_bytes, max_rows, chunk_rows):
    """Numbers of shards and rows cross 9/10, and 99/100 where files are long."""
    files = {"long": sizes_of(1, 2600 if max_bytes < 100 else 1300), "short": sizes_of(2, 9), None: sizes_of(3, 150), "one": [10**6]}
    rows = [(name, i, size) for name, sizes in files.items() for i, size in enumerate(sizes)]
    random.Random(5).shuffle(rows)
    df = spark.createDataFrame(rows, "file_name string, line_no long, bytes long").repartition(6)
    got = S.shard_by_written_bytes(df, max_bytes=max_bytes, max_rows=max_rows, chunk_rows=chunk_rows).collect()
    assert len(got) == len(rows)
    by_file = {}
    for r in got:
        by_file.setdefault(r.file_name, []).append((r.line_no, r.shard, r.row_in_shard))
    for name, sizes in files.items():
        want = [(i, s, n) for i, (s, n, _) in enumerate(plain_shards(sizes, max_bytes, max_rows))]
        assert sorted(by_file[name]) == want, name
    if max_bytes == 60:
        assert max(s for _, s, _ in by_file["long"]) > 100


def test_empty_and_null_sizes(spark):
    empty = spark.createDataFrame([], "file_name string, line_no long, bytes long")
    assert S.shard_by_written_bytes(empty).count() == 0
    df = spark.createDataFrame([("f", i, None) for i in range(30)], "file_name string, line_no long, bytes long")
    got = {(r.shard, r.row_in_shard) for r in S.shard_by_written_bytes(df, max_bytes=10, max_rows=50).collect()}
    assert got == {(s, n) for s, n, _ in plain_shards([0] * 30, 10, 50)}


def test_written_files_end_with_the_row_that_reaches_the_limit(spark, tmp_path):
    rng = random.Random(8)
    texts = ["".join(rng.choice('abc é"\\\n\t日') for _ in range(rng.randint(0, 60))) for _ in range(900)]
    rows = [("a.txt" if i % 3 else 'b "q".txt', i, "sys" if i % 7 else None, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "file_name string, line_no long, system string, user string").repartition(5)
    limit, path = 2000, str(tmp_path / "requests")
    manifest = {(r.file_name, r.shard): r for r in sinks.write_requests(R.roll_requests(df, CFG, limit, 10**6), path).collect()}
    seen = []
    for name in ("a.txt", 'b "q".txt'):
        shards = sorted(s for f, s in manifest if f == name)
        assert shards == list(range(len(shards))) and len(shards) > 10
        for shard in shards:
            assert manifest[name, shard].files == 1
        for shard in shards:
            found = [p for p in glob.glob(f"{path}/*/shard={shard}/part-*") if json.loads(open(p).readline())["custom_id"].startswith(name)]
            assert len(found) == 1 and os.path.getsize(found[0]) == manifest[name, shard].file_bytes
            with open(found[0], newline="") as f:
                lines = f.read().split("\n")[:-1]
            last = len(lines[-1].encode()) + 1
            size = os.path.getsize(found[0])
            assert shard == shards[-1] or size - last < limit <= size
            for n, line in enumerate(lines):
                request = json.loads(line)
                assert request["custom_id"] == f"{name}-{shard}-{n}"
                seen.append(request["body"]["messages"][-1]["content"])
            assert manifest[name, shard].rows == len(lines)
            assert (manifest[name, shard].first_id, manifest[name, shard].last_id) == (f"{name}-{shard}-0", f"{name}-{shard}-{len(lines) - 1}")
    assert sorted(seen) == sorted(texts)


def test_lines_that_are_no_lines_are_set_aside(spark, tmp_path):
    rows = [("f", 0, 0, "one"), ("f", 0, 1, "two\nlines"), ("f", 0, 2, None), ("f", 0, 3, "a\rb"), ("f", 1, 4, "")]
    df = spark.createDataFrame(rows, "file_name string, shard long, line_no long, line string")
    path = str(tmp_path / "out")
    got = sorted(map(tuple, sinks.write_sharded(df, path).collect()))
    assert got == [("f", 0, 2, 8), ("f", 1, 1, 1)]
    kept = spark.read.parquet(path + "-rejected").orderBy("line_no").collect()
    assert [(r.line_no, r.line) for r in kept] == [(1, "two\nlines"), (2, None)]
    assert sum(r[2] for r in got) + len(kept) == len(rows)


def test_rendering_stays_narrow(spark):
    """The request of a placed row is an expression: no Python in it."""
    df = spark.createDataFrame([("f", 1, None, "x")], "file_name string, line_no long, system string, user string")
    plan = df.select(R.request_text(CFG, F.concat("file_name", F.lit("-1")))) ._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan
