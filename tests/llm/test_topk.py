"""Exact search against brute force."""

import math
import random

import pytest
from paralex.llm import topk
from paralex.llm.catalog import oracle_sql, queries
from pyspark.sql import functions as F
from pyspark.sql import types as T

SCHEMA = T.StructType([
    T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
    T.StructField("score", T.StringType()), T.StructField("pivot", T.StringType()),
])


def plain(rows, every, k):
    fine = [
        (i, [math.floor(64 * x) for x in v]) for i, v, *_ in rows
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    ends = 2**63 - 1
    out, done = [], set()
    for i, q in fine:
        if i % every or i in done:
            continue
        done.add(i)
        scores = [(max(-ends + 1, min(ends, sum(a * b for a, b in zip(q, v)))), j) for j, v in fine if j != i and len(v) == len(q)]
        near = [(-s, j) for s, j in scores]
        out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(sorted(near)[:k])]
    return sorted(out)


def vectors(n, seed, clustered):
    rng = random.Random(seed)
    centers = [[rng.gauss(0, 1) for _ in range(6)] for _ in range(4)]
    out = []
    for i in range(n):
        c = rng.choice(centers) if clustered else [0] * 6
        out.append((i, [x + rng.gauss(0, 0.05 if clustered else 1) for x in c], "s", "p"))
    copies = [(n + i, out[3][1], "s", "p") for i in range(n // 3)]  # a third are one vector
    return out + copies


@pytest.mark.parametrize("clustered", [True, False])
@pytest.mark.parametrize("group", [40, topk.GROUP])
def test_search_equals_brute_force(spark, clustered, group, monkeypatch):
    monkeypatch.setattr(topk, "ANNULUS", 16)
    monkeypatch.setattr(topk, "QUERIES_AT_ONCE", 5)
    rows = vectors(200, 4, clustered)
    rows = [(i, [float(f"{x:.4f}") for x in v], *rest) for i, v, *rest in rows]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    exact = [tuple(r) for r in df.collect()]  # as floats
    got = topk.top_k(topk.whole_numbers(df, 64.0), F.col("vec_id") % 20 == 0, 7, 5, group).collect()
    assert sorted(map(tuple, got)) == plain(exact, 20, 7)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, -0.5]), (1, [0.25, 3.0]), (2, None), (3, [None, 1.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [1e30, 1.0]),
        (None, [1.0, 1.0]), (20, [1.0]), (40, []), (7, []), (8, [2.0]), (60, [0.0, 0.0]), (9, [1.0, -0.5]), (9, [1.0, -0.5]),
        (80, [30000000.0, 2.0]), (10, [30000000.0, 1.0]), (100, [4e7, 0.0]), (11, [-4e7, 0.0]), (120, [1e30, -1e30]),
        (12, [3e38, 3e38]), (13, [-3e38, 1.0]), (14, [1e30, 1e30]), (140, [2.0**40, -1.0]), (15, [2.0**40, 3.0]),
    ]
    rows = [(i, v, "s", "p") for i, v in rows]
    df = spark.createDataFrame(rows, SCHEMA)
    got = topk.top_k(topk.whole_numbers(df, 64.0), F.col("vec_id") % 20 == 0, 20).collect()
    assert sorted(map(tuple, got)) == plain([tuple(r) for r in df.collect()], 20, 20)
    none = topk.top_k(topk.whole_numbers(df.limit(0), 64.0), F.col("vec_id") % 20 == 0, 20)
    assert none.count() == 0 and none.columns == ["query_id", "rank", "vec_id", "score"]


def test_repeated_query_ids_take_the_shortest_vector_first_by_bytes(spark):
    rows = [(20, [2.0, 1.0], "s", "p"), (20, [1.0, 5.0], "s", "p"), (1, [1.0, 0.0], "s", "p"), (40, [1.0, 1.0], "s", "p"), (40, [3.0], "s", "p")]
    for shift in range(len(rows)):
        df = spark.createDataFrame(rows[shift:] + rows[:shift], SCHEMA).repartition(3)
        got = topk.top_k(topk.whole_numbers(df, 64.0), F.col("vec_id") % 20 == 0, 1)
        assert [tuple(r) for r in got.collect()] == [(20, 1, 40, 6 * 64 * 64)]


def test_a_task_gets_a_bounded_number_of_queries(spark, monkeypatch):
    """Every row is a query; each meets every group once, in chunks of two blocks."""
    monkeypatch.setattr(topk, "QUERIES_AT_ONCE", 5)
    monkeypatch.setattr(topk, "CHUNK_BLOCKS", 2)
    met = []
    monkeypatch.setattr(topk, "_meetings", lambda *a, f=topk._meetings: (met.append(f(*a)), met[-1])[1])
    rows = vectors(120, 6, True) + [(500 + i, [float(i)], "s", "p") for i in range(23)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = topk.top_k(topk.whole_numbers(df, 64.0), F.lit(True), 3, 5, 40).collect()
    assert sorted(map(tuple, got)) == plain([tuple(r) for r in df.collect()], 1, 3)
    annuli, sent = met[0]
    groups = annuli.select("part", "size").distinct().collect()
    assert len({g.part for g in groups}) > 1
    tasks = sent.groupBy("to", "chunk").agg(F.sum(F.octet_length("ids") / 8).alias("queries")).collect()
    assert max(t.queries for t in tasks) <= 10
    assert sum(t.queries for t in tasks) == sum(160 if g["size"] == 6 else 23 for g in groups)
    held = annuli.groupBy("part", "by", "size").agg(F.sum(F.octet_length("ids") / 8).alias("n")).collect()
    lengths = {(t.chunk, t["size"]) for t in sent.collect()}
    assert {(h.by, h["size"]) for h in held} == lengths
    for size, n in ((6, 160), (1, 23)):
        assert sum(h.n for h in held if h["size"] == size) == n * sum(s == size for _, s in lengths)


def test_annuli_are_left_out(monkeypatch):
    """Far annuli are never scored: the bound stops the search."""
    import numpy as np

    rng = np.random.default_rng(0)
    pivots = np.array([[0.0] * 4, [1000.0] * 4, [-1000.0] * 4])
    annuli = []
    for p in (1, 2):
        v = np.sort((pivots[p] + rng.integers(-5, 5, (64, 4))).astype(np.int32), axis=0)
        d = topk._distances(v.astype(float), pivots)[:, p]
        annuli.append(({"pivot": p, "low": d.min(), "high": d.max(), "norm": np.sqrt((v.astype(float) ** 2).sum(1)).max()}, np.arange(64) + 100 * p, v))
    seen = []
    monkeypatch.setattr(topk, "_products", lambda a, b, f=topk._products: (seen.append(len(b)), f(a, b))[1])
    q = np.array([[1000, 1001, 999, 1000]], np.int32)
    topk._search(annuli, q, np.array([7]), pivots, 5)
    assert len(seen) == 1


def test_query_equals_its_sql(spark):
    from compare import connect, differences, duck_side, spark_side

    sf = "/root/testdata/sf0.001"
    got = spark_side(queries()["op9_topk"](spark, sf))
    assert differences(got, duck_side(connect(sf), oracle_sql()["op9_topk"])) is None
