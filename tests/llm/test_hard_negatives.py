"""Mined negatives against brute force, and the query against its SQL."""

import math
import random
from collections import Counter

import pytest
from paralex.llm import hard_negatives
from paralex.llm.catalog import oracle_sql, queries
from pyspark.sql import functions as F
from pyspark.sql import types as T

SCHEMA = T.StructType([
    T.StructField("vec_id", T.LongType()), T.StructField("label", T.IntegerType()),
    T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("score", T.StringType()), T.StructField("v", T.StringType()),
])


def plain(rows, every, scale):
    fine = [
        (i, label, [math.floor(scale * x) for x in v]) for i, label, v, *_ in rows
        if None not in (i, label, v) and all(x is not None and math.isfinite(x) for x in v)
    ]
    anchors = {}
    for i, label, v in sorted(fine):
        if i % every == 0:
            anchors.setdefault(i, (label, v))
    out = []
    for a, (label, v) in anchors.items():
        near = sorted(
            (-min(max(sum(x * y for x, y in zip(v, w)), -(2**63) + 1), 2**63 - 1), i, other == label)
            for i, other, w in fine if i != a and len(w) == len(v)
        )
        for s, p, _ in [n for n in near if n[2]][:5]:
            inside = [(i, -t) for t, i, same in near if not same and 80 * -s <= 100 * -t <= 100 * -s]
            out += [(a, p, r + 1, i, -s, t) for r, (i, t) in enumerate(inside[:5])]
    return Counter(out)


def mined(df, every, scale):
    rows = hard_negatives.usable(df, F.col("vec_id"), F.col("label"), F.col("embedding"))
    return hard_negatives.mine(rows, F.col("vec_id") % every == 0, scale)


def vectors(n, seed, hot):
    """Three labels around three centres that lie close together; with ``hot`` a
    third of all rows are one vector, with all labels."""
    rng = random.Random(seed)
    centers = [[rng.gauss(1, 0.4) for _ in range(5)] for _ in range(3)]
    out = []
    for i in range(n):
        label = rng.randrange(3)
        out.append((i, label, [x + rng.gauss(0, 0.3) for x in centers[label]], "s", "v"))
    return out + [(n + i, i % 3, out[1][2], "s", "v") for i in range(n // 2 if hot else 0)]


@pytest.mark.parametrize("hot", [False, True])
@pytest.mark.parametrize("block", [7, 64])
def test_mined_rows_equal_brute_force(spark, hot, block, monkeypatch):
    for name, n in (("BLOCK", block), ("PART_BLOCKS", 3), ("CHUNK", 6), ("AT_ONCE", 4)):
        monkeypatch.setattr(hard_negatives, name, n)
    df = spark.createDataFrame(vectors(300, 3, hot), SCHEMA).repartition(5)
    got = Counter(map(tuple, mined(df, 10, 8.0).collect()))
    want = plain([tuple(r) for r in df.collect()], 10, 8.0)
    assert got == want and len(want) > 300


def test_ties_of_positives_and_negatives(spark):
    """A negative of the positive's score counts; equal scores go by id."""
    rows = [(0, 1, [1.0, 0.0])] + [(i, i % 2, [1.0, float(i)]) for i in range(1, 40)] + [(50 + i, i % 2, [0.8, 0.0]) for i in range(8)]
    df = spark.createDataFrame([(*r, "s", "v") for r in rows], SCHEMA)
    got = Counter(map(tuple, mined(df, 1000, 5.0).collect()))
    assert got == plain([tuple(r) for r in df.collect()], 1000, 5.0) and len(got) == 25


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, 1, [1.0, 2.0]), (1, 1, [1.0, 1.5]), (2, 2, [1.0, 1.4]), (3, None, [1.0, 1.0]), (4, 1, None), (5, 1, [None, 1.0]),
        (6, 2, [nan, 1.0]), (7, 2, [inf, 1.0]), (None, 1, [1.0, 1.0]), (10, 1, [1.0]), (11, 1, [2.0]), (12, 2, [1.5]),
        (20, 3, []), (21, 3, []), (22, 4, []), (30, 1, [-1.0, -1.0]), (40, 7, [3.0, 3.0]), (8, 2, [1.0, 1.4]), (8, 2, [1.0, 1.4]),
        (50, 1, [2e30, 1.0]), (51, 1, [1e30, 1.0]), (52, 2, [1e30, 0.5]), (60, 1, [40000.0, 1.0]), (61, 2, [39000.0, 5.0]),
        (70, 1, [1.0, 2.0]), (70, 0, [2.0, 2.0]), (70, 1, [0.5, 0.5]), (80, 5, [0.0, 0.0]), (81, 5, [1.0, 0.0]), (90, 1, [1e9, 1e9]),
    ]
    df = spark.createDataFrame([(*r, "s", "v") for r in rows], SCHEMA).repartition(3)
    got = Counter(map(tuple, mined(df, 10, 256.0).collect()))
    assert got == plain([tuple(r) for r in df.collect()], 10, 256.0) and len(got) > 40
    none = mined(df.limit(0), 10, 256.0)
    assert none.count() == 0 and none.columns == [f.name for f in hard_negatives.TRIPLES]
    assert mined(df.filter("vec_id % 10 <> 0"), 10, 256.0).count() == 0  # no anchors


def test_keys_sort_like_anchor_score_and_id():
    rng = random.Random(1)
    near = [-(2**63), -(2**63) + 1, -5, -1, 0, 1, 7, 2**63 - 1]
    rows = [(rng.choice(near), max(rng.choice(near), -(2**63) + 1), rng.random() < 0.5, rng.choice(near)) for _ in range(500)]
    want = sorted(rows, key=lambda r: (r[0], -r[1], r[2], r[3]))
    assert sorted(rows, key=lambda r: hard_negatives.packed(*r)) == want


def test_the_iterator_holds_no_rows():
    """Windows open, fill and close while keys are read one by one."""
    read = []

    def keys():
        for score in range(1000, 0, -1):
            read.append(score)
            yield hard_negatives.packed(3, score, score not in (1000, 900), 10_000 + score), None

    out = hard_negatives.windows(keys())
    first = [next(out) for _ in range(5)]
    assert [f[3:] for f in first] == [(10_999 - i, 1000, 999 - i) for i in range(5)] and len(read) == 6
    rest = list(out)
    assert [r[1:4] for r in rest] == [(10_900, i + 1, 10_899 - i) for i in range(5)]


def test_a_task_hands_on_a_bounded_number_of_pairs(spark, monkeypatch):
    met = []
    monkeypatch.setattr(hard_negatives, "_met", lambda *a, f=hard_negatives._met: (met.append(f(*a)), met[-1])[1])
    df = spark.createDataFrame(vectors(400, 5, True), SCHEMA).repartition(3)
    got = mined(df, 10, 8.0).count()
    pairs = [m.groupBy("anchor_id").count().agg(F.max("count")).first()[0] for m in met]
    assert got and pairs[0] <= 5 * 8 and pairs[1] <= 25 * 8  # eight parts at most


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_query_equals_its_sql(spark, sf):
    from compare import connect, differences, duck_side, spark_side

    got = spark_side(queries()["op13_hard_negatives"](spark, sf))
    assert len(got[1]) > 0
    assert differences(got, duck_side(connect(sf), oracle_sql()["op13_hard_negatives"])) is None
