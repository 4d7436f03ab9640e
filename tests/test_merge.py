"""Deep merge of ledgers of any depth against a plain recursive update."""

import json
import random

from paralex.operators.relational import deep_merge_leaves
from paralex.sources.text import json_leaves
from pyspark.sql import functions as F


def update(old, new):
    for k, v in new.items():
        old[k] = update(old[k], v) if isinstance(old.get(k), dict) and isinstance(v, dict) else v
    return old


def leaves(node, path=()):
    if isinstance(node, dict) and node:
        for k, v in node.items():
            yield from leaves(v, (*path, k))
    else:
        yield list(path), json.dumps(node, separators=(",", ":"), ensure_ascii=False)


def ledger(rng, depth):
    if depth == 0 or rng.random() < 0.25:
        return rng.choice([1, "x", None, True, [1, {"a": 2}], [], {}])
    return {k: ledger(rng, depth - 1) for k in rng.sample("abcde", rng.randint(0, 4))}


def merged(spark, pairs):
    old, new = (
        json_leaves(spark.createDataFrame([(k, json.dumps(p[i])) for k, p in pairs], "key string, j string"), "j") for i in (0, 1)
    )
    got = deep_merge_leaves(old, new, ["key"]).collect()
    return sorted(((r.key, r.path, r.value) for r in got), key=repr)


def test_merge_equals_a_recursive_update(spark):
    rng = random.Random(4)
    pairs = []
    for i in range(300):
        old, new = ({k: ledger(rng, 4) for k in rng.sample("abcde", rng.randint(0, 4))} for _ in (0, 1))
        pairs.append((f"k{i}" if i else None, (old, new)))
    want = [(k, path, value) for k, (old, new) in pairs for path, value in leaves(update(json.loads(json.dumps(old)), new))]
    assert merged(spark, pairs) == sorted(want, key=repr)


def test_changes_of_type(spark):
    cases = [
        ({"a": {"b": {"c": 1}}}, {"a": {"b": 2}}), ({"a": {"b": 2}}, {"a": {"b": {"c": 1}}}), ({"a": 1}, {"a": {}}), ({"a": {"b": 1}}, {"a": {}}),
        ({"a": {}}, {"a": {"b": 1}}), ({}, {}), ({}, {"a": 1}), ({"a": [1]}, {"a": {"b": [2]}}), ({"a": {"b": 1, "c": 2}}, {"a": None}),
        ({"ab": 1}, {"a": {"b": 2}}),
    ]
    pairs = [(str(i), c) for i, c in enumerate(cases)]
    want = [(k, path, value) for k, (old, new) in pairs for path, value in leaves(update(json.loads(json.dumps(old)), new))]
    assert merged(spark, pairs) == sorted(want, key=repr)


def test_ledgers_of_one_side_only(spark):
    kinds = "key string, path array<string>, value string"
    some = spark.createDataFrame([("a", ["x"], "1"), ("b", ["y", "z"], "{}")], kinds)
    none = some.filter(F.lit(False))
    for old, new in ((some, none), (none, some)):
        assert sorted(map(tuple, deep_merge_leaves(old, new, ["key"]).collect())) == [("a", ["x"], "1"), ("b", ["y", "z"], "{}")]


def test_a_ledger_with_most_leaves_sends_a_path_once(spark):
    """Paths above leaves are distinct before the join: one row each."""
    old = spark.range(20_000).select(F.lit("hot").alias("key"), F.array(F.lit("files"), F.concat(F.lit("f"), "id")).alias("path"), F.lit("1").alias("value"))
    new = old.filter("value = '1'").limit(3).withColumn("value", F.lit("2"))
    assert deep_merge_leaves(old, new, ["key"]).groupBy("value").count().orderBy("value").collect()[1]["count"] == 3
    assert deep_merge_leaves(old, new, ["key"]).count() == 20_000


def test_leaves_are_not_broadcast(spark):
    """A table of keys looks small, whatever ledgers are made of it."""
    rows = spark.range(10).selectExpr("id AS key", """'{"a":{"b":1}}' AS j""")
    merged = deep_merge_leaves(json_leaves(rows, "j"), json_leaves(rows, "j"), ["key"])
    text = merged._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in text and "BroadcastHashJoin" not in text
