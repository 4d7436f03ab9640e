"""Trees of any and mixed depth: JSON, and rows that name their parent."""

import json
import random

from paralex.sources import text as S
from pyspark.sql import functions as F


def plain_paths(node, path=(), place=()):
    if isinstance(node, dict):
        for i, k in enumerate(sorted(node)):
            yield from plain_paths(node[k], (*path, k), (*place, i))
    elif isinstance(node, list):
        for i, x in enumerate(node):
            yield from plain_paths(x, path, (*place, i))
    else:
        parts = [*path, node] if isinstance(node, str) else list(path)
        if parts:
            yield list(place), "-".join(parts)


def tree(rng, depth):
    kind = rng.random()
    if depth == 0 or kind < 0.3:
        return rng.choice(["leaf", "", "é{[\"", "a-b", 1, -2.5, True, None])
    if kind < 0.65:
        return {rng.choice("abcdé]{ \"\\")*rng.randint(1, 2): tree(rng, depth - 1) for _ in range(rng.randint(0, 3))}
    return [tree(rng, depth - 1) for _ in range(rng.randint(0, 3))]


def test_json_trees_equal_a_plain_walk(spark):
    rng = random.Random(6)
    trees = [tree(rng, rng.randint(0, 9)) for _ in range(250)] + ["only", 5, None, [], {}, [[[["x"]]]], {"a": {"a": {"a": []}}}]
    df = spark.createDataFrame([(i, json.dumps(t), f"k{i}") for i, t in enumerate(trees)], "pos long, value string, key string")
    out = S.flatten_json(df, "value")
    assert out.columns == ["pos", "key", "place", "topic"]
    got = sorted((r.pos, r.place, r.topic) for r in out.collect())
    assert got == sorted((i, place, topic) for i, t in enumerate(trees) for place, topic in plain_paths(t))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_depth_of_brackets(spark):
    texts = ['{"a": [1, {"b": "}]["}]}', '"[[["', "[]", "7", '["\\\\", ["\\""]]', ""]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(S.json_depth("t")).collect()] == [3, 0, 1, 0, 2, 0]


def test_text_that_is_no_json_is_returned(spark):
    df = spark.createDataFrame([(1, '{"a": '), (2, None), (3, '{"a": "x"}'), (4, ""), (5, '{"a": 1, "a": 2}')], "id int, tree string")
    assert sorted(r.id for r in S.bad_trees(df).collect()) == [1, 2, 4, 5]
    assert [(r.id, r.topic) for r in S.flatten_json(df).collect()] == [(3, "a-x")]
    assert S.flatten_json(df.limit(0)).count() == 0


def plain_tree(rows):
    """Topics of leaves and reasons of rejected rows, by walking up."""
    by_node = {}
    for r in rows:
        by_node.setdefault(r[0], []).append(r)

    def ways(row, seen):
        node, parent, label = row
        if parent is None:
            return [("root", label)]
        if row in seen:
            return [("cycle", None)]
        if parent not in by_node:
            return [("orphan", None)]
        return [(end, t and f"{t}-{label}") for up in by_node[parent] for end, t in ways(up, {*seen, row})]

    parents = {r[1] for r in rows}
    leaves, rejected = [], []
    for row in rows:
        found = ways(row, set())
        topics = [t for end, t in found if end == "root"]
        if not topics:
            rejected.append((*row, "orphan" if any(end == "orphan" for end, _ in found) else "cycle"))
        elif row[0] not in parents:
            leaves += [(row[0], t) for t in topics]
    return sorted(leaves), sorted(rejected, key=repr)


def test_rows_that_hang_on_no_root_are_returned(spark):
    rng = random.Random(2)
    rows = [("r", None, "R"), ("q", None, "Q")] + [(f"n{i}", f"n{i // 2}" if i > 1 else "r", f"L{i}") for i in range(1, 60)]
    rows += [(f"chain{i}", f"chain{i - 1}" if i else "q", f"c{i}") for i in range(37)]  # deep
    rows += [("o1", "missing", "x"), ("o2", "o1", "y"), ("o3", "o2", "z")]
    rows += [("self", "self", "s"), ("under", "self", "u"), ("x", "y", "1"), ("y", "z", "2"), ("z", "x", "3"), ("tail", "y", "t"), ("end", "tail", "e")]
    rows += [("twice", "r", "a"), ("twice", "missing", "b"), ("below", "twice", "c")]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "node string, parent string, label string").repartition(4)
    leaves, rejected = S.tree_paths(df)
    want = plain_tree(rows)
    assert sorted(map(tuple, leaves.collect())) == want[0]
    got = [tuple(r) for r in rejected.collect()]
    assert sorted(got, key=repr) == want[1] and {r[3] for r in got} == {"orphan", "cycle"}
    assert ("chain36", "Q-" + "-".join(f"c{i}" for i in range(37))) in want[0]


def test_turns_grow_with_the_logarithm_of_the_depth(spark, monkeypatch):
    written = []
    monkeypatch.setattr(S, "stored", lambda df, purpose, f=S.stored: (written.append(purpose), f(df, purpose))[1])
    df = spark.createDataFrame([(i, i - 1 if i else None, "x") for i in range(200)], "node int, parent int, label string")
    leaves, rejected = S.tree_paths(df)
    assert leaves.count() == 1 and rejected.count() == 0 and len(written) <= 2 * 10 + 2


def test_cycles_cost_no_turns(spark, monkeypatch):
    """Many nodes in cycles, and rows that come twice, under a short tree."""
    written = []
    monkeypatch.setattr(S, "stored", lambda df, purpose, f=S.stored: (written.append(purpose), f(df, purpose))[1])
    rows = [("r", None, "R"), ("a", "r", "A"), ("a", "r", "A"), ("o", "gone", "O"), ("p", "o", "P"), (None, "a", "N"), (None, None, "M")]
    rows += [(f"s{i}", f"s{i}", "s") for i in range(300)] + [("s0", "s0", "s"), ("u", "s0", "u")]
    leaves, rejected = S.tree_paths(spark.createDataFrame(rows, "node string, parent string, label string"))
    assert sorted(r.topic for r in leaves.collect()) == sorted(["M", "R-A-N", "R-A-N"])
    found = [(r.node, r.reason) for r in rejected.collect()]
    assert sorted(found) == sorted([("o", "orphan"), ("p", "orphan"), ("u", "cycle"), ("s0", "cycle")] + [(f"s{i}", "cycle") for i in range(300)])
    assert written.count("pointers") <= 4


def test_empty_tree(spark):
    leaves, rejected = S.tree_paths(spark.createDataFrame([], "node string, parent string, label string"))
    assert leaves.count() == 0 and rejected.filter(F.lit(True)).count() == 0
