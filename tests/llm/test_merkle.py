"""The manifest against a plain tree, and the query against its SQL."""

import random
import zlib
from hashlib import sha256

import pytest
from cases import documents, empty
from paralex.llm import merkle
from paralex.llm.catalog import oracle_sql, queries
from pyspark.sql import functions as F

FIELDS = "doc_id long, tree string, leaf string, shown string, pos string, root string"


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def plain_tree(nodes):
    """Levels of a tree, leaves first."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][i : i + 8]) for i in range(0, len(levels[-1]), 8)])
    return levels


def plain_manifest(rows):
    trees = {}
    for row in rows:
        trees.setdefault(row[1], []).append(row)
    names = sorted(trees, key=lambda t: (t is not None, (t or "").encode()))
    for name in names:
        trees[name].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[2]))
    low = {name: plain_tree([r[2] for r in trees[name]]) for name in names}
    top = plain_tree([low[name][-1][0] for name in names])
    out = []
    for number, name in enumerate(names):
        for pos, (doc_id, _, leaf, shown, *_) in enumerate(trees[name]):
            proof, folded = "", shown
            for levels, at in ((low[name], pos), (top, number)):
                for level in levels[:-1]:
                    first = at - at % 8
                    run = level[first : first + 8]
                    proof += "".join(run[: at - first] + run[at - first + 1 :])
                    run[at - first] = folded
                    folded, at = h(*run), at // 8
            out.append((doc_id, name, leaf, shown, low[name][-1][0], top[-1][0], proof, folded, folded == top[-1][0]))
    return sorted(out, key=repr)


COLUMNS = ["doc_id", "tree", "leaf", "shown", "subroot", "root", "proof", "folded_root", "verified"]


@pytest.mark.parametrize("depth", [1, 2, 4])
@pytest.mark.parametrize("sizes", [{"a": 700, None: 65, "b": 64, "é": 1, "z": 9}, {"one": 1}, {f"t{i}": 1 + i % 3 for i in range(70)}])
def test_manifest_equals_a_plain_tree(spark, depth, sizes):
    rng, rows = random.Random(4), []
    for tree, n in sizes.items():
        for i in range(n):
            leaf = h(str(tree), str(i))
            rows.append((i if i != 5 else None, tree, leaf, leaf if rng.random() < 0.7 else h("changed", leaf), "x", "y"))
    rows += [rows[0]] * (3 if len(sizes) > 1 else 0)
    df = spark.createDataFrame(rng.sample(rows, len(rows)), FIELDS).repartition(5)
    out = merkle.manifest(df, depth)
    assert out.columns == [*COLUMNS[:7], "places", *COLUMNS[7:]]
    got = [tuple(r) for r in out.select(COLUMNS).collect()]
    assert sorted(got, key=repr) == plain_manifest(rows)
    for r in out.limit(30).collect():
        assert merkle.fold(r.leaf, r.proof, r.places) == r.root


def test_a_third_of_all_rows_may_be_equal(spark):
    rows = [(7, "hot", h("x"), h("x"), "x", "y")] * 400 + [(i, "hot", h(str(i)), h(str(i)), "x", "y") for i in range(400)]
    got = merkle.manifest(spark.createDataFrame(rows, FIELDS).repartition(6), 2).select(COLUMNS).collect()
    assert sorted(map(tuple, got), key=repr) == plain_manifest(rows)


def test_changed_leaves_are_found(spark):
    rows = [(i, "t", h(str(i)), h(str(i)) if i % 5 else h("no"), "x", "y") for i in range(100)]
    got = merkle.manifest(spark.createDataFrame(rows, FIELDS)).collect()
    assert all(r.verified == (r.doc_id % 5 != 0) for r in got)
    assert len({r.root for r in got}) == 1 and all(r.folded_root != r.root for r in got if r.doc_id % 5 == 0)


def test_leaves_of_odd_rows(spark):
    docs = documents(spark).withColumn("n_chars", F.length("text"))
    names = ["doc_id", "lang", "n_chars", "text"]
    cased = docs.withColumn("text", F.concat("text", F.lit("AÉZİ")))
    for df in (docs, cased):
        for r in df.select(*names, merkle.leaf(*map(F.col, names)).alias("h"), merkle.lower_ascii(F.col("text")).alias("low")).collect():
            written = "".join("-" if r[n] is None else f"{len(str(r[n]).encode())}:{r[n]}" for n in names)
            assert r.h == h(written)
            assert r.low == (None if r.text is None else r.text.encode().lower().decode())
    both = merkle.leaf(F.col("text"))
    some = docs.select("doc_id", F.col("lang").alias("tree"), both.alias("leaf"), both.alias("shown"))
    assert merkle.manifest(some).count() == docs.count() and merkle.manifest(some).filter("not verified").count() == 0
    none = merkle.manifest(empty(spark).select("doc_id", F.col("lang").alias("tree"), both.alias("leaf"), both.alias("shown")))
    assert none.count() == 0


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_query_equals_its_sql(spark, sf):
    from compare import connect, differences, duck_side, spark_side

    out = queries()["op12_merkle"](spark, sf)
    got = spark_side(out)
    assert differences(got, duck_side(connect(sf), oracle_sql()["op12_merkle"])) is None
    capital = {r.doc_id for r in spark.read.parquet(f"{sf}/documents.parquet").filter("text rlike '[A-Z]'").collect()}
    for r in out.collect():
        assert r.verified == (zlib.crc32(str(r.doc_id).encode()) % 3 != 0 or r.doc_id not in capital)
