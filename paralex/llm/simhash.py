"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints that differ in at most ``2 * reach`` bits have a common
variant within ``reach`` flipped bits of each.  So every distinct fingerprint
emits its variants, equal variants meet, and what meets is verified by its bit
distance.  Variants are shuffled by their leading bits: one row per fingerprint
and reachable prefix travels, and the variants with that prefix are written out
where they meet, a class at a time.  Prefixes with very many variants are split
further by a parity class of the variant, so a large group of near copies does
not land in one task.  Fingerprints that share a variant form a star around the
smallest one, so a group never emits all its pairs.

Null texts have no words.  A text without words has fingerprint zero, which is
linked like any other.  Rows with a null id take part and get a component id;
null ids are never a component id unless a component holds no other.  Equal
rows are kept.  Empty tables give empty results.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paralex.llm.common import column_function, give_back, schema_of, stored

SEED = 42
BITS = 64
PER_PREFIX = 1 << 14  # fingerprints that share a prefix, on average
LEAST_PREFIX_BITS = 8
PER_CLASS = 1 << 20  # variants held at once by a task
PER_TASK = 1 << 27  # variants of a prefix beyond which it is split


def fingerprint(text: str | None, words: int) -> int:
    """Signed 64-bit SimHash of the ``words``-word shingles of a text."""
    parts = text.encode().lower().split() if text else []
    if not parts:
        return 0
    joined = b" ".join(parts)
    if len(parts) <= words:
        hashes = np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
    else:
        ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1)
        starts = np.concatenate([[0], ends[:-1]])[: len(parts) - words + 1]
        spans = zip(starts.tolist(), (ends[words - 1 :] - 1).tolist())
        digest = xxhash.xxh64_intdigest
        hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in spans), np.uint64, len(starts))
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        bits = np.unpackbits(hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view(np.int64)[0])


def fingerprint_of(words: int):
    """A column function: text to its signed 64-bit fingerprint."""

    def make():
        return lambda texts: pa.array([fingerprint(t.as_py(), words) for t in texts], pa.int64())

    return column_function(make, T.LongType())


def _flips(positions: range, most: int) -> list[int]:
    """All masks with at most ``most`` (0 to 2) bits among ``positions``, fewest first."""
    ones = [1 << p for p in positions] if most > 0 else []
    twos = [a | b for i, a in enumerate(ones) for b in ones[i + 1 :]] if most > 1 else []
    return [0, *ones, *twos]


def _parity(x: np.ndarray, columns: np.ndarray) -> np.ndarray:
    """XOR of the column values at the set bits of ``x``."""
    out = np.zeros(len(x), np.uint32)
    for p, value in enumerate(columns):
        out ^= np.where((x >> np.uint64(p)) & np.uint64(1), value, np.uint32(0)).astype(np.uint32)
    return out


def _components(a: np.ndarray, b: np.ndarray, size: int) -> np.ndarray:
    """Smallest index reachable from each index, over edges ``a``-``b``."""
    root = np.arange(size)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        while True:
            jumped = new[new]
            if np.array_equal(jumped, new):
                break
            new = jumped
        if np.array_equal(new, root):
            return root
        root = new


def _stars(prints: np.ndarray, prefix: int, low_bits: int, share: int, shares: int, reach: int) -> np.ndarray:
    """Links among sorted distinct ``prints`` through variants with this prefix,
    for one share of the parity classes: rows (smaller, larger), a star per
    connected group."""
    low = np.uint64((1 << low_bits) - 1) if low_bits < 64 else np.uint64(2**64 - 1)
    away = np.bitwise_count((prints >> np.uint64(low_bits)) ^ np.uint64(prefix)) if low_bits < 64 else np.zeros(len(prints), int)
    masks = [np.array(_flips(range(low_bits), reach - d), np.uint64) for d in range(reach + 1)]
    total = sum(int((away == d).sum()) * len(masks[d]) for d in range(reach + 1))
    class_bits = max(math.ceil(math.log2(shares)), math.ceil(math.log2(max(1, total / PER_CLASS))))
    columns = (np.random.default_rng(1).integers(0, 1 << 32, low_bits, np.uint64) >> np.uint64(8)).astype(np.uint32)
    columns &= np.uint32((1 << class_bits) - 1)
    own = _parity(prints & low, columns)
    by_class = [[np.flatnonzero((away == d) & (own == g)) for g in range(1 << class_bits)] for d in range(reach + 1)]
    flipped = [_parity(m, columns) for m in masks]
    left, right = [], []
    for c in range(share, 1 << class_bits, shares):
        values, owners = [], []
        for d in range(reach + 1):
            for g, rows in enumerate(by_class[d]):
                chosen = masks[d][flipped[d] == np.uint32(g ^ c)]
                if len(rows) and len(chosen):
                    values.append(((prints[rows] & low)[:, None] ^ chosen[None, :]).ravel())
                    owners.append(np.repeat(rows, len(chosen)))
        if not values:
            continue
        value, owner = np.concatenate(values), np.concatenate(owners)
        ordered = np.sort(value)
        repeated = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
        if not len(repeated):
            continue
        # Few variants are shared: look them up through a small table first.
        spread = np.uint64(0x9E3779B97F4A7C15)
        maybe = np.zeros(1 << 20, bool)
        maybe[(repeated * spread) >> np.uint64(44)] = True
        found = np.flatnonzero(maybe[(value * spread) >> np.uint64(44)])
        at = np.searchsorted(repeated, value[found])
        hit = (at < len(repeated)) & (repeated[np.minimum(at, len(repeated) - 1)] == value[found])
        at, who = at[hit], owner[found[hit]]
        order = np.lexsort((who, at))
        at, who = at[order], who[order]
        first = np.searchsorted(at, at, "left")
        pairs = np.unique(who[first] << 32 | who)
        a, b = pairs >> 32, pairs & 0xFFFFFFFF
        near = np.bitwise_count(prints[a] ^ prints[b]) <= 2 * reach
        keep = near & (a != b)
        left.append(a[keep])
        right.append(b[keep])
    if not left:
        return np.empty((0, 2), np.uint64)
    root = _components(np.concatenate(left), np.concatenate(right), len(prints))
    member = np.flatnonzero(root != np.arange(len(prints)))
    return np.stack([prints[root[member]], prints[member]], axis=1)


EDGES = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])


def near_links(prints: DataFrame, count: int, max_bits: int, per_task: int = PER_TASK) -> DataFrame:
    """Links ``a``, ``b`` that connect all fingerprints at ``max_bits`` or fewer
    differing bits, for a table of distinct fingerprints ``fp``.

    ``count`` is their number; it sets only how finely variants are spread.
    """
    if max_bits not in (0, 2, 4):
        raise ValueError("fingerprints that share a variant differ in up to twice the flips: 0, 2 or 4 bits")
    reach = max_bits // 2
    prefix_bits = min(24, max(LEAST_PREFIX_BITS, math.ceil(math.log2(max(1, count / PER_PREFIX)))))
    low_bits = BITS - prefix_bits
    prefix = F.shiftrightunsigned("fp", low_bits)
    moves = F.array(*[F.lit(m).cast("bigint") for m in _flips(range(prefix_bits), reach)])
    weights = [len(_flips(range(low_bits), reach - d)) for d in range(reach + 1)]
    shared = (
        prints.groupBy(prefix.alias("p")).count()
        .select("count", "p", F.explode(moves).alias("m"))
        .select(F.col("p").bitwiseXOR(F.col("m")).alias("q"), F.bit_count("m").cast("int").alias("d"), "count")
        .groupBy("q").agg(F.sum(F.col("count") * F.get(F.array(*map(F.lit, weights)), F.col("d"))).alias("variants"))
        .filter(F.col("variants") > per_task)
        .select("q", F.least(F.lit(2048), F.ceil(F.col("variants") / per_task)).cast("int").alias("wanted"))
        .select("q", F.pow(F.lit(2), F.ceil(F.log2("wanted"))).cast("int").alias("shares"))
    )
    rows = (
        prints.select("fp", F.explode(moves).alias("m")).select("fp", prefix.bitwiseXOR(F.col("m")).alias("q"))
        .join(shared, "q", "left")
        .select("fp", "q", F.coalesce("shares", F.lit(1)).alias("shares"))
        .select("fp", "q", "shares", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)).alias("share"))
    )
    schema = schema_of(EDGES)

    def meet(group: pa.Table) -> pa.Table:
        found = np.sort(group.column("fp").to_numpy().view(np.uint64))
        one = {c: group.column(c)[0].as_py() for c in ("q", "share", "shares")}
        links = _stars(found, one["q"], low_bits, one["share"], one["shares"], reach)
        give_back()
        return pa.Table.from_arrays([pa.array(links[:, i].copy().view(np.int64)) for i in (0, 1)], schema=schema)

    return rows.groupBy("q", "share").applyInArrow(meet, EDGES).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` for every end of an edge ``a``-``b``.

    Each round points every node to its smallest neighbour, follows the
    pointers once, and replaces edges by edges between what they point to.
    Nodes at least halve per round; pointers of all rounds are then composed.
    Minima are combined before the shuffle, so a node with very many edges is
    no burden to one task.
    """
    edges = stored(edges.select("a", "b").filter("a <> b"), "edges")
    rounds = []
    while not edges.isEmpty():
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        up = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("to"))
        up = stored(up, "pointers")
        next_up = up.select(F.col("node").alias("to"), F.col("to").alias("then"))
        up = stored(up.join(next_up, "to").select("node", F.col("then").alias("to")), "pointers")
        rounds.append(up)
        a = up.select(F.col("node").alias("a"), F.col("to").alias("ra"))
        b = up.select(F.col("node").alias("b"), F.col("to").alias("rb"))
        left = edges.join(a, "a").join(b, "b").filter("ra <> rb")
        left = left.select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct()
        edges = stored(left, "edges")
    if not rounds:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    out = rounds[0].select("node", F.col("to").alias("root"))
    for up in rounds[1:]:
        step = up.select(F.col("node").alias("root"), F.col("to").alias("then"))
        out = out.join(step, "root", "left").select("node", F.coalesce("then", "root").alias("root"))
    return out


def _roots(nodes: DataFrame, max_bits: int) -> DataFrame:
    """``nodes``, which has one row per fingerprint ``fp``, with the ``root`` of its component."""
    roots = components(near_links(nodes.select("fp"), nodes.count(), max_bits))
    joined = nodes.join(roots, F.col("fp") == F.col("node"), "left")
    return stored(joined.select(*nodes.columns, F.coalesce("root", "fp").alias("root")), "roots")


def near_duplicates(docs: DataFrame, words: int, max_bits: int) -> DataFrame:
    """One row per document: ``doc_id``, ``fp`` (signed 64 bits) and
    ``component_id``, the smallest id reachable over links."""
    prints = stored(docs.select("doc_id", fingerprint_of(words)("text").alias("fp")), "fingerprints")
    nodes = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "fingerprints")
    rooted = _roots(nodes, max_bits)
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = stored(rooted.join(least, "root").select("fp", "component_id"), "components")
    return prints.join(named, "fp").select("doc_id", "fp", "component_id")


def one_of_each(docs: DataFrame, words: int, max_bits: int) -> DataFrame:
    """One row of ``docs`` for each component: that with the smallest id, then
    the smallest hash of its text; null ids come last."""
    same = F.xxhash64("text")
    prints = docs.select("doc_id", same.alias("same"), fingerprint_of(words)("text").alias("fp"))
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "same")
    nodes = stored(prints.select("fp", order.alias("k")).groupBy("fp").agg(F.min("k").alias("k")), "fingerprints")
    best = _roots(nodes, max_bits).groupBy("root").agg(F.min("k").alias("k"))
    kept = stored(best.select(F.col("k.doc_id").alias("__id"), F.col("k.same").alias("__kept")), "kept")
    marked = docs.withColumn("__same", same)
    one = marked.join(kept, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__same") == F.col("__kept")), "left_semi")
    return one.dropDuplicates(["doc_id", "__same"]).drop("__same")


def hex_digits(fp: str | Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
