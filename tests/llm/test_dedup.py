"""Near-duplicates and repeated passages against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest
import xxhash
from cases import documents, empty
from paralex.llm import bytewords, passages, simhash
from paralex.llm.catalog import queries

SF = "/root/testdata/sf0.001"
WORD = re.compile("[^\x20\x09-\x0d]+")


def plain_fingerprint(text, words):
    w = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not w:
        return 0
    shingles = [" ".join(w[i : i + words]) for i in range(max(1, len(w) - words + 1))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def groups(values, near):
    root = list(range(len(values)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(values)):
        for j in range(i):
            if near(values[i], values[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(values))]


def near_prints(rng, n, bits):
    """Chains, dense groups and strangers."""
    out = []
    for _ in range(n // 8):
        x = rng.getrandbits(64)
        out.append(x)
        for _ in range(7):
            y = x
            for b in rng.sample(range(64), rng.randint(0, bits + 1)):
                y ^= 1 << b
            out.append(y)
            if rng.random() < 0.4:
                x = y
    return out


def signed(x):
    return x - (1 << 64) if x >> 63 else x


@pytest.mark.parametrize("per_task", [simhash.PER_TASK, 500])
@pytest.mark.parametrize("max_bits", [2, 4])
def test_links_connect_what_is_near(spark, max_bits, per_task, monkeypatch):
    prints = sorted(set(near_prints(random.Random(max_bits), 240, max_bits)) | {0, 1, (1 << 64) - 1, 3 << 62})
    df = spark.createDataFrame([(signed(x),) for x in prints], "fp long")
    edges = simhash.near_links(df, len(prints), max_bits, per_task)
    for a, b in edges.collect():
        assert a != b
    found = {r.node: r.root for r in simhash.components(edges).collect()}
    want = groups(prints, lambda a, b: (a ^ b).bit_count() <= max_bits)
    got = [found.get(signed(x), signed(x)) for x in prints]
    assert len(set(zip(got, want))) == len(set(got)) == len(set(want))


def test_classes_split_the_variants(monkeypatch):
    monkeypatch.setattr(simhash, "PER_CLASS", 1 << 10)
    prints = np.array(sorted(set(near_prints(random.Random(9), 80, 4))), np.uint64)
    low = 60
    for q in {int(p) >> low for p in prints}:
        own = prints[np.bitwise_count((prints >> np.uint64(low)) ^ np.uint64(q)) <= 2]
        whole = {tuple(r) for r in simhash._stars(own, q, low, 0, 1, 2).tolist()}
        parts = [tuple(r) for s in range(4) for r in simhash._stars(own, q, low, s, 4, 2).tolist()]
        a, b = (simhash._components(*edges(own, e), len(own)).tolist() for e in (whole, parts))
        assert a == b


def edges(prints, pairs):
    pairs = np.array(sorted(pairs), np.uint64).reshape(-1, 2)
    return np.searchsorted(prints, pairs[:, 0]), np.searchsorted(prints, pairs[:, 1])


def test_components_of_a_long_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(1, 200)] + [(5000, 5000)]
    random.Random(1).shuffle(chain)
    rows = simhash.components(spark.createDataFrame(chain, "a long, b long")).collect()
    assert {r.node: r.root for r in rows} == {**{i: 0 for i in range(301)}, **{1000 + i: 1000 for i in range(200)}}


def test_near_duplicates_of_odd_rows(spark):
    docs = documents(spark)
    rows = simhash.near_duplicates(docs, 4, 4).collect()
    source = docs.select("doc_id", "text").collect()
    assert sorted((str(r.doc_id), r.fp) for r in rows) == sorted((str(r.doc_id), signed(plain_fingerprint(r.text, 4))) for r in source)
    assert {r.component_id for r in rows if r.fp == 0} == {0}
    assert simhash.near_duplicates(empty(spark), 4, 4).count() == 0
    one = simhash.one_of_each(docs, 4, 4)
    assert one.columns == docs.columns
    kept = one.select("doc_id", "text").collect()
    prints = [plain_fingerprint(r.text, 4) for r in source]
    assert len(kept) == len(set(groups(prints, lambda a, b: (a ^ b).bit_count() <= 4)))
    assert len({plain_fingerprint(r.text, 4) for r in kept}) == len(kept)
    assert simhash.one_of_each(empty(spark), 4, 4).count() == 0


def test_op5(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    ids = sorted(docs)
    prints = [plain_fingerprint(docs[i], 4) for i in ids]
    root = groups(prints, lambda a, b: (a ^ b).bit_count() <= 4)
    want = {i: (f"{p:016x}", ids[r]) for i, p, r in zip(ids, prints, root)}
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in queries()["op5_simhash"](spark, SF).collect()} == want


def plain_removal(rows, size):
    """Rows (id, text) in order; the words left and their number before."""
    seen, out = set(), []
    for key, text in rows:
        w = (text or "").encode().split()
        covered = [False] * len(w)
        for s in range(len(w) - size + 1):
            k = tuple(w[s : s + size])
            if k in seen:
                covered[s : s + size] = [True] * size
            seen.add(k)
        out.append((key, len(w), sum(covered), b" ".join(x for x, c in zip(w, covered) if not c).decode()))
    return out


def passage_texts(seed, n=120):
    rng = random.Random(seed)
    shared = [" ".join(rng.choices("abcdefgh", k=rng.randint(3, 30))) for _ in range(6)]
    texts = []
    for _ in range(n):
        parts = [" ".join(rng.choices(["alpha", "béta", "gamma", "delta", "ε"], k=rng.randint(0, 12)))]
        parts += [rng.choice(shared) for _ in range(rng.randint(0, 3))]
        rng.shuffle(parts)
        texts.append(rng.choice([" ", "\n", " \t "]).join(parts))
    return texts + ["a a a a a a a a a a", "a a a a a a", None, ""]


@pytest.mark.parametrize("size", [1, 4, 20])
@pytest.mark.parametrize("row_bits", [4, 22])
def test_repeats_equal_brute_force(spark, size, row_bits, monkeypatch):
    monkeypatch.setattr(passages, "LEAST_RANGES", 2)
    monkeypatch.setattr(passages, "KEPT", 50)
    monkeypatch.setattr(passages, "HELD", 40)
    texts = passage_texts(size)
    docs = documents(spark, texts).repartition(5)
    rows = passages.remove_repeats(docs, size, most_row_bits=row_bits).select("doc_id", "repeats.*").collect()
    assert sorted(map(tuple, rows)) == plain_removal(list(enumerate(texts)), size)


def thue_morse(a, b, doublings=10):
    for _ in range(doublings):
        a, b = a + b, b + a
    return a


def test_words_with_equal_polynomial_hashes_are_kept(spark):
    common = " ".join(f"w{i}" for i in range(19))
    texts = [f"{common} {thue_morse('a', 'b')}", f"{common} {thue_morse('b', 'a')}", f"{common} {thue_morse('a', 'b')}"]
    rows = passages.remove_repeats(documents(spark, texts), 20).select("doc_id", "repeats.*").collect()
    assert sorted(map(tuple, rows)) == plain_removal(list(enumerate(texts)), 20)
    assert sorted((r.doc_id, r.n_removed) for r in rows) == [(0, 0), (1, 0), (2, 20)]


def test_texts_above_one_chunk(spark):
    """Texts longer than a chunk, with a passage over the edge of a chunk."""
    rng = random.Random(8)
    words = [f"v{rng.randrange(10**9)}" for _ in range(60_000)]
    half = len(" ".join(words).encode()) // 2
    assert half > bytewords.CHUNK
    texts = [" ".join(words), " \n ".join(words[20_000:] + ["z"]), "a " + "\t".join(words[10:40])]
    rows = passages.remove_repeats(documents(spark, texts), 20).select("doc_id", "repeats.*").collect()
    assert sorted(map(tuple, rows)) == plain_removal(list(enumerate(texts)), 20)


def test_long_texts_are_hashed_in_parts(monkeypatch):
    import pyarrow as pa

    texts = pa.array(["x " * 50 + "word", None, "ab " * 900, "", "q" * 700 + " z"])
    one = [bytewords.word_hashes(d, e) for _, d, e in bytewords.slices(texts)]
    monkeypatch.setattr(bytewords, "CHUNK", 64)
    parts = [bytewords.word_hashes(d, e) for _, d, e in bytewords.slices(texts)]
    assert np.concatenate([w for w, _ in one]).tolist() == np.concatenate([w for w, _ in parts]).tolist()
    assert sum((c.tolist() for _, c in parts), []) == [51, 0, 900, 0, 2]
    words = np.concatenate([w for w, _ in parts])
    assert len(set(words.tolist())) == 5
    assert len(bytewords.window_hashes(words, 20, 1)) == len(words) - 19


def test_repeats_of_odd_rows(spark):
    docs = documents(spark)
    out = passages.remove_repeats(docs, 2)
    assert out.columns == [*docs.columns, "repeats"]
    rows = out.select("doc_id", "text", "repeats.*").collect()
    assert len(rows) == docs.count()
    twice = [r for r in rows if r.doc_id == 4]
    assert len(twice) == 2 and twice[0] == twice[1]
    for r in rows:
        assert r.n_words == len((r.text or "").encode().split()) and len(r.kept.encode().split()) == r.n_words - r.n_removed
    assert passages.remove_repeats(empty(spark), 2).count() == 0
    assert "repeats" in passages.remove_repeats(out, 2).columns


def test_op7(spark):
    rows = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect())
    want = {k: (n, m, hashlib.sha256(t.encode()).hexdigest()) for k, n, m, t in plain_removal(rows, 20)}
    got = queries()["op7_passages"](spark, SF).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in got} == want
