"""Mixture-controlled packing: whole results, no padding, shares of every window."""

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from cases import TEXTS, documents, empty
from paralex.llm import mixture
from paralex.llm.catalog import queries
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

SF = "/root/testdata/sf0.001"
WORDS = public_tokenizers.path("word_bpe_49k.json")
FIELDS = "doc_id long, source string, text string"


def queue_rows(spark, sizes, parts=3):
    """Queues of documents with given sizes: ids count up within a document."""
    rows, before = [], defaultdict(int)
    for i, (source, n) in enumerate(sizes):
        part = i * parts // len(sizes)
        rows.append((i, source, part, before[part, source], n, np.arange(n).astype("<u2").tobytes()))
        before[part, source] += n
    return spark.createDataFrame(rows, "doc_id long, source string, part int, before long, length long, ids binary").repartition(4)


def windows_of(rows, window):
    """Checks that every token lies in one piece and every sequence is gapless;
    tokens by source of each sequence, in order."""
    docs, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        docs[r.doc_id, r.doc_tokens].append((r.start, r.length))
        sequences[r.sequence_id].append((r.offset, r.length, r.source))
    for (_, tokens), pieces in docs.items():
        at = 0
        for start, length in sorted(pieces):
            assert start == at and length > 0
            at += length
        assert at == tokens
    out = []
    for _, pieces in sorted(sequences.items()):
        at, mixed = 0, defaultdict(int)
        for offset, length, source in sorted(pieces, key=lambda p: p[0]):
            assert offset == at
            at += length
            mixed[source] += length
        assert at == window or (at < window and at & (at - 1) == 0)  # no padding
        out.append(dict(mixed))
    return out


def test_every_window_has_the_mixture_of_the_corpus(spark):
    rng = np.random.default_rng(1)
    names = ["hot"] * 50 + ["a"] * 30 + [None] * 15 + ["rare"] * 2
    sizes = [(names[rng.integers(len(names))], int(rng.integers(1, 900))) for _ in range(1200)]
    total = defaultdict(int)
    for s, n in sizes:
        total[s] += n
    everything = sum(total.values())
    rows = mixture.mix(queue_rows(spark, sizes), 512, tokens=64 * 512).collect()
    assert {r.doc_id for r in rows} == set(range(len(sizes)))
    done, windows = defaultdict(int), windows_of(rows, 512)
    for n, mixed in enumerate(windows):
        room = sum(mixed.values())
        for s in total:
            done[s] += mixed.get(s, 0)
            if room == 512:
                assert abs(mixed.get(s, 0) - 512 * total[s] / everything) <= 2 * mixture.LEAST_RUN, (n, s)
        # Deficits are carried: no source runs away from its share over all windows so far.
        so_far = sum(done.values())
        assert all(abs(done[s] - so_far * total[s] / everything) <= 2 * mixture.LEAST_RUN for s in total), n
    assert dict(done) == dict(total)
    assert sum(sum(w.values()) < 512 for w in windows) <= 10 * -(-everything // (64 * 512))


def test_the_size_of_a_range_changes_no_share(spark):
    """A range starts where those before it leave off, at every place."""
    sizes = [("x", 700), ("y", 300)] * 40 + [("one", 1)]
    for tokens in (128, 640, 1 << 20):
        rows = mixture.mix(queue_rows(spark, sizes), 128, tokens=tokens, least_run=1).collect()
        for mixed in windows_of(rows, 128):
            if sum(mixed.values()) == 128:
                assert abs(mixed["x"] - 0.7 * 128) < 4 and abs(mixed["y"] - 0.3 * 128) < 4


def test_targets_hold_until_a_queue_runs_out(spark):
    sizes = [("a", 100)] * 40 + [("b", 50)] * 160 + [("c", 10)] * 30 + [(None, 7)] * 10
    rows = mixture.mix(queue_rows(spark, sizes), 64, {"a": 3, "b": 1, None: 0, "not there": 5}, least_run=1, tokens=640).collect()
    windows = [w for w in windows_of(rows, 64) if sum(w.values()) == 64]
    both = [w for w in windows if "a" in w]
    assert all(abs(w["a"] - 48) <= 3 for w in both[:-2]) and len(both) >= 4000 // 48 - 10
    assert sum(w.get("a", 0) for w in both) >= 4000 - 64 * 10
    after = windows[len(both):]
    assert after[0].keys() == {"b"}  # goes on alone
    assert any(set(w) == {"c", None} for w in after[-4:])  # without a target: last


def test_many_small_sources_share_the_windows(spark):
    sizes = [(f"s{i % 300}", 40) for i in range(1500)]
    windows = windows_of(mixture.mix(queue_rows(spark, sizes), 256).collect(), 256)
    assert sum(map(sum, (w.values() for w in windows))) == 60_000
    runs = [n for w in windows for n in w.values()]
    assert np.median(runs) >= mixture.LEAST_RUN / 2  # not one token of each


def test_one_long_document_spans_ranges(spark):
    rows = mixture.mix(queue_rows(spark, [("a", 5), ("b", 20_001)]), 64, tokens=256).collect()
    windows_of(rows, 64)
    got = np.concatenate([np.frombuffer(r.ids, "<u4") for r in sorted(rows, key=lambda r: r.start) if r.doc_id == 1])
    assert got.tolist() == list(range(20_001))


def test_products_beyond_64_bits(spark):
    df = spark.createDataFrame([(3 * 10**13, 2 * 10**7, 4 * 10**13)], "a long, b long, c long")
    assert df.select(mixture._share(F.col("a"), F.col("b"), F.col("c"))).first()[0] == 15 * 10**6


def test_odd_rows(spark):
    docs = documents(spark).withColumn("source", F.when(F.col("doc_id") % 3 == 0, "x").when(F.col("doc_id") == 4, ""))
    queues = mixture.token_queues(docs, WORDS, 1)
    rows = mixture.mix(queues, 16).collect()
    library = Tokenizer.from_file(WORDS)
    want = sorted(tuple([*library.encode(r.text or "", add_special_tokens=False).ids, 1]) for r in docs.collect())
    by_doc = defaultdict(list)
    for r in rows:
        by_doc[str(r.doc_id), r.doc_tokens, r.source].append(r)
    assert sum(r.length for r in rows) == sum(map(len, want))
    for r in rows:
        assert len(r.ids) == 4 * r.length
    none = mixture.mix(mixture.token_queues(empty(spark).withColumn("source", F.lit("x")), WORDS, 1), 16)
    assert none.count() == 0 and none.columns == [
        "doc_id", "source", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"]
    no_source = documents(spark, TEXTS[:5]).withColumn("source", F.lit(None).cast(T.StringType()))
    assert mixture.mix(mixture.token_queues(no_source, WORDS, 1), 16).count() > 0


@pytest.mark.parametrize("least", [1, 40])
def test_rounds_are_full_and_use_up_the_queues(least):
    rng = np.random.default_rng(least)
    for _ in range(200):
        sizes = rng.integers(1, 400, rng.integers(1, 30))
        windows = mixture.window_sizes(int(sizes.sum()), 64)
        owed = rng.random(len(sizes))
        given = list(mixture.deficit_rounds(sizes, sizes + 0.0, owed, windows, least))
        assert [int(g.sum()) for g in given] == windows and all((g >= 0).all() for g in given)
        assert (sum(given) == sizes).all()


def test_op11(spark):
    library = Tokenizer.from_file(WORDS)
    rows = queries()["op11_mixture"](spark, SF).collect()
    want = {
        r.doc_id: np.array(library.encode(r.text or "", add_special_tokens=False).ids + [1], "<u4")
        for r in spark.read.parquet(f"{SF}/documents.parquet").collect()
    }
    assert {r.doc_id for r in rows} == want.keys()
    for r in rows:
        ids = want[r.doc_id]
        assert r.doc_tokens == len(ids) and zlib.crc32(ids[r.start : r.start + r.length].tobytes()) == r.ids_crc32
    windows_of(rows, 2048)
