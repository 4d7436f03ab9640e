"""BPE and packing against the tokenizers library and against what packing promises."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from cases import TEXTS, documents, empty
from paralex.llm import bpe, packing
from paralex.llm.catalog import queries
from pyspark.sql import functions as F
from tokenizers import Tokenizer

SF = "/root/testdata/sf0.001"
BYTES, WORDS = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))


def odd_texts(n=400):
    rng = random.Random(3)
    alphabet = " \n\t aB'sÉt1%🎉<|İ́ Ǆ\x1c\x85"
    return ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 70))) for _ in range(n)]


@pytest.fixture(scope="module")
def by_library():
    return Tokenizer.from_file(BYTES), Tokenizer.from_file(WORDS)


def test_byte_bpe_equals_the_library(by_library):
    own = bpe.ByteBpe(BYTES)
    for text in [t or "" for t in TEXTS] + odd_texts():
        ids = by_library[0].encode(text, add_special_tokens=False).ids
        assert list(own.encode(text)) == ids
        assert own.decode(ids) == by_library[0].decode(ids, skip_special_tokens=False)


def test_runs_of_other_white_space_are_one_piece(by_library):
    own, rng = bpe.ByteBpe(BYTES), random.Random(5)
    texts = ["x \u00a0 \u00a0\nword", "\u3000 \u3000 x", "x\u00a0 \u00a0", "x\n \n \ny"]
    texts += ["".join(rng.choice(" \u00a0\u3000\n\t\u2003\x1cx1!") for _ in range(rng.randint(0, 12))) for _ in range(20_000)]
    for text in texts:
        ids = by_library[0].encode(text, add_special_tokens=False).ids
        assert list(own.encode(text)) == ids, repr(text)
        assert b"".join(map(own.pieces.__getitem__, own.pattern.findall(text))) == own.encode(text).tobytes()


def test_small_caches_change_nothing(by_library, monkeypatch):
    monkeypatch.setattr(bpe, "CACHED", 3)
    for name in ("CACHED_WORDS", "CACHED_OTHERS"):
        monkeypatch.setattr(packing, name, 3)
    own, words = bpe.ByteBpe(BYTES), packing.WordTokenizer(WORDS)
    for text in odd_texts(100):
        assert list(own.encode(text)) == by_library[0].encode(text, add_special_tokens=False).ids
        assert np.frombuffer(words.packed(text), "<u4").tolist() == by_library[1].encode(text, add_special_tokens=False).ids


def test_word_ids_equal_the_library(by_library):
    own = packing.WordTokenizer(WORDS)
    for text in [t or "" for t in TEXTS] + odd_texts():
        assert np.frombuffer(own.packed(text), "<u4").tolist() == by_library[1].encode(text, add_special_tokens=False).ids


def test_word_ids_of_marks_and_cut_texts(by_library, monkeypatch):
    """Every character that is looked up here, alone and between others, and a
    text whose slices end at each kind of white space."""
    own, rng = packing.WordTokenizer(WORDS), random.Random(7)
    chars = [chr(c) for c in (*range(0x250), *range(0x2000, 0x2070), 0x3000, 0x212B)]
    texts = [t for c in chars for t in (c, f"a{c}b", f"{c}{c} '{c}s 1{c}", f"X{c}\n{c}'ll")]
    texts += ["".join(rng.choice(chars) if rng.random() < 0.2 else rng.choice("abE 's\n1.’—") for _ in range(40)) for _ in range(4000)]
    for text in texts:
        want = by_library[1].encode(text, add_special_tokens=False).ids
        assert np.frombuffer(own.packed(text), "<u4").tolist() == want, repr(text)
    monkeypatch.setattr(packing, "TEXT_SLICE", 5)
    text = "some words\tof a\x0btext\x0cthat\r\nis ’cut’ <|endoftext|> " * 9 + "withoutanyspaceattheend"
    assert len(list(packing._slices(text))) > 20 and "".join(packing._slices(text)) == text
    assert np.frombuffer(own.packed(text), "<u4").tolist() == by_library[1].encode(text, add_special_tokens=False).ids


def test_decode_takes_null_and_unknown_ids(spark):
    ids = list(bpe.ByteBpe(BYTES).encode("plain text"))
    df = spark.createDataFrame([(ids,), (None,), ([],), ([99_999_999, ids[0], -1],)], "ids array<int>")
    assert [r[0] for r in df.select(bpe.bpe_decode(BYTES)("ids")["text"]).collect()] == ["plain text", "", "", "plain"]


def test_round_trip_of_odd_rows(spark):
    docs = documents(spark)
    rows = docs.withColumn("ids", bpe.bpe_round_trip(BYTES)("text")).select("text", "ids.*").collect()
    assert len(rows) == docs.count()
    for text, ids, decoded in rows:
        assert decoded == (text or "") and bool(ids) == bool(text)
    only = docs.select(bpe.bpe_encode(BYTES)("text")["ids"].alias("i")).collect()
    assert sorted(map(str, (r.i for r in only))) == sorted(map(str, (r.ids for r in rows)))


def test_op1_digests(spark, by_library):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in queries()["op1_bpe"](spark, SF).collect():
        ids = by_library[0].encode(docs[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        text = by_library[0].decode(ids, skip_special_tokens=False)
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def check_packing(rows, capacity):
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for b in bins.values():
        at = 0
        for offset, length in sorted(b):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


@pytest.mark.parametrize("open_bins", [1, 3, 64])
def test_packing_is_gapless_and_close_to_full(spark, open_bins):
    rng = random.Random(5)
    sizes = [(i, rng.choice([1, 2, 100, rng.randint(1, 100), rng.randint(20, 40)])) for i in range(3000)]
    df = spark.createDataFrame(sizes, "id long, length long").withColumn("offset", F.lit("x")).repartition(7)
    rows = packing.best_fit(df, 100, open_bins).collect()
    assert sorted((r.id, r.length) for r in rows) == sizes
    used = check_packing(rows, 100)
    assert used <= (1.02 if open_bins == 64 else 1.5) * sum(s for _, s in sizes) / 100 + 1


def test_fullest_bin_closes_first():
    bins = packing.Bins(10, 2)
    assert [bins.add(n) for n in (6, 7, 8)] == [(0, 0), (1, 0), (2, 0)]  # the third opening closes the fullest, bin 2
    assert bins.add(2) == (1, 7) and bins.add(4) == (0, 6)
    assert bins.open() == [(1, 9)]


def test_pieces_of_odd_rows(spark):
    docs = documents(spark)
    pieces = packing.token_pieces(docs, WORDS, 1, 16)
    rows = packing.best_fit(pieces, 16).collect()
    assert check_packing(rows, 16) > 0
    by_doc = {}
    for r in rows:
        assert r.length == len(r.ids) // 4 and 0 < r.length <= 16 and r.start == 16 * r.piece
        by_doc.setdefault(r.doc_id, 0)
    assert sum(r.length for r in rows) == sum(
        len(packing.tokenizer(WORDS).packed(r.text)) // 4 + 1 for r in docs.select("text").collect()
    )
    assert packing.best_fit(packing.token_pieces(empty(spark), WORDS, 1, 16), 16).count() == 0


def test_op3(spark, by_library):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = queries()["op3_packing"](spark, SF).collect()
    used = check_packing(rows, 4096)
    assert used <= sum(r.length for r in rows) / 4096 * 1.05 + 1
    import zlib

    got = {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in rows}
    want = {}
    for i, text in docs.items():
        ids = np.array(by_library[1].encode(text, add_special_tokens=False).ids + [1], "<u4")
        for n, at in enumerate(range(0, len(ids), 4096)):
            cut = ids[at : at + 4096]
            want[i, n] = (at, len(cut), zlib.crc32(cut.tobytes()))
    assert got == want
