"""Greedy longest-match counts against plain greedy matching."""

import random

from functools import cache

import public_tokenizers
import pytest
from cases import documents, empty
from paralex.llm.bpe import loaded
from paralex.llm.catalog import queries
from paralex.llm.token_counts import LongestMatch, token_counts

SF = "/root/testdata/sf0.001"
BYTES = public_tokenizers.path("byte_bpe_50k.json")


def greedy(word, tokens, longest):
    n = at = 0
    while at < len(word):
        at += next(k for k in range(min(longest, len(word) - at), 0, -1) if word[at : at + k] in tokens)
        n += 1
    return n


def test_counts_equal_greedy_matching():
    rng = random.Random(1)
    for _ in range(60):
        tokens = {bytes([b]) for b in b"abc"} | {bytes(rng.choices(b"abc", k=rng.randint(2, 6))) for _ in range(12)}
        match = LongestMatch(sorted(tokens))
        for _ in range(60):
            word = bytes(rng.choices(b"abc", k=rng.randint(0, 25)))
            assert match.count(word) == greedy(word, tokens, 6)


def test_counts_of_the_byte_vocabulary():
    strings = [s for s in loaded(public_tokenizers.path("byte_bpe_50k.json")).strings if s]
    match, tokens = LongestMatch(strings), set(strings)
    words = "internationalisation thntwh!!! éèê 日本語 \x00 aaaaaaaaaaaaaaa".encode().split()
    assert match.total(words * 2) == 2 * sum(greedy(w, tokens, max(map(len, tokens))) for w in words)


def test_words_start_with_their_own_pieces():
    match = LongestMatch([b"a", b"b", b" ", b" a", b" ab", b"ba", b"abb"], b" ")
    assert [match.count(w) for w in (b"a", b"ab", b"abb", b"abba", b"b", b"")] == [1, 1, 2, 2, 2, 1]
    match.total([b"a" * 65, b"a" * 64])
    assert list(match.words) == [b"a" * 64]


@pytest.fixture(scope="module")
def plain_counts():
    tokens = {s for s in loaded(BYTES).strings if s}
    longest = max(map(len, tokens))
    pieces = cache(lambda word: greedy(word, tokens, longest))

    def counts(text):
        words = (text or "").encode().split()
        return len(words), sum(pieces(b" " + w) for w in words)

    return counts


def test_op6_rows_equal_greedy_matching(spark, plain_counts):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = queries()["op6_token_counts"](spark, SF)
    assert got.columns == ["doc_id", "n_words", "n_tokens"]
    assert sorted(map(tuple, got.collect())) == sorted((r.doc_id, *plain_counts(r.text)) for r in docs)


def test_counts_of_odd_rows(spark, plain_counts):
    docs = documents(spark)
    rows = docs.withColumn("t", token_counts(BYTES)("text")).select("text", "t.*").collect()
    assert len(rows) == docs.count()
    for text, *counts in rows:
        assert tuple(counts) == plain_counts(text)
    assert empty(spark).select(token_counts(BYTES)("text")["n_tokens"]).count() == 0
