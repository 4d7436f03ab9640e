"""Byte-level BPE: texts to token ids and back.

A text is cut into pieces by the pattern of the vocabulary, and each piece is
merged on its own: a heap holds the merge ranks of neighbouring symbols, the
symbols form a doubly linked list, and heap entries whose symbols have changed
meanwhile are skipped.  Decoding concatenates the vocabulary strings of the ids.

Null and empty texts have no ids and decode to the empty text.  Texts of any
length are handled; strings of special tokens in a text become their own ids.
Results depend on the text alone, so repeated rows get equal results.
"""

from __future__ import annotations

import json
from array import array
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import types as T

from paralex.llm.common import column_function, text_function

PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
CACHED = 250_000  # entries of each half of a cache in a Python worker
LONGEST_CACHED = 64
_HERE = (1 << 40) - 1
_LOADED: dict[str, ByteBpe] = {}


def byte_alphabet() -> dict[int, str]:
    """The character that stands for each byte in vocabularies of this kind:
    printable Latin-1 characters stand for themselves, the rest follow 255."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}


class _Cache(dict):
    """Packed ids by key, of bounded size: when the younger half is full it
    becomes the older one, and keys met again are taken over."""

    def __init__(self, compute, half: int):
        super().__init__()
        self.compute, self.half, self.older = compute, half, {}

    def __missing__(self, key: str) -> bytes:
        value = self.older.get(key)
        if value is None:
            value = self.compute(key)
        if len(key) <= LONGEST_CACHED:
            if len(self) >= self.half:
                self.older = dict(self)
                self.clear()
            self[key] = value
        return value


class ByteBpe:
    """Encoder and decoder of one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, added = spec["model"]["vocab"], spec["added_tokens"]
        alphabet = byte_alphabet()
        back = {c: b for b, c in alphabet.items()}
        size = max([*vocab.values(), *(t["id"] for t in added)]) + 1
        self.strings = [b""] * size
        for token, i in vocab.items():
            self.strings[i] = bytes(back[c] for c in token)
        self.special = {t["content"]: t["id"] for t in added}
        for token, i in self.special.items():
            self.strings[i] = token.encode()
        self.byte_ids = [vocab[alphabet[b]] for b in range(256)]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        self.merges = [(vocab[a], vocab[b], vocab[a + b]) for a, b in pairs]
        self.ranks = {a << 20 | b: rank for rank, (a, b, _) in enumerate(self.merges)}
        self.pattern = regex.compile(PIECES)
        self.inside = regex.compile(r"\s \s")
        self.specials = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.pieces = _Cache(self._piece, CACHED)
        self.words = _Cache(self._word, CACHED)

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one piece."""
        ids = [self.byte_ids[b] for b in piece]
        n, rank_of, merges = len(ids), self.ranks.get, self.merges
        heap = []
        for i in range(n - 1):
            rank = rank_of(ids[i] << 20 | ids[i + 1])
            if rank is not None:
                heap.append(rank << 40 | i)
        if not heap:
            return ids
        heapify(heap)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        while heap:
            entry = heappop(heap)
            i = entry & _HERE
            left, right, joined = merges[entry >> 40]
            j = after[i]
            if ids[i] != left or j == n or ids[j] != right:
                continue  # one of the symbols was merged meanwhile
            ids[i], ids[j] = joined, -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                rank = rank_of(joined << 20 | ids[k])
                if rank is not None:
                    heappush(heap, rank << 40 | i)
            h = before[i]
            if h >= 0:
                rank = rank_of(ids[h] << 20 | joined)
                if rank is not None:
                    heappush(heap, rank << 40 | h)
        return [x for x in ids if x >= 0]

    def _piece(self, piece: str) -> bytes:
        return array("I", self.merge(piece.encode())).tobytes()

    def _word(self, word: str) -> bytes:
        return b"".join(map(self.pieces.__getitem__, self.pattern.findall(" " + word)))

    def _plain(self, text: str) -> bytes:
        # A space begins a piece unless it stands inside a run of white space, all
        # of which but the last character is one piece.  Without such runs words
        # with their leading space are looked up whole.
        if "  " in text or text.endswith(" ") or self.inside.search(text):
            return b"".join(map(self.pieces.__getitem__, self.pattern.findall(text)))
        first, *words = text.split(" ")
        head = b"".join(map(self.pieces.__getitem__, self.pattern.findall(first)))
        return head + b"".join(map(self.words.__getitem__, words))

    def encode(self, text: str | None) -> array:
        out = array("I")
        if not text:
            return out
        if self.specials is None or not any(s in text for s in self.special):
            out.frombytes(self._plain(text))
            return out
        for part in self.specials.split(text):
            if part in self.special:
                out.append(self.special[part])
            elif part:
                out.frombytes(self._plain(part))
        return out

    def decode(self, ids) -> str:
        """The text of the ids; ids outside the vocabulary add nothing."""
        size = len(self.strings)
        try:
            data = b"".join(map(self.strings.__getitem__, ids))
        except (IndexError, TypeError):
            data = b"".join(self.strings[i] for i in ids if i is not None and 0 <= i < size)
        return data.decode("utf-8", "replace")


def loaded(path: str) -> ByteBpe:
    """The encoder of a file, kept by the Python worker for its later tasks."""
    if path not in _LOADED:
        _LOADED[path] = ByteBpe(path)
    return _LOADED[path]


IDS = T.ArrayType(T.IntegerType(), False)


def _lists(ids: list[array]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), np.frombuffer(b"".join(x.tobytes() for x in ids), np.int32))


def bpe_round_trip(path: str):
    """A column function: text to a struct of ``ids`` and the ``decoded`` text."""

    def make():
        bpe = loaded(path)

        def work(texts):
            ids = [bpe.encode(t.as_py()) for t in texts]
            return pa.StructArray.from_arrays([_lists(ids), pa.array(map(bpe.decode, ids), pa.string())], ["ids", "decoded"])

        return work

    return column_function(make, T.StructType([T.StructField("ids", IDS), T.StructField("decoded", T.StringType())]))


def bpe_encode(path: str):
    """A column function: text to a struct of ``ids``."""

    def make():
        bpe = loaded(path)
        return lambda texts: pa.StructArray.from_arrays([_lists([bpe.encode(t.as_py()) for t in texts])], ["ids"])

    return column_function(make, T.StructType([T.StructField("ids", IDS)]))


def bpe_decode(path: str):
    """A column function: ids to a struct of ``text``; null ids give the empty text."""

    def make():
        bpe = loaded(path)
        return lambda ids: {"text": bpe.decode(ids or [])}

    return text_function(make, T.StructType([T.StructField("text", T.StringType())]))
