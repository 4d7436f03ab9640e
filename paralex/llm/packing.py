"""Token pieces of documents, and their packing into sequences of fixed length.

Packing is bounded-space online best fit.  Every task keeps a fixed number of
open bins; a bitset has a bit for each amount of free space that some open bin
has, so the bin that a piece fits best is the lowest set bit at or above its
length.  When too many bins are open the fullest one is closed.  The pieces of
one Arrow batch are taken longest first.  Bins still open at the end of a task
are joined with those of neighbouring tasks in a second, small round.

Null texts are empty; an empty text is the end token alone.  Equal rows are
separate documents.  An empty table gives an empty result.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paralex.llm.bpe import _Cache, byte_alphabet
from paralex.llm.common import SLICE, batches_of, bounded_batches, schema_of, stored

OPEN_BINS = 512
# Entries of each half of a cache in a Python worker
CACHED_WORDS, CACHED_OTHERS = 300_000, 30_000
TEXT_SLICE = 1 << 18  # characters looked up at once
BETWEEN_WORDS = re.compile("[ \t\n\r\x0b\x0c]")
TASKS_JOINED = 64  # tasks whose last open bins are packed together
_LOADED: dict[str, WordTokenizer] = {}


class WordTokenizer:
    """Ids of the tokenizers library, looked up by word.

    For vocabularies whose pre-tokenizer drops white space, so words between
    white space are encoded independently of each other.  Texts of Latin letters
    and common marks are split, normalised and cut here, and each cut is given to
    the library's model; words of other texts are given to the library whole.
    Ids of words and cuts are kept in caches of bounded size.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.alphabet = byte_alphabet()
        # Characters that the library's normaliser only lower-cases, each on its own, and
        # that Python splits on if and only if the library does.
        simple = [chr(c) for c in (*range(0x1C), *range(0x20, 0x130), *range(0x131, 0x250), *range(0x2010, 0x2028), *range(0x2030, 0x205F))]
        self.odd = re.compile(f"[^{re.escape(''.join(simple))}]")
        lowered = sorted({c.lower() for c in simple})
        among = lambda kind: re.escape("".join(c for c in lowered if regex.fullmatch(kind, c)))
        letters, numbers, spaces = map(among, (r"\p{L}", r"\p{N}", r"\s"))
        self.cuts = re.compile(f"[{letters}]+|'(?:s|t|re|ve|m|ll|d)|[{numbers}]|[^{letters}{numbers}{spaces}]+")
        self.words = _Cache(self._word, CACHED_WORDS)
        self.others = _Cache(self._other, CACHED_OTHERS)

    def _cut(self, symbols: str) -> bytes:
        return array("I", [t.id for t in self.library.model.tokenize(symbols)]).tobytes()

    def _word(self, word: str) -> bytes:
        low = word.lower()
        if low.isalpha():
            if low != word:
                return self.words[low]
            return self._cut(low if low.isascii() else low.encode().decode("latin-1").translate(self.alphabet))
        if low[:-1].isalpha() and not low[-1].isalnum():  # the usual case: a mark at the end
            return self.words[low[:-1]] + self.words[low[-1]]
        cuts = self.cuts.findall(low)
        if len(cuts) == 1:
            return self._cut(low.encode().decode("latin-1").translate(self.alphabet))
        return b"".join(map(self.words.__getitem__, cuts))

    def _other(self, word: bytes) -> bytes:
        return array("I", self.library.encode(word.decode(), add_special_tokens=False).ids).tobytes()

    def packed(self, text: str | None) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        return b"".join(map(self._slice, _slices(text or "")))

    def _slice(self, text: str) -> bytes:
        if self.odd.search(text) or ("<|" in text and any(t in text for t in self.special)):
            return b"".join(map(self.others.__getitem__, text.encode().split()))
        return b"".join(map(self.words.__getitem__, text.split()))


def _slices(text: str) -> Iterator[str]:
    """A text in slices that end between words, so that the words of a very long
    text are not all held at once."""
    at = 0
    while at < len(text):
        end = len(text)
        if end - at > TEXT_SLICE:
            space = BETWEEN_WORDS.search(text, at + TEXT_SLICE)
            end = space.start() if space else end
        yield text[at:end]
        at = end


def tokenizer(path: str) -> WordTokenizer:
    """The tokenizer of a file, kept by the Python worker for its later tasks."""
    if path not in _LOADED:
        _LOADED[path] = WordTokenizer(path)
    return _LOADED[path]


def token_pieces(docs: DataFrame, path: str, end_id: int, most: int) -> DataFrame:
    """One row per piece: ``doc_id``, ``piece``, ``start``, ``length`` and
    ``ids`` (packed little-endian unsigned 32-bit integers).

    A document is its ids and the end id; only what is longer than ``most``
    is cut.
    """
    returns = T.StructType([
        T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("piece", T.IntegerType()),
        T.StructField("start", T.LongType()), T.StructField("length", T.LongType()), T.StructField("ids", T.BinaryType()),
    ])
    schema = schema_of(returns)
    bounded_batches(docs.sparkSession)

    def make():
        tokens = tokenizer(path)
        end = array("I", [end_id]).tobytes()

        def work(batch):
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                rows, piece, start, length, ids = [], [], [], [], []
                for row, text in enumerate(part.column(1)):
                    data = tokens.packed(text.as_py()) + end
                    for n, left in enumerate(range(0, len(data), 4 * most)):
                        cut = data[left : left + 4 * most]
                        rows.append(row)
                        piece.append(n)
                        start.append(left // 4)
                        length.append(len(cut) // 4)
                        ids.append(cut)
                columns = [part.column(0).take(pa.array(rows, pa.int64())), *map(pa.array, (piece, start, length, ids))]
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, schema)], schema=schema)

        return work

    return docs.select("doc_id", "text").mapInArrow(batches_of(make), returns)


class Bins:
    """Open bins by free space.  ``add`` returns the bin and the offset in it."""

    def __init__(self, capacity: int, most_open: int, first: int = 0):
        self.capacity, self.most, self.next = capacity, most_open, first
        self.by_free: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.set, self.count = 0, 0

    def add(self, size: int, name: int | None = None) -> tuple[int, int]:
        """``name`` is given to the bin if a new one is opened."""
        fits = self.set >> size
        if fits:
            free = size + (fits & -fits).bit_length() - 1
            target = self._take(free)
        else:
            free = self.capacity
            target = self.next if name is None else name
            self.next += 1
        if free > size:
            if not self.by_free[free - size]:
                self.set |= 1 << (free - size)
            self.by_free[free - size].append(target)
            self.count += 1
            if self.count > self.most:
                self._take((self.set & -self.set).bit_length() - 1)
        return target, self.capacity - free

    def _take(self, free: int) -> int:
        target = self.by_free[free].pop()
        if not self.by_free[free]:
            self.set &= ~(1 << free)
        self.count -= 1
        return target

    def open(self) -> list[tuple[int, int]]:
        """Names of open bins with the space used in them."""
        return [(b, self.capacity - free) for free, bins in enumerate(self.by_free) for b in bins]


def best_fit(pieces: DataFrame, capacity: int, open_bins: int = OPEN_BINS) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to rows with a ``length`` of 1 to
    ``capacity``; columns of these two names are replaced.

    Rows should be narrow: they are written once between the two rounds.
    """
    kept = pieces.drop("sequence_id", "offset")
    added = [("sequence_id", T.LongType()), ("offset", T.LongType()), ("__open_used", T.LongType())]
    returns = T.StructType([*[T.StructField(f.name, f.dataType) for f in kept.schema], *[T.StructField(*a) for a in added]])
    schema = schema_of(returns)

    def first_round(batches):
        bins = Bins(capacity, open_bins, TaskContext.get().partitionId() << 40)
        for batch in batches:
            sizes = batch.column("length").to_numpy(zero_copy_only=False).astype(np.int64)
            target, offset = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64)
            for i in np.argsort(-sizes, kind="stable").tolist():
                target[i], offset[i] = bins.add(int(sizes[i]))
            columns = [*batch.columns, pa.array(target), pa.array(offset), pa.nulls(len(sizes), pa.int64())]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, schema)], schema=schema)
        left = bins.open()
        columns = [pa.nulls(len(left), f.type) for f in schema]
        columns[-3], columns[-1] = pa.array([b for b, _ in left], pa.int64()), pa.array([u for _, u in left], pa.int64())
        yield pa.RecordBatch.from_arrays(columns, schema=schema)

    moved = T.StructType([T.StructField("__bin", T.LongType()), T.StructField("__to", T.LongType()), T.StructField("__base", T.LongType())])
    moved_schema = schema_of(moved)

    def second_round(group: pa.Table) -> pa.Table:
        rows = sorted(zip(group.column("__bin").to_pylist(), group.column("__used").to_pylist()), key=lambda r: (-r[1], r[0]))
        bins = Bins(capacity, len(rows) + 1)
        to = [bins.add(used, name) for name, used in rows]
        values = [[b for b, _ in rows], [t for t, _ in to], [o for _, o in to]]
        return pa.Table.from_arrays([pa.array(v, pa.int64()) for v in values], schema=moved_schema)

    placed = stored(kept.mapInArrow(first_round, returns), "packing")
    left = placed.filter("__open_used IS NOT NULL").select(
        F.col("sequence_id").alias("__bin"), F.col("__open_used").alias("__used"),
        F.floor(F.shiftright("sequence_id", 40) / TASKS_JOINED).alias("__tasks"),
    )
    moves = left.groupBy("__tasks").applyInArrow(second_round, moved)
    rows = placed.filter("__open_used IS NULL").drop("__open_used")
    return rows.join(moves, F.col("sequence_id") == F.col("__bin"), "left").select(
        *[F.col(f"`{c}`") for c in kept.columns],
        F.coalesce("__to", "sequence_id").alias("sequence_id"),
        (F.col("offset") + F.coalesce("__base", F.lit(0))).alias("offset"),
    )
