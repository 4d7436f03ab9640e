"""Removal of passages that repeat an earlier one, window by window.

A window is a fixed number of consecutive words of one document.  The first
pass counts windows in a count-min sketch: tasks sketch their windows (sorted
column numbers, each at most twice), ranges of columns are merged, and columns
counted twice or more are folded into bit rows of bounded size, which every
task of the second pass holds.  A count is never too small, so no repeated
window is missed; with more data than the rows can tell apart, more windows
pass the filter and the rest of the work is the same.  The second pass groups
the windows that pass by the 128-bit XXH3 hash of their words, joined by single
spaces; the polynomial hashes of the first pass only choose columns, so words
made to collide there let more windows through and remove nothing.  Every task
combines its own windows first, so a passage that very many documents share
reaches a group once per task.

Order is by document id, then start.  Rows equal in id and text are one
document and get equal results; different texts under one id are ordered by a
hash of the text.  Null ids come last.  Null texts have no words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paralex.llm import bytewords as W
from paralex.llm.common import bounded_batches, give_back, schema_of, stored, text_function

RANGE_BYTES = 8 << 20  # text per range of columns
LEAST_RANGES = 64
RANGE_COLUMNS = 28  # bits: columns of the sketch per range
HELD = 1 << 19  # windows a task sketches at once
KEPT = 1 << 17  # windows a task combines at once in the second pass
MOST_ROW_BITS = 27  # bits: size of each of the two bit rows
SEED = 11
LAST = np.iinfo(np.int64).max


def _planes(values: np.ndarray) -> bytes:
    """Bytes of equal weight next to each other, so sorted values compress."""
    return values.view(np.uint8).reshape(len(values), values.itemsize).T.tobytes()


def _values(data: bytes, kind) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.frombuffer(data, np.uint8).reshape(width, -1).T.copy().view(kind).ravel()


def _runs(batches, size: int):
    """Windows of all batches, slice by slice: the batch, hashes, its row and the
    start; and the bytes and starts of texts."""
    for batch in batches:
        texts = batch.column("text")
        for first, data, ends in W.slices(texts):
            words, counts = W.word_hashes(data, ends)
            (hashes,), text, start = W.windows(words, counts, size, (SEED,))
            yield batch, hashes, first, text, start, data, ends


def _exact(data: np.ndarray, ends: np.ndarray, text: np.ndarray, start: np.ndarray, size: int) -> np.ndarray:
    """128 bits, as two numbers, of the words of each window."""
    opens, closes = W.spans(data, ends)
    texts = (b" ".join(data[a:b].tobytes().split()) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist()))
    joined = b" ".join(t for t in texts if t)
    last = np.cumsum(closes - opens + 1) - 1  # where each word ends in the joined bytes
    word = np.searchsorted(opens, ends)[text] + start
    left, right = (last - (closes - opens))[word], last[word + size - 1]
    digest = xxhash.xxh3_128_digest
    found = b"".join([digest(joined[a:b]) for a, b in zip(left.tolist(), right.tolist())])
    return np.frombuffer(found, "<u8").reshape(-1, 2)


SKETCH = T.StructType([T.StructField("range", T.IntegerType()), T.StructField("columns", T.BinaryType())])


def _sketches(texts: DataFrame, size: int, range_bits: int) -> DataFrame:
    schema = schema_of(SKETCH)
    shift = np.uint64(64 - range_bits - RANGE_COLUMNS)

    def flush(held: list[np.ndarray]) -> pa.RecordBatch:
        column = np.sort(np.concatenate(held) >> shift)
        keep = np.ones(len(column), bool)
        keep[2:] = column[2:] != column[:-2]  # counts beyond two tell nothing
        column = column[keep]
        filled, cuts = np.unique((column >> np.uint64(RANGE_COLUMNS)).astype(np.int64), return_index=True)
        low = (column & np.uint64((1 << RANGE_COLUMNS) - 1)).astype(np.uint32)
        blobs = [_planes(part) for part in np.split(low, cuts[1:])]
        return pa.RecordBatch.from_arrays([pa.array(filled, pa.int32()), pa.array(blobs, pa.binary())], schema=schema)

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0
        for _, hashes, *_ in _runs(batches, size):
            held.append(hashes)
            count += len(hashes)
            if count >= HELD:
                yield flush(held)
                held, count = [], 0
        if count:
            yield flush(held)
        del held
        give_back()

    return texts.select("text").mapInArrow(sketch, SKETCH)


MERGED = T.StructType([*SKETCH.fields, T.StructField("n", T.LongType())])


def _merge(group: pa.Table) -> pa.Table:
    columns = np.sort(np.concatenate([_values(b.as_py(), np.uint32) for b in group.column("columns")]))
    twice = np.unique(columns[1:][columns[1:] == columns[:-1]])
    values = [[group.column("range")[0].as_py()], [_planes(twice)], [len(twice)]]
    return pa.Table.from_pydict(dict(zip(MERGED.names, values)), schema=schema_of(MERGED))


def _bits(columns: np.ndarray, seed: int, bits: int) -> np.ndarray:
    return (W.mix(columns.astype(np.uint64), seed) & np.uint64((1 << bits) - 1)).astype(np.int64)


class Filter:
    """Two bit rows, cut into one part per range; tells which windows may repeat."""

    def __init__(self, rows: np.ndarray, range_bits: int, part_bits: int):
        self.rows, self.range_bits, self.part_bits = rows, range_bits, part_bits

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        column = hashes >> np.uint64(64 - self.range_bits - RANGE_COLUMNS)
        base = (column >> np.uint64(RANGE_COLUMNS)).astype(np.int64) << self.part_bits
        low = column & np.uint64((1 << RANGE_COLUMNS) - 1)
        out = np.ones(len(hashes), bool)
        for row, seed in zip(self.rows, (1, 2)):
            at = base + _bits(low, seed, self.part_bits)
            out &= (row[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
        return out


def _filter(texts: DataFrame, size: int, range_bits: int, most_row_bits: int) -> Filter:
    merged = stored(_sketches(texts, size, range_bits).groupBy("range").applyInArrow(_merge, MERGED), "sketch")
    repeated = merged.agg(F.sum("n")).first()[0] or 0
    row_bits = min(most_row_bits, max(range_bits + 8, int(repeated * 32).bit_length()))
    part_bits = row_bits - range_bits
    kind = T.StructType([T.StructField("range", T.IntegerType()), *[T.StructField(c, T.BinaryType()) for c in "ab"]])

    def fold(batches):
        for batch in batches:
            for r, data in zip(batch.column("range").to_pylist(), batch.column("columns")):
                low, parts = _values(data.as_py(), np.uint32), []
                for seed in (1, 2):
                    part = np.zeros(1 << part_bits, bool)
                    part[_bits(low, seed, part_bits)] = True
                    parts.append(np.packbits(part, bitorder="little").tobytes())
                yield pa.RecordBatch.from_arrays([pa.array([r], pa.int32()), *[pa.array([p], pa.binary()) for p in parts]], schema=schema_of(kind))

    rows = np.zeros((2, 1 << (row_bits - 3)), np.uint8)
    part = 1 << (part_bits - 3)
    for r, a, b in merged.select("range", "columns").mapInArrow(fold, kind).toLocalIterator():
        for row, bits in zip(rows, (a, b)):
            row[r * part : (r + 1) * part] = np.frombuffer(bits, np.uint8)
    return Filter(rows, range_bits, part_bits)


FOUND = T.StructType([
    T.StructField("range", T.IntegerType()), T.StructField("doc", T.LongType()), T.StructField("same", T.LongType()),
    T.StructField("starts", T.BinaryType()), T.StructField("met", T.BinaryType()),
])
_DOC = np.dtype([("doc", "<i8"), ("same", "<i8")])


def _later(a, b, doc, same, start) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of the earliest of equal windows, and of those that repeat another."""
    order = np.lexsort((start, same, doc, b, a))
    fresh = np.ones(len(order), bool)
    sa, sb = a[order], b[order]
    fresh[1:] = (sa[1:] != sa[:-1]) | (sb[1:] != sb[:-1])
    head = order[np.flatnonzero(fresh)][np.cumsum(fresh) - 1]
    itself = (doc[head] == doc[order]) & (same[head] == same[order]) & (start[head] == start[order])
    return order[fresh], order[~itself]


def _by_document(doc, same, start) -> Iterator[tuple[int, int, bytes]]:
    order = np.lexsort((start, same, doc))
    doc, same, start = doc[order], same[order], start[order]
    cuts = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (same[1:] != same[:-1])])) if len(doc) else []
    for left, right in zip(cuts, [*cuts[1:], len(doc)]):
        yield int(doc[left]), int(same[left]), np.unique(start[left:right]).astype(np.uint32).tobytes()


def _found(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[] for _ in FOUND.fields]
    schema = schema_of(FOUND)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _pack(a, b, doc, same, start) -> bytes:
    docs = np.empty(len(doc), _DOC)
    docs["doc"], docs["same"] = doc, same
    named, at = np.unique(docs, return_inverse=True)
    head = np.array([len(named), len(a)], np.uint64).tobytes()
    parts = [named["doc"], named["same"], at.astype(np.uint32), start.astype(np.uint32), b, a]
    return head + b"".join(_planes(np.ascontiguousarray(p)) for p in parts)


def _unpack(data: bytes):
    docs, n = np.frombuffer(data[:16], np.uint64).tolist()
    at, out = 16, []
    for kind, count in (("<i8", docs), ("<i8", docs), ("<u4", n), ("<u4", n), ("<u8", n), ("<u8", n)):
        width = np.dtype(kind).itemsize * count
        out.append(_values(data[at : at + width], kind))
        at += width
    doc, same, i, start, b, a = out
    return a, b, doc[i], same[i], start


def _suspects(texts: DataFrame, size: int, passes: Filter) -> DataFrame:
    """Rows with ``starts`` of windows known to repeat, and rows per range with
    the earliest windows of a task (``met``)."""
    shared = texts.sparkSession.sparkContext.broadcast(passes)
    shift = np.uint64(64 - passes.range_bits)

    def flush(held) -> pa.RecordBatch:
        a, b, doc, same, start = (np.concatenate(x) for x in zip(*held))
        first, later = _later(a, b, doc, same, start)
        first = np.sort(first)
        spread = (1 << passes.range_bits) - 1  # known starts go to any group, copies of one text to many
        rows = [((d + s) & spread, d, s, w, None) for d, s, w in _by_document(doc[later], same[later], start[later])]
        a, b, doc, same, start = (x[first] for x in (a, b, doc, same, start))
        group = (a >> shift).astype(np.int64) if passes.range_bits else np.zeros(len(a), np.int64)
        order = np.argsort(group, kind="stable")
        present, cuts = np.unique(group[order], return_index=True)
        for r, pick in zip(present, np.split(order, cuts[1:])):
            rows.append((int(r), None, None, None, _pack(a[pick], b[pick], doc[pick], same[pick], start[pick])))
        return _found(rows)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        passes, held, count, ids = shared.value, [], 0, (None, None, None)
        for batch, hashes, first, text, start, data, ends in _runs(batches, size):
            if ids[0] is not batch:
                doc = batch.column("doc").fill_null(LAST).to_numpy(zero_copy_only=False)
                ids = batch, doc, batch.column("same").to_numpy(zero_copy_only=False)
            maybe = np.flatnonzero(passes(hashes))
            if not len(maybe):
                continue
            row = first + text[maybe]
            a, b = _exact(data, ends, text[maybe], start[maybe], size).T
            held.append((a, b, ids[1][row], ids[2][row], start[maybe]))
            count += len(maybe)
            if count >= KEPT:
                yield flush(held)
                held, count = [], 0
        if count:
            yield flush(held)
        del held
        give_back()

    return texts.mapInArrow(find, FOUND)


def _settle(group: pa.Table) -> pa.Table:
    """Exact grouping of the windows of one range; known starts pass through."""
    known = group.filter(group.column("starts").is_valid()).cast(schema_of(FOUND))
    met = [_unpack(m.as_py()) for m in group.column("met").drop_null()]
    give_back()  # of the group before
    if not met:
        return known
    a, b, doc, same, start = (np.concatenate(x) for x in zip(*met))
    later = _later(a, b, doc, same, start)[1]
    rows = [(0, d, s, w, None) for d, s, w in _by_document(doc[later], same[later], start[later])]
    return pa.concat_tables([known, pa.Table.from_batches([_found(rows)])])


def _cut(size: int):
    """A column function of text and lists of packed starts: word counts and what is left."""

    def make():
        def row(text, found):
            words = text.encode().split() if text else []
            if not found:
                return {"n_words": len(words), "n_removed": 0, "kept": b" ".join(words).decode()}
            starts = np.concatenate([np.frombuffer(x, np.uint32) for x in found]).astype(np.int64)
            edge = np.zeros(len(words) + 1, np.int64)
            np.add.at(edge, starts, 1)
            np.add.at(edge, starts + size, -1)
            covered = np.cumsum(edge)[:-1] > 0
            kept = [w for w, c in zip(words, covered.tolist()) if not c]
            return {"n_words": len(words), "n_removed": int(covered.sum()), "kept": b" ".join(kept).decode()}

        return row

    kind = T.StructType([
        T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("kept", T.StringType()),
    ])
    return text_function(make, kind)


def remove_repeats(docs: DataFrame, size: int, out: str = "repeats", most_row_bits: int = MOST_ROW_BITS) -> DataFrame:
    """``docs`` with the struct ``out``: ``n_words``, ``n_removed`` and ``kept``,
    the words left, joined by single spaces.  A column named ``out`` is replaced.
    """
    docs = docs.drop(out)
    bounded_batches(docs.sparkSession)
    same = F.xxhash64("text")
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc"), same.alias("same"), "text")
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges = max(LEAST_RANGES, total // RANGE_BYTES)
    range_bits = min(24, (ranges - 1).bit_length())
    passes = _filter(texts, size, range_bits, max(most_row_bits, range_bits + 3))
    found = _suspects(texts, size, passes).groupBy("range").applyInArrow(_settle, FOUND)
    found = stored(found.select("doc", "same", "starts"), "repeats")
    starts = found.groupBy("doc", "same").agg(F.collect_list("starts").alias("__starts"))
    key: Column = F.coalesce(F.col("doc_id").cast("bigint"), F.lit(LAST))
    keyed = docs.withColumns({"__doc": key, "__same": same})
    named = starts.select(F.col("doc").alias("__doc"), F.col("same").alias("__same"), "__starts")
    joined = keyed.join(named, ["__doc", "__same"], "left")
    cut = joined.withColumn(out, _cut(size)(F.col("text"), F.col("__starts")))
    return cut.select(*[F.col(f"`{c}`") for c in docs.columns], out)
