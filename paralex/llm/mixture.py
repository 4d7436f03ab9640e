"""Packing of token queues, one for each source, into windows of a fixed mixture.

Deficit round-robin over the sources: in every window each source earns its
target share of tokens and is served what it is owed in whole tokens; what is
left over, or too little for a run of its own, is carried to the next windows.
Room that nobody is owed is lent, in proportion to the shares, and paid back.

The windows are filled in ranges of ``RANGE`` tokens, each by one task.  How far
a source's queue has been served when a range begins follows from its share
alone, so a range starts, without waiting for those before it, where they leave
off, and with the fractions of tokens they still owe.  A range is a group of
bounded size whatever the share of the largest source.  Its last tokens, too few
for a window, go into sequences whose lengths are powers of two: nothing is
padded.

Null sources are a source of their own.  Null texts are empty; an empty text is
the end token alone.  Equal rows, and rows with a null id, are documents like
any other.  An empty table gives an empty result.  Only the named columns are
read; others may have any names.
"""

from __future__ import annotations

import math
from array import array
from collections.abc import Mapping

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paralex.llm.common import SLICE, batches_of, bounded_batches, schema_of, stored
from paralex.llm.packing import tokenizer
from paralex.operators.sharding import join_null_safe

RANGE = 1 << 21  # tokens whose windows are filled by one task
LEAST_RUN = 32  # a source that is owed fewer tokens waits for a later window


def token_queues(docs: DataFrame, path: str, end_id: int) -> DataFrame:
    """One row per document: ``doc_id``, ``source``, ``ids`` with the end id,
    ``length``, and its place in the queue of its source: ``part`` and
    ``before``, the source's tokens earlier in that part.

    ``ids`` are packed little-endian unsigned integers of 16 bits where the
    vocabulary allows it, else of 32.  The rows are written once.
    """
    returns = T.StructType([
        T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("source", docs.schema["source"].dataType),
        T.StructField("part", T.IntegerType()), T.StructField("before", T.LongType()), T.StructField("length", T.LongType()),
        T.StructField("ids", T.BinaryType()),
    ])
    schema = schema_of(returns)
    short = max(end_id, tokenizer(path).library.get_vocab_size() - 1) < 1 << 16
    bounded_batches(docs.sparkSession)

    def make():
        tokens, end = tokenizer(path), array("I", [end_id]).tobytes()
        part, served = TaskContext.get().partitionId(), {}

        def work(batch):
            for at in range(0, batch.num_rows, SLICE):
                rows = batch.slice(at, SLICE)
                before, length, ids = [], [], []
                for source, text in zip(rows.column(1).to_pylist(), rows.column(2)):
                    data = tokens.packed(text.as_py()) + end
                    before.append(served.get(source, 0))
                    length.append(len(data) // 4)
                    served[source] = before[-1] + length[-1]
                    ids.append(np.frombuffer(data, "<u4").astype("<u2").tobytes() if short else data)
                columns = [rows.column(0), rows.column(1), pa.array([part] * len(ids)), *map(pa.array, (before, length, ids))]
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, schema)], schema=schema)

        return work

    return stored(docs.select("doc_id", "source", "text").mapInArrow(batches_of(make), returns), "queues")


def _share(a: Column, b: Column, c: Column) -> Column:
    """``a * b / c`` rounded down, whatever the size of the product."""
    wide = "decimal(19,0)"
    return F.call_function("div", a.cast(wide) * b.cast(wide), c.cast(wide))


def _segments(totals: dict, targets: Mapping, rest: int, tokens: int) -> tuple[dict, tuple[int, int]]:
    """Stretches of the queues that are mixed together.

    For every named source, as ``(low, high, first range, ranges)``, its tokens
    served until the next queue runs out; and the first range and the ranges of
    the ``rest`` tokens of sources without a target, which come last.
    """
    shares = {s: float(w) for s, w in targets.items() if w > 0 and totals.get(s)}
    time, served, first = 0.0, dict.fromkeys(shares, 0), 0
    out: dict = {s: [] for s in shares}
    open_queues = sorted(shares, key=lambda s: totals[s] / shares[s])
    while open_queues:
        time = totals[open_queues[0]] / shares[open_queues[0]]
        to = {s: min(totals[s], math.floor(time * shares[s])) for s in open_queues}
        to[open_queues[0]] = totals[open_queues[0]]
        ranges = max(1, -(-sum(to[s] - served[s] for s in open_queues) // tokens))
        for s in open_queues:
            if to[s] > served[s]:
                out[s].append((served[s], to[s], first, ranges))
        served.update(to)
        first += ranges
        open_queues = [s for s in open_queues if served[s] < totals[s]]
    return out, (first, max(1, -(-rest // tokens)))


def _cut_at_ranges(queues: DataFrame, targets: Mapping | None, tokens: int) -> DataFrame:
    """Stretches of documents, each within one range: the document's columns,
    ``range``, ``at`` (place in the queue), ``start`` (in the document),
    ``length``, and the source's share: its tokens in such a range (``due``) and
    the fraction of a token that it is ``owed`` when the range begins."""
    spark = queues.sparkSession
    per_part = queues.groupBy("source", "part").agg(F.sum("length").alias("n"))
    source = Window.partitionBy("source")
    earlier = source.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = stored(
        per_part.select(
            "source", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"), F.sum("n").over(source).alias("all")
        ),
        "queue-parts",
    )
    # Sources named by the caller only, however many there are in the table.
    named = list(targets or ())
    totals = {}
    if named:
        asked = spark.createDataFrame([(s,) for s in named], T.StructType([T.StructField("source", queues.schema["source"].dataType)]))
        totals = {r[0]: r[1] for r in join_null_safe(bases, asked, ["source"]).groupBy("source").agg(F.max("all")).collect()}
    total = queues.agg(F.sum("length")).first()[0] or 0
    shares = {s: w for s, w in (targets or {}).items() if w > 0 and totals.get(s)}
    segments, (first, ranges) = _segments(totals, shares, total - sum(totals[s] for s in shares), tokens)
    struct = lambda low, high, a, n: F.struct(
        low.cast("bigint").alias("low"), high.cast("bigint").alias("high"),
        F.lit(a).cast("bigint").alias("first"), F.lit(n).cast("bigint").alias("ranges"),
    )
    stretches = F.array(struct(F.lit(0), F.col("all"), first, ranges))
    for s, found in segments.items():
        mine = F.array(*[struct(F.lit(a), F.lit(b), f, n) for a, b, f, n in found])
        stretches = F.when(F.col("source").eqNullSafe(F.lit(s)), mine).otherwise(stretches)

    docs = join_null_safe(queues, bases.withColumn("stretch", stretches).drop("all"), ["source", "part"])
    docs = docs.withColumn("place", F.col("base") + F.col("before")).withColumn("stretch", F.explode("stretch"))
    low, high, n = F.col("stretch.low"), F.col("stretch.high"), F.col("stretch.ranges")
    docs = docs.withColumns({"a": F.greatest("place", low), "b": F.least(F.col("place") + F.col("length"), high)}).filter("a < b")
    size = high - low
    nth = lambda x: F.call_function(  # noqa: E731  (the last range that begins at or before a place)
        "div", (x - low + 1).cast("decimal(19,0)") * n.cast("decimal(19,0)") - 1, size.cast("decimal(19,0)")
    )
    docs = docs.withColumn("nth", F.explode(F.sequence(nth(F.col("a")), nth(F.col("b") - 1))))
    begins = low + _share(F.col("nth"), size, n)
    ends = low + _share(F.col("nth") + 1, size, n)
    owed = (F.col("nth").cast("decimal(19,0)") * size.cast("decimal(19,0)") % n).cast("double") / n
    docs = docs.withColumns({"at": F.greatest("a", begins), "end": F.least("b", ends)}).filter("at < end")
    start, length = F.col("at") - F.col("place"), F.col("end") - F.col("at")
    width = F.call_function("div", F.octet_length("ids"), F.col("length")).cast("int")
    return docs.select(
        (F.col("stretch.first") + F.col("nth")).alias("range"), "source", "doc_id", F.col("length").alias("doc_tokens"), "at",
        start.alias("start"), length.alias("length"), (size / n).alias("due"), owed.alias("owed"),
        F.substring("ids", (start * width + 1).cast("int"), (length * width).cast("int")).alias("ids"),
    )


def window_sizes(tokens: int, window: int) -> list[int]:
    """Full windows, then powers of two for the tokens that do not fill one."""
    rest = tokens % window
    return [window] * (tokens // window) + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def deficit_rounds(left: np.ndarray, due: np.ndarray, owed: np.ndarray, windows: list[int], least: int):
    """Yield for every window the tokens that each queue gives to it.

    ``left`` are the queues' lengths, which add up to the windows' sizes, ``due``
    their shares and ``owed`` the deficits to start with.
    """
    left, share = left.astype(np.int64), due / due.sum()
    # Queues of small shares reach a run in different windows, not all in the same.
    deficit = owed + np.where(share * windows[0] < least, np.arange(len(left)) * 0.618034 % 1 * np.minimum(least, left), 0.0)
    for room in windows:
        deficit += share * room
        give = np.where(deficit >= np.minimum(least, left), np.floor(deficit), 0).clip(0, left).astype(np.int64)
        missing = room - int(give.sum())
        if missing < 0:  # the least owed wait
            order = np.argsort(-deficit, kind="stable")
            give[order] = np.diff(np.minimum(np.cumsum(give[order]), room), prepend=0)
        elif missing:
            lends = (give > 0) & (left > give)
            if lends.any():
                extra = np.floor(missing * share[lends] / share[lends].sum()).astype(np.int64)
                give[lends] += np.minimum(extra, (left - give)[lends])
                missing = room - int(give.sum())
            # The rest goes to those that lend anyway, then to those with most left.
            order = np.lexsort((-(left - give), ~lends))
            spare = (left - give)[order]
            give[order] += np.diff(np.minimum(np.cumsum(spare), missing), prepend=0)
        left -= give
        deficit -= give
        yield give


PLACED = [("start", T.LongType()), ("length", T.LongType()), ("doc_tokens", T.LongType()), ("sequence_id", T.LongType()),
          ("offset", T.LongType()), ("ids", T.BinaryType())]


def mix(queues: DataFrame, window: int, targets: Mapping | None = None, least_run: int = LEAST_RUN, tokens: int = RANGE) -> DataFrame:
    """Pieces of all documents of ``token_queues``, placed in sequences of at
    most ``window`` tokens: ``doc_id``, ``source``, ``start``, ``length``,
    ``doc_tokens``, ``sequence_id``, ``offset`` and ``ids`` (32 bits each).

    Without ``targets`` every window gets the mixture of the whole corpus, and
    all queues end together.  ``targets`` maps sources to weights; where one of
    these queues has run out the others go on in their proportions.  Sources
    that are not named, or have no weight, come after them, in the proportions
    of their tokens.  ``tokens`` sets the work of a task.
    """
    tokens = max(tokens // window, 1) * window
    kinds = [("doc_id", queues.schema["doc_id"].dataType), ("source", queues.schema["source"].dataType), *PLACED]
    returns = T.StructType([T.StructField(*k) for k in kinds])
    schema = schema_of(returns)

    def fill(group: pa.Table) -> pa.Table:
        group = group.sort_by([("source", "ascending"), ("at", "ascending")]).combine_chunks()
        numbers = {c: group.column(c).to_numpy() for c in ("range", "start", "length", "doc_tokens", "due", "owed")}
        ids = group.column("ids").combine_chunks()
        ids = pa.concat_arrays(ids.chunks) if isinstance(ids, pa.ChunkedArray) else ids
        ends = np.cumsum(numbers["length"])
        total, begins = int(ends[-1]), ends - numbers["length"]
        data = b"".join(ids.to_pylist())
        data = np.frombuffer(data, "<u2" if len(data) == 2 * total else "<u4").astype("<u4")
        coded = group.column("source").combine_chunks().dictionary_encode("encode")
        coded = pa.concat_arrays(coded.chunks) if isinstance(coded, pa.ChunkedArray) else coded
        queue = coded.indices.to_numpy(zero_copy_only=False)
        first = np.flatnonzero(np.diff(queue, prepend=-1))  # sorted: one run of rows for each queue
        sizes = np.add.reduceat(numbers["length"], first)

        lengths = window_sizes(total, window)
        which, who, given = [], [], []
        for w, give in enumerate(deficit_rounds(sizes, numbers["due"][first], numbers["owed"][first], lengths, least_run)):
            some = np.flatnonzero(give)
            which.append(np.full(len(some), w))
            who.append(some)
            given.append(give[some])
        which, who, given = map(np.concatenate, (which, who, given))
        offset = np.cumsum(given) - given - (np.cumsum(lengths) - lengths)[which]
        # All queues one after another are the tokens of the range; runs and documents cut them.
        by_queue = np.argsort(who, kind="stable")
        runs = np.cumsum(given[by_queue]) - given[by_queue]
        cuts = np.union1d(runs, begins)
        run = np.searchsorted(runs, cuts, "right") - 1
        doc = np.searchsorted(begins, cuts, "right") - 1
        picked = pa.array(doc)
        bounds = pa.py_buffer((np.append(cuts, total) * 4).astype(np.int32))
        columns = [
            group.column("doc_id").take(picked), group.column("source").take(picked),
            pa.array(numbers["start"][doc] + cuts - begins[doc]), pa.array(np.diff(cuts, append=total)),
            pa.array(numbers["doc_tokens"][doc]), pa.array((numbers["range"][0] << 32) + which[by_queue][run]),
            pa.array(offset[by_queue][run] + cuts - runs[run]),
            pa.BinaryArray.from_buffers(pa.binary(), len(cuts), [None, bounds, pa.py_buffer(data)]),
        ]
        return pa.Table.from_arrays([c.cast(f.type) for c, f in zip(columns, schema)], schema=schema)

    return _cut_at_ranges(queues, targets, tokens).groupBy("range").applyInArrow(fill, returns)
