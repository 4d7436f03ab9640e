"""Applying a caller's batch function to rows, with bounded retries.

This is the only place that needs Python workers: the function is the caller's
client or model.  Rows travel in Arrow batches.
"""

from __future__ import annotations

import heapq
import itertools
import time
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import FIRST_COMPLETED, Future, ThreadPoolExecutor, wait

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from paralex import fixed_values as V

Answer = pd.DataFrame | tuple[Sequence[int], dict[str, Sequence]]
BatchFunction = Callable[[pd.DataFrame | dict[str, list], int], Answer]
MOST_WAITING = 50_000  # rows of a task that may wait for their next attempt while others are asked
PACE = 1.4  # how calls grow and shrink: about one in two fails where few calls are needed


def on_columns(fn: BatchFunction) -> BatchFunction:
    """Marks a function that takes its rows as a dict of columns, each a list.
    To cut lists costs little even for a single row, to cut a frame does not."""
    fn.on_columns = True
    return fn


def enrich(
    df: DataFrame,
    fn: BatchFunction,
    out_schema: T.StructType,
    max_attempts: int = 3,
    first_delay: float = V.FIRST_BACKOFF_SECONDS,
    rows_per_call: int | None = None,
    in_flight: int = 1,
) -> DataFrame:
    """Rows with the columns of ``out_schema``, ``outcome`` and ``attempts``.

    ``fn(batch, attempt)`` returns a frame with the columns of ``out_schema``
    for the rows it could answer, under their index in ``batch``; the others
    are tried again after a delay that doubles, while other rows are asked.  In
    place of a frame, which is dear for a few rows, it may return a pair: the
    places in ``batch`` of these rows, from 0, and a dict of their columns.  A
    function marked by :func:`on_columns` takes lists in place of a frame.  A
    row answered with ``blocked=True`` is not tried again.  After
    ``max_attempts`` a row comes out as ``failed`` with its input intact, so
    nothing is lost; outcomes are ``ok``, ``blocked`` and ``failed``.

    When ``fn`` raises, or returns anything else, none of its rows is answered;
    their first half is asked, and so on down to single rows.  Once a first half
    is answered the second is halved without being asked whole; once it fails
    the second joins the rows after it.  Calls get smaller
    as calls fail and larger as they succeed.  A row that failed alone is asked
    alone in its later attempts.  ``rows_per_call`` bounds the rows of a call:
    with 1 no row is asked twice in an attempt.  Up to ``in_flight`` calls of a
    task run at the same time, in threads.

    A lost executor repeats its partitions, so ``fn`` should be idempotent;
    write the result before using it twice.
    """
    fields = [f.name for f in out_schema.fields]
    schema = T.StructType(
        [
            *df.schema.fields,
            *out_schema.fields,
            T.StructField("outcome", T.StringType()),
            T.StructField("attempts", T.IntegerType()),
        ]
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        with _Asking(fn, fields, rows_per_call, in_flight) as asking:
            due: list[tuple] = []  # (time, number, rows, attempt, whether they are asked alone)
            number, waiting = itertools.count(), 0
            incoming: Iterator[pd.DataFrame | None] = itertools.chain(batches, itertools.repeat(None))
            while True:
                if due and (waiting > MOST_WAITING or due[0][0] <= time.monotonic()):
                    batch = None
                else:
                    batch = next(incoming)
                if batch is not None:
                    rows, attempt, alone = batch.reset_index(drop=True), 1, False
                elif due:
                    at, _, rows, attempt, alone = heapq.heappop(due)
                    waiting -= len(rows)
                    time.sleep(max(0.0, at - time.monotonic()))
                else:
                    return
                done, failed_alone = asking.attempt(rows, attempt, alone)
                settled = done if attempt < max_attempts else np.ones(len(rows), bool)
                if settled.any():
                    yield asking.result(rows, settled, attempt)
                later = time.monotonic() + first_delay * 2 ** (attempt - 1)
                for rest, singly in ((~settled & ~failed_alone, False), (~settled & failed_alone, True)):
                    if rest.any():
                        heapq.heappush(due, (later, next(number), rows[rest], attempt + 1, singly))
                        waiting += int(rest.sum())

    return df.mapInPandas(run, schema)


class _Asking:
    """Calls of a caller's function, and their answers to the rows at hand."""

    def __init__(self, fn: BatchFunction, fields: list[str], rows_per_call: int | None, in_flight: int):
        self.fn, self.fields, self.most, self.in_flight = fn, fields, rows_per_call or MOST_WAITING, in_flight
        self.on_columns = getattr(fn, "on_columns", False)
        self.size = float(self.most)
        self.pool = ThreadPoolExecutor(in_flight) if in_flight > 1 else None

    def __enter__(self) -> _Asking:
        return self

    def __exit__(self, *_) -> None:
        if self.pool:
            self.pool.shutdown(wait=True, cancel_futures=True)

    def attempt(self, rows: pd.DataFrame, attempt: int, alone: bool) -> tuple[np.ndarray, np.ndarray]:
        """Ask for all rows; which are answered, and which failed alone."""
        self.values = {name: np.full(len(rows), None, object) for name in self.fields}
        self.blocked = np.zeros(len(rows), bool)
        self.done = np.zeros(len(rows), bool)
        self.failed_alone = np.zeros(len(rows), bool)
        lists = {name: rows[name].tolist() for name in rows.columns} if self.on_columns else None
        # Ranges of rows, the next one last, and whether a call for the whole range has failed.
        self.waiting = [(0, len(rows), False)]
        running: dict[Future, tuple[int, int, int]] = {}
        while self.waiting or running:
            while self.waiting and len(running) < self.in_flight:
                first, end, _ = asked = self._next(1 if alone else max(1, round(self.size)))
                if lists is not None:
                    part = {name: values[first:end] for name, values in lists.items()}
                else:
                    part = rows if end - first == len(rows) else rows.iloc[first:end].copy()
                if self.pool:
                    running[self.pool.submit(self._call, part, end - first, attempt)] = asked
                else:
                    self._settle(asked, self._call(part, end - first, attempt))
            if running:
                for call in wait(running, return_when=FIRST_COMPLETED).done:
                    self._settle(running.pop(call), call.result())
        return self.done, self.failed_alone

    def _next(self, most: int) -> tuple[int, int, int]:
        """The rows to ask, as their first and end, and the end of the failed
        range whose first half they are (their own end if of none)."""
        first, end, failed = self.waiting.pop()
        if failed and end - first > 1:
            return first, (first + end) // 2, end
        while not failed and end - first < most and self.waiting and self.waiting[-1][::2] == (end, False):
            end = self.waiting.pop()[1]
        if end - first > most:
            self.waiting.append((first + most, end, False))
            end = first + most
        return first, end, end

    def _call(self, part: pd.DataFrame | dict[str, list], n: int, attempt: int) -> tuple[np.ndarray | list | None, list[tuple]] | None:
        """The places in ``part`` of ``n`` rows (nothing: all, in order) of the rows answered,
        and what goes into which array; nothing if the answer is not well formed."""
        try:
            answer = self.fn(part, attempt)
            if isinstance(answer, tuple):
                places, columns = list(answer[0]), answer[1]
                listed = places
            else:
                columns, places, listed = answer, None, []
                index = pd.RangeIndex(n) if self.on_columns else part.index
                if not index.equals(answer.index):
                    places = index.get_indexer(answer.index)
                    listed = places.tolist()
            if listed and (min(listed) < 0 or max(listed) >= n or len(set(listed)) < len(listed)):
                raise ValueError("answers for rows that were not asked, or asked once")
            missing = [name for name in self.fields if name not in columns]
            if missing:
                raise ValueError(f"answers without {missing}")
            found = [(self.values[name], columns[name]) for name in self.fields]
            if "blocked" in columns:
                found.append((self.blocked, columns["blocked"]))
            if not isinstance(answer, tuple):
                found = [(into, column.to_numpy(into.dtype)) for into, column in found]
            elif any(len(column) != len(places) for _, column in found):
                raise ValueError("columns of other lengths than the places")
        except Exception:  # the function is the caller's: whatever it raises, its rows are not answered
            return None
        return places, found

    def _settle(self, asked: tuple[int, int, int], reply) -> None:
        first, end, failed_end = asked
        if failed_end > end:  # the first half of a failed range: if it is well, the fault lies in the second
            self.waiting.append((end, failed_end, reply is not None))
        if reply is None:
            if end - first == 1:
                self.failed_alone[first] = True
                return
            self.waiting.append((first, end, True))
            if failed_end == end:
                self.size = max(1.0, min(self.size, end - first) / PACE)
            return
        places, found = reply
        if failed_end == end and end - first >= round(self.size):
            self.size = min(PACE * self.size, self.most)
        if isinstance(places, list):
            for into, column in found:
                for place, value in zip(places, column, strict=True):
                    into[first + place] = value
            for place in places:
                self.done[first + place] = True
        else:
            at = slice(first, end) if places is None else places + first
            for into, values in found:
                into[at] = values
            self.done[at] = True

    def result(self, rows: pd.DataFrame, settled: np.ndarray, attempt: int) -> pd.DataFrame:
        """Settled rows with their answers, from the attempt just made."""
        outcome = np.where(~self.done, "failed", np.where(self.blocked, "blocked", "ok"))
        added = {name: self.values[name][settled] for name in self.fields}
        out = rows[settled]
        return out.assign(**added, outcome=outcome[settled].astype(object), attempts=attempt)


def answered(df: DataFrame) -> DataFrame:
    """Rows with an answer."""
    return df.filter("outcome = 'ok'")


def dead_letters(df: DataFrame) -> DataFrame:
    """Rows to try again later."""
    return df.filter("outcome = 'failed'")
