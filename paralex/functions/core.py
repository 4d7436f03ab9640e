"""Column helpers shared by all operators; everything stays JVM-side."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paralex.fixed_values import SPACE_CHARS


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and hand it to ``body``.

    A plain reference inside a higher-order function would be evaluated again
    for every array element; a lambda variable is not.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def with_kept(df: DataFrame, name: str, value: Column, keep: Callable[[Column], Column]) -> DataFrame:
    """Add ``value`` as column ``name`` and keep the rows where it passes.

    A filter on a computed column would be pushed below its projection and
    compute it twice; exploding a one-element array computes it once.
    """
    others = [c for c in df.columns if c != name]
    return df.select(*others, F.explode(F.filter(F.array(value), keep)).alias(name))


def strip(c: str | Column) -> Column:
    """Trim Unicode white space on both ends (``trim`` drops spaces only)."""
    return F.btrim(col(c), F.lit(SPACE_CHARS))


def blank_to_null(c: str | Column) -> Column:
    return F.nullif(col(c), F.lit(""))


def alternation(literals: Iterable[str]) -> str:
    """One regex alternative per literal, longest first, so that a label wins
    over its own prefixes."""
    return "|".join(re.escape(s) for s in sorted(literals, key=len, reverse=True))


def any_of(literals: Iterable[str]) -> str:
    """:func:`alternation` for searching inside long text: the alternatives are
    only tried where one of their first characters stands."""
    literals = list(literals)
    firsts = "".join(re.escape(ch) for ch in sorted({s[0] for s in literals}))
    return f"(?=[{firsts}])(?:{alternation(literals)})"


def text_lines(c: str | Column) -> Column:
    """Split at any line break."""
    return F.split(col(c), r"\R")


def int_div(a: str | Column, n: int | Column) -> Column:
    """Whole-number division (``/`` would go through doubles)."""
    return F.call_function("div", col(a), F.lit(n) if isinstance(n, int) else n)


def epoch_to_local(c: str | Column, zone: str, fmt: str) -> Column:
    """Epoch seconds as local wall-clock text, whatever the session zone is."""
    return F.date_format(
        F.convert_timezone(
            F.lit("UTC"), F.lit(zone),
            F.timestamp_add("SECOND", col(c), F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")),
        ),
        fmt,
    )


def local_to_epoch(c: str | Column, zone: str, fmt: str) -> Column:
    """Local wall-clock text back to epoch seconds; null when it is no time."""
    local = F.try_to_timestamp(F.concat(col(c), F.lit(" UTC")), F.lit(fmt + " z"))
    utc = F.to_utc_timestamp(local, zone)
    return F.unix_seconds(utc)
