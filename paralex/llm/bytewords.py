"""Words of whole Arrow slices as 64-bit hashes, without a loop over words.

A word is a run of bytes other than ASCII white space.  Its hash is a
polynomial over its bytes, taken from prefix sums modulo 2**64 and mixed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK = 1 << 17  # bytes or words worked on at once
_BASE, _WORD_BASE = 0x9E3779B97F4A7C55, 0xD6E8FEB86659FD93
_TABLE = np.random.default_rng(7).integers(0, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2**64."""
    have = _POWERS.get(base)
    if have is None or len(have[0]) < n:
        size = max(n, CHUNK + 64)
        up, down = np.full(size, base, np.uint64), np.full(size, pow(base, -1, 1 << 64), np.uint64)
        up[0] = down[0] = 1
        have = _POWERS[base] = np.cumprod(up), np.cumprod(down)
    return have[0][:n], have[1][:n]


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    x = x + np.uint64(seed)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a slice of texts, and where each text starts (one more at the end)."""
    wide = texts.cast(pa.string()).fill_null("").cast(pa.large_string())
    _, offsets, data = wide.buffers()
    ends = np.frombuffer(offsets, np.int64)[wide.offset : wide.offset + len(wide) + 1]
    data = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]] if data is not None else np.empty(0, np.uint8)
    return data, ends - ends[0]


def slices(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Rows in runs of at most ``CHUNK`` bytes, a longer text alone: the first
    row, the bytes and the starts."""
    if not len(texts):
        return
    data, ends = buffers(texts)
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(ends, ends[first] + CHUNK, "right")) - 1)
        yield first, data[ends[first] : ends[last]], ends[first : last + 1] - ends[first]
        first = last


def spans(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every word; words never reach over the start of a text."""
    word = ~_SPACE[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[ends] = True
    cut[0] = cut[-1] = True
    opens = word & np.concatenate([[True], ~word[:-1]]) if len(data) else word
    opens = opens | (word & cut[:-1])
    closes = np.concatenate([opens[1:] | ~word[1:], [True]]) & word if len(data) else word
    return np.flatnonzero(opens), np.flatnonzero(closes) + 1


def _hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    up, down = _powers(_BASE, len(data) + 1)
    sums = np.empty(len(data) + 1, np.uint64)
    sums[0] = 0
    np.cumsum(_TABLE[data] * up[:-1], out=sums[1:])
    return mix((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))


def word_hashes(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A hash per word, and the number of words of each text."""
    start, end = spans(data, ends)
    counts = np.diff(np.searchsorted(start, ends))
    if len(data) <= CHUNK:
        return _hashes(data, start, end), counts
    out = np.empty(len(start), np.uint64)
    at = 0
    while at < len(start):  # one long text: whole words, about a chunk at a time
        to = max(at + 1, int(np.searchsorted(end, start[at] + CHUNK, "right")))
        left = start[at]
        out[at:to] = _hashes(data[left : end[to - 1]], start[at:to] - left, end[at:to] - left)
        at = to
    return out, counts


def window_hashes(words: np.ndarray, size: int, seed: int) -> np.ndarray:
    """A hash for each run of ``size`` words (also those that cross texts)."""
    n = len(words) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.empty(n, np.uint64)
    for at in range(0, n, CHUNK):
        part = mix(words[at : at + CHUNK + size - 1], seed)
        up, down = _powers(_WORD_BASE, len(part))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(part * up)])
        m = len(part) - size + 1
        out[at : at + m] = mix((sums[size:] - sums[:m]) * down[:m])
    return out


def windows(words: np.ndarray, counts: np.ndarray, size: int, seeds: tuple[int, ...]):
    """Windows that lie in one text: hashes per seed, the text's number and the
    window's first word in it."""
    first = np.concatenate([[0], np.cumsum(counts)])
    text = np.repeat(np.arange(len(counts)), counts)
    start = np.arange(len(words)) - first[text]
    inside = np.flatnonzero(start + size <= counts[text])
    inside = inside[inside < len(words) - size + 1]
    return [window_hashes(words, size, s)[inside] for s in seeds], text[inside], start[inside]
