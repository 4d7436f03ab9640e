"""Numbers of greedy longest-match pieces, without building the pieces.

The vocabulary is a trie with failure links.  A node's link leads to what is
left after its longest-match tokens are popped, and how many are popped is
counted beforehand; so a word is read once, byte by byte.  The vocabulary must
hold every single byte.

A word is matched behind the mark that starts a word in the vocabulary (a space
in byte vocabularies): its first piece is one of those that start words, if one
fits, the others are pieces from inside of words.  Every byte is a piece, so no
word is unknown.

Words stand between ASCII white space.  Null and empty texts have none.  Texts
are read whole; equal rows get equal counts.
"""

from __future__ import annotations

from collections import deque

from pyspark.sql import types as T

from paralex.llm.bpe import loaded
from paralex.llm.common import text_function

CACHED = 200_000  # words whose counts a Python worker keeps
LONGEST_KEPT = 64  # bytes; longer words are counted again
_BUILT: dict[tuple[str, bytes], LongestMatch] = {}


class LongestMatch:
    def __init__(self, tokens, start: bytes = b""):
        self.start = start
        self.next, self.pops, self.link, ends = [{}], [0], [-1], {}
        for token in filter(None, tokens):
            at = 0
            for byte in token:
                if byte not in self.next[at]:
                    self.next[at][byte] = len(self.next)
                    self.next.append({})
                    self.pops.append(0)
                    self.link.append(-1)
                at = self.next[at][byte]
            ends[at] = True
        waiting = deque([0])
        while waiting:
            parent = waiting.popleft()
            for byte, node in self.next[parent].items():
                waiting.append(node)
                if node in ends:
                    self.pops[node], self.link[node] = 1, 0
                    continue
                count, z = self.pops[parent], self.link[parent]
                while z >= 0 and byte not in self.next[z]:
                    count, z = count + self.pops[z], self.link[z]
                if z >= 0:
                    self.pops[node], self.link[node] = count, self.next[z][byte]
        self.words: dict[bytes, int] = {}

    def count(self, word: bytes) -> int:
        word, total, at = self.start + word, 0, 0
        for byte in word:
            while byte not in self.next[at]:
                total, at = total + self.pops[at], self.link[at]
            at = self.next[at][byte]
        while at:
            total, at = total + self.pops[at], self.link[at]
        return total

    def total(self, words: list[bytes]) -> int:
        out = 0
        for word in words:
            n = self.words.get(word)
            if n is None:
                n = self.count(word)
                if len(word) <= LONGEST_KEPT:
                    if len(self.words) >= CACHED:
                        self.words.clear()
                    self.words[word] = n
            out += n
        return out


def token_counts(path: str, start: bytes = b" "):
    """A column function: text to ``n_words`` and ``n_tokens`` by a byte vocabulary
    whose entries for the start of a word begin with ``start``."""

    def make():
        if (path, start) not in _BUILT:
            _BUILT[path, start] = LongestMatch(loaded(path).strings, start)
        match = _BUILT[path, start]

        def row(text):
            words = text.encode().split() if text else []
            return {"n_words": len(words), "n_tokens": match.total(words)}

        return row

    return text_function(make, T.StructType([T.StructField("n_words", T.LongType()), T.StructField("n_tokens", T.LongType())]))
