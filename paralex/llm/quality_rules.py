"""Line-first cleaning: lines are judged first, then the document.

A line is removed if it fails a rule of punctuation (marks and symbols instead
of words, runs of end marks, short lines without a letter or digit), of navigation (words set apart by separators) or
of boilerplate (stock phrases in a short line, shouting).  A document is
rejected if the lines that are left hold too little of its text, or by its base
figures.

Null and empty texts have no words and fail the base rule.  Every text is read
whole.  Figures depend on the text alone, so repeated rows get equal results.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

from pyspark.sql import types as T

from paralex.llm.common import text_function

SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
SEPARATORS = frozenset(["|", "»", "›", "·", "•", "/", ">", "::", "—>", "->"])
PHRASES = re.compile(
    r"all rights reserved|privacy policy|terms (?:of (?:use|service)|and conditions)|cookies?\b.{0,40}\b(?:accept|settings|policy)"
    r"|enable javascript|lorem ipsum|powered by|click here|sign up for|subscribe to our|follow us on|skip to (?:main )?content"
    r"|back to top|share this (?:page|article)|add to cart",
    re.IGNORECASE,
)
RUN = re.compile(r"[!?.]{2,}$")
MARK = re.compile(r"[^\w\s]", re.UNICODE)


@dataclass(frozen=True)
class Limits:
    """Shares are of the words or characters of a line, or of a document's text."""

    marks: float = 0.3
    runs: float = 0.5
    separators: float = 0.2
    least_separators: int = 3
    capitals: float = 0.8
    least_words: int = 5
    phrase_words: int = 30
    kept_text: float = 0.5
    document_words: int = 50
    repeated_words: float = 0.5


def line_fault(line: str, limits: Limits) -> str | None:
    """The first rule a line with words fails: punctuation, navigation or boilerplate."""
    words = line.split()
    n = len(words)
    solid = sum(map(len, words))
    if solid and len(MARK.findall(line)) > limits.marks * solid and n >= limits.least_words:
        separators = sum(w in SEPARATORS for w in words)
        if separators < limits.least_separators:
            return "punctuation"
    if n >= limits.least_words and sum(RUN.search(w) is not None for w in words) > limits.runs * n:
        return "punctuation"
    separators = sum(w in SEPARATORS for w in words)
    if separators >= limits.least_separators and separators >= limits.separators * n:
        return "navigation"
    if n <= limits.phrase_words and PHRASES.search(line):
        return "boilerplate"
    letters = sum(map(str.isalpha, line))
    if n >= limits.least_words and letters and sum(map(str.isupper, line)) > limits.capitals * letters:
        return "boilerplate"
    if words and n < limits.least_words and not any(map(str.isalnum, line)):
        return "punctuation"
    return None


def judge(text: str | None, limits: Limits = Limits()) -> dict:
    """Base figures, faults by rule, the text of the lines left and the verdict."""
    text = text or ""
    words = text.encode().split()
    n = len(words)
    word_chars = len(text) - sum(map(text.count, SPACES))
    windows = Counter(zip(words, words[1:], words[2:]))
    repeated = bytearray(n)
    if len(windows) < n - 2:
        for i, w in enumerate(zip(words, words[1:], words[2:])):
            if windows[w] > 1:
                repeated[i] = repeated[i + 1] = repeated[i + 2] = 1
    n_repeat_words = sum(repeated)
    seen, n_dup_lines, left = set(), 0, []
    faults = {"punctuation": 0, "navigation": 0, "boilerplate": 0}
    for line in text.split("\n"):
        if not line.strip(SPACES):
            left.append(line)
            continue
        n_dup_lines += line in seen
        seen.add(line)
        fault = line_fault(line, limits)
        if fault:
            faults[fault] += 1
        else:
            left.append(line)
    cleaned = "\n".join(left) if any(faults.values()) else text
    kept_chars = len(cleaned) - sum(map(cleaned.count, SPACES))
    base_failed = n < limits.document_words or n_repeat_words > limits.repeated_words * n
    return {
        "n_words": n, "word_chars": word_chars, "n_symbols": sum(map(text.count, SYMBOLS)), "n_dup_lines": n_dup_lines,
        "n_repeat_words": n_repeat_words, "base_failed": base_failed,
        "kept": not base_failed and kept_chars >= limits.kept_text * word_chars,
        **{f"n_{k}": v for k, v in faults.items()}, "cleaned": cleaned,
    }


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
FAULTS = ["n_punctuation", "n_navigation", "n_boilerplate"]
VERDICT = T.StructType([
    *[T.StructField(c, T.LongType()) for c in COUNTS],
    *[T.StructField(c, T.BooleanType()) for c in ("base_failed", "kept")],
    *[T.StructField(c, T.LongType()) for c in FAULTS], T.StructField("cleaned", T.StringType()),
])


def quality(limits: Limits = Limits()):
    """A column function: text to the struct of :func:`judge`."""
    return text_function(lambda: lambda text: judge(text, limits), VERDICT)
