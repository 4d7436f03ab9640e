"""Reading ``Label: value`` text into a map, as one narrow expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from paralex import fixed_values as V
from paralex.functions.core import alternation, col, let, strip, text_lines

LANGUAGE_LABELS = {english: code for code, english, _, _ in V.LANGUAGES}
ALL_LABELS = LANGUAGE_LABELS | {label: code for code, label in V.ANNOTATION_LABELS}


def label_codes(labels: dict[str, str]) -> Column:
    """The label table as a constant map expression."""
    return F.create_map(*[F.lit(x) for pair in labels.items() for x in pair])


def labelled_map(
    text: str | Column,
    labels: dict[str, str] | None = None,
    joiner: str = "\n",
    keep_last_annotation: bool = False,
) -> Column:
    """``MAP<code, value>`` of the labelled lines of ``text``; null without labels.

    A line whose part before the first colon is a known label opens a segment;
    every other line continues the open one, joined by ``joiner``.  Text before
    the first label is dropped; a repeated label keeps its first place and its
    last segment.
    ``**Label:**`` counts as ``Label:``.

    Style and scene keep their first line, letters, digits, commas and spaces,
    in lower case.  That includes the last segment of the answer;
    ``keep_last_annotation=True`` leaves the last segment as written, which is
    how older corpora were produced.
    """
    labels = ALL_LABELS if labels is None else labels
    opens = rf"(?s)^[{V.SPACE}]*({alternation(labels)})[{V.SPACE}]*:(.*)$"
    codes = label_codes(labels)
    unbolded = F.regexp_replace(col(text), V.BOLD_LABEL, "$1:")

    def segments(lines: Column) -> Column:
        marked = F.filter(
            F.transform(lines, lambda x, i: F.when(x.rlike(opens), i)), lambda i: i.isNotNull()
        )

        def cut(starts: Column) -> Column:
            def one(start: Column, k: Column) -> Column:
                stop = F.coalesce(F.get(starts, k + 1), F.size(lines))
                head = F.get(lines, start)
                rest = F.slice(lines, start + 2, stop - start - 1)
                body = F.array_join(
                    F.concat(F.array(F.regexp_extract(head, opens, 2)), rest), joiner
                )
                return F.struct(
                    F.element_at(codes, F.regexp_extract(head, opens, 1)).alias("code"),
                    strip(body).alias("body"),
                )

            return F.transform(starts, one)

        return let(marked, cut)

    def last_per_code(segs: Column) -> Column:
        first_seen = F.filter(
            segs,
            lambda s, k: ~F.exists(
                F.slice(segs, F.lit(1), k), lambda earlier: earlier["code"] == s["code"]
            ),
        )
        annotations = [code for code, _ in V.ANNOTATION_LABELS]
        last_code = F.element_at(segs, -1)["code"]

        def tidy(code: Column, body: Column) -> Column:
            cleaned = F.lower(
                strip(F.regexp_replace(F.substring_index(body, "\n", 1), V.ANNOTATION_DROP, ""))
            )
            is_annotation = code.isin(annotations)
            if keep_last_annotation:
                is_annotation = is_annotation & (code != last_code)
            return F.struct(code.alias("key"), F.when(is_annotation, cleaned).otherwise(body).alias("value"))

        def latest(s: Column) -> Column:
            same = F.filter(segs, lambda t: t["code"] == s["code"])
            return tidy(s["code"], F.element_at(same, -1)["body"])

        return F.when(F.size(segs) > 0, F.map_from_entries(F.transform(first_seen, latest)))

    return let(text_lines(unbolded), lambda lines: let(segments(lines), last_per_code))
