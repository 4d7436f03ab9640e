"""Parsing free-text answers back into columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paralex import fixed_values as V
from paralex.functions.core import col, let, strip, text_lines, with_kept
from paralex.functions.labels import ALL_LABELS, LANGUAGE_LABELS, labelled_map


def parse_labelled(
    df: DataFrame,
    codes: Sequence[str],
    text: str = "answer",
    keep_last_annotation: bool = False,
) -> DataFrame:
    """One column per code from ``Label: value`` answers.

    Answers without any known label yield no row.  The map is computed once
    and then read by every column; the plan stays one narrow stage.
    """
    value = labelled_map(text, ALL_LABELS, "\n", keep_last_annotation)
    parsed = with_kept(df, "_parsed", value, lambda m: m.isNotNull())
    return parsed.withColumns({c: F.col("_parsed").getItem(c) for c in codes}).drop("_parsed")


def parse_labelled_inline(df: DataFrame, codes: Sequence[str], text: str = "answer") -> DataFrame:
    """As :func:`parse_labelled`, with continuation lines joined by a space.

    Style and scene are no labels here, so their lines continue the open
    language.
    """
    value = labelled_map(text, LANGUAGE_LABELS, " ")
    parsed = with_kept(df, "_parsed", value, lambda m: m.isNotNull())
    return parsed.withColumns({c: F.col("_parsed").getItem(c) for c in codes}).drop("_parsed")


def fill_from_response(df: DataFrame, names: dict[str, str], text: str = "answer") -> DataFrame:
    """Fill empty language columns from ``Name: value`` lines.

    ``names`` maps column to language name.  The separator is a colon and a
    space, the first line with a value for the name wins, filled cells stay as they are.
    """
    lines = F.split(strip(F.coalesce(col(text), F.lit(""))), "\n")
    named = F.transform(
        F.filter(lines, lambda x: x.contains(": ")),
        lambda x: F.struct(
            strip(F.substring_index(x, ": ", 1)).alias("name"),
            strip(F.substr(x, F.instr(x, F.lit(": ")) + 2)).alias("value"),
        ),
    )
    pairs = F.filter(named, lambda p: (p["value"] != "") & p["name"].isin(list(names.values())))
    out = with_kept(df, "_pairs", pairs, lambda p: p.isNotNull())

    def cell(c: str, name: str) -> Column:
        value = F.get(F.filter("_pairs", lambda p: p["name"] == name), 0)["value"]
        # A null column is an absent language; only empty ones are filled.
        return F.when(F.col(c) == "", F.coalesce(value, F.lit(""))).otherwise(F.col(c))

    return out.withColumns({c: cell(c, name) for c, name in names.items()}).drop("_pairs")


def last_user_message(messages: str | Column = "messages") -> Column:
    """Content of the last user message, so that a missing system message
    does not shift positions."""
    users = F.filter(col(messages), lambda m: m["role"] == "user")
    return F.try_element_at(users, F.lit(-1))["content"]


def post_translation(df: DataFrame, codes: Sequence[str]) -> DataFrame:
    """Answer columns, with the source language restored from the prompt.

    The first non-empty language of the prompt overwrites the answer's column;
    without any, the answer stays.  ``wav_path`` is the row id.  An answer
    without labels still yields a row.
    """
    prompt = labelled_map(last_user_message(), ALL_LABELS)
    out = df.withColumn("_answer", labelled_map("answer", ALL_LABELS)).withColumn("_prompt", prompt)
    source = F.get(
        F.filter(F.map_keys("_prompt"), lambda k: F.col("_prompt")[k] != ""), 0
    )
    out = out.withColumn("_source", source)
    columns = {
        c: F.when(F.col("_source") == c, F.col("_prompt")[c]).otherwise(F.col("_answer")[c])
        for c in codes
    }
    return out.select(F.col("id").alias("wav_path"), *[v.alias(k) for k, v in columns.items()])


def post_topic(df: DataFrame) -> DataFrame:
    """``topic, contents`` with one trimmed sentence per non-empty line.

    Lines are dropped before trimming, so a line of spaces stays as ``''``.
    """
    kept = F.filter(F.split("answer", "\n"), lambda x: x != "")
    return df.select(F.col("id").alias("topic"), F.transform(kept, strip).alias("contents"))


def topic_sentences(df: DataFrame) -> DataFrame:
    """Long form of :func:`post_topic`."""
    return post_topic(df).select("topic", F.posexplode("contents").alias("pos", "sentence"))


def post_norm(df: DataFrame, lang: str, max_edits: int = V.MAX_EDITS) -> DataFrame:
    """``utt, src, text`` of normalisation answers that pass the gates.

    The source is the prompt after its first line break, or the whole prompt.
    """
    from paralex.operators.text import edit_distance_gate

    def source(prompt: Column) -> Column:
        cut = F.locate("\n", prompt)
        return F.when(cut > 0, F.substr(prompt, cut + 1)).otherwise(prompt)

    src = let(last_user_message(), source)
    rows = df.select(F.col("id").alias("utt"), src.alias("src"), F.col("answer").alias("text"))
    return edit_distance_gate(rows, lang, max_edits)


def post_extract(df: DataFrame, source: str = "zh-cn", target: str = "en") -> DataFrame:
    """``wav_path``, the sentence pair and ``term`` (JSON text) of term answers.

    The pair is the JSON object on the last non-blank prompt line, null when it
    is none.  A JSON object answers with its ``term``, other JSON means no
    term, text that is no JSON drops the row, as does an object without
    ``term`` or a blank prompt.
    """
    lines = F.filter(text_lines(last_user_message()), lambda x: strip(x) != "")
    pair = F.from_json(strip(F.try_element_at(lines, F.lit(-1))), "map<string,string>")
    json = F.try_parse_json("answer")
    found = F.struct(
        F.size(lines).alias("n"), pair.alias("pair"), json.alias("json"),
        F.schema_of_variant(json).alias("kind"),
    )
    out = with_kept(df, "_x", found, lambda x: (x["n"] > 0) & x["json"].isNotNull())
    out = out.select("id", F.col("_x.pair").alias("_pair"), F.col("_x.json").alias("_json"), F.col("_x.kind").alias("_kind"))
    is_object = F.startswith("_kind", F.lit("OBJECT"))
    term = F.try_variant_get("_json", "$.term", "variant")
    return out.filter(~is_object | term.isNotNull()).select(
        F.col("id").alias("wav_path"),
        F.col("_pair").getItem(source).alias("source"),
        F.col("_pair").getItem(target).alias("target"),
        F.when(is_object, F.nullif(F.to_json(term), F.lit("null"))).alias("term"),
    )


def parse_sst_pairs(df: DataFrame, text: str = "answer") -> DataFrame:
    """``pairs ARRAY<STRUCT<src,tgt>>`` of a segmentation answer.

    Code fences are dropped and the list ends at its first all-empty pair.
    Bad JSON gives an empty list.
    """
    bare = F.regexp_replace(col(text), "```json|```", "")
    parsed = F.from_json(bare, "array<struct<src:string,tgt:string>>")
    parsed = F.coalesce(parsed, F.from_json(F.lit("[]"), "array<struct<src:string,tgt:string>>"))

    def until_empty(pairs: Column) -> Column:
        flags = F.transform(
            pairs,
            lambda p: (F.coalesce(p["src"], F.lit("")) == "") & (F.coalesce(p["tgt"], F.lit("")) == ""),
        )
        first = F.array_position(flags, True)
        return F.when(first > 0, F.slice(pairs, F.lit(1), first.cast("int") - 1)).otherwise(pairs)

    return df.withColumn("pairs", let(parsed, until_empty))


def parse_sst_incremental(
    df: DataFrame, text: str = "answer", drop_lone_marks: bool = False
) -> DataFrame:
    """``steps ARRAY<STRUCT<src,tgt>>``: what each cumulative step added.

    Walking back from the last step, a step stays when its translation is
    contained in the one kept after it.  Neighbours then give differences; a
    step that adds no translation hands its source to the step before, and so
    does one that adds a lone punctuation mark (``drop_lone_marks=True``
    loses that source text, as older corpora did).
    """
    step = "struct<src:string,tgt:string>"
    sources = F.regexp_extract_all(col(text), F.lit(V.SST_STEP), F.lit(1))
    targets = F.regexp_extract_all(col(text), F.lit(V.SST_STEP), F.lit(2))
    steps = F.transform(
        F.arrays_zip(sources.alias("s"), targets.alias("t")),
        lambda p: F.struct(strip(p["s"]).alias("src"), strip(p["t"]).alias("tgt")),
    )
    empty = F.from_json(F.lit("[]"), f"array<{step}>")

    def chain_of(all_steps: Column) -> Column:
        # Positions only: folding the texts themselves would copy them at every step.
        size = F.size(all_steps)
        back = F.when(size > 0, F.sequence(size - 1, F.lit(0), F.lit(-1))).otherwise(
            F.array().cast("array<int>")
        )
        places = F.aggregate(
            back,
            F.array().cast("array<int>"),
            lambda acc, i: F.when(
                (F.size(acc) == 0)
                | F.get(all_steps, F.get(acc, 0))["tgt"].contains(F.get(all_steps, i)["tgt"]),
                F.concat(F.array(i), acc),
            ).otherwise(acc),
        )
        return F.transform(places, lambda i: F.get(all_steps, i))

    def added(now: Column, before: Column) -> Column:
        return F.when(F.startswith(now, before), F.substr(now, F.length(before) + 1)).otherwise(now)

    def differences(chain: Column) -> Column:
        return F.transform(
            chain,
            lambda s, k: F.when(k == 0, s).otherwise(
                F.struct(
                    added(s["src"], F.get(chain, k - 1)["src"]).alias("src"),
                    added(s["tgt"], F.get(chain, k - 1)["tgt"]).alias("tgt"),
                )
            ),
        )

    def fold(deltas: Column) -> Column:
        def merge(acc: Column, d: Column) -> Column:
            handed = F.concat(
                F.slice(acc, F.lit(1), F.size(acc) - 1),
                F.array(
                    F.struct(
                        F.concat(F.element_at(acc, -1)["src"], d["src"]).alias("src"),
                        F.element_at(acc, -1)["tgt"].alias("tgt"),
                    )
                ),
            )
            lone = d["tgt"].isin(V.SST_LONE_MARKS)
            return (
                F.when(F.size(acc) == 0, F.array(d))
                .when(d["tgt"] == "", handed)
                .when(lone, acc if drop_lone_marks else handed)
                .otherwise(F.concat(acc, F.array(d)))
            )

        return F.aggregate(deltas, empty, merge)

    return df.withColumn("steps", let(let(let(steps, chain_of), differences), fold))
