"""Rendering one model request per row, as nested columns and JSON text."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paralex import fixed_values as V
from paralex.functions.core import col, strip
from paralex.operators.predicates import missing_langs, pivot_lang
from paralex.operators.sharding import sequence_ids, shard_by_written_bytes
from paralex.operators.text import source_after_last

ENGLISH = {code: english for code, english, _, _ in V.LANGUAGES}
CHINESE = {code: chinese for code, _, chinese, _ in V.LANGUAGES}


@dataclass
class RenderConfig:
    """Parameters of a request.  Prompts are the caller's; these are short
    defaults."""

    src_lang: str = "en"
    need_languages: Sequence[str] = tuple(e for c, e, _, _ in V.LANGUAGES if c != "en")
    styles: Sequence[str] = tuple(V.STYLES)
    scenes: Sequence[str] = tuple(V.SCENES)
    prefix: str = "Translate this [src_lang] sentence. Answer with one labelled line per language."
    prompt: str | None = None
    system: str | None = "You translate sentences."
    model: str = "model"
    max_tokens: int = 12000
    dialect: str = "chat"
    url: str = "/chat/completions"


def translation_prompt(text: str | Column, cfg: RenderConfig) -> Column:
    """Prefix, the labelled source, one label per target, style and scene lines.

    A custom prompt replaces all of it: ``prompt`` and text on two lines.
    """
    if cfg.prompt:
        return F.concat(F.lit(cfg.prompt + "\n"), col(text))
    name = ENGLISH[cfg.src_lang]
    head = cfg.prefix.replace("[src_lang]", name) + f"\n\n{name}: "
    labels = ": \n".join(cfg.need_languages) + ": " if cfg.need_languages else ""
    tail = "\n".join(
        [
            "",
            labels,
            f"Style: [Choose one from: {', '.join(cfg.styles)}]",
            f"Scene: [Choose one from: {', '.join(cfg.scenes)}]",
        ]
    )
    return strip(F.concat(F.lit(head), col(text), F.lit(tail)))


def render_translation(df: DataFrame, cfg: RenderConfig, text: str = "text") -> DataFrame:
    return df.withColumn("prompt", translation_prompt(text, cfg))


def without_request(df: DataFrame, needed: Sequence[str]) -> DataFrame:
    """Rows that lack one of the columns their request needs: those that the
    renderer with these columns leaves out."""
    return df.filter(~all_given(needed))


def all_given(needed: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"`{c}`").isNotNull() for c in needed])


def render_sst(
    df: DataFrame,
    prompts: dict[tuple[str, str], str],
    src_lang: str,
    tgt_lang: str,
    id_col: str = "utt",
    text: str = "text",
    spaced: Sequence[str] = ("zh", "ja", "th"),
    compat: bool = False,
) -> DataFrame:
    """``custom_id, system, user`` for segment translation.

    Rows without id or text are left out (:func:`without_request` returns them).
    Spaces are removed from text in the scripts of ``spaced``, which do not
    separate words by them; ``compat=True`` removes them from any language.
    """
    user = F.col(text)
    if compat or src_lang in spaced:
        user = F.replace(user, F.lit(" "), F.lit(""))
    return df.dropna(subset=[id_col, text]).select(
        F.col(id_col).alias("custom_id"), F.lit(prompts[src_lang, tgt_lang]).alias("system"),
        user.alias("user"),
    )


def render_norm(
    df: DataFrame, system: str | None, id_col: str = "utt", text: str = "text"
) -> DataFrame:
    """``custom_id, system, user``: the task prompt, if any, and the text as is.

    Rows without id or text are left out (:func:`without_request` returns them).
    """
    return df.dropna(subset=[id_col, text]).select(
        F.col(id_col).alias("custom_id"), F.lit(system).cast("string").alias("system"),
        F.col(text).alias("user"),
    )


def render_extract(
    df: DataFrame, system: str, template: str, id_col: str, source: str, target: str
) -> DataFrame:
    """Fill ``{transcription}`` and ``{translation}`` of a term template.

    Rows without id, source or target are left out (:func:`without_request`
    returns them).
    """
    user = F.replace(
        F.replace(F.lit(template), F.lit("{transcription}"), F.col(source)),
        F.lit("{translation}"), F.col(target),
    )
    return df.dropna(subset=[id_col, source, target]).select(
        F.col(id_col).alias("custom_id"), F.lit(system).alias("system"), user.alias("user")
    )


def render_topic(
    topics: DataFrame, template: str, num: int, lang: str, topic: str = "topic"
) -> DataFrame:
    """One request per topic path; no system message, the path is the id.  Null
    paths are left out (:func:`without_request` returns them)."""
    filled = template.replace("[num]", str(num)).replace("[language]", CHINESE[lang])
    user = F.replace(F.lit(filled), F.lit("[topic]"), F.concat(F.lit("["), F.col(topic), F.lit("]")))
    return topics.dropna(subset=[topic]).select(
        F.col(topic).alias("custom_id"), F.lit(None).cast("string").alias("system"), user.alias("user")
    )


def render_supplement(
    df: DataFrame, langs: Sequence[str], first: Sequence[str] = ("zh-cn", "en")
) -> DataFrame:
    """Add ``prompt`` asking for the missing languages; null for complete rows
    and rows without any text, which pass through.

    The source is named by its language when it is one of ``first`` and by its
    code otherwise, as existing answers expect.
    """
    out = pivot_lang(missing_langs(df, langs), langs, first)
    # The empty source is asked for in the first preferred language.
    shown = F.coalesce("pivot_lang", F.lit(first[0]))
    label = shown
    for code in first:
        label = F.when(shown == code, ENGLISH[code]).otherwise(label)
    names = F.create_map(*[F.lit(x) for c in langs for x in (c, ENGLISH[c])])
    wanted = F.transform("missing", lambda c: F.element_at(names, c))
    listed = F.array_join(wanted, ", ")
    lines = F.array_join(F.transform(wanted, lambda n: F.concat(n, F.lit(": <translation>"))), "\n")
    prompt = F.concat(
        F.lit("Translate this "), label, F.lit(" sentence into "), listed, F.lit(":\n\n"),
        label, F.lit(": "), F.coalesce("pivot_text", F.lit("")), F.lit("\n"), lines,
    )
    return out.withColumn("prompt", F.when(F.size("missing") > 0, prompt))


def messages(system: Column, users: Column) -> Column:
    """``ARRAY<STRUCT<role, content>>``: an optional system message, then one
    message per element of ``users``."""
    head = F.when(
        system.isNotNull(), F.array(F.struct(F.lit("system").alias("role"), system.alias("content")))
    ).otherwise(F.array().cast("array<struct<role:string,content:string>>"))
    return F.concat(
        head, F.transform(users, lambda u: F.struct(F.lit("user").alias("role"), u.alias("content")))
    )


def request_text(cfg: RenderConfig, key: Column, users: Column | None = None) -> Column:
    """The JSON text of a request with the id ``key``, from the columns
    ``system``, which may be null, and ``user`` (or ``users``)."""
    parts = messages(F.col("system"), F.array("user") if users is None else users)
    if cfg.dialect == "chat":
        request = F.struct(
            key.alias("custom_id"),
            F.lit("POST").alias("method"),
            F.lit(cfg.url).alias("url"),
            F.struct(
                F.lit(cfg.model).alias("model"),
                parts.alias("messages"),
                F.lit(cfg.max_tokens).alias("max_tokens"),
            ).alias("body"),
        )
    elif cfg.dialect == "role":
        request = F.struct(key.alias("id"), parts.alias("messages"))
    else:
        raise ValueError(f"unknown dialect: {cfg.dialect}")
    return F.to_json(request)


def request_envelope(
    df: DataFrame, cfg: RenderConfig, id_col: str = "custom_id", users: Column | None = None
) -> DataFrame:
    """``custom_id, request``: the JSON text of one request per row.

    ``system`` may be null; ``users`` defaults to the single ``user`` column.
    """
    return df.select(F.col(id_col).alias("custom_id"), request_text(cfg, F.col(id_col), users).alias("request"))


def roll_requests(
    df: DataFrame,
    cfg: RenderConfig,
    max_bytes: int = V.SHARD_BYTES,
    max_rows: int = V.SHARD_ROWS,
    order: str = "line_no",
) -> DataFrame:
    """One request line per row of ``file_name``, ``system`` and ``user``, in
    shards whose written bytes reach ``max_bytes`` with their last line.

    Adds ``shard``, ``row_in_shard``, ``custom_id`` (file, shard and row) and
    ``line``.  The id is part of the line, so a line's length depends on its
    shard.  A null file name is written as an empty one.
    """
    name = F.coalesce("file_name", F.lit(""))
    bare = request_text(cfg, F.concat(name, F.lit("--")))
    placed = shard_by_written_bytes(
        df.withColumn("_bytes", F.octet_length(bare) + 1), "_bytes", max_bytes, max_rows, order
    ).drop("_bytes")
    key = F.concat_ws("-", name, "shard", "row_in_shard")
    return placed.withColumn("custom_id", key).withColumn("line", request_text(cfg, F.col("custom_id")))


def system_request(df: DataFrame, cfg: RenderConfig, id_col: str, prompt: str = "prompt") -> DataFrame:
    """Chat request whose only message is the prompt, sent as system message."""
    only = df.withColumn("system", F.col(prompt))
    none = F.array().cast("array<string>")
    return request_envelope(only, cfg, id_col, none)


def render_from_parallel(
    df: DataFrame, cfg: RenderConfig, id_col: str = "id", source: str = "en"
) -> DataFrame:
    """Requests from parallel rows; rows without ``source`` text are skipped."""
    rows = df.filter(F.coalesce(F.col(source), F.lit("")) != "")
    return system_request(render_translation(rows, cfg, source), cfg, id_col)


def rerender_prompts(
    df: DataFrame, cfg: RenderConfig, prompt: str = "prompt", order: str = "line_no"
) -> DataFrame:
    """Existing prompts with new wording, keyed by their sequence in the file:
    ``file_name, key, line`` with ``line`` the keyed prompt as JSON."""
    fresh = df.withColumn("prompt", translation_prompt(source_after_last(prompt), cfg))
    keyed = sequence_ids(fresh, order)
    return keyed.select(
        "file_name", "key", F.to_json(F.create_map("key", "prompt")).alias("line")
    )
