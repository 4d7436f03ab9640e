"""Task registry: what each task renders, and how its answers are read."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paralex.operators import requests as R
from paralex.operators import responses as X
from paralex.operators.enrich import BatchFunction, answered, enrich
from paralex.operators.relational import dedupe_first
from paralex.session import stored

ANSWER = T.StructType([T.StructField("answer", T.StringType())])


@dataclass(frozen=True)
class Task:
    """``render`` maps rows to ``custom_id, system, user``; ``parse`` maps
    ``id, answer, messages`` to the result.  ``also`` names columns that a
    request needs besides id and text."""

    id_col: str
    text_col: str
    render: Callable[[DataFrame, "Task", dict], DataFrame]
    parse: Callable[[DataFrame, dict], DataFrame]
    also: Callable[[dict], tuple[str, ...]] = lambda options: ()

    def needed(self, options: dict) -> list[str]:
        """Columns without which a row has no request."""
        return list(dict.fromkeys([self.id_col, self.text_col, *self.also(options)]))


def _render_translation(df: DataFrame, task: Task, options: dict) -> DataFrame:
    cfg = options.get("config", R.RenderConfig())
    rows = df.dropna(subset=[task.id_col, task.text_col])
    return rows.select(
        F.col(task.id_col).alias("custom_id"), F.lit(cfg.system).alias("system"),
        R.translation_prompt(task.text_col, cfg).alias("user"),
    )


TASKS: dict[str, Task] = {
    "translation": Task(
        "utt", "text", _render_translation, lambda df, o: X.post_translation(df, o["codes"])
    ),
    "norm": Task(
        "utt", "text",
        lambda df, t, o: R.render_norm(df, o.get("system"), t.id_col, t.text_col),
        lambda df, o: X.post_norm(df, o.get("src_lang", "en")),
    ),
    "sst": Task(
        "utt", "text",
        lambda df, t, o: R.render_sst(df, o["prompts"], o["src_lang"], o["tgt_lang"], t.id_col, t.text_col),
        lambda df, o: X.parse_sst_pairs(df).select(F.col("id").alias("utt"), "pairs"),
    ),
    "topic": Task(
        "topic", "topic",
        lambda df, t, o: R.render_topic(df, o["template"], o["num"], o["src_lang"], t.text_col),
        lambda df, o: X.post_topic(df),
    ),
    "extract": Task(
        "wav_path", "zh-cn",
        lambda df, t, o: R.render_extract(df, o["system"], o["template"], t.id_col, t.text_col, o.get("target", "en")),
        lambda df, o: X.post_extract(df),
        lambda o: (o.get("target", "en"),),
    ),
}


@dataclass(frozen=True)
class TaskRun:
    """``results`` of the answered rows; ``rest`` has ``id`` and ``outcome``
    (``failed``, ``blocked`` or ``rejected``) of all others."""

    results: DataFrame
    rest: DataFrame


def run_task(
    df: DataFrame,
    task: str,
    fn: BatchFunction,
    options: dict,
    columns: tuple[str, str] | None = None,
    max_attempts: int = 3,
    first_delay: float = 0.3,
) -> TaskRun:
    """Render, ask ``fn`` and parse, end to end.

    ``fn`` sees ``custom_id, system, user`` and returns ``answer``.  ``columns``
    replaces the task's id and text columns.  With ``file_name`` and
    ``line_no`` columns, repeated ids of a file are asked once.  Rows without
    a column that their request needs are rejected; those and the rows without an answer are the rest.
    Answers are written before they are used twice.  Rows not shuffled for
    their ids are dealt by id and text, for a file may be read by a single task,
    which would ask and parse all of it.
    """
    spec = TASKS[task]
    if columns:
        spec = replace(spec, id_col=columns[0], text_col=columns[1])
    needed = spec.needed(options)
    # Split once: a row is either rendered or rejected.
    if {"file_name", "line_no"} <= set(df.columns):
        df = dedupe_first(df, spec.id_col)
        given = df.filter(R.all_given(needed))
    else:
        given = df.filter(R.all_given(needed)).repartition(F.col(f"`{spec.id_col}`"), F.col(f"`{spec.text_col}`"))
    requests = spec.render(given, spec, options)
    rejected = R.without_request(df, needed).select(
        F.col(f"`{spec.id_col}`").cast("string").alias("id"), F.lit("rejected").alias("outcome")
    )
    asked = stored(enrich(requests, fn, ANSWER, max_attempts, first_delay), "answers")
    answers = answered(asked)
    rest = asked.filter("outcome <> 'ok'").select(F.col("custom_id").cast("string").alias("id"), "outcome").unionByName(rejected)
    decoded = answers.select(
        F.col("custom_id").alias("id"), "answer",
        R.messages(F.col("system"), F.array("user")).alias("messages"),
    )
    return TaskRun(spec.parse(decoded, options), rest)
