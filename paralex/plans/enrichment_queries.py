"""Caller functions and whole tasks, with stand-in functions that are pure."""

from __future__ import annotations

from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paralex.operators.enrich import Answer, enrich, on_columns
from paralex.plans.fixtures import fixture as fx
from paralex.plans.requests_queries import CFG, SST, TEMPLATE, TOPIC
from paralex.plans.tasks import run_task
from paralex.sources.text import flatten_paths

LENGTH = T.StructType([T.StructField("answer", T.StringType()), T.StructField("size", T.LongType())])


# The two functions that raise are called about once a row, where frames for the
# rows and the answers cost more than a loop over lists.
@on_columns
def flaky(batch: dict[str, list], attempt: int) -> Answer:
    """Answers a text once it has been tried (length mod 5) times before."""
    texts = batch["text"]
    sizes = [-1 if t is None else len(t) for t in texts]
    if any(n % 7 == 3 for n in sizes if n >= 0):
        raise ValueError("poison")
    ready = [i for i, n in enumerate(sizes) if n >= 0 and n % 5 < attempt]
    return ready, {"answer": [texts[i].replace("e", "E") for i in ready], "size": [sizes[i] for i in ready],
                   "blocked": [sizes[i] % 11 == 0 for i in ready]}


@on_columns
def echo(batch: dict[str, list], attempt: int) -> Answer:
    """Repeats the last line of the user message and adds two marks; cannot take
    messages of some lengths."""
    users = batch["user"]
    if any(len(u) % 7 == 0 for u in users if u is not None):
        raise ValueError("poison")
    return range(len(users)), {"answer": [None if u is None else u.rsplit("\n", 1)[-1] + "!," for u in users]}


def topics(batch: pd.DataFrame, attempt: int) -> pd.DataFrame:
    return pd.DataFrame({"answer": "first " + batch["custom_id"] + " \n\n second\n"})


def translated(batch: pd.DataFrame, attempt: int) -> pd.DataFrame:
    source = batch["user"].str.extract(r"(?s)English: (.*)\nFrench: ", expand=False)
    return pd.DataFrame({"answer": "French: " + source.str.replace("e", "E") + "\nStyle: Calm."})


def segmented(batch: pd.DataFrame, attempt: int) -> pd.DataFrame:
    size = batch["user"].str.len().astype(str)
    return pd.DataFrame({"answer": '```json\n[{"src": "all", "tgt": "' + size + '"}, {"src": "", "tgt": ""}]\n```'})


def terms(batch: pd.DataFrame, attempt: int) -> pd.DataFrame:
    return pd.DataFrame({"answer": '{"term": ' + batch["user"].str.len().astype(str) + "}"})


def lines(s, d):
    return fx(s, d, "lines").select(
        F.concat_ws("-", "source", "doc_id").alias("file_name"), "line_no",
        F.concat_ws("-", "doc_id", "line_no").alias("utt"), F.col("line").alias("text"))


def enriched(s, d):
    out = enrich(lines(s, d).select("utt", "text"), flaky, LENGTH, max_attempts=3, first_delay=0.0)
    return out.select("utt", "text", "answer", "size", "outcome", "attempts")


def tasks(s, d):
    """Every task over whole tables, as ``task, id, value``."""
    row = lambda task, df, key, value: df.select(F.lit(task).alias("task"), F.col(key).alias("id"), value.alias("value"))
    norm = run_task(lines(s, d), "norm", echo, {"system": "Normalise.", "src_lang": "de"}, first_delay=0.0)
    topic = run_task(flatten_paths(fx(s, d, "nodes")), "topic", topics,
                     {"template": TOPIC, "num": 5, "src_lang": "en"}, first_delay=0.0)
    docs = fx(s, d, "conversations").select(F.concat_ws("-", "conv_id", "turn").alias("utt"), "text")
    moved = run_task(docs, "translation", translated, {"config": CFG, "codes": ["en", "fr", "style"]}, first_delay=0.0)
    cut = run_task(docs, "sst", segmented, {"prompts": SST, "src_lang": "zh", "tgt_lang": "en"}, first_delay=0.0)
    pairs = run_task(fx(s, d, "wide").select("id", "fr", "en"), "extract", terms,
                     {"system": "Extract terms.", "template": TEMPLATE, "target": "en"}, ("id", "fr"), first_delay=0.0)
    rest = [df.rest.select(F.lit(task).alias("task"), "id", F.col("outcome").alias("value"))
            for task, df in (("norm", norm), ("topic", topic), ("translation", moved), ("sst", cut), ("extract", pairs))]
    return reduce(DataFrame.unionByName, [
        row("norm", norm.results, "utt", F.col("text")),
        row("topic", topic.results, "topic", F.array_join("contents", "|")),
        row("translation", moved.results, "wav_path", F.concat_ws("|", "en", "fr", "style")),
        row("sst", cut.results, "utt", F.array_join(F.transform("pairs", lambda p: F.concat(p["src"], p["tgt"])), "|")),
        row("extract", pairs.results, "wav_path", F.col("term")),
        *rest,
    ])


QUERIES = {"enrich_with_retry": enriched, "task_registry": tasks}
ORACLE = {
    "enrich_with_retry": """
      SELECT concat(doc_id, '-', line_no) AS utt, line AS text,
        CASE WHEN length(line) % 5 < 3 AND length(line) % 7 <> 3 THEN replace(line, 'e', 'E') END AS answer,
        CASE WHEN length(line) % 5 < 3 AND length(line) % 7 <> 3 THEN length(line) END AS size,
        CASE WHEN length(line) % 5 >= 3 OR length(line) % 7 = 3 THEN 'failed' WHEN length(line) % 11 = 0 THEN 'blocked' ELSE 'ok' END AS outcome,
        CAST(CASE WHEN length(line) % 7 = 3 THEN 3 ELSE least(length(line) % 5 + 1, 3) END AS INTEGER) AS attempts FROM {lines}""",
    "task_registry": f"""
      SELECT 'norm' AS task, concat(doc_id, '-', line_no) AS id, CASE WHEN length(line) % 7 = 0 THEN 'failed' ELSE line || '!,' END AS value FROM {{lines}}
      UNION ALL SELECT 'topic', r_name || '-' || n_name || '-' || c_name, concat('first ', r_name, '-', n_name, '-', c_name, '|second')
      FROM {{customer}} JOIN {{nation}} ON c_nationkey = n_nationkey JOIN {{region}} ON n_regionkey = r_regionkey
      UNION ALL SELECT 'translation', concat(conv_id, '-', turn), concat(text, '|', replace(text, 'e', 'E'), '|calm') FROM {{conversations}}
      UNION ALL SELECT 'sst', concat(conv_id, '-', turn), concat('all', length(replace(text, ' ', ''))) FROM {{conversations}}
      UNION ALL SELECT 'extract', id, CAST(length(replace(replace('{TEMPLATE}', '{{transcription}}', fr), '{{translation}}', en)) AS VARCHAR)
      FROM {{wide}} WHERE fr IS NOT NULL
      UNION ALL SELECT 'extract', id, 'rejected' FROM {{wide}} WHERE fr IS NULL""",
}
