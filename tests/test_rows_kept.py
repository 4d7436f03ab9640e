"""Rows in are rows out: as results, as rest or as rejected rows, once each."""

import pandas as pd
import pytest
from paralex.operators.usage import join_stats_state
from paralex.plans.tasks import TASKS, run_task
from paralex.sources import text as S

OPTIONS = {
    "translation": {"codes": ["en", "fr"]}, "norm": {}, "sst": {"prompts": {("zh", "en"): "cut"}, "src_lang": "zh", "tgt_lang": "en"},
    "topic": {"template": "[num] [topic]", "num": 2, "src_lang": "en"}, "extract": {"system": "s", "template": "{transcription} {translation}"},
}


@pytest.mark.parametrize("task", sorted(TASKS))
def test_a_row_is_asked_or_rejected(spark, task):
    """Ids, texts and targets are null in turn, and all at once."""
    rows = [(i if i % 2 else None, t, e) for i in range(8) for t in ("text", None) for e in ("target", None)]
    df = spark.createDataFrame([(None if i is None else f"id{n}", t, e) for n, (i, t, e) in enumerate(rows)], "i string, t string, en string")
    columns = ("t", "t") if task == "topic" else ("i", "t")

    def fn(batch, attempt):
        if batch[["custom_id", "user"]].isna().any().any():
            raise ValueError("a request without id or text")
        return pd.DataFrame({"answer": [None] * len(batch)}, index=batch.index)[:0]  # nothing is answered

    run = run_task(df, task, fn, OPTIONS[task], columns, max_attempts=1, first_delay=0.0)
    rest = run.rest.collect()
    assert len(rest) == df.count() and run.results.count() == 0
    needed = {"topic": ["t"], "extract": ["i", "t", "en"]}.get(task, ["i", "t"])
    usable = df.dropna(subset=needed).collect()
    assert sorted(r.id for r in rest if r.outcome == "failed") == sorted(r[columns[0]] for r in usable)
    assert sum(r.outcome == "rejected" for r in rest) == df.count() - len(usable)


def test_files_of_two_configurations_stay_apart(spark):
    stats = spark.createDataFrame([("a", "f", 1), ("b", "f", 2), (None, "f", 3), ("c", None, 4)], "config string, file_name string, lines int")
    state = spark.createDataFrame(
        [("a", "f", 10), ("b", "f", 20), ("b", "f", 25), (None, "f", 30), ("c", None, 40), ("d", "f", 50)], "config string, file_name string, completed_at long")
    got = sorted((r.lines, r.completed_at) for r in join_stats_state(stats, state, ["config"]).collect())
    assert got == [(1, 10), (2, 25), (3, 30), (4, 40)]
    by_name = sorted((r.lines, r.completed_at) for r in join_stats_state(stats, state).collect())
    assert by_name == [(1, 50), (2, 50), (3, 50), (4, 40)]  # one row for each, the latest time


def test_malformed_alignments_are_returned(spark):
    line = lambda entries: '{"tiers": {"words": {"entries": ' + entries + "}}}"
    rows = [
        ("ok", line('[["0.5", "1.25", "a"], [2, 3, "b"]]')), ("time", line('[["x", "1", "a"], ["1", "2", "b"], ["1", "1e300", "c"]]')),
        ("short", line('[["1", "2"]]')), ("empty", line("[]")), ("text", "no json"), ("null", None), ("other", '{"a": 1}'),
    ]
    df = spark.createDataFrame(rows, "utt string, line string")
    good = sorted((r.utt, r.pos, r.word, r.start_ms, r.end_ms) for r in S.read_alignment(df).collect())
    assert good == [("ok", 0, "a", 500, 1250), ("ok", 1, "b", 2000, 3000), ("time", 1, "b", 1000, 2000)]
    bad = sorted((r.utt, r.pos if r.pos is not None else -1, r.entry or "") for r in S.bad_alignment(df).collect())
    assert bad == [("null", -1, ""), ("other", -1, '{"a": 1}'), ("short", 0, '["1","2"]'), ("text", -1, "no json"),
                   ("time", 0, '["x","1","a"]'), ("time", 2, '["1","1e300","c"]')]
