"""Both sides of converted result lines: every line once, also when a batch repeats."""

import json

from paralex.streaming import jobs


def lines(n):
    answer = lambda t: {"response": {"body": {"choices": [{"message": {"content": t}}]}}}
    out = []
    for i in range(n):
        text = {0: "English: one\nFrench: un", 1: "", 2: None}.get(i % 4)
        out.append(json.dumps({"custom_id": f"id{i}", **answer(text)}) if i % 4 < 3 else '{"custom_id": ')
    return out + [json.dumps({"custom_id": None, **answer("English: x")}), "", None, "[1]"]


def sides(spark, sink, rejected):
    good = sorted((r.batch, r.metadata, r.en, r.fr) for r in spark.read.parquet(sink).collect())
    bad = sorted((r.batch, r.file_name, r.reason, r.line or "") for r in spark.read.parquet(rejected).collect())
    return good, bad


def test_good_and_rejected_are_all_lines(spark, tmp_path):
    sink, rejected = str(tmp_path / "good"), str(tmp_path / "bad")
    texts = lines(40)
    df = spark.createDataFrame([("f", t) for t in texts], "file_name string, line string")
    for _ in range(2):  # the second time replaces the first
        jobs.convert_batch(df, 0, "chat", ["en", "fr"], "d", sink, rejected)
        good, bad = sides(spark, sink, rejected)
        assert len(good) + len(bad) == len(texts)
        assert [g[1:] for g in good] == sorted((f"id{i}", "one", "un") for i in range(0, 40, 4))
        assert sum(b[2] == "empty" for b in bad) == 10 and {b[2] for b in bad} == {"empty", "undecodable"}


def test_a_stream_writes_both_sides(spark, tmp_path):
    texts = [t for t in lines(24) if t]
    for part in range(3):
        folder = tmp_path / "in" / f"file_name=f{part}"
        folder.mkdir(parents=True)
        (folder / "p.txt").write_text("\n".join(texts[part::3]) + "\n")
    sink, rejected = str(tmp_path / "good"), str(tmp_path / "bad")
    read = lambda: jobs.arriving_files(
        spark, str(tmp_path / "in"), "value string, file_name string", "text", per_trigger=1).withColumnRenamed("value", "line")
    jobs.convert_to(read(), "chat", ["en", "fr"], "d", sink, rejected, str(tmp_path / "check"))
    good, bad = sides(spark, sink, rejected)
    assert len(good) + len(bad) == len(texts) and len(good) == 6
    assert len({g[0] for g in good} | {b[0] for b in bad}) == 3  # a folder for each micro-batch
    jobs.convert_to(read(), "chat", ["en", "fr"], "d", sink, rejected, str(tmp_path / "check"))
    assert sides(spark, sink, rejected) == (good, bad)  # nothing new came
    jobs.convert_to(read(), "chat", ["en", "fr"], "d", sink, rejected, str(tmp_path / "lost"))
    again = sides(spark, sink, rejected)
    assert len(again[0]) == len(good) and len(again[1]) == len(bad)  # all batches repeated
