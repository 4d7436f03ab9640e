"""Complete parts of several configurations: only their files are opened."""

import json
import os

from paralex.sources import parts
from pyspark.sql import types as T

ROW = T.StructType([T.StructField("id", T.StringType()), T.StructField("n", T.LongType())])


def write(path, *rows):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.writelines((r if isinstance(r, str) else json.dumps(r)) + "\n" for r in rows)


def configurations(root):
    """Three folders with parts of the same names, one of them a folder itself."""
    for c in "abc":
        write(f"{root}/{c}/parallel/p1.jsonl", {"id": f"{c}1", "n": 1})
        write(f"{root}/{c}/parallel/p2.jsonl", {"id": f"{c}2", "n": 2}, "no json")
        write(f"{root}/{c}/parallel/odd [1]{{x}}*é %20.jsonl", {"id": f"{c}odd", "n": 3})
        write(f"{root}/{c}/parallel/whole.jsonl/part-0", {"id": f"{c}w", "n": 4})
        write(f"{root}/{c}/parallel/whole.jsonl/deep/part-1", {"id": f"{c}v", "n": 5})
        write(f"{root}/{c}/parallel/_hidden.jsonl", {"id": "hidden", "n": 6})
    odd = "odd [1]{x}*é %20.jsonl"
    ledgers = {
        "a": {"p1.jsonl": {"state": 1}, odd: {}, "notes.txt": {}},
        "b": {"p2.jsonl": {}, "whole.jsonl": {}, "lost.jsonl": {}},
        "c": {},
    }
    for c, ledger in ledgers.items():
        write(f"{root}/{c}/ledger.json", json.dumps(ledger, indent=1, ensure_ascii=False))
    return {c: f"{root}/{c}/parallel" for c in "abc"}, {c: f"{root}/{c}/ledger.json" for c in "abc"}


def test_parts_of_three_ledgers(spark, tmp_path):
    folders, files = configurations(str(tmp_path))
    ledger = parts.read_ledgers(spark, files)
    assert sorted(map(tuple, ledger.collect())) == [
        ("a", "odd [1]{x}*é %20.jsonl"), ("a", "p1.jsonl"), ("b", "lost.jsonl"), ("b", "p2.jsonl"), ("b", "whole.jsonl")]
    good, bad = parts.read_completed(spark, folders, ledger, ROW)
    assert sorted((r.config, r.file_name, r.id, r.n) for r in good.collect()) == [
        ("a", "odd [1]{x}*é %20.jsonl", "aodd", 3), ("a", "p1.jsonl", "a1", 1), ("b", "p2.jsonl", "b2", 2),
        ("b", "whole.jsonl", "bv", 5), ("b", "whole.jsonl", "bw", 4)]
    assert [(r.config, r.file_name, r.line) for r in bad.collect()] == [("b", "p2.jsonl", "no json")]
    listing = parts.list_parts(spark, folders)
    assert [tuple(r) for r in parts.missing_parts(listing, ledger).collect()] == [("b", "lost.jsonl")]


def test_unfinished_parts_are_not_opened(spark, tmp_path):
    folders, files = configurations(str(tmp_path))
    lines = parts.completed_lines(parts.list_parts(spark, folders), parts.read_ledgers(spark, files))
    opened = {os.path.relpath(p.replace("file://", ""), str(tmp_path)) for p in lines.inputFiles() if "p1" in p or "p2" in p}
    assert opened == {"a/parallel/p1.jsonl", "b/parallel/p2.jsonl"} and len(lines.inputFiles()) == 5
    for c in "abc":  # files that cannot be opened do no harm, unless they are needed
        for name in ("p1", "p2"):
            if f"{c}/parallel/{name}.jsonl" not in opened:
                write(f"{tmp_path}/{c}/parallel/{name}.jsonl", "poison")
                os.chmod(f"{tmp_path}/{c}/parallel/{name}.jsonl", 0)
    assert lines.filter("line = 'poison'").count() == 0 and lines.count() == 6
    listed = parts.list_parts(spark, folders).filter("name = 'p1.jsonl' AND config = 'a'").first()
    assert listed.bytes == os.path.getsize(f"{tmp_path}/a/parallel/p1.jsonl")


def test_no_complete_part(spark, tmp_path):
    folders, files = configurations(str(tmp_path))
    none = parts.read_ledgers(spark, {"c": files["c"]})
    good, bad = parts.read_completed(spark, folders, none, ROW)
    assert good.count() == 0 and bad.count() == 0 and good.columns == ["config", "file_name", "id", "n"]


def test_a_repeated_name_is_read_once(spark, tmp_path):
    write(f"{tmp_path}/x/a.jsonl", {"id": "1", "n": 1})
    ledger = spark.createDataFrame([("x", "a.jsonl")] * 3 + [(None, None)], "config string, name string")
    assert parts.completed_lines(parts.list_parts(spark, {"x": f"{tmp_path}/x/"}), ledger).count() == 1
