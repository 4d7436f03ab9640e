"""Streaming jobs over several micro-batches."""

from paralex.session import scratch
from paralex.streaming import jobs as S

SCHEMA = "id bigint, ts timestamp"


def land(spark, path, rows):
    spark.createDataFrame(rows, "id bigint, t string").selectExpr("id", "cast(t as timestamp) ts").coalesce(1).write.mode(
        "append").parquet(path)


def test_files_are_read_once_across_runs(spark):
    path, sink, mark = (scratch(spark, x) for x in ("in", "out", "cp"))
    for i in range(3):
        land(spark, path, [(i, "2024-01-01 00:00:00")])
        S.append_to(S.arriving_files(spark, path, SCHEMA), sink, mark)
    S.append_to(S.arriving_files(spark, path, SCHEMA), sink, mark)
    assert sorted(r.id for r in spark.read.parquet(sink).collect()) == [0, 1, 2]


def test_rows_later_than_the_watermark_are_dropped(spark):
    path, sink, mark = (scratch(spark, x) for x in ("in", "out", "cp"))
    for rows in ([(1, "2024-01-01 00:00:00")], [(2, "2024-01-10 00:00:00")], [(3, "2024-01-01 00:00:00")],
                 [(4, "2024-01-09 23:30:00"), (2, "2024-01-10 00:00:00"), (5, "2023-01-01 00:00:00")]):
        land(spark, path, rows)
        events = S.stream_cutoff(S.arriving_files(spark, path, SCHEMA), "2023-06-01", "1 hour", "ts")
        S.append_to(events.dropDuplicatesWithinWatermark(["id"]), sink, mark)
    assert sorted(r.id for r in spark.read.parquet(sink).collect()) == [1, 2, 4]


def test_states_follow_the_highest_sequence(spark):
    path, sink, mark = (scratch(spark, x) for x in ("in", "out", "cp"))
    schema = "file_name string, status string, seq bigint"
    for rows in ([("a", "validating", 1), ("b", "failed", 1)], [("a", "completed", 3)], [("a", "in_progress", 2)]):
        spark.createDataFrame(rows, schema).write.mode("append").parquet(path)
        S.changes_to(S.stream_job_state(S.arriving_files(spark, path, schema), ["status"]), sink, mark)
    got = {r.file_name: r.status for r in S.latest_changes(spark, sink, ["file_name"]).collect()}
    assert got == {"a": "completed", "b": "failed"}


def test_number_of_batches_does_not_grow_with_the_files(spark, tmp_path):
    from paralex.plans.streams_queries import job_state

    rows = spark.range(60).selectExpr(
        "id AS o_orderkey", "id % 7 AS o_custkey", "'1-URGENT' AS o_orderpriority", "'F' AS o_orderstatus",
        "timestamp'1995-01-01' + make_interval(id % 5) AS o_orderdate", "id * 1.5 AS o_totalprice")
    for part in range(5):
        rows.filter(f"o_orderkey % 5 = {part}").coalesce(1).write.mode("append").parquet(f"{tmp_path}/orders.parquet")
    out = job_state(spark, str(tmp_path))
    assert {r.file_name: r.seq for r in out.collect()} == {f"part-{k:07d}.jsonl": max(i for i in range(60) if i % 7 == k) for k in range(7)}
    assert len({p.rsplit("batch=", 1)[1].split("/")[0] for p in out.inputFiles()}) <= 2
