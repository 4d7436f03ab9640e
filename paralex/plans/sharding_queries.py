"""Positions, shards and admission."""

from __future__ import annotations

from pyspark.sql import functions as F

from paralex.operators import predicates as P
from paralex.operators import requests as R
from paralex.operators import sharding as S
from paralex.plans.fixtures import FIXTURES, fixture as fx
from paralex.session import scratch
from paralex.sources import sinks

# Lines of the raw file of each source.
FIXTURES["raw"] = """
SELECT concat(source, '.raw.txt') AS file_name, doc_id * 100000 + line_no AS line_no, line,
  CAST(length(line) + 1 AS BIGINT) AS bytes FROM {lines}
"""
FIXTURES["files"] = """
SELECT file_name, max(created_at) AS mtime FROM (SELECT concat('t_', replace(CAST(o_custkey AS STRING), '0', 'x'), '_',
  CAST(o_custkey AS STRING), '.jsonl') AS file_name, o_orderdate AS created_at FROM {orders}) o GROUP BY file_name
"""


def admit(s, d):
    jobs = fx(s, d, "jobs")
    busy = P.running_jobs(jobs).filter("status = 'validating'")
    slots = jobs.agg(F.floor(F.count(F.lit(1)) / 8).alias("n")).scalar()
    return S.admit_top_k(jobs.filter("status = 'completed'").select("file_name", "batch_id"), busy, slots,
                         ["file_name", "batch_id"])


ROLLED = R.RenderConfig(model="m-1", max_tokens=64)


def request_files(s, d):
    """Lines of raw files to written request files, rolled by their bytes."""
    rows = fx(s, d, "raw").select("file_name", "line_no", F.lit("Translate.").alias("system"), F.col("line").alias("user"))
    return sinks.write_requests(R.roll_requests(rows, ROLLED, max_bytes=40_000, max_rows=300), scratch(s, "requests"))


QUERIES = {
    "request_files": request_files,
    "shard_by_rows": lambda s, d: S.shard_by_rows(fx(s, d, "raw"), 50, first=1).select(
        "file_name", "line_no", "shard", "row_in_shard", "shard_name", "custom_id"),
    "shard_by_bytes": lambda s, d: S.shard_by_bytes(
        fx(s, d, "raw"), max_bytes=20000, max_rows=40
    ).select("file_name", "line_no", "shard", "row_in_shard"),
    "group_files_by_suffix": lambda s, d: S.group_files_by_suffix(fx(s, d, "files").select("file_name"), "task"),
    "assign_even": lambda s, d: S.assign_even(fx(s, d, "files").select("file_name"), 7, ["file_name"]),
    "chunk_fixed": lambda s, d: S.chunk_fixed(fx(s, d, "files").select("file_name"), ["file_name"], 100),
    "admit_top_k": admit,
    "order_oldest_first": lambda s, d: S.order_oldest_first(
        fx(s, d, "jobs").groupBy("file_name").agg(F.max("created_at").alias("mtime")),
        fx(s, d, "jobs").filter("status = 'expired'").select("file_name").distinct(),
        fx(s, d, "jobs").filter("status = 'validating'").select("file_name").distinct(), "mtime"),
    "slice_offset_limit": lambda s, d: S.slice_sorted(fx(s, d, "files").select("file_name"), ["file_name"], 20, 60),
    "sequence_ids": lambda s, d: S.sequence_ids(fx(s, d, "raw")).select("file_name", "line_no", "key"),
}

ORACLE = {
    "shard_by_rows": """
      WITH n AS (SELECT file_name, line_no, row_number() OVER (PARTITION BY file_name ORDER BY line_no) - 1 AS p FROM {raw})
      SELECT file_name, line_no, p // 50 + 1 AS shard, p % 50 AS row_in_shard,
        concat(regexp_replace(file_name, '\\.[^.]*$', ''), '_', lpad(CAST(p // 50 + 1 AS VARCHAR), 3, '0')) AS shard_name,
        concat(file_name, '-', p // 50 + 1, '-', p % 50) AS custom_id FROM n""",
    "shard_by_bytes": """
      WITH g AS (SELECT file_name, list({'at': line_no, 'b': bytes, 'n': 0, 's': -1, 'full': true} ORDER BY line_no) AS xs
             FROM {raw} GROUP BY ALL),
        f AS (SELECT file_name, list_reduce(list_prepend({'out': CAST([] AS STRUCT(line_no BIGINT, shard BIGINT)[]), 'at': CAST(0 AS BIGINT),
              'b': CAST(0 AS BIGINT), 'n': 0, 's': CAST(-1 AS BIGINT), 'full': true},
            list_transform(xs, lambda x: {'out': CAST([] AS STRUCT(line_no BIGINT, shard BIGINT)[]), 'at': x.at, 'b': x.b, 'n': 0, 's': CAST(0 AS BIGINT), 'full': true})),
            lambda a, x: {'out': list_append(a.out, {'line_no': x.at, 'shard': a.s + CASE WHEN a.full THEN 1 ELSE 0 END}), 'at': x.at,
              'b': CASE WHEN a.full THEN x.b ELSE a.b + x.b END, 'n': CASE WHEN a.full THEN 1 ELSE a.n + 1 END,
              's': a.s + CASE WHEN a.full THEN 1 ELSE 0 END,
              'full': (CASE WHEN a.full THEN x.b ELSE a.b + x.b END) >= 20000 OR (CASE WHEN a.full THEN 1 ELSE a.n + 1 END) >= 40}) AS r FROM g),
        u AS (SELECT file_name, unnest(r.out, recursive := true) FROM f)
      SELECT file_name, line_no, shard, row_number() OVER (PARTITION BY file_name, shard ORDER BY line_no) - 1 AS row_in_shard FROM u""",
    "request_files": """
      WITH r AS (SELECT file_name, line_no, strlen(CAST(to_json(struct_pack(custom_id := concat(file_name, '--'), method := 'POST',
            url := '/chat/completions', body := struct_pack(model := 'm-1', messages := [struct_pack(role := 'system', content := 'Translate.'),
              struct_pack(role := 'user', content := line)], max_tokens := 64))) AS VARCHAR)) + 1 AS bytes FROM {raw}),
        g AS (SELECT file_name, list({'out': CAST([] AS STRUCT(shard BIGINT, n BIGINT, b BIGINT)[]), 'b': CAST(bytes AS BIGINT), 'n': CAST(0 AS BIGINT),
            's': CAST(0 AS BIGINT)} ORDER BY line_no) AS xs FROM r GROUP BY file_name),
        f AS (SELECT file_name, list_reduce(list_prepend({'out': CAST([] AS STRUCT(shard BIGINT, n BIGINT, b BIGINT)[]), 'b': CAST(0 AS BIGINT),
            'n': CAST(0 AS BIGINT), 's': CAST(0 AS BIGINT)}, xs), lambda a, x: {
            'out': list_append(a.out, {'shard': a.s, 'n': a.n, 'b': x.b + strlen(CAST(a.s AS VARCHAR)) + strlen(CAST(a.n AS VARCHAR))}),
            'b': CASE WHEN a.b + x.b + strlen(CAST(a.s AS VARCHAR)) + strlen(CAST(a.n AS VARCHAR)) >= 40000 OR a.n + 1 = 300 THEN 0
              ELSE a.b + x.b + strlen(CAST(a.s AS VARCHAR)) + strlen(CAST(a.n AS VARCHAR)) END,
            'n': CASE WHEN a.b + x.b + strlen(CAST(a.s AS VARCHAR)) + strlen(CAST(a.n AS VARCHAR)) >= 40000 OR a.n + 1 = 300 THEN 0 ELSE a.n + 1 END,
            's': CASE WHEN a.b + x.b + strlen(CAST(a.s AS VARCHAR)) + strlen(CAST(a.n AS VARCHAR)) >= 40000 OR a.n + 1 = 300 THEN a.s + 1 ELSE a.s END}).out AS out FROM g),
        u AS (SELECT file_name, unnest(out, recursive := true) FROM f)
      SELECT file_name, shard, CAST(1 AS BIGINT) AS files, count(*) AS rows, CAST(sum(b) AS BIGINT) AS file_bytes,
        concat(file_name, '-', shard, '-0') AS first_id, concat(file_name, '-', shard, '-', count(*) - 1) AS last_id FROM u GROUP BY file_name, shard""",
    "group_files_by_suffix": """
      SELECT file_name, concat('task_', (row_number() OVER (ORDER BY CAST(regexp_extract(file_name, '_(\\d+)\\.', 1) AS BIGINT), file_name) - 1) // 50) AS task_name
      FROM {files}""",
    "assign_even": "SELECT file_name, ntile(7) OVER (ORDER BY file_name) - 1 AS part FROM {files}",
    "chunk_fixed": "SELECT file_name, (row_number() OVER (ORDER BY file_name) - 1) // 100 AS chunk, "
        "(row_number() OVER (ORDER BY file_name) - 1) % 100 AS row_in_chunk FROM {files}",
    "admit_top_k": """
      SELECT file_name, batch_id, slot FROM (SELECT file_name, batch_id, row_number() OVER (ORDER BY file_name, batch_id) AS slot
        FROM {jobs} WHERE status = 'completed')
      WHERE slot <= (SELECT count(*) // 8 FROM {jobs}) - (SELECT count(*) FROM {jobs} WHERE status = 'validating')""",
    "order_oldest_first": """
      SELECT file_name, max(created_at) AS mtime FROM {jobs} GROUP BY file_name
      HAVING NOT bool_or(status IN ('expired', 'validating'))""",
    "slice_offset_limit": "SELECT file_name FROM {files} ORDER BY file_name LIMIT 40 OFFSET 20",
    "sequence_ids": """
      WITH n AS (SELECT file_name, line_no, CAST(row_number() OVER (PARTITION BY file_name ORDER BY line_no) - 1 AS VARCHAR) AS p FROM {raw})
      SELECT file_name, line_no, lpad(p, CAST(greatest(4, length(p)) AS INTEGER), '0') AS key FROM n""",
}
