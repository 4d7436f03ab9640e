"""Joins, set differences and ledgers."""

from __future__ import annotations

from pyspark.sql import functions as F

from paralex.operators import relational as J
from paralex.operators.usage import join_stats_state
from paralex.plans import aggregates_queries as A
from paralex.plans.fixtures import FIXTURES, fixture as fx
from paralex.sources.text import parse_list

# Supplements of some rows, twice for some.
FIXTURES["supplement"] = """
SELECT id AS uuid, doc_id * 2 AS line_no, es AS fr, nullif(en, '') AS de, de AS pt FROM {parallel} WHERE es <> ''
UNION ALL SELECT id AS uuid, doc_id * 2 + 1 AS line_no, concat('again ', fr) AS fr, CAST(NULL AS STRING) AS de, '' AS pt
FROM {parallel} WHERE length(fr) > 100
"""
# Audio files on storage: the documents with a quality label.
FIXTURES["stored"] = """
SELECT concat('/nas/', lang, '/', CAST(d.doc_id AS STRING), '.wav') AS path FROM {documents} d
JOIN {labels} l ON l.doc_id = d.doc_id
"""
# The same file name below several folders.
FIXTURES["folders"] = """
SELECT concat('/data/', event_type, '/', CAST(user_id AS STRING), CASE WHEN value > 50 THEN '.multi' ELSE '.txt' END) AS path FROM {events}
"""


def names(s, d, condition):
    return fx(s, d, "jobs").filter(condition).select("file_name").distinct()


def listed(s, d):
    return parse_list(fx(s, d, "list")).withColumnRenamed("id", "path")


def split_jobs(s, d):
    jobs = fx(s, d, "jobs").select("file_name", "batch_id", "file_id", "status", "seq", "created_at")
    return jobs.filter("created_at < timestamp'1998-01-01'"), jobs.filter("created_at >= timestamp'1998-01-01'")


def states_of_configs(s, d):
    """The same files finished at other times under another configuration, and
    some of them twice."""
    state = A.latest_state(s, d).filter("file_name <> 'part-src3.jsonl'").select("file_name", "completed_at")
    later = lambda n: F.col("completed_at") + n
    return state.withColumn("config", F.lit("chat")).unionByName(
        state.withColumns({"config": F.lit("role"), "completed_at": later(60)})
    ).unionByName(state.filter("file_name = 'part-src1.jsonl'").withColumns({"config": F.lit("role"), "completed_at": later(7)}))


def usage_of_configs(s, d):
    usage = A.usage(s, d)
    both = usage.withColumn("config", F.lit("chat")).unionByName(usage.withColumn("config", F.lit("role")))
    return both.unionByName(usage.withColumn("config", F.lit("new")))


QUERIES = {
    "join_stats_state_configs": lambda s, d: join_stats_state(
        usage_of_configs(s, d), states_of_configs(s, d), ["config"]).select("config", "file_name", "lines", "completed_at"),
    "join_supplement": lambda s, d: J.join_supplement(
        fx(s, d, "wide").select("id", "en", "fr", "de"), fx(s, d, "supplement"), ["fr", "de", "pt"]),
    "join_supplement_missing": lambda s, d: J.join_supplement(
        fx(s, d, "wide").select("id", "en", "fr", "de"), fx(s, d, "supplement"), ["fr", "de"], only_missing=True),
    "join_stats_state": lambda s, d: join_stats_state(
        A.usage(s, d), A.latest_state(s, d).filter("file_name <> 'part-src3.jsonl'")
    ).select("file_name", "lines", "completed_at"),
    "anti_join_resume": lambda s, d: J.pending(
        names(s, d, "true"), names(s, d, "status = 'completed' AND file_status = 'Deleted'")),
    "set_diff_pending": lambda s, d: J.set_diff_pending(
        fx(s, d, "jobs"), [names(s, d, "status = 'expired'"), names(s, d, "status = 'cancelled'")],
        names(s, d, "status = 'validating'")),
    "semi_join_inventory": lambda s, d: J.existing_only(listed(s, d), fx(s, d, "stored")).select(
        "file_name", "line_no", "path", "text"),
    "inventory_report": lambda s, d: J.existence_report(listed(s, d), fx(s, d, "stored")),
    "union_completed": lambda s, d: J.union_parts([
        fx(s, d, "parallel").select("id", "en", "fr"), fx(s, d, "parallel").select("id", "de", "es"),
        fx(s, d, "supplement").select(F.col("uuid").alias("id"), "fr", "de")]),
    "ledger_upsert": lambda s, d: J.ledger_upsert(*split_jobs(s, d), ["file_name"]),
    "ready_to_process": lambda s, d: J.ready_to_process(
        J.ledger_upsert(*split_jobs(s, d), ["file_name"]).withColumn(
            "status", F.when(F.col("status") == "completed", "downloaded").otherwise("pending")),
        names(s, d, "status = 'cancelled'")).select("file_name", "batch_id"),
    "dedupe_first_id": lambda s, d: J.dedupe_first(parse_list(fx(s, d, "list"))),
    "dedupe_first_id_global": lambda s, d: J.dedupe_first(
        fx(s, d, "lines").select(F.col("source").alias("file_name"), "doc_id", "line_no", F.col("line").alias("id")),
        order=["doc_id", "line_no"], scope="global"),
    "dedupe_basename": lambda s, d: J.dedupe_basename(fx(s, d, "folders"), ".multi"),
    "drop_matching_ledger": lambda s, d: J.drop_cancelled(
        J.ledger_upsert(*split_jobs(s, d), ["file_name"]),
        fx(s, d, "jobs").filter("status IN ('in_progress', 'validating')")).select("file_name", "batch_id", "status"),
}

LISTED = """
l AS (SELECT file_name, line_no, split_part(trim(line), ' ', 1) AS path,
  trim(substr(trim(line), length(split_part(trim(line), ' ', 1)) + 1)) AS text FROM {list} WHERE contains(trim(line), ' '))"""
LATEST = "(SELECT file_name, max(seq) AS seq FROM {jobs} GROUP BY file_name)"
SUP = "s AS (SELECT uuid, arg_max({'fr': fr, 'de': de, 'pt': pt}, line_no) AS v FROM {supplement} GROUP BY uuid)"

ORACLE = {
    "join_supplement": f"""WITH {SUP} SELECT w.id, w.en, CASE WHEN uuid IS NULL THEN w.fr ELSE v.fr END AS fr,
      CASE WHEN uuid IS NULL THEN w.de ELSE v.de END AS de, v.pt AS pt, w.id AS uuid FROM {{wide}} w LEFT JOIN s ON s.uuid = w.id""",
    "join_supplement_missing": f"""WITH {SUP} SELECT w.id, w.en, CASE WHEN uuid IS NOT NULL AND coalesce(w.fr, '') = '' THEN v.fr ELSE w.fr END AS fr,
      CASE WHEN uuid IS NOT NULL AND coalesce(w.de, '') = '' THEN v.de ELSE w.de END AS de, w.id AS uuid FROM {{wide}} w LEFT JOIN s ON s.uuid = w.id""",
    "join_stats_state": """
      SELECT r.file_name, count(*) AS lines, CASE WHEN r.file_name = 'part-src3.jsonl' THEN 0 ELSE any_value(m) END AS completed_at
      FROM {results} r JOIN (SELECT file_name, max(created) AS m FROM {results} GROUP BY file_name) t ON t.file_name = r.file_name
      WHERE answer <> '' AND length(en) % 23 <> 0 GROUP BY r.file_name""",
    "join_stats_state_configs": """
      SELECT config, r.file_name, count(*) AS lines, CASE WHEN r.file_name = 'part-src3.jsonl' OR config = 'new' THEN 0
          WHEN config = 'role' THEN any_value(m) + 60 ELSE any_value(m) END AS completed_at
      FROM {results} r JOIN (SELECT file_name, max(created) AS m FROM {results} GROUP BY file_name) t ON t.file_name = r.file_name,
        (SELECT unnest(['chat', 'role', 'new']) AS config) c
      WHERE answer <> '' AND length(en) % 23 <> 0 GROUP BY config, r.file_name""",
    "anti_join_resume": "SELECT file_name FROM {jobs} GROUP BY file_name HAVING NOT bool_or(status = 'completed' AND file_status = 'Deleted')",
    "set_diff_pending": "SELECT file_name FROM {jobs} GROUP BY file_name HAVING NOT bool_or(status IN ('expired', 'cancelled', 'validating'))",
    "semi_join_inventory": f"WITH {LISTED} SELECT * FROM l WHERE path IN (SELECT path FROM {{stored}})",
    "inventory_report": f"""WITH {LISTED} SELECT file_name, count(*) AS total, count(*) FILTER (path IN (SELECT path FROM {{stored}})) AS valid,
      count(*) FILTER (path NOT IN (SELECT path FROM {{stored}})) AS missing FROM l GROUP BY file_name""",
    "union_completed": """
      SELECT id, en, fr, NULL AS de, NULL AS es FROM {parallel} UNION ALL SELECT id, NULL, NULL, de, es FROM {parallel}
      UNION ALL SELECT uuid, NULL, fr, de, NULL FROM {supplement}""",
    "ledger_upsert": f"""SELECT j.file_name, batch_id, file_id, status, j.seq, created_at FROM {{jobs}} j
      JOIN {LATEST} m ON m.file_name = j.file_name AND m.seq = j.seq""",
    "ready_to_process": f"""SELECT j.file_name, batch_id FROM {{jobs}} j JOIN {LATEST} m ON m.file_name = j.file_name AND m.seq = j.seq
      WHERE status = 'completed' AND j.file_name NOT IN (SELECT file_name FROM {{jobs}} WHERE status = 'cancelled')""",
    "dedupe_first_id": f"""WITH {LISTED} SELECT l.file_name, l.line_no, path AS id, text FROM l
      JOIN (SELECT file_name AS f, path AS p, min(line_no) AS n FROM l GROUP BY ALL) m ON f = file_name AND p = path AND n = line_no""",
    "dedupe_first_id_global": """
      SELECT source AS file_name, doc_id, line_no, line AS id FROM
        (SELECT *, row_number() OVER (PARTITION BY line ORDER BY source, doc_id, line_no) AS r FROM {lines}) WHERE r = 1""",
    "dedupe_basename": """
      SELECT string_split(path, '/')[-1] AS base_name, min(path) AS path FROM {folders} WHERE suffix(path, '.multi') GROUP BY 1""",
    "drop_matching_ledger": f"""SELECT j.file_name, batch_id, status FROM {{jobs}} j JOIN {LATEST} m ON m.file_name = j.file_name AND m.seq = j.seq
      WHERE status NOT IN ('in_progress', 'validating')""",
}
