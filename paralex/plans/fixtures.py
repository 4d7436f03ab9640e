"""Inputs of the registered queries, derived from the given tables.

Every input covers its whole table and whole texts.  A fixture is one piece of
SQL text that runs unchanged in Spark and in the checking engine; ``{name}``
refers to a table or to another fixture.  Where the engines spell a function
differently the entry is a pair.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()

ACCENTED = "èéêëàâçîïôùûÈÉÊÀÂÇÎÔÛÄÖÜäöüßñÑóÓíÍáÁúÚ"
FOLDED = "eeeeaaciiouuEEEAACIOUAOUaousnNoOiIaAuU"

# One row per line of every document.
_LINES = (
    "SELECT doc_id, lang, source, line_no, line FROM {documents} "
    "LATERAL VIEW posexplode(split(text, '\\n')) AS line_no, line",
    "SELECT doc_id, lang, source, CAST(i AS INTEGER) AS line_no, l[i + 1] AS line FROM ("
    "SELECT doc_id, lang, source, string_split(text, chr(10)) AS l, "
    "unnest(range(len(string_split(text, chr(10))))) AS i FROM {documents})",
)

# Wide parallel rows: the first three lines and the remaining text of a document
# stand for four languages; a short document lacks the later ones.  (The views
# keep Spark from cutting the text again for every use of a column.)
_PARALLEL = (
    "SELECT concat('p-', doc_id) AS id, doc_id, source, x.en, x.fr, x.de, x.es FROM {documents} LATERAL VIEW "
    "explode(transform(array(split(text, '\\n', 4)), l -> named_struct('en', l[0], 'fr', coalesce(get(l, 1), ''), "
    "'de', coalesce(get(l, 2), ''), 'es', coalesce(get(l, 3), '')))) AS x",
    "SELECT concat('p-', CAST(doc_id AS STRING)) AS id, doc_id, source, en, fr, de, "
    "substr(text, CAST(length(en) + length(fr) + length(de) + 4 AS INT)) AS es FROM (SELECT doc_id, source, text, "
    "split_part(text, chr(10), 1) AS en, split_part(text, chr(10), 2) AS fr, split_part(text, chr(10), 3) AS de "
    "FROM {documents}) d",
)

# Decoded answers: bold label, continuation lines, a repeated label, annotation
# lines, some answers without labels and some empty.
_ANSWER = """
  CASE WHEN length(en) % 19 = 0 THEN ''
       WHEN length(en) % 17 = 0 THEN concat('no labels here', chr(10), en, chr(10), fr)
       ELSE concat('Sure: see below', chr(10), '**English:** ', en, chr(10), 'second line', chr(10),
         CASE WHEN fr <> '' THEN concat('French: ', fr, chr(10)) ELSE '' END,
         CASE WHEN de <> '' THEN concat(' German :', de, chr(10)) ELSE '' END,
         CASE WHEN es <> '' THEN concat('Spanish: ', es, chr(10)) ELSE '' END,
         CASE WHEN length(en) % 5 = 0 THEN concat('German: repeat ', en, chr(10)) ELSE '' END,
         'Style: *Chat-Casual!*', chr(10), 'and more', chr(10), 'Scene: Speech.') END"""
_RESULT_ROW = """
SELECT concat('part-', source, '.jsonl') AS file_name, id, doc_id, en, fr, de, es, {answer} AS answer,
  CAST(40 + length(en) % 50 AS BIGINT) AS prompt_tokens,
  CAST(10 + length(fr) % 30 AS BIGINT) AS completion_tokens,
  CAST(50 + length(en) % 50 + length(fr) % 30 AS BIGINT) AS total_tokens,
  CAST(1700000000 + doc_id AS BIGINT) AS created
FROM {parallel} """
_RESULTS = (
    _RESULT_ROW.replace("{answer} AS answer", "answer") + f"LATERAL VIEW explode(array({_ANSWER})) AS answer",
    _RESULT_ROW.replace("{answer}", _ANSWER),
)

# Source and normalised text per line: equal, punctuation only, upper case, small
# and large edits, missing.  Accents are folded because the checking engine
# counts edits in bytes.
_NORM = f"""
SELECT concat('utt-', CAST(doc_id AS STRING), '-', CAST(line_no AS STRING)) AS utt, s AS src,
  CASE length(s) % 6 WHEN 0 THEN upper(s) WHEN 1 THEN concat(s, '!,') WHEN 2 THEN concat('xy', s)
    WHEN 3 THEN concat(s, ' and some more') WHEN 4 THEN CAST(NULL AS STRING) ELSE s END AS text
FROM (SELECT doc_id, line_no, translate(line, '{ACCENTED}', '{FOLDED}') AS s FROM {{lines}}) d
"""

# `path text` lines with repeated paths, blank lines and lines of one token.
_LIST = """
SELECT concat(source, '.list') AS file_name, doc_id * 100000 + line_no AS line_no,
  CASE WHEN length(line) % 13 = 0 THEN '' WHEN length(line) % 11 = 0 THEN path
       ELSE concat('  ', path, '  ', line) END AS line
FROM (SELECT source, doc_id, line_no, line,
        concat('/nas/', lang, '/', CAST(doc_id AS STRING), '.wav') AS path FROM {lines}) d
"""

# Job state events, several per file.
_JOBS = """
SELECT concat('part-', lpad(CAST(o_custkey AS STRING), 7, '0'), '.jsonl') AS file_name,
  o_orderkey AS batch_id, concat('in-', CAST(o_orderkey AS STRING)) AS file_id,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'failed' WHEN '2-HIGH' THEN 'in_progress'
    WHEN '3-MEDIUM' THEN (CASE WHEN o_orderstatus = 'F' THEN 'cancelled' ELSE 'expired' END)
    WHEN '4-NOT SPECIFIED' THEN (CASE WHEN o_orderstatus = 'F' THEN 'validating' ELSE 'completed' END)
    ELSE 'completed' END AS status,
  CASE WHEN o_orderstatus = 'P' THEN 'Deleted' ELSE 'processed' END AS file_status,
  o_orderkey AS seq, o_orderdate AS created_at,
  CAST(900000000 + o_orderkey * 61 AS BIGINT) AS completed_at,
  CAST(floor(o_totalprice) AS BIGINT) AS completed
FROM {orders}
"""

FIXTURES: dict[str, str | tuple[str, str]] = {
    "lines": _LINES,
    "parallel": _PARALLEL,
    "results": _RESULTS,
    "norm": _NORM,
    "list": _LIST,
    "jobs": _JOBS,
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _names(sql: str) -> list[str]:
    known = (n for n in re.findall(r"\{(\w+)\}", sql) if n in TABLES or n in FIXTURES)
    return list(dict.fromkeys(known))


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table or derived input as a DataFrame (lazy)."""
    if name not in FIXTURES:
        return table(spark, sf_dir, name)
    sql = FIXTURES[name]
    sql = sql[0] if isinstance(sql, tuple) else sql
    for n in _names(sql):  # views are resolved right away, so names may be reused
        fixture(spark, sf_dir, n).createOrReplaceTempView(f"paralex_{n}")
        sql = sql.replace("{%s}" % n, f"paralex_{n}")
    return spark.sql(sql)


def with_inputs(sql: str) -> str:
    """The checking SQL with the fixtures it names in braces put in front."""
    order: list[str] = []

    def visit(text: str) -> None:
        for name in _names(text):
            if name in FIXTURES and name not in order:
                body = FIXTURES[name]
                visit(body[1] if isinstance(body, tuple) else body)
                order.append(name)

    visit(sql)
    plain = lambda text: reduce(lambda t, n: t.replace("{%s}" % n, n if n in TABLES else f"fx_{n}"), _names(text), text)
    parts = []
    for name in order:
        body = FIXTURES[name]
        parts.append(f"fx_{name} AS ({plain(body[1] if isinstance(body, tuple) else body)})")
    body = plain(sql).strip()
    if not parts:
        return body
    if body.upper().startswith("WITH RECURSIVE "):
        return "WITH RECURSIVE " + ",\n".join(parts) + ",\n" + body[15:]
    if body.upper().startswith("WITH "):
        return "WITH " + ",\n".join(parts) + ",\n" + body[5:]
    return "WITH " + ",\n".join(parts) + "\n" + body
