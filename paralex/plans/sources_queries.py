"""Sources and sinks."""

from __future__ import annotations

import re

from pyspark.sql import functions as F
from pyspark.sql import types as T

from paralex.operators import predicates as P
from paralex.operators.sharding import shard_by_rows
from paralex.operators.vocabulary import char_vocabulary
from paralex.plans import aggregates_queries as A
from paralex.plans.fixtures import FIXTURES, fixture as fx, table
from paralex.session import scratch
from paralex.sources import jsonl, parts, sinks
from paralex.sources import text as S
from paralex.sources.results import read_results

FIXTURES["json_lines"] = """
SELECT event_id, event_type AS file_name, CASE event_type WHEN 'error' THEN substr(props, 1, length(props) - 1)
  WHEN 'signup' THEN concat('x', props) ELSE props END AS line FROM {events}
"""
FIXTURES["alignment"] = (
    "SELECT concat(conv_id, '-', turn) AS utt, concat('{\"tiers\":{\"words\":{\"entries\":[', array_join(transform("
    "split(text, '[ \\n]+'), (w, i) -> concat('[', i div 5, '.', i % 5 * 2, ',', i div 5, '.', i % 5 * 2, '81,', "
    "substr(to_json(array(w)), 2, length(to_json(array(w))) - 2), ']')), ','), ']}}}') AS line FROM {conversations}",
    "SELECT concat(conv_id, '-', turn) AS utt, concat('{\"tiers\":{\"words\":{\"entries\":[', array_to_string(list_transform("
    "regexp_split_to_array(text, '[ \\n]+'), lambda w, i: concat('[', (i - 1) // 5, '.', (i - 1) % 5 * 2, ',', (i - 1) // 5, '.', (i - 1) % 5 * 2, '81,', "
    "CAST(to_json(w) AS VARCHAR), ']')), ','), ']}}}') AS line FROM {conversations}",
)
_CHAT = """SELECT file_name, CASE WHEN length(en) % 23 = 0 THEN concat('{"custom_id": ', id) ELSE CAST(to_json({struct}(
  'custom_id' {eq} id, 'response' {eq} {struct}('body' {eq} {struct}('choices' {eq} {arr}({struct}('message' {eq} {struct}('content' {eq} answer))),
  'usage' {eq} {struct}('prompt_tokens' {eq} prompt_tokens, 'completion_tokens' {eq} completion_tokens, 'total_tokens' {eq} total_tokens),
  'created' {eq} created)))) AS STRING) END AS line FROM {results}"""
_ROLE = """SELECT file_name, CASE WHEN length(en) % 23 = 0 THEN 'no json' ELSE CAST(to_json({struct}(
  'id' {eq} id, 'messages' {eq} {arr}({struct}('role' {eq} 'system', 'content' {eq} 'be brief'), {struct}('role' {eq} 'user', 'content' {eq} en)),
  'output' {eq} {struct}('created' {eq} created, 'choices' {eq} {arr}({struct}('message' {eq} {struct}('content' {eq} answer))),
  'usage' {eq} {struct}('prompt_tokens' {eq} prompt_tokens, 'completion_tokens' {eq} completion_tokens, 'total_tokens' {eq} total_tokens)))) AS STRING) END AS line
  FROM {results}"""


def _dialects(sql: str) -> tuple[str, str]:
    spark = sql.replace("{struct}", "named_struct").replace(" {eq}", ",").replace("{arr}", "array")
    duck = sql.replace("{struct}", "struct_pack").replace("{arr}", "list_value")
    return spark, re.sub(r"'(\w+)' \{eq\}", r"\1 :=", duck)


FIXTURES["chat_lines"] = _dialects(_CHAT)
FIXTURES["role_lines"] = _dialects(_ROLE)
FIXTURES["run_logs"] = """
SELECT concat('run-', CAST(o_custkey AS STRING), '.log') AS file_name, o_orderkey * 2 AS line_no,
  concat(CAST(o_orderdate AS STRING), ' | INFO | [Logger] Processed ', CAST(o_custkey + 1 AS STRING), '/', CAST(o_orderkey AS STRING), ' lines.|') AS line FROM {orders}
UNION ALL
SELECT concat('run-', CAST(o_custkey AS STRING), '.log') AS file_name, o_orderkey * 2 + 1 AS line_no,
  CASE WHEN o_orderpriority = '5-LOW' THEN '   ' ELSE
  concat(CAST(o_orderdate AS STRING), ' | ', CASE WHEN o_orderstatus = 'F' THEN 'ERROR' ELSE 'SUCCESS' END,
    ' | job - /log/part_', CAST(o_custkey AS STRING), '.json Total prompt tokens: ', CAST(o_orderkey + 7 AS STRING),
    ' | completion tokens: ', CAST(o_custkey + 3 AS STRING), ' |total tokens: ', CAST(o_orderkey + o_custkey + 10 AS STRING),
    CASE WHEN o_orderpriority = '1-URGENT' THEN ' | num_prompt: n/a' ELSE concat(
    ' | num_prompt: ', CAST(o_custkey * 4 AS STRING), ' | num_response: ', CAST(o_orderkey * 2 AS STRING), ' |') END) END AS line FROM {orders}
"""
FIXTURES["keyed_lines"] = (
    "SELECT doc_id, CASE WHEN lang = 'es' THEN '{}' WHEN source = 'src4' THEN text ELSE "
    "to_json(map(lpad(doc_id, 4, '0'), text)) END AS line FROM {documents}",
    "SELECT doc_id, CASE WHEN lang = 'es' THEN '{}' WHEN source = 'src4' THEN text ELSE "
    "CAST(json_object(lpad(CAST(doc_id AS VARCHAR), 4, '0'), text) AS VARCHAR) END AS line FROM {documents}",
)
# Tree nodes: regions, nations below them and customers as leaves.
FIXTURES["nodes"] = """
SELECT concat('r', CAST(r_regionkey AS STRING)) AS node, CAST(NULL AS STRING) AS parent, r_name AS label FROM {region}
UNION ALL SELECT concat('n', CAST(n_nationkey AS STRING)), concat('r', CAST(n_regionkey AS STRING)), n_name FROM {nation}
UNION ALL SELECT concat('c', CAST(c_custkey AS STRING)), concat('n', CAST(c_nationkey AS STRING)), c_name FROM {customer}
"""

# JSON trees of mixed depth: lines of a document, numbers, lists in lists, empty
# objects; some texts are cut off.
_TREE = (
    "SELECT doc_id, concat('{{\"', lang, '\":{{\"', source, '\":', {lines}, ',\"n\":', CAST(n_chars AS STRING), ',\"deep\":', "
    "repeat('[{{\"k\":', CAST(doc_id % 5 AS INT)), '\"end\"', repeat('}},[]]', CAST(doc_id % 5 AS INT)), '}},\"none\":{{}},\"at\":[null,\"x\"]', "
    "CASE WHEN doc_id % 53 = 7 THEN '' ELSE '}}' END) AS tree FROM {{documents}}"
)
FIXTURES["json_trees"] = (
    _TREE.format(lines="to_json(split(text, '\\n'))"), _TREE.format(lines="CAST(to_json(string_split(text, chr(10))) AS VARCHAR)"))
# The nodes with some that hang on no root: below a missing node, in cycles, and below those.
FIXTURES["torn_nodes"] = """
SELECT * FROM {nodes}
UNION ALL SELECT concat('o', CAST(o_orderkey AS STRING)), CASE o_orderkey % 4 WHEN 0 THEN concat('c', CAST(o_custkey AS STRING))
  WHEN 1 THEN concat('gone', CAST(o_custkey AS STRING)) WHEN 2 THEN concat('o', CAST(o_orderkey AS STRING))
  ELSE concat('o', CAST(o_orderkey - 1 AS STRING)) END, o_orderstatus FROM {orders}
"""

# Complete parts of three configurations whose parts have the same names; some
# names stand for no file, and some are no part.
FIXTURES["ledgers"] = """
SELECT DISTINCT c.config, concat('part=part-', source, CASE WHEN c.config = 'c' AND length(source) = 4 THEN '.json' ELSE '.jsonl' END) AS name
FROM {documents} d JOIN (SELECT 'a' AS config, 0 AS odd UNION ALL SELECT 'b', 1 UNION ALL SELECT 'c', 0 UNION ALL SELECT 'c', 1) c
  ON length(source) % 2 = c.odd
UNION ALL SELECT 'b', concat('part=lost-', r_name, '.jsonl') FROM {region}
"""

PART = T.StructType([T.StructField(c, T.StringType()) for c in ("id", "en", "fr")])
CONFIGS = ("a", "b", "c")


def written_parts(s, d):
    """Folders of parts and ledger files of three configurations."""
    path = scratch(s, "parts")
    config = F.element_at(F.array(*map(F.lit, CONFIGS)), (F.col("doc_id") % 3 + 1).cast("int"))
    fx(s, d, "parallel").select(
        config.alias("config"), F.concat(F.lit("part-"), "source", F.lit(".jsonl")).alias("part"),
        F.to_json(F.struct("id", "en", "fr")).alias("value"),
    ).repartition("config", "part").write.partitionBy("config", "part").text(path)
    names = F.map_from_entries(F.collect_list(F.struct("name", F.lit("done").alias("state"))))
    ledger = scratch(s, "ledgers")
    fx(s, d, "ledgers").groupBy("config").agg(F.to_json(names).alias("value")).repartition("config").write.partitionBy("config").text(ledger)
    at = lambda root: {c: f"{root}/config={c}" for c in CONFIGS}
    return at(path), parts.read_ledgers(s, at(ledger))


def numbered_lines(s, d):
    """Raw lines written as files of shards, numbered by their place in the files."""
    path = scratch(s, "lines")
    sinks.write_sharded(shard_by_rows(fx(s, d, "raw"), 5000, first=1).select("file_name", "shard", "line_no", "line"), path)
    rows = S.read_numbered_lines(s, path, schema="value string, file_name string, shard bigint")
    return rows.select("file_name", "shard", "pos", F.col("value").alias("line"))


def counted(s, d):
    """Valid pairs written, with the counts of the pass that wrote them."""
    path, valid = scratch(s, "pairs"), P.is_valid_pair("en", "es", "wav_path", "ñÑ")
    ok = F.coalesce(valid, F.lit(False))
    counters = {"total": F.count(F.lit(1)), "valid": F.count_if(ok), "invalid": F.count_if(~ok), "chars": F.sum(F.length("en").cast("bigint"))}
    seen = sinks.write_counted(fx(s, d, "wide"), path, counters, valid)
    found = s.read.parquet(path).agg(F.count(F.lit(1)).alias("written"))
    return found.select(*[F.lit(seen[c]).cast("bigint").alias(c) for c in counters], "written")


def completed(s, d):
    folders, ledger = written_parts(s, d)
    return parts.read_completed(s, folders, ledger, PART)[0].select("config", "file_name", "id", "en", "fr")


def missing(s, d):
    folders, ledger = written_parts(s, d)
    return parts.missing_parts(parts.list_parts(s, folders), ledger)


EVENT = T.StructType([T.StructField("k", T.LongType())])


def tolerant(s, d):
    rows = jsonl.decode_jsonl(fx(s, d, "json_lines"), EVENT)
    return rows.select("event_id", "file_name", F.when(~F.col("bad"), F.col("row.k")).alias("k"), "bad")


def results(s, d):
    chat = read_results(fx(s, d, "chat_lines"), "chat").withColumn("dialect", F.lit("chat"))
    role = read_results(fx(s, d, "role_lines"), "role").withColumn("dialect", F.lit("role"))
    sent = F.array_join(F.transform("messages", lambda m: m["content"]), "|")
    return chat.unionByName(role).withColumn("messages", sent)


def tree(s, d):
    docs = table(s, d, "documents").select("doc_id", F.create_map(
        F.col("lang"), F.create_map(F.col("source"), F.split("text", "\n"),
                                    F.lit("words"), F.split("text", "[ \n]+"))).alias("tree"))
    return S.flatten_tree(docs).select("doc_id", F.col("_j").alias("branch"), F.col("_k").alias("leaf"), "topic")


def sharded(s, d):
    shards = shard_by_rows(fx(s, d, "raw"), 200)
    return sinks.write_sharded(shards, scratch(s, "shards"))


QUERIES = {
    "scan_jsonl_tolerant": tolerant,
    "scan_list_file": lambda s, d: S.parse_list(fx(s, d, "list"), "last").select("file_name", "id", "text"),
    "scan_list_rows": lambda s, d: S.parse_list(fx(s, d, "list")).select("file_name", "line_no", "id", "text"),
    "scan_marked_blocks": lambda s, d: S.read_blocks(
        fx(s, d, "blocks"), "test48:", keep=["file_name", "doc_id"]),
    "scan_word_alignment": lambda s, d: S.read_alignment(fx(s, d, "alignment")),
    "scan_batch_results": results,
    "scan_bad_run_logs": lambda s, d: S.bad_run_logs(fx(s, d, "run_logs")),
    "scan_run_logs": lambda s, d: S.read_run_logs(fx(s, d, "run_logs")),
    "scan_keyed_prompts": lambda s, d: S.read_keyed_prompts(fx(s, d, "keyed_lines")),
    "scan_completed_parts": completed,
    "scan_missing_parts": missing,
    "scan_topic_tree": tree,
    "scan_topic_paths": lambda s, d: S.flatten_paths(fx(s, d, "nodes")),
    "scan_json_tree": lambda s, d: S.flatten_json(fx(s, d, "json_trees")).select(
        "doc_id", F.array_join("place", ".").alias("place"), "topic"),
    "scan_json_tree_bad": lambda s, d: S.bad_trees(fx(s, d, "json_trees")).select("doc_id"),
    "scan_torn_paths": lambda s, d: S.tree_paths(fx(s, d, "torn_nodes"))[0],
    "scan_torn_paths_rejected": lambda s, d: S.tree_paths(fx(s, d, "torn_nodes"))[1],
    "scan_numbered_lines": numbered_lines,
    "sink_counted_rows": counted,
    "sink_sharded_jsonl": sharded,
    "sink_metrics_table": lambda s, d: sinks.write_report(A.usage_report(s, d), scratch(s, "report")),
    "sink_vocab": lambda s, d: sinks.write_vocabulary(
        char_vocabulary(fx(s, d, "documents"), "text", "a-zà-ÿ", 5000, "doc_id"), scratch(s, "vocab")),
}

ORACLE = {
    "scan_jsonl_tolerant":
        "SELECT event_id, file_name, CASE WHEN json_valid(line) THEN CAST(json_extract(line, '$.k') AS BIGINT) END AS k, "
        "NOT json_valid(line) AS bad FROM {json_lines}",
    "scan_list_rows":
        "SELECT file_name, line_no, split_part(trim(line), ' ', 1) AS id, "
        "trim(substr(trim(line), length(split_part(trim(line), ' ', 1)) + 1)) AS text FROM {list} "
        "WHERE contains(trim(line), ' ')",
    "scan_list_file": """
      WITH r AS (SELECT file_name, line_no, split_part(trim(line), ' ', 1) AS id,
        trim(substr(trim(line), length(split_part(trim(line), ' ', 1)) + 1)) AS text FROM {list} WHERE contains(trim(line), ' '))
      SELECT file_name, id, arg_max(text, line_no) AS text FROM r GROUP BY file_name, id""",
    "scan_marked_blocks": """
      SELECT * FROM (SELECT file_name, doc_id, unnest(range(len(bs))) - 1 AS block_no, unnest(bs) AS block
        FROM (SELECT file_name, doc_id, string_split(body, 'test48:') AS bs FROM {blocks})) WHERE block <> ''""",
    "scan_word_alignment": """
      SELECT utt, unnest(range(len(es))) AS pos, json_extract_string(unnest(es), '$[2]') AS word,
        CAST(floor(CAST(json_extract(unnest(es), '$[0]') AS DOUBLE) * 1000) AS INTEGER) AS start_ms,
        CAST(floor(CAST(json_extract(unnest(es), '$[1]') AS DOUBLE) * 1000) AS INTEGER) AS end_ms
      FROM (SELECT utt, CAST(json_extract(line, '$.tiers.words.entries') AS JSON[]) AS es FROM {alignment})""",
    "scan_batch_results": """
      SELECT file_name, json_extract_string(line, '$.custom_id') AS id, json_extract_string(line, '$.response.body.choices[0].message.content') AS answer,
        CAST(json_extract(line, '$.response.body.usage.prompt_tokens') AS BIGINT) AS prompt_tokens,
        CAST(json_extract(line, '$.response.body.usage.completion_tokens') AS BIGINT) AS completion_tokens,
        CAST(json_extract(line, '$.response.body.usage.total_tokens') AS BIGINT) AS total_tokens,
        CAST(json_extract(line, '$.response.body.created') AS BIGINT) AS created, NULL AS messages, 'chat' AS dialect
      FROM (SELECT * FROM {chat_lines} WHERE json_valid(line)) WHERE json_extract_string(line, '$.response.body.choices[0].message.content') <> ''
      UNION ALL
      SELECT file_name, json_extract_string(line, '$.id'), json_extract_string(line, '$.output.choices[0].message.content'),
        CAST(json_extract(line, '$.output.usage.prompt_tokens') AS BIGINT), CAST(json_extract(line, '$.output.usage.completion_tokens') AS BIGINT),
        CAST(json_extract(line, '$.output.usage.total_tokens') AS BIGINT), CAST(json_extract(line, '$.output.created') AS BIGINT),
        concat(json_extract_string(line, '$.messages[0].content'), '|', json_extract_string(line, '$.messages[1].content')), 'role'
      FROM (SELECT * FROM {role_lines} WHERE json_valid(line))""",
    "scan_run_logs": """
      WITH t AS (SELECT file_name, line, row_number() OVER (PARTITION BY file_name ORDER BY line_no DESC) AS r FROM {run_logs} WHERE trim(line) <> ''),
        p AS (SELECT max(CASE WHEN r = 1 THEN line END) AS l, max(CASE WHEN r = 2 THEN line END) AS b FROM t WHERE r <= 2 GROUP BY file_name),
        v AS (SELECT trim(split_part(l, '|', 1)) AS finish_time, regexp_extract(l, '([^/]+\\.json)', 1) AS file_name,
          TRY_CAST(regexp_extract(b, 'Processed (\\d+)/', 1) AS BIGINT) AS lines, TRY_CAST(regexp_extract(l, 'total tokens: (\\d+)', 1) AS BIGINT) AS total_tokens,
          TRY_CAST(regexp_extract(l, 'prompt tokens: (\\d+)', 1) AS BIGINT) AS send_tokens, TRY_CAST(regexp_extract(l, 'completion tokens: (\\d+)', 1) AS BIGINT) AS receive_tokens,
          TRY_CAST(regexp_extract(l, 'num_prompt: (\\d+)', 1) AS BIGINT) AS send_chars, TRY_CAST(regexp_extract(l, 'num_response: (\\d+)', 1) AS BIGINT) AS receive_chars
          FROM p WHERE trim(split_part(l, '|', 2)) = 'SUCCESS' AND contains(b, 'Processed ')),
        g AS (SELECT * FROM v WHERE send_chars IS NOT NULL AND receive_chars IS NOT NULL)
      SELECT *, CAST(total_tokens AS DOUBLE) / greatest(lines, 1) AS tokens_per_line,
        CAST(receive_tokens AS DOUBLE) / greatest(send_tokens, 1) AS receive_send_ratio,
        CAST(total_tokens AS DOUBLE) / greatest(send_chars + receive_chars, 1) AS tokens_chars_ratio FROM g""",
    "scan_bad_run_logs": """
      WITH t AS (SELECT file_name, line, row_number() OVER (PARTITION BY file_name ORDER BY line_no DESC) AS r FROM {run_logs} WHERE trim(line) <> ''),
        p AS (SELECT file_name, max(CASE WHEN r = 2 THEN line END) AS line_before, max(CASE WHEN r = 1 THEN line END) AS last_line FROM t WHERE r <= 2 GROUP BY file_name)
      SELECT * FROM p WHERE trim(split_part(last_line, '|', 2)) = 'SUCCESS' AND contains(line_before, 'Processed ') AND last_line LIKE '%n/a'""",
    "scan_keyed_prompts":
        "SELECT doc_id, lpad(CAST(doc_id AS VARCHAR), 4, '0') AS key, json_extract_string(line, '$.' || lpad(CAST(doc_id AS VARCHAR), 4, '0')) AS prompt "
        "FROM (SELECT * FROM {keyed_lines} WHERE json_valid(line)) WHERE line <> '{}'",
    "scan_completed_parts": """
      SELECT l.config, l.name AS file_name, id, en, fr FROM {parallel} p
      JOIN {ledgers} l ON l.name = concat('part=part-', source, '.jsonl') AND l.config = ['a', 'b', 'c'][doc_id % 3 + 1]""",
    "scan_missing_parts": """
      SELECT config, name FROM {ledgers} WHERE name LIKE '%jsonl' AND (config, name) NOT IN
        (SELECT (['a', 'b', 'c'][doc_id % 3 + 1], concat('part=part-', source, '.jsonl')) FROM {documents})""",
    "scan_topic_tree": """
      SELECT doc_id, 0 AS branch, unnest(range(len(l))) AS leaf, concat_ws('-', lang, source, unnest(l)) AS topic
      FROM (SELECT doc_id, lang, source, string_split(text, chr(10)) AS l FROM {documents})
      UNION ALL SELECT doc_id, 1, unnest(range(len(l))), concat_ws('-', lang, 'words', unnest(l))
      FROM (SELECT doc_id, lang, regexp_split_to_array(text, '[ \\n]+') AS l FROM {documents})""",
    "scan_topic_paths": """
      WITH RECURSIVE p AS (SELECT node, label AS topic FROM {nodes} WHERE parent IS NULL
        UNION ALL SELECT n.node, p.topic || '-' || n.label FROM {nodes} n JOIN p ON n.parent = p.node)
      SELECT node, topic FROM p WHERE node NOT IN (SELECT parent FROM {nodes} WHERE parent IS NOT NULL)""",
    "scan_json_tree": """
      WITH RECURSIVE w AS (SELECT doc_id, CAST(tree AS JSON) AS v, CAST('' AS VARCHAR) AS place, CAST([] AS VARCHAR[]) AS path
          FROM {json_trees} WHERE json_valid(tree)
        UNION ALL SELECT doc_id, CASE WHEN object THEN json_extract(v, concat('$."', k, '"')) ELSE json_extract(v, concat('$[', k, ']')) END,
            concat(place, CASE WHEN place = '' THEN '' ELSE '.' END, i), CASE WHEN object THEN list_append(path, k) ELSE path END
          FROM (SELECT doc_id, v, place, path, json_type(v) = 'OBJECT' AS object, unnest(ks) AS k, unnest(range(len(ks))) AS i
            FROM (SELECT *, CASE WHEN json_type(v) = 'OBJECT' THEN list_sort(json_keys(v))
                ELSE list_transform(range(CAST(json_array_length(v) AS BIGINT)), lambda x: CAST(x AS VARCHAR)) END AS ks FROM w WHERE json_type(v) IN ('OBJECT', 'ARRAY')))),
        l AS (SELECT doc_id, place, CASE WHEN json_type(v) = 'VARCHAR' THEN list_append(path, v ->> '$') ELSE path END AS parts
          FROM w WHERE json_type(v) NOT IN ('OBJECT', 'ARRAY'))
      SELECT doc_id, place, array_to_string(parts, '-') AS topic FROM l WHERE len(parts) > 0""",
    "scan_json_tree_bad": "SELECT doc_id FROM {json_trees} WHERE NOT json_valid(tree)",
    "scan_torn_paths": """
      WITH RECURSIVE p AS (SELECT node, label AS topic FROM {torn_nodes} WHERE parent IS NULL
        UNION ALL SELECT n.node, p.topic || '-' || n.label FROM {torn_nodes} n JOIN p ON n.parent = p.node)
      SELECT node, topic FROM p WHERE node NOT IN (SELECT parent FROM {torn_nodes} WHERE parent IS NOT NULL)""",
    "scan_torn_paths_rejected": """
      WITH RECURSIVE p AS (SELECT node FROM {torn_nodes} WHERE parent IS NULL
        UNION ALL SELECT n.node FROM {torn_nodes} n JOIN p ON n.parent = p.node),
        o AS (SELECT node FROM {torn_nodes} WHERE parent NOT IN (SELECT node FROM {torn_nodes})
        UNION ALL SELECT n.node FROM {torn_nodes} n JOIN o ON n.parent = o.node)
      SELECT node, parent, label, CASE WHEN node IN (SELECT node FROM o) THEN 'orphan' ELSE 'cycle' END AS reason
      FROM {torn_nodes} WHERE node NOT IN (SELECT node FROM p)""",
    "scan_numbered_lines": """
      SELECT file_name, p // 5000 + 1 AS shard, p % 5000 AS pos, line FROM
        (SELECT file_name, line, row_number() OVER (PARTITION BY file_name ORDER BY line_no) - 1 AS p FROM {raw})""",
    "sink_counted_rows": """
      SELECT count(*) AS total, count(*) FILTER (ok) AS valid, count(*) FILTER (NOT ok) AS invalid,
        CAST(sum(length(en)) AS BIGINT) AS chars, count(*) FILTER (ok) AS written FROM
        (SELECT en, NOT regexp_matches(es, '[\\n\\rñÑ]') AND trim(wav_path, ' ' || chr(10)) <> '' AS ok FROM {wide})""",
    "sink_sharded_jsonl": """
      SELECT file_name, p // 200 AS shard, count(*) AS rows, CAST(sum(strlen(line) + 1) AS BIGINT) AS bytes FROM
        (SELECT file_name, line, row_number() OVER (PARTITION BY file_name ORDER BY line_no) - 1 AS p FROM {raw}) GROUP BY ALL""",
    "sink_metrics_table": A.ORACLE["usage_report"],
    "sink_vocab":
        "SELECT concat(ch, ' ', count(*)) AS line FROM (SELECT unnest(regexp_extract_all(text, '[a-zà-ÿ]')) AS ch FROM {documents}) GROUP BY ch",
}
