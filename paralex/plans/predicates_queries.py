"""Filters, completion and routing."""

from __future__ import annotations

from pyspark.sql import functions as F

from paralex.operators import predicates as P
from paralex.operators.relational import deep_merge_leaves
from paralex.plans.fixtures import FIXTURES, fixture as fx
from paralex.sources.text import json_leaves

FIXTURES["wide"] = """
SELECT id, source AS path, en, nullif(fr, '') AS fr, nullif(de, '') AS de, es,
  CASE WHEN length(en) % 9 = 0 THEN concat(' ', chr(10)) ELSE id END AS wav_path
FROM {parallel}
"""
FIXTURES["blocks"] = """
SELECT concat(source, '.multi') AS file_name, doc_id, lang, concat(
  'test48:', 'Chinese:', chr(10), '中文：你好，世界', chr(10), chr(10), '!!!', chr(10),
  'As an AI Language Model, here is the Parallel Corpus', chr(10), text, chr(10),
  CASE WHEN n_chars % 4 = 0 THEN '' ELSE concat('日文：これは文です', chr(10)) END,
  'Thai: สวัสดี', chr(10), 'Arabic:', chr(10),
  CASE WHEN lang = 'de' THEN concat('很抱歉, no more', chr(10)) ELSE '' END, 'Korean: 안녕하세요', chr(10), 'end',
  'test48:', 'short block', chr(10), 'dropped') AS body
FROM {documents}
"""
FIXTURES["inventory"] = """
SELECT concat('/data/', regexp_replace(url, '^https?://', ''),
  CASE WHEN length(html) % 4 = 0 THEN '/.hidden_punc_train.list' WHEN length(html) % 4 = 1 THEN '/x/y_punc_train.list'
       WHEN length(html) % 4 = 2 THEN '_punc_train.list' ELSE '.v2.jsonl' END) AS path, page_id
FROM {pages}
"""

NOISE_SQL = """
bl AS (SELECT file_name, doc_id, generate_subscripts(string_split(body, 'test48:'), 1) - 2 AS block_no,
         unnest(string_split(body, 'test48:')) AS body FROM {blocks}),
raw AS (SELECT file_name, doc_id, block_no, body, string_split(body, chr(10)) AS ls FROM bl WHERE body <> ''),
usable AS (SELECT file_name, doc_id, block_no, list_filter(ls, lambda x:
    NOT regexp_full_match(x, '[!-/:-@\\[-`\\{-~]*') AND x NOT IN ('Chinese:', 'Arabic:', 'Thai:', 'Korean:')
    AND NOT contains(lower(x), 'ai language model') AND NOT contains(lower(x), 'parallel corpus')) AS ls
  FROM raw WHERE len(ls) >= 7),
cut AS (SELECT file_name, doc_id, block_no, CASE WHEN list_position(list_transform(ls, lambda x: contains(x, '很抱歉')), true) > 0
    THEN ls[:list_position(list_transform(ls, lambda x: contains(x, '很抱歉')), true) - 1] ELSE ls END AS ls FROM usable)
"""


def usable_blocks(spark, sf):
    from paralex.sources.text import read_blocks

    blocks = read_blocks(fx(spark, sf, "blocks"), "test48:", keep=["file_name", "doc_id"])
    return P.filter_noise_lines(blocks, body="block")


# Nested ledgers of each customer, before and after: objects that grow, shrink, become
# values and the reverse, lists and empty objects.
FIXTURES["ledger_pairs"] = """
SELECT c_custkey, CASE c_custkey % 5 WHEN 0 THEN concat('{"s":{"id":', CAST(c_custkey AS STRING), ',"t":{"a":1,"b":[1,{"c":2}]}},"x":{"y":{"z":1}}}')
    WHEN 1 THEN '{"s":5,"x":{}}' WHEN 2 THEN '{"s":{"t":"v"},"k":{"a":{}}}' WHEN 3 THEN '{}' ELSE '{"s":{"id":{"deep":{"er":"w"}}},"l":[]}' END AS before,
  CASE c_custkey % 7 WHEN 0 THEN '{"s":{"t":{"b":7}},"x":{"y":2}}' WHEN 1 THEN '{"s":{"id":{"deep":3}},"x":{"y":{"w":{"q":1}}}}'
    WHEN 2 THEN concat('{"s":"gone","k":{"a":{"b":', CAST(c_custkey AS STRING), '}}}') WHEN 3 THEN '{"x":{},"s":{}}' WHEN 4 THEN '{"s":{"t":{}},"k":{}}'
    WHEN 5 THEN '{}' ELSE '{"s":{"id":{"deep":{"er":{"most":"y"}}}},"l":{"m":[[1]]}}' END AS after
FROM {customer}
"""


def merged_ledgers(s, d):
    pairs = fx(s, d, "ledger_pairs")
    before, after = (json_leaves(pairs.select("c_custkey", c), c) for c in ("before", "after"))
    merged = deep_merge_leaves(before, after, ["c_custkey"])
    return merged.select("c_custkey", F.array_join("path", "/").alias("path"), "value")


QUERIES = {
    "project_rename_required": lambda s, d: P.project_required(
        fx(s, d, "wide"), {"en": "text", "fr": "zh", "wav_path": "id"}
    ),
    "filter_valid_pair": lambda s, d: P.filter_valid_pair(
        fx(s, d, "wide"), "en", "es", "wav_path", "ñÑ"
    ).select("id", "en", "es", "wav_path"),
    "flag_bad_punctuation": lambda s, d: P.flag_punctuation(
        fx(s, d, "documents"), "text", [".", ","]
    ).select("doc_id", "marks"),
    "filter_noise_lines": lambda s, d: usable_blocks(s, d).select(
        "file_name", "doc_id", "block_no", F.posexplode("lines").alias("pos", "line")
    ),
    "fill_missing_langs": lambda s, d: P.fill_langs(
        fx(s, d, "wide").select("id", "en", "fr", "de", "es"), ["en", "fr", "de", "es", "pt"]
    ),
    "detect_missing_langs": lambda s, d: P.missing_langs(fx(s, d, "wide"), ["en", "fr", "de", "es"]).select(
        "id", "lacks_language", F.array_join("missing", ",").alias("missing")
    ),
    "choose_pivot_lang": lambda s, d: P.pivot_lang(
        fx(s, d, "wide"), ["en", "fr", "de", "es"], ("de", "es")
    ).select("id", "pivot_lang", "pivot_text"),
    "rewrite_paths": lambda s, d: P.rewrite_paths(fx(s, d, "inventory"), "/data", "/mnt/data-2").drop("path"),
    "route_job_state": lambda s, d: P.route_jobs(fx(s, d, "jobs").withColumns({
        "file_name": F.when(F.length("file_id") != 6, F.col("file_name")),
        "status": F.when(F.length("file_id") != 7, F.col("status"))}), "1998-01-01").select(
        "file_name", "batch_id", "status", "route"
    ),
    "add_provenance": lambda s, d: P.add_provenance(
        fx(s, d, "parallel").select("id", "en"), "corpus_a", "id"
    ),
    "deep_merge_config": lambda s, d: P.deep_merge(
        fx(s, d, "jobs").filter("created_at < timestamp'1999-01-01'").select(
            "file_name", "batch_id", F.explode(F.create_map(
                F.lit("status"), "status", F.lit("file_status"), "file_status")).alias("field", "value")),
        fx(s, d, "jobs").filter("created_at >= timestamp'1996-01-01'").select(
            "file_name", "batch_id", F.explode(F.create_map(
                F.lit("status"), F.when(F.col("status") != "failed", "archived"),
                F.lit("completed"), F.col("completed").cast("string"))).alias("field", "value")),
        ["file_name", "batch_id", "field"],
    ),
    "deep_merge_ledgers": merged_ledgers,
    "filter_file_inventory": lambda s, d: P.filter_inventory(
        fx(s, d, "inventory"), 2, "_punc_train.list", "/data"
    ),
}

ORACLE = {
    "project_rename_required":
        "SELECT en AS text, fr AS zh, wav_path AS id FROM {wide} "
        "WHERE en IS NOT NULL AND fr IS NOT NULL AND wav_path IS NOT NULL",
    "filter_valid_pair":
        "SELECT id, en, es, wav_path FROM {wide} WHERE es IS NOT NULL AND en IS NOT NULL "
        "AND NOT regexp_matches(es, '[\\n\\rñÑ]') AND trim(wav_path, ' ' || chr(10)) <> ''",
    "flag_bad_punctuation":
        "SELECT doc_id, string_agg(DISTINCT c, '' ORDER BY c) AS marks FROM (SELECT doc_id, "
        "unnest(regexp_extract_all(text, '[^\\p{L}\\p{N}_\\s]')) AS c FROM {documents}) "
        "WHERE c NOT IN ('.', ',') GROUP BY doc_id",
    "filter_noise_lines": f"WITH {NOISE_SQL} SELECT file_name, doc_id, block_no, "
        "unnest(range(len(ls))) AS pos, unnest(ls) AS line FROM cut WHERE len(ls) > 0",
    "fill_missing_langs":
        "SELECT id, en, coalesce(fr, '') AS fr, coalesce(de, '') AS de, es, '' AS pt, id AS uuid FROM {wide}",
    "detect_missing_langs":
        "SELECT id, coalesce(en,'')='' OR fr IS NULL OR de IS NULL OR es='' AS lacks_language, "
        "concat_ws(',', CASE WHEN en='' THEN 'en' END, CASE WHEN fr IS NULL THEN 'fr' END, "
        "CASE WHEN de IS NULL THEN 'de' END, CASE WHEN es='' THEN 'es' END) AS missing FROM {wide}",
    "choose_pivot_lang":
        "SELECT id, CASE WHEN de IS NOT NULL THEN 'de' WHEN es <> '' THEN 'es' WHEN fr IS NOT NULL THEN 'fr' "
        "WHEN en <> '' THEN 'en' END AS pivot_lang, coalesce(de, nullif(es,''), fr, nullif(en,'')) AS pivot_text FROM {wide}",
    "rewrite_paths":
        "SELECT page_id, replace(path, '/data', '/mnt/data-2') AS new_path, "
        "ltrim(replace(path, '/data', '/mnt/data-2'), '/') AS object_key, "
        "string_split(path, '/')[-1] AS base_name, "
        "replace(replace(replace(string_split(path, '/')[-1], '.jsonl', ''), '.json', ''), '.', '-') AS table_id, "
        "replace(replace(string_split(path, '/')[-1], '-', '_'), '.', '_') AS dataset_id FROM {inventory}",
    "route_job_state":
        "SELECT file_name, batch_id, status, CASE WHEN file_name IS NULL THEN 'cancel' WHEN status IN ('completed', 'expired') THEN "
        "CASE WHEN file_status = 'Deleted' THEN 'skip' ELSE 'download' END ELSE 'wait' END AS route FROM (SELECT batch_id, file_status, created_at, "
        "CASE WHEN length(file_id) <> 6 THEN file_name END AS file_name, CASE WHEN length(file_id) <> 7 THEN status END AS status FROM {jobs}) j "
        "WHERE (status IS NULL OR status NOT IN ('failed', 'cancelled', 'cancelling')) AND created_at >= TIMESTAMP '1998-01-01'",
    "add_provenance":
        "SELECT id, en, 'corpus_a' AS dataset, md5('corpus_a/' || id) AS uuid, id AS metadata FROM {parallel}",
    "deep_merge_config": """
      WITH o AS (SELECT file_name, batch_id, unnest(['status', 'file_status']) AS field,
             unnest([status, file_status]) AS value FROM {jobs} WHERE created_at < TIMESTAMP '1999-01-01'),
           n AS (SELECT file_name, batch_id, unnest(['status', 'completed']) AS field,
             unnest([CASE WHEN status <> 'failed' THEN 'archived' END, CAST(completed AS VARCHAR)]) AS value
             FROM {jobs} WHERE created_at >= TIMESTAMP '1996-01-01')
      SELECT * FROM n UNION ALL SELECT o.* FROM o ANTI JOIN n USING (file_name, batch_id, field)""",
    "deep_merge_ledgers": """
      WITH RECURSIVE w AS (SELECT c_custkey, json_merge_patch(CAST(before AS JSON), CAST(after AS JSON)) AS v, CAST('' AS VARCHAR) AS path FROM {ledger_pairs}
        UNION ALL SELECT c_custkey, json_extract(v, concat('$."', k, '"')), concat(path, CASE WHEN path = '' THEN '' ELSE '/' END, k)
          FROM (SELECT c_custkey, v, path, unnest(json_keys(v)) AS k FROM w WHERE json_type(v) = 'OBJECT'))
      SELECT c_custkey, path, CAST(v AS VARCHAR) AS value FROM w WHERE json_type(v) <> 'OBJECT' OR len(json_keys(v)) = 0""",
    "filter_file_inventory":
        "SELECT path, page_id FROM {inventory} WHERE len(string_split(path, '/')) <= 5 "
        "AND suffix(path, '_punc_train.list') AND NOT prefix(string_split(path, '/')[-1], '.')",
}
