"""Parsing answers."""

from __future__ import annotations

from pyspark.sql import functions as F

from paralex.operators import responses as X
from paralex.plans.aggregates_queries import PARSED
from paralex.plans.fixtures import FIXTURES, fixture as fx

CODES = ["en", "fr", "de", "es", "style", "scene"]

# Decoded rows of the role dialect; `prompt` is the user message.
FIXTURES["role_translation"] = """
SELECT id, concat('Translate.', chr(10), 'Spanish: ', CASE WHEN length(de) % 3 = 0 THEN '' ELSE de END, chr(10),
  'English: ', en, chr(10), 'French: ') AS prompt, answer, en, de FROM {results}
"""
FIXTURES["role_norm"] = """
SELECT utt AS id, CASE WHEN length(src) % 5 = 0 THEN src ELSE concat('Normalise this', chr(10), src) END AS prompt,
  coalesce(text, '') AS answer, src FROM {norm}
"""
FIXTURES["role_extract"] = (
    "SELECT id, en, fr, concat('Terms of', chr(10), CASE WHEN length(en) % 7 = 0 THEN 'no pair' ELSE "
    "to_json(map('zh-cn', en, 'en', fr)) END, chr(10), '  ') AS prompt, CASE length(en) % 6 WHEN 0 THEN '[]' WHEN 1 THEN 'no json' "
    "WHEN 2 THEN '{\"other\": 1}' WHEN 3 THEN '{\"term\": null}' ELSE concat('{\"term\": {\"en\": ', to_json(array(en, fr)), '}}') END AS answer FROM {parallel}",
    "SELECT id, en, fr, concat('Terms of', chr(10), CASE WHEN length(en) % 7 = 0 THEN 'no pair' ELSE "
    "CAST(json_object('zh-cn', en, 'en', fr) AS VARCHAR) END, chr(10), '  ') AS prompt, CASE length(en) % 6 WHEN 0 THEN '[]' WHEN 1 THEN 'no json' "
    "WHEN 2 THEN '{\"other\": 1}' WHEN 3 THEN '{\"term\": null}' ELSE concat('{\"term\": {\"en\": ', CAST(to_json([en, fr]) AS VARCHAR), '}}') END AS answer FROM {parallel}",
)
# Segmentation answers: groups of four words and the same words with upper-case vowels.
FIXTURES["sst"] = (
    "SELECT utt, concat('```json', chr(10), CASE WHEN n % 7 = 0 THEN substr(j, 1, length(j) - 1) ELSE j END, chr(10), '```') AS answer FROM ("
    "SELECT concat(conv_id, '-', turn) AS utt, length(text) AS n, to_json(transform(sequence(0, (size(w) - 1) div 4), i -> named_struct("
    "'src', if(i = 3 AND length(text) % 5 = 0, '', array_join(slice(w, i * 4 + 1, 4), ' ')), "
    "'tgt', if(i = 3 AND length(text) % 5 = 0, '', translate(array_join(slice(w, i * 4 + 1, 4), ' '), 'aeiou', 'AEIOU'))))) AS j "
    "FROM {conversations} LATERAL VIEW explode(array(split(text, '[ \\n]+'))) t AS w) d",
    "SELECT utt, concat('```json', chr(10), CASE WHEN n % 7 = 0 THEN substr(j, 1, length(j) - 1) ELSE j END, chr(10), '```') AS answer FROM ("
    "SELECT concat(conv_id, '-', turn) AS utt, length(text) AS n, CAST(to_json(list_transform(range((len(w) - 1) // 4 + 1), lambda i: struct_pack("
    "src := CASE WHEN i = 3 AND length(text) % 5 = 0 THEN '' ELSE array_to_string(w[i * 4 + 1:i * 4 + 4], ' ') END, "
    "tgt := CASE WHEN i = 3 AND length(text) % 5 = 0 THEN '' ELSE translate(array_to_string(w[i * 4 + 1:i * 4 + 4], ' '), 'aeiou', 'AEIOU') END))) AS VARCHAR) AS j "
    "FROM (SELECT *, regexp_split_to_array(text, '[ \\n]+') AS w FROM {conversations}) c) d",
)
# Cumulative steps over groups of sixteen words; some steps revise, repeat or only add a mark.
FIXTURES["sst_steps"] = (
    "SELECT utt, array_join(transform(sequence(0, (size(w) - 1) div 16), i -> concat('- [已累积的原文内容]：', "
    "array_join(slice(w, 1, i * 16 + 16), ' '), chr(10), '[已口播译文]：', CASE i % 6 WHEN 2 THEN translate(array_join(slice(w, 1, i * 16), ' '), 'aeiou', 'AEIOU') "
    "WHEN 3 THEN concat('revised ', i) WHEN 4 THEN concat(translate(array_join(slice(w, 1, i * 16 - 32), ' '), 'aeiou', 'AEIOU'), '') "
    "ELSE translate(array_join(slice(w, 1, i * 16 + 16), ' '), 'aeiou', 'AEIOU') END)), chr(10)) AS answer "
    "FROM (SELECT concat(conv_id, '-', turn) AS utt, w FROM {conversations} LATERAL VIEW explode(array(split(text, '[ \\n]+'))) t AS w) c",
    "SELECT utt, array_to_string(list_transform(range((len(w) - 1) // 16 + 1), lambda i: concat('- [已累积的原文内容]：', "
    "array_to_string(w[1:i * 16 + 16], ' '), chr(10), '[已口播译文]：', CASE i % 6 WHEN 2 THEN translate(array_to_string(w[1:i * 16], ' '), 'aeiou', 'AEIOU') "
    "WHEN 3 THEN concat('revised ', i) WHEN 4 THEN concat(translate(array_to_string(w[1:i * 16 - 32], ' '), 'aeiou', 'AEIOU'), '') "
    "ELSE translate(array_to_string(w[1:i * 16 + 16], ' '), 'aeiou', 'AEIOU') END)), chr(10)) AS answer "
    "FROM (SELECT concat(conv_id, '-', turn) AS utt, regexp_split_to_array(text, '[ \\n]+') AS w FROM {conversations}) c",
)


def role_rows(s, d, name):
    """Rows as the reader delivers them, with a system and a user message."""
    message = lambda role, c: F.struct(F.lit(role).alias("role"), c.alias("content"))
    return fx(s, d, name).withColumn(
        "messages", F.array(message("system", F.lit("be brief")), message("user", F.col("prompt"))))


def fill(s, d):
    rows = fx(s, d, "results").withColumn("en", F.lit("")).withColumn("de", F.nullif("de", F.lit("")))
    return X.fill_from_response(rows.withColumn("pt", F.lit("")),
                                {"en": "English", "fr": "French", "de": "German", "es": "Spanish", "pt": "Portuguese"}
                                ).select("id", "en", "fr", "de", "es", "pt")


def pairs(s, d):
    rows = X.parse_sst_pairs(fx(s, d, "sst"))
    return rows.select("utt", F.posexplode("pairs").alias("pos", "p")).select("utt", "pos", "p.src", "p.tgt")


def steps(s, d):
    rows = X.parse_sst_incremental(fx(s, d, "sst_steps"))
    return rows.select("utt", F.posexplode("steps").alias("pos", "p")).select("utt", "pos", "p.src", "p.tgt")


QUERIES = {
    "parse_labelled_response": lambda s, d: X.parse_labelled(fx(s, d, "results").select("id", "answer"), CODES).drop("answer"),
    "parse_labelled_inline": lambda s, d: X.parse_labelled_inline(fx(s, d, "results").select("id", "answer"), CODES[:4]).drop("answer"),
    "fill_missing_from_response": fill,
    "post_translation": lambda s, d: X.post_translation(role_rows(s, d, "role_translation"), CODES),
    "post_topic": lambda s, d: X.topic_sentences(fx(s, d, "documents").select(
        F.col("doc_id").alias("id"), F.replace("text", F.lit(". "), F.lit(" \n ")).alias("answer"))),
    "post_norm": lambda s, d: X.post_norm(role_rows(s, d, "role_norm"), "en"),
    "post_extract": lambda s, d: X.post_extract(role_rows(s, d, "role_extract")),
    "parse_sst_pairs": pairs,
    "parse_sst_incremental": steps,
}

TIDY = "lower(trim(regexp_replace(split_part(txt, chr(10), 1), '[^a-zA-Z0-9,\\s]', '', 'g')))"
WIDE = f"""
  max(CASE WHEN label = 'English' THEN txt END) AS en, max(CASE WHEN label = 'French' THEN txt END) AS fr,
  max(CASE WHEN label = 'German' THEN txt END) AS de, max(CASE WHEN label = 'Spanish' THEN txt END) AS es,
  max(CASE WHEN label = 'Style' THEN {TIDY} END) AS style, max(CASE WHEN label = 'Scene' THEN {TIDY} END) AS scene"""
INLINE = PARSED.replace(", 'Style', 'Scene')", ")").replace("chr(10) ORDER BY i)", "' ' ORDER BY i)")
STEP = "(?s)(?:- )?\\[已累积的原文内容\\]：(.*?)\\n(?:- )?\\[已口播译文\\]：(.*?)(?:\\n|$)"

ORACLE = {
    "parse_labelled_response": f"WITH {PARSED} SELECT id, {WIDE} FROM parsed GROUP BY id",
    "parse_labelled_inline": f"WITH {INLINE} SELECT * EXCLUDE (style, scene) FROM (SELECT id, {WIDE} FROM parsed GROUP BY id)",
    "fill_missing_from_response": """
      WITH l AS (SELECT id, unnest(range(len(ls))) AS i, unnest(ls) AS line FROM (SELECT id, string_split(answer, chr(10)) AS ls FROM {results})),
        v AS (SELECT id, trim(split_part(line, ': ', 1)) AS name, trim(substr(line, strpos(line, ': ') + 2)) AS value, i FROM l WHERE contains(line, ': ')),
        f AS (SELECT id, name, arg_min(value, i) AS value FROM v WHERE value <> '' GROUP BY id, name)
      SELECT r.id, coalesce(max(CASE WHEN name = 'English' THEN value END), '') AS en,
        any_value(CASE WHEN fr <> '' THEN fr END) AS fr0, coalesce(nullif(any_value(fr), ''), max(CASE WHEN name = 'French' THEN value END), '') AS fr,
        nullif(any_value(de), '') AS de, coalesce(nullif(any_value(es), ''), max(CASE WHEN name = 'Spanish' THEN value END), '') AS es, '' AS pt
      FROM {results} r LEFT JOIN f ON f.id = r.id GROUP BY r.id""".replace(
        "any_value(CASE WHEN fr <> '' THEN fr END) AS fr0, ", ""),
    "post_translation": f"""
      WITH {PARSED}, w AS (SELECT id, {WIDE} FROM parsed GROUP BY id)
      SELECT t.id AS wav_path, CASE WHEN t.src = 'en' THEN trim(t.en) ELSE w.en END AS en, w.fr, w.de,
        CASE WHEN t.src = 'es' THEN trim(t.de) ELSE w.es END AS es, w.style, w.scene
      FROM (SELECT *, CASE WHEN length(de) % 3 <> 0 THEN 'es' WHEN trim(en) <> '' THEN 'en' END AS src FROM {{role_translation}}) t LEFT JOIN w ON w.id = t.id""",
    "post_topic": """
      WITH l AS (SELECT doc_id, list_filter(string_split(replace(text, '. ', ' ' || chr(10) || ' '), chr(10)), lambda x: x <> '') AS ls FROM {documents})
      SELECT doc_id AS topic, unnest(range(len(ls))) AS pos, trim(unnest(ls)) AS sentence FROM l""",
    "post_norm":
        "SELECT id AS utt, src, answer AS text FROM (SELECT *, regexp_replace(lower(src), '[^a-z0-9|;:()@/_#$%&*+=<>~`^]', '', 'g') AS a, "
        "regexp_replace(lower(answer), '[^a-z0-9|;:()@/_#$%&*+=<>~`^]', '', 'g') AS b FROM {role_norm}) "
        "WHERE NOT (upper(answer) = answer AND lower(answer) <> answer) "
        "AND CASE WHEN abs(length(a) - length(b)) > 3 THEN false WHEN a = b THEN true ELSE levenshtein(a, b) <= 3 END",
    "post_extract": """
      SELECT id AS wav_path, CASE WHEN length(en) % 7 <> 0 THEN en END AS source, CASE WHEN length(en) % 7 <> 0 THEN fr END AS target,
        CASE WHEN json_type(json_extract(answer, '$.term')) <> 'NULL' THEN CAST(json_extract(answer, '$.term') AS VARCHAR) END AS term
      FROM (SELECT * FROM {role_extract} WHERE json_valid(answer)) WHERE json_type(answer) <> 'OBJECT' OR json_exists(answer, '$.term')""",
    "parse_sst_pairs": """
      WITH j AS (SELECT utt, replace(replace(answer, '```json', ''), '```', '') AS j FROM {sst}),
        p AS (SELECT utt, unnest(range(len(ps))) AS pos, json_extract_string(unnest(ps), '$.src') AS src, json_extract_string(unnest(ps), '$.tgt') AS tgt
          FROM (SELECT utt, CAST(j AS JSON[]) AS ps FROM j WHERE json_valid(j))),
        e AS (SELECT utt, min(pos) AS stop FROM p WHERE src = '' AND tgt = '' GROUP BY utt)
      SELECT p.* FROM p LEFT JOIN e ON e.utt = p.utt WHERE stop IS NULL OR pos < stop""",
    "parse_sst_incremental": f"""
      WITH z AS (SELECT utt, list_transform(list_zip(regexp_extract_all(answer, '{STEP}', 1), regexp_extract_all(answer, '{STEP}', 2)),
             lambda x: {{'src': trim(x[1]), 'tgt': trim(x[2])}}) AS st FROM {{sst_steps}}),
        k AS (SELECT utt, list_reduce(list_prepend(CAST([] AS STRUCT(src VARCHAR, tgt VARCHAR)[]), list_transform(list_reverse(st), lambda x: [x])),
             lambda a, x: CASE WHEN len(a) = 0 OR contains(a[1].tgt, x[1].tgt) THEN list_concat(x, a) ELSE a END) AS c FROM z),
        d AS (SELECT utt, list_transform(range(1, len(c) + 1), lambda i: CASE WHEN i = 1 THEN c[1] ELSE
             {{'src': CASE WHEN starts_with(c[i].src, c[i - 1].src) THEN substr(c[i].src, length(c[i - 1].src) + 1) ELSE c[i].src END,
              'tgt': CASE WHEN starts_with(c[i].tgt, c[i - 1].tgt) THEN substr(c[i].tgt, length(c[i - 1].tgt) + 1) ELSE c[i].tgt END}} END) AS ds FROM k),
        g AS (SELECT utt, i, x, sum(CASE WHEN i = 0 OR x.tgt NOT IN ('', ',', '.', '。', '，') THEN 1 ELSE 0 END) OVER (PARTITION BY utt ORDER BY i) - 1 AS pos
             FROM (SELECT utt, unnest(range(len(ds))) AS i, unnest(ds) AS x FROM d))
      SELECT utt, pos, string_agg(x.src, '' ORDER BY i) AS src, arg_min(x.tgt, i) AS tgt FROM g GROUP BY utt, pos""",
}
