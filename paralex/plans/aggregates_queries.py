"""Usage counters, coverage, vocabularies and counts."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from paralex import fixed_values as V
from paralex.operators import aggregates as G
from paralex.operators import langid as L
from paralex.operators import predicates as P
from paralex.operators import usage as U
from paralex.operators.text import strip_label
from paralex.operators.vocabulary import char_vocabulary, vocabulary_filter
from paralex.plans.fixtures import fixture as fx
from paralex.plans.predicates_queries import NOISE_SQL, usable_blocks
from paralex.session import scratch
from paralex.sources.results import read_results

# Answer text -> one row per label segment, shared by the checks of parsed answers.
# (Kept in the style of the checks: explode lines, running count of labels.)
PARSED = """
ans AS (SELECT file_name, id, answer, string_split(regexp_replace(answer, '\\*\\*(.*?):\\*\\*', '\\1:', 'g'), chr(10)) AS ls
        FROM {results} WHERE answer <> ''),
ln AS (SELECT file_name, id, unnest(range(len(ls))) AS i, unnest(ls) AS line FROM ans),
tag AS (SELECT *, CASE WHEN contains(line, ':') AND trim(split_part(line, ':', 1)) IN
          ('English', 'French', 'German', 'Spanish', 'Style', 'Scene')
          THEN trim(split_part(line, ':', 1)) END AS label FROM ln),
seg AS (SELECT *, sum(CASE WHEN label IS NULL THEN 0 ELSE 1 END)
          OVER (PARTITION BY id ORDER BY i) AS s FROM tag),
body AS (SELECT id, s, max(label) AS label,
          trim(string_agg(CASE WHEN label IS NULL THEN line ELSE substr(line, strpos(line, ':') + 1) END,
               chr(10) ORDER BY i), ' ' || chr(10)) AS txt
         FROM seg WHERE s > 0 GROUP BY id, s),
parsed AS (SELECT id, label, arg_max(txt, s) AS txt FROM body GROUP BY id, label)
"""


def usage(spark, sf):
    """Counters from result lines; malformed lines are not among the results."""
    return U.usage_by_file(read_results(fx(spark, sf, "chat_lines"), "chat"), U.chat_send_chars())


def latest_state(spark, sf):
    """Ledger of the result files: finish times of every second source."""
    return fx(spark, sf, "results").groupBy("file_name").agg(F.max("created").alias("completed_at"))


def usage_report(spark, sf):
    state = latest_state(spark, sf).filter("file_name <> 'part-src3.jsonl'")
    return U.usage_report(U.join_stats_state(usage(spark, sf), state)).orderBy("finish_time", "file_name")


USAGE = """
usage AS (SELECT a.file_name, CAST(sum(prompt_tokens) AS BIGINT) AS send_tokens,
    CAST(sum(completion_tokens) AS BIGINT) AS receive_tokens,
    CAST(sum(total_tokens) AS BIGINT) AS total_tokens,
    CAST(sum(coalesce(length(p.txt), 0)) AS BIGINT) AS send_chars,
    CAST(sum(length(a.answer)) AS BIGINT) AS receive_chars, count(*) AS lines
  FROM {results} a LEFT JOIN parsed p ON p.id = a.id AND p.label = 'English'
  WHERE a.answer <> '' AND length(a.en) % 23 <> 0 GROUP BY a.file_name)
"""


def usage_report_configs(spark, sf):
    """One report over the files of two configurations, one in either dialect."""
    chat = U.usage_by_file(
        read_results(fx(spark, sf, "chat_lines"), "chat").withColumn("config", F.lit("chat")), U.chat_send_chars(), "created", ["config"])
    role = U.usage_by_file(
        read_results(fx(spark, sf, "role_lines"), "role").withColumn("config", F.lit("role")), U.role_send_chars(), "created", ["config"])
    state = latest_state(spark, sf).filter("file_name <> 'part-src3.jsonl'")
    return U.usage_report(U.join_stats_state(chat.unionByName(role), state))


ROLE_USAGE = """
      SELECT file_name, CAST(sum(prompt_tokens) AS BIGINT) AS send_tokens, CAST(sum(completion_tokens) AS BIGINT) AS receive_tokens,
        CAST(sum(total_tokens) AS BIGINT) AS total_tokens, CAST(sum(8 + length(en)) AS BIGINT) AS send_chars,
        CAST(sum(length(answer)) AS BIGINT) AS receive_chars, count(*) AS lines
      FROM {results} WHERE length(en) % 23 <> 0 GROUP BY file_name"""
REPORT = """strftime(make_timestamp((coalesce(completed_at, 0) + 28800) * 1000000), '%Y-%m-%d %H:%M:%S') AS finish_time,
        u.file_name, greatest(lines, 1) AS lines, total_tokens, greatest(send_tokens, 1) AS send_tokens,
        receive_tokens, send_chars, receive_chars,
        CAST(total_tokens AS DOUBLE) / greatest(lines, 1) AS tokens_per_line,
        CAST(receive_tokens AS DOUBLE) / greatest(send_tokens, 1) AS receive_send_ratio,
        CAST(total_tokens AS DOUBLE) / greatest(send_chars + receive_chars, 1) AS tokens_chars_ratio,
        CAST(total_tokens AS DOUBLE) / greatest(receive_chars + greatest(send_tokens, 1), 1) AS tokens_chars_ratio_compat"""
STATE = """state AS (SELECT file_name, max(created) AS completed_at FROM {results}
                WHERE file_name <> 'part-src3.jsonl' GROUP BY file_name)"""

VOCAB = ("text", "a-zà-ÿ", 20, 0.05, "doc_id")
TRAINED = ["de", "en", "es", "fr"]


def detected(spark, sf, rows, keys, text="line"):
    """Language of rows, by profiles trained on the labelled documents."""
    profiles = L.fit_lang_profiles(fx(spark, sf, "documents"), TRAINED, scratch(spark, "profiles"))
    return L.detect_lang(rows, profiles, keys, text)


def block_lines(spark, sf):
    """Usable lines of each block with their languages, as one array per block."""
    keys = ["file_name", "doc_id", "block_no"]
    blocks = usable_blocks(spark, sf).select(*keys, "lines")
    # A line is asked for as it stands and, if it has a label, again without it.
    both = F.flatten(F.transform("lines", lambda x: F.array(x, F.nullif(strip_label(x), x))))
    lines = blocks.select(*keys, F.posexplode(both).alias("pos", "line"))
    # Codes only, and no more of them than twice the lines of the block (one source record).
    langs = F.array_sort(F.collect_list(F.struct("pos", "detected")))
    codes = detected(spark, sf, lines, [*keys, "pos"]).groupBy(*keys).agg(langs.alias("codes"))
    code = lambda i: F.get("codes", i)["detected"]
    joined = F.transform("lines", lambda x, i: F.struct(
        i.alias("pos"), x.alias("line"), code(2 * i).alias("lang"),
        F.when(strip_label(x).eqNullSafe(x), code(2 * i)).otherwise(code(2 * i + 1)).alias("text_lang")))
    return blocks.join(codes, keys).select(*keys, joined.alias("lines"))


def gated(spark, sf):
    return G.min_langs_gate(block_lines(spark, sf), "zh-cn", 5)


QUERIES = {
    "usage_by_file": usage,
    "usage_by_file_role": lambda s, d: U.usage_by_file(
        read_results(fx(s, d, "role_lines"), "role"), U.role_send_chars()),
    "usage_report": usage_report,
    "usage_report_configs": usage_report_configs,
    "lang_coverage": lambda s, d: G.lang_coverage(fx(s, d, "wide"), ["en", "fr", "de", "es"]),
    "char_frequency_topn": lambda s, d: char_vocabulary(fx(s, d, "documents"), "text", "a-zà-ÿ", 20, "doc_id"),
    "vocab_filter": lambda s, d: vocabulary_filter(fx(s, d, "documents"), *VOCAB).select(
        "doc_id", "n_class", "n_missing", "text"),
    "language_id": lambda s, d: detected(
        s, d, fx(s, d, "lines").select("doc_id", "line_no", "line"), ["doc_id", "line_no"]
    ),
    "min_langs_gate": lambda s, d: gated(s, d).select(
        "file_name", "doc_id", "block_no", F.explode("lines").alias("x")
    ).select("file_name", "doc_id", "block_no", "x.pos", "x.lang", "x.line"),
    "concat_by_lang": lambda s, d: G.concat_by_lang(gated(s, d)),
    "validity_counts": lambda s, d: G.validity_counts(
        fx(s, d, "wide"), P.is_valid_pair("en", "es", "wav_path", "ñÑ"), "path"),
    "job_state_counts": lambda s, d: G.job_state_counts(fx(s, d, "jobs")),
    "distinct_subtasks": lambda s, d: G.distinct_subtasks(fx(s, d, "inventory"), "/data"),
}

CHARS = "c AS (SELECT doc_id, generate_subscripts(cs, 1) AS pos, unnest(cs) AS ch FROM (SELECT doc_id, string_split(text, '') AS cs FROM {documents}))"
TOP = """v AS (SELECT ch, count(*) AS cnt, min({'l': doc_id, 'p': pos}) AS f FROM c WHERE regexp_full_match(ch, '[a-zà-ÿ]') GROUP BY ch
  ORDER BY cnt DESC, f LIMIT 20)"""


def profile(scale: int = 1000000) -> str:
    one = lambda c: f"count(*) FILTER (lang = '{c}') AS {c}"
    weight = lambda c: f"CAST(round(ln(CAST({c} + 1 AS DOUBLE) / CAST((SELECT sum({c}) + count(*) FROM pc) AS DOUBLE)) * {scale}) AS BIGINT) AS {c}"
    return f"""
pg AS (SELECT lang, unnest(list_transform(range(1, greatest(len(ls) - 1, 1)), lambda i: ls[i] || ls[i + 1] || ls[i + 2])) AS gram FROM
  (SELECT lang, string_split(lower(regexp_replace(text, '[^\\p{{L}}]+', ' ', 'g')), '') AS ls FROM {{documents}})),
pc AS (SELECT gram, {", ".join(map(one, TRAINED))} FROM pg GROUP BY gram),
prof AS (SELECT gram, {", ".join(map(weight, TRAINED))} FROM pc)"""


def detect(rows: str, keys: str) -> str:
    """CTE `det`: rows of `rows(keys, line)` with `detected`."""
    sums = ", ".join(f"sum({c}) AS {c}" for c in TRAINED)
    guess = " ".join(f"WHEN {c} = greatest({', '.join(TRAINED)}) THEN '{c}'" for c in TRAINED)
    return f"""
dg AS (SELECT {keys}, unnest(list_transform(range(1, greatest(len(ls) - 1, 1)), lambda i: ls[i] || ls[i + 1] || ls[i + 2])) AS gram FROM
  (SELECT {keys}, string_split(lower(regexp_replace(line, '[^\\p{{L}}]+', ' ', 'g')), '') AS ls FROM {rows})),
ds AS (SELECT {keys}, CASE {guess} END AS guess FROM (SELECT {keys}, {sums} FROM dg JOIN prof USING (gram) GROUP BY {keys})),
det AS (SELECT {rows}.*, CASE WHEN regexp_matches(line, '[\\p{{Hiragana}}\\p{{Katakana}}]') THEN 'ja' WHEN regexp_matches(line, '\\p{{Hangul}}') THEN 'ko'
  WHEN regexp_matches(line, '\\p{{Han}}') THEN 'zh-cn' WHEN regexp_matches(line, '\\p{{Thai}}') THEN 'th'
  WHEN regexp_matches(line, '\\p{{Arabic}}') THEN 'ar' ELSE coalesce(guess, 'unknown') END AS detected
  FROM {rows} LEFT JOIN ds USING ({keys}))"""


def gate_sql() -> str:
    return NOISE_SQL + """, bline AS (SELECT file_name, doc_id, block_no, unnest(range(len(ls))) AS pos, unnest(ls) AS line FROM cut),
""" + profile() + "," + detect("bline", "file_name, doc_id, block_no, pos") + f""",
tline AS (SELECT file_name, doc_id, block_no, pos, {label_free('line')} AS line FROM bline)""" + re.sub(
        r"\b(dg|ds|det)\b", r"t\1", "," + detect("tline", "file_name, doc_id, block_no, pos")) + """,
anch AS (SELECT file_name, doc_id, block_no, min(pos) AS a FROM det WHERE detected = 'zh-cn' GROUP BY ALL),
kept AS (SELECT det.* FROM det JOIN anch USING (file_name, doc_id, block_no) WHERE pos >= a),
pass AS (SELECT file_name, doc_id, block_no FROM kept GROUP BY ALL HAVING count(DISTINCT detected) >= 5)"""


def label_free(line: str) -> str:
    labels = "|".join(re.escape(x) for x in sorted(V.LINE_LABELS, key=len, reverse=True))
    return f"trim(regexp_replace({line}, '^(?:{labels})', ''), ' ' || chr(10))"


def per_lang(code: str) -> str:
    return f"coalesce(string_agg(CASE WHEN text_lang = '{code}' THEN {label_free('line')} END, '' ORDER BY pos), '') AS \"{code}\""


ORACLE = {
    "usage_by_file": f"WITH {PARSED}, {USAGE} SELECT * FROM usage",
    "usage_report": f"""WITH {PARSED}, {USAGE}, {STATE}
      SELECT {REPORT} FROM usage u LEFT JOIN state s ON s.file_name = u.file_name""",
    "usage_report_configs": f"""WITH {PARSED}, {USAGE}, {STATE},
      both_ AS (SELECT 'chat' AS config, usage.*, create_time FROM usage JOIN (SELECT file_name, max(created) AS create_time FROM {{results}}
          WHERE answer <> '' AND length(en) % 23 <> 0 GROUP BY file_name) USING (file_name)
        UNION ALL BY NAME {ROLE_USAGE.replace("SELECT file_name,", "SELECT 'role' AS config, max(created) AS create_time, file_name,", 1)})
      SELECT config, create_time, {REPORT} FROM both_ u LEFT JOIN state s ON s.file_name = u.file_name""",
    "usage_by_file_role": ROLE_USAGE,
    "lang_coverage":
        "SELECT unnest(['en', 'fr', 'de', 'es']) AS lang, unnest([count(*) FILTER (en <> ''), count(fr), count(de), count(*) FILTER (es <> '')]) AS cells FROM {wide}",
    "char_frequency_topn": f"WITH {CHARS}, {TOP} SELECT ch AS char, cnt, f.l AS first_line, CAST(f.p AS INTEGER) AS first_pos FROM v",
    "vocab_filter": f"""WITH {CHARS}, {TOP}, m AS (SELECT doc_id, count(*) AS n_class, count(*) FILTER (ch NOT IN (SELECT ch FROM v)) AS n_missing
        FROM c WHERE regexp_full_match(ch, '[a-zà-ÿ]') GROUP BY doc_id)
      SELECT doc_id, n_class, n_missing, text FROM m JOIN {{documents}} USING (doc_id) WHERE CAST(n_missing AS DOUBLE) / n_class <= 0.05""",
    "language_id": "WITH li AS (SELECT doc_id, line_no, line FROM {lines})," + profile() + "," + detect("li", "doc_id, line_no")
        + " SELECT doc_id, line_no, detected FROM det",
    "min_langs_gate": "WITH " + gate_sql() + " SELECT file_name, doc_id, block_no, pos, detected AS lang, line FROM kept JOIN pass USING (file_name, doc_id, block_no)",
    "concat_by_lang": "WITH " + gate_sql() + " SELECT file_name, doc_id, block_no, " + ", ".join(
        per_lang(c) for c in V.CORPUS_LANGS) + " FROM (SELECT kept.*, tdet.detected AS text_lang FROM kept JOIN tdet USING (file_name, doc_id, block_no, pos))"
        + " JOIN pass USING (file_name, doc_id, block_no) GROUP BY ALL",
    "validity_counts": """
      SELECT path, count(*) AS total, count(*) FILTER (ok) AS valid, count(*) FILTER (NOT ok) AS invalid FROM
        (SELECT path, NOT regexp_matches(es, '[\\n\\rñÑ]') AND trim(wav_path, ' ' || chr(10)) <> '' AS ok FROM {wide}) GROUP BY path""",
    "job_state_counts":
        "SELECT status, count(*) AS jobs, status IN ('in_progress', 'validating') AS busy FROM {jobs} GROUP BY status",
    "distinct_subtasks": "SELECT DISTINCT string_split(path, '/')[3] AS sub_task FROM {inventory} WHERE string_split(path, '/')[3] <> ''",
}
