"""Splitting, cleaning and gating text."""

from __future__ import annotations

import re


from paralex import fixed_values as V
from paralex.operators import text as T
from paralex.functions.core import epoch_to_local, local_to_epoch
from paralex.plans.fixtures import FIXTURES, fixture as fx

FIXTURES["dirty"] = """
SELECT doc_id, line_no, CASE source WHEN 'src1' THEN 'zh-cn' WHEN 'src2' THEN 'ja' ELSE lang END AS lang,
  CASE length(line) % 8 WHEN 0 THEN concat('(German translation) ', line)
    WHEN 1 THEN concat(line, ' see https://a.example/x?y=1 now')
    WHEN 2 THEN concat('中文：', line, '(翻译版)') WHEN 3 THEN concat(': ', line, ' (French)')
    WHEN 4 THEN concat('Spanish ', line, ' Here is the translated text. 日文: end')
    WHEN 5 THEN concat('Provide the translation of ', line)
    WHEN 6 THEN concat('Thai (ไทย): ', line, ' 你好 - ') ELSE line END AS text
FROM {lines}
"""
FIXTURES["labelled_lines"] = """
SELECT doc_id, line_no, CASE length(line) % 4 WHEN 0 THEN concat('Chinese (中文):', line)
  WHEN 1 THEN concat('- 中文： ', line) WHEN 2 THEN concat('English: ', line, ' ') ELSE line END AS line
FROM {lines}
"""
FIXTURES["prompts"] = """
SELECT conv_id, turn, concat('Translate the English: line below', chr(10), chr(10), 'English: ', text, chr(10),
  CASE WHEN role = 'user' THEN concat('English: again ', text, chr(10)) ELSE '' END,
  'Chinese: ', chr(10), 'Spanish: ') AS prompt
FROM {conversations}
"""

SPACE = "' ' || chr(10) || chr(9) || chr(13)"


def fold(pieces: str, limit: int) -> str:
    """Greedy packing in the checking engine."""
    return f"""list_reduce(list_prepend({{'done': CAST([] AS VARCHAR[]), 'open': ''}},
      list_transform({pieces}, lambda p: {{'done': CAST([] AS VARCHAR[]), 'open': p}})),
      lambda a, p: CASE WHEN length(a.open) + length(p.open) <= {limit}
        THEN {{'done': a.done, 'open': a.open || p.open}}
        ELSE {{'done': list_append(a.done, trim(a.open, {SPACE})), 'open': p.open}} END)"""


def cut(text: str, mark: str) -> str:
    return f"""list_transform(list_filter(string_split({text}, '{mark}'), lambda s: s <> ''),
      lambda s: CASE WHEN contains('{V.CLAUSE_TAIL}', right(s, 1)) THEN s ELSE s || '{mark}' END)"""


def clean_sql(t: str, lang: str) -> str:
    labels = "|".join(re.escape(s) for s in sorted(V.SENTENCE_LABELS, key=len, reverse=True))
    sub = lambda x, p: f"regexp_replace({x}, '{p}', '', 'g')"
    base = sub(sub(t, V.CLEAN_BRACKETED), V.CLEAN_URL.replace("{s}", "\\s"))
    step = (f"CASE WHEN {lang} = 'zh-cn' THEN {sub(sub(base, V.CLEAN_ZH_BRACKETED), V.CLEAN_ZH_LABEL)} "
            f"WHEN {lang} = 'ja' THEN {sub(base, V.CLEAN_JA_LABEL)} ELSE {sub(base, V.CLEAN_HAN_RUN.replace("{s}", "\\s"))} END")
    step = f"CASE WHEN {lang} <> 'en' THEN {sub(step, V.CLEAN_TRANSLATION_REMARK)} ELSE {step} END"
    step = f"trim({sub(step, labels)}, {SPACE})"
    step = f"trim({sub(sub(step, V.CLEAN_LEADING), V.CLEAN_TRAILING_NAME)}, {SPACE})"
    return f"CASE WHEN {t} = '' OR regexp_matches({t}, '{V.CLEAN_ECHO}') THEN '' ELSE {step} END"


LABEL_SQL = "|".join(re.escape(s) for s in sorted(V.LINE_LABELS, key=len, reverse=True))
MATCH_SQL = "[" + V.MATCH_PUNCTUATION.replace("'", "''") + "\\s]"
SEARCH_SQL = "[" + V.SEARCH_PUNCTUATION + "\\s]"


def vocabulary(spark, sf):
    """The twelve most frequent lower-case letters, as one string."""
    from paralex.operators.vocabulary import char_vocabulary, vocabulary_string

    docs = fx(spark, sf, "documents")
    return vocabulary_string(char_vocabulary(docs, "text", "a-zà-ÿ", 12, "doc_id"))


QUERIES = {
    "split_clauses": lambda s, d: T.split_clauses(
        fx(s, d, "documents").select("doc_id", "text"), "text", 100, ".", ","
    ).select("doc_id", "para", "pos", "clause"),
    "pack_sentences": lambda s, d: T.pack_sentences(
        fx(s, d, "documents").select("doc_id", "text")
    ).select("doc_id", "para", "pos", "chunk"),
    "clean_translation": lambda s, d: T.clean_translation(fx(s, d, "dirty")),
    "strip_label_prefix": lambda s, d: T.strip_label_prefix(fx(s, d, "labelled_lines")),
    "normalize_for_match": lambda s, d: fx(s, d, "dirty").select(
        "doc_id", "line_no", T.normalize("text", "match").alias("matched"),
        T.normalize("text", "search").alias("searched"),
    ),
    "edit_distance_gate": lambda s, d: T.edit_distance_gate(fx(s, d, "norm"), "en"),
    "all_uppercase_gate": lambda s, d: fx(s, d, "norm").select("utt", T.is_all_upper("text").alias("all_upper")),
    "char_class_ratio": lambda s, d: T.char_ratio(
        fx(s, d, "documents"), vocabulary(s, d), "a-zà-ÿ", "text"
    ).select("doc_id", "n_class", "n_missing", "missing_ratio"),
    "extract_source_from_prompt": lambda s, d: fx(s, d, "prompts").select(
        "conv_id", "turn", T.source_after_last("prompt").alias("after_last"),
        T.source_after_second("prompt").alias("after_second"),
    ),
    "epoch_to_local": lambda s, d: fx(s, d, "jobs").select(
        "batch_id", epoch_to_local("completed_at", V.LOCAL_ZONE, V.LOCAL_TIME_FORMAT).alias("finished"),
        local_to_epoch(
            epoch_to_local("completed_at", V.LOCAL_ZONE, V.LEDGER_TIME_FORMAT), V.LOCAL_ZONE,
            V.LEDGER_TIME_FORMAT,
        ).alias("epoch"),
    ),
    "lang_code_lookup": lambda s, d: T.lang_lookup(fx(s, d, "documents")).select(
        "doc_id", "lang", "english", "chinese", "nllb"
    ),
}

ORACLE = {
    "split_clauses": f"""
      WITH c1 AS (SELECT doc_id, line_no AS para, CASE WHEN length(line) > 100
             THEN {fold(cut("line", "."), 100)} END AS f, line FROM {{lines}} WHERE length(line) > 2),
        c2 AS (SELECT doc_id, para, unnest(range(len(cs))) AS i, unnest(cs) AS c FROM (SELECT doc_id, para,
             CASE WHEN f IS NULL THEN [trim(line, {SPACE})] WHEN f.open <> ''
               THEN list_append(f.done, trim(f.open, {SPACE})) ELSE f.done END AS cs FROM c1)),
        c3 AS (SELECT doc_id, para, i, c, CASE WHEN length(c) > 100 THEN {fold(cut("c", ","), 100)} END AS f FROM c2 WHERE c <> ''),
        c4 AS (SELECT doc_id, para, i, unnest(range(len(cs))) AS j, unnest(cs) AS clause FROM (SELECT doc_id, para, i,
             CASE WHEN f IS NULL THEN [c] WHEN f.open <> '' THEN list_append(f.done, trim(f.open, {SPACE})) ELSE f.done END AS cs FROM c3))
      SELECT doc_id, para, row_number() OVER (PARTITION BY doc_id, para ORDER BY i, j) - 1 AS pos, clause
      FROM c4 WHERE clause <> ''""",
    "pack_sentences": f"""
      WITH paras AS (SELECT doc_id, unnest(range(len(l))) AS para, unnest(l) AS line FROM
             (SELECT doc_id, string_split(trim(text, {SPACE}), chr(10)) AS l FROM {{documents}})),
        f AS (SELECT doc_id, para, {fold("list_transform(regexp_extract_all(trim(line), '.+?(?:[.!?] +|$)'), lambda s: trim(s) || ' ')", 400)} AS f FROM paras WHERE trim(line) <> ''),
        c AS (SELECT doc_id, para, unnest(range(len(cs))) AS i, unnest(cs) AS chunk FROM
             (SELECT doc_id, para, list_append(f.done, trim(f.open, {SPACE})) AS cs FROM f))
      SELECT doc_id, para, row_number() OVER (PARTITION BY doc_id, para ORDER BY i) - 1 AS pos, chunk
      FROM c WHERE chunk <> ''""",
    "clean_translation":
        f"SELECT doc_id, line_no, lang, CASE WHEN lang IN ('zh-cn', 'en', 'ja', 'es') THEN {clean_sql('text', 'lang')} "
        "ELSE text END AS text FROM {dirty}",
    "strip_label_prefix":
        f"SELECT doc_id, line_no, trim(regexp_replace(line, '^(?:{LABEL_SQL})', ''), {SPACE}) AS line FROM {{labelled_lines}}",
    "normalize_for_match":
        f"SELECT doc_id, line_no, regexp_replace(text, '{MATCH_SQL}', '', 'g') AS matched, "
        f"lower(regexp_replace(text, '{SEARCH_SQL}', '', 'g')) AS searched FROM {{dirty}}",
    "edit_distance_gate":
        "SELECT utt, src, text FROM (SELECT *, regexp_replace(lower(src), '[^a-z0-9|;:()@/_#$%&*+=<>~`^]', '', 'g') AS a, "
        "regexp_replace(lower(text), '[^a-z0-9|;:()@/_#$%&*+=<>~`^]', '', 'g') AS b FROM {norm} WHERE text IS NOT NULL) "
        "WHERE NOT (upper(text) = text AND lower(text) <> text) "
        "AND CASE WHEN abs(length(a) - length(b)) > 3 THEN false WHEN a = b THEN true ELSE levenshtein(a, b) <= 3 END",
    "all_uppercase_gate": "SELECT utt, upper(text) = text AND lower(text) <> text AS all_upper FROM {norm}",
    "char_class_ratio": """
      WITH c AS (SELECT doc_id, unnest(regexp_extract_all(text, '[a-zà-ÿ]')) AS ch FROM {documents}),
        v AS (SELECT ch FROM c GROUP BY ch ORDER BY count(*) DESC LIMIT 12)
      SELECT d.doc_id, length(regexp_replace(text, '[^a-zà-ÿ]', '', 'g')) AS n_class, coalesce(m.n, 0) AS n_missing,
        CASE WHEN length(regexp_replace(text, '[^a-zà-ÿ]', '', 'g')) > 0
          THEN CAST(coalesce(m.n, 0) AS DOUBLE) / length(regexp_replace(text, '[^a-zà-ÿ]', '', 'g')) END AS missing_ratio
      FROM {documents} d LEFT JOIN (SELECT doc_id, count(*) AS n FROM c ANTI JOIN v USING (ch) GROUP BY doc_id) m
        ON m.doc_id = d.doc_id""",
    "extract_source_from_prompt": f"""
      SELECT conv_id, turn,
        trim(string_split(string_split(prompt, 'English: ')[-1], 'Chinese: ')[1], {SPACE}) AS after_last,
        trim(string_split(array_to_string(string_split(prompt, 'English: ')[3:], 'English: '), chr(10))[1], {SPACE}) AS after_second
      FROM {{prompts}}""",
    "epoch_to_local":
        "SELECT batch_id, strftime(make_timestamp((completed_at + 28800) * 1000000), '%Y-%m-%d %H:%M:%S') AS finished, "
        "completed_at AS epoch FROM {jobs}",
    "lang_code_lookup":
        "SELECT doc_id, lang, english, chinese, nllb FROM {documents} LEFT JOIN (VALUES "
        + ", ".join(str(row) for row in V.LANGUAGES)
        + ") AS d(code, english, chinese, nllb) ON code = lang",
}
