"""Rendering requests."""

from __future__ import annotations

from pyspark.sql import functions as F

from paralex.operators import requests as R
from paralex.plans.fixtures import FIXTURES, fixture as fx
from paralex.sources.text import flatten_paths

CFG = R.RenderConfig(need_languages=("French", "German", "Spanish"), styles=("calm", "chat"), scenes=("speech",),
                     model="m-1", max_tokens=64)
ROLE = R.RenderConfig(dialect="role")
PROMPT = "Say it in another language"
SST = {("en", "zh"): "Segment and translate.", ("zh", "en"): "Segment, then translate."}
TEMPLATE = 'Terms of {"a": "{transcription}", "b": "{translation}"}'
TOPIC = "Write [num] sentences in [language] about [topic]."

# Requests made earlier, whose sentence is recovered and asked again.
FIXTURES["old_prompts"] = """
SELECT role AS file_name, conv_id * 1000 + turn AS line_no,
  concat('Old wording.', chr(10), chr(10), 'English: ', text, chr(10), 'Chinese: ', chr(10), 'French: ') AS prompt
FROM {conversations}
"""
HEAD = "Translate this English sentence. Answer with one labelled line per language.\n\nEnglish: "
TAIL = "\nFrench: \nGerman: \nSpanish: \nStyle: [Choose one from: calm, chat]\nScene: [Choose one from: speech]"


def lit(text: str) -> str:
    return "concat(" + ", chr(10), ".join("'" + part.replace("'", "''") + "'" for part in text.split("\n")) + ")"


def utterances(s, d):
    return fx(s, d, "conversations").select(
        F.concat_ws("-", "conv_id", "turn").alias("utt"), F.when(F.col("role") != "system", F.col("text")).alias("text"))


def sst(s, d):
    zh = R.render_sst(utterances(s, d), SST, "zh", "en")
    return zh.unionByName(R.render_sst(utterances(s, d), SST, "en", "zh"))


def envelopes(s, d):
    rows = R.render_norm(utterances(s, d), "Clean the text.")
    bare = R.render_norm(utterances(s, d), None)
    pair = F.array(F.lit("Rules first."), F.col("user"))
    return (
        R.request_envelope(rows, CFG).withColumn("kind", F.lit("chat"))
        .unionByName(R.request_envelope(bare, ROLE).withColumn("kind", F.lit("role")))
        .unionByName(R.request_envelope(rows, ROLE, users=pair).withColumn("kind", F.lit("pair")))
    )


QUERIES = {
    "render_translation": lambda s, d: R.render_translation(fx(s, d, "documents"), CFG).select(
        "doc_id", "prompt", R.translation_prompt("text", R.RenderConfig(prompt=PROMPT)).alias("custom")),
    "render_sst": sst,
    "render_norm": lambda s, d: R.render_norm(utterances(s, d), "Clean the text."),
    "render_extract": lambda s, d: R.render_extract(fx(s, d, "wide"), "Extract terms.", TEMPLATE, "id", "fr", "en"),
    "render_topic": lambda s, d: R.render_topic(flatten_paths(fx(s, d, "nodes")), TOPIC, 10, "fr"),
    "render_supplement": lambda s, d: R.render_supplement(
        fx(s, d, "wide"), ["en", "fr", "de", "es"], ("de", "en")).select("id", "prompt"),
    "render_from_parallel": lambda s, d: R.render_from_parallel(fx(s, d, "wide"), CFG, "id", "de"),
    "request_envelope": envelopes,
    "rerender_prompts": lambda s, d: R.rerender_prompts(fx(s, d, "old_prompts"), CFG),
}

UTT = """u AS (SELECT concat(conv_id, '-', turn) AS utt, CASE WHEN role <> 'system' THEN text END AS text FROM {conversations})"""
BODY = "body := struct_pack(model := 'm-1', messages := {m}, max_tokens := 64)"
CHAT = "CAST(to_json(struct_pack(custom_id := {id}, method := 'POST', url := '/chat/completions', " + BODY + ")) AS VARCHAR)"
MSG = "struct_pack(role := '{r}', content := {c})"


def msg(role: str, content: str) -> str:
    return MSG.replace("{r}", role).replace("{c}", content)


def chat(key: str, parts: str) -> str:
    return CHAT.replace("{id}", key).replace("{m}", parts)


ORACLE = {
    "render_translation":
        f"SELECT doc_id, concat({lit(HEAD)}, text, {lit(TAIL)}) AS prompt, concat('{PROMPT}', chr(10), text) AS custom FROM {{documents}}",
    "render_sst": f"""WITH {UTT}
      SELECT utt AS custom_id, 'Segment, then translate.' AS system, replace(text, ' ', '') AS user FROM u WHERE text IS NOT NULL
      UNION ALL SELECT utt, 'Segment and translate.', text FROM u WHERE text IS NOT NULL""",
    "render_norm": f"WITH {UTT} SELECT utt AS custom_id, 'Clean the text.' AS system, text AS user FROM u WHERE text IS NOT NULL",
    "render_extract":
        "SELECT id AS custom_id, 'Extract terms.' AS system, replace(replace('" + TEMPLATE
        + "', '{transcription}', fr), '{translation}', en) AS user FROM {wide} WHERE fr IS NOT NULL AND en IS NOT NULL",
    "render_topic": """
      SELECT r_name || '-' || n_name || '-' || c_name AS custom_id, CAST(NULL AS VARCHAR) AS system,
        concat('Write 10 sentences in 法语 about [', r_name, '-', n_name, '-', c_name, '].') AS user
      FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey""",
    "render_supplement": """
      WITH w AS (SELECT *, CASE WHEN de IS NOT NULL THEN 'German' WHEN en <> '' THEN 'English' WHEN es <> '' THEN 'es'
            WHEN fr IS NOT NULL THEN 'fr' ELSE 'German' END AS label, coalesce(de, nullif(en, ''), nullif(es, ''), fr, '') AS src,
          list_filter([CASE WHEN en = '' THEN 'English' END, CASE WHEN fr IS NULL THEN 'French' END,
            CASE WHEN de IS NULL THEN 'German' END, CASE WHEN es = '' THEN 'Spanish' END], lambda x: x IS NOT NULL) AS need FROM {wide})
      SELECT id, CASE WHEN len(need) > 0 THEN concat('Translate this ', label, ' sentence into ', array_to_string(need, ', '), ':', chr(10), chr(10),
        label, ': ', src, chr(10), array_to_string(list_transform(need, lambda n: n || ': <translation>'), chr(10))) END AS prompt FROM w""",
    "render_from_parallel":
        f"SELECT id AS custom_id, {chat('id', '[' + msg('system', f'concat({lit(HEAD)}, de, {lit(TAIL)})') + ']')} AS request FROM {{wide}} WHERE de IS NOT NULL",
    "request_envelope": f"""WITH {UTT}
      SELECT utt AS custom_id, {chat('utt', '[' + msg('system', "'Clean the text.'") + ', ' + msg('user', 'text') + ']')} AS request, 'chat' AS kind FROM u WHERE text IS NOT NULL
      UNION ALL SELECT utt, CAST(to_json(struct_pack(id := utt, messages := [{msg('user', 'text')}])) AS VARCHAR), 'role' FROM u WHERE text IS NOT NULL
      UNION ALL SELECT utt, CAST(to_json(struct_pack(id := utt, messages := [{msg('system', "'Clean the text.'")}, {msg('user', "'Rules first.'")}, {msg('user', 'text')}])) AS VARCHAR), 'pair'
        FROM u WHERE text IS NOT NULL""",
    "rerender_prompts": f"""
      WITH n AS (SELECT file_name, prompt, CAST(row_number() OVER (PARTITION BY file_name ORDER BY line_no) - 1 AS VARCHAR) AS p FROM {{old_prompts}}),
        k AS (SELECT file_name, lpad(p, CAST(greatest(4, length(p)) AS INTEGER), '0') AS key,
          concat({lit(HEAD)}, trim(string_split(string_split(prompt, 'English: ')[-1], 'Chinese: ')[1], ' ' || chr(10)), {lit(TAIL)}) AS prompt FROM n)
      SELECT file_name, key, CAST(json_object(key, prompt) AS VARCHAR) AS line FROM k""",
}
