"""Aligning segments with timestamps."""

from __future__ import annotations

from pyspark.sql import functions as F

from paralex.functions.core import let, with_kept
from paralex.operators import align as A
from paralex.plans.fixtures import FIXTURES, fixture as fx

# Words of each conversation turn; some become full-width marks.
FIXTURES["tokens"] = (
    "SELECT concat(conv_id, '-', turn) AS utt, pos, CASE WHEN length(word) = 2 THEN concat('，', word) WHEN length(word) = 3 THEN '。' ELSE word END AS word, "
    "CAST(pos * 200 AS BIGINT) AS start_ms, CAST(pos * 200 + 180 AS BIGINT) AS end_ms "
    "FROM {conversations} LATERAL VIEW posexplode(split(text, '[ \\n]+')) AS pos, word",
    "SELECT utt, pos, CASE WHEN length(word) = 2 THEN concat('，', word) WHEN length(word) = 3 THEN '。' ELSE word END AS word, pos * 200 AS start_ms, pos * 200 + 180 AS end_ms "
    "FROM (SELECT concat(conv_id, '-', turn) AS utt, unnest(range(len(w))) AS pos, unnest(w) AS word FROM "
    "(SELECT conv_id, turn, regexp_split_to_array(text, '[ \\n]+') AS w FROM {conversations}))",
)
# Segments of four words; some empty, some with a changed first character, some only marks.
FIXTURES["segments"] = (
    "SELECT utt, i AS seg_no, CASE WHEN i % 11 = 10 THEN '?!' WHEN i % 7 = 6 THEN concat('#x', substr(t, 2)) WHEN i % 13 = 12 THEN concat('zzz', t, 'zzz') "
    "WHEN i % 17 = 16 THEN '' ELSE t END AS transcription FROM (SELECT utt, i, array_join(slice(w, i * 4 + 1, 4), ' ') AS t FROM ("
    "SELECT utt, w, explode(sequence(0, (size(w) - 1) div 4)) AS i FROM "
    "(SELECT concat(conv_id, '-', turn) AS utt, w FROM {conversations} LATERAL VIEW explode(array(split(text, '[ \\n]+'))) t AS w) c) d) e",
    "SELECT utt, i AS seg_no, CASE WHEN i % 11 = 10 THEN '?!' WHEN i % 7 = 6 THEN concat('#x', substr(t, 2)) WHEN i % 13 = 12 THEN concat('zzz', t, 'zzz') "
    "WHEN i % 17 = 16 THEN '' ELSE t END AS transcription FROM (SELECT utt, i, array_to_string(w[i * 4 + 1:i * 4 + 4], ' ') AS t FROM ("
    "SELECT utt, w, unnest(range((len(w) - 1) // 4 + 1)) AS i FROM "
    "(SELECT concat(conv_id, '-', turn) AS utt, regexp_split_to_array(text, '[ \\n]+') AS w FROM {conversations}) c) d) e",
)
FIXTURES["chars"] = (
    "SELECT concat(conv_id, '-', turn) AS utt, pos, CAST(pos * 50 AS BIGINT) AS start_ms, CAST(pos * 50 + 40 AS BIGINT) AS end_ms "
    "FROM {conversations} LATERAL VIEW posexplode(split(replace(text, chr(10), ''), '')) AS pos, ch",
    "SELECT utt, pos, pos * 50 AS start_ms, pos * 50 + 40 AS end_ms FROM (SELECT concat(conv_id, '-', turn) AS utt, "
    "unnest(range(length(replace(text, chr(10), '')))) AS pos FROM {conversations})",
)


def nested(s, d):
    """One row per utterance, straight from its text."""
    token = lambda w, i: F.struct(w.alias("word"), (i * 200).alias("start_ms"), (i * 200 + 180).alias("end_ms"))

    def utterance(w):
        def segment(i):
            t = F.array_join(F.slice(w, i * 4 + 1, 4), " ")
            return F.struct(
                F.when(i % 11 == 10, "?!").when(i % 7 == 6, F.concat(F.lit("#x"), F.substr(t, F.lit(2))))
                .when(i % 13 == 12, F.concat(F.lit("zzz"), t, F.lit("zzz"))).when(i % 17 == 16, "").otherwise(t).alias("transcription"))

        groups = F.sequence(F.lit(0), F.floor((F.size(w) - 1) / 4).cast("int"))
        return F.struct(F.transform(w, token).alias("tokens"), F.transform(groups, segment).alias("segments"))

    rows = with_kept(fx(s, d, "conversations"), "x", let(F.split("text", "[ \n]+"), utterance), lambda x: F.lit(True))
    return rows.select(F.concat_ws("-", "conv_id", "turn").alias("utt"), "x.tokens", "x.segments")


QUERIES = {
    "align_by_length": lambda s, d: A.align_by_length(fx(s, d, "segments"), fx(s, d, "chars")),
    "align_by_search": lambda s, d: A.align_by_search(nested(s, d)).select(
        "utt", F.posexplode("aligned").alias("seg", "x")).select("utt", "seg", "x.transcription", "x.start_ms", "x.end_ms"),
    "attach_punctuation": lambda s, d: A.attach_punctuation(fx(s, d, "tokens")),
}

NORM = "lower(regexp_replace({x}, '[\\p{P}\\s]', '', 'g'))"


def norm(x: str) -> str:
    return NORM.replace("{x}", x)


def hit(cut_left: int, cut_right: int) -> str:
    part = f"substr(x.n, {cut_left + 1}, CAST(length(x.n) - {cut_left + cut_right} AS INTEGER))"
    return (f"CASE WHEN length(x.n) > {cut_left + cut_right} AND strpos(substr(x.whole, CAST(a.cur + 1 AS INTEGER)), {part}) > 0 THEN "
            f"{{'f': a.cur + strpos(substr(x.whole, CAST(a.cur + 1 AS INTEGER)), {part}) - 1, 'l': length(x.n) - {cut_left + cut_right}}} END")


ORACLE = {
    "align_by_length": """
      WITH n AS (SELECT utt, max(pos) AS last FROM {chars} GROUP BY utt),
        p AS (SELECT utt, seg_no, transcription, length(transcription) AS len, coalesce(sum(length(transcription)) OVER
          (PARTITION BY utt ORDER BY seg_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b FROM {segments})
      SELECT p.utt, seg_no, transcription, CASE WHEN len > 0 THEN least(b, last) * 50 END AS start_ms,
        CASE WHEN len > 0 THEN least(b + len - 1, last) * 50 + 40 END AS end_ms FROM p JOIN n ON n.utt = p.utt""",
    "align_by_search": f"""
      WITH w AS (SELECT concat(conv_id, '-', turn) AS utt, regexp_split_to_array(text, '[ \\n]+') AS w FROM {{conversations}}),
        t AS (SELECT utt, list_transform(w, lambda y: {norm('y')}) AS ns, len(w) AS nt FROM w),
        o AS (SELECT utt, array_to_string(ns, '') AS whole, nt, flatten(list_transform(range(nt), lambda i: list_transform(range(length(ns[i + 1])), lambda k: i))) AS owner FROM t),
        s AS (SELECT utt, list({{'seg_no': seg_no, 't': transcription, 'n': {norm('transcription')}}} ORDER BY seg_no) AS ss FROM {{segments}} WHERE trim(transcription) <> '' GROUP BY utt),
        f AS (SELECT utt, nt, owner, list_reduce(list_prepend({{'cur': CAST(0 AS BIGINT), 't': '', 'n': '', 'whole': '', 'out': CAST([] AS STRUCT(t VARCHAR, f BIGINT, l BIGINT)[])}},
            list_transform(ss, lambda x: {{'cur': CAST(0 AS BIGINT), 't': x.t, 'n': x.n, 'whole': whole, 'out': CAST([] AS STRUCT(t VARCHAR, f BIGINT, l BIGINT)[])}})),
            lambda a, x: CASE WHEN x.n = '' THEN {{'cur': a.cur, 't': '', 'n': '', 'whole': '', 'out': list_append(a.out, {{'t': x.t, 'f': -1, 'l': -1}})}}
              WHEN coalesce({hit(0, 0)}, {hit(1, 0)}, {hit(0, 1)}, {hit(2, 0)}, {hit(0, 2)}) IS NULL
                THEN {{'cur': a.cur, 't': '', 'n': '', 'whole': '', 'out': list_append(a.out, {{'t': x.t, 'f': a.cur, 'l': -2}})}}
              ELSE {{'cur': coalesce({hit(0, 0)}, {hit(1, 0)}, {hit(0, 1)}, {hit(2, 0)}, {hit(0, 2)}).f + coalesce({hit(0, 0)}, {hit(1, 0)}, {hit(0, 1)}, {hit(2, 0)}, {hit(0, 2)}).l,
                't': '', 'n': '', 'whole': '', 'out': list_append(a.out, {{'t': x.t, 'f': coalesce({hit(0, 0)}, {hit(1, 0)}, {hit(0, 1)}, {hit(2, 0)}, {hit(0, 2)}).f,
                'l': coalesce({hit(0, 0)}, {hit(1, 0)}, {hit(0, 1)}, {hit(2, 0)}, {hit(0, 2)}).l}})}} END) AS r FROM s JOIN o USING (utt)),
        u AS (SELECT utt, nt, owner, unnest(range(len(r.out))) AS seg, unnest(r.out) AS y FROM f)
      SELECT utt, seg, y.t AS transcription,
        CASE WHEN y.f = -1 THEN NULL WHEN y.f < len(owner) THEN owner[y.f + 1] * 200 ELSE (nt - 1) * 200 END AS start_ms,
        CASE WHEN y.l = -1 THEN NULL WHEN y.l = -2 THEN (nt - 1) * 200 + 180 ELSE owner[y.f + y.l] * 200 + 180 END AS end_ms FROM u""",
    "attach_punctuation": """
      WITH g AS (SELECT *, sum(CASE WHEN regexp_matches(word, '^[，。！？；：]') THEN 0 ELSE 1 END) OVER (PARTITION BY utt ORDER BY pos) AS k FROM {tokens})
      SELECT utt, k - 1 AS pos, string_agg(word, '' ORDER BY pos) AS word, min(start_ms) FILTER (NOT regexp_matches(word, '^[，。！？；：]')) AS start_ms,
        max(end_ms) FILTER (NOT regexp_matches(word, '^[，。！？；：]')) AS end_ms FROM g WHERE k > 0 GROUP BY utt, k""",
}
