"""Query of the dataset manifest."""

from __future__ import annotations

from pyspark.sql import functions as F

from paralex.llm import merkle
from paralex.llm.common import table

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def op12_merkle(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(*FIELDS)
    tampered = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    leaf = merkle.leaf(*map(F.col, FIELDS))
    shown = F.when(tampered, merkle.leaf(*map(F.col, FIELDS[:-1]), merkle.lower_ascii(F.col("text")))).otherwise(leaf)
    rows = docs.select("doc_id", F.col("lang").alias("tree"), leaf.alias("leaf"), shown.alias("shown"))
    return merkle.manifest(rows).select(
        "doc_id", "leaf", "subroot", "root", F.sha2("proof", 256).alias("proof_sha256"), "folded_root", "verified"
    )


QUERIES = {"op12_merkle": op12_merkle}
ORACLE = {
    "op12_merkle": """
      WITH RECURSIVE d AS (
          SELECT doc_id, lang, text, concat(
              CASE WHEN doc_id IS NULL THEN '-' ELSE concat(strlen(CAST(doc_id AS VARCHAR)), ':', doc_id) END,
              CASE WHEN source IS NULL THEN '-' ELSE concat(strlen(source), ':', source) END,
              CASE WHEN lang IS NULL THEN '-' ELSE concat(strlen(lang), ':', lang) END,
              CASE WHEN n_chars IS NULL THEN '-' ELSE concat(strlen(CAST(n_chars AS VARCHAR)), ':', n_chars) END) AS head,
            xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT),
                list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
              lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda r, i: xor(r >> 1, 3988292384 * (r & 1)))))
              AS crc FROM documents),
        e AS (SELECT doc_id, lang,
            sha256(concat(head, CASE WHEN text IS NULL THEN '-' ELSE concat(strlen(text), ':', text) END)) AS leaf,
            CASE WHEN crc % 3 = 0 THEN sha256(concat(head, CASE WHEN text IS NULL THEN '-' ELSE concat(strlen(text), ':',
              translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) END)) END AS changed FROM d),
        leaves AS (SELECT *, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS t,
            row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
            count(*) OVER (PARTITION BY lang) AS n FROM e),
        low AS (SELECT t, 0 AS level, pos, leaf AS h, n FROM leaves
          UNION ALL SELECT t, level + 1, pos // 8, sha256(string_agg(h, '' ORDER BY pos)), max((n + 7) // 8) FROM low WHERE n > 1
            GROUP BY t, level, pos // 8),
        sub AS (SELECT t, level AS height, h AS subroot FROM low WHERE n = 1),
        high AS (SELECT 0 AS level, t AS pos, subroot AS h, (SELECT count(*) FROM sub) AS n FROM sub
          UNION ALL SELECT level + 1, pos // 8, sha256(string_agg(h, '' ORDER BY pos)), max((n + 7) // 8) FROM high WHERE n > 1
            GROUP BY level, pos // 8),
        nodes AS (SELECT t, level, pos, h, n FROM low WHERE n > 1
          UNION ALL SELECT s.t, s.height + h.level, h.pos, h.h, h.n FROM high h, sub s WHERE h.n > 1),
        steps AS (SELECT l.t, l.pos AS id, l.leaf, coalesce(l.changed, l.leaf) AS folded, 0 AS level, l.pos AS here, '' AS proof, s.height
            FROM leaves l JOIN sub s USING (t)
          UNION ALL SELECT a.t, a.id, a.leaf, sha256(string_agg(CASE WHEN x.pos = a.here THEN a.folded ELSE x.h END, '' ORDER BY x.pos)),
              a.level + 1, a.here // 8,
              concat(a.proof, coalesce(string_agg(CASE WHEN x.pos <> a.here THEN x.h END, '' ORDER BY x.pos), '')), a.height
            FROM (SELECT * REPLACE (CASE WHEN level = height THEN t ELSE here END AS here) FROM steps) a
            JOIN nodes x ON x.t = a.t AND x.level = a.level AND x.pos // 8 = a.here // 8
            GROUP BY a.t, a.id, a.leaf, a.folded, a.level, a.here, a.proof, a.height),
        done AS (SELECT t, id, arg_max(folded, level) AS folded_root, arg_max(proof, level) AS proof FROM steps GROUP BY t, id)
      SELECT l.doc_id, l.leaf, s.subroot, r.h AS root, sha256(f.proof) AS proof_sha256, f.folded_root, f.folded_root = r.h AS verified
      FROM leaves l JOIN done f ON f.t = l.t AND f.id = l.pos JOIN sub s ON s.t = l.t, (SELECT h FROM high WHERE n = 1) r""",
}
