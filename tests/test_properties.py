"""Properties over whole texts."""

import random

import pytest
from pyspark.sql import functions as F

from paralex import fixed_values as V
from paralex.functions.labels import ALL_LABELS, labelled_map
from paralex.operators import responses as X
from paralex.operators import text as TX
from paralex.plans.fixtures import table

SF = "/root/testdata/sf0.001"


def squeezed(c):
    return F.regexp_replace(c, r"\s+", "")


def test_packing_loses_no_character(spark):
    docs = table(spark, SF, "documents").select("doc_id", "text")
    chunks = TX.pack_sentences(docs)
    assert chunks.filter("length(chunk) > 400 and chunk rlike '[.!?] '").count() == 0
    back = chunks.groupBy("doc_id").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("para", "pos", "chunk"))), lambda x: x["chunk"]), "").alias("t"))
    assert docs.join(back, "doc_id", "left").filter(squeezed("text") != squeezed(F.coalesce("t", F.lit("")))).count() == 0


def test_labelled_map_against_a_plain_loop(spark):
    rng = random.Random(3)
    labels = ["English", "French", "German", "Style", "Scene"]
    pieces = [f"{x}: v{i}" for i, x in enumerate(labels)] + [f"**{x}:** b" for x in labels] + [
        "plain", "", "Klingon: no", " English : s", "French:", "a: b: c"]
    answers = ["\n".join(rng.choice(pieces) for _ in range(rng.randrange(1, 9))) for _ in range(300)]

    def expected(answer):
        found, order = {}, []
        for line in answer.replace("**", "").split("\n"):
            name, colon, rest = line.partition(":")
            if colon and name.strip() in ALL_LABELS:
                order.append(name.strip())
                found[order[-1]] = [rest]
            elif order:
                found[order[-1]].append(line)
        out = {}
        for name, lines in found.items():
            value = "\n".join(lines).strip()
            if name in ("Style", "Scene"):
                first = value.split("\n")[0]
                value = "".join(ch for ch in first if ch.isascii() and (ch.isalnum() or ch in ", ")).strip().lower()
            out[ALL_LABELS[name]] = value
        return out or None

    df = spark.createDataFrame([(i, a) for i, a in enumerate(answers)], "i int, answer string")
    got = {r.i: r.m for r in df.select("i", labelled_map("answer").alias("m")).collect()}
    for i, answer in enumerate(answers):
        assert got[i] == expected(answer), answer


def test_edit_gate_against_the_full_distance(spark):
    rng = random.Random(5)
    rows = []
    for i in range(200):
        a = "".join(rng.choice("abc") for _ in range(rng.randrange(120, 400)))
        b = list(a)
        for _ in range(rng.randrange(0, 6)):
            at = rng.randrange(len(b))
            b[at:at + rng.randrange(0, 2)] = rng.choice(["", "x", "yz"])
        rows.append((i, a, "".join(b)))
    df = spark.createDataFrame(rows, "i int, src string, text string")
    kept = {r.i for r in TX.edit_distance_gate(df, "zh").collect()}
    full = {r.i for r in df.filter(F.levenshtein("src", "text") <= 3).collect()}
    assert kept == full and 0 < len(full) < 200


def test_sides_of_the_edit_gate_are_computed_once(spark):
    """Whatever computes the sides runs once a row, not once for every place of the gate that names one."""
    rows = [("a b", "initial! A b"), ("a b", "other"), (None, None), ("x\ny", "initial Y"), ("", "")]
    raw = spark.createDataFrame(rows, "prompt string, said string")
    parts = raw.select(
        F.lit(1).alias("id"), F.initcap("said").alias("answer"),
        F.array(F.struct(F.lit("user").alias("role"), F.concat(F.lit("do\n initial "), F.soundex("prompt"), F.col("prompt")).alias("content"))).alias("messages"))
    for lang in ("en", "de"):
        gated = X.post_norm(parts, lang)
        text = gated._jdf.queryExecution().optimizedPlan().toString()
        assert text.count("initcap(") == 1 and text.count("soundex(") == 1
        assert gated.columns == ["utt", "src", "text"]
    sides = raw.select(F.initcap("said").alias("text"), F.col("prompt").alias("src"), "prompt")
    gated = TX.edit_distance_gate(sides, "en")
    assert gated._jdf.queryExecution().optimizedPlan().toString().count("initcap(") == 1
    assert gated.columns == sides.columns and [tuple(r) for r in gated.collect()] == [("", "", "")]


@pytest.mark.parametrize("lang", ["de", "en"])
def test_edit_gate_normalises_what_follows_a_common_prefix(spark, lang):
    """Same rows as with both sides normalised whole; each side is normalised once and the distance taken once."""
    rng = random.Random(11)
    rows = [(i, None if i % 41 == 0 else "".join(rng.choices("ab.,! ΣςéİI😀", k=rng.choice([0, 3, 9, 150])))) for i in range(400)]
    rows = [(i, a, None if a is None or i % 37 == 0 else "".join(c for c in a if rng.random() > 0.02) + rng.choice(["", "!,", "xy", " more", "."])) for i, a in rows]
    df = spark.createDataFrame(rows + [(900, "ab", "a.b"), (901, "a.b", "ab"), (902, "!", ""), (903, "", None)], "i int, src string, text string")
    gated = TX.edit_distance_gate(df, lang)
    same = F.lower if lang == "en" else F.col
    near = F.levenshtein(TX.normalize(same("src")), TX.normalize(same("text"))) <= V.MAX_EDITS
    full = {r.i for r in df.filter(near & ~TX.is_all_upper("text") if lang == "en" else near).collect()}
    assert {r.i for r in gated.collect()} == full and 50 < len(full) < 390
    plan = gated._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("translate(") == plan.count("translate(substr(") == 2 and plan.count("levenshtein(") == 2


def test_match_mode_drops_the_marks_of_its_class(spark):
    """Every character up to U+3100 and the full-width forms, one by one and in runs."""
    chars = [chr(c) for c in [*range(1, 0x3100), *range(0xFF00, 0xFFF0), 0x1F600]]
    df = spark.createDataFrame([(c,) for c in chars] + [("a" + c + c + "b",) for c in chars] + [(None,), ("",)], "t string")
    plain = F.regexp_replace("t", f"[{V.MATCH_PUNCTUATION}{V.SPACE}]+", "")
    assert df.filter(~TX.normalize("t").eqNullSafe(plain)).count() == 0
    assert df.filter(F.length(TX.normalize("t")) == 0).count() == len(V.MATCH_PUNCTUATION_CHARS + V.SPACE_CHARS) + 1
