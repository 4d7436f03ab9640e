"""Edge rows: Han text, full-width marks, CRLF, U+3000, repeated labels."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paralex.functions.core import epoch_to_local, local_to_epoch, strip
from paralex.functions.labels import labelled_map
from paralex.operators import aggregates as G
from paralex.operators import align as A
from paralex.operators import predicates as P
from paralex.operators import requests as R
from paralex.operators import responses as X
from paralex.operators import text as TX
from paralex.operators.vocabulary import char_vocabulary, vocabulary_filter
from paralex.sources import jsonl
from paralex.sources import text as S
from paralex.sources.results import read_results, rejected_results


def one(spark, value, expr):
    df = spark.createDataFrame([(value,)], "x string")
    return df.select(expr.alias("y")).first().y


@pytest.mark.parametrize(
    "text, expected",
    [
        ("**Chinese:** 你好\r\nEnglish: hi", {"zh-cn": "你好", "en": "hi"}),
        ("intro\nEnglish: a\nmore: b\nlast", {"en": "a\nmore: b\nlast"}),
        ("English: a\nEnglish: b", {"en": "b"}),
        (" English : a", {"en": "a"}),
        ("Style: *Chat-Casual!*\nx\nScene: Speech.", {"style": "chatcasual", "scene": "speech"}),
        ("no label", None),
        ("english: lower case is no label", None),
    ],
)
def test_labelled_map(spark, text, expected):
    assert one(spark, text, labelled_map("x")) == expected


def test_last_annotation_may_stay_as_written(spark):
    text = "Style: A-b!\nScene: Speech."
    assert one(spark, text, labelled_map("x", keep_last_annotation=True)) == {"style": "ab", "scene": "Speech."}


def test_strip_knows_wide_space(spark):
    assert one(spark, "　 a b \r\n", strip("x")) == "a b"


def test_clauses_of_han_text(spark):
    text = "短。\n" + "一二三四五六七八九十" * 2 + "。" + "甲" * 12 + "，" + "乙" * 12 + "。”尾巴。\nab"
    rows = TX.split_clauses(spark.createDataFrame([(text,)], "text string"), limit=24).orderBy("para", "pos").collect()
    assert [(r.para, r.clause) for r in rows] == [
        # a leading closing quote belongs to the last finished clause
        (1, "一二三四五六七八九十" * 2 + "。”"), (1, "甲" * 12 + "，"), (1, "乙" * 12 + "。"), (1, "尾巴。"),
    ]


def test_packing_keeps_over_long_sentence_whole(spark):
    text = "x" * 30 + ". one. two.\n\n  three!  "
    rows = TX.pack_sentences(spark.createDataFrame([(text,)], "text string"), limit=12).orderBy("para", "pos").collect()
    assert [r.chunk for r in rows] == ["x" * 30 + ".", "one. two.", "three!"]
    kept = TX.pack_sentences(spark.createDataFrame([(text,)], "text string"), limit=12, keep_empty=True)
    assert kept.filter("chunk = ''").count() == 2


@pytest.mark.parametrize(
    "lang, text, expected",
    [
        ("en", "(a translation) hello https://a.b/c now (French)", "hello  now"),
        ("zh-cn", "- 中文：你好（x）", "你好（x）"),
        ("es", "hola 你好 amigo", "holaamigo"),
        ("ko", "Here is the translated text. 안녕", "안녕"),
        ("en", "Provide the translation here", ""),
        ("ja", "日语：こんにちは", "こんにちは"),
        ("de", "Spanish bleibt", "Spanish bleibt"),
    ],
)
def test_clean_translation(spark, lang, text, expected):
    df = spark.createDataFrame([(lang, text)], "lang string, text string")
    assert TX.clean_translation(df).first().text == expected


def test_longest_label_is_stripped_once(spark):
    assert one(spark, "Chinese (中文):中文：你", TX.strip_label("x")) == "中文：你"


@pytest.mark.parametrize(
    "lang, src, text, kept",
    [
        ("en", "Hello, world", "hello world!", True),
        ("en", "hello", "HELLO", False),
        ("zh", "你好。", "你 好　吗", True),
        ("zh", "hello", "HELLO", False),
        ("zh", "a" * 300 + "bcd", "a" * 300 + "xyz", True),
        ("zh", "a" * 300 + "bcde", "a" * 300 + "wxyz", False),
        ("zh", "b" + "a" * 300 + "c", "a" * 300 + "d", True),
        ("en", None, "a", False),
        ("en", "a", None, False),
    ],
)
def test_edit_gate(spark, lang, src, text, kept):
    df = spark.createDataFrame([(src, text)], "src string, text string")
    assert (TX.edit_distance_gate(df, lang).count() == 1) is kept


def test_valid_pair_rules(spark):
    rows = [("1", "源", "fine", "p"), ("2", "源", "has 汉", "p"), ("3", "源", "two\nlines", "p"),
            ("4", "源", "ok", " 　"), ("5", None, "ok", "p"), ("6", "源", None, "p"), ("7", "", "", "p")]
    df = spark.createDataFrame(rows, "id string, zh string, en string, path string")
    assert [r.id for r in P.filter_valid_pair(df, "zh", "en", "path").collect()] == ["1", "7"]


def test_punctuation_outside_the_list(spark):
    df = spark.createDataFrame([("你好，世界。",), ("你好! a_b",), ("é…‥",)], "text string")
    assert {r.text: r.marks for r in P.flag_punctuation(df).collect()} == {"你好! a_b": "!", "é…‥": "‥…"}


def test_vocabulary_ties_go_to_the_first_seen(spark):
    df = spark.createDataFrame([(1, "乙甲甲乙"), (2, "丙x"), (3, "丁")], "line_no int, text string")
    rows = char_vocabulary(df, size=3).orderBy(F.desc("cnt"), "first_line", "first_pos").collect()
    assert [(r.char, r.cnt) for r in rows] == [("乙", 2), ("甲", 2), ("丙", 1)]
    kept = vocabulary_filter(df, size=3, max_missing=0.2)
    assert sorted(r.line_no for r in kept.collect()) == [1, 2]


def test_block_rules(spark):
    lines = ["中文：", "好", "!!", "An AI Language Model 很抱歉", "a", "很抱歉", "b"]
    df = spark.createDataFrame([("\n".join(lines),), ("x\n" * 3,)], "body string")
    assert [r.lines for r in P.filter_noise_lines(df).collect()] == [["好", "a"]]


def test_gate_and_concat_by_language(spark):
    rows = [("en", "skip"), ("zh-cn", "中文：你"), ("en", "English: hi"), ("zh-cn", "好"), ("xx", "?"), ("fr", "a")]
    rows = [(lang, line, lang) for lang, line in rows]
    df = spark.createDataFrame([(rows,)], "lines array<struct<lang:string,line:string,text_lang:string>>")
    out = G.concat_by_lang(G.min_langs_gate(df)).first()
    assert (out["zh-cn"], out["en"], out["fr"], out["ja"]) == ("你好", "hi", "a", "")
    assert G.min_langs_gate(df, at_least=5).count() == 0
    assert G.min_langs_gate(df, anchor="ko").count() == 0


def test_pairs_stop_at_the_first_empty_one(spark):
    answer = '```json\n[{"src":"a","tgt":"b"},{"src":"","tgt":""},{"src":"c","tgt":"d"}]```'
    df = spark.createDataFrame([(answer,), ("not json",)], "answer string")
    assert [len(r.pairs) for r in X.parse_sst_pairs(df).collect()] == [1, 0]


def test_incremental_steps(spark):
    step = lambda s, t: f"- [已累积的原文内容]：{s}\n- [已口播译文]：{t}\n"
    text = step("现在", "Now,") + step("现在呢", "wrong") + step("现在呢我", "Now,") + step("现在呢我们", "Now, we") + step(
        "现在呢我们到", "Now, we.") + step("现在呢我们到了", "Now, we. go")
    df = spark.createDataFrame([(text,)], "answer string")
    got = [(p.src, p.tgt) for p in X.parse_sst_incremental(df).first().steps]
    assert got == [("现在呢我", "Now,"), ("们到", " we"), ("了", " go")]
    lost = [(p.src, p.tgt) for p in X.parse_sst_incremental(df, drop_lone_marks=True).first().steps]
    assert lost[1] == ("们", " we")


def test_extract_outcomes(spark):
    schema = "id string, answer string, messages array<struct<role:string,content:string>>"
    prompt = 'Terms\n{"zh-cn": "深圳", "en": "Shenzhen"}\n'
    rows = [("ok", '{"term": {"zh-cn": [["深圳", "Shenzhen"]]}}'), ("none", '{"term": null}'), ("list", "[]"),
            ("bad", "{oops"), ("other", '{"x": 1}')]
    df = spark.createDataFrame([(i, a, [("user", prompt)]) for i, a in rows], schema)
    got = {r.wav_path: (r.source, r.term) for r in X.post_extract(df).collect()}
    assert got == {"ok": ("深圳", '{"zh-cn":[["深圳","Shenzhen"]]}'), "none": ("深圳", None), "list": ("深圳", None)}


def test_norm_without_system_message(spark):
    schema = "id string, answer string, messages array<struct<role:string,content:string>>"
    df = spark.createDataFrame([("u", "abc", [("user", "task\nabc")])], schema)
    assert X.post_norm(df, "en").first().src == "abc"


def test_punctuation_is_glued_to_the_word_before(spark):
    rows = [("u", 0, "，", 0, 1), ("u", 1, "你", 1, 2), ("u", 2, "。", 2, 3), ("u", 3, "！x", 3, 4), ("u", 4, ".", 4, 5)]
    df = spark.createDataFrame(rows, "utt string, pos int, word string, start_ms int, end_ms int")
    got = [(r.pos, r.word, r.start_ms, r.end_ms) for r in A.attach_punctuation(df).orderBy("pos").collect()]
    assert got == [(0, "你。！x", 1, 2), (1, ".", 4, 5)]


def test_search_alignment_paths(spark):
    tokens = [(w, i * 10, i * 10 + 9) for i, w in enumerate(["你", "好", "，", "世", "界", "再", "见"])]
    segs = [("你好，",), ("。",), ("x世界",), ("  ",), ("完全不同",), ("再见",)]
    df = spark.createDataFrame(
        [(tokens, segs)], "tokens array<struct<word:string,start_ms:int,end_ms:int>>, segments array<struct<transcription:string>>")
    got = [(r.transcription, r.start_ms, r.end_ms) for r in A.align_by_search(df).first().aligned]
    assert got == [("你好，", 0, 19), ("。", None, None), ("x世界", 30, 49), ("完全不同", 50, 69), ("再见", 50, 69)]


def test_length_alignment_clamps(spark):
    segs = spark.createDataFrame([("u", 0, "ab"), ("u", 1, ""), ("u", 2, "cdef"), ("u", 3, "g")],
                                 "utt string, seg_no int, transcription string")
    chars = spark.createDataFrame([("u", i, i * 10, i * 10 + 9) for i in range(4)],
                                  "utt string, pos int, start_ms int, end_ms int")
    got = [(r.start_ms, r.end_ms) for r in A.align_by_length(segs, chars).orderBy("seg_no").collect()]
    assert got == [(0, 19), (None, None), (20, 39), (30, 39)]


def test_bad_lines_are_kept_apart(spark):
    df = spark.createDataFrame([('{"k": 1}',), ('{"k": ',), ("[1]",), ("",)], "line string")
    good, bad = jsonl.read_jsonl(df, T.StructType([T.StructField("k", T.LongType())]))
    assert [r.k for r in good.collect()] == [1]
    assert bad.count() == 3


def test_result_rows_without_usage_or_answer(spark):
    lines = [("f", '{"custom_id":"a","response":{"body":{"choices":[{"message":{"content":"x"}}]}}}'),
             ("f", '{"custom_id":"b","response":{"body":{"choices":[]}}}'), ("f", "oops")]
    df = spark.createDataFrame(lines, "file_name string, line string")
    assert [r.id for r in read_results(df, "chat").collect()] == ["a"]
    assert rejected_results(df, "chat").count() == 2


def test_list_lines(spark):
    df = spark.createDataFrame([("f", 1, " a\t x y \n"), ("f", 2, "b"), ("f", 3, ""), ("f", 4, "a　z")],
                               "file_name string, line_no int, line string")
    assert [(r.id, r.text) for r in S.parse_list(df).orderBy("line_no").collect()] == [("a", "x y"), ("a", "z")]
    assert [r.text for r in S.parse_list(df, "last").collect()] == ["z"]


def test_local_time_round_trip(spark):
    df = spark.createDataFrame([(0,), (1700000000,)], "t bigint")
    rows = df.select(epoch_to_local("t", "Asia/Shanghai", "yyyy-MM-dd HH-mm-ss").alias("s")).select(
        "s", local_to_epoch("s", "Asia/Shanghai", "yyyy-MM-dd HH-mm-ss").alias("t")).collect()
    assert [(r.s, r.t) for r in rows] == [("1970-01-01 08-00-00", 0), ("2023-11-15 06-13-20", 1700000000)]


def test_segment_requests_strip_spaces_by_script(spark):
    df = spark.createDataFrame([("u", "a b"), (None, "x"), ("v", None)], "utt string, text string")
    prompts = {("zh", "en"): "p", ("en", "zh"): "q"}
    assert R.render_sst(df, prompts, "zh", "en").first().user == "ab"
    assert R.render_sst(df, prompts, "en", "zh").first().user == "a b"
    assert R.render_sst(df, prompts, "en", "zh", compat=True).first().user == "ab"


def test_merge_of_nested_maps(spark):
    row = spark.sql("select map('a', map('x', '1', 'y', '2'), 'b', map('z', '3')) as o, "
                    "map('a', map('y', cast(null as string)), 'c', map('w', '4')) as n").select(
        P.deep_merge_maps("o", "n").alias("m")).first()
    assert row.m == {"a": {"x": "1", "y": None}, "b": {"z": "3"}, "c": {"w": "4"}}
