"""Quality rules against plain rules; learned models by held-out accuracy; odd rows."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from cases import documents, empty
from paralex.llm import language, quality_model, quality_rules, toxicity
from paralex.llm.catalog import queries
from paralex.llm.common import held_out, logistic

SF = "/root/testdata/sf0.01"
WORD = re.compile("[^\x20\x09-\x0d]+")


@pytest.fixture(scope="module")
def tables(spark):
    read = lambda n: {r[0]: r for r in spark.read.parquet(f"{SF}/{n}.parquet").collect()}
    return read("documents"), read("labels")


def plain_base(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    repeated = sum(any(windows[tuple(words[j : j + 3])] > 1 for j in range(max(0, i - 2), min(i, len(words) - 3) + 1)) for i in range(len(words)))
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return {
        "n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": len(re.findall("[#*$%&|<>]", text)),
        "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": repeated,
        "base_failed": len(words) < 50 or 100 * repeated > 50 * len(words),
    }


def test_base_figures(spark, tables):
    for row in queries()["op2_quality_rules"](spark, SF).collect():
        want = plain_base(tables[0][row.doc_id].text)
        assert {k: row[k] for k in want} == want
        assert not (row.base_failed and row.kept)


def test_base_figures_of_odd_rows(spark):
    docs = documents(spark)
    rows = docs.withColumn("q", quality_rules.quality()("text")).select("text", "q.*").collect()
    assert len(rows) == docs.count()
    for row in rows:
        want = plain_base(row.text)
        assert {k: row[k] for k in want} == want
    assert empty(spark).withColumn("q", quality_rules.quality()("text")).count() == 0


GOOD = "This is a plain sentence about nothing much, and it ends here."


@pytest.mark.parametrize(
    ("line", "fault"),
    [
        (GOOD, None), ("Short title", None), ("Home | About | News | Contact | Help", "navigation"),
        ("BUY NOW OR REGRET IT FOREVER TODAY", "boilerplate"), ("All rights reserved.", "boilerplate"),
        ("the%%% cat$$$ sat### on*** the&&& mat%%%", "punctuation"), ("what!! is!! this!! about!! now!!", "punctuation"),
        ("Well, yes. (It says so.) \"Right?\" he asked; she said: 'no'.", None),
    ],
)
def test_line_rules(line, fault):
    assert quality_rules.line_fault(line, quality_rules.Limits()) == fault


def test_documents_that_lose_too_much_go():
    good = [" ".join(f"w{i}x{j}" for j in range(12)) + "." for i in range(10)]
    bad = ["Home | About | News | Contact | Help"]
    kept = quality_rules.judge("\n".join(good + bad))
    assert kept["kept"] and kept["n_navigation"] == 1 and kept["cleaned"] == "\n".join(good)
    junk = [f"w{i}$$$ x{i}%%% y{i}### z{i}*** v{i}&&& u{i}$$$" for i in range(60)]
    assert not quality_rules.judge("\n".join(good + junk))["kept"]
    assert quality_rules.judge("\n".join(good))["cleaned"] == "\n".join(good)


def test_documents_of_short_symbol_lines_go():
    junk = [f"{a * 4} {b * 4} {c * 4}" for a in "#*$=-~" for b in "+%&_" for c in "<>"]
    got = quality_rules.judge("\n".join(junk))
    assert got["n_punctuation"] == len(junk) and not got["base_failed"] and not got["kept"]
    for line in ("==========", "* 1", "日本語", "a", "|"):
        fault = None if any(map(str.isalnum, line)) else "punctuation"
        assert quality_rules.line_fault(line, quality_rules.Limits()) == fault


def test_kept_follows_quality_labels(spark, tables):
    rows = [r for r in queries()["op2_quality_rules"](spark, SF).collect() if r.doc_id in tables[1] and r.n_words >= 50]
    good = [r.kept for r in rows if tables[1][r.doc_id].quality == 1]
    bad = [r.kept for r in rows if tables[1][r.doc_id].quality == 0]
    assert np.mean(good) > 0.99 and np.mean(bad) < 0.1


def held(i):
    return zlib.crc32(str(i).encode()) % 5 == 0


def test_language_of_held_out_documents(spark, tables):
    rows = queries()["op4_language"](spark, SF).collect()
    assert all(r.held_out == held(r.doc_id) and 0 <= r.score <= 1 for r in rows) and len(rows) == len(tables[0])
    assert np.mean([r.lang_pred == tables[0][r.doc_id].lang for r in rows if r.held_out]) > 0.98
    assert np.mean([r.rejected for r in rows]) < 0.005


def test_language_of_odd_rows(spark):
    docs = documents(spark)
    answer = language.language_of(spark, language.fit(docs))
    rows = docs.withColumn("a", answer("text")).select("text", "a.*").collect()
    for r in rows:
        assert (r.lang == "und") == (r.text is None or not any(c.isalpha() for c in r.text))
        assert 0 <= r.score <= 1
    nothing = language.language_of(spark, language.fit(empty(spark)))
    assert {r.lang for r in docs.select(nothing("text").alias("a")).select("a.lang").collect()} == {"und"}
    assert empty(spark).select(answer("text")).count() == 0


def test_far_texts_are_rejected(spark, tables):
    model = language.fit(spark.read.parquet(f"{SF}/documents.parquet"))
    rng = random.Random(2)
    noise = " ".join("".join(rng.choices("qxzjkvw", k=7)) for _ in range(300))
    assert language.predict(model, noise)["rejected"] and language.predict(model, "これは日本語の文章です。" * 40)["rejected"]
    assert not any(language.predict(model, tables[0][i].text)["rejected"] for i in list(tables[0])[:200])


def test_vectors_count_every_gram(monkeypatch):
    text = "Ab c  dé\n" * 30
    whole = language.gram_counts(text)
    clean = re.sub("[^a-z\x80-\xff]+", " ", f" {text.lower()} ".encode().decode("latin-1"))
    assert whole.sum() == sum(len(clean) - n + 1 for n in language.ORDERS)
    monkeypatch.setattr(language, "_CHUNK", 50)
    assert language.gram_counts(text).tolist() == whole.tolist()


@pytest.mark.parametrize(("key", "label", "least"), [("op8_quality", "quality", 0.93), ("op10_toxicity", "toxic", 0.93)])
def test_held_out_accuracy(spark, tables, key, label, least):
    rows = queries()[key](spark, SF).collect()
    assert len(rows) == len(tables[0]) and all(0 <= r.score <= 1 and r.held_out == held(r.doc_id) for r in rows)
    limit = 0.3 if label == "quality" else 0.5
    assert all(r.predicted == (r.score >= limit) for r in rows)
    right = [r.predicted == tables[1][r.doc_id][label] for r in rows if r.held_out and r.doc_id in tables[1]]
    assert np.mean(right) >= least


@pytest.mark.parametrize("module", [quality_model, toxicity])
def test_models_take_odd_rows(spark, module):
    docs = documents(spark)
    label = "quality" if module is quality_model else "toxic"
    rows = [(i, i % 2, "x") for i in range(12)] + [(None, 1, "x"), (3, None, "x"), (5, 1, "x")]
    labels = spark.createDataFrame(rows, f"doc_id long, {label} int, text string")
    score = (lambda m: quality_model.score(m)) if module is quality_model else (lambda m: toxicity.toxicity(spark, m))
    for use in (labels, labels.limit(0), labels.filter(f"{label} = 1")):
        value = score(module.fit(docs, use))("text")
        got = [r[0] for r in docs.select(value["score"] if module is quality_model else value).collect()]
        assert len(got) == docs.count() and all(0 <= x <= 1 for x in got)
        assert empty(spark).select(value).count() == 0
    module.fit(empty(spark), labels)


def test_gradients_of_the_network():
    rng = np.random.default_rng(0)
    net = toxicity.Network.fresh()
    net.p = {k: v.astype(float) for k, v in net.p.items()}
    x, y = rng.normal(size=(toxicity.WINDOW, 4, toxicity.INPUTS)), np.array([0.0, 1, 1, 0])
    mask = (np.arange(toxicity.WINDOW)[:, None] < np.array([24, 10, 1, 17])[None, :]).astype(float)
    weight = np.array([0.1, 0.4, 0.2, 0.3])
    g = net.gradients(x, mask, y, weight)

    def loss():
        index = np.where(mask.T > 0, np.arange(4 * toxicity.WINDOW).reshape(4, -1), -1)
        logit = net.logits(x.transpose(1, 0, 2).reshape(-1, toxicity.INPUTS), index).astype(float)
        p = 1 / (1 + np.exp(-logit))
        return -(weight * (y * np.log(p) + (1 - y) * np.log(1 - p))).sum()

    for name in net.p:
        flat = net.p[name].reshape(-1)
        for i in rng.choice(len(flat), min(4, len(flat)), replace=False):
            old = flat[i]
            flat[i] = old + 1e-3
            up = loss()
            flat[i] = old - 1e-3
            down = loss()
            flat[i] = old
            assert abs((up - down) / 2e-3 - g[name].reshape(-1)[i]) < 2e-4, name


def test_windows_cover_all_words_and_overlap():
    counts = np.array([0, 1, 24, 25, 36, 37, 100])
    index, text = toxicity.windows(counts)
    for t, n in enumerate(counts):
        own = index[text == t]
        first = counts[:t].sum()
        assert sorted(set(own[own >= 0].tolist())) == list(range(first, first + n))
    assert len(index[text == 6]) == 8


def test_scores_do_not_depend_on_the_slice(spark, tables):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = toxicity.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"), per_label=60)
    texts = [tables[0][i].text for i in sorted(tables[0])[:60]] + [None, "", "."]
    together = toxicity.score_texts(model, texts)
    alone = [toxicity.score_texts(model, [t])[0] for t in texts]
    assert np.allclose(together, alone, atol=1e-4) and together[-3:].tolist() == [0, 0, 0]


def test_logistic_finds_the_weights():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(20000, 2)) * [3, 0.1]
    y = (rng.random(20000) < 1 / (1 + np.exp(-(0.5 * x[:, 0] - 4 * x[:, 1] + 1)))).astype(float)
    assert np.allclose(logistic(x, y, np.ones(len(y)), 1e-6), [0.5, -4, 1], atol=0.3)


def test_held_out_rows(spark):
    rows = spark.range(50).withColumnRenamed("id", "doc_id").withColumn("h", held_out()).collect()
    assert all(r.h == held(r.doc_id) for r in rows)
    assert spark.sql("SELECT CAST(NULL AS BIGINT) AS doc_id").select(held_out().alias("h")).first().h is True
