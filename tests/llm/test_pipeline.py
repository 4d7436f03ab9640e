"""The pipeline, stage by stage, against what the operators and brute force say."""

import corpus_pipeline as pipeline
import pytest
from cases import documents, empty
from paralex.llm import language, toxicity
from paralex.llm.common import stored, table
from test_dedup import groups, plain_fingerprint, plain_removal
from test_tokens import check_packing

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = table(spark, SF, "documents"), []
    for name, stage in pipeline.STAGES:
        before, docs = docs, stored(stage(spark, docs, SF), name)
        out.append((before, docs))
    return out


def rows(df):
    return {r.doc_id: r for r in df.collect()}


def test_all_but_the_last_return_documents(spark, stages):
    for before, after in stages[:-1]:
        assert after.columns == before.columns == table(spark, SF, "documents").columns
        assert after.dtypes == before.dtypes


def test_language_and_toxicity_decide(spark, stages):
    before, after = stages[0]
    model = language.fit(before)
    assert set(rows(after)) == {i for i, r in rows(before).items() if not language.predict(model, r.text)["rejected"]}
    before, after = stages[1]
    model, docs = toxicity.fit(before, table(spark, SF, "labels")), rows(before)
    scores = dict(zip(docs, toxicity.score_texts(model, [r.text for r in docs.values()])))
    assert set(rows(after)) == {i for i, s in scores.items() if s < pipeline.TOXIC}


def test_one_of_near_copies_stays(stages):
    before, after = map(rows, stages[2])
    ids = sorted(before)
    root = groups([plain_fingerprint(before[i].text, 4) for i in ids], lambda a, b: (a ^ b).bit_count() <= 4)
    assert after == {i: before[i] for n, i in enumerate(ids) if root[n] == n}


def test_repeats_go_and_other_texts_stay(stages):
    before, after = map(rows, stages[3])
    for i, n, removed, kept in plain_removal(sorted((i, r.text) for i, r in before.items()), 20):
        assert after[i].text == (kept if removed else before[i].text)
        assert after[i].n_chars == (len(kept) if removed else before[i].n_chars)


def test_packing_holds_every_document(stages):
    before, after = stages[4]
    found = after.collect()
    assert {r.doc_id for r in found} == set(rows(before)) and check_packing(found, 4096) > 0


def test_odd_and_empty_documents(spark):
    for docs in (documents(spark).drop("offset", "length", "piece", "sequence_id"), empty(spark)):
        for name, stage in pipeline.STAGES:
            columns = docs.columns
            docs = stored(stage(spark, docs, SF), name)
            assert name == "packing" or docs.columns == columns


def test_run_is_registered(spark):
    import __spark_entry__ as entry

    assert "pipeline" in entry.queries() and "pipeline" not in entry.oracle_sql()
    assert [n for n, _ in pipeline.STAGES] == ["language", "toxicity", "near_copies", "repeats", "packing"]
