import hashlib

import numpy as np
import plain
import pytest

import corpus_pipeline
from yieldwatch.sources.scratch import settle


@pytest.fixture(scope="module")
def stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    odd = spark.createDataFrame([(10**9, None, "en", "s", None), (10**9 + 1, "", None, None, 0), (None, "odd one", "en", "s", 7)], docs.schema)
    kept = [docs.unionByName(odd).unionByName(docs.limit(3))]
    for name, stage in corpus_pipeline.STAGES:
        kept.append(settle(stage(spark, kept[-1], sf)))
    return kept


def test_stages_keep_the_columns_of_documents(stages):
    for df in stages[1:-1]:
        assert df.columns == stages[0].columns and [t for _, t in df.dtypes] == [t for _, t in stages[0].dtypes]


def test_quality_goes_by_the_labels(spark, sf, stages):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    kept = {r["doc_id"] for r in stages[1].collect()}
    right = [(i in kept) == bool(q) for i, q in labels.items()]
    assert np.mean(right) > 0.95


def test_no_near_duplicates_are_left_and_no_group_is_lost(stages):
    before, after = ([(r["doc_id"], plain.shingles(r["text"])) for r in df.collect()] for df in stages[1:3])
    links = lambda a, b: a and b and 100 * len(a & b) >= 75 * len(a | b)
    assert not any(links(a, b) for i, (_, a) in enumerate(after) for _, b in after[:i])
    kept = {i for i, _ in after}
    assert all(i in kept or any(links(a, b) for j, b in before if j != i or a is not b) for i, a in before)


def test_no_item_is_left(spark, sf, stages):
    items = [" ".join(plain.words(r["text"])) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    dirty = [r["doc_id"] for r in stages[2].collect() if any(i in " ".join(plain.words(r["text"])) for i in items)]
    kept = {r["doc_id"] for r in stages[3].collect()}
    assert dirty and not set(dirty) & kept and len(kept) > 0.9 * stages[2].count() - len(dirty)


def test_personal_data_is_masked_and_nothing_else_changes(stages):
    before = {r["doc_id"]: r for r in stages[3].collect()}
    for r in stages[4].collect():
        old = before[r["doc_id"]]
        assert plain.base_spans(r["text"]) == []
        assert r["n_chars"] == (None if r["text"] is None else len(r["text"]))
        if not plain.base_spans(old["text"]) and r["text"] != old["text"]:
            assert "<IBAN>" in r["text"] or "<SSN>" in r["text"]
    assert stages[4].count() == stages[3].count()


def test_tokens_decode_to_the_text(stages):
    texts = {r["doc_id"]: r["text"] or "" for r in stages[4].collect()}
    out = stages[5].collect()
    assert len(out) == len(texts)
    for r in out:
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()
        assert r["n_tokens"] == len(r["token_ids"]) // 4


def test_run_gives_the_last_stage(spark, sf):
    out = corpus_pipeline.run(spark, sf)
    assert {"doc_id", "token_ids", "n_tokens"} <= set(out.columns) and out.count() > 50
