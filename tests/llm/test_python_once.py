"""A task runs Python once at a time, so an executor has no more Python workers than cores."""

import pytest

from yieldwatch.llm import decontaminate, jaccard


@pytest.fixture
def stored(monkeypatch):
    """(found, note): the number of Arrow UDF steps in the plan of each stored table, and of each that is noted."""
    found = []

    def note(df):
        found.append(df._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython"))
        return df

    for module in (decontaminate, jaccard):
        monkeypatch.setattr(module, "settle", lambda df, settle=module.settle: settle(note(df)))
    return found, note


def rows(spark):
    words = [" ".join(f"w{i * 100 + k}" for k in range(30)) for i in range(4)]
    texts = [*words, words[0] + " more", words[1], "", None, "\t "]
    return spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"), words


def test_classes_are_computed_once_for_words_and_once_for_no_words(spark, stored):
    found, note = stored
    docs, _ = rows(spark)
    kept = note(jaccard.keep_one(docs))
    assert found[-1] == 2  # one for each side of the union
    assert sorted(r["doc_id"] for r in kept.collect()) == [0, 1, 2, 3, 6, 7, 8]


def test_a_pair_is_verified_once_and_a_text_named_once(spark, stored):
    found, note = stored
    docs, words = rows(spark)
    items = spark.createDataFrame([(7, words[0]), (8, "not in any of the texts at all")], "item_id bigint, text string")
    clean = note(decontaminate.drop_contaminated(docs, items))
    assert [steps for steps in found if steps] == [1, 1]
    assert sorted(r["doc_id"] for r in clean.collect()) == [1, 2, 3, 5, 6, 7, 8]
