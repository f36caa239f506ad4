"""The queries themselves, on a small table with odd rows, against plain recomputations."""

import glob
import hashlib
import random
import zlib

import duckdb
import numpy as np
import plain
import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline
from yieldwatch.llm import bpe, queries

random.seed(41)
WORDS = [f"w{i}" for i in range(400)]
ITEM = random.choices(WORDS, k=30)


def sentence(n):
    return " ".join(random.choices(WORDS, k=n))


def documents():
    rows = [(i, sentence(random.randint(1, 60)), random.choice(["en", "de", None]), f"s{i % 3}", i) for i in range(60)]
    long = sentence(4000)
    odd = [None, "", " \t\n", "x", "mail a@b.org or 10.0.0.1, card 4111 1111 1111 1111, call +1 (743) 555-3824", long, " ".join(ITEM) + " end", "漢字 é́ 😀"]
    rows += [(100 + i, t, "en", "s", None) for i, t in enumerate(odd)]
    rows += [(200, rows[5][1], "en", "s", 1), (201, rows[5][1] + " more", "en", "s", 1), rows[7], (None, "no id here", None, None, None)]
    return rows


DOCUMENTS = documents()
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("tables")
    rows = DOCUMENTS
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{path}/documents.parquet")
    labels = [(r[0], int(i % 2), 0) for i, r in enumerate(rows) if r[0] is not None and r[0] < 60] + [(None, 1, 0)]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, " ".join(ITEM)), (2, None)], "item_id bigint, text string").write.parquet(f"{path}/benchmark.parquet")
    vectors = [(i, np.random.default_rng(i).normal(size=8).astype(np.float32).tolist()) for i in range(90)] + [(100, None)]
    spark.createDataFrame(vectors, "vec_id bigint, embedding array<float>").write.parquet(f"{path}/embeddings.parquet")
    return str(path)


def rows_of(spark, folder, name):
    return queries.QUERIES[name](spark, folder).collect()


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def as_bag(rows):
    return sorted(map(str, rows))


def test_op3(spark, folder):
    found = {r["doc_id"]: r for r in rows_of(spark, folder, "op3_spaced_seeds")}
    assert [k for k, r in found.items() if r["contaminated"]] == [106] and found[106]["item_id"] == 1


def test_op4(spark, folder):
    found = rows_of(spark, folder, "op4_quadratic_quality")
    assert len(found) == len(DOCUMENTS)
    for r in found:
        assert r["held_out"] == (plain.crc_mod(r["doc_id"], 3) == 1)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)


def test_op5_equals_its_sql(spark, folder):
    found = rows_of(spark, folder, "op5_adaptive_prefix_join")
    sql = queries.JACCARD_SQL.replace("FROM documents", f"FROM (SELECT * FROM read_parquet('{folder}/documents.parquet/*.parquet') WHERE doc_id IS NOT NULL)")
    want = {r[0]: r[1:] for r in duckdb.sql(sql).fetchall()}
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found if r["doc_id"] is not None} == want
    assert want[200][1] == 5


def test_op6(spark, folder):
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = []
    for key, text, *_ in DOCUMENTS:
        ids = library.encode_ordinary(text or "")
        want.append((key, len(ids), sha(np.array(ids, dtype="<u4").tobytes()), sha(text or "")))
    assert as_bag(map(tuple, rows_of(spark, folder, "op6_byte_bpe"))) == as_bag(want)


def test_op8(spark, folder):
    found: dict = {}
    for r in rows_of(spark, folder, "op8_multi_index_hashing"):
        found.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    matrix = np.array([np.random.default_rng(i).normal(size=8).astype(np.float32) for i in range(90)]).astype(float)
    hits = 0
    for q in range(0, 90, 20):
        best = sorted((-float(matrix[i] @ matrix[q]), i) for i in range(90) if i != q)[:20]
        assert [r for r, _, _ in sorted(found[q])] == list(range(1, 21))
        assert all(s == pytest.approx(float(matrix[i] @ matrix[q]), abs=1e-12) for _, i, s in found[q])
        hits += len({i for _, i in best} & {i for _, i, _ in found[q]})
    assert set(found) == set(range(0, 90, 20)) and hits >= 0.9 * 100


def test_op9_is_the_permutation_recomputed(spark, folder):
    found = rows_of(spark, folder, "op9_feistel_shards")
    rows = DOCUMENTS
    want = [(k, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for k, t, *_ in rows]
    assert as_bag((r["doc_id"], r["size"], r["text_crc32"]) for r in found) == as_bag(want)
    assert {(r["law"], r["grown_shard"]) for r in found} == {("rows", None)}
    counts = [sum(r["shard"] == s for r in found) for s in range(8)]
    assert sum(counts) == len(rows) and max(counts) - min(counts) <= 1
    for s in range(8):
        assert sorted(r["slot"] for r in found if r["shard"] == s) == list(range(counts[s]))
    # Shard and slot follow from the row number alone.
    from pyspark.sql import functions as F

    from yieldwatch.llm import shards

    order = shards.Permutation(len(rows), seed=9)
    numbers = spark.range(len(rows)).select("id", order.position(F.col("id")).alias("p")).collect()
    place = {r["id"]: r["p"] for r in numbers}
    assert sorted(r["row_number"] for r in found) == list(range(len(rows)))
    assert all((place[r["row_number"]] % 8, place[r["row_number"]] // 8) == (r["shard"], r["slot"]) for r in found)


def test_op10(spark, folder):
    found = {r["doc_id"]: r for r in rows_of(spark, folder, "op10_pii_spans")}
    for key, text, *_ in DOCUMENTS:
        spans = plain.base_spans(text)
        r = found[key]
        for kind in plain.PATTERNS:
            assert r[f"n_{kind}"] == sum(k == kind for k, _, _ in spans)
        order = list(plain.PATTERNS)
        listed = ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (order.index(s[0]), s[1])))
        assert r["base_sha256"] == sha(listed)
        assert set(listed.split(",")) - {""} <= set(r["spans"].split(","))


def test_all_queries_on_empty_tables(spark, tmp_path):
    for name, schema in {
        "documents": SCHEMA, "labels": "doc_id bigint, quality int, toxic int", "benchmark": "item_id bigint, text string",
        "embeddings": "vec_id bigint, embedding array<float>", "pages": "page_id bigint, url string, html string",
    }.items():
        spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/{name}.parquet")
        assert glob.glob(f"{tmp_path}/{name}.parquet/*.parquet")
    for name, run in queries.QUERIES.items():
        assert run(spark, str(tmp_path)).count() == 0, name
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_pipeline_keeps_extra_columns_and_needs_no_labels_or_items(spark, folder, tmp_path):
    from pyspark.sql import functions as F

    docs = spark.read.parquet(f"{folder}/documents.parquet").withColumns({"key": F.lit(1), "name": F.lit("n"), "_pii": F.lit(2), "label": F.lit(3)})
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, str(tmp_path))
        assert kept.columns == docs.columns, name
        assert kept.select("label", "name").distinct().count() <= 1
