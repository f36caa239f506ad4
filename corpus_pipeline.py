"""A training corpus from raw documents: quality, near-duplicates, benchmark passages,
personal data, tokens. Each stage takes the rows that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from yieldwatch.llm import bpe, decontaminate, jaccard, pii, quality
from yieldwatch.llm.columns import free_name
from yieldwatch.llm.queries import crc_mod, table, vocabulary_path
from yieldwatch.sources.scratch import settle

#: SQL cannot express the fitted classifier, the components or the byte pairs.
ORACLE_SQL = None


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the classifier rejects (score below 0.5).

    It learns from the labels of those documents whose crc32(doc_id) mod 3 is not 1. Null
    and empty texts are judged by their (empty) statistics.
    """
    rows = settle(docs.filter(crc_mod(3) != 1).select("doc_id", quality.text_statistics("text").alias("statistics")))
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    model = quality.fit(rows.join(labels, "doc_id"))
    return docs.filter(model.score("text") >= 0.5)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest doc_id stays."""
    return jaccard.keep_one(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that hold a passage of the benchmark."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data by its kind; n_chars follows the new text. No document goes."""
    spans = free_name(docs, "_pii")
    masked = pii.mask(pii.find(docs, out=spans), spans=spans)
    return masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All columns with token_ids, token_offsets, n_tokens and the decoded bytes' sha256, which equals the text's."""
    decoded = free_name(docs, "_decoded")
    coded = bpe.encode(docs, vocabulary_path(), decoded=decoded)
    return coded.withColumn("decoded_sha256", F.sha2(decoded, 256)).drop(decoded)


STAGES = [
    ("quality", good_quality),
    ("near_duplicates", without_near_duplicates),
    ("decontamination", without_benchmark),
    ("personal_data", without_personal_data),
    ("byte_bpe", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each writes its result as Parquet for the next one."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
