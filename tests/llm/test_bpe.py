import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from yieldwatch.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
TEXTS = [None, "", " ", "'", "''s", "don't they'll 're", " 's", "\n's", "a  b", "a\n\nb \n", "x" * 5000, " " * 3000, "a'" * 200, "٣٤ ½", "漢字 e\u0301", "<|endoftext|>", "\u0085a", "\x1cb"]


@pytest.fixture(scope="module")
def reference():
    ranks = bpe.read_ranks(PATH)
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def rows(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "id int, text string")


def test_ids_and_bytes_are_those_of_the_library(spark, reference):
    random.seed(3)
    signs = list("abstrvemldSTé漢٣12½'’ \n\t\r\u3000.,!-") + ["'re", "'ll", "'s", "'ve", " '", "\u200b", "😀"]
    texts = TEXTS + ["".join(random.choices(signs, k=random.randint(0, 80))) for _ in range(2000)]
    coded = bpe.encode(rows(spark, texts), PATH, decoded="back").collect()
    assert len(coded) == len(texts)
    for row in coded:
        expected = reference.encode_ordinary(texts[row["id"]] or "")
        ids = np.frombuffer(row["token_ids"], dtype="<u4").tolist()
        assert ids == expected and row["n_tokens"] == len(expected)
        assert bytes(row["back"]) == (texts[row["id"]] or "").encode()
        starts = np.frombuffer(row["token_offsets"], dtype="<u4").tolist()
        lengths = [len(reference.decode_single_token_bytes(i)) for i in ids]
        assert starts == [sum(lengths[:k]) for k in range(len(ids))]


def test_clashing_columns_are_replaced_and_others_kept(spark):
    df = rows(spark, ["a b", "a b"]).withColumns({"n_tokens": F.lit("old"), "Token_IDs": F.lit(1), "part": F.lit(2)})
    out = bpe.encode(df, PATH)
    assert out.columns == ["id", "text", "part", "token_ids", "token_offsets", "n_tokens"]
    assert [r["n_tokens"] for r in out.collect()] == [2, 2]
    again = bpe.decode(out.withColumn("decoded", F.lit(0)), PATH)
    assert {bytes(r["decoded"]) for r in again.collect()} == {b"a b"}
    assert again.select(bpe.unpack_ids(F.col("token_ids")).alias("x")).first()["x"] == [64, 275]


def test_empty_tables_null_ids_and_unknown_ids(spark):
    assert bpe.encode(rows(spark, []), PATH).count() == 0
    df = spark.createDataFrame([(None, None)], "token_ids binary, token_offsets binary")
    assert bpe.decode(df, PATH).first()["decoded"] is None
    bad = spark.createDataFrame([(b"\xff\xff\xff\x7f", b"\0\0\0\0")], "token_ids binary, token_offsets binary")
    with pytest.raises(Exception, match="not an id"):
        bpe.decode(bad, PATH).collect()


def test_long_pieces_merge_as_short_ones():
    ranks = bpe.read_ranks(PATH)
    random.seed(4)
    for n in (2, 9, 100, 400):
        piece = bytes(random.choices(b"abcde \xc3\xa9", k=n))
        assert bpe._cuts_short(piece, ranks) == bpe._cuts_long(piece, ranks)
