import random

import plain
from pyspark.sql import functions as F

from yieldwatch.llm import pii


def found(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    return {r["id"]: [(s["kind"], s["start"], s["end"]) for s in r["pii"]] for r in pii.find(df).collect()}


def test_base_spans_are_those_of_plain_patterns(spark):
    random.seed(5)
    signs = list("a.b@c-+ ()é漢") + ["1", "22", "255", "4111 1111 1111 1111", "@x.org", "+1 (743) 555-3824", "10.0.0.1", "256.1.1.1", "\n", "000255"]
    texts = ["".join(random.choices(signs, k=random.randint(0, 25))) for _ in range(3000)]
    texts += [None, "", "a@b.c_d@e.f", "1.2.3.4.5.6.7.8", "a@b.c.@d.e", "+" * 50, "+1" + " " * 200, "x@y", "4" * 16, "0" * 17]
    for i, spans in found(spark, texts).items():
        assert [s for s in spans if s[0] in pii.BASE_KINDS] == plain.base_spans(texts[i]), texts[i]


def test_many_spans_and_long_runs_stay_right_and_quick(spark):
    many = " ".join(f"u{i}@h.org" for i in range(1500))
    texts = [many, "1" * 200_000, "a" * 200_000, "1 " * 50_000, "1." * 50_000, "+1" + "(" * 100_000]
    out = found(spark, texts)
    for i, text in enumerate(texts[:1]):
        assert [s for s in out[i] if s[0] == "email"] == plain.base_spans(text)
    assert [len(out[i]) for i in (1, 2, 3, 5)] == [0, 0, 0, 0]
    assert len(out[4]) == 12_500


def test_account_numbers_need_their_checksum_and_others_their_context(spark):
    texts = ["pay GB82 WEST 1234 5698 7654 32 now", "pay GB83 WEST 1234 5698 7654 32 now", "my ssn is 123-45-6789.", "part 123-45-6789.", "ssn 000-12-3456"]
    out = found(spark, texts)
    assert out[0] == [("iban", 4, 31)] and out[2] == [("ssn", 10, 21)]
    assert out[1] == out[3] == out[4] == []


def test_masking_and_clashing_columns(spark):
    texts = ["é write x@y.org or 10.0.0.1!", "call +1 10.0.0.1 23 45 now", None, "clean", "x@y.org"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string").withColumns({"_work": F.lit(1), "PII": F.lit(2), "_merged": F.lit(3)})
    out = pii.mask(pii.find(df))
    assert out.columns == ["id", "text", "_work", "_merged", "pii"]
    masked = {r["id"]: r["text"] for r in out.collect()}
    assert masked == {0: "é write <EMAIL> or <IP>!", 1: "call <PHONE> now", 2: None, 3: "clean", 4: "<EMAIL>"}
    assert pii.find(df.limit(0)).count() == 0


def test_context_reaches_over_other_matches_of_the_kind(spark):
    many = "taxpayer " + " ".join(f"123-45-678{i}" for i in range(5))
    out = found(spark, ["SSNs: 123-45-6789, 321-54-9876", "ssn 123-45-6789 " + "x" * 40 + " 321-54-9876", many, "123-45-6789 321-54-9876 is an ssn"])
    assert out[0] == [("ssn", 6, 17), ("ssn", 19, 30)]
    assert out[1] == [("ssn", 4, 15)]
    # The word lies 40 code points or less before the first three.
    assert out[2] == [("ssn", 9, 20), ("ssn", 21, 32), ("ssn", 33, 44)]
    assert out[3] == [("ssn", 0, 11), ("ssn", 12, 23)]


def test_words_after_account_numbers_are_not_their_groups(spark):
    iban = "BE68 5390 0754 7034"
    texts = [f"{iban}{rest}" for rest in ("", " IT", " PLEASE", " Please", " 1234", " MORE THAN EVER SEEN", "X", " A1B2C3")]
    texts += [f"{iban} {iban}", "BE68539007547034 GB82WEST12345698765432 OK", "BE69 5390 0754 7034 IT"]
    out = found(spark, texts)
    for i in (0, 1, 2, 3, 4, 5, 7):
        assert [s for s in out[i] if s[0] == "iban"] == [("iban", 0, 19)], texts[i]
    assert [s for s in out[6] if s[0] == "iban"] == [s for s in out[10] if s[0] == "iban"] == []
    assert [s for s in out[8] if s[0] == "iban"] == [("iban", 0, 19), ("iban", 20, 39)]
    assert [s for s in out[9] if s[0] == "iban"] == [("iban", 0, 16), ("iban", 17, 39)]


def test_a_word_that_makes_a_longer_number_valid_is_no_part_of_it(spark):
    """Of all words of four capitals that could follow, about one in 97 keeps the checksum."""
    account = "DE89 3704 0044 0532 0130 00"
    plain_code = account.replace(" ", "")

    def valid(code):
        turned = code[4:] + code[:4]
        return int("".join(str(int(c, 36)) for c in turned)) % 97 == 1

    words = [w for w in (f"{a}{b}" for a in "ABCDEFGHIJ" for b in ("AIR", "ANK", "OAT", "EAR", "UST", "ELL", "INE"))]
    belgian = "BE68 5390 0754 7034"
    lengthening = [w for w in (f"{a}{b}{c}T" for a in "ABCDEFGH" for b in "AEIOU" for c in "LMNRS") if valid(belgian.replace(" ", "") + w)]
    assert valid(plain_code) and lengthening
    texts = [f"{account} {w} x" for w in words[:5]] + [f"{belgian} {w} please" for w in lengthening]
    out = found(spark, texts)
    assert all([s for s in out[i] if s[0] == "iban"] == [("iban", 0, len(account))] for i in range(5))
    assert all([s for s in out[i] if s[0] == "iban"] == [("iban", 0, 19)] for i in range(5, len(texts)))
