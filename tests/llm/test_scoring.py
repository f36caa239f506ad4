import math
import random
from collections import Counter

import numpy as np
import plain
import pytest
from pyspark.sql import functions as F

from yieldwatch.llm import scoring


def corpus():
    random.seed(13)
    common, rare = [f"c{i}" for i in range(12)], [f"r{i}" for i in range(2000)]
    texts = []
    for _ in range(150):
        words = []
        while len(words) < random.randint(0, 60):
            words += ["new", "york"] if random.random() < 0.2 else [random.choice(common if random.random() < 0.6 else rare)]
        texts.append(" ".join(words))
    return [(i, t) for i, t in enumerate(texts + [None, "", "New  YORK\t", "unseen words here"])] + [(3, texts[3]), (None, texts[4])]


def plain_model(rows, learned):
    """The automaton by plain counting, and the tokens of each text."""
    seqs = [plain.words(t) + ["\n"] for _, t in rows]
    counts, pairs, triples = Counter(), Counter(), Counter()
    for seq, train in zip(seqs, learned):
        if train:
            counts.update(seq)
            pairs.update(zip(["\n"] + seq, seq))
            triples.update(zip(["\n"] + seq, seq, seq[1:]))
    total, distinct = sum(counts.values()), len(counts)

    def p(w):
        return (counts[w] + 0.5) / (total + 0.5 * (distinct + 1))

    expected: dict = {}

    def failure(c):
        if c not in expected:
            expected[c] = sum(1 - (1 - n / total) ** c for n in counts.values())
        return expected[c] / (c + expected[c])

    def arc(state, w):
        """The weight of reading w in a state: its arc, or failure arcs until there is one."""
        if not state:
            return p(w)
        seen, of = (pairs[state[0], w], counts[state[0]]) if len(state) == 1 else (triples[(*state, w)], pairs[state])
        f = failure(of)
        return (1 - f) * seen / of + f * arc(state[1:], w)

    def state_after(history):
        """The longest state that the history ends in."""
        if len(history) == 2 and pairs[history] >= scoring.STATE_LEAST:
            return history
        return history[-1:] if counts[history[-1]] else ()

    out = []
    for seq in seqs:
        state, before, score = (state_after(("\n",)) if total else ()), ("\n",), 0.0
        for w in seq:
            score += math.log10(arc(state, w))
            before = (before + (w,))[-2:]
            state = state_after(before)
        base = sum(math.log10(p(w)) for w in seq)
        out.append((len(seq), sum(counts[w] > 0 for w in seq), total, base, score))
    return out, counts, pairs, triples, arc


def run(spark, rows, learned, **settings):
    df = spark.createDataFrame([(i, *r, t) for i, (r, t) in enumerate(zip(rows, learned))], "n int, doc_id int, text string, train boolean")
    return scoring.score_texts(df, F.col("train"), keys=("n", "doc_id"), **settings)


@pytest.mark.parametrize("learned", [lambda i: i % 5 != 1 and (None if i == 7 else True), lambda i: True])
def test_scores_are_those_of_the_automaton(spark, learned):
    """Order three: states of two words, one and none, failure arcs from one to the next."""
    rows = corpus()
    marks = [learned(i) for i in range(len(rows))]
    expected, counts, pairs, triples, arc = plain_model(rows, [bool(x) for x in marks])
    out = run(spark, rows, marks).collect()
    assert sorted(r["n"] for r in out) == list(range(len(rows)))
    for r in out:
        n, known, total, base, score = expected[r["n"]]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (n, known, total)
        assert r["base_score"] == pytest.approx(base, abs=1e-9)
        # The histogram puts near counts together.
        assert r["score"] == pytest.approx(score, rel=0.01, abs=1e-6)
        assert r["doc_id"] == rows[r["n"]][0]
    # Arcs of three words matter, and all arcs of a state sum to 1.
    assert sum(c >= scoring.STATE_LEAST for c in pairs.values()) > 50
    for state in ((), ("new",), ("new", "york")):
        assert sum(arc(state, w) for w in counts) + arc(state, "never seen") == pytest.approx(1.0, abs=1e-9)


def test_failure_weights_come_from_the_histogram(spark):
    counts = Counter(w for _, t in corpus() for w in plain.words(t) + ["\n"])
    total = sum(counts.values())
    model = scoring.Automaton(total, len(counts), np.array(sorted(counts.values()), dtype=float), np.ones(len(counts), dtype=np.int64))
    for c in set(counts.values()):
        t = sum(1 - (1 - n / total) ** c for n in counts.values())
        assert model.failure_of(np.array([c]))[0] == pytest.approx(t / (c + t))


def test_packed_keys_come_back():
    rng = np.random.default_rng(4)
    for keys in ([5], [0, 2**64 - 1], sorted(rng.integers(0, 2**64, 1000, dtype=np.uint64).tolist()), [2**63, 2**63 + 1]):
        keys = np.array(keys, dtype=np.uint64)
        assert scoring._unpacked(scoring._packed(keys)).tolist() == keys.tolist()
        bucket, at = scoring._dealt(keys, 64)
        assert [int(k) * 64 >> 64 for k in keys[at[:-1]]] == bucket.tolist()


def test_a_copy_scores_higher_than_a_text_of_the_same_words(spark):
    random.seed(32)
    words = [f"w{i}" for i in range(300)]
    texts = [" ".join(random.choices(words, k=40)) for _ in range(120)]
    other = texts[5].split()
    random.shuffle(other)
    rows = list(enumerate([*texts, texts[5], " ".join(other)]))
    out = {r["n"]: r for r in run(spark, rows, [i < 120 for i in range(122)]).collect()}
    assert out[120]["base_score"] == pytest.approx(out[121]["base_score"])
    assert out[120]["score"] > out[121]["score"] + 20


def test_very_long_and_repeated_texts(spark, monkeypatch):
    monkeypatch.setattr(scoring, "BLOCK_BYTES", 1 << 12)
    random.seed(33)
    words = [f"w{i}" for i in range(50)]
    rows = [(1, " ".join(random.choices(words, k=60_000))), (2, "a " * 3), (2, "a " * 3), (2, "a " * 3), (3, " ".join(random.choices(words, k=500)))]
    expected, *_ = plain_model(rows, [True] * 5)
    out = run(spark, rows, [True] * 5).collect()
    assert len(out) == 5
    for r in out:
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == expected[r["n"]][:3]
        assert r["score"] == pytest.approx(expected[r["n"]][4], rel=0.01)


def test_keys_named_like_made_columns(spark):
    df = spark.createDataFrame([(1, 2, "a b")], "score int, block int, text string")
    out = scoring.score_texts(df, F.lit(True), keys=("score", "block"))
    assert out.columns == ["_score", "block", *scoring.MADE]
    assert tuple(out.first())[:4] == (1, 2, 3, 3)


def test_texts_do_not_move(spark):
    """The table of blocks is read in its buckets: only asks and answers are exchanged."""
    df = spark.createDataFrame([(i, f"a b {i}") for i in range(50)], "doc_id int, text string")
    plan = scoring.score_texts(df, F.lit(True))._jdf.queryExecution().executedPlan().toString()
    moved = [line for line in plan.splitlines() if "Exchange" in line]
    assert moved and all("text" not in line for line in moved)
    assert plan.count("Exchange hashpartitioning(block") <= 2


def test_query_columns(spark, tmp_path):
    import zlib

    from yieldwatch.llm import queries

    rows = [(i, t) for i, (_, t) in enumerate(corpus())] + [(None, "x y")]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(str(tmp_path / "documents.parquet"))
    held = [r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 1 for r in rows]
    expected, *_ = plain_model(rows, [not h for h in held])
    found = {r["doc_id"]: r for r in queries.QUERIES["op1_backoff_automaton"](spark, str(tmp_path)).collect()}
    assert len(found) == len(rows)
    for (key, _), h, want in zip(rows, held, expected):
        row = found[key]
        assert (row["held_out"], row["n_tokens"], row["n_known"], row["train_tokens"]) == (h, *want[:3])
        assert row["base_score"] == pytest.approx(want[3], abs=1e-9) and row["score"] == pytest.approx(want[4], rel=0.01, abs=1e-6)


def test_the_number_of_blocks_changes_no_score(spark, monkeypatch):
    rows = corpus()
    learned = [i % 2 == 0 for i in range(len(rows))]
    one = {r["n"]: r for r in run(spark, rows, learned).collect()}
    monkeypatch.setattr(scoring, "LEAST_GROUPS", 3)
    monkeypatch.setattr(scoring, "BLOCK_BYTES", 900)
    for r in run(spark, rows, learned).collect():
        assert r["base_score"] == pytest.approx(one[r["n"]]["base_score"], abs=1e-9)
        assert r["score"] == pytest.approx(one[r["n"]]["score"], abs=1e-9)


def test_nothing_to_learn_from_and_empty_tables(spark):
    out = run(spark, [(1, "a b"), (2, None)], [False, False]).collect()
    assert [(r["n_tokens"], r["n_known"], r["train_tokens"], r["score"]) for r in sorted(out)] == [(3, 0, 0, 0.0), (1, 0, 0, 0.0)]
    df = spark.createDataFrame([], "doc_id int, text string")
    assert scoring.score_texts(df, F.lit(True)).count() == 0


def test_rare_histories_keep_their_pairs_in_a_larger_corpus(spark):
    random.seed(31)
    common = [f"c{i}" for i in range(40)]
    # Each rare word occurs twice, both times before the same word.
    rare = [(f"h{i}", f"t{i % 700}") for i in range(3000)] * 2
    random.shuffle(rare)
    texts = [" ".join(w for pair in rare[k : k + 20] for w in (*pair, *random.choices(common, k=4))) for k in range(0, len(rare), 20)]
    rows = list(enumerate(texts))
    expected, counts, pairs, *_ = plain_model(rows, [True] * len(rows))
    assert sum(counts.values()) > 30_000 and counts["h5"] == pairs["h5", "t5"] == 2
    for r in run(spark, rows, [True] * len(rows)).collect():
        assert r["score"] == pytest.approx(expected[r["n"]][4], rel=0.01)
        assert r["base_score"] == pytest.approx(expected[r["n"]][3], abs=1e-9)
