import random

from pyspark.sql import functions as F

from yieldwatch.llm import decontaminate

random.seed(12)
WORDS = [f"v{i}" for i in range(3000)]
ITEMS = [random.choices(WORDS, k=n) for n in (40, 40, 25, 12, 8, 5, 4, 300)]


def text(n):
    return random.choices(WORDS, k=n)


def substituted(words, every):
    return [random.choice(WORDS) if i % every == every - 1 else w for i, w in enumerate(words)]


def planted():
    """(text, item): what is planted, or None."""
    out = [(text(n), None) for n in (0, 1, 5, 50, 500, 9000)]
    for k, item in enumerate(ITEMS):
        if len(item) >= decontaminate.SHORTEST:
            out += [(text(30) + item + text(30), k), (item, k), (text(5000) + item, k)]
    out += [(text(20) + substituted(ITEMS[k], 6) + text(9), k) for k in (0, 1, 7)]
    out += [(text(20) + ITEMS[0][10:26] + text(20), 0), (ITEMS[7][100:140] + text(3), 7)]
    out += [(text(5) + ITEMS[6] + text(5), None), (ITEMS[0][:6] + text(30), None), (ITEMS[4][:4] + text(30), None)]
    # All words of an item, in another order.
    out.append((sorted(ITEMS[0]), None))
    return out


def frames(spark):
    cases = planted()
    rows = [(i, " ".join(w).upper() if i % 3 == 0 else "\n".join(w)) for i, (w, _) in enumerate(cases)]
    items = [(k, " ".join(w)) for k, w in enumerate(ITEMS)] + [(90, " ".join(ITEMS[0])), (91, None), (92, "")]
    docs = spark.createDataFrame(rows + [(1000, None), rows[7]], "doc_id int, text string")
    return cases, docs, spark.createDataFrame(items, "item_id int, text string")


def test_planted_passages_are_found_and_clean_texts_left(spark):
    cases, docs, items = frames(spark)
    out = decontaminate.find_overlaps(docs, items).collect()
    assert len(out) == len(cases) + 2
    for row in out:
        expected = None if row["doc_id"] == 1000 else cases[row["doc_id"]][1]
        assert (row["contaminated"], row["item_id"]) == (expected is not None, expected), row
    whole = next(r for r in out if r["doc_id"] == 6)
    assert (whole["first_word"], whole["last_word"], whole["matched"]) == (30, 70, 40)


def test_contaminated_rows_go_with_all_columns_kept(spark):
    cases, docs, items = frames(spark)
    docs = docs.withColumns({"_name": F.lit("x"), "name": F.lit(1)})
    out = decontaminate.drop_contaminated(docs, items)
    assert out.columns == docs.columns
    assert sorted(r["doc_id"] for r in out.collect()) == [i for i, (_, k) in enumerate(cases) if k is None] + [1000]


def test_empty_tables(spark):
    _, docs, items = frames(spark)
    assert decontaminate.find_overlaps(docs.limit(0), items).count() == 0
    assert decontaminate.drop_contaminated(docs, items.limit(0)).count() == docs.count()


def test_overlap_is_the_best_stretch():
    import numpy as np

    a = np.arange(10, dtype=np.uint64)
    b = a.copy()
    b[4] = 99
    assert decontaminate.overlap(a, b, 0) == (9 - decontaminate.PENALTY, 9, 0, 10)
    assert decontaminate.overlap(a, b, 20)[0] == 0
    assert decontaminate.overlap(a[3:], a, -3) == (7.0, 7, 0, 7)


def best_without_seeds(seeds, longest):
    """The best score of a row of matches and changes that avoids all seeds; longest: of at most
    so many words, or None for any number."""
    import numpy as np

    width = max(int(m[-1]) + 1 for m in seeds) - 1
    state = np.arange(1 << width)  # the last words, 1 for a match
    window = state << 1 | 1
    patterns = [sum(1 << int(m[-1] - offset) for offset in m) for m in seeds]
    hit = np.any([(window & p) == p for p in patterns], axis=0)
    before = [state >> 1, state >> 1 | (1 << width) >> 1]
    match = state & 1 == 1
    best = np.where(state == 0, 0.0, -np.inf)
    for _ in range(longest or 5000):
        came = np.maximum(*[np.where(match & hit[b], -np.inf, best[b]) for b in before])
        longer = np.maximum(best, came + np.where(match, 1.0, -decontaminate.PENALTY))
        if longest is None and (longer == best).all():
            return best.max()  # no longer row is better
        best = longer
    return best.max() if longest else np.inf


def test_no_overlap_of_the_needed_score_avoids_the_seeds():
    needed = lambda n: min(decontaminate.NEEDED, decontaminate.SHARE * n)
    for n in range(decontaminate.SHORTEST, 21):
        short = n < decontaminate.SPACED_FROM
        masks = decontaminate.masks_for([n] if short else [])
        seeds = masks[len(decontaminate.MASKS) :] if short else masks
        assert best_without_seeds(seeds, n) < needed(n), n
    assert best_without_seeds(decontaminate.masks_for([]), None) < decontaminate.NEEDED


def test_changed_and_partial_items_are_those_of_a_search_of_all_places(spark):
    import numpy as np

    rng = random.Random(44)
    items = [rng.sample(range(3000), n) for n in range(5, 21) for _ in range(2)]
    texts = []
    for item in items:
        for changes in (0, 1, 1, 2, 2, 3, 3):
            copy = list(item)
            for place in rng.sample(range(len(item)), changes):
                copy[place] = rng.randrange(3000, 6000)
            texts.append(rng.choices(range(6000, 9000), k=7) + copy + rng.choices(range(6000, 9000), k=7))
        for size in (10, 11):
            if len(item) > size:
                begin = rng.randrange(len(item) - size + 1)
                texts.append(rng.choices(range(6000, 9000), k=4) + item[begin : begin + size] + rng.choices(range(6000, 9000), k=4))
    for places in ((1, 3), (0, 1), (6, 8), (4, 9), (11, 13)):
        texts.append([9000 + i if i in places else w for i, w in enumerate(items[20])])

    def best(text):
        rows = [np.array(x, dtype=np.uint64) for x in (text, *items)]
        found = [max(decontaminate.overlap(rows[0], r, s)[0] for s in range(-len(r) + 1, len(text))) for r in rows[1:]]
        fit = [(-f, k) for k, f in enumerate(found) if f >= min(10.0, 0.75 * len(items[k]))]
        return (min(fit)[1], -min(fit)[0]) if fit else (None, None)

    words = lambda row: " ".join(f"w{i}" for i in row)
    docs = spark.createDataFrame([(i, words(t)) for i, t in enumerate(texts)], "doc_id int, text string")
    bench = spark.createDataFrame([(k, words(r)) for k, r in enumerate(items)], "item_id int, text string")
    out = {r["doc_id"]: (r["item_id"], r["score"]) for r in decontaminate.find_overlaps(docs, bench).collect()}
    assert out == {i: best(t) for i, t in enumerate(texts)}


def test_keys_named_like_made_columns(spark):
    item = " ".join(ITEMS[0])
    docs = spark.createDataFrame([(1, item), (2, "a b c")], "score int, text string")
    items = spark.createDataFrame([(7, item)], "matched int, text string")
    out = decontaminate.find_overlaps(docs, items, key="score", item_key="matched")
    assert out.columns == ["_score", "contaminated", "_matched", "score", "matched", "first_word", "last_word"]
    assert {r["_score"]: (r["contaminated"], r["_matched"], r["matched"]) for r in out.collect()} == {1: (True, 7, 40), 2: (False, None, None)}
