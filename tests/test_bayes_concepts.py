"""Naive Bayes by counts and many concept searches in one pass, against plain Python and the one-search operator."""
import math
import re
from collections import Counter

from veriscope.operators import bayes, concepts
from veriscope.operators.filters import concept_filter


def test_naive_bayes_equals_plain_counts(spark):
    train = [("the sea is rising", 1), ("sea level and the ice", 1), ("buy cheap now now", 0), ("now cheap", 0), (None, 0), ("left out", None)]
    texts = [(1, "the sea now"), (2, "cheap cheap sea"), (3, ""), (None, None), (5, "never seen"), (1, "the sea now"), (6, "now " * 5000)]
    got = bayes.classify(spark.createDataFrame([(i, t, "x") for i, t in texts], "doc_id long, text string, s string"),
                         *bayes.train(spark.createDataFrame(train, "text string, label int"))).collect()
    n = {c: Counter(w for t, y in train if y == c for w in re.findall("[a-z]+", t or "")) for c in (0, 1)}
    vocabulary = set(n[0]) | set(n[1])

    def micro(x):
        return round(math.log(x) * 1_000_000)

    def share(w, c):
        return micro((n[c][w] + 1) / (sum(n[c].values()) + len(vocabulary)))

    want = []
    for i, t in texts:
        m = micro(3) - micro(4) + sum(share(w, 1) - share(w, 0) for w in re.findall("[a-z]+", t or "") if w in vocabulary)
        want.append((i, "Yes" if m >= 0 else "No", round(1 / (1 + math.exp(-abs(m) / 1e6)), 6), m))
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_naive_bayes_without_rows(spark):
    none = spark.createDataFrame([], "doc_id long, text string, label int")
    weights, prior = bayes.train(none)
    assert weights.count() == 0 and prior.first()["prior"] == 0
    one = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    assert [tuple(r) for r in bayes.classify(one, weights, prior).collect()] == [(1, "Yes", 0.5, 0)]
    assert bayes.classify(none, weights, prior).count() == 0


def test_searches_equal_one_by_one(spark):
    docs = [(1, "Sea level  rise in the\nNorth Sea."), (2, "sea. level rise; north sea"), (3, "the sealevel rise"), (4, None), (5, ""),
            (6, "ice-sheet melt and sea level"), (7, "NORTH   sea: sea level"), (8, "x y " * 3000 + "sea level rise"), (8, "north sea")]
    groups = {10: ['"sea level" OR "ice"', '"north sea" OR rise'], 11: ["melt"], 12: ['"sea level rise"'], 13: ["sea", "absent"]}
    table = spark.createDataFrame(docs, "doc_id long, text string")
    searches = spark.createDataFrame([(s, k, g) for s, gs in groups.items() for k, g in enumerate(gs)], "search_id long, group_no int, group_text string")
    single = table.where("doc_id <> 8")
    got = {(r["search_id"], r["doc_id"]) for r in concepts.search_many(single, searches).collect()}
    assert got == {(s, r["doc_id"]) for s, gs in groups.items() for r in concept_filter(single, "text", gs).collect()}
    counts = {tuple(r) for r in concepts.search_many(table, searches).where("doc_id = 8").collect()}
    assert counts == {(10, 8, 3), (12, 8, 1)}
    assert concepts.search_many(table.where("false"), searches).count() == 0
    assert concepts.search_many(table, searches.where("false")).count() == 0
