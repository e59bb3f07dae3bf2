from veriscope.operators import knn

# Scores 0.9 and 0.9 + 2e-7 are one value at 6 decimals; the smaller id has the lesser raw score.
STORE = [(1, [0.9, 0.0]), (2, [0.9 + 2e-7, 0.0]), (3, [0.1, 0.0])]


def test_raw_scores_find_the_true_neighbour(spark):
    store = spark.createDataFrame(STORE, "doc_id long, embedding array<double>")
    query = spark.createDataFrame([(7, [1.0, 0.0])], "claim_id long, embedding array<double>")
    for method in ("broadcast", "blocked"):
        for decimals, want in ((None, 2), (6, 1)):
            got = knn.knn_topk(query, store, 1, "dot_product", method=method, decimals=decimals).collect()
            assert [(r.doc_id, r.score) for r in got] == [(want, 0.9)], (method, decimals)
    for decimals, want in ((None, 2), (6, 1)):
        got = knn.topk_single(store, [1.0, 0.0], 1, "dot_product", decimals=decimals).collect()
        assert [(r.doc_id, r.score, r["rank"]) for r in got] == [(want, 0.9, 1)]
