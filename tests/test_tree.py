"""The tree's search equals the exact one and reads fewer rows."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from veriscope.operators import knn, tree
from veriscope.session import scratch_path

SF = "/root/testdata/sf0.001"


def frames(spark, docs, queries):
    d = spark.createDataFrame([(i, None if v is None else [float(x) for x in v]) for i, v in enumerate(docs)],
                              "doc_id long, embedding array<double>")
    q = spark.createDataFrame([(i, None if v is None else [float(x) for x in v]) for i, v in enumerate(queries)],
                              "claim_id long, embedding array<double>")
    return d, q


def rows(df):
    return sorted(tuple(r) for r in df.select("claim_id", "doc_id", "rank", "score").collect())


def both(spark, d, q, k, metric, **kw):
    path = tree.build_tree(d, scratch_path(spark, "tree"), metric=metric, **kw)
    return rows(tree.search(q, spark, path, k, metric)), rows(knn.knn_topk(q, d, k, metric)), path


@pytest.mark.parametrize("metric", ["cosine", "dot_product"])
def test_equals_exact_with_ties_zeros_and_nulls(spark, metric):
    rng = np.random.default_rng(4)
    docs = [*rng.integers(0, 3, size=(300, 6)).astype(float), np.zeros(6), None, *np.full((40, 6), 2.0)]
    queries = [*rng.integers(-1, 3, size=(25, 6)).astype(float), np.zeros(6), None]
    d, q = frames(spark, docs, queries)
    got, want, _ = both(spark, d, q, 7, metric)
    assert got == want
    got, want, _ = both(spark, d, q, 500, metric, leaves=5)         # more asked for than there is
    assert got == want


def test_empty_sides(spark):
    d, q = frames(spark, [[1.0, 2.0]] * 3, [[1.0, 0.0]])
    path = tree.build_tree(d.limit(0), scratch_path(spark, "tree"))
    assert tree.search(q, spark, path).count() == 0
    path = tree.build_tree(d, scratch_path(spark, "tree"))
    assert tree.search(q.limit(0), spark, path).count() == 0 and tree.search(q, spark, path).count() == 3


def test_groups_are_cut_without_changing_rows(spark, monkeypatch):
    monkeypatch.setattr(tree, "GROUP_ROWS", 16)
    monkeypatch.setattr(tree, "QUERY_ROWS", 4)
    rng = np.random.default_rng(6)
    d, q = frames(spark, rng.normal(size=(200, 5)), rng.normal(size=(30, 5)))
    got, want, _ = both(spark, d, q, 5, "cosine", leaves=4)
    assert got == want


def test_clustered_store_skips_leaves_and_rows(spark):
    rng = np.random.default_rng(8)
    heads = rng.normal(size=(40, 16))
    docs = (heads[:, None, :] + 0.05 * rng.normal(size=(40, 50, 16))).reshape(-1, 16)
    d, q = frames(spark, docs, docs[::100] + 0.01)
    got, want, path = both(spark, d, q, 10, "cosine", leaves=64)
    assert got == want
    _, short = tree.shortlist(q, spark, path, 10)
    assert short.count() < 0.05 * q.count() * d.count()
    leaves = spark.read.parquet(f"{path}/leaves")
    assert leaves.agg(F.sum("n")).first()[0] == d.count() and leaves.count() > 20


def test_given_vectors_read_under_a_third(spark):
    e = spark.read.parquet(f"{SF}/embeddings.parquet").select(F.col("vec_id").alias("doc_id"), "embedding")
    q = e.where("doc_id % 100 = 0").withColumnRenamed("doc_id", "claim_id")
    path = tree.build_tree(e, scratch_path(spark, "tree"))
    assert rows(tree.search(q, spark, path)) == rows(knn.knn_topk(q, e))
    _, short = tree.shortlist(q, spark, path)
    assert short.count() < q.count() * e.count() / 3


def test_slices_bound_what_a_task_holds(spark, monkeypatch):
    for name in ("VISIT_CELLS", "VISIT_ROWS", "HELD_ROWS"):
        monkeypatch.setattr(tree, name, 70)
    rng = np.random.default_rng(7)
    d, q = frames(spark, rng.normal(size=(300, 5)), rng.normal(size=(40, 5)))
    for metric in ("cosine", "dot_product"):
        got, want, path = both(spark, d, q, 5, metric)
        assert got == want
    _, short = tree.shortlist(q, spark, path, 5)
    assert short.count() < q.count() * d.count()
