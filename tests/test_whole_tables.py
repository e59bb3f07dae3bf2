import duckdb
import numpy as np
import pyarrow.parquet as pq
import pytest

import __spark_entry__ as E
from tests.test_entry import SF, _norm
from veriscope.operators import knn
from veriscope.plans import catalog

ALL = ["topk_dot_all", "topk_cosine_all", "topk_cosine_blocked_all", "ivf_full_probe_all", "ivf_probe_recall"]


@pytest.mark.parametrize("name", ALL)
def test_every_vector_is_a_query_and_the_oracle_agrees(spark, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{SF}/embeddings.parquet')")
    got = E.queries()[name](spark, SF).toPandas()
    assert _norm(got) == _norm(con.execute(E.oracle_sql()[name]).df())
    ids = pq.read_table(f"{SF}/embeddings.parquet")["vec_id"].to_pylist()
    assert set(got["query_id"]) == set(ids)


def _recall(got, sf):
    """Share of the exact top-k, by plain numpy, of the queries vec_id % 100 = 0."""
    t = pq.read_table(f"{sf}/embeddings.parquet")
    ids, v = t["vec_id"].to_numpy(), np.array(t["embedding"].to_pylist(), float)
    u = v / np.linalg.norm(v, axis=1, keepdims=True)
    hits = total = 0
    for i in np.flatnonzero(ids % 100 == 0):
        score = knn.round6(u @ u[i])
        exact = set(ids[np.lexsort((ids, -score))[:catalog.TOP_K]].tolist())
        hits += len(exact & set(got.loc[got["query_id"] == ids[i], "vec_id"]))
        total += len(exact)
    return hits / total


@pytest.mark.parametrize("sf", [SF, "/root/testdata/sf0.01", "/root/testdata/sf0.1"])
def test_probing_reaches_the_recall(spark, sf):
    assert _recall(E.queries()["ivf_probe_recall"](spark, sf).toPandas(), sf) >= knn.RECALL


def test_nprobe_follows_the_measured_recall(spark, out_dir):
    rng = np.random.default_rng(2)
    rows = [(i, rng.standard_normal(8).tolist()) for i in range(300)]
    store = spark.createDataFrame(rows, "doc_id long, embedding array<double>")
    knn.build_ivf_index(store, out_dir + "/ivf", "IVF_FLAT", 8)
    opened, centres = knn.open_ivf_index(spark, out_dir + "/ivf")
    queries = store.withColumnRenamed("doc_id", "claim_id")
    few, most, every = (knn.choose_nprobe(queries, opened, centres, 10, r) for r in (0.3, 0.9, 1.0))
    assert 1 <= few < most <= every <= 8
    assert knn.choose_nprobe(queries.limit(0), opened, centres) == 8
