"""Plan-shape checks for the scale properties the operators rely on."""

import numpy as np
from pyspark.sql import functions as F

from veriscope.operators import knn
from veriscope.operators.numbering import dense_index
from veriscope.sources.store import dedupe_documents


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_dedupe_collapses_copies_before_the_shuffle(spark):
    rows = [("hot", i, "same text") for i in range(300)] + [(f"k{i}", 1000 + i, f"t{i}") for i in range(200)]
    df = spark.createDataFrame(rows, "doc_key string, doc_id long, content string").repartition(6)
    out = dedupe_documents(df)
    p = plan(out)
    assert "partial_min" in p and p.index("Exchange hashpartitioning") < p.rindex("partial_min")
    got = {r.doc_key: r.doc_id for r in out.collect()}
    assert got["hot"] == 0 and len(got) == 201


def test_knn_prunes_candidates_before_the_shuffle(spark):
    rng = np.random.default_rng(0)
    store = spark.createDataFrame([(i, [float(x) for x in rng.normal(size=4)]) for i in range(200)],
                                  "doc_id long, embedding array<float>").repartition(4)
    q = spark.createDataFrame([(i, [float(x) for x in rng.normal(size=4)]) for i in range(5)],
                              "claim_id long, embedding array<float>")
    p = plan(knn.knn_topk(q, store, 3))
    # partial limit below the exchange, final limit above it; no nested-loop or cartesian join
    assert p.count("WindowGroupLimit") == 2
    assert "CartesianProduct" not in p and "NestedLoopJoin" not in p


def test_ivf_probe_prunes_cells(spark, out_dir):
    rng = np.random.default_rng(1)
    store = spark.createDataFrame([(i, [float(x) for x in rng.normal(size=4)]) for i in range(200)],
                                  "vec_id long, embedding array<float>")
    cents = knn.train_ivf(store, 4, seed=3)
    knn.write_ivf_store(store, cents, out_dir + "/ivf")
    q = knn.probe_cells(spark.createDataFrame([(0, [1.0, 0.0, 0.0, 0.0])], "query_id long, embedding array<float>"),
                        cents, 1)
    out = knn.knn_topk(q, spark.read.parquet(out_dir + "/ivf"), 3, qid="query_id", did="vec_id",
                       probes="cells", cell="cell")
    scan = [line for line in plan(out).split("\n") if "FileScan parquet" in line][0]
    pruned = scan.split("PartitionFilters: [", 1)[1].split("]", 1)[0]
    assert "cell#" in pruned
    assert out.count() == 3


def test_dense_index_never_moves_rows_to_one_partition(spark):
    df = spark.range(0, 5000).select((F.col("id") * 37 % 5003).alias("k")).repartition(5)
    lines = plan(dense_index(df, ["k"], "i")).split("\n")
    single = [i for i, line in enumerate(lines) if "Exchange SinglePartition" in line]
    # exactly one single-partition exchange, and it carries per-partition counts only
    assert len(single) == 1 and "HashAggregate(keys=[_pid" in lines[single[0] + 1]


def test_inverted_index_is_built_without_python(spark):
    from veriscope.plans.views import invert_text
    docs = spark.createDataFrame([(1, "a b a c  b\n a"), (2, None), (3, ""), (4, " é z é ")], "doc_id long, text string")
    inv = invert_text(docs)
    assert "EvalPython" not in inv._jdf.queryExecution().executedPlan().toString()
    assert {r.doc_id: r.abstract_inverted_index for r in inv.collect()} == {
        1: {"a": [0, 2, 5], "b": [1, 4], "c": [3]}, 2: None, 3: {"": [0]}, 4: {"é": [0, 2], "z": [1]}}
