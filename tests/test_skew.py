"""Hot keys: one key holds a third of all rows.  Results stay whole and exact."""

import numpy as np
from pyspark.sql import functions as F

from veriscope.operators import knn
from veriscope.operators.enrich import enrich_by_doi, normalize_works
from veriscope.sources.store import EvidenceStore, dedupe_documents

from test_knn import _as_dict, brute


def test_hot_cell_blocked_knn_is_exact(spark):
    rng = np.random.default_rng(11)
    n, dim = 300, 8
    d = rng.integers(0, 3, size=(n, dim)).astype(float)
    q = rng.integers(0, 3, size=(9, dim)).astype(float)
    # A third of the store in cell 0, the rest over cells 1-4.
    rows = [(i, [float(x) for x in v], 0 if i % 3 == 0 else 1 + i % 4) for i, v in enumerate(d)]
    store = spark.createDataFrame(rows, "doc_id long, embedding array<float>, cell int").repartition(4)
    queries = spark.createDataFrame([(100 + i, [float(x) for x in v], [0, 1, 2, 3, 4]) for i, v in enumerate(q)],
                                    "claim_id long, embedding array<float>, cells array<int>")
    want = brute(q, d, np.arange(100, 109), np.arange(n), 6, "cosine")
    # max_store_rows=20 splits the hot cell (100 rows) over 5 salts; the budget
    # fits 3 queries per block, so queries are cut into blocks as well.
    got = _as_dict(knn.knn_topk(queries, store, 6, probes="cells", cell="cell", method="blocked",
                                max_store_rows=20, broadcast_budget_bytes=3 * (dim * 8 + 64)))
    assert got == want
    assert _as_dict(knn.knn_topk(queries, store, 6, probes="cells", cell="cell")) == want


def test_hot_doi_enrichment_keeps_every_work_once(spark):
    n = 300
    works = spark.range(n).select(
        F.concat(F.lit("https://openalex.org/W"), F.col("id").cast("string")).alias("id"),
        F.concat(F.lit("https://doi.org/10.1/"), (F.col("id") % 50).cast("string")).alias("doi"),
        F.lit("T").alias("title"), F.lit(2001).alias("publication_year"),
        F.lit("orig").alias("abstract"), F.lit("A").alias("authors"))
    # A third of all papers carry DOI 10.1/0.
    papers = spark.range(3 * n).select(
        F.when(F.col("id") % 3 == 0, F.lit("10.1/0"))
        .otherwise(F.concat(F.lit("10.1/"), (F.col("id") % 50).cast("string"))).alias("doi"),
        F.concat(F.lit("P"), F.format_string("%04d", F.col("id"))).alias("paperId"),
        F.lit("enriched").alias("abstract"),
        F.col("id").cast("int").alias("citationCount"),
        F.lit(0).alias("influentialCitationCount"))
    out = enrich_by_doi(normalize_works(works), papers)
    assert out.count() == n and out.select("openalex_id").distinct().count() == n
    hot = {r.paperId for r in out.filter(F.col("doi") == "10.1/0").collect()}
    assert hot == {"P0000"}


def test_hot_content_dedupes_to_smallest_id(spark, out_dir):
    n = 600
    rows = spark.range(n).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 3 == 1, F.lit("the same text"))
        .otherwise(F.concat(F.lit("text "), F.col("id").cast("string"))).alias("content"),
        F.struct(F.lit("t").alias("title"), F.lit(2000).alias("publication_year"), F.lit("").alias("authors"),
                 F.lit("").alias("doi"), F.lit("").alias("open_alex_id")).alias("meta")).repartition(6)
    keyed = rows.withColumn("doc_key", F.sha2("content", 256))
    uniq = dedupe_documents(keyed)
    assert uniq.count() == n - n // 3 + 1
    assert uniq.filter(F.col("content") == "the same text").select("doc_id").first()[0] == 1
    store = EvidenceStore(spark, out_dir + "/hot", recreate=True)
    store.write_documents(rows)
    store.write_documents(rows)
    assert store.read().count() == n - n // 3 + 1
