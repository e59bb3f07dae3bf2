"""Bucketed keys, batch tables, checked pages: repeated and killed runs, full filters, damaged files."""
import json
import os
import re

import pytest
from pyspark.sql import functions as F

from veriscope.plans import jobs
from veriscope.schemas import WORK
from veriscope.session import scratch_path
from veriscope.sources import keys
from veriscope.sources.manifest import BatchTable
from veriscope.sources.store import EvidenceStore
from veriscope.sources.works import flatten_works, read_checked_pages, rejected_pages, write_works_csv

META = "struct<title:string,publication_year:int,authors:string,doi:string,open_alex_id:string>"


def docs(spark, texts):
    rows = [(i, t, ("t", 2000, "", "", "")) for i, t in texts]
    return spark.createDataFrame(rows, f"doc_id long, content string, meta {META}")


def contents(store):
    return sorted(r[0] for r in store.read().select("content").collect())


def test_bucketed_store_equals_plain_store(spark):
    plain = EvidenceStore(spark, scratch_path(spark, "s"), recreate=True)
    bucketed = EvidenceStore(spark, scratch_path(spark, "s"), recreate=True, buckets=8)
    assert bucketed.read().count() == 0 and bucketed.read().columns == plain.read().columns
    for batch in ([(i, f"text {i}") for i in range(30)], [(i + 100, f"text {i % 40}") for i in range(60)],
                  [(1, "text 1")] * 20, [(5, "")], []):
        for s in (plain, bucketed):
            s.write_documents(docs(spark, batch))
    assert contents(bucketed) == contents(plain) and len(contents(plain)) == 41
    again = EvidenceStore(spark, bucketed.path, buckets=8)                     # opened by another run
    again.write_documents(docs(spark, [(7, "text 7"), (900, "new")]))
    assert again.read().count() == 42 and again.embedding_count() == 42


def test_only_buckets_that_may_hold_a_key_are_read(spark):
    store = EvidenceStore(spark, scratch_path(spark, "s"), recreate=True, buckets=64)
    store.write_documents(docs(spark, [(i, f"text {i}") for i in range(400)]))
    one = store.prepare(docs(spark, [(1, "text 11"), (2, "never seen")]))
    maybe = store.filters.maybe(one)
    assert maybe.count() == 1
    plan = keys.stored_keys(store._open(), maybe)._jdf.queryExecution().executedPlan().toString()
    scan = next(x for x in plan.splitlines() if "FileScan" in x and re.search(r"PartitionFilters: \[[^\]]*bucket#", x))
    assert "struct<doc_key:string>" in scan
    assert store.present(one).count() == 1
    fresh = store.filters.maybe(store.prepare(docs(spark, [(i, f"other {i}") for i in range(500)])))
    assert fresh.count() < 25                                                  # false positives of filters with room


def test_full_filters_lose_nothing(spark, monkeypatch):
    monkeypatch.setattr(keys, "COMPACT", 1)
    store = EvidenceStore(spark, scratch_path(spark, "s"), recreate=True, buckets=4)
    store.filters.bits = 8
    for lo in (0, 50, 100):
        store.write_documents(docs(spark, [(i, f"text {i}") for i in range(lo, lo + 80)]))
    assert store.read().count() == 180
    assert store.filters._rows().count() <= 2 * 4                              # joined as batches come
    with pytest.raises(ValueError):
        keys.BucketFilters(spark, "x", 4, bits=100)


def test_filters_without_rows_are_harmless(spark):
    store = EvidenceStore(spark, scratch_path(spark, "s"), recreate=True, buckets=4)
    batch = docs(spark, [(1, "a"), (2, "b")])
    store.filters.add(store.prepare(batch))                                    # killed before the rows were written
    store.write_documents(batch)
    assert contents(store) == ["a", "b"]


def test_batch_table(spark):
    table = BatchTable(spark, scratch_path(spark, "t"), "a int")
    rows = spark.range(5).select(F.col("id").cast("int").alias("a"))
    assert table.read().count() == 0 and table.committed() == set()
    table.stage(rows, "x")                                                     # killed: no reader sees it
    assert table.read().count() == 0
    assert table.append("x", lambda: rows) and not table.append("x", lambda: pytest.fail("made again"))
    table.commit("x", *table.stage(rows, "x"))                                 # two runs named the same batch
    assert table.append("none", lambda: rows.limit(0))
    assert table.read().count() == 5 and table.committed() == {"x", "none"}


def test_enrich_resumes(spark, out_dir):
    works = [(f"https://openalex.org/W{i}", f"https://doi.org/10.5/{i}", f"t{i}", 2000, f"abs\n\"{i}\"", "") for i in range(40)]
    write_works_csv(spark.createDataFrame(works, WORK), f"{out_dir}/csv")
    papers = spark.createDataFrame([("10.5/3", "p3", "better", 1, 2)], "doi string, paperId string, abstract string, "
                                   "citationCount int, influentialCitationCount int")
    landed = BatchTable(spark, f"{out_dir}/landed", "id string, doi string, title string, publication_year int, abstract string, "
                        "authors string, part int")
    out = BatchTable(spark, f"{out_dir}/out", jobs.ENRICHED)
    assert jobs.enrich_resumable(spark, f"{out_dir}/csv", papers, landed, out, parts=5, limit=2) == 2
    first = {r["openalex_id"] for r in out.read().collect()}
    assert jobs.enrich_resumable(spark, f"{out_dir}/csv", papers, landed, out, parts=5) == 3
    assert jobs.enrich_resumable(spark, f"{out_dir}/csv", papers, landed, out, parts=5) == 0
    rows = {r["openalex_id"]: r for r in out.read().collect()}
    assert out.read().count() == 40 == len(rows) and first < set(rows) and rows["W3"]["abstract"] == "better"
    more = [*works[:10], ("https://openalex.org/W99", "https://doi.org/10.5/99", "t", 2001, "x", "")]
    write_works_csv(spark.createDataFrame(more, WORK), f"{out_dir}/csv2")      # a later file repeats works
    jobs.enrich_resumable(spark, f"{out_dir}/csv2", papers, BatchTable(spark, f"{out_dir}/landed2", landed.schema), out, parts=2, name="later")
    assert out.read().count() == 41


def test_rejected_pages(spark, out_dir):
    work = {"id": "W1", "doi": None, "title": "t", "publication_year": 2000, "abstract_inverted_index": {"a": [0, 2], "b": [1]},
            "authorships": [{"author": {"display_name": "Z"}}]}
    os.makedirs(f"{out_dir}/pages")
    text = json.dumps([work, {**work, "id": "W2"}])
    for name, body in (("results_0.json", text), ("results_1.json", text[:-30]), ("results_2.json", "[]"), ("results_3.json", "{oops"),
                       ("next_cursor.txt", "abc")):
        with open(f"{out_dir}/pages/{name}", "w") as f:
            f.write(body)
    good = read_checked_pages(spark, f"{out_dir}/pages")
    assert {(r["id"], r["file_name"]) for r in good.collect()} == {("W1", "results_0.json"), ("W2", "results_0.json")}
    assert [r["abstract"] for r in flatten_works(good).collect()] == ["a b"] * 2
    bad = {r["file_name"]: (r["n_bad"], r["n_chars"]) for r in rejected_pages(spark, f"{out_dir}/pages").collect()}
    assert bad == {"results_1.json": (1, len(text) - 30), "results_3.json": (1, 5)}
    with open(f"{out_dir}/lines.json", "w") as f:
        f.write(json.dumps(work) + "\n{broken\n" + json.dumps(work) + "\n")
    assert rejected_pages(spark, f"{out_dir}/lines.json", multiline=False).collect()[0]["n_bad"] == 1
    assert read_checked_pages(spark, f"{out_dir}/lines.json", multiline=False).count() == 2


def test_landed_parts_are_not_one_task_each(spark, out_dir):
    """A part that is a large share of the input is written by as many tasks as its bytes ask for."""
    from pyspark.sql import functions as F
    from veriscope.schemas import WORK
    from veriscope.sources.manifest import BatchTable
    from veriscope.sources.works import land_works_csv
    csv = spark.range(4000).select(F.concat(F.lit("W"), "id").alias("id"), F.lit("d").alias("doi"), F.lit("t").alias("title"),
                                   F.lit(2000).alias("publication_year"), F.sha2(F.col("id").cast("string"), 512).alias("abstract"),
                                   F.lit("").alias("authors"))
    table = BatchTable(spark, out_dir + "/landed", f"{WORK.simpleString()[7:-1].replace(':', ' ')}, part int")
    size = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "32k")
    try:
        landed = land_works_csv(csv, table, 2)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", size)
    assert len(landed.inputFiles()) > 2
    assert landed.select("id").distinct().count() == landed.count() == 4000
    assert landed.groupBy("part").count().count() == 2
