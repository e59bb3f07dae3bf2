import pandas as pd
from pyspark.sql import functions as F

from veriscope.functions.scoring import topic_score
from veriscope.operators.models import batch_scorer, default_batch_size, partition_map
from veriscope.sources.store import EvidenceStore
from veriscope.streaming.ingest import ingest_pages


def docs(spark, rows):
    return spark.createDataFrame(
        [(i, c, (t, 2000, "", "", "")) for i, c, t in rows],
        "doc_id long, content string, meta struct<title:string,publication_year:int,authors:string,doi:string,open_alex_id:string>")


def test_store_write_twice_equals_once_and_skips_duplicates(spark, out_dir):
    s = EvidenceStore(spark, out_dir + "/store", recreate=True)
    d = docs(spark, [(1, "sea level rises", "A"), (2, "sea level rises", "B"), (3, "ice melts", "C")])
    s.write_documents(d)
    s.write_documents(d)
    s.write_documents(docs(spark, [(4, "ice melts", "D"), (5, "new text", "E")]))
    rows = sorted((r.doc_id, r.content) for r in s.read().collect())
    assert rows == [(1, "sea level rises"), (3, "ice melts"), (5, "new text")]
    assert s.embedding_count() == 3
    top = s.top_k("sea level", 2).collect()
    assert top[0].doc_id == 1 and [r.rank for r in top] == [1, 2]
    q = spark.createDataFrame([(0, "melting ice"), (1, "rises")], "claim_id long, claim string")
    hits = s.top_k_batch(q, 1).collect()
    assert {(r.claim_id, r.doc_id) for r in hits} == {(0, 3), (1, 1)}
    EvidenceStore(spark, out_dir + "/store", recreate=True)
    assert EvidenceStore(spark, out_dir + "/store").read().count() == 0


def test_stream_ingest_reruns_add_nothing(spark, out_dir):
    src = spark.createDataFrame([(1, "a b c", "s1"), (2, "a b c", "s2"), (3, "d e", "s3")],
                                "doc_id long, text string, source string")
    src.repartition(2).write.json(out_dir + "/land/p1")
    src.filter("doc_id = 3").write.json(out_dir + "/land/p2")
    store = EvidenceStore(spark, out_dir + "/st", recreate=True)

    def to_docs(b):
        return b.select("doc_id", F.col("text").alias("content"),
                        F.struct(F.col("source").alias("title"), F.lit(None).cast("int").alias("publication_year"),
                                 F.lit("").alias("authors"), F.lit("").alias("doi"),
                                 F.lit("").alias("open_alex_id")).alias("meta"))
    for _ in range(2):
        ingest_pages(spark, out_dir + "/land/*", src.schema, store, to_docs, out_dir + "/ck", max_files_per_trigger=1)
    assert sorted(r.content for r in store.read().collect()) == ["a b c", "d e"]


def test_batch_scorer_equals_column_scorer(spark):
    def load():
        return {"cut": 0.1, "lex": {"the", "of", "and", "in", "is"}}

    def score(model, texts: pd.Series) -> pd.DataFrame:
        ws = texts.fillna("").str.lower().str.findall("[a-z]+")
        share = ws.map(lambda w: (sum(x in model["lex"] for x in w) / len(w)) if w else 0.0)
        yes = share >= model["cut"]
        return pd.DataFrame({"label": yes.map({True: "Yes", False: "No"}),
                             "score": share.where(yes, 1 - share).round(6)})

    sc = batch_scorer(load, score, "label string, score double", "lexicon", batch_size=3)
    df = spark.createDataFrame([(i, t) for i, t in enumerate(["the sea is", "zebra", "", "of of and x y z w v u t"] * 5)],
                               "id int, t string")
    a = df.select("id", sc("t").alias("s")).orderBy("id").collect()
    b = df.select("id", topic_score(F.col("t")).alias("s")).orderBy("id").collect()
    assert [(r.s.label, round(r.s.score, 6)) for r in a] == [(r.s.label, r.s.score) for r in b]
    assert default_batch_size(True) == 128 and default_batch_size(False) == 1


def test_partition_map(spark):
    df = spark.range(100).withColumn("t", F.lit("a b"))
    out = partition_map(df, lambda p: pd.DataFrame({"id": p["id"], "n": p["t"].str.len()}), "id long, n long", 4)
    assert out.count() == 100 and out.agg(F.sum("n")).first()[0] == 300


def test_insert_if_absent_agrees_whether_broadcast_or_shuffled(spark):
    from veriscope.sources.store import insert_if_absent
    new = spark.createDataFrame([(f"k{i % 50}", i) for i in range(200)], "doc_key string, doc_id long")
    old = spark.createDataFrame([(f"k{i}",) for i in range(0, 80, 3)], "doc_key string")
    a = sorted(insert_if_absent(new, old).collect())
    bound = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        b = sorted(insert_if_absent(new, old).collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", bound)
    assert a == b and len(a) == 200 - 4 * 17


def test_write_documents_runs_its_input_once(spark, out_dir):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(text):
        seen.add(1)
        return text

    store = EvidenceStore(spark, out_dir + "/once", recreate=True)
    store.write_documents(docs(spark, [(i, f"stored {i}", "A") for i in range(5)]))
    batch = docs(spark, [(100 + i, f"new {i}", "A") for i in range(40)]).withColumn("content", counted("content"))
    store.write_documents(batch)
    assert seen.value == 40 and store.read().count() == 45


def test_index_opened_again_gives_the_same_rows(spark, out_dir):
    from veriscope.operators import knn
    from veriscope.plans import jobs
    sea = "sea level ice melts river warm storm coast tide glacier wind".split()
    store = EvidenceStore(spark, out_dir + "/flat", recreate=True)
    store.write_documents(docs(spark, [(i, " ".join(sea[(i * 7 + j * j) % 11] for j in range(i % 5 + 3)) + f" {i}", "A")
                                        for i in range(60)]))
    claims = spark.createDataFrame([(i, f"the {sea[i]} {sea[i + 2]}") for i in range(9)], "claim_id long, claim string")
    made = knn.build_ivf_index(store.read(), out_dir + "/ivf", "IVF_FLAT", 4)
    opened, centres = knn.open_ivf_index(spark, out_dir + "/ivf")
    assert (made == centres).all()

    def rows(df):
        return sorted((r.claim_id, r.rank, r.doc_id, r.score) for r in df.collect())
    exact = rows(jobs.find_evidence(claims, store.read(), 5))
    assert rows(jobs.find_evidence(claims, opened, 5, centroids=centres, nprobe=4)) == exact
    few = jobs.find_evidence(claims, opened, 5, centroids=centres, nprobe=1)
    assert 0 < few.count() <= 45


def test_streamed_store_equals_batch_store(spark, out_dir):
    rows = [(i, f"text {i % 7} of the sea", f"s{i % 3}") for i in range(60)]
    src = spark.createDataFrame(rows, "doc_id long, text string, source string")
    src.repartition(6).write.json(out_dir + "/land6")

    def to_docs(b):
        return b.select("doc_id", F.col("text").alias("content"),
                        F.struct(F.col("source").alias("title"), F.lit(None).cast("int").alias("publication_year"),
                                 F.lit("").alias("authors"), F.lit("").alias("doi"),
                                 F.lit("").alias("open_alex_id")).alias("meta"))
    streamed = EvidenceStore(spark, out_dir + "/s1", recreate=True)
    ingest_pages(spark, out_dir + "/land6", src.schema, streamed, to_docs, out_dir + "/ck6", max_files_per_trigger=1)
    batch = EvidenceStore(spark, out_dir + "/s2", recreate=True)
    batch.write_documents(to_docs(src))
    cols = ["doc_key", "content"]
    assert sorted(streamed.read().select(*cols).collect()) == sorted(batch.read().select(*cols).collect())
    assert streamed.read().count() == 7


def test_stream_ingest_continuous_trigger(spark, out_dir):
    src = spark.createDataFrame([(1, "x y", "s"), (2, "x y", "s"), (3, "z", "s")], "doc_id long, text string, source string")
    src.write.json(out_dir + "/landc")
    store = EvidenceStore(spark, out_dir + "/stc", recreate=True)

    def to_docs(b):
        return b.select("doc_id", F.col("text").alias("content"),
                        F.struct(F.col("source").alias("title"), F.lit(None).cast("int").alias("publication_year"),
                                 F.lit("").alias("authors"), F.lit("").alias("doi"),
                                 F.lit("").alias("open_alex_id")).alias("meta"))
    q = ingest_pages(spark, out_dir + "/landc", src.schema, store, to_docs, out_dir + "/ckc",
                     processing_time="1 second")
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    assert sorted(r.content for r in store.read().collect()) == ["x y", "z"]
