from pyspark.sql import Window
from pyspark.sql import functions as F

from veriscope.functions.scoring import claim_score, pair_score, topic_score
from veriscope.operators.claims import (
    attach_claims, claim_documents, claims_per_doc, extract_claims, split_sentences,
)
from veriscope.operators.enrich import enrich_by_doi, normalize_works
from veriscope.operators.export import claim_records, corpus_from_abstracts, corpus_from_titles
from veriscope.operators.numbering import dense_index
from veriscope.operators.verify import verdicts


def test_dense_index_matches_row_number(spark):
    df = spark.range(0, 2000).select((F.col("id") * 7919 % 2003).alias("k"), (F.col("id") % 3).alias("g")) \
        .repartition(7)
    got = dense_index(df, ["g", "k"], "i").select("g", "k", "i")
    want = df.select("g", "k", (F.row_number().over(Window.orderBy("g", "k")) - 1).alias("i"))
    assert got.exceptAll(want).count() == 0 and got.count() == 2000


def test_enrich_left_join_unknown_duplicate_and_empty(spark):
    works = spark.createDataFrame([
        ("https://openalex.org/W1", "https://doi.org/10.1/a", "T1", 2001, "orig1", "X"),
        ("https://openalex.org/W2", "https://doi.org/10.1/b", "T2", 2002, "orig2", "Y"),
        ("https://openalex.org/W3", None, "T3", 2003, "orig3", "Z"),
        ("https://openalex.org/W4", "https://doi.org/10.1/c", None, None, None, None),
    ], "id string, doi string, title string, publication_year int, abstract string, authors string")
    papers = spark.createDataFrame([
        ("10.1/a", "P2", "", 5, 1), ("10.1/a", "P1", "better", 7, 2), ("10.1/c", "P3", None, 1, 0),
    ], "doi string, paperId string, abstract string, citationCount int, influentialCitationCount int")
    out = {r.openalex_id: r for r in enrich_by_doi(normalize_works(works), papers).collect()}
    assert set(out) == {"W1", "W2", "W4"}
    assert (out["W1"].paperId, out["W1"].abstract, out["W1"].citationCount) == ("P1", "better", 7)
    assert (out["W2"].paperId, out["W2"].abstract, out["W2"].citationCount) == ("", "orig2", None)
    assert (out["W4"].abstract, out["W4"].title) == ("", "")
    assert list(enrich_by_doi(normalize_works(works), papers).columns) == [
        "openalex_id", "doi", "title", "year", "paperId", "citationCount", "influentialCitationCount", "abstract"]


def test_scorers(spark):
    df = spark.createDataFrame([("The cat is in the house of the king.",), ("Zebra quagga!",), ("",)], "t string")
    r = df.select(topic_score(F.col("t")).alias("a"), claim_score(F.col("t")).alias("b")).collect()
    assert r[0].a.label == "Yes" and abs(r[0].a.score - 6 / 9) < 1e-6
    assert r[1].a.label == "No" and r[1].a.score == 1.0 and r[1].b.label == 0
    assert r[2].b.score == 0.0
    p = spark.createDataFrame([("sea is not rising", "the sea is rising fast"), ("sea rising", "sea rising"),
                               ("alpha beta", "gamma")], "c string, e string")
    v = p.select(pair_score(F.col("c"), F.col("e")).alias("v")).collect()
    assert v[0].v.label == "REFUTES" and abs(v[0].v.prob - 0.75) < 1e-9
    assert v[1].v.label == "SUPPORTS" and v[1].v.prob == 1.0
    assert v[2].v.label == "NOT_ENOUGH_INFO" and v[2].v.prob == 1.0


def test_claims_chain(spark):
    works = spark.createDataFrame([
        ("W1", "the sea is rising. zebra quagga. the ice of the pole melts.", "T", 2001, "A", "d1"),
        ("W2", "nothing here", "U", 2002, "B", "d2"), ("W3", "", "V", 2003, "C", "d3"),
    ], "id string, abstract string, title string, publication_year int, authors string, doi string")
    assert split_sentences(works, "abstract", ["id"]).filter("id = 'W3'").count() == 0
    cl = extract_claims(works, "abstract", ["id"], 0.25)
    assert [(r.id, r.pos) for r in cl.orderBy("id", "pos").collect()] == [("W1", 0), ("W1", 2)]
    grouped = claims_per_doc(cl, "id")
    assert grouped.first().claims == ["the sea is rising.", "the ice of the pole melts."]
    docs = claim_documents(attach_claims(works, grouped, "id")).collect()
    assert [(d.content, d.meta.open_alex_id, d.claim_pos) for d in docs] == [
        ("the sea is rising.", "W1", 0), ("the ice of the pole melts.", "W1", 1)]


def test_export_records(spark):
    m = spark.createDataFrame([(0, 1, "A", "x one. x two."), (0, 2, "B", "y."), (0, 3, "A", "z."),
                               (2, 1, "C", "w.")], "claim_id long, rank int, title string, content string")
    claims = spark.createDataFrame([(0, "c0"), (1, "c1"), (2, "c2")], "claim_id long, claim string")
    corp = corpus_from_abstracts(m).orderBy("doc_id").collect()
    assert [(r.doc_id, r.claim_id, r.rank) for r in corp] == [(0, 0, 1), (1, 0, 2), (2, 0, 3), (3, 2, 1)]
    assert corp[0].abstract == ["x one.", "x two."]
    recs = {r.id: r.doc_ids for r in claim_records(claims, corpus_from_abstracts(m)).collect()}
    assert recs == {0: [0, 1, 2], 1: [], 2: [3]}
    titles = corpus_from_titles(m).orderBy("doc_id").collect()
    assert [(r.doc_id, r.title, r.abstract) for r in titles] == [
        (0, "A", ["x one. x two.", "z."]), (1, "B", ["y."]), (2, "C", ["w."])]


def test_verdicts_filter(spark):
    pairs = spark.createDataFrame([(0, "sea rising", "sea rising"), (1, "sea rising", "nothing"),
                                   (2, "sea not rising", "sea rising")], "id int, claim string, content string")
    assert sorted(r.id for r in verdicts(pairs).collect()) == [0, 2]
    assert sorted(r.id for r in verdicts(pairs, print_neutral=True).collect()) == [0, 1, 2]


def test_similarity_has_no_thousands_separator(spark):
    from pyspark.sql import functions as F

    from veriscope.functions.vectors import format_prob, format_similarity
    row = spark.createDataFrame([(1234.5678, 0.125)], "s double, p double").select(
        format_similarity(F.col("s")), format_prob(F.col("p"))).first()
    assert tuple(row) == ("1234.568", "0.12")


def test_two_column_batch_scorer_and_embedder_run_once_per_row(spark):
    import pandas as pd
    from pyspark.sql import functions as F

    from veriscope.operators.models import batch_scorer
    from veriscope.operators.verify import verdicts
    from veriscope.sources.store import embed_missing
    pairs, embedded = spark.sparkContext.accumulator(0), spark.sparkContext.accumulator(0)

    def score(model, claims, evidence):
        pairs.add(len(claims))
        return pd.DataFrame({"label": ["SUPPORTS"] * len(claims), "prob": [0.9] * len(claims)})

    df = spark.createDataFrame([(i, f"c{i}", f"e{i}") for i in range(50)], "id long, claim string, content string")
    out = verdicts(df, scorer=batch_scorer(dict, score, "label string, prob double", "pairs", batch_size=8))
    assert len(out.collect()) == 50 and pairs.value == 50

    @F.pandas_udf("array<float>")
    def vector(texts: pd.Series) -> pd.Series:
        embedded.add(len(texts))
        return texts.map(lambda t: [1.0])

    rows = spark.createDataFrame([(i, "t", None if i < 10 else [0.5]) for i in range(100)], "id long, t string, embedding array<float>")
    assert len(embed_missing(rows, vector, F.col("t")).where("embedding[0] = 1.0").select("id").collect()) == 10
    assert embedded.value <= 20


def test_resolve_input_takes_one_page_per_url(spark):
    from veriscope.operators.filters import resolve_input
    inputs = spark.createDataFrame([(1, "http://a"), (2, "plain"), (3, "http://b")], "id long, text string")
    pages = spark.createDataFrame([("http://a", "<body>x</body>"), ("http://a", "<body>y</body>")], "url string, html string")
    assert sorted(r["id"] for r in resolve_input(inputs, pages).collect()) == [1, 2, 3]
