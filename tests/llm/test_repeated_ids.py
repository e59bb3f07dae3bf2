from veriscope.llm import embeddings, jaccard


def test_an_id_with_two_texts_names_two_classes(spark):
    a, b = ([f"{x}{i}" for i in range(60)] for x in "ab")
    rows = [(4, " ".join(a)), (4, " ".join(b)), (2, " ".join(a[:-1])), (3, " ".join(b[:-1])), (4, " ".join(a))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(tuple(r) for r in jaccard.join_documents(docs).select("doc_id", "class_id", "copy_id", "n_shingles", "n_links").collect())
    assert got == [(2, 2, 2, 55, 2), (3, 3, 3, 55, 1), (4, 2, 4, 56, 2), (4, 2, 4, 56, 2), (4, 3, 4, 56, 1)]


def test_an_id_with_two_vectors_names_two_classes(spark):
    rows = [(4, [1.0, 0.0, 0.0]), (4, [0.0, 1.0, 0.0]), (2, [1.0, 0.01, 0.0]), (3, [0.0, 1.0, 0.01])]
    table = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, label int")
    got = sorted(tuple(r) for r in embeddings.link_embeddings(table).select("id", "n_links", "component_id", "kept").collect())
    assert got == [(2, 1, 2, True), (3, 1, 3, True), (4, 1, 2, False), (4, 1, 3, False)]
