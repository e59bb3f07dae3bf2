import numpy as np

from veriscope.llm import tokens


def test_slices_reach_from_start_to_end():
    for n in (1, 4096, 4097, 5000, 100_000):
        got = np.frombuffer(tokens.spread_slices(np.arange(n, dtype="<u4").tobytes()), "<u4")
        assert len(got) == min(n, 4096) and got[0] == 0 and got[-1] == n - 1
        assert (np.diff(got) >= 1).all() and np.diff(got, prepend=0).max() <= max(1, n // 15)


def test_the_sample_holds_the_end_of_a_long_document(spark, monkeypatch, tmp_path):
    """The dictionary's training data reach beyond the first 4,096 ids."""
    import zstandard
    from veriscope.llm.catalog import tokenizer_path
    docs = spark.createDataFrame([(1, "start " * 20_000 + "finish " * 20_000)], "doc_id long, text string")
    seen = []
    monkeypatch.setattr(zstandard, "train_dictionary", lambda size, rows: seen.extend(rows) or zstandard.ZstdCompressionDict(b"x" * 64))
    tokens.train_dictionary(docs, tokenizer_path(), 2, 10, 1024)
    ids = np.frombuffer(seen[0], "<u4")
    assert len(ids) == 4096 and ids[-1] == 2 and len(np.unique(ids)) >= 3


def test_sample_is_the_least_hashes_whatever_the_copies(spark, monkeypatch):
    import zstandard
    from pyspark.sql import functions as F

    from veriscope.llm import tokens
    from veriscope.llm.catalog import tokenizer_path

    rows = [(i, f"document number {i} of many") for i in range(3000)] + [(None, "one text of many rows")] * 2000
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    seen = []
    monkeypatch.setattr(zstandard, "train_dictionary", lambda size, samples: seen.extend(samples) or zstandard.ZstdCompressionDict(b"x" * 64))
    path = tokenizer_path()
    tokens.train_dictionary(docs, path, 2, 100, 4096)
    enc = tokens.WordEncoder(path)
    least = docs.distinct().orderBy(F.xxhash64("doc_id", "text")).limit(100).collect()
    assert seen == [enc.ids(r["text"]) + (2).to_bytes(4, "little") for r in least]
