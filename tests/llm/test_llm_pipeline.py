"""The pipeline's stages against brute force, each on what its predecessor kept."""
import zlib

import corpus_pipeline as C
import numpy as np
from tests.llm.test_llm_operators import brute_links, word_list

from veriscope.llm.catalog import tokenizer_path
from veriscope.llm.common import write_table

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    from tokenizers import Tokenizer
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = [docs]
    for name, stage in C.STAGES:
        kept.append(write_table(stage(spark, kept[-1], SF), name))
    assert all(d.columns == docs.columns for d in kept[:-1])
    rows = [sorted((r["doc_id"], r["text"]) for r in d.select("doc_id", "text").collect()) for d in kept[:-1]]
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    good = {i for i, _ in rows[1]}
    assert np.mean([(i in good) == bool(q) for i, q in labels.items()]) > 0.9

    sets = [{tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set() for w in (word_list(t) for _, t in rows[1])]
    _, root = brute_links(sets, 0.8)
    assert rows[2] == [r for k, r in enumerate(rows[1]) if root[k] == k]

    windows = set()
    for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect():
        w = word_list(r["text"])
        windows |= {tuple(w[s:s + 10]) for s in range(max(1, len(w) - 9))} if w else set()
    lengths = {len(w) for w in windows}

    def clean(text):
        w = word_list(text)
        return not any(tuple(w[s:s + n]) in windows for n in lengths for s in range(len(w) - n + 1))
    assert rows[3] == [r for r in rows[2] if clean(r[1])]

    assert set(rows[4]) <= set(rows[3])
    tokenizer, at, want = Tokenizer.from_file(tokenizer_path()), 0, []
    for i, text in rows[4]:
        ids = tokenizer.encode(text, add_special_tokens=False).ids + [2]
        want.append((at, len(ids), i, zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    got = sorted(tuple(r) for r in kept[5].select("start", "n_tokens", "doc_id", "ids_crc32").collect())
    assert got == want
