"""Rows without an id, and ids that repeat: nothing is lost, linked or repeated wrongly."""
import collections

import corpus_pipeline as C
import pytest
from tests.llm.test_llm_operators import brute_links, word_list

from veriscope.llm import embeddings, jaccard, mixing

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def text(x, n=60, skip=()):
    return " ".join(f"{x}{i}" for i in range(n) if i not in skip)


@pytest.fixture(scope="module")
def rows():
    a, b, c = text("a"), text("b"), text("c")
    out = [(4, a), (None, text("a", skip=(59,))), (None, text("a", skip=(0,))), (None, b), (None, text("b", skip=(59,))), (7, c), (7, c),
           (7, text("d")), (None, None), (None, ""), (None, c), (9, "alone and short"), (None, "x y"), (None, "x y")]
    return [(i, t, "en", f"s{k % 2}", 1) for k, (i, t) in enumerate(out)]


def test_links_of_rows_without_ids(spark, rows):
    sets = [{tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set() for w in (word_list(r[1]) for r in rows)]
    links, root = brute_links(sets, 0.8)
    groups = collections.defaultdict(list)
    for k, r in enumerate(root):
        groups[r].append(rows[k][0])
    name = {r: min([i for i in ids if i is not None], default=None) for r, ids in groups.items()}
    want = sorted(((rows[k][0], name[root[k]], links[k]) for k in range(len(rows))), key=repr)
    got = jaccard.join_documents(spark.createDataFrame(rows, DOCS)).select("doc_id", "class_id", "n_links").collect()
    assert sorted((tuple(r) for r in got), key=repr) == want


def test_vectors_without_ids(spark):
    v = [(1, [1.0, 0.0, 0.0]), (None, [1.0, 0.01, 0.0]), (None, [0.0, 1.0, 0.0]), (None, [0.0, 1.0, 0.01]), (None, [0.0, 0.0, 1.0]),
         (None, None), (2, None), (None, [0.0, 1.0, 0.0])]
    table = spark.createDataFrame([(*r, 1, "x") for r in v], "vec_id long, embedding array<double>, label int, rep string")
    got = sorted((tuple(r) for r in embeddings.link_embeddings(table).select("id", "n_links", "component_id", "kept").collect()), key=repr)
    assert got == sorted([(1, 1, 1, True), (None, 1, 1, False), (None, 2, None, True), (None, 2, None, True), (None, 2, None, True),
                          (None, 0, None, True), (None, 0, None, True), (2, 0, 2, True)], key=repr)


def test_vectors_against_brute_force(spark):
    import numpy as np
    rng = np.random.default_rng(3)
    heads = rng.normal(size=(30, 16))
    x = np.concatenate([heads + s * rng.normal(size=heads.shape) for s in (0, 0.05, 0.1, 0.2, 0.4)])
    label = [None if k % 17 == 0 else k % 30 % 3 for k in range(len(x))]
    ids = [None if k % 11 == 0 else k for k in range(len(x))]
    table = spark.createDataFrame([(i, [float(a) for a in v], g) for i, v, g in zip(ids, x, label)], "vec_id long, embedding array<double>, label int")
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = (unit @ unit.T >= 0.98) & np.array([[a is not None and a == b for b in label] for a in label])
    np.fill_diagonal(near, False)
    assert near.sum() > 60
    root = list(range(len(x)))
    for _ in range(len(x)):
        root = [min([root[k], *(root[j] for j in np.flatnonzero(near[k]))]) for k in range(len(x))]
    name = {r: min([ids[k] for k in range(len(x)) if root[k] == r and ids[k] is not None], default=None) for r in set(root)}
    want = sorted(((ids[k], int(near[k].sum()), name[root[k]]) for k in range(len(x))), key=repr)
    got = embeddings.link_embeddings(table).select("id", "n_links", "component_id").collect()
    assert sorted((tuple(r) for r in got), key=repr) == want


def test_pipeline_stages_on_repeated_and_missing_ids(spark, rows, tmp_path):
    docs = spark.createDataFrame(rows, DOCS)
    kept = sorted((r["doc_id"], r["text"]) for r in C.near_duplicates(spark, docs, "").where("doc_id is not null").collect())
    assert kept == sorted([(4, text("a")), (7, text("c")), (7, text("d")), (9, "alone and short")])
    nameless = [r["text"] for r in C.near_duplicates(spark, docs, "").where("doc_id is null").collect()]
    assert sorted(nameless, key=repr) == sorted([min(text("b"), text("b", skip=(59,)), key=lambda t: t in nameless and -1 or 0), None, "", "x y"], key=repr)

    spark.createDataFrame([(1, text("b", 20))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    clean = C.decontamination(spark, docs, str(tmp_path)).collect()
    assert len(clean) == len(rows) - 2 and not any((r["text"] or "").startswith("b0 b1") for r in clean)
    twins = spark.createDataFrame([(5, text("b"), "en", "s", 1), (5, text("c"), "en", "s", 1)], DOCS)
    assert [r["text"] for r in C.decontamination(spark, twins, str(tmp_path)).collect()] == [text("c")]

    out = collections.Counter(tuple(r) for r in C.mix_sources(spark, docs, "").collect())
    want = collections.Counter()
    for r in mixing.mix(docs).collect():
        want[r["doc_id"], r["k1"], r["k2"], r["source"]] += r["repeats"]
    assert sum(out.values()) == sum(want.values())
    assert collections.Counter(r[0] for r in out.elements()) == collections.Counter(k[0] for k, n in want.items() for _ in range(n))
