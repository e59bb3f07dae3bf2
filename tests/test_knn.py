import numpy as np
from hypothesis import given, settings, strategies as st

from veriscope.operators import knn


def brute(q, d, qids, dids, k, metric):
    out = {}
    for i, qv in enumerate(q):
        rows = []
        for j, dv in enumerate(d):
            s = float(qv @ dv)
            if metric == "cosine":
                den = float(np.sqrt((qv @ qv) * (dv @ dv)))
                s = s / den if den > 0 else 0.0
            rows.append((float(knn.round6(np.array([s]))[0]), int(dids[j])))
        rows.sort(key=lambda x: (-x[0], x[1]))
        out[int(qids[i])] = rows[:k]
    return out


@settings(max_examples=40, deadline=None)
@given(st.integers(1, 6), st.integers(1, 40), st.integers(1, 8), st.integers(0, 10_000))
def test_merge_topk_matches_sort_with_ties(nq, nd, k, seed):
    rng = np.random.default_rng(seed)
    s = rng.integers(0, 4, size=(nq, nd)).astype(float)       # many ties
    d = np.broadcast_to(rng.permutation(nd).astype(np.int64), (nq, nd))
    bs = np.full((nq, k), -np.inf)
    bd = np.full((nq, k), np.iinfo(np.int64).max, dtype=np.int64)
    half = nd // 2
    bs, bd = knn.merge_topk(bs, bd, s[:, :half], d[:, :half], k)
    bs, bd = knn.merge_topk(bs, bd, s[:, half:], d[:, half:], k)
    for r in range(nq):
        want = sorted(zip(-s[r], d[r]))[:k]
        got = [(-a, b) for a, b in zip(bs[r], bd[r]) if np.isfinite(a)]
        assert got == [(a, b) for a, b in want]


def _frames(spark, n_docs=300, n_q=12, dim=8, seed=3):
    rng = np.random.default_rng(seed)
    d = rng.integers(0, 3, size=(n_docs, dim)).astype(float)   # integer vectors: exact ties
    d[5] = 0.0                                                  # a zero vector
    q = rng.integers(0, 3, size=(n_q, dim)).astype(float)
    store = spark.createDataFrame([(int(i), [float(x) for x in v]) for i, v in enumerate(d)],
                                  "doc_id long, embedding array<float>").repartition(5)
    queries = spark.createDataFrame([(int(100 + i), [float(x) for x in v]) for i, v in enumerate(q)],
                                    "claim_id long, embedding array<float>")
    return store, queries, d, q


def _as_dict(df):
    out = {}
    for r in df.orderBy("claim_id", "rank").collect():
        out.setdefault(r.claim_id, []).append((r.score, r.doc_id))
    return out


def test_exact_paths_equal_brute_force(spark):
    store, queries, d, q = _frames(spark)
    for metric in ("cosine", "dot_product"):
        want = brute(q, d, np.arange(100, 100 + len(q)), np.arange(len(d)), 7, metric)
        for method in ("broadcast", "blocked"):
            got = _as_dict(knn.knn_topk(queries, store, 7, metric, method=method, max_store_rows=37))
            assert got == want, (metric, method)
        # several query blocks per cell (budget fits 2 queries per group)
        tiny = _as_dict(knn.knn_topk(queries, store, 7, metric, method="blocked", max_store_rows=37,
                                     broadcast_budget_bytes=300))
        assert tiny == want, (metric, "blocked-tiny")
        # budget too small for a broadcast: "auto" must choose the blocked plan and agree
        assert _as_dict(knn.knn_topk(queries, store, 7, metric, broadcast_budget_bytes=300)) == want


def test_ranks_dense_from_one_and_topk_prefix(spark):
    store, queries, _, _ = _frames(spark)
    a = _as_dict(knn.knn_topk(queries, store, 4))
    b = _as_dict(knn.knn_topk(queries, store, 5))
    assert all(b[c][:4] == a[c] for c in a)
    ranks = knn.knn_topk(queries, store, 4).groupBy("claim_id").agg({"rank": "max"}).collect()
    assert {r[1] for r in ranks} == {4}


def test_ivf_full_probe_equals_exact_and_recall_grows(spark, out_dir):
    store, queries, _, _ = _frames(spark, n_docs=400, dim=8)
    cents = knn.train_ivf(store, 6, seed=1)
    cells = knn.assign_cells(store, cents)
    cells.write.partitionBy("cell").parquet(out_dir + "/ivf")
    ivf = spark.read.parquet(out_dir + "/ivf")
    exact = _as_dict(knn.knn_topk(queries, store, 5))
    full = _as_dict(knn.knn_topk(knn.probe_cells(queries, cents, 6), ivf, 5, probes="cells", cell="cell"))
    assert full == exact
    full_blocked = _as_dict(knn.knn_topk(knn.probe_cells(queries, cents, 6), ivf, 5, probes="cells",
                                         cell="cell", method="blocked", max_store_rows=50,
                                         broadcast_budget_bytes=500))
    assert full_blocked == exact
    recalls = []
    for n in (1, 2, 4, 6):
        got = _as_dict(knn.knn_topk(knn.probe_cells(queries, cents, n), ivf, 5, probes="cells", cell="cell"))
        hit = sum(len({x[1] for x in got.get(c, [])} & {x[1] for x in exact[c]}) for c in exact)
        recalls.append(hit)
    assert recalls == sorted(recalls) and recalls[-1] == 5 * len(exact)


def test_topk_single_matches_batch(spark):
    store, queries, _, q = _frames(spark)
    one = knn.topk_single(store, list(q[0]), 6).orderBy("rank").collect()
    batch = _as_dict(knn.knn_topk(queries, store, 6))[100]
    assert [(r.score, r.doc_id) for r in one] == batch
    assert [r.rank for r in one] == list(range(1, 7))


def test_rows_without_vectors_are_skipped(spark):
    store, queries, d, q = _frames(spark)
    holes = store.unionByName(spark.createDataFrame([(9999, None)], "doc_id long, embedding array<float>"))
    assert _as_dict(knn.knn_topk(queries, holes, 5)) == _as_dict(knn.knn_topk(queries, store, 5))
    assert 9999 not in [r.doc_id for r in knn.topk_single(holes, list(q[0]), 400).collect()]


def test_autoindex_picks_nlist_and_full_probe_is_exact(spark, out_dir):
    store, queries, _, _ = _frames(spark, n_docs=100, dim=8)
    cents = knn.build_ivf_index(store, out_dir + "/auto", "AUTOINDEX")
    assert len(cents) == knn.auto_nlist(100) == 40
    ivf = spark.read.parquet(out_dir + "/auto")
    got = _as_dict(knn.knn_topk(knn.probe_cells(queries, cents, len(cents)), ivf, 5, probes="cells", cell="cell"))
    assert got == _as_dict(knn.knn_topk(queries, store, 5))


def test_bounds_in_single_precision_lose_no_row():
    rng = np.random.default_rng(11)
    near = rng.normal(size=(1, 16)) + 1e-7 * rng.normal(size=(300, 16))                 # closer than single precision tells
    d = np.concatenate([rng.normal(size=(3000, 16)), near, 1e6 * rng.normal(size=(50, 16)), np.zeros((5, 16)),
                        rng.integers(0, 2, size=(500, 16))])
    d[40, 3] = np.nan
    q = np.concatenate([d[3000:3020], rng.normal(size=(30, 16)), np.zeros((2, 16)), rng.integers(0, 2, size=(10, 16))])
    ids = rng.permutation(len(d)).astype(np.int64)
    for metric in ("cosine", "dot_product"):
        for decimals in (6, None):
            top = knn._TopK(q, np.arange(len(q)), 7, metric, decimals=decimals, product_rows=100)
            for lo in range(0, len(d), 1300):
                top.add(d[lo:lo + 1300], ids[lo:lo + 1300])
            raw = np.einsum("ij,kj->ik", q, d)
            if metric == "cosine":
                den = np.sqrt((q * q).sum(1)[:, None] * (d * d).sum(1)[None, :])
                raw = np.where(den > 0, raw / np.where(den > 0, den, 1.0), 0.0)
            want = raw if decimals is None else knn.round6(raw, decimals)
            want = np.where(np.isnan(want), -np.inf, want)
            order = np.lexsort((np.broadcast_to(ids, want.shape), -want), axis=1)[:, :7]
            assert np.allclose(top.s, np.take_along_axis(want, order, 1), rtol=1e-12, atol=1e-12), (metric, decimals)
            if decimals is not None:
                assert (top.d == ids[order]).mean() > 0.99          # a sum's last digit may turn a rounding


def test_few_groups_of_a_store_are_searched_by_all_tasks(spark):
    """A store that fits one group: its queries are split over tasks (before, one task searched all of them)."""
    rng = np.random.default_rng(12)
    d, q = rng.normal(size=(400, 4)), rng.normal(size=(5000, 4))
    store = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(d)], "doc_id long, embedding array<double>")
    queries = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(q)], "claim_id long, embedding array<double>")
    cand = knn._blocked_candidates(queries, store, 3, "cosine", "claim_id", "doc_id", "embedding", "embedding", None, None,
                                   1 << 20, 1 << 20, 1 << 12, 6)
    assert cand.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).filter(lambda n: n > 0).count() >= 4
    assert cand.count() == 3 * 5000


def test_copies_of_vectors_keep_the_smallest_ids(spark):
    store = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(50)] + [(60, [2.0, 1.0])], "doc_id long, embedding array<double>")
    queries = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(5)], "claim_id long, embedding array<double>")
    got = _as_dict(knn.knn_topk(queries, store, 4, method="blocked"))
    assert got == {i: [(1.0, j) for j in range(4)] for i in range(5)}


def test_training_norms_are_computed_once_a_row(spark):
    """The norm stays in a projection below the division (before, it was summed again for each component)."""
    d = spark.createDataFrame([([3.0, 4.0],), ([0.0, 0.0],)], "embedding array<double>").repartition(2)
    units = knn._units(d, "embedding")
    plan = units._jdf.queryExecution().optimizedPlan().toString()
    top = plan.splitlines()[0]
    assert "transform(" in top and "aggregate(" not in top and "aggregate(" in plan
    assert sorted(r.v for r in units.collect()) == [[0.0, 0.0], [0.6, 0.8]]


def test_each_task_searches_one_group(spark):
    """30 groups fill 30 tasks (before, hashed group numbers met: some tasks took several, others none)."""
    rng = np.random.default_rng(13)
    store = spark.createDataFrame([(i, v.tolist(), i % 3) for i, v in enumerate(rng.normal(size=(300, 4)))],
                                  "doc_id long, embedding array<double>, cell int")
    queries = spark.createDataFrame([(i, v.tolist(), [0, 1, 2]) for i, v in enumerate(rng.normal(size=(2560, 4)))],
                                    "claim_id long, embedding array<double>, cells array<int>")
    cand = knn._blocked_candidates(queries, store, 3, "cosine", "claim_id", "doc_id", "embedding", "embedding", "cells", "cell",
                                   256, 1 << 20, 1 << 12, 6)
    rows = cand.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()
    assert len(rows) == 30 and min(rows) > 0 and sum(rows) == 3 * 3 * 2560


def test_groups_past_the_most_tasks_are_all_searched(spark, monkeypatch):
    monkeypatch.setattr(knn, "MAX_TASKS", 4)
    store, queries, d, q = _frames(spark)
    want = brute(q, d, np.arange(100, 100 + len(q)), np.arange(len(d)), 7, "cosine")
    got = _as_dict(knn.knn_topk(queries, store, 7, method="blocked", group_budget_bytes=20 * 128))
    assert got == want


def test_few_finds_what_flatnonzero_finds():
    rng = np.random.default_rng(14)
    for shape in ((3, 5), (16, 64), (7, 9), (1, 3), (0, 4)):
        for share in (0.0, 0.02, 1.0):
            cells = rng.random(shape) < share
            assert knn._few(cells).tolist() == np.flatnonzero(cells).tolist()


def test_vectors_are_shuffled_once_whatever_the_blocks(spark, monkeypatch):
    """30 groups of a store meet 8 blocks of queries (before, each vector was shuffled for every block or group of the other side)."""
    rng = np.random.default_rng(15)
    d, q = rng.integers(0, 4, size=(600, 4)).astype(float), rng.integers(0, 4, size=(400, 4)).astype(float)
    store = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(d)], "doc_id long, embedding array<float>")
    queries = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(q)], "claim_id long, embedding array<double>")
    moved, deal = [], type(store).repartitionById
    monkeypatch.setattr(type(store), "repartitionById", lambda df, n, by: (moved.append(df.count()), deal(df, n, by))[1])
    cand = knn._blocked_candidates(queries, store, 3, "cosine", "claim_id", "doc_id", "embedding", "embedding", None, None, 50, 20, 7, 6)
    assert cand.count() <= 3 * 400 * knn.MOST_SLICES                 # before: 3 rows a query from each of 30 groups
    assert sum(moved) <= 2 * (600 + 400)
    want = brute(q, d, np.arange(400), np.arange(600), 3, "cosine")
    best = knn.final_topk(cand, 3).withColumnsRenamed({"qid": "claim_id", "did": "doc_id"})
    assert _as_dict(best) == want


def test_paired_search_keeps_null_ids_copies_and_empty_sides(spark):
    shape = "doc_id long, embedding array<double>"
    store = spark.createDataFrame([(None, [1.0, 0.0]), (None, [0.0, 1.0]), (4, [1.0, 0.0]), (4, [1.0, 0.0]), (9, [0.0, 0.0])], shape)
    queries = store.withColumnRenamed("doc_id", "claim_id").where("claim_id > 0")
    key = lambda df: sorted((r.claim_id, r["rank"], r.doc_id, r.score) for r in df.collect())
    for budget in (64 << 20, 1):
        got = key(knn.knn_topk(queries, store, 3, method="blocked", group_budget_bytes=budget))
        assert got == key(knn.knn_topk(queries, store, 3, method="broadcast")) and len(got) == 2 * 3
    for left, right in ((queries, store.limit(0)), (queries.limit(0), store)):
        assert knn.knn_topk(left, right, 3, method="blocked", dim=2).count() == 0
