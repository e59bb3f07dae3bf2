"""k-NN similarity join (J4), top-k per query (T1), single-query top-k (T2), IVF.

Plan shape (exact and IVF):

* **broadcast path** (query block whose size is checked against a budget): the query
  vectors are broadcast once; ``mapInPandas`` runs over the store's own partitions
  (no store shuffle), does one matrix product per Arrow batch and keeps a running
  local top-k per query.  Each store partition emits at most ``k`` rows per query.
* **paired path** (queries above the budget, no cells): the store is dealt into a few
  slices and the queries into blocks, both packed into rows of many vectors and shuffled
  once.  A cartesian product of the packed rows gives each task one slice and one block: the
  slice streams by in pieces and the task keeps the block's running top-k.  No vector is
  written once for each block or slice, so disk grows with the rows of both sides, not with
  their product; neither do candidates, as slices are ``MOST_SLICES`` at most.
* **blocked path** (the same with cells): the store is salted into groups of at
  most ``group_budget_bytes`` per (cell, salt) and the queries are split into blocks;
  a ``cogroup`` on the number of (cell, salt, qblock) meets every store group with every
  query block that needs it.  Both sides of a group are bounded, hot cells are split by the
  salt, no (query, document) pair is materialised as a row, and candidates grow with the
  number of store groups, not with the tasks that read the store.
* the final top-k is a ``row_number`` window per query over the local candidates;
  Spark plans it with ``WindowGroupLimit`` so candidates are pruned before the shuffle.

Scores are rounded to ``decimals`` (6; half away from zero) before ranking; ties are
broken by the smaller document id, so results are deterministic.  ``decimals=None``
ranks raw scores and rounds them to 6 decimals afterwards.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veriscope.functions.vectors import cosine_expr, dot_expr

CANDIDATE_SCHEMA = "qid long, did long, score double"
#: Packed vectors: ids, distinct vectors (``dim`` numbers each) and, of queries, the number of each id's vector.
PIECE_SCHEMA = "part int, dim int, ids binary, vectors binary, of binary"
_NO_DOC, _NULL_ID = np.iinfo(np.int64).max, np.iinfo(np.int64).min
RECALL = 0.9
#: Queries that are broadcast at most (each task returns k rows for each of them), least rows of a query block and
#: most, groups for each core, and tasks at most.
BROADCAST_QUERIES, LEAST_QUERIES, MOST_QUERIES, GROUPS_PER_CORE, MAX_TASKS = 1 << 13, 256, 1 << 14, 4, 10_000
#: Slices of a store without cells at most (each returns k rows a query), and pieces of a group's bytes that rows are packed into.
MOST_SLICES, PIECES = 8, 4


def round6(x: np.ndarray, decimals: int = 6) -> np.ndarray:
    """Round half away from zero to 6 decimals (matches SQL ROUND on these values)."""
    unit = 10.0 ** decimals
    return np.sign(x) * np.floor(np.abs(x) * unit + 0.5) / unit


def _as_matrix(col: pd.Series, dim: int | None = None) -> np.ndarray:
    if len(col) == 0:
        return np.zeros((0, dim or 0), dtype=np.float64)
    return np.stack([np.asarray(v, dtype=np.float64) for v in col.values])


def _normalise(m: np.ndarray) -> np.ndarray:
    n = np.linalg.norm(m, axis=1, keepdims=True)
    with np.errstate(invalid="ignore", divide="ignore"):
        out = np.where(n > 0, m / np.where(n > 0, n, 1.0), 0.0)
    return out


def merge_topk(best_s: np.ndarray, best_d: np.ndarray, s: np.ndarray, d: np.ndarray, k: int):
    """Merge candidate scores ``s`` / ids ``d`` (q x m) into running top-k (q x k).

    Order: score descending, then id ascending.  argpartition selects k per row;
    rows where a tie straddles the k-th place are re-sorted exactly.
    """
    cs = np.concatenate([best_s, s], axis=1)
    cd = np.concatenate([best_d, d], axis=1)
    m = cs.shape[1]
    if m <= k:
        order = np.lexsort((cd, -cs), axis=1)
    else:
        idx = np.argpartition(-cs, k - 1, axis=1)[:, :k]
        sel = np.take_along_axis(cs, idx, 1)
        kth = sel.min(axis=1)
        n_all = (cs == kth[:, None]).sum(axis=1)
        n_sel = (sel == kth[:, None]).sum(axis=1)
        tied = np.flatnonzero(n_all != n_sel)
        if len(tied):
            idx[tied] = np.lexsort((cd[tied], -cs[tied]), axis=1)[:, :k]
        sel_s = np.take_along_axis(cs, idx, 1)
        sel_d = np.take_along_axis(cd, idx, 1)
        o2 = np.lexsort((sel_d, -sel_s), axis=1)
        return np.take_along_axis(sel_s, o2, 1), np.take_along_axis(sel_d, o2, 1)
    return np.take_along_axis(cs, order, 1)[:, :k], np.take_along_axis(cd, order, 1)[:, :k]


def _merge_pairs(best_s: np.ndarray, best_d: np.ndarray, rows: np.ndarray, s: np.ndarray, d: np.ndarray, k: int) -> None:
    """Merge scored pairs (row, score, id) into the running top-k of their rows, in place."""
    own, at = np.unique(rows, return_inverse=True)
    at = np.concatenate([np.repeat(np.arange(len(own)), k), at])
    cs = np.concatenate([best_s[own].ravel(), s])
    cd = np.concatenate([best_d[own].ravel(), d])
    order = np.lexsort((cd, -cs, at))
    begin = np.searchsorted(at[order], np.arange(len(own)))
    take = order[begin[:, None] + np.arange(k)[None, :]]            # each row has its k old entries at least
    best_s[own], best_d[own] = cs[take], cd[take]


def _distinct(m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first row of each distinct vector, number of the distinct vector of each row)."""
    if not m.size:
        return np.arange(min(1, len(m))), np.zeros(len(m), np.int64)
    m = np.ascontiguousarray(m)
    _, first, of = np.unique(m.view(np.dtype((np.void, m.shape[1] * m.itemsize))).ravel(), return_index=True,
                             return_inverse=True)
    return first, of.ravel()


def _first_copies(m: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Rows that can be among a query's k best: of equal vectors, which score alike, the k smallest ids."""
    _, of = _distinct(m)
    order = np.lexsort((ids, of))
    nth = np.arange(len(order)) - np.searchsorted(of[order], of[order])
    return np.sort(order[nth < k])


def _few(cells: np.ndarray) -> np.ndarray:
    """``np.flatnonzero`` of booleans that are nearly all false: looked at eight at a time first."""
    flat = np.ascontiguousarray(cells).ravel()
    whole = len(flat) // 8 * 8
    at = (np.flatnonzero(flat[:whole].view(np.uint64))[:, None] * 8 + np.arange(8)).ravel()
    return np.concatenate([at[flat[at]], whole + np.flatnonzero(flat[whole:])])


#: Cells of one product, rows that are scored in full before bounds hold, and rows between two merges.
PRODUCT_CELLS, DENSE_ROWS, MERGE_ROWS = 1 << 20, 512, 1 << 13


class _TopK:
    """Running top-k for a fixed set of queries.

    Cosine is computed as dot / sqrt(|q|^2 |d|^2) (0 when a norm is 0), the same
    formula as the SQL oracle, so integer count vectors give identical doubles.

    Once a query has k rows, others are first compared in single precision on vectors of
    length 1; only those that reach its k-th score, less the error that the product can
    have, are scored in double precision.  No row of the k best is lost.
    """

    def __init__(self, q: np.ndarray, qids: np.ndarray, k: int, metric: str, chunk_cells: int = 1 << 22,
                 decimals: int | None = 6, product_rows: int = 1 << 12):
        self.q, self.qids, self.k, self.metric, self.decimals = q, qids, k, metric, decimals
        self.qn2 = (q * q).sum(axis=1)
        self.s = np.full((len(qids), k), -np.inf)
        self.d = np.full((len(qids), k), _NO_DOC, dtype=np.int64)
        self.cells, self.width = chunk_cells, max(1, min(product_rows, PRODUCT_CELLS))
        self.plain = np.isfinite(self.qn2) & (self.qn2 > 0)              # others are scored in full
        self.qn = np.where(self.plain, np.sqrt(np.where(self.plain, self.qn2, 1.0)), 1.0)
        self.unit = np.where(self.plain[:, None], q / self.qn[:, None], 0.0).astype(np.float32)

    def _score(self, raw: np.ndarray, den2: np.ndarray) -> np.ndarray:
        if self.metric == "cosine":
            den = np.sqrt(den2)
            with np.errstate(invalid="ignore", divide="ignore"):
                raw = np.where(den > 0, raw / np.where(den > 0, den, 1.0), 0.0)
        return raw if self.decimals is None else round6(raw, self.decimals)

    def add(self, docs: np.ndarray, ids: np.ndarray, rows: np.ndarray | None = None):
        if len(self.q) == 0 or len(docs) == 0 or rows is not None and len(rows) == 0:
            return
        rows = np.arange(len(self.q)) if rows is None else rows
        dn2 = (docs * docs).sum(axis=1)
        good, plain = np.isfinite(dn2), self.plain[rows]
        if not good.all():
            self._add_all(docs[~good], ids[~good], rows)
            docs, ids, dn2 = docs[good], ids[good], dn2[good]
        if not plain.all():
            self._add_all(docs, ids, rows[~plain])
            rows = rows[plain]
        begun = np.isfinite(self.s[rows, -1])
        lo = 0
        if not begun.all():                                # no bound yet: the first rows in full
            lo = max(DENSE_ROWS, self.k)
            self._add_all(docs[:lo], ids[:lo], rows[~begun])
            if begun.any():
                self._add_above(docs[:lo], ids[:lo], dn2[:lo], rows[begun])
        while lo < len(docs):
            hi = lo + min(MERGE_ROWS, lo or MERGE_ROWS)
            self._add_above(docs[lo:hi], ids[lo:hi], dn2[lo:hi], rows)
            lo = hi

    def _add_all(self, docs: np.ndarray, ids: np.ndarray, rows: np.ndarray):
        """Every row scored in double precision against the queries ``rows``."""
        step = max(1, self.cells // max(1, len(docs)))
        for at in (rows[lo:lo + step] for lo in range(0, len(rows), step)) if len(docs) else ():
            wide = max(1, self.cells // len(at))
            for lo in range(0, len(docs), wide):
                dm = docs[lo:lo + wide]
                with np.errstate(invalid="ignore", over="ignore"):
                    s = self._score(self.q[at] @ dm.T, self.qn2[at][:, None] * (dm * dm).sum(axis=1)[None, :])
                d = np.broadcast_to(ids[lo:lo + wide], s.shape)
                self.s[at], self.d[at] = merge_topk(self.s[at], self.d[at], s, d, self.k)

    def _add_above(self, docs: np.ndarray, ids: np.ndarray, dn2: np.ndarray, rows: np.ndarray):
        """Rows that may reach the k-th score of a query."""
        if not len(docs) or not len(rows):
            return
        dn = np.sqrt(dn2)
        top = 1.0 if self.metric == "cosine" else max(float(dn.max()), np.finfo(np.float64).tiny)
        by = np.where(dn > 0, dn, 1.0) if self.metric == "cosine" else np.full(len(dn), top)
        unit = (docs / by[:, None]).astype(np.float32)
        # single precision: casts and n products and sums of vectors no longer than 1; rounded scores: half a unit
        slack = (docs.shape[1] + 8) * 2.0 ** -23
        unit_score = 0.0 if self.decimals is None else 10.0 ** -self.decimals
        span = top if self.metric == "cosine" else self.qn[rows] * top
        low = ((self.s[rows, -1] - unit_score) / span - slack).astype(np.float32)
        step = max(1, PRODUCT_CELLS // self.width)
        qi, di = [], []
        for a in range(0, len(rows), step):
            left, bound = self.unit[rows[a:a + step]], low[a:a + step, None]
            for b in range(0, len(docs), self.width):
                right = unit[b:b + self.width]
                hit = _few(left @ right.T >= bound)
                if len(hit):
                    qi.append(rows[a + hit // len(right)])
                    di.append(b + hit % len(right))
                if sum(map(len, qi)) > self.cells // 4:                # bounded, however many reach it
                    self._merge(qi, di, docs, ids, dn2)
                    qi, di = [], []
        self._merge(qi, di, docs, ids, dn2)

    def _merge(self, qi: list, di: list, docs: np.ndarray, ids: np.ndarray, dn2: np.ndarray):
        if not qi:
            return
        qi, di = np.concatenate(qi), np.concatenate(di)
        s = np.empty(len(qi))
        step = max(1, self.cells // max(1, docs.shape[1]))
        for lo in range(0, len(qi), step):
            q, d = qi[lo:lo + step], di[lo:lo + step]
            s[lo:lo + step] = self._score(np.einsum("ij,ij->i", self.q[q], docs[d]), self.qn2[q] * dn2[d])
        last_s, last_d = self.s[qi, -1], self.d[qi, -1]
        new = (s > last_s) | (s == last_s) & (ids[di] < last_d)
        if new.any():
            _merge_pairs(self.s, self.d, qi[new], s[new], ids[di[new]], self.k)

    def frame(self) -> pd.DataFrame:
        ok = np.isfinite(self.s)
        qi, _ = np.nonzero(ok)
        return pd.DataFrame({"qid": self.qids[qi], "did": self.d[ok], "score": self.s[ok]})


def _broadcast_candidates(queries: DataFrame, store: DataFrame, k: int, metric: str,
                          qid: str, did: str, qvec: str, dvec: str,
                          probes: str | None, cell: str | None, decimals: int | None) -> DataFrame:
    spark = store.sparkSession
    qcols = [F.col(qid).cast("long").alias("qid"), F.col(qvec).alias("v")]
    if probes:
        qcols.append(F.col(probes).alias("p"))
    qpdf = queries.select(*qcols).toPandas()   # size checked by the caller
    q = _as_matrix(qpdf["v"])
    qids = qpdf["qid"].to_numpy(dtype=np.int64)
    probe_map = None
    if probes:
        pm: dict[int, list[int]] = {}
        for i, cells in enumerate(qpdf["p"].values):
            for c in (cells if cells is not None else []):
                pm.setdefault(int(c), []).append(i)
        probe_map = {c: np.asarray(v, dtype=np.int64) for c, v in pm.items()}
    bc = spark.sparkContext.broadcast((q, qids, probe_map))

    def local_topk(batches):
        qm, ids, pmap = bc.value
        top = _TopK(qm, ids, k, metric, decimals=decimals)
        for pdf in batches:
            if pdf.empty:
                continue
            dm = _as_matrix(pdf["v"], qm.shape[1])
            di = pdf["did"].to_numpy(dtype=np.int64)
            if pmap is None:
                top.add(dm, di)
            else:
                cells = pdf["c"].to_numpy()
                for c in np.unique(cells):
                    rows = pmap.get(int(c))
                    if rows is None:
                        continue
                    m = cells == c
                    top.add(dm[m], di[m], rows)
        out = top.frame()
        if len(out):
            yield out

    scols = [F.col(did).cast("long").alias("did"), F.col(dvec).alias("v")]
    if probes:
        scols.append(F.col(cell).cast("int").alias("c"))
        # Only cells some query probes are read (partition filter on a cell-partitioned store).
        store = store.filter(F.col(cell).isin(sorted(probe_map)))
    return store.select(*scols).mapInPandas(local_topk, CANDIDATE_SCHEMA)


def _packed(rows: DataFrame, n: int, most: int | None, k: int) -> DataFrame:
    """Rows (id, v, part) as ``PIECE_SCHEMA``, partition ``part`` of ``n`` holding the pieces of that part.

    A piece of a store has at most ``most`` rows, of equal vectors the ``k`` smallest ids.  Without
    ``most`` a part is one piece, of queries: equal vectors are packed, and later searched, once.
    Packing ends in a shuffle, so that it is done once however many tasks read a piece."""
    def piece(held):
        m, ids, part = np.concatenate([x[0] for x in held]), np.concatenate([x[1] for x in held]), held[0][2]
        if most:
            kept, of = _first_copies(m, ids, k), b""
            m, ids = m[kept], ids[kept]
        else:
            first, of = _distinct(m)
            m, of = m[first], of.astype(np.int32).tobytes()
        values = ([part], [m.shape[1]], [ids.tobytes()], [m.tobytes()], [of])
        return pa.RecordBatch.from_arrays(
            [pa.array(v, t) for v, t in zip(values, (pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()))],
            ["part", "dim", "ids", "vectors", "of"])

    def pack(batches):
        held, size = [], 0
        for batch in batches:
            for lo in range(0, batch.num_rows, most or max(1, batch.num_rows)):
                b = batch.slice(lo, most)
                if most and held and size + b.num_rows > most:
                    yield piece(held)
                    held, size = [], 0
                held.append((_arrow_matrix(b.column("v")), b.column("id").fill_null(_NULL_ID).to_numpy(), b.column("part")[0].as_py()))
                size += b.num_rows
        if held:
            yield piece(held)

    return rows.repartitionById(n, "part").mapInArrow(pack, PIECE_SCHEMA).repartitionById(n, "part")


def _arrow_matrix(col: pa.Array) -> np.ndarray:
    """Vectors of equal length as a matrix, in the precision they are stored in."""
    dims = col.value_lengths().unique().to_pylist()
    if len(dims) > 1:
        raise ValueError(f"vectors of different lengths: {sorted(dims)}")
    kind = np.float32 if pa.types.is_float32(col.type.value_type) else np.float64
    return col.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(len(col), dims[0])


def _unpacked(vectors: pa.Buffer, n: int, dim: int) -> np.ndarray:
    kind = np.float32 if vectors.size == 4 * n * dim else np.float64
    return np.frombuffer(vectors, kind).reshape(n, dim).astype(np.float64)


def _paired_candidates(queries: DataFrame, store: DataFrame, k: int, metric: str,
                       qid: str, did: str, qvec: str, dvec: str,
                       max_query_rows: int, group_rows: int, product_rows: int, decimals: int | None) -> DataFrame:
    """Every slice of the store meets every block of queries; vectors are written once, whatever the number of either."""
    s = store.select(F.col(did).cast("long").alias("id"), F.col(dvec).alias("v"))
    q = queries.select(F.col(qid).cast("long").alias("id"), F.col(qvec).alias("v"))
    n_docs, n_queries = s.count(), q.count()
    most = max(1, group_rows // PIECES)
    # Query blocks are small enough to give every core several tasks, and a block is no larger than a store's piece.
    share = n_queries // (GROUPS_PER_CORE * store.sparkSession.sparkContext.defaultParallelism) + 1
    block_rows = min(max_query_rows, max(LEAST_QUERIES, share), most)
    slices, blocks = (max(1, n) for n in (min(MOST_SLICES, -(-n_docs // group_rows)), -(-n_queries // block_rows)))
    dealt = lambda n: F.pmod(F.xxhash64("id", "v"), F.lit(n)).cast("int").alias("part")
    s = _packed(s.select("id", "v", dealt(slices)), slices, most, k)
    q = _packed(q.select("id", "v", dealt(blocks)), blocks, None, k)

    def search(batches):
        tops = {}
        for b in batches:
            for r in range(b.num_rows):
                block, qdim, dim = (b.column(x)[r].as_py() for x in ("block", "qdim", "dim"))
                qids, queries, of, ids, vectors = (b.column(x)[r].as_buffer() for x in ("qids", "queries", "of", "ids", "vectors"))
                if block not in tops:
                    of = np.frombuffer(of, np.int32)
                    qm = _unpacked(queries, int(of.max()) + 1, qdim)
                    tops[block] = _TopK(qm, np.arange(len(qm)), k, metric, decimals=decimals, product_rows=product_rows), np.frombuffer(qids, np.int64), of
                ids = np.frombuffer(ids, np.int64)
                tops[block][0].add(_unpacked(vectors, len(ids), dim), ids)
        for top, qids, of in tops.values():
            top.qids, top.s, top.d = qids, top.s[of], top.d[of]
            yield from pa.Table.from_pandas(top.frame(), preserve_index=False).to_batches(1 << 16)

    right = q.select(F.col("part").alias("block"), F.col("dim").alias("qdim"), F.col("ids").alias("qids"),
                     F.col("vectors").alias("queries"), "of")
    pairs = s.select("dim", "ids", "vectors").hint("shuffle_replicate_nl").crossJoin(right)
    return pairs.mapInArrow(search, CANDIDATE_SCHEMA)


def _blocked_candidates(queries: DataFrame, store: DataFrame, k: int, metric: str,
                        qid: str, did: str, qvec: str, dvec: str,
                        probes: str | None, cell: str | None,
                        max_query_rows: int, group_rows: int, product_rows: int, decimals: int | None) -> DataFrame:
    if not cell:
        return _paired_candidates(queries, store, k, metric, qid, did, qvec, dvec, max_query_rows, group_rows,
                                  product_rows, decimals)
    if probes:
        # Probed cells: at most nlist values, so they are collected and used as a partition filter.
        needed = [r[0] for r in queries.select(F.explode(probes)).distinct().collect()]
        store = store.filter(F.col(cell).isin(sorted(int(c) for c in needed)))
    s = store.select(F.col(did).cast("long").alias("did"), F.col(dvec).alias("v"),
                     F.col(cell).cast("int").alias("cell"))
    q = (queries.select(F.col(qid).cast("long").alias("qid"), F.col(qvec).alias("v"),
                        (F.col(probes) if probes else F.array(F.lit(0))).alias("cells"))
         .select("qid", "v", F.explode("cells").alias("cell")))
    # Per cell: store salts and query blocks, from the cell sizes on each side.  One row
    # per cell (bounded by nlist), broadcast to both sides.
    s_stats = s.groupBy("cell").agg(F.count(F.lit(1)).alias("n_docs"))
    q_stats = q.groupBy("cell").agg(F.count(F.lit(1)).alias("n_queries"))
    sizes = s_stats.join(q_stats, "cell").collect()
    # Query blocks are small enough to give every core several groups, however few cells there are.
    share = sum(r["n_queries"] for r in sizes) // (GROUPS_PER_CORE * store.sparkSession.sparkContext.defaultParallelism) + 1
    block_rows = min(max_query_rows, max(LEAST_QUERIES, share))
    plan, first = [], 0
    for r in sizes:
        salts, blocks = -(-r["n_docs"] // group_rows), -(-r["n_queries"] // block_rows)
        plan.append((r["cell"], salts, blocks, first))
        first += salts * blocks
    stats = store.sparkSession.createDataFrame(plan, "cell int, salts int, qblocks int, first int")
    number = (F.col("first") + F.col("salt") * F.col("qblocks") + F.col("qblock")).alias("part")
    s_g = (s.join(F.broadcast(stats), "cell")
           .withColumn("salt", F.pmod(F.xxhash64("did"), F.col("salts")).cast("int"))
           .withColumn("qblock", F.explode(F.sequence(F.lit(0), F.col("qblocks") - 1)))
           .select("did", "v", number))
    q_g = (q.join(F.broadcast(stats), "cell")
           .withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)))
           .withColumn("qblock", F.pmod(F.xxhash64("qid"), F.col("qblocks")).cast("int"))
           .select("qid", "v", number))

    def group_topk(docs: pd.DataFrame, qs: pd.DataFrame) -> pd.DataFrame:
        if docs.empty or qs.empty:
            return pd.DataFrame({"qid": pd.Series([], dtype="int64"), "did": pd.Series([], dtype="int64"),
                                 "score": pd.Series([], dtype="float64")})
        qm = _as_matrix(qs["v"])
        dm = _as_matrix(docs["v"], qm.shape[1])
        di, qids = docs["did"].to_numpy(dtype=np.int64), qs["qid"].to_numpy(dtype=np.int64)
        kept = _first_copies(dm, di, k)
        first, of = _distinct(qm)                               # equal queries are searched once
        top = _TopK(qm[first], np.arange(len(first)), k, metric, decimals=decimals, product_rows=product_rows)
        top.add(dm[kept], di[kept])
        top.q, top.qids, top.s, top.d = qm, qids, top.s[of], top.d[of]
        return top.frame()

    # As many tasks as groups, one each: placed by number, for hashed numbers would meet in some tasks and miss others.
    n = max(1, min(first, MAX_TASKS))
    return (s_g.repartitionById(n, "part").groupBy("part").cogroup(q_g.repartitionById(n, "part").groupBy("part"))
            .applyInPandas(group_topk, CANDIDATE_SCHEMA))


def final_topk(candidates: DataFrame, k: int, qid: str = "qid", did: str = "did",
               score: str = "score") -> DataFrame:
    """Keep the k best rows per query; rank from 1, ties by smaller id."""
    w = Window.partitionBy(qid).orderBy(F.col(score).desc(), F.col(did).asc())
    return candidates.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def knn_topk(queries: DataFrame, store: DataFrame, k: int = 10, metric: str = "cosine",
             qid: str = "claim_id", did: str = "doc_id", qvec: str = "embedding",
             dvec: str = "embedding", probes: str | None = None, cell: str | None = None,
             method: str = "auto", broadcast_budget_bytes: int = 256 << 20,
             max_store_rows: int | None = None, dim: int | None = None,
             group_budget_bytes: int = 64 << 20, decimals: int | None = 6) -> DataFrame:
    """Exact (or IVF when ``probes``/``cell`` are given) top-k store rows per query.

    The query side is broadcast only when its estimated size (rows x dim) fits the
    budget and it has ``BROADCAST_QUERIES`` rows at most; otherwise the paired plan is used, or with
    cells the blocked one.  Store groups take at most ``group_budget_bytes`` of vectors (pieces of a
    slice a quarter of it), ``max_store_rows`` of them in one product.  Returns ``(qid, did, score, rank)`` with the caller's column names.
    """
    if metric not in ("cosine", "dot_product"):
        raise ValueError(f"unknown similarity {metric!r}")
    if probes and not cell:
        raise ValueError("probes need the store's cell column")
    # Rows without a vector cannot be scored (documents stored but not embedded yet).
    queries = queries.filter(F.col(qvec).isNotNull())
    store = store.filter(F.col(dvec).isNotNull())
    n_q = queries.count()
    if dim is None:
        dim = queries.agg(F.max(F.size(qvec))).first()[0] or 0
    est = n_q * (dim * 8 + 64)
    if method == "auto":
        method = "broadcast" if est <= broadcast_budget_bytes and n_q <= BROADCAST_QUERIES else "blocked"
    if method == "broadcast":
        cand = _broadcast_candidates(queries, store, k, metric, qid, did, qvec, dvec, probes, cell, decimals)
    elif method == "blocked":
        max_query_rows = max(1, min(MOST_QUERIES, broadcast_budget_bytes // (dim * 8 + 64)))
        group_rows = max(1, group_budget_bytes // (dim * 8 + 64))
        cand = _blocked_candidates(queries, store, k, metric, qid, did, qvec, dvec, probes, cell,
                                   max_query_rows, group_rows, max_store_rows or 1 << 12, decimals)
    else:
        raise ValueError(f"unknown method {method!r}")
    out = final_topk(cand, k)
    score = F.round("score", 6).alias("score") if decimals is None else "score"
    return out.select(F.col("qid").alias(qid), F.col("did").alias(did), score, F.col("rank").cast("int"))


def topk_single(store: DataFrame, vector: list[float], k: int = 10, metric: str = "cosine",
                did: str = "doc_id", dvec: str = "embedding", decimals: int | None = 6) -> DataFrame:
    """Top-k for one query vector: a per-row expression and TakeOrdered (no shuffle of rows)."""
    qv = F.array(*[F.lit(float(x)).cast("double") for x in vector])
    sim = cosine_expr(F.col(dvec), qv) if metric == "cosine" else dot_expr(F.col(dvec), qv)
    scored = store.filter(F.col(dvec).isNotNull()).withColumn("score", sim if decimals is None else F.round(sim, decimals))
    top = scored.orderBy(F.col("score").desc(), F.col(did).asc()).limit(k)
    w = Window.orderBy(F.col("score").desc(), F.col(did).asc())
    ranked = top.withColumn("rank", F.row_number().over(w).cast("int"))
    return ranked.withColumn("score", F.round("score", 6)) if decimals is None else ranked


# --------------------------------------------------------------------------- IVF

def _units(df: DataFrame, col: str) -> DataFrame:
    """``v``: the vectors at length 1.  The norm is a column of its own: inside the lambda it would be summed for each component."""
    nrm = F.sqrt(F.aggregate(F.col(col), F.lit(0.0).cast("double"),
                             lambda a, x: a + x.cast("double") * x.cast("double")))
    return df.select(F.col(col).alias("v"), nrm.alias("nrm")).select(
        F.transform("v", lambda x: F.when(F.col("nrm") > 0, x.cast("double") / F.col("nrm")).otherwise(F.lit(0.0))).alias("v"))


def train_ivf(store: DataFrame, nlist: int, vec: str = "embedding", metric: str = "cosine",
              seed: int = 7, max_iter: int = 10, train_fraction: float | None = None) -> np.ndarray:
    """Cluster centres for an IVF index (pyspark.ml KMeans; nlist x dim, bounded by nlist).

    ``train_fraction`` fits the centres on a sample (the usual quantizer training on
    very large stores); every row is still filed under a cell and searched."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector
    src = store.sample(fraction=train_fraction, seed=seed) if train_fraction else store
    src = _units(src, vec) if metric == "cosine" else src.select(F.col(vec).alias("v"))
    feats = src.select(array_to_vector("v").alias("features"))
    model = KMeans(k=nlist, seed=seed, maxIter=max_iter, featuresCol="features").fit(feats)
    return np.asarray(model.clusterCenters(), dtype=np.float64)


def _nearest_cells_udf(centroids: np.ndarray, n: int, metric: str):
    cn = (centroids ** 2).sum(axis=1)

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def nearest(vs: pd.Series) -> pd.Series:
        if len(vs) == 0:
            return pd.Series([], dtype=object)
        m = _as_matrix(vs, centroids.shape[1])
        if metric == "cosine":
            m = _normalise(m)
        d = cn[None, :] - 2.0 * (m @ centroids.T)
        order = np.argsort(d, axis=1, kind="stable")[:, :n]
        return pd.Series([r.astype(np.int32) for r in order])
    return nearest


def assign_cells(df: DataFrame, centroids: np.ndarray, vec: str = "embedding", metric: str = "cosine",
                 name: str = "cell") -> DataFrame:
    """Nearest centre per row (the cell a store row is filed under)."""
    return df.withColumn(name, _nearest_cells_udf(centroids, 1, metric)(F.col(vec))[0])


def write_ivf_store(store: DataFrame, centroids: np.ndarray, path: str, vec: str = "embedding",
                    metric: str = "cosine", mode: str = "overwrite") -> None:
    """File every store row under its nearest cell, ``partitionBy("cell")``.

    The ``rebalance`` hint lets AQE split a hot cell over several writers and merge
    small ones, instead of one file per (task, cell)."""
    (assign_cells(store, centroids, vec, metric).hint("rebalance", "cell")
     .write.mode(mode).partitionBy("cell").parquet(path))


def auto_nlist(n_rows: int) -> int:
    """Cell count chosen from the store size (about 4 sqrt(n), at least 1)."""
    return max(1, round(4 * math.sqrt(max(n_rows, 1))))


def build_ivf_index(store: DataFrame, path: str, index_type: str = "IVF_FLAT", nlist: int | None = None,
                    vec: str = "embedding", metric: str = "cosine", seed: int = 7,
                    train_fraction: float | None = None, centroids: np.ndarray | None = None) -> np.ndarray:
    """Train centres and write the cell-partitioned store, centres beside it; returns the centres.

    ``IVF_FLAT`` uses the given ``nlist``; ``AUTOINDEX`` picks it from the row count;
    given ``centroids`` are taken as they are.  ``open_ivf_index`` opens the index again."""
    if centroids is not None:
        return _write_index(store, np.asarray(centroids, np.float64), path, vec, metric)
    if index_type == "AUTOINDEX":
        nlist = auto_nlist(store.count())
    elif index_type != "IVF_FLAT":
        raise ValueError(f"unknown index type {index_type!r}")
    if not nlist:
        raise ValueError("IVF_FLAT needs nlist")
    centroids = train_ivf(store, nlist, vec, metric, seed, train_fraction=train_fraction)
    return _write_index(store, centroids, path, vec, metric)


def _centres_path(path: str) -> str:
    return f"{path.rstrip('/')}-centres"


def _write_index(store: DataFrame, centroids: np.ndarray, path: str, vec: str, metric: str) -> np.ndarray:
    write_ivf_store(store, centroids, path, vec, metric)
    rows = [(i, [float(x) for x in c]) for i, c in enumerate(centroids)]           # nlist rows
    store.sparkSession.createDataFrame(rows, "cell int, centre array<double>").write.mode("overwrite").parquet(
        _centres_path(path))
    return centroids


def open_ivf_index(spark: SparkSession, path: str) -> tuple[DataFrame, np.ndarray]:
    """(store, centres) of an index written before; nlist centres come to the driver."""
    rows = spark.read.parquet(_centres_path(path)).orderBy("cell").collect()
    return spark.read.parquet(path), np.array([r["centre"] for r in rows], np.float64)


def probe_cells(df: DataFrame, centroids: np.ndarray, nprobe: int, vec: str = "embedding",
                metric: str = "cosine", name: str = "cells") -> DataFrame:
    """The ``nprobe`` nearest cells per query."""
    nprobe = max(1, min(nprobe, len(centroids)))
    return df.withColumn(name, _nearest_cells_udf(centroids, nprobe, metric)(F.col(vec)))


def choose_nprobe(queries: DataFrame, store: DataFrame, centroids: np.ndarray, k: int = 10, recall: float = RECALL,
                  metric: str = "cosine", qid: str = "claim_id", did: str = "doc_id", vec: str = "embedding",
                  cell: str = "cell") -> int:
    """The least number of probed cells that finds ``recall`` of the exact top-k of these queries.

    A true neighbour is found just when its cell is probed: the rows of other cells that
    are missing can only let it rise.  Without any neighbour to measure, all cells."""
    exact = knn_topk(queries, store, k, metric, qid=qid, did=did, qvec=vec, dvec=vec).select(qid, did)
    order = probe_cells(queries.where(F.col(vec).isNotNull()), centroids, len(centroids), vec, metric, "_order")
    at = (exact.join(store.select(did, cell), did).join(order.select(qid, "_order"), qid)
          .groupBy(F.array_position("_order", F.col(cell)).alias("nth")).agg(F.count(F.lit(1)).alias("n")).collect())
    found = np.zeros(len(centroids) + 1)
    for r in at:                                           # at most nlist rows
        found[int(r["nth"])] = r["n"]
    if not found.sum():
        return len(centroids)
    return int(np.flatnonzero(np.cumsum(found) >= recall * found.sum())[0])
