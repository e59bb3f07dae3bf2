"""Exact k-NN that skips (J4, J7): a two-level tree of cells with bounds, and residual codes.

``build_tree`` files every store row under a leaf: branches are k-means centres of a
bounded sample, leaves are k-means centres inside each branch (about 4 sqrt(n) in all,
``MAX_LEAVES`` at most).  Three tables are written:

* ``leaves``: centre, radius and row count of each leaf;
* ``codes``: per row one signed byte a dimension of its distance from the leaf's centre,
  and the norm of what the code leaves out (``err``);
* ``vectors``: the rows as they are, partitioned by leaf group.

``search`` is exact.  For a vector x with centre c and code vector y, every query q has
q.x <= q.(c + y) + |q| err, and for all rows of a leaf q.x <= q.c + |q| radius.  Leaves are
visited in the order of their bound: the first ones give each query a k-th score that is
surely reached; of the others only those whose bound reaches it are scanned, by codes;
only rows whose own bound still reaches it are read as vectors and scored.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from veriscope.operators.knn import _as_matrix, _normalise, final_topk, round6
from veriscope.sources.scan import written

#: Leaves at most (they are broadcast: 65,536 x 64 dimensions are 32 MB), and rows of the training sample.
MAX_LEAVES, SAMPLE_ROWS = 1 << 16, 200_000
#: Scores are ranked after rounding to 6 decimals, so bounds give way by more than that.
SLACK = 2e-6
#: Rows of one side of a group at most.
GROUP_ROWS, QUERY_ROWS = 1 << 15, 1 << 12
#: Leaves of one part: they are filed and scanned together.
PART = 64
#: Cells of queries x leaves bounded at once, rows of one answer, and rows a scan holds before it leaves some out.
VISIT_CELLS, VISIT_ROWS, HELD_ROWS = 1 << 20, 1 << 14, 1 << 20
CODE = "did long, leaf int, code binary, scale float, err float"


def nearest(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Number of the nearest centre, in slices of bounded size."""
    step, norm = max(1, (1 << 22) // len(centres)), (centres ** 2).sum(1)[None, :]
    parts = [np.argmin(norm - 2 * points[lo:lo + step] @ centres.T, axis=1) for lo in range(0, len(points), step)]
    return np.concatenate(parts) if parts else np.empty(0, np.int64)


def lloyd(points: np.ndarray, k: int, seed: int, rounds: int = 8) -> np.ndarray:
    """k-means centres of a bounded sample; empty clusters are dropped."""
    rng = np.random.default_rng(seed)
    centres = points[rng.choice(len(points), min(k, len(points)), replace=False)].copy()
    for _ in range(rounds):
        near = nearest(points, centres)
        n = np.bincount(near, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, near, points)
        centres = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centres)[n > 0]
    return centres


def _points(values: pd.Series, metric: str, dim: int | None = None) -> np.ndarray:
    m = _as_matrix(values, dim)
    return _normalise(m) if metric == "cosine" else m


def train_leaves(store: DataFrame, n_rows: int, vec: str, metric: str, seed: int, leaves: int | None) -> pd.DataFrame:
    """(branch, branch_centre, leaf, centre): branches first, then the leaves of each branch in a task of its own.

    Both levels see the same sample of about ``SAMPLE_ROWS`` rows; a branch gets leaves in
    proportion to its share, so that leaves hold about as many rows each."""
    total = min(MAX_LEAVES, leaves or max(1, round(4 * math.sqrt(max(n_rows, 1)))))
    branches = max(1, round(math.sqrt(total)))
    sample = store.select(F.col(vec).alias("v")).where(
        F.pmod(F.xxhash64("v", F.lit(seed)), F.lit(1 << 30)) < int(min(1.0, SAMPLE_ROWS / max(n_rows, 1)) * (1 << 30)))
    sample, kind = written(sample, "sample"), store.schema[vec].dataType.simpleString()
    heads = sample.limit(branches * 64).toPandas()          # bounded: 64 rows a branch
    if heads.empty:
        return pd.DataFrame({"branch": [], "branch_centre": [], "leaf": [], "centre": []})
    top = lloyd(_points(heads["v"], metric), branches, seed)
    share = total / max(1, min(n_rows, SAMPLE_ROWS))

    def file_rows(batches):
        for b in batches:
            m = _points(b["v"], metric, top.shape[1])
            yield pd.DataFrame({"branch": nearest(m, top), "v": b["v"]})

    def split(b: pd.DataFrame) -> pd.DataFrame:
        m = _points(b["v"], metric, top.shape[1])
        centres = lloyd(m, max(1, min(round(len(m) * share), 4 * branches)), seed)
        return pd.DataFrame({"branch": int(b["branch"].iloc[0]), "centre": [c.tolist() for c in centres]})

    rows = (sample.mapInPandas(file_rows, f"branch int, v {kind}").groupBy("branch")
            .applyInPandas(split, "branch int, centre array<double>").toPandas())      # MAX_LEAVES rows at most
    rows = rows.sort_values("branch", kind="stable").reset_index(drop=True)
    rows["leaf"], rows["branch_centre"] = np.arange(len(rows)), [top[b].tolist() for b in rows["branch"]]
    return rows


class Leaves:
    """Centres of all leaves and of their branches, for filing rows."""

    def __init__(self, rows: pd.DataFrame):
        self.branch_of = rows["branch"].to_numpy(np.int64)
        self.centre = np.array(rows["centre"].tolist(), np.float64)
        ids, first = np.unique(self.branch_of, return_index=True)
        self.branches, self.branch_centre = ids, np.array(rows["branch_centre"].iloc[first].tolist(), np.float64)

    def file(self, m: np.ndarray) -> np.ndarray:
        """Leaf of each row: the nearest branch, then the nearest leaf in it."""
        near = self.branches[nearest(m, self.branch_centre)]
        out = np.empty(len(m), np.int64)
        for b in np.unique(near):
            own = np.flatnonzero(self.branch_of == b)
            rows = near == b
            out[rows] = own[nearest(m[rows], self.centre[own])]
        return out


def build_tree(store: DataFrame, path: str, did: str = "doc_id", vec: str = "embedding", metric: str = "cosine",
               seed: int = 7, leaves: int | None = None) -> str:
    """Write the tree of a store whose ids are unique; every row with a vector is indexed, whatever sample trained the centres."""
    spark = store.sparkSession
    kind = f"{CODE}, v {store.schema[vec].dataType.simpleString()}, far double"
    rows = store.where(F.col(vec).isNotNull()).select(F.col(did).cast("long").alias("did"), F.col(vec).alias("v"))
    trained = train_leaves(rows, rows.count(), "v", metric, seed, leaves)
    if len(trained):
        held = spark.sparkContext.broadcast(Leaves(trained))     # MAX_LEAVES centres at most

        def file_rows(batches):
            tree = held.value
            for b in batches:
                m = _points(b["v"], metric, tree.centre.shape[1])
                leaf = tree.file(m)
                rest = m - tree.centre[leaf]
                scale = np.maximum(np.abs(rest).max(axis=1), 1e-12).astype(np.float32)
                code = np.round(rest / scale[:, None] * 127).astype(np.int8)
                left = np.linalg.norm(rest - code * (scale[:, None].astype(np.float64) / 127), axis=1)
                yield pd.DataFrame({"did": b["did"], "v": b["v"], "leaf": leaf.astype(np.int32), "code": [c.tobytes() for c in code],
                                    "scale": scale, "err": np.nextafter((left * (1 + 1e-9) + 1e-12).astype(np.float32), np.float32(np.inf)),
                                    "far": np.linalg.norm(rest, axis=1)})

        filed = written(rows.mapInPandas(file_rows, kind), "filed")
    else:
        filed = spark.createDataFrame([], kind)
    stats = filed.groupBy("leaf").agg(F.max("far").alias("radius"), F.count(F.lit(1)).alias("n"))
    centres = spark.createDataFrame([(int(i), [float(x) for x in c]) for i, c in zip(trained["leaf"], trained["centre"])], "of int, centre array<double>")
    (stats.join(F.broadcast(centres), F.col("leaf") == F.col("of")).select("leaf", "centre", (F.col("radius") + 1e-9).alias("radius"), "n")
     .write.mode("overwrite").parquet(f"{path}/leaves"))
    (filed.select("did", "leaf", "code", "scale", "err", F.floor(F.col("leaf") / PART).cast("int").alias("part"))
     .hint("rebalance", "part").write.mode("overwrite").partitionBy("part").parquet(f"{path}/codes"))
    filed.select("did", "v").write.mode("overwrite").parquet(f"{path}/vectors")
    return path


def _bounds(q: np.ndarray, centre: np.ndarray, radius: np.ndarray, metric: str) -> np.ndarray:
    """Highest score that any row of a leaf can have (queries x leaves)."""
    dot = q @ centre.T
    norm = np.linalg.norm(q, axis=1)[:, None]
    out = dot + norm * radius[None, :]
    if metric == "cosine":                                   # |q - x| >= |q - c| - radius, for vectors of length 1
        gap = np.sqrt(np.maximum(norm ** 2 - 2 * dot + (centre ** 2).sum(1)[None, :], 0)) - radius[None, :]
        out = np.minimum(out, 1 - np.maximum(gap, 0) ** 2 / 2)
    return out


def _scan(asked: DataFrame, codes: DataFrame, leaves, k: int, metric: str) -> DataFrame:
    """(qid, did, low, high) of the rows of the listed leaves that may be among a query's k best.

    ``asked``: (qid, v, floor, part, cells), a row for each query and part of 64 leaves, one bit of ``cells`` a leaf.
    Groups are (part, salt, query block): both sides bounded."""
    per = asked.groupBy("part").agg(F.count(F.lit(1)).alias("n_q"))
    ids, _, _, n = leaves.value
    sizes = np.bincount(ids // PART, weights=n) if len(ids) else []
    held = codes.sparkSession.createDataFrame([(p, int(x)) for p, x in enumerate(sizes)], "p int, n long")
    plan = written(per.join(F.broadcast(held), F.col("part") == F.col("p"))
                   .select(F.col("part").alias("of"), F.ceil(F.col("n") / GROUP_ROWS).cast("int").alias("salts"),
                           F.ceil(F.col("n_q") / QUERY_ROWS).cast("int").alias("blocks")), "plan")     # a row a part
    docs = (codes.join(F.broadcast(plan), F.col("part") == F.col("of"))
            .select("part", "leaf", "did", "code", "scale", "err", F.pmod(F.xxhash64("did"), F.col("salts")).cast("int").alias("salt"),
                    F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")))
    asked = (asked.join(F.broadcast(plan), F.col("part") == F.col("of"))
             .select("part", "qid", "v", "floor", "cells", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"),
                     F.pmod(F.xxhash64("qid"), F.col("blocks")).cast("int").alias("block")))

    def scan(key, docs: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        none = pd.DataFrame({"qid": pd.Series([], dtype="int64"), "did": pd.Series([], dtype="int64"),
                             "low": pd.Series([], dtype="float64"), "high": pd.Series([], dtype="float64")})
        if docs.empty or asked.empty:
            return none
        ids, centres, _, _ = leaves.value
        q, qid = _points(asked["v"], metric), asked["qid"].to_numpy(np.int64)
        norm, floor = np.linalg.norm(q, axis=1), asked["floor"].to_numpy(np.float64).copy()
        cells = asked["cells"].to_numpy(np.int64).view(np.uint64)
        found, held = [], 0                                       # (query's place, did, low, high)

        def reaching() -> list:
            """What reaches its query's floor, which rises from leaf to leaf: near k rows a query are held."""
            qi, did, low, high = (np.concatenate(x) for x in zip(*found))
            keep = high >= floor[qi] - SLACK
            return [(qi[keep], did[keep], low[keep], high[keep])]

        for leaf, rows in docs.groupby("leaf", sort=False):
            code = np.frombuffer(b"".join(rows["code"]), np.int8).reshape(len(rows), -1)
            x = centres[np.searchsorted(ids, leaf)] + code * (rows["scale"].to_numpy(np.float64)[:, None] / 127)
            err, did = rows["err"].to_numpy(np.float64), rows["did"].to_numpy(np.int64)
            who = np.flatnonzero(cells >> np.uint64(leaf % PART) & np.uint64(1))
            step = max(1, (1 << 21) // len(rows))
            for at in (who[lo:lo + step] for lo in range(0, len(who), step)):
                mid, off = q[at] @ x.T, norm[at][:, None] * err[None, :]
                low, high = mid - off, mid + off
                if low.shape[1] >= k:
                    floor[at] = np.maximum(floor[at], np.partition(low, -k, axis=1)[:, -k])
                qi, di = np.nonzero(high >= floor[at][:, None] - SLACK)
                found.append((at[qi], did[di], low[qi, di], high[qi, di]))
                held += len(qi)
                if held > HELD_ROWS:
                    found = reaching()
                    held = len(found[0][0]) // 2                 # room for as many again
        if not found:
            return none
        qi, did, low, high = reaching()[0]
        return pd.DataFrame({"qid": qid[qi], "did": did, "low": low, "high": high})

    keys = ["part", "salt", "block"]
    return docs.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInPandas(scan, "qid long, did long, low double, high double")


def _kth(found: DataFrame, k: int) -> DataFrame:
    """(of, floor): the k-th highest sure score of each query that has k of them."""
    w = Window.partitionBy("qid").orderBy(F.desc("low"))
    return (found.select("qid", "low").withColumn("r", F.row_number().over(w)).where(F.col("r") <= k)
            .groupBy("qid").agg(F.min("low").alias("floor"), F.count(F.lit(1)).alias("n")).where(F.col("n") >= k)
            .select(F.col("qid").alias("of"), "floor"))


def shortlist(queries: DataFrame, spark: SparkSession, path: str, k: int = 10, metric: str = "cosine",
              qid: str = "claim_id", qvec: str = "embedding", first: int = 4) -> tuple[DataFrame, DataFrame]:
    """(queries, (qid, did) of all rows that can be among a query's k best), by bounds and codes only."""
    rows = spark.read.parquet(f"{path}/leaves").orderBy("leaf").toPandas()                    # MAX_LEAVES at most
    leaves = spark.sparkContext.broadcast((rows["leaf"].to_numpy(np.int64), np.array(rows["centre"].tolist(), np.float64),
                                           rows["radius"].to_numpy(np.float64), rows["n"].to_numpy(np.int64)))
    codes = spark.read.schema(f"{CODE}, part int").parquet(f"{path}/codes")
    asked = written(queries.where(F.col(qvec).isNotNull()).select(F.col(qid).cast("long").alias("qid"),
                                                                  F.col(qvec).alias("v")), "asked")

    def visit(begun: bool):
        def run(batches):
            ids, centre, radius, n = leaves.value
            parts = int(ids[-1]) // PART + 1 if len(ids) else 1
            for b in batches:
                if not len(ids):
                    return
                step = max(1, VISIT_CELLS // len(ids))                    # queries x leaves of a slice
                for part in (b.iloc[lo:lo + step] for lo in range(0, len(b), step)):
                    high = _bounds(_points(part["v"], metric, centre.shape[1]), centre, radius, metric)
                    order, floor = np.argsort(-high, axis=1, kind="stable"), part["floor"].to_numpy(np.float64)
                    enough = (np.cumsum(n[order], axis=1) < k).sum(axis=1) + 1
                    start = np.maximum(first, enough)                     # leaves of the first round
                    place = np.empty_like(order)
                    np.put_along_axis(place, order, np.arange(len(ids))[None, :], axis=1)
                    early = place < start[:, None]
                    reach = ~early & (high >= floor[:, None] - SLACK) if begun else early
                    qi, li = np.nonzero(reach)
                    if not len(qi):
                        continue
                    at, bit = qi * parts + ids[li] // PART, np.uint64(1) << (ids[li] % PART).astype(np.uint64)
                    head = np.flatnonzero(np.diff(at, prepend=-1))         # leaves in order: a run for each query and part
                    rows = qi[head]
                    cells = np.bitwise_or.reduceat(bit, head).view(np.int64)
                    for lo in range(0, len(rows), VISIT_ROWS):
                        own = rows[lo:lo + VISIT_ROWS]
                        yield pd.DataFrame({"qid": part["qid"].to_numpy()[own], "v": part["v"].to_numpy()[own], "floor": floor[own],
                                            "part": (at[head] % parts)[lo:lo + VISIT_ROWS].astype(np.int32),
                                            "cells": cells[lo:lo + VISIT_ROWS]})
        return run

    shape = f"qid long, v {asked.schema['v'].dataType.simpleString()}, floor double, part int, cells long"
    lowest = F.lit(float("-inf"))
    begin = written(asked.withColumn("floor", lowest).mapInPandas(visit(False), shape), "begin")
    near = written(_scan(begin, codes, leaves, k, metric), "near")
    floors = written(_kth(near, k), "floors")
    later = (asked.join(floors, F.col("qid") == F.col("of"), "left")
             .select("qid", "v", F.coalesce("floor", lowest).alias("floor")).mapInPandas(visit(True), shape))
    found = written(near.unionByName(_scan(written(later, "later"), codes, leaves, k, metric)), "found")
    floors = written(_kth(found, k), "floors")
    kept = (found.join(floors, F.col("qid") == F.col("of"), "left")
            .where(F.col("high") >= F.coalesce("floor", lowest) - SLACK).select("qid", "did"))
    return asked, written(kept, "short")


def search(queries: DataFrame, spark: SparkSession, path: str, k: int = 10, metric: str = "cosine", qid: str = "claim_id",
           did: str = "doc_id", qvec: str = "embedding", decimals: int = 6) -> DataFrame:
    """Exact top-k (qid, did, score, rank) over a tree: only shortlisted rows are read as vectors and scored."""
    asked, short = shortlist(queries, spark, path, k, metric, qid, qvec)
    vectors = spark.read.parquet(f"{path}/vectors").select(F.col("did").alias("d"), F.col("v").alias("dv"))
    pairs = (short.join(vectors, F.col("did") == F.col("d"))
             .join(asked.select(F.col("qid").alias("q"), F.col("v").alias("qv")), F.col("qid") == F.col("q"))
             .select("qid", "did", "qv", "dv"))

    def score(batches):
        for b in batches:
            if b.empty:
                continue
            q, x = _as_matrix(b["qv"]), _as_matrix(b["dv"])
            s = np.einsum("ij,ij->i", q, x)
            if metric == "cosine":
                den = np.sqrt((q * q).sum(1) * (x * x).sum(1))
                s = np.where(den > 0, s / np.where(den > 0, den, 1.0), 0.0)
            yield pd.DataFrame({"qid": b["qid"], "did": b["did"], "score": round6(s, decimals)})

    out = final_topk(pairs.mapInPandas(score, "qid long, did long, score double"), k)
    return out.select(F.col("qid").alias(qid), F.col("did").alias(did), "score", F.col("rank").cast("int"))
