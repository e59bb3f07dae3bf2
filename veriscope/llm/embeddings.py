"""Embedding near-dedup by collision counting over one-dimensional projections."""

from __future__ import annotations

from collections.abc import Iterator
from math import comb, erf, sqrt

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veriscope.llm.common import write_table
from veriscope.llm.components import components, least_names, local_roots


def calibrate(threshold: float, n_projections: int, width: float, miss: float) -> tuple[float, int]:
    """(half window, least count): a pair at the threshold is missed with probability ``miss`` at most.

    Unit vectors of cosine c lie 2 - 2c apart squared, so their projections on a
    normal direction differ by a normal of that variance; closer pairs collide more."""
    spread = sqrt(max(2 - 2 * threshold, 1e-12))
    p = erf(width / sqrt(2))
    below, least = 0.0, 0
    while least <= n_projections:
        below += comb(n_projections, least) * p ** least * (1 - p) ** (n_projections - least)
        if below > miss:
            break
        least += 1
    return width * spread, least


def link_embeddings(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", group_col: str = "label",
                    threshold: float = 0.98, n_projections: int = 24, width: float = 1.5, miss: float = 1e-7,
                    guard: float = 5.5, block_rows: int = 1024, seed: int = 11) -> DataFrame:
    """(id, n_links, component_id, kept): one row per input row.

    Only vectors with equal groups (null: none) and equal lengths meet.  Equal vectors
    are one class with a count.  Vectors are normalised and projected on normal
    directions.  The first projection cuts each group into strips as wide as a window
    that holds practically every linked pair (``guard`` standard deviations), so that
    only neighbouring strips meet; strips are salted into blocks of about
    ``block_rows``.  For each pair of blocks a task sorts the other projections, counts
    the query-centred windows in which each pair meets, and computes the cosine, in
    double precision, of pairs that reach the calibrated count.  A task returns link
    counts and local roots, never pairs, so a group of near copies adds no pair rows.

    Vectors that are null, empty, zero or hold null or non-finite components, and
    vectors without a group, link with nothing.  Repeated rows count as vectors.  Rows
    with a null id link like others but name no component: one of null ids alone has
    the name null, and its rows are kept.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"),
                          F.col(group_col).alias("g"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    fit = rows.where(F.col("g").isNotNull() & F.col("v").isNotNull() & ~bad & F.exists("v", lambda x: x != 0))
    keyed = fit.select("id", "g", "v", F.xxhash64("g", "v").alias("k1"), F.xxhash64(F.lit(1), "v", "g").alias("k2"))
    reps = keyed.groupBy("k1", "k2").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("copies"))
    # A class goes by a number of its own: an id repeated with different vectors names several classes.
    reps = write_table(reps.withColumn("rep", F.monotonically_increasing_id()), "reps")
    half, least = calibrate(threshold, n_projections, width, miss)
    strip_width = guard * sqrt(max(2 - 2 * threshold, 1e-12))

    def project(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            v = [np.asarray(x, float) for x in b["v"]]
            x0 = [float(x @ _directions(len(x), 1, seed)[0] / _norm(x)) for x in v]
            yield pd.DataFrame({"rep": b["rep"], "copies": b["copies"], "part": b["part"], "v": b["v"],
                                "strip": np.floor(np.array(x0) / strip_width).astype("i8")})

    first = (keyed.join(reps, ["k1", "k2"]).where("id <=> least").dropDuplicates(["rep"])
             .select("rep", "copies", F.concat_ws("|", F.col("g").cast("string"), F.size("v").cast("string")).alias("part"), "v"))
    placed = write_table(first.mapInPandas(project, "rep long, copies long, part string, v array<double>, strip long"),
                         "strips")
    sizes = write_table(placed.groupBy("part", "strip").agg(
        F.ceil(F.count(F.lit(1)) / block_rows).cast("int").alias("blocks")), "sizes")
    # A block meets the blocks of its own strip from itself on, and those of the next strip.
    met = placed.join(sizes, ["part", "strip"]).withColumn("block", F.pmod(F.xxhash64("rep"), "blocks").cast("int"))
    after = sizes.select("part", (F.col("strip") - 1).alias("strip"), F.col("blocks").alias("n_after"))
    before = sizes.select("part", (F.col("strip") + 1).alias("strip"), F.col("blocks").alias("n_before"))
    met = met.join(after, ["part", "strip"], "left").join(before, ["part", "strip"], "left")
    def pair(lo_strip, lo, hi_strip, hi, side):
        return F.struct(lo_strip.alias("s1"), lo.alias("b1"), hi_strip.alias("s2"), hi.alias("b2"), F.lit(side).alias("side"))
    s, k = F.col("strip"), F.col("block")
    every = F.concat(
        F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda o: F.when(k <= o, pair(s, k, s, o, 0)).otherwise(pair(s, o, s, k, 1))),
        F.when(F.col("n_after") > 0, F.transform(F.sequence(F.lit(0), F.col("n_after") - 1), lambda o: pair(s, k, s + 1, o, 0)))
        .otherwise(F.array()),
        F.when(F.col("n_before") > 0, F.transform(F.sequence(F.lit(0), F.col("n_before") - 1), lambda o: pair(s - 1, o, s, k, 1)))
        .otherwise(F.array()))
    dealt = met.select("part", "rep", "copies", "v", F.explode(every).alias("p")).select("part", "rep", "copies", "v", "p.*")

    def meet(pdf: pd.DataFrame) -> pd.DataFrame:
        one_block = bool(pdf["s1"].iat[0] == pdf["s2"].iat[0] and pdf["b1"].iat[0] == pdf["b2"].iat[0])
        pdf = pdf.sort_values("rep", kind="stable").reset_index(drop=True)
        x = np.array(pdf["v"].tolist(), float)
        unit = x / np.linalg.norm(x, axis=1, keepdims=True)
        side = pdf["side"].to_numpy()
        left = np.arange(len(x)) if one_block else np.flatnonzero(side == 0)
        right = left if one_block else np.flatnonzero(side == 1)
        i, j = _candidates(unit[left] @ _directions(x.shape[1], n_projections + 1, seed)[1:].T,
                           unit[right] @ _directions(x.shape[1], n_projections + 1, seed)[1:].T, half, least)
        i, j = left[i], right[j]
        if one_block:
            i, j = i[i < j], j[i < j]
        cosine = np.einsum("ij,ij->i", x[i], x[j]) / (np.sqrt(np.einsum("ij,ij->i", x[i], x[i])) * np.sqrt(np.einsum("ij,ij->i", x[j], x[j])))
        i, j = i[cosine >= threshold], j[cosine >= threshold]
        links, copies = np.zeros(len(x), "i8"), pdf["copies"].to_numpy()
        np.add.at(links, i, copies[j])
        np.add.at(links, j, copies[i])
        some = links > 0
        rep = pdf["rep"].to_numpy()
        return pd.DataFrame({"rep": rep[some], "links": links[some], "root": rep[local_roots(len(x), i, j)][some]})

    found = write_table(dealt.groupBy("part", "s1", "b1", "s2", "b2").applyInPandas(
        meet, "rep long, links long, root long"), "links")
    counted = found.groupBy("rep").agg(F.sum("links").alias("links"))
    joined = least_names(components(found, "rep", "root"), reps.select("rep", "least"))
    classes = write_table(reps.join(counted, "rep", "left").join(joined, "rep", "left").select(
        "k1", "k2", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("component", "least").alias("component_id")), "classes")
    linked = keyed.select("id", "k1", "k2").join(classes, ["k1", "k2"]).select("id", "n_links", "component_id")
    alone = rows.where(F.col("g").isNull() | F.col("v").isNull() | F.coalesce(bad, F.lit(False))
                       | ~F.coalesce(F.exists("v", lambda x: x != 0), F.lit(False))).select(
        "id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return linked.unionByName(alone).select("id", "n_links", "component_id",
                                            F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


def _norm(x: np.ndarray) -> float:
    return float(np.sqrt(x @ x))


def _directions(dim: int, n: int, seed: int) -> np.ndarray:
    return np.random.default_rng([seed, dim]).standard_normal((n, dim))


def _candidates(a: np.ndarray, b: np.ndarray, half: float, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i, j) that meet in at least ``least`` of the query-centred windows."""
    counts = np.zeros((len(a), len(b)), "i1")
    for x, y in zip(a.T, b.T):
        order = np.argsort(y, kind="stable")
        lo, hi = np.searchsorted(y[order], x - half), np.searchsorted(y[order], x + half, "right")
        at = np.arange(len(y))
        counts[:, order] += ((at >= lo[:, None]) & (at < hi[:, None])).astype("i1")
    return np.nonzero(counts >= least)
