"""Connected components over an edge table, and inside one task."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veriscope.llm.common import write_table


def local_roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For nodes 0..n-1 joined by pairs (i, j): the least node that each reaches."""
    root = np.arange(n)
    while len(i):
        low = np.minimum(root[i], root[j])
        before = root.copy()
        np.minimum.at(root, i, low)
        np.minimum.at(root, j, low)
        np.minimum.at(root, before[i], low)
        np.minimum.at(root, before[j], low)
        root = root[root]
        if (root == before).all():
            break
    return root


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component): the least id reachable from each id that has an edge.

    Alternating large-star and small-star rounds: a node's least neighbour is a
    partial aggregate, and hanging the neighbours below it is a join on the node with
    a written table, so a node of very many edges is split.  Each round's edges are
    written to the shared folder; the number of rounds is logarithmic.
    """
    now = write_table(edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b").distinct(), "edges")
    seen = None
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        now = _hang(both, F.col("b") > F.col("a"))                               # large star
        down = now.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        now = _hang(down.unionByName(down.select("a", F.col("a").alias("b"))), F.lit(True))   # small star
        mark = tuple(now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.pmod(F.xxhash64("b", "a"), F.lit(1 << 30)))).first())
        if mark == seen:
            break
        seen = mark
    roots = now.select(F.greatest("a", "b").alias("id"), F.least("a", "b").alias("component"))
    return roots.unionByName(roots.select(F.col("component").alias("id"), "component")).distinct()


def least_names(joined: DataFrame, names: DataFrame) -> DataFrame:
    """(rep, component): the least name in each node's component, from (id, component) and (rep, least)."""
    each = write_table(joined.join(names, joined["id"] == names["rep"]).select("rep", "component", "least"), "members")
    least = each.groupBy("component").agg(F.min("least").alias("name"))
    return each.join(least, "component").select("rep", F.col("name").alias("component"))


def _hang(pairs: DataFrame, which) -> DataFrame:
    """Edges from each node's chosen neighbours to the least of them and itself."""
    least = write_table(pairs.groupBy("a").agg(F.min("b").alias("m"))
                        .select("a", F.least("a", "m").alias("m")), "least")
    return write_table(pairs.where(which).join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                       .where("a <> b").distinct(), "edges")
