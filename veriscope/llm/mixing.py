"""Mixing sources to target weights: capped water-filling, then seeded repetitions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veriscope.llm.common import digest, row_key, write_table

#: A word of a size: a run of anything but ASCII white space (fixed value).
SIZE_WORD = r"[^\x20\x09-\x0D]+"
#: A document's place in its source's random order: 52 bits of an MD5.
PLACE_BITS, CELL_BITS = 52, 12


def fill_targets(sources: DataFrame, max_epochs: float = 3.0) -> DataFrame:
    """Adds ``target`` to (source, weight, source_size, ...).

    The sum of all sizes is shared by weight; a source whose share exceeds
    ``max_epochs`` times its size is clamped there and the excess is shared again
    among the others, until none is above.  A round is one aggregate over the
    sources: the state is the level (target per weight) alone, which only rises.
    """
    cap = F.col("source_size") * F.lit(max_epochs)
    total = sources.agg(F.coalesce(F.sum("source_size"), F.lit(0)).cast("double")).first()[0]
    level, clamped = None, None
    while True:
        full = F.lit(False) if level is None else cap <= F.lit(level) * F.col("weight")
        n, used, weight = sources.agg(
            F.count_if(full), F.coalesce(F.sum(F.when(full, cap)), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~full, F.col("weight").cast("double"))), F.lit(0.0))).first()
        if n == clamped or not weight:
            break
        level, clamped = (total - used) / weight, n
    share = cap if level is None else F.least(cap, F.lit(level) * F.col("weight"))
    return sources.withColumn("target", share.cast("double"))


def mix(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), max_epochs: float = 3.0, seed: int = 7,
        id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(doc_id, source, k1, k2, size, source_size, target, repeats): one row per input row; k1, k2 are the
    digest of (doc_id, text).

    Sources ordered by code point (null last) get ``weights`` in turn.  Each document
    is repeated as often as its source's target holds the whole source, and once more
    if it lies in the fraction that is left: documents stand in a seeded random order
    (by MD5 of seed and doc_id, or of the text where that is null), and one is taken again if the middle of its words
    lies within the fraction.  So a source's words are off by half a document at
    most, no document exceeds ``max_epochs`` repetitions, and a rerun takes the same.

    The order is cut into 4,096 cells a source: running sums are taken inside a cell
    and over the cells' totals, so that no source passes through one task.  A null
    text has size 0; a null source is a source; repeated rows are mixed one by one.
    """
    size = F.coalesce(F.regexp_count(F.col(text_col), F.lit(SIZE_WORD)), F.lit(0)).cast("long")
    place = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(F.col(id_col).cast("string"),
                                                                                   F.md5(F.coalesce(F.col(text_col), F.lit("")))))),
                               1, PLACE_BITS // 4), 16, 10).cast("long")
    key = digest(F.col(id_col).cast("long"), F.coalesce(F.col(text_col), F.lit("")))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), *key, size.alias("size"),
                       place.alias("place"))
    rows = write_table(rows.withColumn("cell", F.shiftright("place", PLACE_BITS - CELL_BITS)), "sizes")
    cells = write_table(rows.groupBy("source", "cell").agg(F.sum("size").alias("n")), "cells")
    turn = F.pmod(F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1, F.lit(len(weights)))
    sources = write_table(                                   # one row a source, after aggregation
        cells.groupBy("source").agg(F.sum("n").alias("source_size"))
        .withColumn("weight", F.get(F.array(*[F.lit(float(w)) for w in weights]), turn)), "sources")
    filled = fill_targets(sources, max_epochs)
    epochs = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    filled = filled.withColumn("whole", F.floor(epochs + F.lit(1e-9))).withColumn(
        "extra", F.greatest((epochs - F.col("whole")) * F.col("source_size"), F.lit(0.0)))
    earlier = Window.partitionBy("_source").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    plan = (cells.withColumnRenamed("source", "_source")
            .withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
            .join(filled.drop("weight"), F.col("_source").eqNullSafe(F.col("source"))).drop("source", "n"))
    plan = write_table(plan.withColumnRenamed("cell", "_cell"), "plan")
    inside = Window.partitionBy("source", "cell").orderBy("place", "doc_id", "size").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    ranked = rows.withColumn("upto", F.sum("size").over(inside))
    joined = ranked.join(plan, F.col("source").eqNullSafe(F.col("_source")) & (F.col("cell") == F.col("_cell")))
    again = (F.col("before") + F.col("upto") - F.col("size") / 2 <= F.col("extra")) & (F.col("extra") > 0)
    return joined.select("doc_id", "source", "k1", "k2", "size", "source_size", "target",
                         (F.col("whole") + again.cast("long")).alias("repeats"))


def repeated(docs: DataFrame, mixed: DataFrame) -> DataFrame:
    """The rows of ``docs`` as often as ``mixed`` repeats them.

    Rows meet by the digest of (doc_id, text) and the source.  Rows that are equal in
    all of that are one row here, taken as often as all of them together."""
    key = ["k1", "k2", "source"]
    times = mixed.where(F.col("repeats") > 0).groupBy(*key).agg(F.sum("repeats").alias("times"))
    twice = write_table(mixed.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(*key), "twice")
    k1, k2 = row_key(docs)
    rows = docs.select(F.struct(*docs.columns).alias("row"), k1, k2, "source")
    same = (F.col("k1") == F.col("t1")) & (F.col("k2") == F.col("t2")) & F.col("source").eqNullSafe(F.col("t3"))
    t = twice.select(F.col("k1").alias("t1"), F.col("k2").alias("t2"), F.col("source").alias("t3"))
    once = rows.join(t, same, "left_anti")
    repeats = rows.join(t, same, "left_semi").groupBy(*key).agg(F.first("row").alias("row")).select("row", *key)
    each = once.unionByName(repeats)
    p = times.select(F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("source").alias("p3"), "times")
    found = each.join(p, (F.col("k1") == F.col("p1")) & (F.col("k2") == F.col("p2")) & F.col("source").eqNullSafe(F.col("p3")))
    return found.select("row", F.explode(F.sequence(F.lit(1), F.col("times").cast("int")))).select("row.*")
