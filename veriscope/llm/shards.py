"""Sharding by histogram sort: exact byte counts below probes fix the splitters, one exchange deals the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veriscope.llm.common import write_table
from veriscope.session import scratch_path

LOW = -(2 ** 63)
#: Bits by which keys are shifted right, round by round: each round probes 1,024 boundaries inside a cell.
SHIFTS = (54, 44, 34, 24, 14, 4, 0)


def splitters(keys: DataFrame, n_shards: int, tolerance: float = 0.01) -> list[tuple[int, int]]:
    """The n_shards - 1 boundaries (p, s); a row lies below one if its (p, s) is smaller.

    ``keys`` has (p, s, size).  Each round counts the exact bytes in the cells between
    probes, across all partitions, and keeps for every splitter the one cell that
    holds its target; a boundary within ``tolerance`` of a shard's mean bytes is
    taken, or the nearer side of a cell of one row.  The first key ``p`` is exhausted before the second, so equal first keys
    are only parted where one group alone exceeds the tolerance.  A round brings at
    most 1,024 rows for each open splitter to the driver.
    """
    total = keys.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    slack = tolerance * total / n_shards
    done: dict[int, tuple[int, int]] = {}
    open_cells: dict[tuple[int | None, int | None], tuple[int, list[int]]] = {(None, None): (0, list(range(1, n_shards)))}
    for column, shift, last in [("p", x, False) for x in SHIFTS] + [("s", x, x == 0) for x in SHIFTS]:
        cell = F.shiftright(F.col(column), shift)
        parent = _parent(column, shift)
        counts = keys
        if (None, None) not in open_cells:
            counts = keys.where(_inside(open_cells, column, shift))
        group = ([F.col("p").alias("_p")] if column == "s" else []) + [cell.alias("_cell")]
        got = sorted(((r["_p"] if column == "s" else None, r["_cell"]), r["n"], r["rows"] == 1)
                     for r in counts.groupBy(*group).agg(F.sum("size").alias("n"), F.count(F.lit(1)).alias("rows")).collect())
        by_parent: dict[tuple, list] = {}
        for (p, c), n, single in got:
            by_parent.setdefault((p, parent(c)) if (None, None) not in open_cells else (None, None), []).append(
                (p, c, n, single))
        after: dict[tuple, tuple[int, list[int]]] = {}
        for where, (below, targets) in open_cells.items():
            cum, waiting, cells = below, list(targets), by_parent.get(where, [])
            for i, (p, c, n, single) in enumerate(cells):
                while waiting and (cum + n >= total * waiting[0] / n_shards or i == len(cells) - 1):
                    t = waiting.pop(0)
                    to_low, to_high = abs(total * t / n_shards - cum), abs(cum + n - total * t / n_shards)
                    if last or single or min(to_low, to_high) <= slack:
                        done[t] = _bound(column, p, c if to_low <= to_high else c + 1, shift)
                    else:
                        after.setdefault((p, c), (cum, []))[1].append(t)
                cum += n
        # The last round of the first key leaves single values; the second key then starts afresh inside them.
        open_cells = {((c, None) if column == "p" and shift == 0 else (p, c)): v for (p, c), v in after.items()}
        if not open_cells:
            break
    return [done.get(t, (2 ** 63 - 1, 2 ** 63 - 1)) for t in range(1, n_shards)]


def _parent(column: str, shift: int):
    """From a cell of this round to its cell of the round before (None in the key's first round)."""
    i = SHIFTS.index(shift)
    return (lambda c: None) if i == 0 else (lambda c: c >> (SHIFTS[i - 1] - shift))


def _inside(open_cells: dict, column: str, shift: int) -> Column:
    i = SHIFTS.index(shift)
    if column == "p":
        return F.shiftright("p", SHIFTS[i - 1]).isin([c for _, c in open_cells])
    if i == 0:
        return F.col("p").isin([p for p, _ in open_cells])
    ps = F.col("p").isin(sorted({p for p, _ in open_cells}))
    return ps & F.struct("p", F.shiftright("s", SHIFTS[i - 1])).isin(
        [F.struct(F.lit(p).cast("long"), F.lit(c).cast("long")) for p, c in open_cells])


def _bound(column: str, p: int | None, cell: int, shift: int) -> tuple[int, int]:
    """The smallest (p, s) of a cell."""
    at = min(cell << shift, 2 ** 63 - 1)
    return (at, LOW) if column == "p" else (p, at)


def shard_documents(docs: DataFrame, n_shards: int = 24, id_col: str = "doc_id", text_col: str = "text",
                    tolerance: float = 0.01, cell_rows: int = 2048, seed: int = 0) -> DataFrame:
    """(doc_id, text, size, shard, slot), written as one folder per shard and opened again.

    Shards have near equal bytes (text in UTF-8 plus 8 a row): within ``tolerance`` of
    the mean at each end, or half of one row where rows are larger.  The sort key is
    (hash of the text, hash of doc_id and text), so equal texts lie together unless
    their group alone is too large.  Slots count each shard's rows from 0 without
    gaps: rows are ranked inside (shard, cell), where cells are slices of the second
    hash holding about ``cell_rows`` rows, and a cell's offset is the count of the
    cells before it.  No shard passes through one task, and hot groups fill many
    cells.  Rows are exchanged once, by (shard, cell).

    A null text has no bytes and stays null; repeated rows are all dealt.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"),
        (F.octet_length(text).cast("long") + 8).alias("size"), F.xxhash64(text).alias("p"),
        F.xxhash64(F.lit(seed), F.col(id_col), text).alias("s"))
    keys = write_table(rows.select("p", "s", "size"), "keys")
    cuts = splitters(keys, n_shards, tolerance)
    n_cells = max(1, -(-keys.count() // (n_shards * cell_rows)))
    bounds = F.array(*[F.struct(F.lit(p).cast("long").alias("p"), F.lit(s).cast("long").alias("s")) for p, s in cuts]) \
        if cuts else F.array().cast("array<struct<p:bigint,s:bigint>>")
    shard = F.size(F.filter(bounds, lambda b: b <= F.struct("p", "s"))).alias("shard")
    cell = F.pmod("s", F.lit(n_cells)).alias("cell")
    before = Window.partitionBy("shard").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (keys.select(shard, cell).groupBy("shard", "cell").agg(F.count(F.lit(1)).alias("n"))
               .select("shard", "cell", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset")))
    offsets = write_table(offsets, "offsets")
    place = F.row_number().over(Window.partitionBy("shard", "cell").orderBy("p", "s")) - 1
    dealt = (rows.select("doc_id", "text", "size", "p", "s", shard, cell)
             .withColumn("place", place).join(offsets, ["shard", "cell"])
             .select("doc_id", "text", "size", "shard", (F.col("offset") + F.col("place")).alias("slot")))
    path = scratch_path(spark, "shards")
    dealt.write.partitionBy("shard").option("compression", "zstd").parquet(path)
    return spark.read.schema(dealt.schema).parquet(path)
