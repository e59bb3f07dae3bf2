"""Line dedup: drop lines that many documents share, keep them in one document."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veriscope.llm.common import BLANKS, ascii_lower, digest, documents, write_table


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept): one row per input row.

    Lines are exploded with their positions, their keys (stripped, A-Z lowered, at
    least ``min_chars`` code points) hashed to 128 bits, and distinct documents
    counted per hash.  Keys found in ``min_docs`` documents or more lose all their
    lines but those of the largest ``doc_id`` holding them; what stays is put
    together by position.  Only hashes and positions are shuffled before the last
    join, and a hot line collapses map-side in the count; its occurrences meet the
    (tiny) drop list through a broadcast or a skew-splittable join.

    A null or empty text is one empty line.  A null ``doc_id`` is no document for
    the count and never the holder, so its copies of a dropped line go.  Rows that
    repeat a ``doc_id`` count once.
    """
    base = documents(docs, id_col, text_col)
    k1, k2 = digest(F.col("doc_id"), F.col("text"))
    exploded = base.select("doc_id", k1, k2, F.posexplode_outer(F.split("text", "\n")).alias("pos", "line"))
    line = F.trim(F.col("line"), F.lit(BLANKS))
    key = ascii_lower(line)
    long_lines = exploded.where(F.char_length(line) >= min_chars).select(
        "doc_id", "k1", "k2", "pos", F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(1), key).alias("h2"))
    seen = long_lines.groupBy("h1", "h2").agg(
        F.count_distinct("doc_id").alias("n_docs"), F.max("doc_id").alias("holder"))
    over = write_table(seen.where(F.col("n_docs") >= min_docs).select("h1", "h2", "holder"), "lines")
    dropped = (long_lines.join(over, ["h1", "h2"])
               .where(~F.col("doc_id").eqNullSafe(F.col("holder")))
               .groupBy("k1", "k2").agg(F.collect_set("pos").alias("gone")))
    rows = (base.select("doc_id", "text", *digest(F.col("doc_id"), F.col("text"))).join(dropped, ["k1", "k2"], "left")
            .withColumn("lines", F.split("text", "\n")))
    stays = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("gone"))
    kept = F.when(F.col("gone").isNull(), F.col("text")).otherwise(
        F.array_join(F.transform(stays, lambda i: F.get("lines", i)), "\n"))
    return rows.select("doc_id", F.size("lines").cast("long").alias("n_lines"),
                       F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped"), kept.alias("kept"))
