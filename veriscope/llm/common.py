"""Helpers shared by the training-data operators.

Operators take a DataFrame plus column names and read only those columns, so
extra input columns (whatever their names) never reach their plans.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veriscope.session import scratch_path

#: White space that line keys and word counts treat as such (fixed value).
BLANKS = " \t\n\x0b\x0c\r"
#: A word of the decontamination and shingle rules: digits, a-z, anything beyond ASCII (fixed value).
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only; other letters keep their case.  ``lower`` is the fast way for ASCII texts."""
    return F.when(F.octet_length(c) == F.char_length(c), F.lower(c)).otherwise(
        F.translate(c, string.ascii_uppercase, string.ascii_lowercase))


def words(text: Column) -> Column:
    """Array of the lower-cased words of a text (null: no words)."""
    return F.regexp_extract_all(ascii_lower(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))


def digest(*cols: Column) -> tuple[Column, Column]:
    """128 bits as two longs: two 64-bit hashes that start from different values."""
    return F.xxhash64(*cols).alias("k1"), F.xxhash64(F.lit(1), *reversed(cols)).alias("k2")


def row_key(docs: DataFrame) -> tuple[Column, Column]:
    """The digest of a document's (doc_id, text), as the operators return it."""
    return digest(F.col("doc_id").cast("long"), F.coalesce(F.col("text"), F.lit("")))


def documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text): null texts become empty."""
    return docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def write_table(df: DataFrame, name: str) -> DataFrame:
    """Write to the cluster's shared folder and open the written files.

    Cuts lineage in a way that outlives executors, and gives later joins the true
    size, so that Spark itself decides whether a side is small enough to broadcast."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
