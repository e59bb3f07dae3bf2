"""Landed works: JSON pages, CSV, Parquet tables (S1, S3-S6, C1 pieces)."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veriscope.constants import KEEP_FIELDS
from veriscope.functions.text import authors_string, uninvert_abstract
from veriscope.operators.filters import drop_missing_abstract
from veriscope.schemas import RAW_WORK, WORK
from veriscope.sources.manifest import BatchTable
from veriscope.sources.scan import written


def read_works_pages(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    """Every ``*.json`` page under ``path`` with the declared RAW_WORK schema.

    ``multiline=True`` reads one JSON array per file (each element a row); a file
    that does not parse is dropped as a whole.  ``multiline=False`` reads JSON lines
    and drops malformed lines.  Other files (e.g. a cursor file) are ignored.
    """
    return (spark.read.schema(RAW_WORK)
            .option("multiLine", multiline)
            .option("mode", "DROPMALFORMED")
            .option("pathGlobFilter", "*.json")
            .option("recursiveFileLookup", "true")
            .json(path))


CORRUPT = "_corrupt"


def _checked(spark: SparkSession, path: str, multiline: bool) -> DataFrame:
    """RAW_WORK rows of every page with the text that did not parse and the file's name."""
    schema = T.StructType([*RAW_WORK.fields, T.StructField(CORRUPT, T.StringType(), True)])
    return (spark.read.schema(schema).option("multiLine", multiline).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT).option("pathGlobFilter", "*.json")
            .option("recursiveFileLookup", "true").json(path)
            .select("*", F.col("_metadata.file_name").alias("file_name")))


def read_checked_pages(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    """S1 with ``file_name``: works of the pages that parse; what does not is in ``rejected_pages``."""
    # Spark refuses scans of the corrupt-record column alone (a plain count): the condition names a second column.
    good = F.when(F.col("id").isNull() & F.col(CORRUPT).isNotNull(), False).otherwise(F.col(CORRUPT).isNull())
    return _checked(spark, path, multiline).where(good).drop(CORRUPT)


def rejected_pages(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    """(file_name, n_bad, n_chars): files with pages (``multiline``) or lines that do not parse, and their size.

    A page that is cut off is rejected as a whole and listed once; other files beside
    the pages (a cursor file) are neither read nor listed."""
    bad = _checked(spark, path, multiline).where(F.col(CORRUPT).isNotNull() & F.col("id").isNull())
    return bad.groupBy("file_name").agg(F.count(F.lit(1)).alias("n_bad"), F.sum(F.length(CORRUPT)).alias("n_chars"))


def land_pages(works: DataFrame, path: str, page: Column, damaged: Column | None = None) -> DataFrame:
    """Write one JSON array file ``results_<page>.json`` for each value of ``page`` (bounded by the page size),
    and where ``damaged`` holds, a cut-off copy ``results_<page>_cut.json``; returns (file_name, n_works).

    Files are written by tasks; a repeated attempt writes the same file again."""
    root = path if "://" in path or path.startswith("file:") else f"file://{path}"
    rows = works.select(page.alias("page"), (damaged if damaged is not None else F.lit(False)).alias("cut"),
                        F.to_json(F.struct(*works.columns), {"ignoreNullFields": "false"}).alias("work"))

    def land(group: pd.DataFrame) -> pd.DataFrame:
        from pyarrow import fs
        folder, at = fs.FileSystem.from_uri(root)
        folder.create_dir(at, recursive=True)
        text = "[" + ",\n".join(sorted(group["work"])) + "]"
        name = f"results_{group['page'].iloc[0]}"
        files = [(f"{name}.json", text, len(group))]
        if group["cut"].any():
            files.append((f"{name}_cut.json", text[:len(text) // 2], 0))
        for file, body, _ in files:
            with folder.open_output_stream(f"{at}/{file}") as f:
                f.write(body.encode())
        return pd.DataFrame({"file_name": [f[0] for f in files], "n_works": [f[2] for f in files]})

    return written(rows.groupBy("page").applyInPandas(land, "file_name string, n_works long"), "landed")


def land_works_csv(csv: DataFrame, table: BatchTable, parts: int, name: str = "works", key: str = "id") -> DataFrame:
    """S3 landed once: rows of a CSV (read in one task a file) as Parquet, clustered by ``part`` of their key.

    A part is as large as its share of the input, so the tasks that write it follow the bytes and not the parts."""
    table.append(name, lambda: csv.withColumn("part", F.pmod(F.xxhash64(key), F.lit(parts)).cast("int")).hint("rebalance", "part"))
    return table.read()


def flatten_works(raw: DataFrame, keep: list[str] = KEEP_FIELDS) -> DataFrame:
    """P4 + P5 + F1 + F2: works with an abstract, flat columns in WORK order."""
    kept = drop_missing_abstract(raw)
    return kept.select(*keep,
                       uninvert_abstract(F.col("abstract_inverted_index")).alias("abstract"),
                       authors_string(F.col("authorships")).alias("authors"))


def read_works_csv(spark: SparkSession, path: str, schema=WORK) -> DataFrame:
    """S3: header CSV with quoted text and embedded newlines/quotes (pandas style)."""
    return (spark.read.schema(schema)
            .option("header", True).option("multiLine", True)
            .option("quote", '"').option("escape", '"')
            .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
            .csv(path))


def write_works_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV counterpart of S3 (quotes doubled, whitespace kept)."""
    (df.write.mode(mode).option("header", True).option("quote", '"').option("escape", '"')
     .option("quoteAll", True)
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .csv(path))


def write_works(df: DataFrame, path: str, field: str | None = None, fmt: str = "parquet",
                mode: str = "overwrite") -> None:
    """One table per searched field (``path/field=<name>``)."""
    target = f"{path}/field={field}" if field else path
    if fmt == "csv":
        write_works_csv(df, target, mode)
    else:
        df.write.mode(mode).parquet(target)


def append_table(df: DataFrame, path: str) -> None:
    """Append processed rows to a result table."""
    df.write.mode("append").parquet(path)


def skip_done(df: DataFrame, done: DataFrame, key: str = "id") -> DataFrame:
    """Rows not handled yet (anti-join on the key instead of a row offset)."""
    return df.join(done.select(key).distinct(), key, "left_anti")


def corpus_profile(df: DataFrame) -> DataFrame:
    """A5: rows and columns of a built table."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_cols", F.lit(len(df.columns)))


def preview(df: DataFrame, order_by: list[str], n: int = 5) -> DataFrame:
    """T4: first rows in a stated order."""
    return df.orderBy(*order_by).limit(n)
