"""Corpus pipeline: documents -> good -> one of each near-duplicate group -> decontaminated -> mixed -> token files.

Every stage takes (spark, docs, sf_dir) and works on all that its predecessor kept;
stages are written as Parquet to the shared folder and read again, so a lost executor
costs no earlier stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veriscope.llm import catalog, decontam, jaccard, mixing, quality, tokens
from veriscope.llm.common import row_key, write_table
from veriscope.session import ship_package


#: The digest of (doc_id, text): ids may be missing or repeated.
KEY = ["k1", "k2"]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.withColumns(dict(zip(KEY, row_key(docs))))


def _without(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose (doc_id, text) is not among the listed digests."""
    return _keyed(docs).join(keys, KEY, "left_anti").select(*docs.columns)


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier takes for good (score of 0.3 or more)."""
    ship_package(spark)
    return quality.keep_good(docs, quality.fit_quality(docs, _table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least doc_id of each group of linked documents, a null doc_id last, and one
    row of it where rows repeat.  Documents without words stay."""
    ship_package(spark)
    found = write_table(jaccard.join_documents(docs, numbered=True).where("class_no is not null")
                        .groupBy("class_no", *KEY).agg(F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("n")), "found")
    best = found.groupBy("class_no").agg(F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", *KEY)).alias("b"),
                                         F.count(F.lit(1)).alias("members")).where("members > 1")
    gone = write_table(found.join(best, "class_no").where((F.col("k1") != F.col("b.k1")) | (F.col("k2") != F.col("b.k2")))
                       .select(*KEY), "gone")
    twice = write_table(found.where("n > 1").select(*KEY).join(gone, KEY, "left_anti"), "twice")
    rest = _without(docs, gone.unionByName(twice))
    return rest.unionByName(_keyed(docs).join(twice, KEY, "left_semi").dropDuplicates(KEY).select(*docs.columns))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item."""
    found = decontam.decontaminate(docs, _table(spark, sf_dir, "benchmark"))
    return _without(docs, write_table(found.where("n_hit > 0").select(*KEY).distinct(), "gone"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated as their source's target asks; those taken no times go."""
    return mixing.repeated(docs, write_table(mixing.mix(docs).select(*KEY, "source", "repeats"), "mixed"))


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files written and read back: (doc_id, start, n_tokens, ids_crc32)."""
    ship_package(spark)
    path = tokens.write_tokens(docs, catalog.tokenizer_path())
    return tokens.read_tokens(spark, path).select("doc_id", "start", "n_tokens", "ids_crc32")


STAGES = [("quality_classifier", quality_filter), ("ngram_jaccard_join", near_duplicates),
          ("benchmark_decontamination", decontamination), ("mixing_sources", mix_sources),
          ("token_output", token_output)]

#: The classifier, the MinHash join and the tokenizer are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = write_table(docs, name)
    return docs
