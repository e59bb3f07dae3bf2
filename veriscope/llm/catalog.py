"""Registered queries of the training-data operators and their DuckDB oracles."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veriscope.llm import (alignment, decontam, embeddings, jaccard, lines, mixing, packing, phrases, quality, shards, suffix,
                           tokens, urls)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = lines.dedup_lines(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


#: (action, host, path), as the task fixes them.
URL_RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
             ("allow", "com", "/fr/"), ("block", "com", "/de/")]


def op3_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "action string, host string, path string")
    return urls.filter_pages(_table(spark, sf_dir, "pages"), rules)


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontam.decontaminate(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                      (F.col("n_hit") > 0).alias("contaminated"))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = shards.shard_documents(_table(spark, sf_dir, "documents"), 24)
    return out.select("doc_id", "size", F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
                      F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard"),
                      F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.mix(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "source_size", "target",
                      (F.col("size") * F.col("repeats")).cast("long").alias("taken"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return quality.score_quality(docs, quality.fit_quality(docs, _table(spark, sf_dir, "labels")))


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join_documents(_table(spark, sf_dir, "documents"))


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix.dedup_spans(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op8_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = embeddings.link_embeddings(_table(spark, sf_dir, "embeddings"))
    return out.withColumnRenamed("id", "vec_id")


def tokenizer_path() -> str:
    """The tokenizers file: $VERISCOPE_TOKENIZER, else the installed public one (present on every node)."""
    import public_tokenizers
    return os.environ.get("VERISCOPE_TOKENIZER") or public_tokenizers.path("word_bpe_49k.json")


def op9_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = tokens.write_tokens(_table(spark, sf_dir, "documents"), tokenizer_path())
    return tokens.read_tokens(spark, path).select("doc_id", "start", "n_tokens", "ids_crc32")


def public_file(name: str) -> str:
    """A vocabulary file: in the folder $VERISCOPE_TOKENIZERS, else the installed public one (present on every node)."""
    import public_tokenizers
    folder = os.environ.get("VERISCOPE_TOKENIZERS")
    return os.path.join(folder, name) if folder else public_tokenizers.path(name)


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align_tokens(_table(spark, sf_dir, "documents"), public_file("byte_bpe_50k.json"),
                                  public_file("piece_bpe_32k.model"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.top_phrases(_table(spark, sf_dir, "documents"))


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = packing.write_sequences(_table(spark, sf_dir, "documents"), public_file("byte_bpe_50k.json"))
    return packing.sequences(spark, path).withColumn("ids_crc32", F.crc32("ids")).drop("ids")


QUERIES = {
    "op1_line_dedup": op1_line_dedup,
    "op2_quality": op2_quality,
    "op3_url_filters": op3_url_filters,
    "op4_decontamination": op4_decontamination,
    "op5_sharding": op5_sharding,
    "op6_jaccard_join": op6_jaccard_join,
    "op7_suffix_dedup": op7_suffix_dedup,
    "op8_embedding_dedup": op8_embedding_dedup,
    "op9_tokens": op9_tokens,
    "op10_mixing": op10_mixing,
    "op11_token_alignment": op11_token_alignment,
    "op12_collocations": op12_collocations,
    "op13_packing": op13_packing,
}
