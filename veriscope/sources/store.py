"""The evidence store: documents + embeddings in Parquet.

Rows: ``doc_key`` (sha256 of content), ``doc_id`` (long; given or derived from the
key), ``content``, ``meta`` struct and ``embedding`` (array<float>); an IVF store
adds ``cell`` and is partitioned by it so probes prune whole directories.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from veriscope.constants import HASH_DIM, TOP_K
from veriscope.functions.text import doc_key, embed_input
from veriscope.functions.vectors import hash_embedding
from veriscope.operators import knn
from veriscope.sources.keys import BucketFilters, bucket_of, stored_keys
from veriscope.sources.scan import written


def dedupe_documents(docs: DataFrame, key: str = "doc_key", id_col: str = "doc_id") -> DataFrame:
    """One row per content key: the row with the smallest id.  ``min`` over a struct
    is a partial aggregate, so a key with huge numbers of copies is collapsed on the
    map side before the shuffle."""
    others = [c for c in docs.columns if c not in (key, id_col)]
    best = F.min(F.struct(F.col(id_col), *[F.col(c) for c in others])).alias("_b")
    return docs.groupBy(key).agg(best).select(key, "_b.*")


def insert_if_absent(new_docs: DataFrame, existing: DataFrame | None, key: str = "doc_key") -> DataFrame:
    """Rows whose key is not stored yet.

    The batch's keys are semi-joined against the store's key column, and the batch is
    anti-joined against those found.  Spark broadcasts either side only where its
    measured size is under ``autoBroadcastJoinThreshold``, and shuffles otherwise."""
    if existing is None:
        return new_docs
    present = existing.select(key).join(new_docs.select(key).distinct(), key, "left_semi").distinct()
    return new_docs.join(present, key, "left_anti")


def embed_missing(df: DataFrame, embed: Callable[[Column], Column], text: Column,
                  vec: str = "embedding") -> DataFrame:
    """Compute embeddings only where missing (existing ones are kept).

    Two branches, because a Python embedder inside ``when`` would run on every row."""
    missing = df.filter(F.col(vec).isNull()).withColumn(
        vec, embed(text).cast(df.schema[vec].dataType.simpleString()))
    return df.filter(F.col(vec).isNotNull()).unionByName(missing)


class EvidenceStore:
    """``write_documents``, ``top_k`` (one phrase) and ``top_k_batch`` (many)."""

    def __init__(self, spark: SparkSession, path: str, dim: int = HASH_DIM, similarity: str = "cosine",
                 embed: Callable[[Column], Column] | None = None, recreate: bool = False,
                 buckets: int | None = None):
        """``buckets`` files rows by a hash of their key, with a Bloom filter for each
        bucket beside the store, so that a batch reads only the keys of buckets that may
        hold one of its own (256 and more at scale; a store keeps the number it began with)."""
        self.spark, self.path, self.dim, self.similarity = spark, path, dim, similarity
        self.embed = embed or (lambda c: hash_embedding(c, dim))
        self.filters = BucketFilters(spark, f"{path.rstrip('/')}-filters", buckets) if buckets else None
        if recreate:       # S8: drop and recreate
            if self.filters:
                self._empty().withColumn("bucket", F.lit(0)).write.mode("overwrite").partitionBy("bucket").parquet(path)
                self.filters.clear()
            else:
                self._empty().write.mode("overwrite").parquet(path)

    def _empty(self) -> DataFrame:
        schema = ("doc_key string, doc_id long, content string, "
                  "meta struct<title:string,publication_year:int,authors:string,doi:string,open_alex_id:string>, "
                  "embedding array<float>")
        return self.spark.createDataFrame([], schema)

    def exists(self) -> bool:
        try:
            self.spark.read.parquet(self.path).schema
            return True
        except AnalysisException:
            return False

    def read(self) -> DataFrame:
        """Open the store (empty when it does not exist yet)."""
        return self._open().drop("bucket") if self.exists() else self._empty()

    def _open(self) -> DataFrame:
        if not self.filters:
            return self.spark.read.parquet(self.path)
        return self.spark.read.schema(self._empty().withColumn("bucket", F.lit(0)).schema).parquet(self.path)

    def prepare(self, docs: DataFrame) -> DataFrame:
        """Add key and id; ``docs`` has ``content``, ``meta`` and optionally ``doc_id``."""
        out = docs.withColumn("doc_key", doc_key(F.col("content")))
        if "doc_id" not in docs.columns:
            out = out.withColumn("doc_id", F.xxhash64("doc_key"))
        if "embedding" not in docs.columns:
            out = out.withColumn("embedding", F.lit(None).cast("array<float>"))
        return out.select("doc_key", F.col("doc_id").cast("long"), "content", "meta", "embedding")

    def new_documents(self, docs: DataFrame) -> DataFrame:
        """S7 without the write: dedupe, skip stored keys, embed the missing vectors.

        The keyed batch is written once, so its input runs once however often it is read."""
        keyed = written(dedupe_documents(self.prepare(docs)), "batch")
        if self.filters:
            fresh = keyed.join(self.present(keyed), "doc_key", "left_anti") if self.exists() else keyed
        else:
            existing = self.read() if self.exists() else None
            if existing is not None and existing.isEmpty():
                existing = None
            fresh = insert_if_absent(keyed, existing)
        return embed_missing(fresh, self.embed, embed_input(F.col("meta.title"), F.col("content")))

    def write_documents(self, docs: DataFrame) -> None:
        """Insert documents not present yet (duplicates skipped), embedded.

        A bucketed store writes its filters first: rows whose filter is missing would be
        inserted again, filters whose rows are missing only cost reading."""
        fresh = self.new_documents(docs)
        if self.filters:
            fresh = written(fresh, "fresh")
            self.filters.add(fresh)
            (fresh.withColumn("bucket", bucket_of(F.col("doc_key"), self.filters.buckets)).hint("rebalance", "bucket")
             .write.mode("append").partitionBy("bucket").parquet(self.path))
        else:
            fresh.write.mode("append").parquet(self.path)

    def present(self, docs: DataFrame) -> DataFrame:
        """J5 on a bucketed store: keys of ``docs`` that are stored, read from buckets that may hold them only."""
        return stored_keys(self._open(), self.filters.maybe(docs))

    def embedding_count(self) -> int:
        """A4."""
        return self.read().agg(F.count("embedding")).first()[0]

    def embed_query(self, text: str) -> list[float]:
        row = self.spark.range(1).select(self.embed(F.lit(text)).alias("v")).first()
        return list(row["v"])

    def top_k(self, phrase: str, k: int = TOP_K, decimals: int | None = 6) -> DataFrame:
        """Best k documents for one phrase."""
        return knn.topk_single(self.read(), self.embed_query(phrase), k, self.similarity, decimals=decimals)

    def top_k_batch(self, queries: DataFrame, k: int = TOP_K, qid: str = "claim_id",
                    text: str = "claim", **kw) -> DataFrame:
        """J4 + T1: best k documents per query row; rows (qid, doc_id, score, rank, content, meta)."""
        q = queries.select(F.col(qid), self.embed(F.col(text)).alias("embedding"))
        store = self.read()
        hits = written(knn.knn_topk(written(q, "phrases"), store, k, self.similarity, qid=qid, did="doc_id", **kw), "hits")
        return store.select("doc_id", "content", "meta").join(hits, "doc_id")
