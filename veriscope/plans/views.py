"""Inputs of the registered queries, derived by Spark from the given tables.

The given tables stand in for the pipeline's data: ``documents`` for abstracts
(``source`` as title), ``conversations`` for author lists and articles,
``labels`` for the paper lookup, ``pages`` for article pages, ``benchmark`` for
claim sources, ``embeddings`` for a vector store.  Every rule here has a mirror in
``sql.py`` used by the DuckDB oracles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veriscope.constants import DOI_PREFIX, HASH_DIM, WORK_ID_PREFIX
from veriscope.functions.text import collapse_ws, doc_key
from veriscope.session import scratch_path
from veriscope.sources.scan import spread
from veriscope.sources.store import EvidenceStore, dedupe_documents


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet"))


def author_lists(conversations: DataFrame) -> DataFrame:
    """Roles of a conversation in turn order, as authorships (a 'system' turn is an
    author whose name is null).  One list per conversation (bounded by its turns)."""
    entry = F.struct(F.col("turn"), F.when(F.col("role") == "system", F.lit(None).cast("string"))
                     .otherwise(F.col("role")).alias("name"))
    grouped = conversations.groupBy("conv_id").agg(F.sort_array(F.collect_list(entry)).alias("_a"))
    return grouped.select(
        F.col("conv_id"),
        F.transform("_a", lambda a: F.struct(F.create_map(F.lit("display_name"), a["name"]).alias("author")))
        .alias("authorships"))


def work_columns(docs: DataFrame) -> list:
    return [
        F.concat(F.lit(WORK_ID_PREFIX + "W"), F.col("doc_id").cast("string")).alias("id"),
        F.when(F.col("lang") != "es", F.concat(F.lit(DOI_PREFIX + "10.5555/"), F.col("doc_id").cast("string")))
        .alias("doi"),
        F.col("source").alias("title"),
        (F.lit(2000) + F.pmod(F.col("doc_id"), F.lit(24))).cast("int").alias("publication_year"),
    ]


def works_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WORK rows (id, doi, title, publication_year, abstract, authors) plus doc_id."""
    from veriscope.functions.text import authors_string
    docs = load(spark, sf_dir, "documents")
    authors = author_lists(load(spark, sf_dir, "conversations")).select(
        F.col("conv_id").alias("doc_id"), authors_string(F.col("authorships")).alias("authors"))
    return (docs.join(authors, "doc_id", "left")
            .select("doc_id", *work_columns(docs), F.col("text").alias("abstract"),
                    F.coalesce(F.col("authors"), F.lit("")).alias("authors")))


def _starts(sorted_words: Column) -> Column:
    """Places in a list of (word, pos) in word order where another word begins, and its end."""
    n = F.size(sorted_words)
    first = F.filter(F.sequence(F.lit(0), n - 1), lambda i: (i == 0) | (sorted_words[i]["word"] != sorted_words[F.greatest(i - 1, F.lit(0))]["word"]))
    return F.concat(first, F.array(n))


def inverted(docs: DataFrame, text: Column, name: str = "abstract_inverted_index") -> DataFrame:
    """Inverted index of a text: word -> ascending positions of its whitespace tokens; null for a null text.

    Row-local and without Python: words are sorted with their positions, and each run of
    equal words is one entry.  Memory is that of one row."""
    words = F.split(collapse_ws(text), " ")
    placed = F.sort_array(F.transform(words, lambda w, i: F.struct(w.alias("word"), i.alias("pos"))))
    at = docs.withColumn("_placed", placed)
    at = at.withColumn("_starts", F.when(F.col("_placed").isNotNull(), _starts(F.col("_placed"))))
    run = lambda i: F.slice(F.col("_placed"), F.col("_starts")[i] + 1, F.col("_starts")[i + 1] - F.col("_starts")[i])
    entries = F.transform(F.sequence(F.lit(0), F.size("_starts") - 2), lambda i: F.struct(
        F.col("_placed")[F.col("_starts")[i]]["word"], F.transform(run(i), lambda x: x["pos"])))
    return (at.withColumn(name, F.when(F.col("_starts").isNotNull(), F.map_from_entries(entries)))
            .drop("_placed", "_starts"))


def invert_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Inverted index word -> ascending positions of the whitespace tokens of a text."""
    return inverted(docs.select(id_col, text_col), F.col(text_col)).select(id_col, "abstract_inverted_index")


def raw_works(spark: SparkSession, sf_dir: str, deal: str | None = None) -> DataFrame:
    """RAW_WORK rows as landed by the works API, derived from documents + conversations.

    ``deal``: a document column to deal the rows out by, as texts: an inverted index is several times as large."""
    docs = load(spark, sf_dir, "documents")
    docs = docs.repartition(deal) if deal else docs
    auth = author_lists(load(spark, sf_dir, "conversations")).withColumnRenamed("conv_id", "doc_id")
    return (inverted(docs.join(auth, "doc_id", "left"), F.col("text"))
            .select(*work_columns(docs), "abstract_inverted_index",
                    F.coalesce(F.col("authorships"),
                               F.array().cast("array<struct<author:map<string,string>>>")).alias("authorships")))


def papers_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PAPER rows keyed by bare DOI, derived from labels."""
    lab = load(spark, sf_dir, "labels")
    return lab.select(
        F.concat(F.lit("10.5555/"), F.col("doc_id").cast("string")).alias("doi"),
        F.concat(F.lit("P"), F.col("doc_id").cast("string")).alias("paperId"),
        F.when(F.col("quality") == 1, F.concat(F.lit("enriched abstract of work "), F.col("doc_id").cast("string")))
        .otherwise(F.lit("")).alias("abstract"),
        (F.col("quality") * 10 + F.col("toxic")).cast("int").alias("citationCount"),
        F.col("toxic").cast("int").alias("influentialCitationCount"))


def document_rows(spark: SparkSession, sf_dir: str, with_authors: bool = False) -> DataFrame:
    """Documents as store input rows: doc_id, content, meta (duplicates still present)."""
    docs = load(spark, sf_dir, "documents")
    if with_authors:
        w = works_view(spark, sf_dir)
        meta_src = w.select("doc_id", "title", "publication_year", "authors", "doi", "id")
        base = docs.select("doc_id", "text").join(meta_src, "doc_id")
    else:
        base = docs.select("doc_id", "text", *work_columns(docs)).withColumn("authors", F.lit(""))
    return base.select(
        F.col("doc_id").cast("long"), F.col("text").alias("content"),
        F.struct("title", "publication_year", "authors", "doi", F.col("id").alias("open_alex_id")).alias("meta"))


def store_documents(spark: SparkSession, sf_dir: str, with_authors: bool = False) -> DataFrame:
    """Store rows (doc_key, doc_id, content, meta) with duplicate contents skipped."""
    rows = document_rows(spark, sf_dir, with_authors)
    return dedupe_documents(rows.withColumn("doc_key", doc_key(F.col("content"))))


def embedded_store(spark: SparkSession, sf_dir: str, dim: int = HASH_DIM) -> DataFrame:
    """Index the documents (C3 without gate: dedupe, embed title + content, write
    Parquet into the shared checkpoint folder) and open the written store."""
    store = EvidenceStore(spark, scratch_path(spark, "store"), dim=dim, recreate=True)
    store.write_documents(document_rows(spark, sf_dir))
    return spread(store.read())
