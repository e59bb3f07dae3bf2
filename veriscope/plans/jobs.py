"""Composite jobs C1-C11 as functions from DataFrames to DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veriscope.constants import (
    CLAIM_THRESHOLD_TEXT, HASH_DIM, TOP_K, TOP_K_EXPORT, VERDICT_THRESHOLD,
)
from veriscope.functions.vectors import format_prob, format_similarity, hash_embedding
from veriscope.operators import knn
from veriscope.operators.claims import (
    attach_claims, claim_documents, claims_per_doc, extract_claims,
)
from veriscope.operators.enrich import enrich_by_doi, normalize_works
from veriscope.operators.export import claim_records, corpus_from_abstracts, corpus_from_titles
from veriscope.operators.filters import search_by_field, to_documents, topic_gate
from veriscope.operators.numbering import dense_index
from veriscope.operators.verify import verdicts
from veriscope.sources.scan import written
from veriscope.sources.store import EvidenceStore
from veriscope.sources.manifest import BatchTable
from veriscope.sources.works import (
    append_table, flatten_works, land_works_csv, read_works_csv, read_works_pages, skip_done, write_works,
)


def build_corpus(spark: SparkSession, pages_dir: str, groups, out: str | None = None,
                 fields=("title", "abstract"), multiline: bool = True) -> DataFrame:
    """Landed pages -> flat works -> concept search per field (-> one table per field)."""
    works = flatten_works(read_works_pages(spark, pages_dir, multiline=multiline))
    found = search_by_field(works, list(fields), groups)
    if out:
        for f in fields:
            write_works(found.filter(F.col("matched_field") == f).drop("matched_field"), out, field=f)
    return found


def enrich_corpus(spark: SparkSession, works_csv: str, papers: DataFrame, out: str | None = None) -> DataFrame:
    """Works CSV -> normalised -> enriched by DOI (-> appended to ``out``)."""
    enriched = enrich_by_doi(normalize_works(read_works_csv(spark, works_csv)), papers)
    if out:
        append_table(enriched, out)
    return enriched


ENRICHED = ("openalex_id string, doi string, title string, year int, paperId string, citationCount int, "
            "influentialCitationCount int, abstract string")


def enrich_resumable(spark: SparkSession, works_csv: str, papers: DataFrame, landed: BatchTable, out: BatchTable,
                     parts: int = 64, limit: int | None = None, name: str = "works") -> int:
    """C2 that can be killed and run again: the CSV is landed once, then enriched part by part, each part a
    committed batch of ``out``.  Parts that are there are not computed again, works that an earlier batch
    holds are skipped (S6), and ``limit`` ends a call after that many new parts.  Returns the new parts."""
    works = land_works_csv(read_works_csv(spark, works_csv), landed, parts, name)
    done, new = out.committed(), 0
    for part in range(parts):
        batch = f"{name}/{part:05d}"
        if batch in done or limit is not None and new >= limit:
            continue
        rows = normalize_works(works.where(F.col("part") == part).drop("part"))
        new += out.append(batch, lambda: enrich_by_doi(skip_done(rows, out.read(), "openalex_id"), papers))
    return new


def index_abstracts(works: DataFrame, store: EvidenceStore, gate: bool = True,
                    keep: list[str] | None = None, scorer=None) -> None:
    """Works -> documents -> (topic gate) -> store (dedupe, skip stored, embed)."""
    docs = to_documents(works, keep=keep)
    if gate:
        docs = topic_gate(docs, "content", scorer).drop("topic")
    store.write_documents(docs)


def index_claims(works: DataFrame, store: EvidenceStore, threshold: float, gate: bool = True,
                 scorer=None, claim_scorer=None, numbered: bool = False) -> None:
    """Works -> claims per work (C4) -> joined back (J1) -> claim documents -> store.

    ``numbered`` gives the claims dense ids in (work, position) order, instead of a
    64-bit hash of their text; a repeated claim keeps its least number."""
    claims = claims_per_doc(extract_claims(works, "abstract", ["id"], threshold, claim_scorer), "id")
    docs = claim_documents(attach_claims(works, claims, "id"))
    if gate:
        docs = topic_gate(docs, "content", scorer).drop("topic")
    if numbered:
        docs = dense_index(docs.withColumn("work", F.col("meta.open_alex_id")), ["work", "claim_pos"], "doc_id").select("doc_id", "content", "meta")
    store.write_documents(docs.drop("claim_pos"))


def article_claims(articles: DataFrame, id_cols: list[str], text_col: str = "text",
                   threshold: float = CLAIM_THRESHOLD_TEXT, gate: bool = True,
                   scorer=None, claim_scorer=None) -> DataFrame:
    """C6 (+P12): claims of many articles; claim_id dense from 0 in (article, position) order."""
    src = topic_gate(articles, text_col, scorer).drop("topic") if gate else articles
    claims = extract_claims(src, text_col, id_cols, threshold, claim_scorer)
    return dense_index(claims.withColumnRenamed("sentence", "claim"), id_cols + ["pos"], "claim_id")


def find_evidence(claims: DataFrame, store: DataFrame, k: int = TOP_K, metric: str = "cosine",
                  dim: int = HASH_DIM, embed=None, centroids=None, nprobe: int | None = None,
                  **knn_kw) -> DataFrame:
    """Top-k store documents per claim, with claim text, content and meta.

    Claims are embedded (``embed``: Column -> Column) once and written.  With
    ``centroids`` and ``nprobe``, ``store`` is an IVF store and only the probed cells
    are read."""
    embed = embed or (lambda c: hash_embedding(c, dim))
    q = written(claims.select("claim_id", "claim", embed(F.col("claim")).alias("embedding")), "claims")
    cols, wanted = ["doc_id", "embedding"], q
    if centroids is not None:
        wanted = written(knn.probe_cells(q, centroids, nprobe or len(centroids), metric=metric), "probes")
        cols, knn_kw = [*cols, "cell"], {"probes": "cells", "cell": "cell", **knn_kw}
    hits = knn.knn_topk(wanted, store.select(*cols), k, metric, qid="claim_id", did="doc_id", dim=dim, **knn_kw)
    return attach_content(hits, store).join(q.select("claim_id", "claim"), "claim_id")


def attach_content(hits: DataFrame, store: DataFrame, did: str = "doc_id") -> DataFrame:
    """Content and meta of the matched documents.  The hits are written first, so that
    Spark knows their size: few are broadcast into the store scan, many are shuffled,
    with skew handling for a document that very many claims match."""
    return store.select(did, "content", "meta").join(written(hits, "hits"), did)


def match_report(matches: DataFrame) -> DataFrame:
    """C11: claim, evidence number (from 0), similarity (3 decimals), quote, title, doi, year."""
    return matches.select("claim_id", "claim", "rank", (F.col("rank") - 1).alias("evidence_no"), "score",
                          format_similarity(F.col("score")).alias("similarity"), "doc_id",
                          F.col("content").alias("quote"), F.col("meta.title").alias("title"),
                          F.col("meta.doi").alias("doi"), F.col("meta.publication_year").alias("year"))


def verify_claims(matches: DataFrame, threshold: float = VERDICT_THRESHOLD,
                  print_neutral: bool = False, scorer=None) -> DataFrame:
    """(claim, evidence) pairs -> pair classifier -> P14."""
    return verdicts(matches, "claim", "content", threshold, print_neutral, scorer)


def verdict_report(verified: DataFrame) -> DataFrame:
    """C8 as report lines: claim, evidence number (from 0), title, label, probability (2 decimals)."""
    return verified.select("claim_id", "claim", (F.col("rank") - 1).alias("evidence_no"), F.col("meta.title").alias("title"), "label",
                           format_prob(F.col("prob")).alias("prob"))


def export_abstracts(claims: DataFrame, store: DataFrame, k: int = TOP_K_EXPORT, **kw):
    """Corpus (one record per match) and claim records for an external verifier."""
    m = find_evidence(claims, store, k, **kw).select("claim_id", "rank", F.col("meta.title").alias("title"),
                                                      "content")
    corpus = corpus_from_abstracts(m)
    return corpus, claim_records(claims, corpus)


def export_phrases(claims: DataFrame, works: DataFrame, store: EvidenceStore, threshold: float, k: int = TOP_K, gate: bool = True,
                   scorer=None, claim_scorer=None, **kw):
    """C5 then C10: the works' claims become the phrase store, the claims' nearest phrases are grouped by title (A2)
    and exported with the claim records (A3)."""
    index_claims(works, store, threshold, gate, scorer, claim_scorer, numbered=True)
    return export_titles(claims, store.read(), k, **kw)


def export_titles(claims: DataFrame, store: DataFrame, k: int = TOP_K, **kw):
    """Corpus grouped by title per claim, and claim records."""
    m = find_evidence(claims, store, k, **kw).select("claim_id", "rank", F.col("meta.title").alias("title"),
                                                      "content")
    corpus = corpus_from_titles(m)
    return corpus, claim_records(claims, corpus)
