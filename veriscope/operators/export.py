"""Export records for an external verifier (A2, A3, T3; written by sources.jsonl)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veriscope.functions.text import sentences
from veriscope.operators.numbering import dense_index


def corpus_from_abstracts(matches: DataFrame, claim_id: str = "claim_id", rank: str = "rank",
                          title: str = "title", content: str = "content") -> DataFrame:
    """C9 corpus: one record per (claim, match); doc_id runs over all (claim, rank)."""
    numbered = dense_index(matches.select(claim_id, rank, title, content), [claim_id, rank], "doc_id")
    return numbered.select(claim_id, rank, "doc_id", F.coalesce(F.col(title), F.lit("")).alias("title"),
                           sentences(F.col(content)).alias("abstract"))


def corpus_from_titles(matches: DataFrame, claim_id: str = "claim_id", rank: str = "rank",
                       title: str = "title", content: str = "content") -> DataFrame:
    """C10 corpus (A2): evidence of a claim grouped by title; titles in first-seen
    (best rank) order, quotes in rank order; doc_id runs over (claim, title group).
    A group holds at most k quotes (the claim's top-k)."""
    grouped = (matches.withColumn(title, F.coalesce(F.col(title), F.lit("")))
               .groupBy(claim_id, title)
               .agg(F.min(rank).alias("first_rank"),
                    F.sort_array(F.collect_list(F.struct(F.col(rank), F.col(content)))).alias("_q")))
    grouped = grouped.select(claim_id, title, "first_rank",
                             F.transform("_q", lambda x: x[content]).alias("abstract"))
    return dense_index(grouped, [claim_id, "first_rank"], "doc_id")


def claim_records(claims: DataFrame, corpus: DataFrame, claim_id: str = "claim_id",
                  claim: str = "claim", order_col: str = "doc_id") -> DataFrame:
    """A3: {id, claim, doc_ids}; a claim without matches keeps an empty list."""
    ids = corpus.groupBy(claim_id).agg(F.sort_array(F.collect_list(order_col)).alias("doc_ids"))
    return (claims.join(ids, claim_id, "left")
            .select(F.col(claim_id).alias("id"), F.col(claim).alias("claim"),
                    F.coalesce(F.col("doc_ids"), F.array().cast("array<long>")).alias("doc_ids")))
