"""Sentences and claims."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veriscope.constants import CLAIM_THRESHOLD_CORPUS
from veriscope.functions.scoring import claim_score
from veriscope.functions.text import sentences
from veriscope.operators.filters import claim_predicate, score_once


def split_sentences(df: DataFrame, text_col: str, keep: list[str], pos: str = "pos",
                    out: str = "sentence") -> DataFrame:
    """One row per sentence with its 0-based position (empty texts yield no rows)."""
    return df.select(*keep, F.posexplode(sentences(F.col(text_col))).alias(pos, out))


def score_sentences(df: DataFrame, col: str = "sentence", scorer=None) -> DataFrame:
    scorer = scorer or claim_score
    return score_once(df, scorer(F.col(col)), "_s").select(
        "*", F.col("_s.label").alias("label"), F.col("_s.score").alias("score")).drop("_s")


def extract_claims(df: DataFrame, text_col: str, keep: list[str],
                   threshold: float = CLAIM_THRESHOLD_CORPUS, scorer=None) -> DataFrame:
    """Sentences scored by the claim classifier, kept by P13."""
    s = score_sentences(split_sentences(df, text_col, keep), scorer=scorer)
    return s.filter(claim_predicate("label", "score", threshold))


def claims_per_doc(claims: DataFrame, id_col: str, pos: str = "pos", col: str = "sentence",
                   out: str = "claims") -> DataFrame:
    """A1: claims of each document as an ordered list (bounded by the document's own text)."""
    return (claims.groupBy(id_col)
            .agg(F.sort_array(F.collect_list(F.struct(pos, col))).alias("_c"))
            .select(id_col, F.transform("_c", lambda x: x[col]).alias(out)))


def attach_claims(works: DataFrame, grouped_claims: DataFrame, id_col: str = "id") -> DataFrame:
    """Inner equi-join; works without any claim disappear."""
    return works.join(grouped_claims, id_col, "inner")


def claim_documents(works_with_claims: DataFrame, claims_col: str = "claims") -> DataFrame:
    """One document per claim with the work's meta (explode keeps claim order)."""
    meta = F.struct(F.col("title"), F.col("publication_year").cast("int").alias("publication_year"),
                    F.col("authors"), F.col("doi"), F.col("id").alias("open_alex_id"))
    return works_with_claims.select(meta.alias("meta"), F.posexplode(claims_col).alias("claim_pos", "content"))
