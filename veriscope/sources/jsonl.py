"""JSON lines export (S9 corpus, S10 claims)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_corpus_jsonl(corpus: DataFrame, path: str, mode: str = "overwrite") -> None:
    """{doc_id, title, abstract[]} per line."""
    (corpus.select(F.col("doc_id").cast("long"), F.col("title"), F.col("abstract"))
     .write.mode(mode).json(path))


def write_claims_jsonl(claims: DataFrame, path: str, mode: str = "overwrite") -> None:
    """{id, claim, doc_ids[]} per line."""
    (claims.select(F.col("id").cast("long"), F.col("claim"), F.col("doc_ids"))
     .write.mode(mode).json(path))
