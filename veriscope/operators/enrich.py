"""Work normalisation and enrichment by DOI."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veriscope.functions.text import coalesce_abstract
from veriscope.operators.filters import drop_null_doi, fill_missing, strip_id_prefixes


def normalize_works(works: DataFrame) -> DataFrame:
    """Drop rows without DOI, drop authors, fill text, strip URL prefixes, rename."""
    df = drop_null_doi(works).drop("authors")
    df = strip_id_prefixes(fill_missing(df))
    return df.withColumnsRenamed({"id": "openalex_id", "publication_year": "year"})


def unique_papers(papers: DataFrame) -> DataFrame:
    """One paper per DOI (D8), chosen deterministically: the smallest
    (paperId, abstract, citationCount, influentialCitationCount).  ``min`` of a struct
    is a partial aggregate, so copies of a hot DOI collapse map-side."""
    best = F.min(F.struct("paperId", "abstract", "citationCount", "influentialCitationCount")).alias("_p")
    return (papers.filter(F.col("doi").isNotNull()).groupBy("doi").agg(best)
            .select("doi", "_p.*"))


def enrich_by_doi(works: DataFrame, papers: DataFrame) -> DataFrame:
    """J2 + F5: every normalised work keeps exactly one row; unknown DOIs get blank
    paper fields (counts stay null); the abstract is the paper's when non-empty."""
    p = unique_papers(papers).withColumnRenamed("abstract", "_abstract_y")
    joined = works.withColumnRenamed("abstract", "_abstract_x").join(p, "doi", "left")
    return joined.select(
        "openalex_id", "doi", "title", "year",
        F.coalesce(F.col("paperId"), F.lit("")).alias("paperId"),
        F.col("citationCount").cast("int").alias("citationCount"),
        F.col("influentialCitationCount").cast("int").alias("influentialCitationCount"),
        coalesce_abstract(F.col("_abstract_y"), F.col("_abstract_x")).alias("abstract"))
