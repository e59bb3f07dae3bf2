"""Projections, filters and predicates."""

from __future__ import annotations

import functools
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veriscope.constants import (
    CLAIM_CLASS_IDS, CLAIM_THRESHOLD_CORPUS, DOI_PREFIX, KEEP_FIELDS, NEUTRAL_LABEL, TOPIC_POSITIVE,
    VERDICT_THRESHOLD, WORK_ID_PREFIX,
)
from veriscope.functions.text import _c, article_text
from veriscope.functions.scoring import topic_score

_REGEX_SPECIAL = set("\\.^$|?*+()[]{}")


def parse_concept_groups(groups: list[str]) -> list[list[str]]:
    """Each group text -> phrases (whitespace collapsed, split on ' OR ', quotes stripped)."""
    out = []
    for g in groups:
        flat = re.sub(" +", " ", g.replace("\n", " ").strip())
        phrases = [p.strip().strip('"').strip() for p in flat.split(" OR ")]
        out.append([p for p in phrases if p])
    return out


def parse_concept_groups_col(c) -> Column:
    """P2 as a column: group text -> array of phrases."""
    flat = F.trim(F.regexp_replace(F.regexp_replace(_c(c), "\n", " "), " +", " "))
    return F.filter(F.transform(F.split(flat, " OR "),
                                lambda p: F.trim(F.regexp_replace(p, '"', ""))), lambda p: p != "")


def _phrase_regex(phrase: str) -> str:
    parts = []
    for tok in phrase.lower().split():
        parts.append("".join("\\" + ch if ch in _REGEX_SPECIAL else ch for ch in tok))
    return "[ \t\n\r]+".join(parts)


def concept_regex(phrases: list[str]) -> str:
    """Whole-phrase match of any phrase in a lower-cased text (RE2 and Java compatible)."""
    alts = "|".join(_phrase_regex(p) for p in phrases)
    return f"(^|[^a-z0-9])({alts})($|[^a-z0-9])"


def concept_predicate(col, groups: list[str] | list[list[str]]) -> Column:
    """AND across groups, OR across the phrases of a group, on one text column."""
    parsed = parse_concept_groups(groups) if groups and isinstance(groups[0], str) else groups
    lowered = F.lower(_c(col))
    return functools.reduce(lambda a, b: a & b,
                            [lowered.rlike(concept_regex(g)) for g in parsed])


def concept_filter(df: DataFrame, field: str, groups) -> DataFrame:
    return df.filter(concept_predicate(field, groups))


def search_by_field(df: DataFrame, fields: list[str], groups) -> DataFrame:
    """The filter run once per field, results kept apart (tagged, not deduplicated)."""
    parts = [concept_filter(df, f, groups).withColumn("matched_field", F.lit(f)) for f in fields]
    return functools.reduce(DataFrame.unionByName, parts)


def drop_missing_abstract(df: DataFrame, col: str = "abstract_inverted_index") -> DataFrame:
    """Drop works whose inverted abstract is null or empty."""
    return df.filter(F.coalesce(F.size(col) > 0, F.lit(False)))


def keep_fields(df: DataFrame, fields: list[str] = KEEP_FIELDS) -> DataFrame:
    """P5."""
    return df.select(*fields)


def drop_null_doi(df: DataFrame) -> DataFrame:
    """P6."""
    return df.dropna(subset=["doi"])


def strip_prefix(col, prefix: str) -> Column:
    """Remove a known URL prefix (anchored; unchanged when absent)."""
    return F.regexp_replace(_c(col), "^" + re.escape(prefix), "")


def strip_id_prefixes(df: DataFrame) -> DataFrame:
    return (df.withColumn("id", strip_prefix("id", WORK_ID_PREFIX))
              .withColumn("doi", strip_prefix("doi", DOI_PREFIX)))


def fill_missing(df: DataFrame) -> DataFrame:
    """Missing text -> '' (numeric columns stay nullable)."""
    strings = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.fillna("", subset=strings) if strings else df


def to_documents(df: DataFrame, content: str = "abstract", keep: list[str] | None = None) -> DataFrame:
    """P10: work rows -> documents (content + meta struct); ``keep`` carries extra columns."""
    meta = F.struct(F.col("title"), F.col("publication_year").cast("int").alias("publication_year"),
                    F.col("authors"), F.col("doi"), F.col("id").alias("open_alex_id"))
    return df.select(*(keep or []), F.col(content).alias("content"), meta.alias("meta"))


def score_once(df: DataFrame, score, out: str) -> DataFrame:
    """Attach ``score`` as column ``out``, evaluated once per row.

    A filter on a plain projected column is pushed below the projection with the
    expression inlined, so a costly scorer would run in both.  A one-row generator
    keeps the later filter above it."""
    return df.select("*", F.inline(F.array(F.struct(score.alias(out)))))


def topic_gate(df: DataFrame, text_col: str, scorer=None, gate: bool = True,
               out: str = "topic") -> DataFrame:
    """Attach a topic label and keep rows labelled positive (when ``gate``)."""
    scorer = scorer or topic_score
    scored = score_once(df, scorer(F.col(text_col)), out)
    return scored.filter(F.col(f"{out}.label") == TOPIC_POSITIVE) if gate else scored


def claim_predicate(label="label", score="score", threshold: float = CLAIM_THRESHOLD_CORPUS) -> Column:
    """Class id in {1, 2} and score strictly above the threshold."""
    return _c(label).isin(*CLAIM_CLASS_IDS) & (_c(score) > F.lit(threshold))


def verdict_predicate(label="label", prob="prob", threshold: float = VERDICT_THRESHOLD,
                      print_neutral: bool = False) -> Column:
    """Prob strictly above the threshold; neutral pairs only when asked."""
    keep_label = F.lit(True) if print_neutral else (_c(label) != F.lit(NEUTRAL_LABEL))
    return (_c(prob) > F.lit(threshold)) & keep_label


def resolve_input(inputs: DataFrame, pages: DataFrame, text_col: str = "text",
                  url_col: str = "url", html_col: str = "html", out: str = "resolved") -> DataFrame:
    """A text starting with 'http' is a URL looked up in ``pages`` (F4 on its
    html); any other text is used as is.  URL rows and plain rows take separate
    branches, so plain texts never become join keys (no hot null/text key)."""
    is_url = F.coalesce(F.col(text_col).startswith("http"), F.lit(False))
    plain = inputs.filter(~is_url).withColumn(out, F.col(text_col))
    asked = inputs.filter(is_url).select(F.col(text_col).alias("_url")).distinct()
    # One page per URL (the least HTML of repeated ones); text is extracted for asked pages only.
    page = (pages.select(F.col(url_col).alias("_url"), F.col(html_col).alias("_html")).join(asked, "_url", "left_semi")
            .groupBy("_url").agg(F.min("_html").alias("_html"))
            .select("_url", article_text(F.col("_html")).alias("_page_text")))
    urls = (inputs.filter(is_url)
            .join(page, F.col(text_col) == F.col("_url"), "left")
            .withColumn(out, F.col("_page_text")).drop("_url", "_page_text"))
    return plain.unionByName(urls)
