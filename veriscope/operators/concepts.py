"""P1/P2 for a table of concept searches: all of them in one pass over the documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veriscope.operators.filters import parse_concept_groups_col
from veriscope.sources.scan import written

#: Anything but letters, digits and white space ends a run of words (fixed value).
BREAK, SPACE = "[^a-z0-9 \t\n\r]+", "[ \t\n\r]+"


def _runs(text) -> Column:
    """Runs of lower-cased words with only white space between them, each an array of words."""
    pieces = F.split(F.lower(text), BREAK)
    return F.filter(F.transform(pieces, lambda p: F.filter(F.split(p, SPACE), lambda w: w != "")), lambda ws: F.size(ws) > 0)


def phrase_table(searches: DataFrame, search_col: str = "search_id", group_col: str = "group_no", text_col: str = "group_text") -> DataFrame:
    """(search_id, group_no, phrase, n): the distinct phrases of each group as words joined by blanks."""
    parsed = searches.select(F.col(search_col).alias("search_id"), F.col(group_col).alias("group_no"),
                             F.explode(parse_concept_groups_col(F.col(text_col))).alias("p"))
    runs = parsed.select("search_id", "group_no", _runs(F.col("p")).alias("r")).where(F.size("r") == 1)
    return runs.select("search_id", "group_no", F.array_join(F.col("r")[0], " ").alias("phrase"), F.size(F.col("r")[0]).alias("n")).distinct()


def search_many(docs: DataFrame, searches: DataFrame, id_col: str = "doc_id", text_col: str = "text", search_col: str = "search_id",
                group_col: str = "group_no", group_text_col: str = "group_text") -> DataFrame:
    """(search_id, id, n_phrases): documents in which every group of a search has a phrase.

    A search is its rows of (search_id, group_no, group_text), group texts as in
    ``parse_concept_groups``; a phrase occurs where its words follow each other with
    only white space between them.  Equals ``concept_filter`` for each search whose
    phrases are letters, digits and blanks; a phrase with anything else in it matches
    nothing here.  ``n_phrases`` counts the search's (group, phrase) pairs found.
    Null texts hold no phrase, rows that repeat an id are one document.

    The documents are read once: every word sequence as long as some phrase is a
    posting, equal ones of a document are one before they are shuffled, and postings
    meet phrases by equality.  The lengths alone (a few numbers) reach the driver.
    """
    phrases = written(phrase_table(searches, search_col, group_col, group_text_col), "phrases")
    groups = phrases.groupBy("search_id").agg(F.count_distinct("group_no").alias("found_groups")).join(
        searches.groupBy(F.col(search_col).alias("search_id")).agg(F.count_distinct(group_col).alias("n_groups")), "search_id")
    groups = groups.where("found_groups = n_groups").select("search_id", "n_groups")
    lengths = sorted(r["n"] for r in phrases.select("n").distinct().collect())
    runs = docs.select(F.col(id_col), F.explode(_runs(F.col(text_col))).alias("ws"))

    def of_length(ws, n):
        found = F.transform(F.sequence(F.lit(1), F.size(ws) - n + 1), lambda i: F.array_join(F.slice(ws, i, n), " "))
        return F.when(F.size(ws) >= n, found).otherwise(F.array().cast("array<string>"))

    def grams(ws):
        return F.array_distinct(F.concat(F.array().cast("array<string>"), *[of_length(ws, n) for n in lengths]))

    postings = runs.select(id_col, F.explode(grams(F.col("ws"))).alias("phrase")).distinct()
    found = postings.join(phrases.select("search_id", "group_no", "phrase"), "phrase")
    return (found.groupBy("search_id", id_col).agg(F.count_distinct("group_no").alias("g"), F.count(F.lit(1)).alias("n_phrases"))
            .join(groups, "search_id").where("g = n_groups").select("search_id", id_col, "n_phrases"))
