"""U1 trained on labelled documents: multinomial naive Bayes as counts, joins and sums."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veriscope.functions.text import words
from veriscope.sources.scan import written

#: Weights are whole millionths, so that sums of them are exact in any order.
UNIT = 1_000_000


def _micro(c):
    return F.round(F.log(c) * UNIT).cast("long")


def train(docs: DataFrame, text_col: str = "text", label_col: str = "label") -> tuple[DataFrame, DataFrame]:
    """(weights, prior) from labelled texts.

    ``weights`` has one row a word: ``weight``, the logarithm of its share in class 1
    over that in class 0 (one added to each count), in millionths.  ``prior`` is one
    row: the logarithm of class 1's rows over class 0's (one added to each).  Rows with a null label are left out; a null text has no words.
    Words are counted map-side before they are shuffled, so frequent words cost one row a task.
    """
    one = F.col(label_col).cast("int")
    known = docs.select(one.alias("label"), F.col(text_col).alias("text")).where("label in (0, 1)")
    prior = known.agg((_micro(F.coalesce(F.sum("label"), F.lit(0)) + 1) - _micro(F.coalesce(F.sum(1 - F.col("label")), F.lit(0)) + 1))
                      .alias("prior"))
    counts = written(known.select("label", F.explode(words(F.coalesce("text", F.lit("")))).alias("word")).groupBy("word").agg(
        F.sum("label").alias("n1"), F.sum(1 - F.col("label")).alias("n0")), "word-counts")
    totals = counts.agg(F.sum("n1").alias("t1"), F.sum("n0").alias("t0"), F.count(F.lit(1)).alias("v"))
    share = [_micro((F.col(f"n{c}") + 1) / (F.col(f"t{c}") + F.col("v"))) for c in (1, 0)]
    return counts.join(F.broadcast(totals)).select("word", (share[0] - share[1]).alias("weight")), prior


def classify(docs: DataFrame, weights: DataFrame, prior: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, topic_label, topic_score, margin): one row per input row, repeated rows included.

    ``margin`` is the log-odds of class 1 in millionths: the prior and, for each word
    the training texts hold, its count times its weight.  'Yes' from 0 up; the score
    is the chosen class's probability.  A text without known words has the prior alone.

    Words are counted by (text, word) before the join, so that copies of a text, however
    many, are one row for each word; the vocabulary grows with the corpus, so Spark broadcasts the weights
    only if they are measured to be small, and else splits frequent words.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col), F.xxhash64(text).alias("_k1"), F.xxhash64(F.lit(1), text).alias("_k2"), text.alias("_t"))
    # The empty word counts a text's copies; their common sum is divided by it, without remainder.
    counts = (rows.select("_k1", "_k2", F.explode(F.array_append(words(F.col("_t")), F.lit(""))).alias("word"))
              .groupBy("_k1", "_k2", "word").agg(F.count(F.lit(1)).alias("n")))
    sums = counts.join(weights, "word", "left").groupBy("_k1", "_k2").agg(
        F.expr("sum(n * weight) div max(if(word = '', n, null))").alias("s"))
    margin = F.col("prior") + F.coalesce("s", F.lit(0))
    return (rows.drop("_t").join(sums, ["_k1", "_k2"], "left").join(F.broadcast(prior)).select(
        id_col, F.when(margin >= 0, F.lit("Yes")).otherwise(F.lit("No")).alias("topic_label"),
        F.round(1 / (1 + F.exp(-F.abs(margin) / UNIT)), 6).alias("topic_score"), margin.alias("margin")))
