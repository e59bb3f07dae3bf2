"""Benchmark decontamination by winnowed word fingerprints."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veriscope.llm.common import WORD, digest, documents, words, write_table


def _grams(ws: Column, n: int, least: int) -> Column:
    """Hashes of all n-grams of a word array; none if it has fewer than ``least`` words."""
    return F.when(F.size(ws) >= least, F.transform(
        F.sequence(F.lit(0), F.size(ws) - n),
        lambda i: F.xxhash64(*[F.get(ws, i + j) for j in range(n)])))


def winnowed(rows: DataFrame, ws: str, gram: int, window: int) -> DataFrame:
    """Adds (pos, hash): the gram hashes that are the least of some run of ``window`` grams.

    Sliding minima are built by doubling (runs of 1, 2, 4, ... grams), and a gram is
    chosen if it equals the minimum of a run that it lies in.  Ties are all chosen,
    which keeps the choice a function of the words alone.  Every ``gram + window - 1``
    equal words of two texts have a chosen gram in common.  (Outer generator and
    coalesce: otherwise Spark infers null and size filters that compute all grams
    again below the scan's projection.)
    """
    keep = [c for c in rows.columns if c != ws]
    out = rows.select(*keep, _grams(F.col(ws), gram, gram + window - 1).alias("_hashes"))
    out, have = out.withColumn("_least", F.col("_hashes")), 1
    while have < window:
        step = min(have, window - have)
        shifted = F.slice("_least", step + 1, F.greatest(F.size("_least"), F.lit(1)))
        out = out.withColumn("_least", F.zip_with("_least", shifted, lambda a, b: F.least(a, b)))
        have += step
    each = out.select(*keep, "_least", F.posexplode_outer("_hashes").alias("pos", "hash"))
    chosen = F.array_contains(F.slice("_least", F.greatest(F.col("pos") - (window - 2), F.lit(1)), window), F.col("hash"))
    return each.where(F.coalesce(chosen, F.lit(False))).select(*keep, "pos", "hash")


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_id_col: str = "item_id", item_text_col: str = "text",
                  span: int = 10, gram: int = 5) -> DataFrame:
    """(doc_id, k1, k2, n_words, n_hit, items, spans): one row per input row; k1, k2 are the digest of (doc_id, text).

    ``items`` are the sorted item_ids (as strings) that have a window of ``span`` words
    in the document; ``spans`` the sorted starts of such windows with their lengths.
    Fingerprints of documents and items meet on the hash alone (semi join: a passage
    in very many items or documents adds no pairs).  Each meeting is extended to the
    windows around it, which are then compared word by word with the items' distinct
    windows, so hash collisions never count.  Winnowing makes the search complete:
    every shared span of ``span`` words holds a common fingerprint.  Items of fewer
    words are one window each and met by all document grams of their length.

    Null and empty texts have no words.  Items without words are ignored; a null
    item_id marks words but is not listed.  Repeated items count once.
    """
    window = span - gram + 1
    bench = items.select(F.col(item_id_col).cast("string").alias("item"), words(F.col(item_text_col)).alias("ws"))
    n = F.size("ws")
    starts = F.when(n >= span, F.sequence(F.lit(0), n - span)).when(n > 0, F.array(F.lit(0)))
    windows = write_table(
        bench.select("item", "ws", F.explode_outer(starts).alias("_s"))
        .select("item", F.least(n, F.lit(span)).alias("len"),
                F.array_join(F.slice("ws", F.col("_s") + 1, span), " ").alias("window"))
        .where(F.col("window") != "").distinct(), "windows")
    distinct = write_table(windows.select("window", "len").distinct(), "distinct")
    prints = write_table(winnowed(bench.select("ws"), "ws", gram, window).select("hash").distinct(), "prints")
    short = [r[0] for r in distinct.where(F.col("len") < span).select("len").distinct().collect()]   # below span

    base = documents(docs, id_col, text_col)
    key = digest(F.col("doc_id"), F.col("text"))
    ws = base.select(*key, words(F.col("text")).alias("ws"))
    met = winnowed(ws, "ws", gram, window).join(prints, "hash", "left_semi").select(
        "k1", "k2", F.greatest(F.col("pos") - (window - 1), F.lit(0)).alias("lo"), F.col("pos").alias("hi"),
        F.lit(span).alias("len"))
    for m in short:
        own = distinct.where(F.col("len") == m).select(
            F.xxhash64(*[F.get(F.split("window", " "), F.lit(j)) for j in range(m)]).alias("hash"))
        grams = ws.select("k1", "k2", F.posexplode_outer(_grams(F.col("ws"), m, m)).alias("pos", "hash"))
        met = met.unionByName(grams.join(own, "hash", "left_semi").select(
            "k1", "k2", F.col("pos").alias("lo"), F.col("pos").alias("hi"), F.lit(m).alias("len")))
    places = F.array_distinct(F.flatten(F.transform(
        F.collect_set(F.struct("lo", "hi", "len")),
        lambda x: F.transform(F.sequence(x["lo"], x["hi"]), lambda s: F.struct(s.alias("start"), x["len"].alias("len"))))))
    met = write_table(met.groupBy("k1", "k2").agg(places.alias("places")), "met")

    # The documents that met anything, then their windows, each an exact string.  What met grows
    # with the corpus, so it is never broadcast: the same plan holds at every size.
    texts = base.select(*key, "text").join(met.hint("merge"), ["k1", "k2"]).dropDuplicates(["k1", "k2"])
    cand = (texts.select("k1", "k2", words(F.col("text")).alias("ws"), "places")
            .select("k1", "k2", "ws", F.explode("places").alias("p"))
            .where(F.col("p.start") + F.col("p.len") <= F.size("ws"))
            .select("k1", "k2", "p.start", "p.len",
                    F.array_join(F.slice("ws", F.col("p.start") + 1, F.col("p.len")), " ").alias("window")))
    found = write_table(cand.join(distinct, ["window", "len"], "left_semi"), "found")
    covered = F.size(F.array_distinct(F.flatten(F.transform(
        F.col("spans"), lambda s: F.sequence(s["start"], s["start"] + s["len"] - 1)))))
    spans = (found.groupBy("k1", "k2").agg(F.sort_array(F.collect_set(F.struct("start", "len"))).alias("spans"))
             .withColumn("n_hit", covered))
    listed = (found.select("k1", "k2", "window", "len").distinct().join(windows, ["window", "len"])
              .where(F.col("item").isNotNull()).select("k1", "k2", "item").distinct()
              .groupBy("k1", "k2").agg(F.sort_array(F.collect_list("item")).alias("items")))
    result = write_table(spans.join(listed, ["k1", "k2"], "left"), "contaminated")
    n_words = F.regexp_count(F.col("text"), F.lit(WORD.replace(r"\x60", r"\x40\x5B-\x60")))   # A-Z belong to words here
    rows = base.select("doc_id", *key, n_words.cast("long").alias("n_words"))
    return rows.join(result, ["k1", "k2"], "left").select(
        "doc_id", "k1", "k2", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.coalesce("spans", F.array().cast("array<struct<start:int,len:int>>")).alias("spans"))
