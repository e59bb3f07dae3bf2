"""URL filters: hashed host-suffix and path-prefix expressions against a rule list."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veriscope.llm.common import ascii_lower, write_table


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path).  No ``://`` or null: both empty."""
    at = F.instr(url, "://")
    rest = F.coalesce(F.when(at > 0, F.substr(url, at + 3)), F.lit(""))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.char_length(host) + 1), "^[^?#]*", 0)
    return ascii_lower(host), path


def judge_urls(urls: DataFrame, rules: DataFrame, url_col: str = "url", default: str = "allow") -> DataFrame:
    """(url, host, path, rule, verdict): one row per distinct url that is not null.

    ``rules`` has (action, host, path).  Each distinct url is expanded into all its
    host suffixes (cut at dots) times its path prefixes of the lengths that rules
    have; the expressions meet the rules on the first 32 bits of their SHA-256, the
    full digest is confirmed afterwards, and the longest rule wins (block before
    allow among equals).  A url without a rule gets ``default`` (a block list with
    exceptions lets unlisted urls pass).  Distinct urls are judged once, so a hot url
    is no hot key; a hot host meets the rules in a broadcast or skew-split join.
    """
    lengths = [r[0] for r in rules.select(F.char_length("path")).distinct().collect()]   # at most the longest path
    keyed = rules.select("action", F.col("host").alias("rule_host"), F.col("path").alias("rule_path"),
                         _expression(F.col("host"), F.col("path")).alias("rule_digest"))
    keyed = keyed.withColumn("short", F.substring("rule_digest", 1, 8))
    host, path = url_parts(F.col("url"))
    distinct = urls.select(F.col(url_col).alias("url")).where(F.col("url").isNotNull()).distinct()
    parts = distinct.select("url", host.alias("host"), path.alias("path"))
    labels = F.split("host", r"\.")
    n = F.size(labels)
    suffixes = F.transform(F.sequence(F.lit(1), n), lambda i: F.array_join(F.slice(labels, i, n), "."))
    fitting = F.filter(F.array(*[F.lit(x) for x in lengths]).cast("array<int>"), lambda x: x <= F.char_length("path"))
    prefixes = F.transform(fitting, lambda x: F.substr(F.col("path"), F.lit(1), x))
    cut = (parts.select("url", F.explode_outer(suffixes).alias("suffix"), prefixes.alias("prefixes"))
           .select("url", "suffix", F.explode_outer("prefixes").alias("prefix"))
           .select("url", _expression(F.col("suffix"), F.col("prefix")).alias("url_digest")))
    hits = (cut.withColumn("short", F.substring("url_digest", 1, 8)).join(keyed, "short")
            .where(F.col("url_digest") == F.col("rule_digest")))
    rank = F.struct((F.char_length("rule_host") + F.char_length("rule_path")).alias("n"),
                    (F.col("action") == "block").cast("int").alias("strict"),
                    F.concat("rule_host", "rule_path").alias("rule"), F.col("action").alias("verdict"))
    best = write_table(hits.groupBy("url").agg(F.max(rank).alias("best")).select("url", "best.rule", "best.verdict"),
                       "urls")
    return parts.join(best, "url", "left").select(
        "url", "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict"))


def _expression(host: Column, path: Column) -> Column:
    return F.sha2(F.concat(host, F.lit("\n"), path), 256)


def filter_pages(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url",
                 default: str = "allow") -> DataFrame:
    """(page_id, host, path, rule, verdict): one row per input row, repeats included.

    Null urls have an empty host and path, no rule and the default verdict."""
    judged = write_table(judge_urls(pages, rules, url_col, default), "pages")
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"))
    return rows.join(judged, "url", "left").select(
        "page_id", F.coalesce("host", F.lit("")).alias("host"), F.coalesce("path", F.lit("")).alias("path"),
        "rule", F.coalesce("verdict", F.lit(default)).alias("verdict"))
