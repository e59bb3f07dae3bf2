"""The SQL mirrors used by the oracles agree with the Spark column rules on arbitrary text."""

import duckdb
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from veriscope.constants import SYNTHETIC_CONCEPT_GROUPS
from veriscope.functions.scoring import claim_score, topic_score
from veriscope.functions.text import article_text, sentences, words
from veriscope.functions.vectors import hash_buckets
from veriscope.operators.filters import concept_predicate
from veriscope.plans import catalog
from veriscope.plans import sql as S

ALPHABET = st.sampled_from(list("abcdeThe of.!? \n\t\r,;é'\"<>/&") + ["the ", "of the ", "in the ", "is ", "that ",
                                                                      "<p>", "</p>", "<script>x</script>", "&amp;",
                                                                      "<article>", "</article>", "<!-- c -->"])
TEXTS = st.lists(ALPHABET, max_size=40).map("".join)


def _duck(expr: str, texts):
    con = duckdb.connect()
    con.execute("CREATE TABLE t (i INTEGER, x VARCHAR)")
    con.executemany("INSERT INTO t VALUES (?, ?)", list(enumerate(texts)))
    return [r[0] for r in con.execute(f"SELECT {expr} FROM t ORDER BY i").fetchall()]


@settings(max_examples=15, deadline=None)
@given(st.lists(TEXTS, min_size=1, max_size=8))
def test_text_rules_match_sql(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, x string")
    got = df.orderBy("i").select(
        words(F.col("x")).alias("w"), sentences(F.col("x")).alias("s"), hash_buckets(F.col("x")).alias("b"),
        concept_predicate("x", SYNTHETIC_CONCEPT_GROUPS).alias("c"), article_text(F.col("x")).alias("a"),
        topic_score(F.col("x")).alias("tp"), claim_score(F.col("x")).alias("cl")).collect()
    assert [list(r.w) for r in got] == _duck(S.words("x"), texts)
    assert [list(r.s) for r in got] == _duck(S.sentences("x"), texts)
    assert [list(r.b) for r in got] == _duck(S.buckets("x"), texts)
    assert [r.c for r in got] == _duck(catalog._sql_concept("x"), texts)
    assert [r.a for r in got] == _duck(catalog._sql_article_text("x"), texts)
    assert [r.tp.label == "Yes" for r in got] == _duck(S.topic_yes("x"), texts)
    assert [(r.cl.label, r.cl.score) for r in got] == list(zip(_duck(S.claim_label("x"), texts),
                                                               _duck(S.claim_score("x"), texts)))
