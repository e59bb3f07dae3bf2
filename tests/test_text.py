from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from veriscope.functions.text import (
    article_text, authors_string, coalesce_abstract, doc_key, embed_input, sentences, uninvert_abstract,
)
from veriscope.schemas import RAW_WORK


def one(spark, col, rows, schema):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(col).collect()]


def test_uninvert_orders_by_positions_and_keeps_first_occurrence(spark):
    rows = [({"world": [1], "hello": [0, 2], "again": [3]},), (None,), ({},), ({"b": [], "a": [0]},)]
    got = one(spark, uninvert_abstract(F.col("m")), rows, "m map<string,array<int>>")
    # repeated word lost (D1); null stays null; empty map -> ''; empty position list sorts first
    assert got == ["hello world again", None, "", "b a"]


@settings(max_examples=25, deadline=None)
@given(st.lists(st.sampled_from(["a", "b", "c", "dd", "e"]), min_size=1, max_size=30))
def test_uninvert_of_invert_is_distinct_words_in_first_order(spark, toks):
    inv = {}
    for i, w in enumerate(toks):
        inv.setdefault(w, []).append(i)
    got = one(spark, uninvert_abstract(F.col("m")), [(inv,)], "m map<string,array<int>>")[0]
    assert got == " ".join(dict.fromkeys(toks))


def test_authors_null_dropped_missing_blank(spark):
    rows = [([{"author": {"display_name": "A"}}, {"author": {"display_name": None}}, {"author": {}},
              {"author": {"display_name": "Z"}}],), ([],), (None,)]
    got = one(spark, authors_string(F.col("a")), rows, "a array<struct<author:map<string,string>>>")
    assert got == ["A, , Z", "", None]


def test_sentences_rule(spark):
    rows = [("First one. Second  one!\nThird?  ",), ("",), (None,), ("no end",)]
    got = one(spark, sentences(F.col("t")), rows, "t string")
    assert got == [["First one.", "Second one!", "Third?"], [], None, ["no end"]]


def test_article_text_prefers_article_and_strips_noise(spark):
    html = ("<html><head><title>T</title><script>var x='<p>';</script><style>p{}</style></head>"
            "<body><nav>menu</nav><article><h1>Head</h1><!-- ad --><p>A &amp; B &lt;c&gt;</p>"
            "<footer>foot</footer></article></body></html>")
    body_only = "<html><body><p>Only   body</p><script>x</script></body></html>"
    got = one(spark, article_text(F.col("h")), [(html,), (body_only,), ("plain text",)], "h string")
    assert got == ["Head A & B <c>", "Only body", "plain text"]


def test_coalesce_abstract_doc_key_embed_input(spark):
    df = spark.createDataFrame([("", "orig", "T", "c"), ("new", "orig", None, "c"), (None, "orig", "T", None)],
                               "y string, x string, title string, content string")
    r = df.select(coalesce_abstract(F.col("y"), F.col("x")).alias("a"), doc_key(F.col("content")).alias("k"),
                  embed_input(F.col("title"), F.col("content")).alias("e")).collect()
    assert [x.a for x in r] == ["orig", "new", "orig"]
    assert r[0].k == r[1].k and len(r[0].k) == 64
    assert [x.e for x in r] == ["T\nc", "c", "T"]


def test_raw_work_schema_has_map_abstract():
    assert RAW_WORK["abstract_inverted_index"].dataType.simpleString() == "map<string,array<int>>"


def test_score_formatting(spark):
    from veriscope.functions.vectors import format_prob, format_similarity
    r = spark.createDataFrame([(0.98765, 0.5)], "s double, p double").select(
        format_similarity(F.col("s")).alias("a"), format_prob(F.col("p")).alias("b")).first()
    assert (r.a, r.b) == ("0.988", "0.50")
