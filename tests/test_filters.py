from pyspark.sql import functions as F

from veriscope.constants import CLIMATE_CONCEPT_GROUPS
from veriscope.operators.filters import (
    claim_predicate, concept_filter, concept_predicate, drop_missing_abstract, fill_missing,
    parse_concept_groups, parse_concept_groups_col, resolve_input, search_by_field, strip_id_prefixes,
    verdict_predicate,
)


def test_parse_concept_groups_handles_newlines_quotes_and_repeats():
    g = parse_concept_groups([' "water\n    supply" OR "a+b"  OR\n "fire" OR "fire" '])
    assert g == [["water supply", "a+b", "fire", "fire"]]
    climate = parse_concept_groups(CLIMATE_CONCEPT_GROUPS)
    assert len(climate) == 3 and "water supply" in climate[1] and "was responsible" in climate[2]


def test_parse_concept_groups_column_matches_driver_side(spark):
    text = ' "snow water\n  equivalent" OR "drought" '
    got = spark.createDataFrame([(text,)], "g string").select(parse_concept_groups_col(F.col("g"))).first()[0]
    assert got == parse_concept_groups([text])[0]


def test_concept_filter_and_of_ors_whole_phrase(spark):
    groups = [["sea level", "a+b"], ["rise"]]
    rows = [(1, "The Sea\nlevel will rise."), (2, "sea levels rise"), (3, "a+b rise"), (4, "sea level falls"),
            (5, None)]
    df = spark.createDataFrame(rows, "id int, t string")
    assert sorted(r.id for r in concept_filter(df, "t", groups).collect()) == [1, 3]
    both = search_by_field(df.withColumn("u", F.lit("rise a+b")), ["t", "u"], groups)
    assert sorted((r.id, r.matched_field) for r in both.collect()) == \
        [(1, "t"), (1, "u"), (2, "u"), (3, "t"), (3, "u"), (4, "u"), (5, "u")]
    assert spark.createDataFrame([("x",)], "t string").filter(concept_predicate("t", [["(bad"]])).count() == 0


def test_drop_missing_abstract_null_and_empty(spark):
    df = spark.createDataFrame([(1, {"a": [0]}), (2, {}), (3, None)], "id int, abstract_inverted_index map<string,array<int>>")
    assert [r.id for r in drop_missing_abstract(df).collect()] == [1]


def test_strip_prefixes_and_fill(spark):
    df = spark.createDataFrame([("https://openalex.org/W1", "https://doi.org/10.1/x", None, 3),
                                ("W2", "10.2/y", "t", None)], "id string, doi string, title string, n int")
    r = fill_missing(strip_id_prefixes(df)).collect()
    assert [(x.id, x.doi, x.title, x.n) for x in r] == [("W1", "10.1/x", "", 3), ("W2", "10.2/y", "t", None)]


def test_claim_and_verdict_predicates_are_strict(spark):
    df = spark.createDataFrame([(1, 0.7), (2, 0.71), (0, 0.9), (3, 0.9)], "label int, score double")
    assert [r.label for r in df.filter(claim_predicate("label", "score", 0.7)).collect()] == [2]
    v = spark.createDataFrame([("SUPPORTS", 0.5), ("REFUTES", 0.6), ("NOT_ENOUGH_INFO", 0.9)], "label string, prob double")
    assert [r.label for r in v.filter(verdict_predicate("label", "prob", 0.5)).collect()] == ["REFUTES"]
    assert v.filter(verdict_predicate("label", "prob", 0.5, print_neutral=True)).count() == 2


def test_resolve_input_url_and_text(spark):
    inputs = spark.createDataFrame([(1, "http://a/1"), (2, "plain words"), (3, "http://missing"), (4, None)],
                                   "id int, text string")
    pages = spark.createDataFrame([("http://a/1", "<body><p>page one</p></body>")], "url string, html string")
    got = {r.id: r.resolved for r in resolve_input(inputs, pages).collect()}
    assert got == {1: "page one", 2: "plain words", 3: None, 4: None}
