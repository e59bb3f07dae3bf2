import json
import os

from pyspark.sql import functions as F

from veriscope.sources.jsonl import write_claims_jsonl, write_corpus_jsonl
from veriscope.sources.works import (
    append_table, corpus_profile, flatten_works, preview, read_works_csv, read_works_pages, skip_done,
    write_works, write_works_csv,
)

WORK1 = {"id": "https://openalex.org/W1", "doi": "https://doi.org/10.1/a", "title": "T1", "publication_year": 2001,
         "abstract_inverted_index": {"b": [1], "a": [0, 2]},
         "authorships": [{"author": {"display_name": "X"}}, {"author": {"display_name": None}},
                         {"author": {}}]}
WORK2 = {"id": "https://openalex.org/W2", "doi": None, "title": None, "publication_year": 2002,
         "abstract_inverted_index": None, "authorships": []}
WORK3 = {"id": "https://openalex.org/W3", "doi": None, "title": "T3", "publication_year": 2003,
         "abstract_inverted_index": {}, "authorships": []}


def land(path):
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/results_1.json", "w") as f:
        json.dump([WORK1, WORK2], f)
    with open(f"{path}/results_2.json", "w") as f:
        json.dump([WORK3, WORK1], f)
    with open(f"{path}/results_3.json", "w") as f:
        f.write(json.dumps([WORK1])[:-10])          # truncated page
    with open(f"{path}/next_cursor.txt", "w") as f:
        f.write("None")


def test_read_pages_skips_broken_file_and_flattens(spark, out_dir):
    land(out_dir)
    raw = read_works_pages(spark, out_dir)
    assert raw.count() == 4
    flat = flatten_works(raw).collect()
    assert len(flat) == 2
    assert {(r.id, r.abstract, r.authors) for r in flat} == {("https://openalex.org/W1", "a b", "X, ")}
    assert [c for c in flatten_works(raw).columns] == ["id", "doi", "title", "publication_year", "abstract", "authors"]


def test_csv_roundtrip_quotes_newlines_and_na(spark, out_dir):
    rows = [("W1", None, 'He said "hi"', 2001, "line one\nline two, with comma", "A, B"),
            ("W2", "10.1/x", "NA", None, "  padded  ", "")]
    df = spark.createDataFrame(rows, "id string, doi string, title string, publication_year int, abstract string, authors string")
    write_works_csv(df, f"{out_dir}/csv")
    back = sorted(read_works_csv(spark, f"{out_dir}/csv").collect(), key=lambda r: r.id)
    assert back[0].title == 'He said "hi"' and back[0].abstract == "line one\nline two, with comma"
    assert back[1].title == "NA" and back[1].abstract == "  padded  " and back[1].publication_year is None


def test_write_per_field_append_skip_profile_preview(spark, out_dir):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id int, t string")
    write_works(df, out_dir + "/w", field="title")
    assert spark.read.parquet(out_dir + "/w").filter(F.col("field") == "title").count() == 3
    append_table(df.limit(1), out_dir + "/app")
    append_table(df.filter("id > 1"), out_dir + "/app")
    assert spark.read.parquet(out_dir + "/app").count() == 3
    done = spark.createDataFrame([(1,), (1,), (3,)], "id int")
    assert [r.id for r in skip_done(df, done).collect()] == [2]
    assert corpus_profile(df).first().asDict() == {"n_rows": 3, "n_cols": 2}
    assert [r.id for r in preview(df, ["id"], 2).collect()] == [1, 2]


def test_jsonl_records(spark, out_dir):
    corpus = spark.createDataFrame([(0, "T", ["s1", "s2"])], "doc_id long, title string, abstract array<string>")
    claims = spark.createDataFrame([(0, "c", [0]), (1, "d", [])], "id long, claim string, doc_ids array<long>")
    write_corpus_jsonl(corpus, out_dir + "/corpus")
    write_claims_jsonl(claims, out_dir + "/claims")
    lines = [json.loads(x) for f in sorted(os.listdir(out_dir + "/claims")) if f.endswith(".json")
             for x in open(f"{out_dir}/claims/{f}")]
    assert sorted(lines, key=lambda d: d["id"]) == [{"id": 0, "claim": "c", "doc_ids": [0]},
                                                     {"id": 1, "claim": "d", "doc_ids": []}]
    c = [json.loads(x) for f in os.listdir(out_dir + "/corpus") if f.endswith(".json")
         for x in open(f"{out_dir}/corpus/{f}")]
    assert c == [{"doc_id": 0, "title": "T", "abstract": ["s1", "s2"]}]
