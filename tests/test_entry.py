import duckdb
import pandas as pd
import pytest

import __spark_entry__ as E
from veriscope.plans import catalog

SF = "/root/testdata/sf0.001"
TABLES = "documents embeddings pages benchmark labels conversations".split()
FAST = ["uninvert_abstract", "concept_filter", "article_text", "search_by_field", "resolve_input", "normalize_ids",
        "enrich_by_doi", "split_sentences", "topic_gate", "extract_claims", "claims_per_doc", "claim_documents",
        "dedupe_documents", "insert_if_absent", "hash_embedding", "topk_dot", "topk_cosine", "topk_cosine_blocked",
        "match_report", "verify_claims", "export_corpus_abstracts", "export_claims", "export_corpus_titles",
        "topk_one", "partition_map", "skip_done", "ivf_probe", "match_report_ivf", "store_top_k", "store_top_k_batch",
        "embed_missing"]


def _cell(v):
    if v is None or (not isinstance(v, (list, str)) and pd.isna(v)):
        return None
    if hasattr(v, "item"):
        v = v.item()
    return round(v, 6) if isinstance(v, float) else v


def _norm(df):
    cols = sorted(df.columns)
    return sorted((tuple(_cell(v) for v in r) for r in df[cols].astype(object).itertuples(index=False)), key=repr)


def test_contract_keys():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q) and "match_report" in q
    assert set(catalog.QUERIES) - set(catalog.ORACLES) == {"ml_topic"}
    assert len(q) >= 43


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["claim_id", "claim", "rank", "evidence_no", "score", "similarity", "doc_id", "quote",
                          "title", "doi", "year"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle(spark, con, name):
    got = E.queries()[name](spark, SF).toPandas()
    want = con.execute(E.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want)
    assert _norm(got) == _norm(want)
