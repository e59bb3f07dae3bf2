"""Queries that SQL can express equal DuckDB on whole tables."""
import duckdb
import pandas as pd
import pytest

import __spark_entry__ as E
from veriscope.llm.oracles import ORACLES

SF = "/root/testdata/sf0.001"


def _rows(df):
    df = df[sorted(df.columns)]
    return sorted((tuple(None if v is None or v is pd.NA or v != v else round(v, 6) if isinstance(v, float) else v for v in r)
                   for r in df.astype(object).itertuples(index=False)), key=repr)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    got, want = E.queries()[name](spark, SF).toPandas(), con.execute(ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert _rows(got) == _rows(want)
