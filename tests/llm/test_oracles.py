"""The operators that SQL can express, against their SQL."""

import os

import duckdb
import pytest

from tillgrid.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_equals_its_sql(spark, name):
    got = queries.QUERIES[name](spark, SF).toPandas()
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM read_parquet('{SF}/{f}')")
    want = con.execute(queries.ORACLE[name]).fetchdf()
    names = sorted(want.columns)
    assert sorted(got.columns) == names and len(got) == len(want)
    rows = lambda df: sorted(
        tuple(None if v != v or v is None else v for v in r) for r in df[names].astype(object).itertuples(index=False))
    key = lambda r: repr(r)
    clean = lambda df: sorted(
        (tuple("null" if x is None or str(x) in ("nan", "<NA>") else x for x in r)
         for r in df[names].astype(object).itertuples(index=False)), key=key)
    del rows
    assert clean(got) == clean(want)
