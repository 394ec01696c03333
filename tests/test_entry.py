"""The driver contract: entry(), queries(), oracle_sql()."""

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from tillgrid.sources.tables import TABLES


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert {"store_id", "period", "revenue", "amount_mom_pct"} <= set(df.columns)


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


FAST = ["headline", "mom_sql", "tier_split", "top_products", "sku_pareto", "sheet_unpivot",
        "classified_products", "new_conflicts", "upsert_fact_sales", "grounding_findings",
        "fallback_texts", "deck_texts", "sql_headline", "sql_tier_split", "category_labels",
        "upsert_fact_channel", "upsert_dim_product", "brand_carry_forward", "document_grounding"]


@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle_on_small_tables(spark, name):
    df = E.queries()[name](spark, SF_SMALL)
    got = [tuple(sorted(r.asDict().items())) for r in df.collect()]
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    res = con.execute(E.oracle_sql()[name])
    cols = [d[0] for d in res.description]
    want = [tuple(sorted(zip(cols, r))) for r in res.fetchall()]

    def norm(rows):
        out = [tuple((k, round(v, 6) if isinstance(v, float) else
                      (float(v) if hasattr(v, "as_tuple") else v)) for k, v in r) for r in rows]
        return sorted(out, key=repr)
    assert norm(got) == norm(want)
