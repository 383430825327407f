"""The driver contract and a DuckDB cross-check on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as E
from tests.conftest import SF001

CHECKED = ["mart_city_top_products", "mart_well_kpi", "mart_route_optimization", "join_next_event",
           "changes_apply", "agg_factor_long", "target_dataset"]


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["city", "product_id", "product_name", "orders_cnt", "qty_sum", "revenue_sum"]
    assert df.count() > 0


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", CHECKED)
def test_oracle_agrees_on_sf0001(spark, name):
    con = duckdb.connect()
    for t in ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    s = E.queries()[name](spark, SF001).toPandas()
    o = con.sql(E.oracle_sql()[name]).df()
    cols = sorted(s.columns)
    assert cols == sorted(o.columns)
    norm = lambda df: sorted(map(repr, df[cols].astype(object).where(df[cols].notna(), None)
                                  .itertuples(index=False, name=None)))
    assert len(s) == len(o)
    assert norm(s) == norm(o)
