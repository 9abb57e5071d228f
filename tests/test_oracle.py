"""Registered queries against their DuckDB twin on the smallest scale."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from tests.conftest import SF0001

TABLES = "region nation customer supplier part orders lineitem events".split()
BATCH_KEYS = [
    "silver_customers", "silver_orders", "silver_line_items", "scd1_orders", "scd1_line_items",
    "scd2_history", "scd2_current_rows", "scd2_noop_suppressed", "scd2_late_arrival", "scd_tie_break",
    "scd2_skewed_key", "cdc_apply_late_arrival", "pipeline_scd2_incremental",
    "join_orders_current_customers", "join_line_items_orders", "agg_count_distinct", "agg_conditional",
    "agg_conditional_distinct", "mv_sales_by_region_monthly", "mv_product_sales_metrics", "clustered_write",
    "ingest_json_orders", "ingest_rescued_data", "ingest_bounded_batches", "clustered_tables", "dataset_catalog", "pipeline_end_to_end",
]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF0001}/{t}.parquet')")
    return c


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return None if v is None else str(v)


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


def test_every_query_has_an_oracle():
    from layerkit.plans import oracle, queries

    assert set(queries.queries()) == set(oracle.oracle_sql())
    assert len(queries.queries()) == 31
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("key", BATCH_KEYS)
def test_query_matches_oracle(spark, con, key):
    df = E.queries()[key](spark, SF0001)
    res = con.execute(E.oracle_sql()[key])
    dcols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(dcols)
    assert _canon(df.columns, [tuple(r) for r in df.collect()]) == _canon(dcols, res.fetchall())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "total_revenue" in df.columns
