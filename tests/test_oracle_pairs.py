"""Each registered query against its DuckDB oracle on the smallest tables."""
import collections
import datetime as dt
import decimal

import duckdb
import pytest

import __spark_entry__ as entry
from vellum.sources.tables import TABLES

SF = "/root/testdata/sf0.001"
SAMPLE = ["trips_daily_metrics", "trips_quality_report", "fact_order", "operations_daily", "category_sales",
          "kpi_headline", "revenue_leakage", "client_scorecard", "account_health", "client_daily_operations",
          "quality_client", "reconcile_totals", "reconcile_keys", "exception_queue", "cutover_readiness",
          "cutover_checklist", "duplicate_keys", "orphan_rows", "quarantine", "change_set",
          "fact_order_incremental", "fact_order_upsert", "fact_order_corrections", "run_evidence", "delivery_manifest",
          "migration_manifest", "exception_severity_map", "quality_over_loads"]


def _norm(v):
    if isinstance(v, decimal.Decimal):
        return ("d", v.normalize())
    if isinstance(v, float):
        return ("f", round(v, 9))
    if isinstance(v, (dt.date, dt.datetime)):
        return ("t", v.isoformat())
    if isinstance(v, (list, tuple)):
        return ("l", tuple(_norm(x) for x in v))
    return (type(v).__name__, v)


def _bag(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return collections.Counter(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "net_revenue" in df.columns


def test_every_query_of_the_products_has_an_oracle():
    from vellum.plans import catalog
    assert set(catalog.QUERIES) <= set(entry.queries()) and set(catalog.QUERIES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", SAMPLE)
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    s_rows = [tuple(r) for r in df.collect()]
    rel = duck.execute(entry.oracle_sql()[name])
    d_cols = [c[0] for c in rel.description]
    assert sorted(df.columns) == sorted(d_cols)
    assert _bag(df.columns, s_rows) == _bag(d_cols, rel.fetchall())
