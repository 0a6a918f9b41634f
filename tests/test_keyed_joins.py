"""Tables that grow with the input aren't broadcast: the planner takes their
size from packed files, and the driver would unpack millions of rows."""
import contextlib
import io

import pytest
from pyspark.sql import functions as F

from vellum.operators import quality as Q
from vellum.plans import client, revenue
from vellum.sources import adapters
from vellum.sources.tables import Tables, write_table

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


@pytest.fixture(scope="module")
def silver(spark):
    t = Tables(spark, SF)
    return revenue.Silver.from_tables(t).materialize_all(), client.Silver.from_tables(t).materialize_all()


def test_models_and_sources_broadcast_no_table(spark, silver):
    """At Spark's own limit for broadcasts, far above these tables' size."""
    s, c = silver
    t = Tables(spark, SF)
    fact = write_table(revenue.fact_order(s), f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/keyed-joins-fact")
    frames = {
        "fact_order": revenue.fact_order(s), "category_sales": revenue.category_sales(s),
        "product_sales": revenue.product_sales(s), "customer_sales": revenue.customer_sales(s, fact),
        "account_health": client.account_health(c), "orphans": Q.missing_parents(fact, "customer_id", s.customers, "customer_id"),
        "shipments": adapters.shipments(t), "transactions": adapters.migration_source(t, "transactions"),
    }
    for name, df in frames.items():
        df.collect()  # the planner may still change its mind while it runs
        for plan in (_plan(df), _plan(df.where(F.lit(True)))):  # as it ran, as it is planned
            assert "SortMergeJoin" in plan and "Broadcast" not in plan, name


def test_packed_keys_are_not_unpacked_on_the_driver(spark, tmp_path):
    """A file far below the limit for broadcasts whose rows are far above it."""
    limit = 1_500_000
    parents = write_table(spark.range(400_000).select("id", F.lit("the same long name").alias("name")), f"{tmp_path}/parents")
    size = sum(p.stat().st_size for p in (tmp_path / "parents").glob("*.parquet"))
    assert size < limit < 400_000 * 8
    child = spark.range(0, 500_000, 5).select(F.col("id").alias("fk"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(limit))
    try:
        found = Q.missing_parents(child, "fk", parents, "id")
        got = found.collect()
        plan = _plan(found)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sorted(r["_k"] for r in got) == list(range(400_000, 500_000, 5)) and {r["_n"] for r in got} == {1}
    assert "Broadcast" not in plan
