"""A key holding a third of all rows: results stay whole and exact, and the
plans reduce the hot key map-side before any exchange."""
import contextlib
import io

from pyspark.sql import functions as F

from vellum.operators import quality as Q
from vellum.operators.reconcile import reconcile_keys


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def _hot(spark, n=30000):
    # key 0 holds a third of the rows, the rest are unique
    return spark.range(n).select(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"),
                                 (F.col("id") % 7).cast("decimal(12,2)").alias("a"))


def test_reconcile_with_a_hot_key(spark):
    src = _hot(spark)
    tgt = _hot(spark).where(F.col("k") != 1)
    got = {(r.record_key, r.issue_type): (r.source_rows, r.target_rows)
           for r in reconcile_keys(src, tgt, "k", "a").collect()}
    assert got[("0", "duplicate_source_key")] == (10000, 10000)
    assert got[("0", "amount_mismatch")] == (10000, 10000)
    assert got[("1", "missing_in_target")] == (1, 0) and len(got) == 4
    plan = _plan(reconcile_keys(src, tgt, "k", "a"))
    # per-key partial aggregation sits below every exchange on the key
    assert plan.count("partial_count(1)") == 2 and "CartesianProduct" not in plan


def test_orphans_and_duplicates_with_a_hot_key(spark):
    child = _hot(spark).select(F.col("k").alias("pid"))
    parent = spark.range(1, 30000).select(F.col("id").alias("id"))
    rep = {r.check_name: r.incidents for r in Q.report(
        [Q.orphan("orphans", "c", "pid", "p", "id"), Q.duplicate_key("dups", "c", "pid")],
        {"c": child, "p": parent}).collect()}
    assert rep == {"orphans": 10000, "dups": 1}


def test_raw_row_joins_split_the_hot_key(spark):
    """Joins of raw rows on a hot key (the trip adapter's lines ⋈ orders, the
    marts' semi join) rely on AQE skew handling: the hot partition is split."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        lines = spark.range(300000).select(
            F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("order_id"),
            (F.col("id") % 50).alias("product_id"))
        active = spark.range(300000).where(F.col("id") % 2 == 0).select(F.col("id").alias("order_id"))
        for how in ("left_semi", "inner"):
            df = lines.join(active, "order_id", how).groupBy("product_id").count()
            got = sum(r["count"] for r in df.collect())
            assert got == 100000 + 100000            # the hot key's third plus the even other ids
            assert "SortMergeJoin(skew=true)" in _plan(df)
    finally:
        for k in conf:
            spark.conf.unset(k)


def test_written_silver_keeps_the_hot_key_splittable(spark, tmp_path):
    """The layer as a run writes it: rows stay where their task wrote them, so
    a semi join of raw lines on a hot order is split."""
    from vellum.plans.pipeline import write_layer
    lines = spark.range(300000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("order_id"), (F.col("id") % 50).alias("product_id"))
    active = spark.range(300000).where(F.col("id") % 2 == 0).select(F.col("id").alias("order_id"))
    written = write_layer({"order_items": lines, "orders": active}, str(tmp_path))
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        df = written["order_items"].join(written["orders"], "order_id", "left_semi").groupBy("product_id").count()
        assert sum(r["count"] for r in df.collect()) == 200000
        assert "SortMergeJoin(skew=true)" in _plan(df)
    finally:
        for k in conf:
            spark.conf.unset(k)
