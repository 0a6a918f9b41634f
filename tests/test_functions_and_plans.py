import contextlib
import datetime as dt
import io
import uuid
from decimal import Decimal as D

from pyspark.sql import functions as F
from pyspark.sql import types as T

from vellum.functions import avg2, avg_money, days_between, display_time, money_text, ratio_pct, sum2, title_label
from vellum.plans import catalog, revenue
from vellum.session import work_dir
from vellum.sources import files


def test_expressions(spark):
    df = spark.createDataFrame([(1, 3, dt.datetime(2024, 1, 1, 23), dt.datetime(2024, 1, 2, 1), 1234.5,
                                 "duplicate_customer_ids")],
                               "a long, b long, s timestamp_ntz, e timestamp_ntz, m double, name string")
    r = df.select(ratio_pct("a", "b").alias("p"), ratio_pct(F.lit(2), "b").alias("q"),
                  ratio_pct("a", F.lit(0)).alias("z"), display_time("s").alias("at"),
                  days_between("s", "e").alias("d"), money_text("m").alias("t"),
                  title_label("name").alias("label")).first()
    assert (r.p, r.q, r.z, r.at) == (D("33.33"), D("66.67"), None, "2024-01-01 23:00:00")
    assert r.d == 1                       # calendar days, not 24-hour spans
    assert (r.t, r.label) == ("$1,234.50", "Duplicate Customer Ids")


def test_avg_money_rounds_once_half_up(spark):
    df = spark.createDataFrame([(D("0.01"),), (D("0.02"),)], "x decimal(12,2)")
    assert df.agg(avg_money("x").alias("a")).first().a == D("0.02")


def test_measures_are_rounded_once(spark):
    """Values with three decimals: the mean is rounded, not the values."""
    for values, mean, total in (([1.006, 1.006, 1.000], 1.0, 3.01), ([0.004, 0.004, 0.014], 0.01, 0.02),
                                ([0.01, 0.02], 0.02, 0.03), ([-0.01, -0.02], -0.02, -0.03), ([1e11, 0.005, None], 5e10, 1e11 + 0.01)):
        row = spark.createDataFrame([(v,) for v in values], "x double").agg(avg2("x").alias("a"), sum2("x").alias("s")).first()
        assert (row.a, row.s) == (mean, total), values
    assert spark.createDataFrame([], "x double").agg(avg2("x").alias("a")).first().a is None


def test_csv_intake_keeps_spaces_and_bad_lines(spark):
    path = work_dir(spark, f"csv-{uuid.uuid4().hex[:8]}")
    spark.createDataFrame([(" 1", " a "), ("2", "b"), ("x", "c")], "id string, v string") \
        .coalesce(1).write.mode("overwrite").options(header="true", ignoreLeadingWhiteSpace="false",
                                                     ignoreTrailingWhiteSpace="false").csv(path)
    as_text = files.read_csv(spark, path)
    assert sorted(r.v for r in as_text.collect()) == [" a ", "b", "c"]
    typed = files.read_csv(spark, path, T.StructType([T.StructField("id", T.IntegerType()),
                                                      T.StructField("v", T.StringType())]), "_corrupt")
    bad = [r for r in typed.collect() if r._corrupt is not None]
    assert len(bad) >= 1 and any("x" in r._corrupt for r in bad)


def _plan(df, mode="simple") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def test_trip_filters_reach_the_scan(spark):
    plan = _plan(catalog.QUERIES["trips_daily_metrics"](spark, "/root/testdata/sf0.001"), "formatted")
    assert "GreaterThanOrEqual(l_quantity,0.0)" in plan and "GreaterThanOrEqual(l_extendedprice,0.0)" in plan
    scan = [line for line in plan.splitlines() if line.startswith("ReadSchema") and "l_orderkey" in line][0]
    assert "l_returnflag" not in scan and "l_discount" not in scan      # only the columns used are read


def test_fact_exchanges_at_scale(spark):
    """Broadcast off (the large-input shape): one exchange per fact input."""
    from vellum.sources.tables import Tables
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        silver = revenue.Silver.from_tables(Tables(spark, "/root/testdata/sf0.001"), materialize=True).materialize_all()
        plan = _plan(revenue.fact_order(silver))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # orders + four per-order rollups; the chained joins on order_id reuse it
    assert plan.count("Exchange hashpartitioning(order_id") == 5
    assert "CartesianProduct" not in plan


def test_building_a_query_runs_no_job(spark):
    tracker = spark.sparkContext.statusTracker()
    for name, build in catalog.QUERIES.items():
        if name in catalog.WRITES_WHILE_BUILDING:
            continue
        group = f"build-{name}"
        spark.sparkContext.setJobGroup(group, group)
        try:
            build(spark, "/root/testdata/sf0.001")
            # reading a parquet footer is the only work a lazy plan needs
            stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(j).stageIds]
            assert all(i is None or i.name.startswith("parquet at") for i in stages), name
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_a_row_of_a_very_large_order_does_not_overflow(spark):
    from tests.test_revenue import bronze
    lines = spark.range(3).select(F.concat(F.lit("L"), F.col("id").cast("string")).alias("order_item_id"), F.lit(100).cast("long").alias("order_id"),
                                  F.lit(1).cast("long").alias("product_id"), F.lit(2.0).alias("quantity"), F.lit(9999999999.99).alias("unit_price"))
    fact = revenue.fact_order(bronze(spark, order_items=lines))
    assert fact.where("order_id = 100").first().order_total == D("59999999999.94")


def test_csv_round_trip_counts_what_differs(spark, tmp_path):
    """Rows that come back as they were aren't grouped; those that don't are counted on both sides."""
    from vellum.plans import catalog
    from vellum.sources import files
    df = spark.createDataFrame([(1, "a", 1.5), (1, "a", 1.5), (None, None, None), (2, "", float("nan"))], "k long, t string, x double")
    same = catalog._csv_round_trip_rows(spark, "same", df, f"{tmp_path}/same")
    assert "Exchange" not in same._jdf.queryExecution().executedPlan().toString()  # sums were enough
    assert [tuple(r) for r in same.collect()] == [("same", 4, 0)]

    def faulty(*args, **kw):  # loses one of two copies, and changes a NULL
        return files.read_csv(*args, **kw).dropDuplicates().fillna({"t": "b"})

    assert [tuple(r) for r in catalog._csv_round_trip_rows(spark, "faulty", df, f"{tmp_path}/faulty", faulty).collect()] == [("faulty", 4, 3)]
    empty = catalog._csv_round_trip_rows(spark, "empty", df.where("k > 5"), f"{tmp_path}/empty")
    assert [tuple(r) for r in empty.collect()] == [("empty", 0, 0)]
