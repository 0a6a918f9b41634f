from pyspark.sql import functions as F

from vellum.operators import quality as Q
from vellum.operators.numbering import number_rows
from vellum.operators.profile import profile, referential_coverage


def test_fused_report_counts(spark):
    parent = spark.createDataFrame([(1,), (2,), (2,), (None,)], "id long")
    child = spark.createDataFrame([(1, "a"), (3, "b"), (3, None), (None, "zz")], "pid long, kind string")
    checks = [
        Q.duplicate_key("dup_parent", "parent", "id"),
        Q.null_key("null_parent", "parent", "id"),
        Q.orphan("orphan_child", "child", "pid", "parent", "id"),
        Q.domain("bad_kind", "child", "kind", ("a", "b")),
        Q.domain("bad_kind_strict", "child", "kind", ("a", "b"), null_violates=True),
        Q.row_rule("big_pid", "child", F.col("pid") > 2),
    ]
    rep = {r.check_name: r.incidents for r in Q.report(checks, {"parent": parent, "child": child}).collect()}
    # NULL key group with one row is not a duplicate; NOT EXISTS counts a NULL fk
    assert rep == {"dup_parent": 1, "null_parent": 1, "orphan_child": 3, "bad_kind": 1,
                   "bad_kind_strict": 2, "big_pid": 2}
    s = Q.summary(Q.report(checks, {"parent": parent, "child": child})).first()
    assert (s.checks, s.failed_checks, s.status) == (6, 6, "failed")


def test_model_tests_semantics(spark):
    m = spark.createDataFrame([(1, "x"), (1, "y"), (None, "y"), (2, None), (3, "q")], "k long, v string")
    dim = spark.createDataFrame([(1,), (2,)], "k long")
    tests = [Q.Test("m", "k", "unique"), Q.Test("m", "k", "not_null"),
             Q.Test("m", "v", "accepted_values", values=("x",)),
             Q.Test("m", "k", "relationships", to="d", field="k")]
    got = {r.rule: r.failures for r in Q.run_tests(tests, {"m": m, "d": dim}).collect()}
    assert got == {"unique": 1, "not_null": 1, "accepted_values": 2, "relationships": 1}


def test_key_checks_keep_the_number_of_partitions(spark):
    """Small partitions of keys aren't joined up to a size in bytes: a task's
    keys are a fixed share of them all."""
    keys, some = spark.range(4000).withColumn("k", F.col("id") % 2000), spark.range(1000)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for found in (Q.repeated_keys(keys, "k"), Q.missing_parents(keys, "k", some, "id")):
            per_task = found.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n"), F.sum("_n").alias("rows")).collect()
            assert len(per_task) == 8 and max(r.n for r in per_task) < 500
            assert sum(r.n for r in per_task) in (1000, 2000) and sum(r.rows for r in per_task) == 2 * sum(r.n for r in per_task)
        row = referential_coverage(keys, "k", some, "id", "k").first()
        assert (row.child_rows, row.matched_rows) == (4000, 2000)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_quarantine_split(spark):
    df = spark.createDataFrame([(1, 5.0), (None, -1.0), (3, None)], "id long, amount double")
    valid, bad = Q.quarantine(df, {"missing_id": F.col("id").isNull(), "negative": F.col("amount") < 0})
    assert valid.count() == 2
    assert [sorted(r.reasons) for r in bad.collect()] == [["missing_id", "negative"]]


def test_number_rows_is_global_and_consecutive(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5000).alias("v"), (F.col("id") % 3).alias("g"))
    out = number_rows(df, [F.col("g").desc(), F.col("v").asc()], "n", partitions=7)
    rows = out.orderBy("n").collect()
    assert [r.n for r in rows] == list(range(1, 5001))
    keys = [(-r.g, r.v) for r in rows]
    assert keys == sorted(keys)


def test_profile(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (2, "b")], "k long, v string")
    p = {r.column_name: (r.row_count, r.null_count, r.distinct_count) for r in profile(df, "t").collect()}
    assert p == {"k": (3, 0, 2), "v": (3, 1, 2)}
    pa = {r.column_name: r.distinct_count for r in profile(df, "t", approx=True).collect()}
    assert pa == {"k": 2, "v": 2}


def test_silver_and_quarantine_partition_bronze(spark):
    """Every bronze row is either accepted by silver or quarantined with a reason."""
    from vellum.plans import catalog, client
    bronze = catalog._client(spark, "/root/testdata/sf0.001").bronze["accounts"]
    rules = {
        "missing_account_id": F.col("account_id").isNull(),
        "missing_account_name": F.col("account_name").isNull(),
        "unparseable_signup_date": F.col("signup_date").try_cast("date").isNull(),
        "negative_or_missing_mrr": ~F.coalesce(F.col("monthly_recurring_revenue") >= 0, F.lit(False)),
    }
    valid, bad = Q.quarantine(bronze, rules)
    silver = client.silver_accounts(bronze)
    assert valid.count() == silver.count() and bad.count() > 0
    assert valid.count() + bad.count() == bronze.count()
