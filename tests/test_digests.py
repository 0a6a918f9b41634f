"""The digest tree gives the issues of the full reconcile and reads few rows for few differences."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vellum.operators.digests import Tree, differing, digest, in_question, merged, reconcile_by_digest
from vellum.operators.reconcile import reconcile_keys

SMALL = Tree(buckets=64, fan=8)
ROWS = "k long, amount decimal(12,2)"


def issues(df):
    return sorted(map(tuple, df.collect()), key=str)


def sums(df):
    return sorted(map(tuple, df.drop("repeats").collect()))


row = st.tuples(st.one_of(st.none(), st.integers(0, 12)), st.one_of(st.none(), st.sampled_from(["1.00", "1.01", "5.00"])))


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(same=st.lists(row, max_size=8), left=st.lists(row, max_size=4), right=st.lists(row, max_size=4))
def test_same_issues_as_the_full_join(spark, same, left, right):
    frame = lambda rows: spark.createDataFrame(rows, "k long, a string").select("k", F.col("a").cast("decimal(12,2)").alias("amount"))
    source, target = frame(same + left), frame(same + right)
    want = issues(reconcile_keys(source, target, "k", "amount"))
    assert issues(reconcile_by_digest(source, target, "k", "amount", tree=SMALL)) == want
    # a target that came in two loads, known by its merged digest only
    two = merged(digest(frame(same), "k", "amount", SMALL), digest(frame(right), "k", "amount", SMALL))
    assert sums(two) == sums(digest(target, "k", "amount", SMALL))
    assert issues(reconcile_by_digest(source, target, "k", "amount", tree=SMALL, target_digest=two)) == want


def test_rows_joined_grow_with_the_differences(spark):
    source = spark.range(40_000).select(F.col("id").alias("k"), (F.col("id") % 500).cast("decimal(12,2)").alias("amount"))
    tree = Tree(buckets=4096, fan=64)
    known = digest(source, "k", "amount", tree).persist()
    per_bucket, joined = 40_000 / tree.buckets, {}
    for n in (0, 5, 50):
        hit = F.col("k") % (40_000 // n) == 7 if n else F.lit(False)
        target = source.withColumn("amount", F.when(hit, F.col("amount") + 9).otherwise(F.col("amount")).cast("decimal(12,2)"))
        buckets = differing(known, digest(target, "k", "amount", tree), tree).persist()
        assert buckets.count() <= n
        joined[n] = in_question(source, "k", buckets, tree).count()
        assert issues(reconcile_by_digest(source, target, "k", "amount", tree=tree, source_digest=known)) == issues(
            reconcile_keys(source, target, "k", "amount"))
    assert joined[0] == 0 and joined[5] <= 5 * 3 * per_bucket and joined[50] <= 50 * 2 * per_bucket


def test_hot_and_null_keys_and_empty_sides(spark):
    hot = spark.range(3000).select(F.lit(None).cast("long").alias("k"), F.lit("1.00").cast("decimal(12,2)").alias("amount"))
    none = spark.createDataFrame([], ROWS)
    for a, b in ((hot, hot), (hot, none), (none, hot), (none, none)):
        assert issues(reconcile_by_digest(a, b, "k", "amount", tree=SMALL)) == issues(reconcile_keys(a, b, "k", "amount"))
    bare = spark.createDataFrame([("a",), ("b",), ("b",)], "k string")
    assert issues(reconcile_by_digest(bare, bare, "k", tree=SMALL)) == issues(reconcile_keys(bare, bare, "k"))


def test_rows_are_dealt_once_for_counts_and_join(spark):
    """The full outer join takes the partitions of the counts (NULL is a key
    like any other), and a digest's buckets those of its keys."""
    from tests.test_skew import _plan
    a = spark.createDataFrame([(None, 1), (None, 2), ("x", 3), ("y", 4)], "k string, n int").withColumn("n", F.col("n").cast("decimal(12,2)"))
    b = spark.createDataFrame([(None, 1), ("x", 3), ("z", 4)], "k string, n int").withColumn("n", F.col("n").cast("decimal(12,2)"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = reconcile_keys(a, b, "k", "n")
        assert _plan(found).count("Exchange hashpartitioning") == 2
        assert _plan(digest(a, "k", "n")).count("Exchange hashpartitioning") == 1
        assert {tuple(r)[1:] for r in found.collect()} == {
            (None, "duplicate_source_key", 2, 1), (None, "amount_mismatch", 2, 1), ("y", "missing_in_target", 1, 0), ("z", "unexpected_in_target", 0, 1)}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
