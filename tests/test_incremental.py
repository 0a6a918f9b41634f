import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from vellum.operators import incremental as inc
from vellum.session import work_dir
from vellum.streaming import incremental_stream as stream


def _orders(spark, ids):
    return spark.createDataFrame([(i, f"o{i}") for i in ids], "order_id long, note string")


def test_incremental_equals_full_refresh_on_append_only_input(spark):
    first = _orders(spark, range(1, 6))
    full = _orders(spark, range(1, 11))
    merged = inc.append_above_watermark(first, full, "order_id")
    assert sorted(r.order_id for r in merged.collect()) == list(range(1, 11))


def test_watermark_skips_late_keys(spark):
    first = _orders(spark, [1, 5])
    later = _orders(spark, [3, 6])
    assert inc.watermark(first, "order_id") == 5
    assert sorted(r.order_id for r in inc.append_above_watermark(first, later, "order_id").collect()) == [1, 5, 6]


def test_upsert_replaces_keys(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "order_id long, note string")
    new = spark.createDataFrame([(2, "B"), (3, "c")], "order_id long, note string")
    got = sorted((r.order_id, r.note) for r in inc.upsert(old, new, "order_id").collect())
    assert got == [(1, "a"), (2, "B"), (3, "c")]


def test_change_set(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k long, v string")
    new = spark.createDataFrame([(2, "b"), (3, "C"), (3, "C"), (4, "d")], "k long, v string")
    got = sorted((r.record_key, r.change_type) for r in inc.change_set(old, new, "k").collect())
    assert got == [("1", "removed"), ("3", "changed"), ("4", "new")]
    assert inc.change_set(old, old, "k").count() == 0


def test_versioned_write_moves_pointer_and_checks_schema(spark):
    base = work_dir(spark, f"t-{uuid.uuid4().hex[:8]}")
    assert inc.current_version(spark, base) is None
    v1 = inc.write_version(_orders(spark, [1, 2]), base)
    v2 = inc.write_version(_orders(spark, [1, 2, 3]), base, expected_schema=True)
    assert (v1, v2) == (1, 2) and inc.read_current(spark, base).count() == 3
    bad = spark.createDataFrame([(1,)], "order_id string")
    try:
        inc.write_version(bad, base, expected_schema=True)
        raise AssertionError("schema change accepted")
    except ValueError:
        pass
    assert inc.current_version(spark, base) == 2


@pytest.mark.parametrize("slices", [1, 5])
def test_stream_rows_do_not_depend_on_the_batches(spark, slices):
    """The same arrivals in one run or in five, keys in no order, id 0 among them."""
    landing, base, ckpt = (work_dir(spark, f"{n}-{uuid.uuid4().hex[:8]}") for n in ("land", "fact", "ckpt"))
    ids = [7, 0, 12, 3, 9, 1, 15, 4, 2, 11]
    for k in range(slices):
        _orders(spark, ids[k::slices]).write.mode("append").parquet(landing)
        stream.run_available(spark, landing, _orders(spark, [1]).schema,
                             lambda orders: orders.withColumn("note", F.upper("note")), base, ckpt)
    got = stream.read_fact(spark, base).collect()
    assert sorted((r.order_id, r.note) for r in got) == sorted((i, f"O{i}") for i in ids)


def test_stream_does_not_load_a_key_twice(spark):
    landing, base, ckpt = (work_dir(spark, f"{n}-{uuid.uuid4().hex[:8]}") for n in ("land", "fact", "ckpt"))
    for ids in ([1, 2], [2, 3]):
        _orders(spark, ids).write.mode("append").parquet(landing)
        stream.run_available(spark, landing, _orders(spark, [1]).schema, lambda orders: orders, base, ckpt)
    assert sorted(r.order_id for r in stream.read_fact(spark, base).collect()) == [1, 2, 3]


def test_first_load_has_no_watermark(spark):
    empty = _orders(spark, [])
    assert inc.watermark(empty, "order_id") is None
    got = inc.append_above_watermark(empty, _orders(spark, [0, -3, 5]), "order_id")
    assert sorted(r.order_id for r in got.collect()) == [-3, 0, 5]


def test_a_value_that_moves_to_another_column_is_a_change(spark):
    schema = "k long, promised date, actual date"
    day = dt.date(2024, 1, 5)
    old, new = spark.createDataFrame([(1, day, None)], schema), spark.createDataFrame([(1, None, day)], schema)
    assert [r.change_type for r in inc.change_set(old, new, "k").collect()] == ["changed"]
    assert inc.apply_changes(old, new, "k").collect() == new.collect()


def test_null_is_a_key(spark):
    schema = "order_id long, note string"
    old = spark.createDataFrame([(None, "a"), (1, "b")], schema)
    assert inc.change_set(old, old, "order_id").count() == 0
    new = spark.createDataFrame([(None, "A"), (1, "b")], schema)
    assert [(r.record_key, r.change_type) for r in inc.change_set(old, new, "order_id").collect()] == [(None, "changed")]
    assert sorted(r.note for r in inc.apply_changes(old, new, "order_id").collect()) == ["A", "b"]
    assert sorted(r.note for r in inc.upsert(old, new, "order_id").collect()) == ["A", "b"]


def test_apply_changes_picks_up_corrections_to_old_keys(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "order_id long, note string")
    cur = spark.createDataFrame([(1, "a"), (2, "B"), (4, "d")], "order_id long, note string")
    merged = sorted((r.order_id, r.note) for r in inc.apply_changes(old, cur, "order_id").collect())
    assert merged == [(1, "a"), (2, "B"), (4, "d")]                      # equals the current snapshot
    # the watermark load keeps the stale row 2 and the removed row 3
    stale = sorted((r.order_id, r.note) for r in inc.append_above_watermark(old, cur, "order_id").collect())
    assert stale == [(1, "a"), (2, "b"), (3, "c"), (4, "d")]
