import random
import uuid

import pytest
from pyspark.sql import functions as F

from vellum.operators.versions import KeyedTable
from vellum.session import work_dir


def table(spark, key="k"):
    return KeyedTable(spark, work_dir(spark, f"versions-{uuid.uuid4().hex[:8]}"), key)


def rows(spark, pairs):
    return spark.createDataFrame(list(pairs), "k long, v string")


def got(df):
    return sorted(((r.k, r.v) for r in df.collect()), key=repr)


def keys(spark, values):
    return spark.createDataFrame([(k,) for k in values], "_key long")


def bytes_by_load(t, version):
    return {r.load: r.b for r in t.manifest(version).groupBy("load").agg(F.sum("bytes").alias("b")).collect()}


def test_appending_one_percent_writes_about_one_percent(spark):
    t = table(spark)
    wide = spark.range(200_000).select(F.col("id").alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
    first = t.replace(wide)
    second = t.append(spark.range(200_000, 202_000).select(F.col("id").alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v")))
    size = bytes_by_load(t, second)
    assert size[first] == bytes_by_load(t, first)[first]      # the old files are shared
    assert size[second] < 0.02 * size[first]
    assert t.read(first).count() == t.row_count(first) == 200_000
    assert t.read(second).count() == t.row_count(second) == 202_000
    assert t.watermark(first) == 199_999 and t.watermark(second) == 201_999


def test_merge_rewrites_only_files_that_hold_a_touched_key(spark):
    """Keys 0, 10, 20, ...: a new key inside a file's range does not rewrite the file."""
    t = table(spark)
    for low in range(0, 800, 100):
        t.append(rows(spark, ((k, "old") for k in range(low, low + 100, 10))))
    before = t.current()
    files = {r.file: (r.low, r.high) for r in t.manifest(before).collect()}
    after = t.merge(keys(spark, [110, 355, 790, 9_000]), rows(spark, [(110, "new"), (355, "added")]))
    left = {r.file for r in t.manifest(after).collect()}
    gone = [files[f] for f in files if f not in left]
    assert all(any(low <= k <= high for k in (110, 790)) for low, high in gone) and gone
    assert not any(low <= 355 <= high for low, high in gone)
    want = {k: "old" for k in range(0, 800, 10)}
    assert got(t.read(before)) == sorted(want.items(), key=repr)      # an old version keeps its rows
    want.update({110: "new", 355: "added"})
    del want[790]
    assert got(t.read(after)) == sorted(want.items(), key=repr)
    assert t.touched(keys(spark, [5, 9_999]), after) == []


@pytest.mark.parametrize("seed", [1, 2])
def test_random_loads_equal_a_dictionary(spark, seed):
    rng, t, want, seen = random.Random(seed), table(spark), {}, {}
    for step in range(6):
        some = [rng.choice([None, *range(60)]) for _ in range(rng.randint(1, 12))]
        some = list(dict.fromkeys(some))
        if step == 0:
            version = t.append(rows(spark, ((k, f"{step}") for k in some)))
            want = {k: f"{step}" for k in some}
        elif step == 4:
            version = t.compact(1 << 30)
        else:
            kept = [k for k in some if rng.random() < 0.8]
            version = t.merge(keys(spark, some), rows(spark, ((k, f"{step}") for k in kept)))
            want = {k: v for k, v in want.items() if k not in some} | {k: f"{step}" for k in kept}
        seen[version] = dict(want)
    for version, state in seen.items():
        assert got(t.read(version)) == sorted(state.items(), key=repr)
    some = [None, *range(0, 60, 7)]
    assert got(t.rows_of(keys(spark, some), version)) == sorted(((k, v) for k, v in want.items() if k in some), key=repr)


def test_repeated_keys_move_together(spark):
    t = table(spark)
    t.append(rows(spark, [(1, "a"), (1, "b"), (2, "c")]))
    t.append(rows(spark, [(1, "d"), (3, "e")]))
    t.merge(keys(spark, [1, 1]), rows(spark, [(1, "f")]))
    assert got(t.read()) == [(1, "f"), (2, "c"), (3, "e")]


def test_feed_compaction_and_tags(spark):
    t = table(spark)
    assert t.current() is None and t.read() is None and t.version_of("a") is None
    one = t.append(rows(spark, [(1, "a"), (5, "b")]), tag="load-1")
    two = t.append(rows(spark, [(2, "c")]))
    three = t.append(rows(spark, [(9, "d")]), tag="load-3")
    assert got(t.added(one, three)) == [(2, "c"), (9, "d")] and got(t.added(None, two)) == [(1, "a"), (2, "c"), (5, "b")]
    assert got(t.added(three, three)) == []
    assert (t.version_of("load-1"), t.version_of("load-3"), t.version_of("load-2")) == (one, three, None)
    packed = t.compact(1 << 30, upto=two)
    assert packed == three + 1 and got(t.added(two, packed)) == [(9, "d")]
    assert got(t.read(packed)) == got(t.read(three)) and t.manifest(packed).count() < t.manifest(three).count()
    assert t.compact(1) == packed                                # nothing small: no new version


def test_schema_and_abandoned_loads(spark):
    t = table(spark)
    t.append(rows(spark, [(1, "a")]))
    with pytest.raises(ValueError, match="schema change"):
        t.append(spark.createDataFrame([(1, 2)], "k long, v long"))
    # a load that died before its commit: files and a manifest that no version names
    t._write(rows(spark, [(7, "lost")]), "append", 2)
    rows(spark, [(7, "lost")]).write.parquet(f"{t.base}/manifest/v=2")
    assert t.current() == 1 and got(t.read()) == [(1, "a")]
    assert t.append(rows(spark, [(2, "b")])) == 3 and got(t.read()) == [(1, "a"), (2, "b")]
    empty = t.append(rows(spark, [(3, "c")]).limit(0))
    assert got(t.read(empty)) == [(1, "a"), (2, "b")]
    with pytest.raises(ValueError, match="no version"):
        t.read(99)
