"""The gate over loads against the full gate over all rows."""
import random
import uuid

import pytest
from pyspark.sql import functions as F

from vellum.operators import key_index
from vellum.operators import quality as Q
from vellum.operators.key_index import KeyIndex, key_counts
from vellum.operators.load_gate import LoadGate
from vellum.session import work_dir

PARENT, CHILD = "pid long, name string", "cid string, pid long, kind string, amount long"


def checks():
    return [
        Q.null_key("null_ids", "parents", "pid"),
        Q.duplicate_key("dup_parents", "parents", "pid"),
        Q.duplicate_key("dup_children", "children", "cid"),
        Q.orphan("orphans", "children", "pid", "parents"),
        Q.domain("kinds", "children", "kind", ("a", "b"), null_violates=True),
        Q.row_rule("negative", "children", F.col("amount") < 0),
    ]


def folder(spark):
    return work_dir(spark, f"gate-{uuid.uuid4().hex[:8]}")


def full(spark, parents, children):
    tables = {"parents": spark.createDataFrame(parents, PARENT), "children": spark.createDataFrame(children, CHILD)}
    return {r["check_name"]: r["incidents"] for r in Q.report(checks(), tables).collect()}


def frames(spark, parents, children):
    load = {}
    if parents is not None:
        load["parents"] = spark.createDataFrame(parents, PARENT)
    if children is not None:
        load["children"] = spark.createDataFrame(children, CHILD)
    return load


@pytest.mark.parametrize("seed", [1, 2])
def test_every_load_reports_as_the_full_gate(spark, seed, monkeypatch):
    """Random loads with repeated, NULL and late keys; one entity may be missing or empty."""
    monkeypatch.setattr(key_index, "PER_FILE", 8)  # several key files a segment
    rng = random.Random(seed)
    gate = LoadGate(spark, folder(spark), checks())
    all_p, all_c = [], []
    for step in range(4):
        p = [(rng.choice([None, *range(40)]) if rng.random() < 0.3 else rng.randint(40, 90), "n") for _ in range(rng.randint(0, 20))]
        c = [(rng.choice([None, *map(str, range(60))]), rng.choice([None, *range(100)]), rng.choice(["a", "b", "z", None]),
              rng.randint(-1, 9)) for _ in range(rng.randint(0, 25))]
        if step == 2:
            p, c = (None, c) if seed == 1 else (p, None)
        all_p, all_c = all_p + (p or []), all_c + (c or [])
        load = frames(spark, p, c)
        want = full(spark, all_p, all_c)
        if step % 2:
            assert {r["check_name"]: r["incidents"] for r in gate.report(load).collect()} == want
        assert gate.accept(load, tag=f"load-{step}") == want
        if step == 1:
            gate.compact()
    assert gate.accept(frames(spark, [(1, "again")], None), tag="load-3") == want  # taken once
    assert {r["check_name"]: r["incidents"] for r in gate.report({}).collect()} == want


def test_a_held_load_leaves_no_trace(spark):
    gate = LoadGate(spark, folder(spark), checks())
    gate.accept(frames(spark, [(1, "x"), (2, "y")], [("c1", 1, "a", 1)]), hold=True)
    before = gate.state()
    with pytest.raises(Q.QualityGateError) as held:
        gate.accept(frames(spark, [(2, "y")], [("c2", 9, "a", 1)]), hold=True)
    assert held.value.report["dup_parents"] == held.value.report["orphans"] == 1
    assert gate.state() == before
    assert set(gate.accept(frames(spark, [(9, "z")], [("c2", 9, "a", 1)]), hold=True).values()) == {0}


def test_lookups_read_only_files_that_may_hold_a_key(spark, monkeypatch):
    monkeypatch.setattr(key_index, "PER_FILE", 1_000)
    base = folder(spark)
    index = KeyIndex(spark, base)
    index.segments.append(index.add(key_counts(spark.range(0, 40_000, 2), "id")))
    index.segments.append(index.add(key_counts(spark.range(100_000, 101_000).union(spark.range(100_000, 100_010)), "id")))
    assert index.segments[0].files == 20

    def ask(df):
        rows, read = index.held(key_counts(df, "id"))
        return {r["_key"]: r["_held"] for r in rows.collect()}, read

    assert ask(spark.range(200_000, 210_000)) == ({}, [])          # above all ranges
    found, read = ask(spark.range(1, 2_001, 2))                    # inside, but absent
    assert found == {} and len(read) <= 20                         # only false alarms of the filter are looked up
    maybe = index._perhaps(key_counts(spark.range(1, 40_001, 2), "id"), index.segments[:1]).count()
    assert maybe < 0.01 * 20_000
    found, read = ask(spark.range(100_005, 100_007).union(spark.range(4, 5)))
    assert found == {4: 1, 100_005: 2, 100_006: 2} and len(read) <= 3
    rows, read = index.held(key_counts(spark.createDataFrame([(None,)], "id long"), "id"))
    assert rows.collect() == [] and read == []


def test_keys_without_an_order_in_the_log_and_null_keys(spark):
    index = KeyIndex(spark, folder(spark))
    days = spark.sql("SELECT explode(array(DATE'2020-01-01', DATE'2020-01-02', NULL)) AS d")
    index.segments.append(index.add(key_counts(days.union(days), "d")))
    rows, _ = index.held(key_counts(days.where("d IS NULL OR d > '2020-01-01'"), "d"))
    assert sorted((str(r["_key"]), r["_held"]) for r in rows.collect()) == [("2020-01-02", 2), ("None", 2)]
    assert index.add(key_counts(days.where("false"), "d")) is None
