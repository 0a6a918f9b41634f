"""Operators against brute-force Python on random small inputs."""
import collections
from decimal import Decimal as D

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vellum.operators import quality as Q
from vellum.operators.incremental import apply_changes, change_set
from vellum.operators.numbering import number_rows
from vellum.operators.reconcile import reconcile_keys

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
rows = st.lists(st.tuples(st.integers(0, 6), st.integers(0, 3)), max_size=25)


def brute_reconcile(src, tgt):
    s, t = collections.defaultdict(list), collections.defaultdict(list)
    for k, a in src:
        s[k].append(a)
    for k, a in tgt:
        t[k].append(a)
    out = set()
    for k in set(s) | set(t):
        if k in s and k not in t:
            out.add((str(k), "missing_in_target"))
        if k in t and k not in s:
            out.add((str(k), "unexpected_in_target"))
        if len(s.get(k, [])) > 1:
            out.add((str(k), "duplicate_source_key"))
        if len(t.get(k, [])) > 1:
            out.add((str(k), "duplicate_target_key"))
        if k in s and k in t and any(abs(x - y) >= 1 for x in s[k] for y in t[k]):
            out.add((str(k), "amount_mismatch"))
    return out


@SETTINGS
@given(src=rows, tgt=rows)
def test_reconcile_keys_matches_pairwise_definition(spark, src, tgt):
    schema = "k long, a decimal(12,2)"
    s = spark.createDataFrame([(k, D(a)) for k, a in src], schema)
    t = spark.createDataFrame([(k, D(a)) for k, a in tgt], schema)
    got = {(r.record_key, r.issue_type) for r in reconcile_keys(s, t, "k", "a", tolerance="1").collect()}
    assert got == brute_reconcile(src, tgt)


maybe = st.one_of(st.none(), st.integers(0, 2))
wide_rows = st.lists(st.tuples(maybe, maybe, maybe), max_size=20)


@SETTINGS
@given(old=wide_rows, new=wide_rows)
def test_change_set_matches_multisets(spark, old, new):
    """NULLs in every column, the key included."""
    schema = "k long, v long, w long"
    o, n = spark.createDataFrame(old, schema), spark.createDataFrame(new, schema)
    got = {(r.record_key, r.change_type) for r in change_set(o, n, "k").collect()}
    om, nm = collections.defaultdict(collections.Counter), collections.defaultdict(collections.Counter)
    for side, counts in ((old, om), (new, nm)):
        for k, *values in side:
            counts[k][tuple(values)] += 1
    want = set()
    for k in {*om, *nm}:
        if om[k] != nm[k]:
            want.add((None if k is None else str(k), "new" if not om[k] else "removed" if not nm[k] else "changed"))
    assert got == want
    merged = collections.Counter(tuple(r) for r in apply_changes(o, n, "k").collect())
    assert merged == collections.Counter(new)


@SETTINGS
@given(values=st.lists(st.tuples(st.integers(0, 3), st.integers(0, 10 ** 6)), min_size=1, max_size=60, unique=True))
def test_number_rows_matches_sorted_enumeration(spark, values):
    df = spark.createDataFrame(values, "g long, v long")
    got = [(r.g, r.v) for r in number_rows(df, [F.col("g").desc(), F.col("v")], "n", partitions=5)
           .orderBy("n").collect()]
    assert got == sorted(values, key=lambda x: (-x[0], x[1]))


@SETTINGS
@given(parent=st.lists(st.one_of(st.none(), st.integers(0, 5)), max_size=15),
       child=st.lists(st.one_of(st.none(), st.integers(0, 8)), max_size=25))
def test_gate_counts_match_sql_semantics(spark, parent, child):
    p = spark.createDataFrame([(x,) for x in parent], "id long")
    c = spark.createDataFrame([(x,) for x in child], "pid long")
    rep = {r.check_name: r.incidents for r in Q.report(
        [Q.duplicate_key("dup", "p", "id"), Q.null_key("nul", "p", "id"), Q.orphan("orph", "c", "pid", "p", "id")],
        {"p": p, "c": c}).collect()}
    counts = collections.Counter(parent)
    assert rep["dup"] == sum(1 for n in counts.values() if n > 1)          # GROUP BY groups NULLs too
    assert rep["nul"] == parent.count(None)
    present = {x for x in parent if x is not None}
    assert rep["orph"] == sum(1 for x in child if x is None or x not in present)   # NOT EXISTS


trip_rows = st.lists(st.tuples(
    st.integers(0, 3),                                   # pickup day offset
    st.integers(-2, 2),                                  # drop-off minus pick-up, hours
    st.one_of(st.none(), st.integers(-3, 30)),           # distance
    st.one_of(st.none(), st.integers(-500, 5000))),      # total, cents
    max_size=30)


@SETTINGS
@given(rows=trip_rows)
def test_trip_acceptance_accounts_for_every_row(spark, rows):
    import datetime as dt

    from vellum.plans import trips
    base = dt.datetime(2024, 1, 1, 12)
    data = [(base + dt.timedelta(days=d), base + dt.timedelta(days=d, hours=h), 1.0,
             None if dist is None else float(dist), None if cents is None else cents / 100)
            for d, h, dist, cents in rows]
    raw = spark.createDataFrame(data, "pickup_at timestamp_ntz, dropoff_at timestamp_ntz, passenger_count double, "
                                      "trip_distance double, total_amount double")
    r = trips.quality_report(raw).first()
    assert r.raw_rows == len(rows) == r.staged_rows + r.dropped_rows
    assert r.dropped_rows == r.invalid_rows_detected + r.null_measure_rows
    assert r.invalid_rows_after_cleaning == 0
    daily = trips.daily_metrics(trips.staged_trips(raw)).collect()
    assert sum(x.trip_count for x in daily) == r.staged_rows
    staged = [t for t in data if t[1] >= t[0] and t[3] is not None and t[3] >= 0 and t[4] is not None and t[4] >= 0]
    assert len(staged) == r.staged_rows
