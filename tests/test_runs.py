import json

import pytest
from pyspark.sql import functions as F

from tests.test_pipeline import CLIENT_CSV, _csv, _orders_csv, _out
from vellum.operators import quality as Q
from vellum.plans import pipeline, runs
from vellum.plans.runs import Run
from vellum.sources import files


class Killed(BaseException):
    """The driver dies here."""


def _killed_after(monkeypatch, stop):
    real = Run.record

    def record(self, step, detail=None):
        out = real(self, step, detail)
        if step == stop:
            raise Killed(step)
        return out

    monkeypatch.setattr(Run, "record", record)


def _client(spark, out, source):
    return pipeline.run_client(spark, None, out, "grove", "2030-03-31", source_dir=source)


def _seen(spark, out):
    """What readers of the published run see of silver and gold."""
    silver = {r.account_id: r.monthly_recurring_revenue for r in runs.read_published(spark, out, "silver", "accounts").collect()}
    gold = {r.account_id: r.health_segment for r in runs.read_published(spark, out, "gold", "gold_account_health").collect()}
    return silver, gold


def _jobs(spark):
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(None))


CHANGED = dict(CLIENT_CSV, accounts=CLIENT_CSV["accounts"].replace("active,80", "active,95").replace("trial,0", "churned,0"))
STOPS = ("intake/client_accounts", "bronze/accounts", "silver/invoices", "gate/report", "gold/gold_account_health", "tests")


def test_a_run_killed_anywhere_leaves_the_published_run_and_is_taken_over(spark, monkeypatch):
    out, first, second = _out(spark, "runs"), _csv(spark, _out(spark, "grove"), **CLIENT_CSV), _csv(spark, _out(spark, "grove"), **CHANGED)
    before = _jobs(spark)
    _client(spark, out, first)
    whole = _jobs(spark) - before
    old, pointer = _seen(spark, out), runs.published(spark, out)
    assert old[0][1] == 80 and old[1][3] == "needs_attention"
    for stop in STOPS:
        with monkeypatch.context() as m:
            _killed_after(m, stop)
            with pytest.raises(Killed):
                _client(spark, out, second)
        assert runs.published(spark, out) == pointer and _seen(spark, out) == old
    before = _jobs(spark)
    row = _client(spark, out, second)
    assert _jobs(spark) - before < 0.5 * whole        # only what was missing
    assert row["scorecard"]["mrr"] == 95.0
    new = _seen(spark, out)
    assert new[0][1] == 95 and new[1][3] == "churned" and runs.published(spark, out)["number"] == 2
    steps = runs.journal(spark, out).groupBy("run").agg(F.count("step").alias("n"), F.count_distinct("step").alias("d")).collect()
    assert len(steps) == 2 and all(r.n == r.d for r in steps)   # one run took over all the attempts; no step ran twice
    # the deliverables at their place are the published ones
    assert {r.account_id: r.health_segment for r in spark.read.parquet(f"{out}/gold/gold_account_health").collect()} == new[1]
    # a finished run is not taken over: the same inputs make a new one
    _client(spark, out, second)
    assert runs.published(spark, out)["number"] == 3


def test_a_run_killed_after_the_pointer_moved_is_finished(spark, monkeypatch):
    out, source = _out(spark, "runs"), _csv(spark, _out(spark, "grove"), **CLIENT_CSV)
    with monkeypatch.context() as m:
        _killed_after(m, "published")
        with pytest.raises(Killed):
            _client(spark, out, source)
    pointer = runs.published(spark, out)
    assert pointer["number"] == 1 and not files.exists(spark, f"{out}/gold")
    row = _client(spark, out, source)
    assert runs.published(spark, out) == pointer and row["delivery_status"] == "accepted"
    assert spark.read.parquet(f"{out}/gold/gold_daily_operations").count() == 3
    assert pipeline.latest_run(spark, out)["delivery_id"] == row["delivery_id"]


def test_a_held_run_leaves_the_published_run(spark):
    out = _out(spark, "runs")
    _client(spark, out, _csv(spark, _out(spark, "grove"), **CLIENT_CSV))
    old, pointer = _seen(spark, out), runs.published(spark, out)
    orphan = _csv(spark, _out(spark, "grove"), **dict(CLIENT_CSV, invoices=CLIENT_CSV["invoices"] + "\nI3,77,2030-03-01,5,paid"))
    for _ in range(2):    # held again, as a run of its own
        with pytest.raises(Q.QualityGateError):
            _client(spark, out, orphan)
        assert runs.published(spark, out) == pointer and _seen(spark, out) == old
    held = [json.loads(r.detail) for r in runs.journal(spark, out).where("step = 'held'").collect()]
    assert [h["orphan_invoices"] for h in held] == [1, 1]


def test_a_fact_version_is_seen_once_its_run_is_published(spark, monkeypatch):
    out = _out(spark, "runs")
    pipeline.run_revenue(spark, None, out, source_dir=_csv(spark, _out(spark, "shop"), **_orders_csv(36)))
    assert pipeline.read_revenue_fact(spark, out).count() == 36
    grown = _csv(spark, _out(spark, "shop"), **_orders_csv(40))
    real = pipeline._load_fact
    with monkeypatch.context() as m:
        def load(*args):
            real(*args)
            raise Killed("after the version was committed, before the journal")

        m.setattr(pipeline, "_load_fact", load)
        with pytest.raises(Killed):
            pipeline.run_revenue(spark, None, out, incremental_load=True, source_dir=grown)
    table = pipeline.revenue_fact(spark, out)
    assert table.row_count(table.current()) == 40 and pipeline.read_revenue_fact(spark, out).count() == 36
    row = pipeline.run_revenue(spark, None, out, incremental_load=True, source_dir=grown)
    assert row["gold_rows"]["fact_order"] == 40 == pipeline.read_revenue_fact(spark, out).count()
    assert table.current() == runs.published(spark, out)["fact_version"] == 2    # appended once
    # a correction to an old order: the upsert shares the files without it
    fixed = _orders_csv(40)
    fixed["payments"] = fixed["payments"].replace("P7,7,card,paid,19.0", "P7,7,card,paid,1.0")
    row = pipeline.run_revenue(spark, None, out, upsert=True, source_dir=_csv(spark, _out(spark, "shop"), **fixed))
    assert row["fact_changes"] == {"changed": 1}
    assert {r.order_id: r.paid_amount for r in pipeline.read_revenue_fact(spark, out).collect()}[7] == 1
    loads = {r.load for r in table.manifest(table.current()).collect()}
    assert loads == {2, 3} or loads == {1, 2, 3}
