import json
import uuid

import pytest
from pyspark.sql import functions as F

from vellum import contracts
from vellum.operators import quality as Q
from vellum.plans import migration, pipeline
from vellum.session import work_dir
from vellum.sources import files

SF = "/root/testdata/sf0.001"


def _out(spark, name):
    return work_dir(spark, f"{name}-{uuid.uuid4().hex[:8]}")


def _row(df):
    return json.loads(df.toJSON().first())


def _csv(spark, folder, **tables):
    """A folder of one CSV file an entity, as users deliver them."""
    for name, lines in tables.items():
        spark.createDataFrame([(x,) for x in lines.strip().split("\n")], "value string").coalesce(1).write.text(f"{folder}/{name}.csv")
    return folder


def _orders_csv(n):
    """n orders of two lines each, every third of them late, every fourth partly refunded."""
    return {
        "customers": "customer_id,full_name,email,country,registered_date\n" + "\n".join(
            f"{c}, Name {c} ,C{c}@Shop.example,pt,2030-01-0{c}" for c in (1, 2, 3)),
        "products": "product_id,product_name,category,unit_price\n1,Lamp,Home,12.5\n2,Rope,Garden,3.25",
        "orders": "order_id,customer_id,order_date,order_status,shipping_country\n" + "\n".join(
            f"{i},{i % 3 + 1},2030-02-{i % 28 + 1:02d},Delivered,pt" for i in range(n)),
        "order_items": "order_item_id,order_id,product_id,quantity,unit_price\n" + "\n".join(
            f"{i}-{p},{i},{p},{p},{price}" for i in range(n) for p, price in ((1, 12.5), (2, 3.25))),
        "payments": "payment_id,order_id,payment_method,payment_status,amount\n" + "\n".join(f"P{i},{i},card,paid,19.0" for i in range(n)),
        "shipments": "shipment_id,order_id,carrier,promised_delivery_date,actual_delivery_date,shipping_cost,shipment_status\n" + "\n".join(
            f"S{i},{i},ups,2030-03-10,2030-03-{12 if i % 3 == 0 else 9:02d},4.5,delivered" for i in range(n)),
        "refunds": "refund_id,order_id,refund_date,refund_reason,refund_status,amount\n" + "\n".join(
            f"R{i},{i},2030-04-01,damaged,processed,5.0" for i in range(0, n, 4)),
    }


def test_revenue_run_on_csv_files_appends_new_orders(spark):
    out = _out(spark, "revenue-csv")
    first = pipeline.run_revenue(spark, None, out, source_dir=_csv(spark, _out(spark, "shop"), **_orders_csv(36)))
    assert first["quality_status"] == "passed" and first["gold_rows"]["fact_order"] == 36
    assert (first["completed_orders"], first["revenue_leakage"]) == (36, 12 * 4.5 + 9 * 5.0)
    assert first["completed_net_revenue"] == 36 * 19.0 - 9 * 5.0
    grown = _csv(spark, _out(spark, "shop"), **_orders_csv(40))
    second = pipeline.run_revenue(spark, None, out, incremental_load=True, source_dir=grown)
    assert second["pipeline_mode"] == "incremental" and second["gold_rows"]["fact_order"] == 40
    assert second["completed_net_revenue"] == 40 * 19.0 - 10 * 5.0


def test_revenue_intake_names_missing_files_and_sets_bad_lines_aside(spark):
    tables = _orders_csv(4)
    tables["payments"] += "\nP9,not a number,card,paid,1.0"
    tables["products"] += "\n3,Sold below zero,Home,-1.0"
    with pytest.raises(FileNotFoundError, match="orders.csv, payments.csv"):
        pipeline.run_revenue(spark, None, _out(spark, "x"), source_dir=_csv(
            spark, _out(spark, "shop"), **{k: v for k, v in tables.items() if k not in ("orders", "payments")}))
    out = _out(spark, "revenue-csv")
    assert pipeline.run_revenue(spark, None, out, source_dir=_csv(spark, _out(spark, "shop"), **tables))["bronze_rows"]["payments"] == 4
    lines = spark.read.parquet(f"{out}/quarantine/revenue_lines").collect()
    assert [(r.entity, r.line) for r in lines] == [("payments", "P9,not a number,card,paid,1.0")]
    rows = spark.read.parquet(f"{out}/quarantine/rows").collect()
    assert [(r.entity, r.record_key, r.reasons) for r in rows] == [("products", "3", ["negative_price"])]


CLIENT_CSV = {
    "accounts": "account_id,account_name,plan,country,signup_date,account_status,monthly_recurring_revenue\n"
                "1,Elm,Pro,se,2030-01-02,active,80\n2,Oak,Pro,se,2030-01-03,Churned,40\n3,Ash,Basic,fi,2030-02-01,trial,0",
    "invoices": "invoice_id,account_id,invoice_date,amount,invoice_status\nI1,1,2030-03-01,80,paid\nI2,2,2030-03-01,40,overdue",
    "support_tickets": "ticket_id,account_id,created_date,resolved_date,priority,ticket_status\n"
                       "T1,1,2030-03-02,2030-03-03,low,resolved\nT2,3,2030-03-05,,high,open",
    "account_events": "event_id,account_id,event_date,event_type\nE1,3,2030-02-01,trial_started\nE2,3,2030-02-09,activated",
}


def test_client_run_is_accepted_and_publishes_its_models(spark):
    out = _out(spark, "client-csv")
    row = pipeline.run_client(spark, None, out, "grove", "2030-03-31", source_dir=_csv(spark, _out(spark, "grove"), **CLIENT_CSV))
    assert (row["delivery_id"], row["delivery_status"], row["reporting_period"]) == ("grove-2030-03", "accepted", "2030-03")
    assert row["quality_gate"]["status"] == "passed" and row["quality_gate"]["score"] == 100
    assert set(row["quality_gate"]["checks"].values()) == {0} and len(row["quality_gate"]["checks"]) == 10
    assert row["quality_gate"]["source_rows"] == {"accounts": 3, "invoices": 2, "support_tickets": 2, "account_events": 2}
    assert row["sla"]["status"] == "within_target"
    card = row["scorecard"]
    assert (card["mrr"], card["collection_rate"], card["logo_churn_rate"], card["support_sla_rate"]) == (80.0, 50.0, 50.0, 100.0)
    health = {r.account_id: r.health_segment for r in spark.read.parquet(f"{out}/gold/gold_account_health").collect()}
    assert health == {1: "healthy", 2: "churned", 3: "needs_attention"}
    assert spark.read.parquet(f"{out}/gold/gold_daily_operations").count() == 3


MIGRATION_CSV = {
    "accounts": "account_id,account_name,country,created_date,monthly_value\n1,Elm,se,2030-01-02,80\n2,Oak,se,2030-01-03,40",
    "invoices": "invoice_id,account_id,invoice_date,amount,invoice_status\nI1,1,2030-03-01,80,paid\nI2,2,2030-03-01,40,open",
    "transactions": "transaction_id,account_id,transaction_date,amount,transaction_type\nX1,1,2030-03-01,80.00,sale",
    "contacts": "contact_id,account_id,email,country,contact_status\nC1,1,a@elm.example,se,active\nC2,2,b@oak.example,se,active",
}


def test_migration_run_ready_and_held(spark):
    def run(target):
        base = _out(spark, "move")
        _csv(spark, f"{base}/source", **MIGRATION_CSV)
        _csv(spark, f"{base}/target", **target)
        out = _out(spark, "migration-csv")
        return pipeline.run_migration(spark, None, out, "MOVE-7", source_dir=base), out

    row, _ = run(MIGRATION_CSV)
    assert (row["migration_id"], row["cutover_decision"], row["delivery_status"]) == ("MOVE-7", "READY", "ready_for_signoff")
    assert row["exceptions_by_severity"] == {} and {r["reconciliation_status"] for r in row["reconciliation"]} == {"passed"}
    review = dict(MIGRATION_CSV, invoices=MIGRATION_CSV["invoices"].replace("I2,2,2030-03-01,40", "I2,2,2030-03-01,45"),
                  contacts=MIGRATION_CSV["contacts"].rsplit("\n", 1)[0])
    row, out = run(review)
    assert (row["cutover_decision"], row["exceptions_by_severity"]) == ("HOLD", {"high": 1, "medium": 1})
    assert [c["status"] for c in row["checklist"]] == ["passed", "passed", "review", "blocked", "pending", "pending"]
    queue = spark.read.parquet(f"{out}/gold/gold_exception_queue").orderBy("exception_id").collect()
    assert [(r.exception_id, r.entity, r.record_key, r.issue_type) for r in queue] == [
        (1, "contacts", "C2", "missing_in_target"), (2, "invoices", "I2", "amount_mismatch")]
    with pytest.raises(FileNotFoundError, match="source/accounts.csv, .*target/contacts.csv"):
        pipeline.run_migration(spark, None, _out(spark, "x"), source_dir=_out(spark, "nothing"))


def test_revenue_run_full_then_incremental(spark):
    out = _out(spark, "revenue")
    first = pipeline.run_revenue(spark, SF, out)
    assert first["pipeline_mode"] == "full_refresh" and first["quality_status"] == "passed"
    assert set(first["quality_checks"].values()) == {0} and first["data_tests"] == 23
    assert first["gold_rows"]["fact_order"] == first["silver_rows"]["orders"]
    again = pipeline.run_revenue(spark, SF, out, incremental_load=True)
    # same input: nothing above the watermark, the fact is unchanged
    assert again["gold_rows"]["fact_order"] == first["gold_rows"]["fact_order"]
    assert again["completed_net_revenue"] == first["completed_net_revenue"]
    latest = pipeline.latest_run(spark, out)
    assert latest["pipeline_mode"] == "incremental"
    upserted = pipeline.run_revenue(spark, SF, out, upsert=True)
    # same input again: the change set is empty and the fact is unchanged
    assert upserted["fact_changes"] == {} and upserted["pipeline_mode"] == "upsert"
    assert upserted["gold_rows"]["fact_order"] == first["gold_rows"]["fact_order"]


def test_client_run_stops_at_the_gate(spark):
    # accounts with a negative balance are dropped by silver, so their
    # invoices and tickets become orphans and nothing is published
    out = _out(spark, "client")
    with pytest.raises(Q.QualityGateError) as err:
        pipeline.run_client(spark, SF, out)
    assert err.value.report["orphan_invoices"] > 0
    assert not files.exists(spark, f"{out}/gold")


def test_trips_run(spark):
    out = _out(spark, "trips")
    s = pipeline.run_trips(spark, SF, out)
    assert s["quality"]["passed"] and s["metric_days"] > 0
    with pytest.raises(ValueError):
        pipeline.run_trips(spark, SF, out, month="2024-13")


def test_required_inputs_and_contract(spark):
    out = _out(spark, "inputs")
    files.write_parquet(spark.range(3), f"{out}/present")
    files.require_inputs(spark, {"present": f"{out}/present"})
    with pytest.raises(FileNotFoundError, match="missing_a, missing_b"):
        files.require_inputs(spark, {"present": f"{out}/present", "missing_a": f"{out}/a", "missing_b": f"{out}/b"})
    df = spark.createDataFrame([(1, "x")], "order_id long, extra string")
    issues = contracts.check_schemas({"orders": df}, {"orders": contracts.REVENUE["orders"]})
    kinds = {(i["column"], i["issue"]) for i in issues}
    assert ("extra", "extra") in kinds and ("order_status", "missing") in kinds


def test_migration_manifest(spark):
    from tests.test_migration import snapshots
    m = snapshots(spark)
    recon = migration.reconciliation(m)
    queue = migration.exception_queue(m)
    gold = {"gold_reconciliation": recon, "gold_exception_queue": queue,
            "gold_cutover_readiness": migration.cutover_readiness(queue, recon)}
    row = _row(pipeline.migration_manifest(gold, migration.quality_report(m), "MIG-1", 1.0, 24))
    assert row["cutover_decision"] == "HOLD" and row["delivery_status"] == "review_required"
    assert row["exceptions_by_severity"] == {"high": 4, "medium": 1}
    assert [c["status"] for c in row["checklist"]] == ["passed", "passed", "review", "blocked", "pending", "pending"]
    assert len(row["reconciliation"]) == 4 and row["sla"]["status"] == "within_target"


def test_delivery_manifest_of_a_failed_gate(spark):
    from tests.test_client import silver
    from vellum.plans import client, evidence
    s = silver(spark)
    report = client.quality_report(s).withColumn("incidents", F.when(F.col("check_name") == "orphan_events", 3).otherwise(F.col("incidents")))
    row = _row(pipeline.delivery_manifest(client.client_scorecard(s), evidence.layer_counts({"bronze": s.bronze}), report,
                                          "acme", "2025-03-31", 90000.5, 24))
    assert (row["delivery_id"], row["reporting_period"], row["delivery_status"]) == ("acme-2025-03", "2025-03", "held")
    assert row["quality_gate"]["score"] == 90 and row["quality_gate"]["checks"]["orphan_events"] == 3
    assert row["quality_gate"]["source_rows"]["accounts"] == 5
    assert row["scorecard"]["active_accounts"] == 2 and row["sla"]["status"] == "missed"


def test_trips_run_reads_the_month_file(spark):
    """A month's file goes through raw, staged and metrics, all of them written."""
    import datetime as dt

    from vellum.plans import trips
    src, out = _out(spark, "months"), _out(spark, "trips-file")
    start = dt.datetime(2031, 7, 4, 23, 50)
    values = {"tpep_pickup_datetime": start, "tpep_dropoff_datetime": start + dt.timedelta(minutes=25), "trip_distance": 7.125, "total_amount": 31.4}
    source = spark.range(2).select(*[F.lit(values.get(n, 1)).cast(
        "timestamp_ntz" if t == "timestamp_ntz" else "long" if t == "int" else "double").alias(n) for n, _, t in trips.TRIP_COLUMNS])
    source.write.parquet(files.monthly_file(src, "2031-07"))
    s = pipeline.run_trips(spark, None, out, month="2031-07", source_dir=src)
    assert s["quality"]["raw_rows"] == 2 and s["metric_days"] == 1
    assert spark.read.parquet(f"{out}/raw").count() == spark.read.parquet(f"{out}/staged").count() == 2
    assert spark.read.parquet(f"{out}/daily_metrics").first().avg_trip_distance == 7.13
    with pytest.raises(FileNotFoundError):
        pipeline.run_trips(spark, None, _out(spark, "trips-file"), month="2031-08", source_dir=src)
    source.drop("total_amount").write.parquet(files.monthly_file(src, "2031-09"))
    with pytest.raises(ValueError, match="total_amount"):
        pipeline.run_trips(spark, None, _out(spark, "trips-file"), month="2031-09", source_dir=src)


def test_migration_run_stops_at_the_source_gate(spark):
    # accounts with a negative monthly value are dropped by silver, so the
    # invoices and transactions of those accounts are orphans in the source
    out = _out(spark, "migration")
    with pytest.raises(Q.QualityGateError) as err:
        pipeline.run_migration(spark, SF, out)
    assert err.value.report["orphan_source_invoices"] > 0
    assert err.value.report["duplicate_source_accounts"] == 0
    assert not files.exists(spark, f"{out}/gold")
