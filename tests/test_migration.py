import datetime as dt
from decimal import Decimal as D

from pyspark.sql import functions as F

from vellum.operators.reconcile import reconcile_keys, reconcile_totals
from vellum.plans import migration

DATE = dt.date
ACC = "account_id long, account_name string, country string, created_date date, monthly_value double"
INV = "invoice_id string, account_id long, invoice_date date, amount double, invoice_status string"
TRX = "transaction_id string, account_id long, transaction_date date, amount double, transaction_type string"
CON = "contact_id string, account_id long, email string, country string, contact_status string"


def snapshots(spark, review=True):
    """Six accounts (2 and 4 both worth 20), six invoices, three transactions,
    four contacts. ``review`` reproduces the defects of the review scenario:
    account 2 lost and account 4 doubled (offsetting, D15), INV-2 lost,
    INV-4 doubled, INV-3 shifted by 35, contact C-4 lost."""
    acc = [(i, f"A{i}", "pt", DATE(2024, 1, 1), 20.0 if i in (2, 4) else 10.0 * i) for i in range(1, 7)]
    inv = [(f"INV-{i}", i, DATE(2025, 1, 1), 100.0 + i, "paid") for i in range(1, 7)]
    trx = [(f"T-{i}", i, DATE(2025, 1, 1), 5.0, "sale") for i in range(1, 4)]
    con = [(f"C-{i}", i, f"c{i}@x", "pt", "active") for i in range(1, 5)]
    t_acc, t_inv, t_con = list(acc), list(inv), list(con)
    if review:
        t_acc = [r for r in acc if r[0] != 2] + [acc[3]]
        t_inv = [r for r in inv if r[0] != "INV-2"] + [inv[3]]
        t_inv = [(k, a, d, amt + 35 if k == "INV-3" else amt, st) for k, a, d, amt, st in t_inv]
        t_con = [r for r in con if r[0] != "C-4"]
    rows = {("source", "accounts"): (acc, ACC), ("source", "invoices"): (inv, INV),
            ("source", "transactions"): (trx, TRX), ("source", "contacts"): (con, CON),
            ("target", "accounts"): (t_acc, ACC), ("target", "invoices"): (t_inv, INV),
            ("target", "transactions"): (trx, TRX), ("target", "contacts"): (t_con, CON)}
    return migration.Snapshots({k: spark.createDataFrame(r, sch) for k, (r, sch) in rows.items()})


def test_reconcile_keys_finds_every_issue(spark):
    s = spark.createDataFrame([(1, D("1.00")), (2, D("2.00")), (3, D("3.00")), (3, D("3.00"))], "k long, a decimal(12,2)")
    t = spark.createDataFrame([(1, D("1.00")), (1, D("1.00")), (3, D("3.50")), (4, D("4.00"))], "k long, a decimal(12,2)")
    got = sorted((r.record_key, r.issue_type) for r in reconcile_keys(s, t, "k", "a", entity="x").collect())
    assert got == [("1", "duplicate_target_key"), ("2", "missing_in_target"), ("3", "amount_mismatch"),
                   ("3", "duplicate_source_key"), ("4", "unexpected_in_target")]


def test_reconcile_of_identical_snapshots_is_empty(spark):
    s = spark.range(100).select(F.col("id").alias("k"), (F.col("id") * 1.5).cast("decimal(12,2)").alias("a"))
    assert reconcile_keys(s, s, "k", "a").count() == 0
    r = reconcile_totals(s, s, "x", "a").first()
    assert (r.row_count_delta, r.amount_delta, r.reconciliation_status) == (0, D("0.00"), "passed")


def test_review_scenario_holds(spark):
    m = snapshots(spark)
    recon = {r.entity: r for r in migration.reconciliation(m).collect()}
    assert recon["accounts"].reconciliation_status == "passed"        # blind to offsetting errors
    assert recon["invoices"].row_count_delta == 0 and recon["invoices"].amount_delta == D("37.00")
    assert recon["contacts"].row_count_delta == -1 and recon["contacts"].source_amount is None
    q = migration.exception_queue(m).orderBy("exception_id").collect()
    assert [r.exception_id for r in q] == [1, 2, 3, 4, 5]
    assert q[0].severity == "medium"                                   # text order (D9)
    assert sorted((r.entity, r.record_key, r.issue_type) for r in q) == [
        ("accounts", "2", "missing_in_target"), ("accounts", "4", "duplicate_target_key"),
        ("contacts", "C-4", "missing_in_target"), ("invoices", "INV-2", "missing_in_target"),
        ("invoices", "INV-3", "amount_mismatch")]
    ready = migration.cutover_readiness(migration.exceptions(m), migration.reconciliation(m))
    r = ready.first()
    assert (r.cutover_decision, r.high_exceptions, r.medium_exceptions, r.passed_entities) == ("HOLD", 4, 1, 2)
    checklist = migration.cutover_checklist(ready, migration.quality_report(m)).orderBy("step").collect()
    assert [c.status for c in checklist] == ["passed", "passed", "review", "blocked", "pending", "pending"]
    keyed = {(r.record_key, r.issue_type) for r in migration.key_reconciliation(m).collect()}
    assert ("INV-4", "duplicate_target_key") in keyed                  # the general reconcile adds it


def test_clean_scenario_is_ready(spark):
    m = snapshots(spark, review=False)
    ready = migration.cutover_readiness(migration.exceptions(m), migration.reconciliation(m)).first()
    assert (ready.cutover_decision, ready.total_exceptions, ready.passed_entities) == ("READY", 0, 4)
    assert ready.decision_reason.startswith("All reconciliation checks passed")
