import datetime as dt
from decimal import Decimal as D

from vellum.plans import client

DATE = dt.date


def silver(spark):
    accounts = spark.createDataFrame([
        (1, "A", "pro", "pt", "2024-01-01", "active", 100.0),
        (2, "B", "pro", "pt", "2024-01-01", "Churned", 50.0),
        (3, "C", "basic", "se", "2024-01-01", "trial", 0.0),
        (4, "D", "basic", "se", "2024-01-01", "active", 30.0),
        (5, "E", "basic", "se", "2024-01-01", "active", -1.0),
    ], "account_id long, account_name string, plan string, country string, signup_date string, "
       "account_status string, monthly_recurring_revenue double")
    invoices = spark.createDataFrame([
        ("I1", 1, DATE(2025, 3, 1), 100.0, "paid"), ("I2", 1, DATE(2025, 3, 2), 100.0, "overdue"),
        ("I3", 4, DATE(2025, 3, 1), 30.0, "paid"),
    ], "invoice_id string, account_id long, invoice_date date, amount double, invoice_status string")
    tickets = spark.createDataFrame([
        ("T1", 1, DATE(2025, 3, 1), "2025-03-02", "low", "resolved"),
        ("T2", 1, DATE(2025, 3, 1), "2025-03-05", "high", "resolved"),
        ("T3", 4, DATE(2025, 3, 3), "", "medium", "resolved"),
        ("T4", 4, DATE(2025, 3, 4), "", "medium", "open"),
    ], "ticket_id string, account_id long, created_date date, resolved_date string, priority string, "
       "ticket_status string")
    events = spark.createDataFrame([
        ("E1", 3, DATE(2025, 3, 1), "trial_started"), ("E2", 3, DATE(2025, 3, 2), "activated"),
        ("E3", 1, DATE(2025, 3, 1), "trial_started"),
    ], "event_id string, account_id long, event_date date, event_type string")
    return client.Silver({"accounts": accounts, "invoices": invoices, "support_tickets": tickets,
                          "account_events": events})


def test_scorecard(spark):
    r = client.client_scorecard(silver(spark)).first()
    assert (r.active_accounts, r.churned_accounts, r.mrr) == (2, 1, D("130.00"))
    assert (r.billed_revenue, r.paid_revenue) == (D("230.00"), D("130.00"))
    assert r.collection_rate == D("66.67")              # by invoice count, 2 of 3
    assert r.logo_churn_rate == D("33.33") and r.trial_to_active_rate == D("50.00")
    # resolved ticket without a resolved date: not compliant, still counted
    assert r.support_sla_rate == D("33.33") and r.open_tickets == 1
    assert r.reporting_period == DATE(2025, 3, 31)


def test_account_health_segments(spark):
    h = {r.account_id: r for r in client.account_health(silver(spark)).collect()}
    assert set(h) == {1, 2, 3, 4}                       # negative MRR dropped by silver
    assert h[1].health_segment == "needs_attention" and h[1].support_sla_rate == D("50.00")
    assert h[2].health_segment == "churned"
    assert h[3].health_segment == "trial" and h[3].support_sla_rate == D("100.00")  # no tickets → 100
    assert h[4].health_segment == "needs_attention" and h[4].paid_revenue == D("30.00")


def test_daily_operations_spine(spark):
    d = {r.metric_date: r for r in client.daily_operations(silver(spark)).collect()}
    assert sorted(d) == [DATE(2025, 3, 1), DATE(2025, 3, 2), DATE(2025, 3, 3), DATE(2025, 3, 4)]
    assert d[DATE(2025, 3, 3)].billed_revenue == D("0.00") and d[DATE(2025, 3, 3)].tickets_created == 1
    assert d[DATE(2025, 3, 2)].overdue_invoices == 1


def test_gate(spark):
    rep = {r.check_name: r.incidents for r in client.quality_report(silver(spark)).collect()}
    assert rep["orphan_invoices"] == 0 and rep["invalid_account_statuses"] == 0
    assert sum(rep.values()) == 0
