import datetime as dt
from decimal import Decimal as D

import pytest

from vellum.operators import quality as Q
from vellum.plans import revenue

DATE = dt.date


def bronze(spark, **override):
    b = {
        "customers": spark.createDataFrame(
            [(1, " Ana ", " ANA@X.COM ", "pt", DATE(2024, 1, 1)), (2, "Bo", "bo@x.com", "se", DATE(2024, 2, 1)),
             (3, "No Mail", None, "us", DATE(2024, 3, 1))],
            "customer_id long, full_name string, email string, country string, registered_date date"),
        "products": spark.createDataFrame(
            [(10, "Pen", "Stationery ", 1.5), (11, "Lamp", "home", 20.0), (12, "Bad", "x", -1.0)],
            "product_id long, product_name string, category string, unit_price double"),
        "orders": spark.createDataFrame(
            [(100, 1, "2025-01-01", " Delivered", "pt"), (101, 2, "2025-01-01", "CANCELLED", "se"),
             (102, 1, "2025-01-02", "shipped", "pt"), (103, 2, "2025-01-02", "lost", "se")],
            "order_id long, customer_id long, order_date string, order_status string, shipping_country string"),
        "order_items": spark.createDataFrame(
            [("100-1", 100, 10, 2.0, 10.0), ("100-2", 100, 11, 1.0, 5.5), ("101-1", 101, 11, 1.0, 12.0),
             ("100-3", 100, 10, 0.0, 1.0)],
            "order_item_id string, order_id long, product_id long, quantity double, unit_price double"),
        "payments": spark.createDataFrame(
            [("P1", 100, "card", "paid", 25.5), ("P2", 101, "card", "Refunded", 12.0)],
            "payment_id string, order_id long, payment_method string, payment_status string, amount double"),
        "shipments": spark.createDataFrame(
            [("S1", 100, "UPS ", DATE(2025, 1, 5), "2025-01-08", 4.5, "delivered"),
             ("S3", 102, "dhl", DATE(2025, 1, 6), "", 3.0, "in_transit")],
            "shipment_id string, order_id long, carrier string, promised_delivery_date date, "
            "actual_delivery_date string, shipping_cost double, shipment_status string"),
        "refunds": spark.createDataFrame(
            [("R1", 100, DATE(2025, 1, 9), "damaged", "Processed", D("5.00")),
             ("R2", 100, DATE(2025, 1, 9), "damaged", "pending", D("3.00")),
             ("R3", 101, DATE(2025, 1, 2), "cancelled", "processed", D("12.00")),
             ("R4", 102, DATE(2025, 1, 2), "none", "processed", D("0.00"))],
            "refund_id string, order_id long, refund_date date, refund_reason string, refund_status string, "
            "amount decimal(12,2)"),
    }
    b.update(override)
    return revenue.Silver(b)


def test_silver_rules(spark):
    s = bronze(spark)
    assert [r.email for r in s.customers.orderBy("customer_id").collect()] == ["ana@x.com", "bo@x.com"]
    assert s.customers.first().full_name == "Ana"
    assert s.products.count() == 2 and s.products.where("product_id = 10").first().category == "stationery"
    assert sorted(r.order_status for r in s.orders.collect()) == ["cancelled", "delivered", "shipped"]
    assert s.order_items.count() == 3           # quantity 0 dropped
    assert s.refunds.count() == 3               # amount 0 dropped
    assert s.shipments.where("order_id = 102").first().actual_delivery_date is None  # tolerant cast


def test_fact_order(spark):
    s = bronze(spark)
    f = {r.order_id: r for r in revenue.fact_order(s).collect()}
    assert set(f) == {100, 101, 102}
    o = f[100]
    assert (o.order_total, o.paid_amount, o.refunded_amount, o.net_revenue) == (D("25.50"), D("25.50"), D("5.00"), D("20.50"))
    assert (o.is_completed, o.is_late, o.days_late, o.carrier, o.leakage_amount) == (True, True, 3, "ups", D("9.50"))
    c = f[101]
    assert (c.is_completed, c.net_revenue, c.leakage_amount, c.carrier) == (False, D("0.00"), D("12.00"), "not_shipped")
    n = f[102]
    assert (n.order_total, n.is_late, n.days_late, n.shipping_cost) == (D("0.00"), False, 0, D("3.00"))


def test_marts(spark):
    s = bronze(spark)
    fact = revenue.fact_order(s)
    daily = {r.order_date: r for r in revenue.daily_sales(fact).collect()}
    assert daily[DATE(2025, 1, 1)].order_count == 1 and daily[DATE(2025, 1, 1)].revenue == D("20.50")
    leak = {r.leakage_type: r for r in revenue.revenue_leakage(fact).collect()}
    assert (leak["refund"].affected_orders, leak["refund"].leakage_amount, leak["refund"].priority) == (2, D("17.00"), "low")
    assert (leak["late_delivery"].affected_orders, leak["late_delivery"].leakage_amount) == (1, D("4.50"))
    ops = {r.order_date: r for r in revenue.operations_daily(fact).collect()}
    assert ops[DATE(2025, 1, 1)].late_delivery_rate == D("100.00")
    assert ops[DATE(2025, 1, 2)].late_delivery_rate == D("0.00")   # no late completed → 0
    cats = {r.category: r for r in revenue.category_sales(s).collect()}
    assert (cats["stationery"].units_sold, cats["stationery"].revenue) == (2, D("20.00"))
    assert cats["home"].units_sold == 1          # the cancelled order's lamp is not counted
    tot = revenue.run_totals(fact).first()
    assert (tot.completed_orders, tot.completed_net_revenue, tot.revenue_leakage) == (2, D("20.50"), D("21.50"))
    kpi = revenue.kpi_headline(fact).first()
    assert (kpi.order_count, kpi.completed_orders, kpi.active_customers) == (3, 2, 1)
    assert kpi.average_order_value == D("10.25") and kpi.late_delivery_rate == D("50.00")
    cs = revenue.customer_sales(s, fact).collect()
    assert [(r.customer_id, r.order_count, r.lifetime_value) for r in cs] == [(1, 2, D("20.50"))]


def test_gate_passes_and_fails(spark):
    s = bronze(spark)
    assert set(Q.gate(revenue.quality_report(s)).values()) == {0}
    report = {r.check_name: r.incidents for r in revenue.quality_report(s).collect()}
    # product 12 was dropped by silver (negative price) → no orphan; all clean
    assert report["orphan_order_items"] == 0 and report["duplicate_customer_ids"] == 0
    dirty = bronze(spark, refunds=spark.createDataFrame(
        [("R9", 999, DATE(2025, 1, 1), "x", "processed", D("1.00")),
         ("R8", None, DATE(2025, 1, 1), "x", "processed", D("1.00"))],
        "refund_id string, order_id long, refund_date date, refund_reason string, refund_status string, "
        "amount decimal(12,2)"))
    with pytest.raises(Q.QualityGateError) as err:
        Q.gate(revenue.quality_report(dirty))
    assert err.value.report["orphan_refunds"] == 1     # NULL order id is dropped by silver


def test_gold_tests_all_pass_on_clean_fixture(spark):
    s = bronze(spark)
    res = {r.test_name: r.failures for r in Q.run_tests(revenue.gold_tests(), revenue.gold_models(s)).collect()}
    assert len(res) == 23 and sum(res.values()) == 0
