"""Derive the data products' source entities from the driver tables.

Each function returns a *bronze* DataFrame: the source columns of one
entity, as a CSV export would carry them (untrimmed text, mixed case,
dates as text where the product parses them). The silver builders in
``vellum.plans`` then apply the products' own typing and filtering rules.

All rules are row-local projections or keyed aggregations, so every
entity scales with its driver table; no source row is dropped or capped.
The one exception is deliberate: the migration *target* snapshot loses,
doubles and shifts records by fixed key rules — the defects the
reconciliation has to find.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellum.sources.tables import Tables, dealt, keyed_join

# --------------------------------------------------------------------------
# fixed values of the adapters (domain spellings as they arrive in bronze)
# --------------------------------------------------------------------------
ORDER_STATUS_TEXT = {"F": "Delivered", "O": " SHIPPED", "P": "cancelled "}
SHIPMENT_STATUS_TEXT = {"F": "delivered", "O": "in_transit", "P": "cancelled"}
CARRIERS = ("UPS", "FedEx ", " DHL")
PAYMENT_METHODS = ("card", "bank_transfer", "wallet")
REFUND_REASONS = ("Damaged", "late delivery", "Changed Mind")
TICKET_PRIORITIES = ("low", "Medium", "HIGH")
EVENT_TYPE_TEXT = {
    "signup": "account_created",
    "view": "Trial_Started",
    "purchase": "activated",
    "click": "cancelled",
    "error": "invalid",
}
MIGRATION_INVOICE_STATUS = {"F": "paid", "O": "open", "P": "partial"}
# migration target defects, by the numeric key of a record
TARGET_DROP_EVERY = 97
TARGET_DUPLICATE_EVERY = 89
TARGET_SHIFT_EVERY = 83
TARGET_SHIFT_AMOUNT = 35


def _case_map(c: Column, mapping: dict[str, str]) -> Column:
    expr = None
    for key, value in mapping.items():
        expr = (F.when(c == key, F.lit(value)) if expr is None
                else expr.when(c == key, F.lit(value)))
    return expr


def _pick(index: Column, values: tuple[str, ...]) -> Column:
    """values[index % len(values)] as a CASE (index is a non-negative long)."""
    slot = F.pmod(index, F.lit(len(values)))
    expr = None
    for i, value in enumerate(values):
        expr = (F.when(slot == i, F.lit(value)) if expr is None
                else expr.when(slot == i, F.lit(value)))
    return expr


def _day_offset(start: str, days: Column) -> Column:
    return F.date_add(F.lit(start).cast("date"), days.cast("int"))


def _dec(c: str | Column, spec: str = "decimal(12,2)") -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast(spec)


# --------------------------------------------------------------------------
# T — taxi trips
# --------------------------------------------------------------------------
def trip_source(t: Tables) -> DataFrame:
    """Monthly trip file with the source's own column names.

    One trip per order line: pick-up is the order date, drop-off the ship
    date, distance the quantity, passengers the line number.
    """
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    li = t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                           "l_quantity", "l_extendedprice", "l_discount", "l_tax",
                           "l_shipdate")
    j = li.join(o, li.l_orderkey == o.o_orderkey, "inner")
    return j.select(
        F.col("l_suppkey").alias("VendorID"),
        F.col("o_orderdate").alias("tpep_pickup_datetime"),
        F.col("l_shipdate").alias("tpep_dropoff_datetime"),
        F.col("l_linenumber").cast("long").alias("passenger_count"),
        F.col("l_quantity").alias("trip_distance"),
        F.col("l_linenumber").cast("long").alias("RatecodeID"),
        (F.pmod(F.col("o_custkey"), F.lit(265)) + 1).alias("PULocationID"),
        (F.pmod(F.col("l_partkey"), F.lit(265)) + 1).alias("DOLocationID"),
        (F.pmod(F.col("l_orderkey"), F.lit(4)) + 1).alias("payment_type"),
        F.col("l_extendedprice").alias("fare_amount"),
        F.col("l_tax").alias("tip_amount"),
        F.col("l_discount").alias("tolls_amount"),
        F.col("l_extendedprice").alias("total_amount"),
    )


# --------------------------------------------------------------------------
# E — revenue protection
# --------------------------------------------------------------------------
def _customer_nation(t: Tables) -> DataFrame:
    # nation is the 25-row TPC-H dimension; the planner broadcasts it by size
    n = t.nation.select("n_nationkey", "n_name")
    c = t.customer.select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    return c.join(n, c.c_nationkey == n.n_nationkey, "left")


def customers(t: Tables) -> DataFrame:
    c = _customer_nation(t)
    return c.select(
        F.col("c_custkey").alias("customer_id"),
        F.concat(F.lit(" "), F.col("c_name")).alias("full_name"),
        F.concat(F.lit("User."), F.col("c_custkey").cast("string"), F.lit("@Example.COM ")).alias("email"),
        F.lower(F.col("n_name")).alias("country"),
        _day_offset("1992-01-01", F.pmod(F.col("c_custkey"), F.lit(365))).alias("registered_date"),
    )


def products(t: Tables) -> DataFrame:
    return t.part.select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_retailprice").alias("unit_price"),
    )


def orders(t: Tables) -> DataFrame:
    o = t.orders
    return o.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").alias("order_date"),
        _case_map(F.col("o_orderstatus"), ORDER_STATUS_TEXT).alias("order_status"),
        F.col("o_orderpriority").alias("shipping_country"),
    )


def order_items(t: Tables) -> DataFrame:
    li = t.lineitem
    return li.select(
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("order_item_id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").alias("unit_price"),
    )


def payments(t: Tables) -> DataFrame:
    o = t.orders
    return o.select(
        F.concat(F.lit("PAY-"), F.col("o_orderkey").cast("string")).alias("payment_id"),
        F.col("o_orderkey").alias("order_id"),
        _pick(F.col("o_orderkey"), PAYMENT_METHODS).alias("payment_method"),
        F.when(F.col("o_orderstatus") == "P", F.lit("refunded")).otherwise(F.lit("paid")).alias("payment_status"),
        F.col("o_totalprice").alias("amount"),
    )


def shipments(t: Tables) -> DataFrame:
    """One shipment per order that has lines; orders without lines have none."""
    lines = (t.lineitem.groupBy("l_orderkey")
             .agg(F.count(F.lit(1)).alias("n_lines"), F.max("l_shipdate").alias("last_ship")))
    o = dealt(t.orders.select("o_orderkey", "o_orderdate", "o_orderstatus"), "o_orderkey")
    j = keyed_join(o, lines, o.o_orderkey == lines.l_orderkey)
    delivered = F.col("o_orderstatus") == "F"
    return j.select(
        F.concat(F.lit("SHP-"), F.col("o_orderkey").cast("string")).alias("shipment_id"),
        F.col("o_orderkey").alias("order_id"),
        _pick(F.col("o_orderkey"), CARRIERS).alias("carrier"),
        F.date_add(F.col("o_orderdate").cast("date"), 30).alias("promised_delivery_date"),
        F.when(delivered, F.date_format(F.col("last_ship"), "yyyy-MM-dd")).otherwise(F.lit("")).alias("actual_delivery_date"),
        (F.lit(4.50) + F.lit(0.75) * F.col("n_lines")).alias("shipping_cost"),
        _case_map(F.col("o_orderstatus"), SHIPMENT_STATUS_TEXT).alias("shipment_status"),
    )


def refunds(t: Tables) -> DataFrame:
    li = t.lineitem.where(F.col("l_returnflag") == "R")
    return li.select(
        F.concat(F.lit("REF-"), F.col("l_orderkey").cast("string"), F.lit("-"),
                 F.col("l_linenumber").cast("string")).alias("refund_id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_shipdate").alias("refund_date"),
        _pick(F.col("l_linenumber"), REFUND_REASONS).alias("refund_reason"),
        F.when(F.pmod(F.col("l_linenumber"), F.lit(5)) == 0, F.lit("Pending"))
         .otherwise(F.lit("Processed")).alias("refund_status"),
        (_dec("l_extendedprice") * _dec("l_discount", "decimal(4,2)")).alias("amount"),
    )


REVENUE_SOURCES = {
    "customers": customers, "products": products, "orders": orders,
    "order_items": order_items, "payments": payments, "shipments": shipments,
    "refunds": refunds,
}


# --------------------------------------------------------------------------
# C — client data operations
# --------------------------------------------------------------------------
def accounts(t: Tables) -> DataFrame:
    c = _customer_nation(t)
    key = F.col("c_custkey")
    status = (F.when(F.pmod(key, F.lit(11)) == 0, F.lit("churned"))
              .when(F.pmod(key, F.lit(4)) == 0, F.lit("Trial"))
              .otherwise(F.lit("active ")))
    return c.select(
        key.alias("account_id"),
        F.col("c_name").alias("account_name"),
        F.col("c_mktsegment").alias("plan"),
        F.lower(F.col("n_name")).alias("country"),
        F.date_format(_day_offset("2020-01-01", F.pmod(key, F.lit(400))), "yyyy-MM-dd").alias("signup_date"),
        status.alias("account_status"),
        F.col("c_acctbal").alias("monthly_recurring_revenue"),
    )


def invoices(t: Tables) -> DataFrame:
    o = t.orders
    return o.select(
        F.concat(F.lit("INV-"), F.col("o_orderkey").cast("string")).alias("invoice_id"),
        F.col("o_custkey").alias("account_id"),
        F.col("o_orderdate").alias("invoice_date"),
        F.col("o_totalprice").alias("amount"),
        F.when(F.col("o_orderstatus") == "P", F.lit("overdue")).otherwise(F.lit("paid")).alias("invoice_status"),
    )


def support_tickets(t: Tables) -> DataFrame:
    e = t.events.where(F.col("event_type") == "error")
    eid = F.col("event_id")
    is_open = F.pmod(eid, F.lit(6)) == 0
    resolved = F.date_add(F.col("ts").cast("date"), F.pmod(eid, F.lit(4)).cast("int"))
    return e.select(
        F.concat(F.lit("TCK-"), eid.cast("string")).alias("ticket_id"),
        F.col("user_id").alias("account_id"),
        F.col("ts").alias("created_date"),
        F.when(is_open, F.lit("")).otherwise(F.date_format(resolved, "yyyy-MM-dd")).alias("resolved_date"),
        _pick(eid, TICKET_PRIORITIES).alias("priority"),
        F.when(is_open, F.lit("open")).otherwise(F.lit("resolved")).alias("ticket_status"),
    )


def account_events(t: Tables) -> DataFrame:
    e = t.events
    return e.select(
        F.col("event_id").cast("string").alias("event_id"),
        F.col("user_id").alias("account_id"),
        F.col("ts").alias("event_date"),
        _case_map(F.col("event_type"), EVENT_TYPE_TEXT).alias("event_type"),
    )


CLIENT_SOURCES = {
    "accounts": accounts, "invoices": invoices,
    "support_tickets": support_tickets, "account_events": account_events,
}


# --------------------------------------------------------------------------
# M — migration assurance (source snapshot and a target with defects)
# --------------------------------------------------------------------------
def _m_accounts(t: Tables) -> DataFrame:
    c = _customer_nation(t)
    return c.select(
        F.col("c_custkey").alias("_n"),
        F.col("c_custkey").alias("account_id"),
        F.col("c_name").alias("account_name"),
        F.col("n_name").alias("country"),
        _day_offset("2019-01-01", F.pmod(F.col("c_custkey"), F.lit(500))).alias("created_date"),
        F.col("c_acctbal").alias("monthly_value"),
    )


def _m_invoices(t: Tables) -> DataFrame:
    o = t.orders
    return o.select(
        F.col("o_orderkey").alias("_n"),
        F.concat(F.lit("INV-"), F.col("o_orderkey").cast("string")).alias("invoice_id"),
        F.col("o_custkey").alias("account_id"),
        F.col("o_orderdate").alias("invoice_date"),
        F.col("o_totalprice").alias("amount"),
        _case_map(F.col("o_orderstatus"), MIGRATION_INVOICE_STATUS).alias("invoice_status"),
    )


def _m_transactions(t: Tables) -> DataFrame:
    """One transaction per order line key, summed so the key is unique. Lines
    are dealt by their order once, for the sums and for the join."""
    lines = t.lineitem.select("l_orderkey", "l_linenumber", _dec("l_extendedprice").alias("price"), "l_shipdate",
                              F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("returned"))
    li = (dealt(lines, "l_orderkey")
          .groupBy("l_orderkey", "l_linenumber")
          .agg(F.sum("price").alias("amount"),
               F.max("l_shipdate").alias("transaction_date"),
               F.max("returned").alias("returned")))
    o = t.orders.select("o_orderkey", "o_custkey")
    j = keyed_join(li, o, li.l_orderkey == o.o_orderkey)
    return j.select(
        F.col("l_orderkey").alias("_n"),
        F.concat(F.lit("TRX-"), F.col("l_orderkey").cast("string"), F.lit("-"),
                 F.col("l_linenumber").cast("string")).alias("transaction_id"),
        F.col("o_custkey").alias("account_id"),
        F.col("transaction_date"),
        F.col("amount"),
        F.when(F.col("returned") == 1, F.lit("Refund")).otherwise(F.lit("sale")).alias("transaction_type"),
    )


def _m_contacts(t: Tables) -> DataFrame:
    s = t.supplier
    return s.select(
        F.col("s_suppkey").alias("_n"),
        F.concat(F.lit("CON-"), F.col("s_suppkey").cast("string")).alias("contact_id"),
        F.col("s_suppkey").alias("account_id"),
        F.concat(F.lit("Contact."), F.col("s_suppkey").cast("string"), F.lit("@Vendor.example")).alias("email"),
        F.lower(F.col("s_nationkey").cast("string")).alias("country"),
        F.lit("active").alias("contact_status"),
    )


MIGRATION_BUILDERS = {
    "accounts": (_m_accounts, "monthly_value"),
    "invoices": (_m_invoices, "amount"),
    "transactions": (_m_transactions, "amount"),
    "contacts": (_m_contacts, None),
}


def migration_source(t: Tables, entity: str) -> DataFrame:
    build, _ = MIGRATION_BUILDERS[entity]
    return build(t).drop("_n")


def migration_target(t: Tables, entity: str) -> DataFrame:
    """Target snapshot: some keys lost, some doubled, some amounts shifted."""
    build, amount = MIGRATION_BUILDERS[entity]
    src = build(t)
    n = F.col("_n")
    kept = src.where(F.pmod(n, F.lit(TARGET_DROP_EVERY)) != 0)
    if amount is not None:
        shifted = F.when(F.pmod(n, F.lit(TARGET_SHIFT_EVERY)) == 0,
                         F.col(amount) + F.lit(TARGET_SHIFT_AMOUNT)).otherwise(F.col(amount))
        kept = kept.withColumn(amount, shifted)
    # doubled keys: one pass that emits a second copy, not a second scan
    copies = F.when(F.pmod(n, F.lit(TARGET_DUPLICATE_EVERY)) == 0, F.lit(2)).otherwise(F.lit(1))
    return kept.withColumn("_copy", F.explode(F.sequence(F.lit(1), copies))).drop("_n", "_copy")


MIGRATION_ENTITIES = tuple(MIGRATION_BUILDERS)
