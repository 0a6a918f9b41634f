"""Data contracts of the products' source entities (bronze), and the row
rules the contracts state beyond the silver filters.

Fixed values: entity → columns and types as the sources deliver them.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from vellum.operators import quality as Q

L, S, D, DT, TS = T.LongType(), T.StringType(), T.DoubleType(), T.DateType(), T.TimestampNTZType()


def _schema(*cols) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in cols])


REVENUE = {
    "customers": _schema(("customer_id", L), ("full_name", S), ("email", S), ("country", S),
                         ("registered_date", DT)),
    "products": _schema(("product_id", L), ("product_name", S), ("category", S), ("unit_price", D)),
    "orders": _schema(("order_id", L), ("customer_id", L), ("order_date", TS), ("order_status", S),
                      ("shipping_country", S)),
    "order_items": _schema(("order_item_id", S), ("order_id", L), ("product_id", L), ("quantity", D),
                           ("unit_price", D)),
    "payments": _schema(("payment_id", S), ("order_id", L), ("payment_method", S), ("payment_status", S),
                        ("amount", D)),
    "shipments": _schema(("shipment_id", S), ("order_id", L), ("carrier", S), ("promised_delivery_date", DT),
                         ("actual_delivery_date", S), ("shipping_cost", D), ("shipment_status", S)),
    "refunds": _schema(("refund_id", S), ("order_id", L), ("refund_date", TS), ("refund_reason", S),
                       ("refund_status", S), ("amount", T.DecimalType(17, 4))),
}

CLIENT = {
    "accounts": _schema(("account_id", L), ("account_name", S), ("plan", S), ("country", S),
                        ("signup_date", S), ("account_status", S), ("monthly_recurring_revenue", D)),
    "invoices": _schema(("invoice_id", S), ("account_id", L), ("invoice_date", TS), ("amount", D),
                        ("invoice_status", S)),
    "support_tickets": _schema(("ticket_id", S), ("account_id", L), ("created_date", TS), ("resolved_date", S),
                               ("priority", S), ("ticket_status", S)),
    "account_events": _schema(("event_id", S), ("account_id", L), ("event_date", TS), ("event_type", S)),
}


MIGRATION = {
    "accounts": _schema(("account_id", L), ("account_name", S), ("country", S), ("created_date", DT),
                        ("monthly_value", D)),
    "invoices": _schema(("invoice_id", S), ("account_id", L), ("invoice_date", TS), ("amount", D),
                        ("invoice_status", S)),
    "transactions": _schema(("transaction_id", S), ("account_id", L), ("transaction_date", TS),
                            ("amount", T.DecimalType(22, 2)), ("transaction_type", S)),
    "contacts": _schema(("contact_id", S), ("account_id", L), ("email", S), ("country", S), ("contact_status", S)),
}

# numeric columns of a trips file come as integers or doubles: names are the contract, types are cast
TRIPS = _schema(("VendorID", L), ("tpep_pickup_datetime", TS), ("tpep_dropoff_datetime", TS), ("passenger_count", L),
                ("trip_distance", D), ("RatecodeID", L), ("PULocationID", L), ("DOLocationID", L), ("payment_type", L),
                ("fare_amount", D), ("tip_amount", D), ("tolls_amount", D), ("total_amount", D))


def check_schemas(frames: dict, contract: dict) -> list[dict]:
    """Q1: every contract entity present, with its columns and types."""
    from vellum.sources.files import schema_diff
    issues = []
    for name, schema in contract.items():
        if name not in frames:
            issues.append({"entity": name, "column": None, "issue": "missing_entity"})
            continue
        for d in schema_diff(frames[name].schema, schema):
            issues.append({"entity": name, **d})
    return issues


def revenue_contract_rules() -> list[Q.Check]:
    """Q12–Q14 and D12/D14 on bronze: what the contract promises beyond the
    silver filters (silver drops these rows silently; here they are counted)."""
    c = F.col
    return [
        Q.null_key("null_order_ids", "orders", "order_id"),
        Q.duplicate_key("duplicate_order_ids", "orders", "order_id"),
        Q.duplicate_key("duplicate_order_item_ids", "order_items", "order_item_id"),
        Q.duplicate_key("duplicate_payment_ids", "payments", "payment_id"),
        Q.duplicate_key("shipments_per_order_above_one", "shipments", "order_id"),
        Q.domain("invalid_order_statuses", "orders", "order_status_norm", ("delivered", "shipped", "cancelled"),
                 null_violates=True),
        Q.domain("invalid_payment_statuses", "payments", "payment_status_norm", ("paid", "refunded")),
        Q.domain("invalid_shipment_statuses", "shipments", "shipment_status_norm",
                 ("delivered", "in_transit", "cancelled")),
        Q.row_rule("non_positive_quantities", "order_items", c("quantity") <= 0),
        Q.row_rule("negative_prices", "order_items", c("unit_price") < 0),
        Q.row_rule("non_positive_refunds", "refunds", c("amount") <= 0),
        Q.row_rule("unparseable_delivery_dates", "shipments",
                   (F.length(F.trim(c("actual_delivery_date"))) > 0) & c("actual_delivery_date").try_cast("date").isNull()),
        Q.row_rule("delivered_without_delivery_date", "shipments",
                   (c("shipment_status_norm") == "delivered") & c("actual_delivery_date").try_cast("date").isNull()),
        Q.row_rule("delivery_date_when_not_delivered", "shipments",
                   (c("shipment_status_norm") != "delivered") & c("actual_delivery_date").try_cast("date").isNotNull()),
    ]


def revenue_rule_inputs(bronze: dict) -> dict:
    """Bronze frames with the normalised status columns the rules read."""
    def norm(df, col):
        return df.withColumn(f"{col}_norm", F.lower(F.trim(F.col(col))))
    out = dict(bronze)
    out["orders"] = norm(bronze["orders"], "order_status")
    out["payments"] = norm(bronze["payments"], "payment_status")
    out["shipments"] = norm(bronze["shipments"], "shipment_status")
    return out


MIGRATION_AMOUNTS = {"accounts": "monthly_value", "invoices": "amount", "transactions": "amount"}


def migration_contract_rules(entities: dict) -> list[Q.Check]:
    """D13/D16 on both bronze snapshots: NULL keys (silver drops them before
    the gate looks), repeated keys and negative amounts, per side."""
    checks = []
    for side in ("source", "target"):
        for e, (key, _) in entities.items():
            t = f"{side}_{e}"
            checks.append(Q.null_key(f"null_{t}_keys", t, key))
            checks.append(Q.duplicate_key(f"duplicate_{t}_keys", t, key))
            amount = MIGRATION_AMOUNTS.get(e)
            if amount:
                checks.append(Q.row_rule(f"negative_{t}_amounts", t, F.col(amount) < 0))
    return checks


# ------------------------------------------------------------- quarantine
def _missing(*columns: str) -> dict:
    return {f"missing_{c}": F.col(c).isNull() for c in columns}


def _unknown(column: str, values: tuple[str, ...], nulls: bool = False) -> dict:
    bad = ~F.lower(F.trim(column)).isin(*values)
    return {f"unknown_{column}": bad | F.col(column).isNull() if nulls else bad}


def quarantine_rules() -> dict[str, dict[str, tuple[str, dict]]]:
    """Q12: product → entity → (key, reason → violation) on the delivered rows."""
    c = F.col
    migration = {e: (key, {**_missing(key, *(() if key == "account_id" else ("account_id",))),
                           **({"negative_amount": c(MIGRATION_AMOUNTS[e]) < 0} if e in MIGRATION_AMOUNTS else {})})
                 for e, key in (("accounts", "account_id"), ("invoices", "invoice_id"),
                                ("transactions", "transaction_id"), ("contacts", "contact_id"))}
    return {
        "revenue": {
            "customers": ("customer_id", _missing("customer_id", "email")),
            "products": ("product_id", {**_missing("product_id"), "negative_price": c("unit_price") < 0}),
            "orders": ("order_id", {**_missing("order_id", "customer_id", "order_date"),
                                    **_unknown("order_status", ("delivered", "shipped", "cancelled"), nulls=True)}),
            "order_items": ("order_item_id", {**_missing("order_item_id", "order_id", "product_id"),
                                              "non_positive_quantity": c("quantity") <= 0,
                                              "negative_price": c("unit_price") < 0}),
            "payments": ("payment_id", {**_missing("payment_id", "order_id"), "negative_amount": c("amount") < 0}),
            "shipments": ("shipment_id", {**_missing("shipment_id", "order_id", "promised_delivery_date"),
                                          "negative_cost": c("shipping_cost") < 0,
                                          "unparseable_delivery_date": (F.length(F.trim("actual_delivery_date")) > 0)
                                          & c("actual_delivery_date").try_cast("date").isNull()}),
            "refunds": ("refund_id", {**_missing("refund_id", "order_id"), "non_positive_amount": c("amount") <= 0}),
        },
        "client": {
            "accounts": ("account_id", {**_missing("account_id", "account_name"),
                                        "unparseable_signup_date": c("signup_date").try_cast("date").isNull(),
                                        "negative_mrr": c("monthly_recurring_revenue") < 0,
                                        **_unknown("account_status", ("active", "trial", "churned"))}),
            "invoices": ("invoice_id", {**_missing("invoice_id", "account_id"), "negative_amount": c("amount") < 0,
                                        **_unknown("invoice_status", ("paid", "overdue"))}),
            "support_tickets": ("ticket_id", {**_missing("ticket_id", "account_id", "created_date"),
                                              **_unknown("priority", ("low", "medium", "high")),
                                              **_unknown("ticket_status", ("open", "resolved"))}),
            "account_events": ("event_id", {**_missing("event_id", "account_id", "event_date"), **_unknown(
                "event_type", ("account_created", "trial_started", "activated", "cancelled"))}),
        },
        "migration_source": migration,
        "migration_target": migration,
    }


def quarantined(bronze: dict):
    """The rows of the delivered entities ((product, entity) → frame) that
    break a contract rule: product, entity, record_key, reasons."""
    from functools import reduce

    from pyspark.sql import DataFrame
    parts = []
    for (product, entity), df in bronze.items():
        key, rules = quarantine_rules()[product][entity]
        _, bad = Q.quarantine(df, rules)
        parts.append(bad.select(F.lit(product).alias("product"), F.lit(entity).alias("entity"),
                                F.col(key).cast("string").alias("record_key"), "reasons"))
    return reduce(DataFrame.unionByName, parts)
