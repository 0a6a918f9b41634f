"""E — revenue protection: silver entities, the order fact and its marts.

Shape of the plan at scale: every child table is aggregated per order
*before* it meets ``orders`` (map-side partial aggregation, one row per
order leaves each child), so the four left joins are joins of one row per
key on the same key — one exchange per child, no row multiplication.
Product and customer marts aggregate to the dimension key first and join
the dimension after, so the join input is bounded by the dimension size,
not by the number of order lines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellum.functions import (MONEY, MONEY_TOTAL, RATE, avg_money, days_between, money, money_total, norm_lower,
                              norm_upper, ratio_pct)
from vellum.sources import adapters
from vellum.sources.tables import Tables, keyed_join, materialize_all, materialized

# Accepted order statuses
ORDER_STATUSES = ("delivered", "shipped", "cancelled")
KEY = "long"  # ids are BIGINT: INTEGER order keys overflow past ~2^31 orders


# ---------------------------------------------------------------- silver ---
def silver_customers(bronze: DataFrame) -> DataFrame:
    return (bronze.where(F.col("customer_id").isNotNull() & F.col("email").isNotNull())
            .select(F.col("customer_id").cast(KEY).alias("customer_id"),
                    F.trim("full_name").alias("full_name"),
                    norm_lower("email").alias("email"),
                    norm_upper("country").alias("country"),
                    F.col("registered_date").cast("date").alias("registered_date")))


def silver_products(bronze: DataFrame) -> DataFrame:
    return (bronze.where(F.col("product_id").isNotNull() & (F.col("unit_price") >= 0))
            .select(F.col("product_id").cast(KEY).alias("product_id"),
                    F.trim("product_name").alias("product_name"),
                    norm_lower("category").alias("category"),
                    money("unit_price").alias("unit_price")))


def silver_orders(bronze: DataFrame) -> DataFrame:
    return (bronze.where(F.col("order_id").isNotNull() & F.col("customer_id").isNotNull()
                         & F.col("order_date").isNotNull()
                         & norm_lower("order_status").isin(*ORDER_STATUSES))
            .select(F.col("order_id").cast(KEY).alias("order_id"),
                    F.col("customer_id").cast(KEY).alias("customer_id"),
                    F.col("order_date").cast("date").alias("order_date"),
                    norm_lower("order_status").alias("order_status"),
                    norm_upper("shipping_country").alias("shipping_country")))


def silver_order_items(bronze: DataFrame) -> DataFrame:
    return (bronze.where(F.col("order_item_id").isNotNull() & F.col("order_id").isNotNull()
                         & F.col("product_id").isNotNull() & (F.col("quantity") > 0)
                         & (F.col("unit_price") >= 0))
            .select(F.trim("order_item_id").alias("order_item_id"),
                    F.col("order_id").cast(KEY).alias("order_id"),
                    F.col("product_id").cast(KEY).alias("product_id"),
                    F.rint("quantity").cast("int").alias("quantity"),
                    money("unit_price").alias("unit_price")))


def silver_payments(bronze: DataFrame) -> DataFrame:
    return (bronze.where(F.col("payment_id").isNotNull() & F.col("order_id").isNotNull()
                         & (F.col("amount") >= 0))
            .select(F.trim("payment_id").alias("payment_id"),
                    F.col("order_id").cast(KEY).alias("order_id"),
                    norm_lower("payment_method").alias("payment_method"),
                    norm_lower("payment_status").alias("payment_status"),
                    money("amount").alias("amount")))


def silver_shipments(bronze: DataFrame) -> DataFrame:
    return (bronze.where(F.col("shipment_id").isNotNull() & F.col("order_id").isNotNull()
                         & F.col("promised_delivery_date").isNotNull()
                         & (F.col("shipping_cost") >= 0))
            .select(F.trim("shipment_id").alias("shipment_id"),
                    F.col("order_id").cast(KEY).alias("order_id"),
                    norm_lower("carrier").alias("carrier"),
                    F.col("promised_delivery_date").cast("date").alias("promised_delivery_date"),
                    F.col("actual_delivery_date").try_cast("date").alias("actual_delivery_date"),
                    money("shipping_cost").alias("shipping_cost"),
                    norm_lower("shipment_status").alias("shipment_status")))


def silver_refunds(bronze: DataFrame) -> DataFrame:
    return (bronze.where(F.col("refund_id").isNotNull() & F.col("order_id").isNotNull()
                         & (F.col("amount") > 0))
            .select(F.trim("refund_id").alias("refund_id"),
                    F.col("order_id").cast(KEY).alias("order_id"),
                    F.col("refund_date").cast("date").alias("refund_date"),
                    norm_lower("refund_reason").alias("refund_reason"),
                    norm_lower("refund_status").alias("refund_status"),
                    money("amount").alias("amount")))


SILVER = {
    "customers": silver_customers, "products": silver_products, "orders": silver_orders,
    "order_items": silver_order_items, "payments": silver_payments,
    "shipments": silver_shipments, "refunds": silver_refunds,
}


class Silver:
    """The seven silver tables of one run, built lazily from bronze frames."""

    def __init__(self, bronze: dict[str, DataFrame], materialize: bool = False):
        self.bronze = bronze
        self.materialize = materialize
        self._silver: dict[str, DataFrame] = {}

    @classmethod
    def from_silver(cls, frames: dict) -> "Silver":
        """Wrap silver tables that were already built (e.g. read from a written layer)."""
        obj = cls({})
        obj._silver.update(frames)
        return obj

    @classmethod
    def from_tables(cls, t: Tables, materialize: bool = False) -> "Silver":
        return cls({name: build(t) for name, build in adapters.REVENUE_SOURCES.items()}, materialize)

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in SILVER:
            raise AttributeError(name)
        if name not in self._silver:
            self._silver[name] = materialized(SILVER[name](self.bronze[name]), self.materialize, f"silver-{name}")
        return self._silver[name]

    def materialize_all(self) -> "Silver":
        """Write every silver table (concurrent jobs) and read them back."""
        todo = {n: SILVER[n](self.bronze[n]) for n in SILVER if n not in self._silver}
        self._silver.update(materialize_all(todo, "silver"))
        return self


# ------------------------------------------------------------------ gold ---
def dim_customer(s: Silver) -> DataFrame:
    return s.customers.select("customer_id", "full_name", "email", "country", "registered_date")


def dim_product(s: Silver) -> DataFrame:
    return s.products.select("product_id", "product_name", "category", "unit_price")


def _line_amount():
    return (F.col("quantity") * F.col("unit_price"))


def fact_order(s: Silver, orders: DataFrame | None = None) -> DataFrame:
    """D-E9: one row per order with totals, refunds, lateness and leakage.

    ``orders`` restricts the driving rows (the incremental candidates);
    children are still read whole so an order sees all its lines.
    """
    o = s.orders if orders is None else orders
    order_totals = (s.order_items.groupBy("order_id")
                    .agg(money_total(F.sum(_line_amount())).alias("ot_total")))
    payment_totals = (s.payments.groupBy("order_id")
                      .agg(money_total(F.sum(F.when(F.col("payment_status") == "paid", F.col("amount"))
                                             .otherwise(F.lit(0)))).alias("pt_paid")))
    refund_totals = (s.refunds.groupBy("order_id")
                     .agg(money_total(F.sum(F.when(F.col("refund_status") == "processed", F.col("amount"))
                                            .otherwise(F.lit(0)))).alias("rt_refunded")))
    shipment = s.shipments.select(
        "order_id", F.col("carrier").alias("sd_carrier"),
        "promised_delivery_date", "actual_delivery_date",
        F.col("shipping_cost").alias("sd_cost"))

    j = o
    for child in (order_totals, payment_totals, refund_totals, shipment):
        j = keyed_join(j, child, "order_id", "left")

    # per-order sums keep the width of a total: one very large order must not
    # overflow row money
    total = F.coalesce(F.col("ot_total"), F.lit(0).cast(MONEY_TOTAL))
    refunded = F.coalesce(F.col("rt_refunded"), F.lit(0).cast(MONEY_TOTAL))
    completed = F.col("order_status") != "cancelled"
    late = F.col("actual_delivery_date") > F.col("promised_delivery_date")
    cost = F.coalesce(F.col("sd_cost"), F.lit(0).cast(MONEY))
    return j.select(
        "order_id", "customer_id", "order_date", "order_status",
        total.alias("order_total"),
        money_total(F.coalesce(F.col("pt_paid"), F.lit(0))).alias("paid_amount"),
        completed.alias("is_completed"),
        refunded.alias("refunded_amount"),
        money_total(F.when(completed, F.greatest(total - refunded, F.lit(0))).otherwise(F.lit(0))).alias("net_revenue"),
        F.coalesce(F.col("sd_carrier"), F.lit("not_shipped")).alias("carrier"),
        "promised_delivery_date", "actual_delivery_date",
        money(cost).alias("shipping_cost"),
        F.coalesce(late, F.lit(False)).alias("is_late"),
        F.when(late, days_between("promised_delivery_date", "actual_delivery_date"))
         .otherwise(F.lit(0)).cast("long").alias("days_late"),
        money_total(refunded + F.when(late, cost).otherwise(F.lit(0))).alias("leakage_amount"),
    )


def daily_sales(fact: DataFrame) -> DataFrame:
    """D-E10: completed orders per date."""
    return (fact.where(F.col("is_completed")).groupBy("order_date")
            .agg(F.count(F.lit(1)).alias("order_count"),
                 money_total(F.sum("net_revenue")).alias("revenue"),
                 avg_money("net_revenue").alias("average_order_value"),
                 money_total(F.sum("order_total")).alias("gross_revenue"),
                 money_total(F.sum("refunded_amount")).alias("refunded_amount"),
                 money_total(F.sum("leakage_amount")).alias("leakage_amount")))


def _active_item_totals(s: Silver) -> DataFrame:
    """Units and revenue per product over lines of non-cancelled orders.

    Lines are kept by a semi join (orders contribute only the filter) and
    collapsed to one row per product before any dimension join.
    """
    active = s.orders.where(F.col("order_status") != "cancelled").select("order_id")
    lines = keyed_join(s.order_items, active, "order_id", "left_semi")
    return (lines.groupBy("product_id")
            .agg(F.sum("quantity").alias("units_sold"),
                 F.sum(_line_amount()).alias("line_revenue")))


def category_sales(s: Silver) -> DataFrame:
    """D-E11: units and revenue per category of non-cancelled orders."""
    per_product = keyed_join(_active_item_totals(s), dim_product(s).select("product_id", "category"), "product_id")
    return (per_product.groupBy("category")
            .agg(F.sum("units_sold").cast("long").alias("units_sold"),
                 money_total(F.sum("line_revenue")).alias("revenue")))


def product_sales(s: Silver) -> DataFrame:
    """D-E12: the same per product."""
    dim = dim_product(s).select("product_id", "product_name", "category")
    per_product = keyed_join(_active_item_totals(s), dim, "product_id")
    # a product id may repeat in the dimension (the gate's duplicate check);
    # grouping keeps the reference's GROUP BY result either way
    return (per_product.groupBy("product_id", "product_name", "category")
            .agg(F.sum("units_sold").cast("long").alias("units_sold"),
                 money_total(F.sum("line_revenue")).alias("revenue")))


def customer_sales(s: Silver, fact: DataFrame) -> DataFrame:
    """D-E13: completed orders and lifetime value per customer."""
    per_customer = (fact.where(F.col("is_completed")).groupBy("customer_id")
                    .agg(F.count("order_id").alias("order_count"),
                         F.sum("net_revenue").alias("ltv")))
    dim = dim_customer(s).select("customer_id", "full_name")
    return (keyed_join(per_customer, dim, "customer_id")
            .groupBy("customer_id", "full_name")
            .agg(F.sum("order_count").cast("long").alias("order_count"),
                 money_total(F.sum("ltv")).alias("lifetime_value")))


def operations_daily(fact: DataFrame) -> DataFrame:
    """D-E14: every order per date, with the late-delivery rate of completed ones."""
    done = F.col("is_completed")
    g = fact.groupBy("order_date").agg(
        F.count(F.lit(1)).alias("order_count"),
        F.count_if(done).alias("completed_orders"),
        money_total(F.sum(F.when(done, F.col("order_total")).otherwise(F.lit(0)))).alias("gross_revenue"),
        money_total(F.sum("net_revenue")).alias("net_revenue"),
        money_total(F.sum("refunded_amount")).alias("refunded_amount"),
        money_total(F.sum("leakage_amount")).alias("leakage_amount"),
        F.count_if(F.col("is_late")).alias("late_orders"),
        F.count_if(F.col("is_late") & done).alias("_late_done"),
    )
    rate = F.coalesce(ratio_pct("_late_done", "completed_orders"), F.lit(0).cast(RATE))
    return g.withColumn("late_delivery_rate", rate).drop("_late_done")


def revenue_leakage(fact: DataFrame) -> DataFrame:
    """D-E15: refund and late-delivery events per cause with a priority band."""
    refunds = (fact.where(F.col("refunded_amount") > 0)
               .select("order_id", F.lit("refund").alias("leakage_type"),
                       F.col("refunded_amount").alias("amount")))
    late = (fact.where(F.col("is_late") & F.col("is_completed") & (F.col("shipping_cost") > 0))
            .select("order_id", F.lit("late_delivery").alias("leakage_type"),
                    F.col("shipping_cost").alias("amount")))
    g = (refunds.unionByName(late).groupBy("leakage_type")
         .agg(F.count_distinct("order_id").alias("affected_orders"),
              F.sum("amount").alias("_total")))
    total = F.col("_total")
    return g.select(
        "leakage_type", "affected_orders",
        money_total(total).alias("leakage_amount"),
        F.when(total >= 100, "high").when(total >= 40, "medium").otherwise("low").alias("priority"),
    )


def run_totals(fact: DataFrame) -> DataFrame:
    """D-E16: the run's headline numbers in one aggregate."""
    done = F.col("is_completed")
    return fact.agg(
        F.count_if(done).alias("completed_orders"),
        money_total(F.coalesce(F.sum(F.when(done, F.col("net_revenue"))), F.lit(0))).alias("completed_net_revenue"),
        money_total(F.coalesce(F.sum("leakage_amount"), F.lit(0))).alias("revenue_leakage"),
    )


def kpi_headline(fact: DataFrame) -> DataFrame:
    """D-S1: dashboard KPI row. ``order_count`` is what the dashboard labels
    completed orders (a count of all orders, D10); ``completed_orders`` is
    the true count."""
    done = F.col("is_completed")
    g = fact.agg(
        F.count(F.lit(1)).alias("order_count"),
        F.count_if(done).alias("completed_orders"),
        F.sum(F.when(done, F.col("net_revenue"))).alias("_rev"),
        F.count(F.when(done, F.col("net_revenue"))).alias("_n"),
        F.coalesce(F.sum("refunded_amount"), F.lit(0)).alias("_refunded"),
        F.coalesce(F.sum("leakage_amount"), F.lit(0)).alias("_leak"),
        F.count_if(F.col("is_late") & done).alias("_late_done"),
        F.count_distinct(F.when(done, F.col("customer_id"))).alias("active_customers"),
    )
    mean = F.round(F.col("_rev") / F.nullif(F.col("_n").cast("decimal(20,0)"), F.lit(0).cast("decimal(20,0)")), 2)
    return g.select(
        "order_count", "completed_orders",
        money_total(F.coalesce(F.col("_rev"), F.lit(0))).alias("revenue"),
        F.coalesce(mean, F.lit(0)).cast(MONEY).alias("average_order_value"),
        money_total("_refunded").alias("refunded_amount"),
        money_total("_leak").alias("leakage_amount"),
        F.coalesce(ratio_pct("_late_done", "completed_orders"), F.lit(0).cast(RATE)).alias("late_delivery_rate"),
        "active_customers",
    )


def top_products(products: DataFrame, n: int = 8) -> DataFrame:
    """D-S2: the n best-selling products (TopN, ties by id)."""
    return products.orderBy(F.col("revenue").desc_nulls_last(), F.col("product_id").asc()).limit(n)


def top_customers(customers: DataFrame, n: int = 10) -> DataFrame:
    return customers.orderBy(F.col("lifetime_value").desc_nulls_last(), F.col("customer_id").asc()).limit(n)


def gold(s: Silver, fact: DataFrame | None = None) -> dict[str, DataFrame]:
    """All nine gold models of one run (lazy)."""
    fact = fact_order(s) if fact is None else fact
    return {
        "dim_customer": dim_customer(s),
        "dim_product": dim_product(s),
        "fact_order": fact,
        "daily_sales": daily_sales(fact),
        "category_sales": category_sales(s),
        "customer_sales": customer_sales(s, fact),
        "product_sales": product_sales(s),
        "operations_daily": operations_daily(fact),
        "revenue_leakage": revenue_leakage(fact),
    }



# ------------------------------------------------------------------ gate ---
def gate_checks() -> list:
    from vellum.operators import quality as Q
    return [
        Q.duplicate_key("duplicate_customer_ids", "customers", "customer_id"),
        Q.duplicate_key("duplicate_product_ids", "products", "product_id"),
        Q.orphan("orphan_order_customers", "orders", "customer_id", "customers"),
        Q.orphan("orphan_order_items", "order_items", "order_id", "orders"),
        Q.orphan("orphan_products", "order_items", "product_id", "products"),
        Q.orphan("orphan_shipments", "shipments", "order_id", "orders"),
        Q.orphan("orphan_refunds", "refunds", "order_id", "orders"),
    ]


def quality_report(s: Silver) -> DataFrame:
    from vellum.operators import quality as Q
    return Q.report(gate_checks(), {n: getattr(s, n) for n in SILVER})


def gold_tests() -> list:
    """The 23 schema tests of the gold models."""
    from vellum.operators import quality as Q
    T = Q.Test
    return [
        T("gold_dim_customer", "customer_id", "not_null"), T("gold_dim_customer", "customer_id", "unique"),
        T("gold_dim_customer", "email", "not_null"),
        T("gold_dim_product", "product_id", "not_null"), T("gold_dim_product", "product_id", "unique"),
        T("gold_fact_order", "order_id", "not_null"), T("gold_fact_order", "order_id", "unique"),
        T("gold_fact_order", "customer_id", "not_null"),
        T("gold_fact_order", "customer_id", "relationships", to="gold_dim_customer", field="customer_id"),
        T("gold_fact_order", "order_status", "accepted_values", values=ORDER_STATUSES),
        T("gold_fact_order", "net_revenue", "not_null"), T("gold_fact_order", "leakage_amount", "not_null"),
        T("gold_daily_sales", "order_date", "not_null"), T("gold_daily_sales", "order_date", "unique"),
        T("gold_product_sales", "product_id", "not_null"), T("gold_product_sales", "product_id", "unique"),
        T("gold_operations_daily", "order_date", "not_null"), T("gold_operations_daily", "order_date", "unique"),
        T("gold_operations_daily", "net_revenue", "not_null"),
        T("gold_operations_daily", "late_delivery_rate", "not_null"),
        T("gold_revenue_leakage", "leakage_type", "not_null"), T("gold_revenue_leakage", "leakage_type", "unique"),
        T("gold_revenue_leakage", "leakage_amount", "not_null"),
    ]


def gold_models(s: Silver, fact: DataFrame | None = None) -> dict[str, DataFrame]:
    return {f"gold_{k}": v for k, v in gold(s, fact).items()}


def sales_for_period(fact: DataFrame, start, end) -> DataFrame:
    """A serving query with bound parameters (named markers, no string
    formatting of values); the fact is passed as a DataFrame argument."""
    return fact.sparkSession.sql(
        """SELECT order_date, count(*) AS order_count,
                  CAST(sum(net_revenue) AS DECIMAL(22,2)) AS revenue,
                  CAST(sum(leakage_amount) AS DECIMAL(22,2)) AS leakage_amount
           FROM {fact}
           WHERE is_completed AND order_date >= :start AND order_date < :end
           GROUP BY order_date""",
        args={"start": start, "end": end}, fact=fact)
