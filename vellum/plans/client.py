"""C — client data operations: silver exports, scorecard, account health,
daily operations, and the delivery gate.

The scorecard combines four global aggregates. Instead of joining one-row
frames, the four inputs are projected to a tagged union and reduced by a
single aggregate — one pass, partial aggregation per task, no join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellum.functions import (RATE, days_between, money, money_total, norm_lower, norm_upper,
                              ratio_pct)
from vellum.operators import quality as Q
from vellum.sources import adapters
from vellum.sources.tables import Tables, keyed_join, materialize_all, materialized

KEY = "long"

# Accepted domains of the client contract
ACCOUNT_STATUSES = ("active", "trial", "churned")
INVOICE_STATUSES = ("paid", "overdue")
TICKET_PRIORITIES = ("low", "medium", "high")
TICKET_STATUSES = ("open", "resolved")
EVENT_TYPES = ("account_created", "trial_started", "activated", "cancelled")
HEALTH_SEGMENTS = ("healthy", "needs_attention", "trial", "churned")
SLA_DAYS = 2
DEFAULT_CLIENT_ID = "atlas-saas"
DEFAULT_PERIOD = "2025-03-31"


# ---------------------------------------------------------------- silver ---
def silver_accounts(b: DataFrame) -> DataFrame:
    return (b.where(F.col("account_id").isNotNull() & F.col("account_name").isNotNull()
                    & F.col("signup_date").cast("date").isNotNull()
                    & (F.col("monthly_recurring_revenue") >= 0))
            .select(F.col("account_id").cast(KEY).alias("account_id"),
                    F.trim("account_name").alias("account_name"),
                    norm_lower("plan").alias("plan"),
                    norm_upper("country").alias("country"),
                    F.col("signup_date").cast("date").alias("signup_date"),
                    norm_lower("account_status").alias("account_status"),
                    money("monthly_recurring_revenue").alias("monthly_recurring_revenue")))


def silver_invoices(b: DataFrame) -> DataFrame:
    return (b.where(F.col("invoice_id").isNotNull() & F.col("account_id").isNotNull()
                    & (F.col("amount") >= 0))
            .select(F.trim("invoice_id").alias("invoice_id"),
                    F.col("account_id").cast(KEY).alias("account_id"),
                    F.col("invoice_date").cast("date").alias("invoice_date"),
                    money("amount").alias("amount"),
                    norm_lower("invoice_status").alias("invoice_status")))


def silver_support_tickets(b: DataFrame) -> DataFrame:
    return (b.where(F.col("ticket_id").isNotNull() & F.col("account_id").isNotNull()
                    & F.col("created_date").isNotNull())
            .select(F.trim("ticket_id").alias("ticket_id"),
                    F.col("account_id").cast(KEY).alias("account_id"),
                    F.col("created_date").cast("date").alias("created_date"),
                    F.col("resolved_date").try_cast("date").alias("resolved_date"),
                    norm_lower("priority").alias("priority"),
                    norm_lower("ticket_status").alias("ticket_status")))


def silver_account_events(b: DataFrame) -> DataFrame:
    return (b.where(F.col("event_id").isNotNull() & F.col("account_id").isNotNull()
                    & F.col("event_date").isNotNull())
            .select(F.trim("event_id").alias("event_id"),
                    F.col("account_id").cast(KEY).alias("account_id"),
                    F.col("event_date").cast("date").alias("event_date"),
                    norm_lower("event_type").alias("event_type")))


SILVER = {
    "accounts": silver_accounts, "invoices": silver_invoices,
    "support_tickets": silver_support_tickets, "account_events": silver_account_events,
}


class Silver:
    def __init__(self, bronze: dict[str, DataFrame], materialize: bool = False):
        self.bronze = bronze
        self.materialize = materialize
        self._s: dict[str, DataFrame] = {}

    @classmethod
    def from_silver(cls, frames: dict) -> "Silver":
        """Wrap silver tables that were already built (e.g. read from a written layer)."""
        obj = cls({})
        obj._s.update(frames)
        return obj

    @classmethod
    def from_tables(cls, t: Tables, materialize: bool = False) -> "Silver":
        return cls({n: b(t) for n, b in adapters.CLIENT_SOURCES.items()}, materialize)

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in SILVER:
            raise AttributeError(name)
        if name not in self._s:
            self._s[name] = materialized(SILVER[name](self.bronze[name]), self.materialize, f"silver-{name}")
        return self._s[name]

    def materialize_all(self) -> "Silver":
        """Write every silver table (concurrent jobs) and read them back."""
        todo = {n: SILVER[n](self.bronze[n]) for n in SILVER if n not in self._s}
        self._s.update(materialize_all(todo, "silver"))
        return self

    def tables(self) -> dict[str, DataFrame]:
        return {n: getattr(self, n) for n in SILVER}


# ------------------------------------------------------------------ gate ---
def gate_checks() -> list[Q.Check]:
    return [
        Q.duplicate_key("duplicate_account_ids", "accounts", "account_id"),
        Q.duplicate_key("duplicate_invoice_ids", "invoices", "invoice_id"),
        Q.orphan("orphan_invoices", "invoices", "account_id", "accounts"),
        Q.orphan("orphan_tickets", "support_tickets", "account_id", "accounts"),
        Q.orphan("orphan_events", "account_events", "account_id", "accounts"),
        Q.domain("invalid_account_statuses", "accounts", "account_status", ACCOUNT_STATUSES),
        Q.domain("invalid_invoice_statuses", "invoices", "invoice_status", INVOICE_STATUSES),
        Q.domain("invalid_ticket_priorities", "support_tickets", "priority", TICKET_PRIORITIES),
        Q.domain("invalid_ticket_statuses", "support_tickets", "ticket_status", TICKET_STATUSES),
        Q.domain("invalid_event_types", "account_events", "event_type", EVENT_TYPES),
    ]


def quality_report(s: Silver) -> DataFrame:
    return Q.report(gate_checks(), s.tables())


# ------------------------------------------------------------------ gold ---
def _resolved_within_sla() -> F.Column:
    return ((F.col("ticket_status") == "resolved")
            & (days_between("created_date", "resolved_date") <= SLA_DAYS))


def client_scorecard(s: Silver, client_id: str = DEFAULT_CLIENT_ID,
                     reporting_period: str = DEFAULT_PERIOD) -> DataFrame:
    """D-C5: one row of portfolio metrics (single aggregate over a tagged union)."""
    inv = s.invoices.select(F.lit("i").alias("_src"), F.col("invoice_status").alias("_status"),
                            F.col("amount").alias("_amount"))
    acc = s.accounts.select(F.lit("a").alias("_src"), F.col("account_status").alias("_status"),
                            F.col("monthly_recurring_revenue").alias("_amount"))
    evt = s.account_events.select(F.lit("e").alias("_src"), F.col("event_type").alias("_status"))
    tck = s.support_tickets.select(F.lit("t").alias("_src"), F.col("ticket_status").alias("_status"),
                                   _resolved_within_sla().alias("_sla"))
    u = inv.unionByName(acc, allowMissingColumns=True) \
           .unionByName(evt, allowMissingColumns=True) \
           .unionByName(tck, allowMissingColumns=True)
    src, st = F.col("_src"), F.col("_status")
    g = u.agg(
        F.count_if(src == "i").alias("invoice_count"),
        F.count_if((src == "i") & (st == "paid")).alias("paid_invoice_count"),
        F.sum(F.when(src == "i", F.col("_amount"))).alias("_billed"),
        F.sum(F.when((src == "i") & (st == "paid"), F.col("_amount"))).alias("_paid"),
        F.count_if((src == "i") & (st == "overdue")).alias("overdue_invoice_count"),
        F.count_if((src == "a") & (st == "active")).alias("active_accounts"),
        F.count_if((src == "a") & (st == "churned")).alias("churned_accounts"),
        F.sum(F.when((src == "a") & (st == "active"), F.col("_amount"))).alias("_mrr"),
        F.count_if((src == "e") & (st == "trial_started")).alias("_trials"),
        F.count_if((src == "e") & (st == "activated")).alias("_activated"),
        F.count_if(src == "t").alias("tickets_created"),
        F.count_if((src == "t") & (st == "open")).alias("open_tickets"),
        F.count_if((src == "t") & F.coalesce(F.col("_sla"), F.lit(False))).alias("_sla_ok"),
        F.count_if((src == "t") & (st == "resolved")).alias("_resolved"),
    )
    return g.select(
        F.lit(client_id).alias("client_id"),
        F.lit(reporting_period).cast("date").alias("reporting_period"),
        "active_accounts", "churned_accounts",
        money_total("_mrr").alias("mrr"),
        money_total("_billed").alias("billed_revenue"),
        money_total("_paid").alias("paid_revenue"),
        ratio_pct("paid_invoice_count", "invoice_count").alias("collection_rate"),
        ratio_pct("churned_accounts", F.col("active_accounts") + F.col("churned_accounts")).alias("logo_churn_rate"),
        ratio_pct("_activated", "_trials").alias("trial_to_active_rate"),
        "overdue_invoice_count", "tickets_created", "open_tickets",
        ratio_pct("_sla_ok", "_resolved").alias("support_sla_rate"),
    )


def account_health(s: Silver) -> DataFrame:
    """D-C6: per account rollups (pre-aggregated per key) and a segment."""
    inv = (s.invoices.groupBy("account_id")
           .agg(F.sum("amount").alias("i_billed"),
                F.sum(F.when(F.col("invoice_status") == "paid", F.col("amount"))).alias("i_paid"),
                F.count_if(F.col("invoice_status") == "overdue").alias("i_overdue")))
    tck = (s.support_tickets.groupBy("account_id")
           .agg(F.count(F.lit(1)).alias("t_created"),
                F.count_if(F.col("ticket_status") == "open").alias("t_open"),
                ratio_pct(F.count_if(F.coalesce(_resolved_within_sla(), F.lit(False))),
                          F.count_if(F.col("ticket_status") == "resolved")).alias("t_sla")))
    j = keyed_join(keyed_join(s.accounts, inv, "account_id", "left"), tck, "account_id", "left")
    overdue = F.coalesce(F.col("i_overdue"), F.lit(0))
    open_t = F.coalesce(F.col("t_open"), F.lit(0))
    segment = (F.when(F.col("account_status") == "churned", "churned")
               .when((overdue > 0) | (open_t > 0), "needs_attention")
               .when(F.col("account_status") == "trial", "trial")
               .otherwise("healthy"))
    return j.select(
        "account_id", "account_name", "plan", "country", "account_status", "monthly_recurring_revenue",
        money_total(F.coalesce(F.col("i_billed"), F.lit(0))).alias("billed_revenue"),
        money_total(F.coalesce(F.col("i_paid"), F.lit(0))).alias("paid_revenue"),
        overdue.cast("long").alias("overdue_invoices"),
        F.coalesce(F.col("t_created"), F.lit(0)).cast("long").alias("tickets_created"),
        open_t.cast("long").alias("open_tickets"),
        F.coalesce(F.col("t_sla"), F.lit(100).cast(RATE)).alias("support_sla_rate"),
        segment.alias("health_segment"),
    )


def daily_operations(s: Silver) -> DataFrame:
    """D-C7: date spine (distinct union of both date columns) ⟕ daily rollups."""
    dates = (s.invoices.select(F.col("invoice_date").alias("metric_date"))
             .union(s.support_tickets.select(F.col("created_date").alias("metric_date")))
             .distinct())
    inv = (s.invoices.groupBy(F.col("invoice_date").alias("metric_date"))
           .agg(F.sum("amount").alias("i_billed"),
                F.sum(F.when(F.col("invoice_status") == "paid", F.col("amount"))).alias("i_paid"),
                F.count_if(F.col("invoice_status") == "overdue").alias("i_overdue")))
    tck = (s.support_tickets.groupBy(F.col("created_date").alias("metric_date"))
           .agg(F.count(F.lit(1)).alias("t_created"),
                F.count_if(F.col("ticket_status") == "open").alias("t_open")))
    # NULL dates never match an equi-join, as in the reference
    j = dates.join(inv, "metric_date", "left").join(tck, "metric_date", "left")
    return j.select(
        "metric_date",
        money_total(F.coalesce(F.col("i_billed"), F.lit(0))).alias("billed_revenue"),
        money_total(F.coalesce(F.col("i_paid"), F.lit(0))).alias("paid_revenue"),
        F.coalesce(F.col("i_overdue"), F.lit(0)).cast("long").alias("overdue_invoices"),
        F.coalesce(F.col("t_created"), F.lit(0)).cast("long").alias("tickets_created"),
        F.coalesce(F.col("t_open"), F.lit(0)).cast("long").alias("open_tickets"),
    )


def accounts_by_risk(health: DataFrame) -> DataFrame:
    """D-S3 / O2: accounts by overdue, open tickets, paid revenue (all desc)."""
    return (health.select("account_id", "account_name", "plan", "account_status", "paid_revenue",
                          "overdue_invoices", "open_tickets", "support_sla_rate", "health_segment")
            .orderBy(F.col("overdue_invoices").desc_nulls_last(), F.col("open_tickets").desc_nulls_last(),
                     F.col("paid_revenue").desc_nulls_last(), F.col("account_id")))


def needs_attention(health: DataFrame) -> DataFrame:
    """D-S3 / F11: the accounts Customer Success must call."""
    return (health.where(F.col("health_segment") == "needs_attention")
            .select("account_id", "account_name", "overdue_invoices", "open_tickets"))


def gold_tests() -> list[Q.Test]:
    return [
        Q.Test("gold_client_scorecard", "client_id", "not_null"),
        Q.Test("gold_client_scorecard", "client_id", "unique"),
        Q.Test("gold_client_scorecard", "reporting_period", "not_null"),
        Q.Test("gold_client_scorecard", "mrr", "not_null"),
        Q.Test("gold_client_scorecard", "collection_rate", "not_null"),
        Q.Test("gold_account_health", "account_id", "not_null"),
        Q.Test("gold_account_health", "account_id", "unique"),
        Q.Test("gold_account_health", "account_status", "accepted_values", values=ACCOUNT_STATUSES),
        Q.Test("gold_account_health", "health_segment", "accepted_values", values=HEALTH_SEGMENTS),
        Q.Test("gold_daily_operations", "metric_date", "not_null"),
        Q.Test("gold_daily_operations", "metric_date", "unique"),
        Q.Test("gold_daily_operations", "paid_revenue", "not_null"),
    ]


def gold(s: Silver) -> dict[str, DataFrame]:
    return {
        "gold_client_scorecard": client_scorecard(s),
        "gold_account_health": account_health(s),
        "gold_daily_operations": daily_operations(s),
    }

