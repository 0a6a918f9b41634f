"""Named queries: one callable ``(spark, sf_dir) -> DataFrame`` per dataset.

These are the datasets users of the products run; each builds its inputs
from the driver tables through the adapters, so the work grows with them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from vellum.plans import revenue, trips
from vellum.sources import adapters
from vellum.sources.tables import Tables, materialize_all, materialized

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


# ------------------------------------------------------------------ T ---
# Building a query runs no job: every dataset is a lazy plan over the driver
# tables. The exceptions are the queries that are about a written table (a
# numbered queue, a versioned fact, a file round trip, tests of written models).
WRITES_WHILE_BUILDING = frozenset((
    "exception_queue", "exception_queue_carried", "reconcile_digests", "quality_over_loads", "rules_gold", "csv_round_trip", "csv_round_trip_all", "parquet_round_trip", "fact_order_incremental",
    "fact_order_stream", "fact_order_arrivals", "fact_order_corrections", "fact_order_upsert", "fact_order_as_of"))


def _raw_trips(spark, sf):
    return trips.raw_trips(adapters.trip_source(Tables(spark, sf)))


@register("trips_staged")
def _q_trips_staged(spark, sf):
    return trips.staged_trips(_raw_trips(spark, sf))


@register("trips_daily_metrics")
def _q_trips_daily(spark, sf):
    return trips.daily_metrics(trips.staged_trips(_raw_trips(spark, sf)))


@register("trips_quality_report")
def _q_trips_quality(spark, sf):
    return trips.quality_report(_raw_trips(spark, sf))


@register("trips_month")
def _q_trips_month(spark, sf):
    raw = trips.select_month(_raw_trips(spark, sf), "1995-06")
    return trips.daily_metrics(trips.staged_trips(raw))


# ------------------------------------------------------------------ E ---
def _silver(spark, sf) -> revenue.Silver:
    return revenue.Silver.from_tables(Tables(spark, sf))


def _silver_query(entity: str):
    def q(spark, sf):
        return getattr(_silver(spark, sf), entity)
    return q


for _entity in revenue.SILVER:
    register(f"silver_{_entity}")(_silver_query(_entity))


@register("dim_customer")
def _q_dim_customer(spark, sf):
    return revenue.dim_customer(_silver(spark, sf))


@register("dim_product")
def _q_dim_product(spark, sf):
    return revenue.dim_product(_silver(spark, sf))


def _fact(spark, sf):
    return revenue.fact_order(_silver(spark, sf))


@register("fact_order")
def _q_fact_order(spark, sf):
    return _fact(spark, sf)


def _fact_query(mart):
    def q(spark, sf):
        return mart(_fact(spark, sf))
    return q


for _name, _mart in (("daily_sales", revenue.daily_sales),
                     ("operations_daily", revenue.operations_daily),
                     ("revenue_leakage", revenue.revenue_leakage),
                     ("run_totals", revenue.run_totals),
                     ("kpi_headline", revenue.kpi_headline)):
    register(_name)(_fact_query(_mart))


@register("category_sales")
def _q_category_sales(spark, sf):
    return revenue.category_sales(_silver(spark, sf))


@register("product_sales")
def _q_product_sales(spark, sf):
    return revenue.product_sales(_silver(spark, sf))


@register("customer_sales")
def _q_customer_sales(spark, sf):
    s = _silver(spark, sf)
    return revenue.customer_sales(s, _fact(spark, sf))


@register("top_products")
def _q_top_products(spark, sf):
    return revenue.top_products(revenue.product_sales(_silver(spark, sf)))


@register("top_customers")
def _q_top_customers(spark, sf):
    s = _silver(spark, sf)
    return revenue.top_customers(revenue.customer_sales(s, _fact(spark, sf)))


# ------------------------------------------------------------------ C ---
from vellum.plans import client, migration  # noqa: E402


def _client(spark, sf) -> client.Silver:
    return client.Silver.from_tables(Tables(spark, sf))


for _entity, _qname in (("accounts", "silver_accounts"), ("invoices", "silver_invoices"),
                        ("support_tickets", "silver_tickets"), ("account_events", "silver_account_events")):
    register(_qname)((lambda e: lambda spark, sf: getattr(_client(spark, sf), e))(_entity))


@register("client_scorecard")
def _q_client_scorecard(spark, sf):
    return client.client_scorecard(_client(spark, sf))


@register("account_health")
def _q_account_health(spark, sf):
    return client.account_health(_client(spark, sf))


@register("client_daily_operations")
def _q_client_daily(spark, sf):
    return client.daily_operations(_client(spark, sf))


@register("needs_attention")
def _q_needs_attention(spark, sf):
    return client.needs_attention(client.account_health(_client(spark, sf)))


@register("accounts_by_risk")
def _q_accounts_by_risk(spark, sf):
    return client.accounts_by_risk(client.account_health(_client(spark, sf)))


@register("quality_client")
def _q_quality_client(spark, sf):
    return client.quality_report(_client(spark, sf))


@register("quality_revenue")
def _q_quality_revenue(spark, sf):
    return revenue.quality_report(_silver(spark, sf))


# ------------------------------------------------------------------ M ---
def _snap(spark, sf) -> migration.Snapshots:
    return migration.Snapshots.from_tables(Tables(spark, sf))


for _side in migration.SIDES:
    for _entity in migration.ENTITIES:
        register(f"silver_{_side}_{_entity}")(
            (lambda sd, e: lambda spark, sf: _snap(spark, sf).get(sd, e))(_side, _entity))


@register("quality_migration")
def _q_quality_migration(spark, sf):
    return migration.quality_report(_snap(spark, sf))


@register("reconcile_totals")
def _q_reconcile_totals(spark, sf):
    return migration.reconciliation(_snap(spark, sf))


@register("reconcile_keys")
def _q_reconcile_keys(spark, sf):
    return migration.key_reconciliation(_snap(spark, sf))


@register("reconcile_digests")
def _q_reconcile_digests(spark, sf):
    return migration.digest_reconciliation(_snap(spark, sf))


@register("exception_queue")
def _q_exception_queue(spark, sf):
    return _queue(spark, sf)


@register("exception_queue_carried")
def _q_exception_queue_carried(spark, sf):
    """Two rehearsals: the first moved accounts and invoices, the second moved
    everything after the doubled accounts were repaired."""
    found = materialized(migration.exceptions(_snap(spark, sf)), name="exceptions")
    first = migration.numbered_queue(found.where(F.col("entity").isin("accounts", "invoices")))
    return migration.carried_queue(migration.opened(first, "rehearsal-1"),
                                   found.where(F.col("issue_type") != "duplicate_target_key"), "rehearsal-2")


def _queue(spark, sf):
    """The numbered queue is a gold table: exceptions written, then numbered."""
    return migration.exception_queue(_snap(spark, sf))


@register("exceptions_ranked")
def _q_exceptions_ranked(spark, sf):
    return migration.exceptions_ranked(migration.exceptions(_snap(spark, sf)))


@register("exceptions_by_severity")
def _q_exceptions_by_severity(spark, sf):
    return migration.exceptions_by_severity(migration.exceptions(_snap(spark, sf)))


@register("cutover_readiness")
def _q_cutover_readiness(spark, sf):
    m = _snap(spark, sf)
    return migration.cutover_readiness(migration.exceptions(m), migration.reconciliation(m))


@register("cutover_checklist")
def _q_cutover_checklist(spark, sf):
    m = _snap(spark, sf)
    ready = migration.cutover_readiness(migration.exceptions(m), migration.reconciliation(m))
    return migration.cutover_checklist(ready, migration.quality_report(m))


# ------------------------------------------- quality, evidence, intake ---
from functools import reduce as _reduce  # noqa: E402

from pyspark.sql import DataFrame as _DF, Observation  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from vellum.functions import display_time, money_text, title_label  # noqa: E402
from vellum.operators import incremental, profile as _profile, quality as Q  # noqa: E402
from vellum.operators.digests import table_sums  # noqa: E402
from vellum.operators.versions import KeyedTable  # noqa: E402
from vellum import contracts  # noqa: E402
from vellum.plans import evidence  # noqa: E402
from vellum.session import work_dir  # noqa: E402
from vellum.sources import files  # noqa: E402


def _gold_models(spark, sf) -> dict:
    """The models as a run publishes them: silver, fact, queue and the rest written once."""
    s, c, m = (x.materialize_all() for x in (_silver(spark, sf), _client(spark, sf), _snap(spark, sf)))
    fact = materialized(revenue.fact_order(s), name="gold-fact-order")
    models = {**revenue.gold_models(s, fact), **client.gold(c), "gold_reconciliation": migration.reconciliation(m)}
    written = materialize_all({k: v for k, v in models.items() if k != "gold_fact_order"}, "gold")
    written["gold_fact_order"] = fact
    written["gold_exception_queue"] = materialized(migration.exception_queue(m), name="gold-queue")
    written["gold_cutover_readiness"] = migration.cutover_readiness(written["gold_exception_queue"],
                                                                    written["gold_reconciliation"])
    return written


@register("rules_gold")
def _q_rules_gold(spark, sf):
    """Q8–Q11/Q13: the 47 schema tests of the three products' gold models."""
    tests = revenue.gold_tests() + client.gold_tests() + migration.gold_tests()
    return Q.run_tests(tests, _gold_models(spark, sf))


# declared keys of the contract entities (D14: every entity, not only the gate's)
CONTRACT_KEYS = (
    ("revenue", "customers", "customer_id"), ("revenue", "products", "product_id"),
    ("revenue", "orders", "order_id"), ("revenue", "order_items", "order_item_id"),
    ("revenue", "payments", "payment_id"), ("revenue", "shipments", "shipment_id"),
    ("revenue", "refunds", "refund_id"),
    ("client", "accounts", "account_id"), ("client", "invoices", "invoice_id"),
    ("client", "support_tickets", "ticket_id"), ("client", "account_events", "event_id"),
)


def _product_table(spark, sf, product, entity):
    return getattr(_silver(spark, sf) if product == "revenue" else _client(spark, sf), entity)


@register("duplicate_keys")
def _q_duplicate_keys(spark, sf):
    """Every repeated key value of every contract entity, with its rows."""
    parts = []
    for product, entity, key in CONTRACT_KEYS:
        found = Q.repeated_keys(_product_table(spark, sf, product, entity), key)
        parts.append(found.select(F.lit(entity).alias("entity"), F.col("_k").cast("string").alias("record_key"),
                                  F.col("_n").alias("row_count")))
    return _reduce(_DF.unionByName, parts)


CONTRACT_FKS = (
    ("revenue", "orders", "customer_id", "customers", "customer_id"),
    ("revenue", "order_items", "order_id", "orders", "order_id"),
    ("revenue", "order_items", "product_id", "products", "product_id"),
    ("revenue", "payments", "order_id", "orders", "order_id"),
    ("revenue", "shipments", "order_id", "orders", "order_id"),
    ("revenue", "refunds", "order_id", "orders", "order_id"),
    ("client", "invoices", "account_id", "accounts", "account_id"),
    ("client", "support_tickets", "account_id", "accounts", "account_id"),
    ("client", "account_events", "account_id", "accounts", "account_id"),
)


@register("orphan_rows")
def _q_orphan_rows(spark, sf):
    """Orphan child rows per foreign-key value (counted per value)."""
    parts = []
    for product, child, fk, parent, pk in CONTRACT_FKS:
        found = Q.missing_parents(_product_table(spark, sf, product, child), fk, _product_table(spark, sf, product, parent), pk)
        parts.append(found.select(F.lit(child).alias("entity"), F.lit(fk).alias("foreign_key"),
                                  F.col("_k").cast("string").alias("key_value"), F.col("_n").alias("row_count")))
    return _reduce(_DF.unionByName, parts)


CONTRACT_DOMAINS = (
    ("revenue", "orders", "order_status", revenue.ORDER_STATUSES),
    ("revenue", "payments", "payment_status", ("paid", "refunded")),
    ("revenue", "shipments", "shipment_status", ("delivered", "in_transit", "cancelled")),
    ("revenue", "refunds", "refund_status", ("processed",)),
    ("client", "accounts", "account_status", client.ACCOUNT_STATUSES),
    ("client", "invoices", "invoice_status", client.INVOICE_STATUSES),
    ("client", "support_tickets", "priority", client.TICKET_PRIORITIES),
    ("client", "support_tickets", "ticket_status", client.TICKET_STATUSES),
    ("client", "account_events", "event_type", client.EVENT_TYPES),
)


@register("domain_violations")
def _q_domain_violations(spark, sf):
    """Values outside each contract domain (NULL reported too), with rows."""
    parts = []
    for product, entity, column, values in CONTRACT_DOMAINS:
        df = _product_table(spark, sf, product, entity)
        bad = ~F.col(column).isin(*values) | F.col(column).isNull()
        parts.append(df.where(bad).groupBy(F.col(column).alias("value"))
                     .agg(F.count(F.lit(1)).alias("row_count"))
                     .select(F.lit(entity).alias("entity"), F.lit(column).alias("column_name"),
                             "value", "row_count"))
    return _reduce(_DF.unionByName, parts)


@register("quarantine")
def _q_quarantine(spark, sf):
    """Q12: the rows of every contract entity that break its rules, with every reason."""
    bronze = {("revenue", e): df for e, df in _silver(spark, sf).bronze.items()}
    bronze.update({("client", e): df for e, df in _client(spark, sf).bronze.items()})
    bronze.update({(f"migration_{side}", e): df for (side, e), df in _snap(spark, sf).bronze.items()})
    return contracts.quarantined(bronze)


@register("table_profile")
def _q_table_profile(spark, sf):
    """Profile of the order fact and the silver orders."""
    s = _silver(spark, sf)
    return (_profile.profile(s.orders, "silver_orders")
            .unionByName(_profile.profile(_fact(spark, sf), "gold_fact_order",
                                          ["order_id", "customer_id", "carrier", "actual_delivery_date",
                                           "net_revenue", "is_late"])))


@register("change_set")
def _q_change_set(spark, sf):
    """Keys of every entity that changed between the source and target snapshots."""
    m = _snap(spark, sf)
    parts = [incremental.change_set(m.get("source", e), m.get("target", e), key).withColumn("entity", F.lit(e))
             for e, (key, _) in migration.ENTITIES.items()]
    return _reduce(_DF.unionByName, parts)


@register("layer_counts")
def _q_layer_counts(spark, sf):
    """V1: bronze, silver and gold row counts of the revenue product."""
    s = _silver(spark, sf)
    return evidence.layer_counts({
        "bronze": s.bronze,
        "silver": {n: getattr(s, n) for n in revenue.SILVER},
        "gold": revenue.gold(s, _fact(spark, sf)),
    })


def _entries(df, *columns):
    """(section, name, value) rows of the map columns of a one-row frame, as text."""
    parts = [F.transform(F.map_entries(c), lambda e: F.struct(
        F.lit(c).alias("section"), e["key"].alias("name"), e["value"].cast("string").alias("value"))) for c in columns]
    return df.select(F.explode(F.concat(*parts)).alias("e")).select("e.*")


@register("run_evidence")
def _q_run_evidence(spark, sf):
    """V2: the revenue run's summary (counts, checks, totals) as rows, without its run times."""
    s = _silver(spark, sf)
    row = evidence.run_summary(_q_layer_counts(spark, sf), revenue.quality_report(s),
                               revenue.run_totals(_fact(spark, sf)), "full_refresh")
    heads = ("pipeline_mode", "quality_status", "completed_orders", "completed_net_revenue", "revenue_leakage")
    head = F.create_map(*[x for c in heads for x in (F.lit(c), F.col(c).cast("string"))])
    return _entries(row.withColumn("summary", head), "summary", "bronze_rows", "silver_rows", "gold_rows", "quality_checks")


@register("exception_severity_map")
def _q_exception_severity_map(spark, sf):
    """The severity → count map, as its entries in order."""
    counts = migration.severity_map(migration.exceptions(_snap(spark, sf)))
    return counts.select(F.posexplode("exceptions_by_severity").alias("position", "severity", "issue_count")).withColumn(
        "position", F.col("position").cast("long"))


@register("quality_summary")
def _q_quality_summary(spark, sf):
    """Q15: status and score of the client delivery gate."""
    return Q.summary(client.quality_report(_client(spark, sf)))


@register("quality_display")
def _q_quality_display(spark, sf):
    """The gate report as the dashboard shows it."""
    rep = revenue.quality_report(_silver(spark, sf)).unionByName(client.quality_report(_client(spark, sf)))
    return rep.select(title_label("check_name").alias("control"), F.col("incidents"))


@register("leakage_display")
def _q_leakage_display(spark, sf):
    """Leakage per cause with title labels and money text."""
    leak = revenue.revenue_leakage(_fact(spark, sf))
    return leak.select(title_label("leakage_type").alias("cause"), F.col("affected_orders"),
                       money_text("leakage_amount").alias("leakage"), F.col("priority"))




def _scratch(spark, name):
    """A fresh folder under the shared checkpoint folder for a written table."""
    import uuid
    return work_dir(spark, f"{name}-{uuid.uuid4().hex[:12]}")


@register("csv_round_trip")
def _q_csv_round_trip(spark, sf):
    """Bronze customers written as CSV and read back under the contract."""
    bronze = _silver(spark, sf).bronze["customers"]
    path = _scratch(spark, "csv-customers")
    files.write_csv(bronze, path)
    return files.read_csv(spark, path, bronze.schema)


@register("csv_round_trip_all")
def _q_csv_round_trip_all(spark, sf):
    """Every bronze entity of the three products written as CSV and read
    back under its schema: its rows, and the rows that differ on either side."""
    entities = {f"revenue_{e}": df for e, df in _silver(spark, sf).bronze.items()}
    entities.update({f"client_{e}": df for e, df in _client(spark, sf).bronze.items()})
    entities.update({f"migration_{side}_{e}": df for (side, e), df in _snap(spark, sf).bronze.items()})
    base = _scratch(spark, "csv-entities")
    return _reduce(_DF.unionByName, [_csv_round_trip_rows(spark, name, df, f"{base}/{name}") for name, df in entities.items()])


def _csv_round_trip_rows(spark, name, df, path, read=files.read_csv):
    """entity, row_count, differing_rows of one table's round trip. Sums over
    all rows are taken as they are written and as they are read back; only a
    table whose sums differ is grouped by whole rows to count what does."""
    written = Observation()
    files.write_csv(df.observe(written, *table_sums(df.columns)), path, exact=True, compression="gzip")
    back = read(spark, path, df.schema, exact=True)
    if written.get == back.agg(*table_sums(df.columns)).first().asDict():
        return spark.createDataFrame([(name, written.get["n_rows"], 0)], "entity string, row_count long, differing_rows long")
    # a row is there as often on both sides where its signed copies cancel out
    both = df.withColumn("_side", F.lit(1)).unionByName(back.withColumn("_side", F.lit(-1)))
    per_row = both.groupBy(*df.columns).agg(F.sum("_side").alias("_left"), F.count_if(F.col("_side") > 0).alias("_rows"))
    return (per_row.agg(F.coalesce(F.sum("_rows"), F.lit(0)).alias("row_count"),
                        F.coalesce(F.sum(F.abs("_left")), F.lit(0)).alias("differing_rows"))
            .select(F.lit(name).alias("entity"), "row_count", "differing_rows"))


@register("domain_counts")
def _q_domain_counts(spark, sf):
    """How often each value of every contract domain column occurs, and
    whether the contract knows it (a NULL is a value that it doesn't know)."""
    parts = []
    for product, entity, column, values in CONTRACT_DOMAINS:
        counts = _profile.value_counts(_product_table(spark, sf, product, entity), column, values)
        parts.append(counts.select(F.lit(entity).alias("entity"), F.lit(column).alias("column_name"), "value", "in_domain", "row_count"))
    return _reduce(_DF.unionByName, parts)


@register("order_times_display")
def _q_order_times_display(spark, sf):
    """X11: per status, the first and last order as the dashboard shows times."""
    orders = _silver(spark, sf).bronze["orders"]
    g = orders.groupBy("order_status").agg(F.count(F.lit(1)).alias("orders"), F.min("order_date").alias("a"), F.max("order_date").alias("b"))
    return g.select(title_label("order_status").alias("status"), "orders", display_time("a").alias("first_order"),
                    display_time("b").alias("last_order"))


@register("parquet_round_trip")
def _q_parquet_round_trip(spark, sf):
    """The order fact written as a parquet snapshot and read back."""
    path = _scratch(spark, "fact-order")
    files.write_parquet(_fact(spark, sf), path)
    return spark.read.parquet(path)


def _arrivals(orders):
    """Two arrivals by key, as an order system delivers them: the lower half
    of the key range, then everything above it."""
    middle = orders.agg(((F.min("order_id") + F.max("order_id")) / 2).cast("long")).first()[0]
    first = F.col("order_id") <= F.lit(middle)
    return orders.where(first), orders.where(~first)


@register("fact_order_incremental")
def _q_fact_incremental(spark, sf):
    """The second run appends the orders above the stored key
    watermark, which the table's manifest knows; the new version shares the
    files of the first. Both loads make the full fact."""
    s = _silver(spark, sf)
    table = KeyedTable(spark, _scratch(spark, "fact-incremental"), "order_id")
    first, _ = _arrivals(s.orders)
    loaded = table.replace(revenue.fact_order(s, first))
    candidates = revenue.fact_order(s, incremental.above(s.orders, "order_id", table.watermark(loaded)))
    return table.read(table.append(candidates, loaded))


@register("fact_order_arrivals")
def _q_fact_arrivals(spark, sf):
    """S5 with late children: all seven tables land in two arrivals, half of
    the orders after their children and half before; the fact is rebuilt for
    the touched orders only and ends as the full refresh."""
    from vellum.streaming.late_arrivals import STORE_KEYS, ArrivingFact
    bronze = _silver(spark, sf).bronze
    arriving, landing = ArrivingFact(spark, _scratch(spark, "fact-arrivals")), _scratch(spark, "landing")
    for arrival in (0, 1):
        for e, key in STORE_KEYS.items():
            half = F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(2))
            late = 1 - half if e == "orders" else half
            files.append_parquet(bronze[e].where(late == arrival), f"{landing}/{e}")
        arriving.take_in(landing)
        arriving.rebuild()
    return arriving.read()


@register("fact_order_stream")
def _q_fact_stream(spark, sf):
    """S5 as a stream: orders land in two arrivals, the later keys first; each
    availableNow run adds the fact rows of the keys not loaded yet."""
    from vellum.streaming import incremental_stream as stream
    s = _silver(spark, sf)
    landing, base, ckpt = _scratch(spark, "landing"), _scratch(spark, "fact-stream"), _scratch(spark, "stream-ckpt")

    def build(orders):
        return revenue.fact_order(s, orders)

    for arrival in reversed(_arrivals(s.orders)):
        arrival.write.mode("append").parquet(landing)
        stream.run_available(spark, landing, s.orders.schema, build, base, ckpt)
    return stream.read_fact(spark, base)


@register("contract_rules_revenue")
def _q_contract_rules_revenue(spark, sf):
    """Contract rules on the revenue bronze entities."""
    from vellum import contracts
    s = _silver(spark, sf)
    return Q.report(contracts.revenue_contract_rules(), contracts.revenue_rule_inputs(s.bronze))


@register("migration_rows")
def _q_migration_rows(spark, sf):
    """D-S4: delivered (bronze) and accepted (silver) rows per side and entity."""
    m = _snap(spark, sf)
    parts = []
    for side in migration.SIDES:
        for e in migration.ENTITIES:
            b = m.bronze[(side, e)].agg(F.count(F.lit(1)).alias("bronze_rows"))
            parts.append(b.select(F.lit(side).alias("side"), F.lit(e).alias("entity"), "bronze_rows",
                                  F.lit(None).cast("long").alias("silver_rows")))
            sv = m.get(side, e).agg(F.count(F.lit(1)).alias("silver_rows"))
            parts.append(sv.select(F.lit(side).alias("side"), F.lit(e).alias("entity"),
                                   F.lit(None).cast("long").alias("bronze_rows"), "silver_rows"))
    return (_reduce(_DF.unionByName, parts).groupBy("side", "entity")
            .agg(F.max("bronze_rows").alias("bronze_rows"), F.max("silver_rows").alias("silver_rows")))


@register("sales_for_period")
def _q_sales_for_period(spark, sf):
    """Completed sales per day of one calendar year, through bound SQL parameters."""
    import datetime as dt
    return revenue.sales_for_period(_fact(spark, sf), dt.date(1995, 1, 1), dt.date(1996, 1, 1))


@register("contract_rules_migration")
def _q_contract_rules_migration(spark, sf):
    """Key and amount rules on both bronze snapshots."""
    from vellum import contracts
    m = _snap(spark, sf)
    tables = {f"{side}_{e}": m.bronze[(side, e)] for side in migration.SIDES for e in migration.ENTITIES}
    return Q.report(contracts.migration_contract_rules(migration.ENTITIES), tables)


@register("quality_over_loads")
def _q_quality_over_loads(spark, sf):
    """Q2–Q6 over loads: the target snapshot lands in two halves, children
    before their parents; the second report covers both, from the second half
    and the stored facts of the first. Equal to the full gate over all rows."""
    from vellum import contracts
    from vellum.operators.load_gate import LoadGate
    bronze = {f"target_{e}": df for (side, e), df in _snap(spark, sf).bronze.items() if side == "target"}
    checks = [c for c in contracts.migration_contract_rules(migration.ENTITIES) if c.entity in bronze]
    checks += [Q.orphan(f"orphan_{e}", e, "account_id", "target_accounts") for e in bronze if e != "target_accounts"]
    gate, landed = LoadGate(spark, _scratch(spark, "gate"), checks), [{}, {}]
    for e, df in bronze.items():
        half = F.pmod(F.xxhash64(F.col(migration.ENTITIES[e.removeprefix("target_")][0]).cast("string")), F.lit(2))
        late = 1 - half if e == "target_accounts" else half
        for arrival in (0, 1):
            landed[arrival][e] = df.where(late == arrival)
    gate.accept(landed[0], tag="first")
    return gate.report(landed[1])


# ------------------------------------- the generic gate on other tables ---
def _documents(spark, sf):
    t = Tables(spark, sf)
    # exact copies are found on a digest of the whole text: the shuffle
    # carries 32 bytes per row instead of texts of up to 20,000 words
    docs = t.documents.select("doc_id", "lang", "source", "n_chars",
                              F.sha2(F.col("text"), 256).alias("text_sha256"))
    return docs, t.labels


@register("quality_documents")
def _q_quality_documents(spark, sf):
    """Q2–Q5 on documents and their labels (keys, copies, orphans, label domains)."""
    docs, labels = _documents(spark, sf)
    checks = [
        Q.null_key("null_document_ids", "documents", "doc_id"),
        Q.duplicate_key("duplicate_document_ids", "documents", "doc_id"),
        Q.duplicate_key("duplicate_document_texts", "documents", "text_sha256"),
        Q.row_rule("empty_documents", "documents", F.col("n_chars") <= 0),
        Q.duplicate_key("duplicate_label_doc_ids", "labels", "doc_id"),
        Q.orphan("orphan_labels", "labels", "doc_id", "documents"),
        Q.domain("invalid_quality_labels", "labels", "quality", (0, 1), null_violates=True),
        Q.domain("invalid_toxic_labels", "labels", "toxic", (0, 1), null_violates=True),
    ]
    return Q.report(checks, {"documents": docs, "labels": labels})


@register("documents_profile")
def _q_documents_profile(spark, sf):
    """G4 on documents (text distinctness on the digest of the whole text) and labels."""
    docs, labels = _documents(spark, sf)
    return _profile.profile(docs, "documents").unionByName(_profile.profile(labels, "labels"))


# ------------------------------------------- focused operator queries ---
@register("literals_and_casts")
def _q_literals_and_casts(spark, sf):
    """Key to text, date literal, typed NULL, decimal widening."""
    inv = _snap(spark, sf).get("source", "invoices")
    return inv.select(
        F.col("account_id").cast("string").alias("account_key"),
        F.col("invoice_id"),
        F.lit("2025-03-31").cast("date").alias("reporting_period"),
        F.lit(None).cast("decimal(14,2)").alias("no_amount"),
        F.col("amount").cast("decimal(14,2)").alias("amount_14_2"),
        F.lit("open").alias("status"))


@register("earliest_deliveries")
def _q_earliest_deliveries(spark, sf):
    """Top-N ascending with NULLs last (Spark's ascending default
    puts NULLs first; the reference engine puts them last)."""
    fact = _fact(spark, sf)
    return (fact.select("order_id", "actual_delivery_date", "carrier")
            .orderBy(F.col("actual_delivery_date").asc_nulls_last(), F.col("order_id")).limit(10))


@register("filtered_vs_conditional_sum")
def _q_filtered_vs_conditional(spark, sf):
    """A8 vs A9: a filtered sum is NULL when no row matches, a conditional
    sum with ELSE 0 is 0."""
    inv = _client(spark, sf).invoices
    paid = F.col("invoice_status") == "paid"
    return (inv.groupBy("account_id")
            .agg(F.sum(F.when(paid, F.col("amount"))).cast("decimal(22,2)").alias("paid_filtered"),
                 F.sum(F.when(paid, F.col("amount")).otherwise(F.lit(0))).cast("decimal(22,2)").alias("paid_conditional"),
                 F.count_if(~paid).alias("unpaid_invoices")))


@register("referential_coverage")
def _q_referential_coverage(spark, sf):
    """Share of child rows with a parent, for every contract foreign key."""
    parts = []
    for product, child, fk, parent, pk in CONTRACT_FKS:
        parts.append(_profile.referential_coverage(_product_table(spark, sf, product, child), fk,
                                                   _product_table(spark, sf, product, parent), pk,
                                                   f"{child}.{fk} -> {parent}.{pk}"))
    return _reduce(_DF.unionByName, parts)


# ------------------------------------------------------------ manifests ---
@register("migration_manifest")
def _q_migration_manifest(spark, sf):
    """V4: the manifest's decision, severities, checklist and reconciliation as rows, without its run times."""
    from vellum.plans import pipeline
    m = _snap(spark, sf)
    recon, exceptions = migration.reconciliation(m), migration.exceptions(m)
    gold = {"gold_reconciliation": recon, "gold_exception_queue": exceptions,
            "gold_cutover_readiness": migration.cutover_readiness(exceptions, recon)}
    row = pipeline.migration_manifest(gold, migration.quality_report(m), migration.DEFAULT_MIGRATION_ID, 0.0, 24)
    head = F.create_map(*[x for c in ("migration_id", "cutover_decision", "delivery_status") for x in (F.lit(c), F.col(c))])
    steps = F.map_from_entries(F.transform("checklist", lambda c: F.struct(
        c["check_name"], F.concat_ws("/", c["step"].cast("string"), c["status"], c["owner"]))))
    state = F.map_from_entries(F.transform("reconciliation", lambda c: F.struct(
        c["entity"], F.concat_ws("/", c["source_count"].cast("string"), c["target_count"].cast("string"), c["reconciliation_status"]))))
    return _entries(row.select(head.alias("manifest"), steps.alias("checklist"), state.alias("reconciliation"), "exceptions_by_severity"),
                    "manifest", "checklist", "reconciliation", "exceptions_by_severity")


@register("delivery_manifest")
def _q_delivery_manifest(spark, sf):
    """V3: the client delivery's status, checks, source counts and scorecard as rows, without its run times."""
    from vellum.plans import pipeline
    c = _client(spark, sf)
    row = pipeline.delivery_manifest(client.client_scorecard(c), evidence.layer_counts({"bronze": c.bronze}),
                                     client.quality_report(c), client.DEFAULT_CLIENT_ID, client.DEFAULT_PERIOD, 0.0, 24)
    heads = ("client_id", "delivery_id", "delivery_status", "reporting_period", "quality_gate.status", "quality_gate.score")
    head = F.create_map(*[x for h in heads for x in (F.lit(h.split(".")[-1]), F.col(h).cast("string"))])
    scores = [f.name for f in row.schema["scorecard"].dataType]
    score = F.create_map(*[x for n in scores for x in (F.lit(n), F.col(f"scorecard.{n}").cast("string"))])
    flat = row.select(head.alias("manifest"), F.col("quality_gate.checks").alias("checks"),
                      F.col("quality_gate.source_rows").alias("source_rows"), score.alias("scorecard"))
    return _entries(flat, "manifest", "checks", "source_rows", "scorecard")


REFUNDS_KNOWN_BEFORE = "1996-01-01"


def _stored_fact(spark, sf):
    """The fact as an earlier run stored it, when only the refunds up to a date had arrived."""
    s = _silver(spark, sf)
    known = s.refunds.where(F.col("refund_date") < F.lit(REFUNDS_KNOWN_BEFORE).cast("date"))
    earlier = revenue.Silver.from_silver({**{n: getattr(s, n) for n in revenue.SILVER}, "refunds": known})
    table = KeyedTable(spark, _scratch(spark, "fact-versions"), "order_id")
    table.replace(revenue.fact_order(earlier))
    return table


@register("fact_order_corrections")
def _q_fact_corrections(spark, sf):
    """Orders whose fact row changed since the stored version (later
    refunds are corrections to old keys, which the watermark load can't see)."""
    cs = incremental.change_set(_stored_fact(spark, sf).read(), _fact(spark, sf), "order_id")
    return cs.groupBy("change_type").agg(F.count(F.lit(1)).alias("orders"))


def _corrected(spark, sf):
    """The stored fact with every changed, new or removed order applied, as its next version."""
    table, current = _stored_fact(spark, sf), _fact(spark, sf)
    changes = materialized(incremental.changed_keys(table.read(), current, "order_id"), name="changes")
    take = changes.where(F.col("change_type") != "removed").select("_key")
    table.merge(changes, current.join(take, current["order_id"].eqNullSafe(take["_key"]), "left_semi"))
    return table


@register("fact_order_upsert")
def _q_fact_upsert(spark, sf):
    """S5 upsert mode: the corrected version, equal to a full refresh; files
    without a changed order are shared with the version before."""
    return _corrected(spark, sf).read()


@register("fact_order_as_of")
def _q_fact_as_of(spark, sf):
    """A reader of the version before the corrections still sees its rows."""
    table = _corrected(spark, sf)
    first = table.log().agg(F.min("version").alias("v")).first()["v"]
    return table.read(first)
