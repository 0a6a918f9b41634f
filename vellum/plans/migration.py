"""M — migration assurance: silver snapshots of both sides, the source gate,
reconciliation, the exception queue, the cutover decision and checklist."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellum.functions import money, norm_lower, norm_upper
from vellum.operators import quality as Q
from vellum.operators.digests import digest, reconcile_by_digest
from vellum.operators.numbering import number_rows
from vellum.operators.reconcile import reconcile_keys, reconcile_totals
from vellum.sources import adapters
from vellum.sources.tables import Tables, materialize_all, materialized

KEY = "long"
SIDES = ("source", "target")

# Entity → (key, amount column); queue rules and texts
ENTITIES = {
    "accounts": ("account_id", "monthly_value"),
    "invoices": ("invoice_id", "amount"),
    "transactions": ("transaction_id", "amount"),
    "contacts": ("contact_id", None),
}
QUEUE_RULES = (
    ("accounts", "missing_in_target", "high", "Source account has no matching target record.", "Migration lead"),
    ("accounts", "duplicate_target_key", "high", "Target contains more than one record for the same account key.", "CRM owner"),
    ("invoices", "missing_in_target", "high", "Source invoice has no matching target record.", "Finance"),
    ("invoices", "amount_mismatch", "high", "Invoice amount differs between source and target.", "Finance"),
    ("contacts", "missing_in_target", "medium", "Source contact has no matching target record.", "CRM owner"),
)
DEFAULT_MIGRATION_ID = "MIG-2026-09-W03"
WAVE = "03"
REASON_HOLD = "Resolve high-severity exceptions before cutover."
REASON_REVIEW = "Review reconciliation differences before sign-off."
REASON_READY = "All reconciliation checks passed. Obtain business sign-off."
CHECKLIST = (
    ("source_snapshot_received", "Data"),
    ("source_quality_gate", "Data"),
    ("row_and_amount_reconciliation", "Data"),
    ("blocking_exceptions_resolved", "Migration lead"),
    ("finance_signoff", "Finance"),
    ("business_owner_signoff", "Business owner"),
)


# ---------------------------------------------------------------- silver ---
def silver(entity: str, b: DataFrame) -> DataFrame:
    """The same typing and filtering rules for both sides."""
    if entity == "accounts":
        return (b.where(F.col("account_id").isNotNull() & F.col("account_name").isNotNull()
                        & (F.col("monthly_value") >= 0))
                .select(F.col("account_id").cast(KEY).alias("account_id"),
                        F.trim("account_name").alias("account_name"),
                        norm_upper("country").alias("country"),
                        F.col("created_date").cast("date").alias("created_date"),
                        money("monthly_value").alias("monthly_value")))
    if entity in ("invoices", "transactions"):
        key = ENTITIES[entity][0]
        date, kind = (("invoice_date", "invoice_status") if entity == "invoices"
                      else ("transaction_date", "transaction_type"))
        return (b.where(F.col(key).isNotNull() & F.col("account_id").isNotNull() & (F.col("amount") >= 0))
                .select(F.trim(key).alias(key),
                        F.col("account_id").cast(KEY).alias("account_id"),
                        F.col(date).cast("date").alias(date),
                        money("amount").alias("amount"),
                        norm_lower(kind).alias(kind)))
    if entity == "contacts":
        return (b.where(F.col("contact_id").isNotNull() & F.col("account_id").isNotNull()
                        & F.col("email").isNotNull())
                .select(F.trim("contact_id").alias("contact_id"),
                        F.col("account_id").cast(KEY).alias("account_id"),
                        norm_lower("email").alias("email"),
                        norm_upper("country").alias("country"),
                        norm_lower("contact_status").alias("contact_status")))
    raise ValueError(entity)


class Snapshots:
    """Silver tables of both sides, keyed (side, entity)."""

    def __init__(self, bronze: dict[tuple[str, str], DataFrame], materialize: bool = False):
        self.bronze = bronze
        self.materialize = materialize
        self._s: dict[tuple[str, str], DataFrame] = {}

    @classmethod
    def from_silver(cls, frames: dict) -> "Snapshots":
        """Wrap silver tables that were already built (e.g. read from a written layer)."""
        obj = cls({})
        obj._s.update(frames)
        return obj

    @classmethod
    def from_tables(cls, t: Tables, materialize: bool = False) -> "Snapshots":
        b = {}
        for e in ENTITIES:
            b[("source", e)] = adapters.migration_source(t, e)
            b[("target", e)] = adapters.migration_target(t, e)
        return cls(b, materialize)

    def get(self, side: str, entity: str) -> DataFrame:
        if (side, entity) not in self._s:
            self._s[(side, entity)] = materialized(silver(entity, self.bronze[(side, entity)]), self.materialize,
                                                   f"silver-{side}-{entity}")
        return self._s[(side, entity)]

    def materialize_all(self) -> "Snapshots":
        """Write both snapshots (concurrent jobs) and read them back."""
        todo = {k: silver(k[1], b) for k, b in self.bronze.items() if k not in self._s}
        self._s.update(materialize_all(todo, "silver"))
        return self


# ------------------------------------------------------------------ gate ---
def gate_checks() -> list[Q.Check]:
    checks = []
    for e, (key, _) in ENTITIES.items():
        checks.append(Q.duplicate_key(f"duplicate_source_{e}", e, key))
        checks.append(Q.null_key(f"null_source_{key}", e, key))
    for e in ("invoices", "transactions", "contacts"):
        checks.append(Q.orphan(f"orphan_source_{e}", e, "account_id", "accounts"))
    return checks


def quality_report(m: Snapshots) -> DataFrame:
    return Q.report(gate_checks(), {e: m.get("source", e) for e in ENTITIES})


# ------------------------------------------------------------------ gold ---
def reconciliation(m: Snapshots) -> DataFrame:
    """D-M2 / G2: counts and totals per entity."""
    parts = [reconcile_totals(m.get("source", e), m.get("target", e), e, amount)
             for e, (_, amount) in ENTITIES.items()]
    return reduce(DataFrame.unionByName, parts)


def key_reconciliation(m: Snapshots) -> DataFrame:
    """G1 over every entity: all issue types the contract implies."""
    parts = [reconcile_keys(m.get("source", e), m.get("target", e), key, amount, entity=e)
             for e, (key, amount) in ENTITIES.items()]
    return reduce(DataFrame.unionByName, parts)


def digest_reconciliation(m: Snapshots) -> DataFrame:
    """G1 by digest tree: the same issues; only differing buckets are joined."""
    made = materialize_all({(side, e): digest(m.get(side, e), key, amount)
                            for e, (key, amount) in ENTITIES.items() for side in ("source", "target")}, "digest")
    parts = [reconcile_by_digest(m.get("source", e), m.get("target", e), key, amount, entity=e,
                                 source_digest=made["source", e], target_digest=made["target", e])
             for e, (key, amount) in ENTITIES.items()]
    return reduce(DataFrame.unionByName, parts)


def exceptions(m: Snapshots) -> DataFrame:
    """The five (entity, issue) pairs the queue carries, with severity,
    description and owner; one row per key and issue."""
    keyed = key_reconciliation(m)
    wanted = F.lit(False)
    sev = desc = own = None
    for entity, issue, severity, description, owner in QUEUE_RULES:
        hit = (F.col("entity") == entity) & (F.col("issue_type") == issue)
        wanted = wanted | hit
        sev = F.when(hit, severity) if sev is None else sev.when(hit, severity)
        desc = F.when(hit, description) if desc is None else desc.when(hit, description)
        own = F.when(hit, owner) if own is None else own.when(hit, owner)
    return (keyed.where(wanted)
            .select("entity", "record_key", "issue_type", sev.alias("severity"),
                    desc.alias("description"), own.alias("owner"), F.lit("open").alias("status")))


def exception_queue(m: Snapshots) -> DataFrame:
    """D-M3: numbered queue; numbering follows severity as text (descending),
    entity, key — the reference order (D9) — without a single partition.
    The exceptions are written first, so sampling their order for the range
    partitioning reads the written rows and not the reconcile again."""
    return numbered_queue(materialized(exceptions(m), name="exceptions"))


def numbered_queue(written: DataFrame) -> DataFrame:
    """The queue of written exceptions."""
    numbered = number_rows(written, [F.col("severity").desc_nulls_last(), F.col("entity").asc_nulls_last(),
                                F.col("record_key").asc_nulls_last(), F.col("issue_type").asc_nulls_last()],
                           name="exception_id")
    return numbered.select("exception_id", "entity", "record_key", "issue_type", "severity",
                           "description", "owner", "status")


INCIDENT = ("entity", "record_key", "issue_type")


def opened(queue: DataFrame, run: str) -> DataFrame:
    """A first numbered queue with the history columns of ``carried_queue``."""
    return queue.withColumns({"first_seen": F.lit(run), "closed_in": F.lit(None).cast("string")})


def carried_queue(previous: DataFrame, current: DataFrame, run: str) -> DataFrame:
    """The queue of ``run``: numbers, first-seen runs and closed states carried
    over from the previous queue by incident (entity, record key, issue).

    An incident of both keeps its number and first-seen run, and is open
    (again, if it was closed). One that is gone stays in the queue as closed,
    with the run that no longer found it. New ones are numbered on from the
    largest number, in the order of a first queue. Both sides hold an incident
    once, so the join can't skew; the same two inputs always give the same
    numbers, so a run may be repeated.
    """
    was = previous.select(*[F.col(c).alias(f"was_{c}") for c in previous.columns])
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"was_{c}")) for c in INCIDENT])
    both = materialized(current.withColumn("found", F.lit(True)).join(was, same, "full_outer"), name="incidents")
    found = F.col("found").isNotNull()
    either = [F.when(found, F.col(c)).otherwise(F.col(f"was_{c}")).alias(c)
              for c in (*INCIDENT, "severity", "description", "owner")]
    known = both.where("was_exception_id IS NOT NULL").select(
        F.col("was_exception_id").alias("exception_id"), *either, F.when(found, "open").otherwise("closed").alias("status"),
        F.col("was_first_seen").alias("first_seen"),
        F.when(~found, F.coalesce("was_closed_in", F.lit(run))).alias("closed_in"))
    last = previous.agg(F.max("exception_id")).first()[0] or 0
    new = numbered_queue(both.where("was_exception_id IS NULL").select(
        *INCIDENT, "severity", "description", "owner", "status"))
    return known.unionByName(opened(new.withColumn("exception_id", F.col("exception_id") + F.lit(last)), run))


def exceptions_ranked(queue: DataFrame) -> DataFrame:
    """D-S4 / O3: business order, high first."""
    rank = F.when(F.col("severity") == "high", 1).otherwise(2)
    return (queue.select("entity", "record_key", "issue_type", "severity", "description", "owner", "status")
            .orderBy(rank, "entity", "record_key", "issue_type"))


def exceptions_by_severity(queue: DataFrame) -> DataFrame:
    """Exception counts per severity."""
    return queue.groupBy("severity").agg(F.count(F.lit(1)).alias("issue_count"))


def severity_map(queue: DataFrame) -> DataFrame:
    """A17 as the manifest carries it: one row with a severity → count map."""
    counts = exceptions_by_severity(queue)
    return counts.agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("severity", "issue_count"))))
                      .alias("exceptions_by_severity"))


def cutover_readiness(queue: DataFrame, recon: DataFrame,
                      migration_id: str = DEFAULT_MIGRATION_ID) -> DataFrame:
    """D-M4: HOLD iff any high exception; one aggregate over a tagged union."""
    u = (queue.select(F.lit("q").alias("_src"), F.col("severity").alias("_v"))
         .unionByName(recon.select(F.lit("r").alias("_src"), F.col("reconciliation_status").alias("_v"))))
    q, r, v = F.col("_src") == "q", F.col("_src") == "r", F.col("_v")
    g = u.agg(F.count_if(q).alias("total_exceptions"),
              F.count_if(q & (v == "high")).alias("high_exceptions"),
              F.count_if(q & (v == "medium")).alias("medium_exceptions"),
              F.count_if(r).alias("entity_count"),
              F.count_if(r & (v == "passed")).alias("passed_entities"))
    hold = F.col("high_exceptions") > 0
    return g.select(
        F.lit(migration_id).alias("migration_id"), F.lit(WAVE).alias("wave"),
        F.when(hold, "HOLD").otherwise("READY").alias("cutover_decision"),
        "total_exceptions", "high_exceptions", "medium_exceptions", "entity_count", "passed_entities",
        F.when(hold, REASON_HOLD)
         .when(F.col("passed_entities") < F.col("entity_count"), REASON_REVIEW)
         .otherwise(REASON_READY).alias("decision_reason"),
    )


def cutover_checklist(readiness: DataFrame, gate_report: DataFrame) -> DataFrame:
    """D-M5: six controls; statuses follow the decision and the source gate."""
    u = (readiness.select(F.col("cutover_decision").alias("_d"), F.lit(None).cast("long").alias("_i"))
         .unionByName(gate_report.select(F.lit(None).cast("string").alias("_d"), F.col("incidents").alias("_i"))))
    g = u.agg(F.max("_d").alias("decision"), F.coalesce(F.sum("_i"), F.lit(0)).alias("incidents"))
    d = F.col("decision")
    status = {
        "source_snapshot_received": F.lit("passed"),
        "source_quality_gate": F.when(F.col("incidents") == 0, "passed").otherwise("failed"),
        "row_and_amount_reconciliation": F.when(d != "READY", "review").otherwise("passed"),
        "blocking_exceptions_resolved": F.when(d == "HOLD", "blocked").otherwise("passed"),
        "finance_signoff": F.lit("pending"),
        "business_owner_signoff": F.lit("pending"),
    }
    items = F.array(*[F.struct(F.lit(i + 1).alias("step"), F.lit(c).alias("check_name"),
                               status[c].alias("status"), F.lit(o).alias("owner"))
                      for i, (c, o) in enumerate(CHECKLIST)])
    return g.select(F.explode(items).alias("c")).select("c.*")


def gold_tests() -> list[Q.Test]:
    return [
        Q.Test("gold_reconciliation", "entity", "not_null"),
        Q.Test("gold_reconciliation", "entity", "unique"),
        Q.Test("gold_reconciliation", "source_count", "not_null"),
        Q.Test("gold_reconciliation", "target_count", "not_null"),
        Q.Test("gold_reconciliation", "reconciliation_status", "accepted_values", values=("passed", "review")),
        Q.Test("gold_exception_queue", "exception_id", "not_null"),
        Q.Test("gold_exception_queue", "exception_id", "unique"),
        Q.Test("gold_exception_queue", "severity", "accepted_values", values=("high", "medium")),
        Q.Test("gold_exception_queue", "status", "accepted_values", values=("open",)),
        Q.Test("gold_cutover_readiness", "migration_id", "not_null"),
        Q.Test("gold_cutover_readiness", "migration_id", "unique"),
        Q.Test("gold_cutover_readiness", "cutover_decision", "accepted_values", values=("HOLD", "READY")),
    ]
