"""The layered runs of the four products.

bronze (as delivered) → silver (typed, filtered) → gate → gold → model
tests → publish → evidence. Every layer is written as parquet under
``out_dir`` (a shared location on a cluster) and the next layer reads the
written files; the tables of one layer are written as concurrent jobs. Only
small reports (gate, tests, evidence row) are collected to the driver.

The revenue, client and migration runs write into a folder of their own and
publish it after the gate and the model tests (``plans.runs``); a run that
stops is taken over by the next one with the same inputs and parameters. The
revenue fact is a versioned table whose versions share files
(``operators.versions``); the published run names its version.
"""

from __future__ import annotations

import json
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vellum import contracts
from vellum.operators import incremental, quality as Q
from vellum.operators.versions import KeyedTable
from vellum.plans import client, evidence, migration, revenue, runs, trips
from vellum.plans.runs import Run
from vellum.sources import adapters, files
from vellum.sources.tables import Tables, write_table


def write_layer(frames: dict, base: str, parallel: int = 8, counts: dict | None = None) -> dict[str, DataFrame]:
    """Write each frame to ``base/<name>`` (concurrent jobs) and read them back.

    With ``counts``, each table's row count is observed while it is written
    (``DataFrame.observe``), so the run evidence needs no second scan.
    """
    from concurrent.futures import ThreadPoolExecutor

    from pyspark.sql import Observation

    def one(item):
        name, df = item
        label = name if isinstance(name, str) else "_".join(name)
        path = f"{base.rstrip('/')}/{label}"
        obs = None
        if counts is not None:
            obs = Observation(f"rows_{label}_{time.time_ns()}")
            df = df.observe(obs, F.count(F.lit(1)).alias("rows"))
        written = write_table(df, path)
        if obs is not None:
            counts[label] = int(obs.get["rows"])
        return name, written

    with ThreadPoolExecutor(max_workers=max(1, min(parallel, len(frames)))) as pool:
        return dict(pool.map(one, frames.items()))


CORRUPT = "_corrupt_record"


def intake(spark: SparkSession, contract: dict, source_dir: str, out_dir: str, label: str,
           run: Run | None = None) -> dict[str, DataFrame]:
    """A product's CSV folder (``<entity>.csv``) under its contract.

    Every missing file is named at once. The files are parsed once, into the
    ``intake`` tables (of the run, if one is given); lines that don't parse
    under the contract's types are set aside as delivered
    (``quarantine/<label>_lines``).
    """
    base = source_dir.rstrip("/")
    files.require_inputs(spark, {f"{e}.csv": f"{base}/{e}.csv" for e in contract})
    good, bad = {}, []
    for e, schema in contract.items():
        def parsed(e=e, schema=schema) -> DataFrame:
            return files.read_csv(spark, f"{base}/{e}.csv", schema, corrupt_column=CORRUPT)

        rows = run.table(f"intake/{label}_{e}", parsed) if run else write_table(parsed(), f"{out_dir}/intake/{label}_{e}")
        good[e] = rows.where(F.col(CORRUPT).isNull()).drop(CORRUPT)
        bad.append(rows.where(F.col(CORRUPT).isNotNull()).select(F.lit(e).alias("entity"), F.col(CORRUPT).alias("line")))
    every = bad[0]
    for more in bad[1:]:
        every = every.unionByName(more)

    def aside() -> None:
        write_table(every, f"{out_dir}/quarantine/{label}_lines")

    run.once(f"lines/{label}", aside) if run else aside()
    return good


def _set_aside(bronze: dict, out_dir: str, run: Run) -> None:
    """Q12: the delivered rows that break a contract rule, written with every reason."""
    def aside() -> None:
        write_table(contracts.quarantined(bronze), f"{out_dir}/quarantine/rows")

    run.once("quarantine", aside)


def _gated(run: Run, build) -> tuple[DataFrame, dict[str, int]]:
    """The gate report, computed once per run and read by the gate and the
    evidence; the run is held if a check fails."""
    report = run.table("gate/report", lambda: build().coalesce(1))
    try:
        return report, Q.gate(report)
    except Q.QualityGateError as err:
        run.held(err.report)
        raise


def _tested(run: Run, tests: list, models: dict) -> dict[str, int]:
    """The model tests; the run is held if one fails."""
    try:
        return run.once("tests", lambda: _fail_on_tests(Q.run_tests(tests, models)))
    except Q.QualityGateError as err:
        run.held(err.report)
        raise


def _export(run: Run, gold: dict[str, DataFrame], out_dir: str) -> None:
    """The published deliverables at the place where clients pick them up."""
    for name, df in gold.items():
        run.once(f"export/{name}", lambda name=name, df=df: write_table(df, f"{out_dir}/gold/{name}") and None)


def _published_evidence(run: Run, row, out_dir: str) -> dict:
    return run.once("evidence", lambda: _write_evidence(row(), f"{out_dir}/evidence/run={run.id}"))


def _counts_frame(spark: SparkSession, layers: dict[str, dict[str, int]]) -> DataFrame:
    """(layer, table_name, row_count) rows from observed counts (tens of rows)."""
    rows = [(layer, name, int(n)) for layer, tables in layers.items() for name, n in tables.items()]
    return spark.createDataFrame(rows, "layer string, table_name string, row_count long")


def _fail_on_tests(report: DataFrame) -> dict[str, int]:
    res = {r["test_name"]: int(r["failures"]) for r in report.collect()}
    bad = {k: v for k, v in res.items() if v}
    if bad:
        raise Q.QualityGateError(bad)
    return res


def _write_evidence(row: DataFrame, path: str) -> dict:
    """Write the one-row evidence and return it as read back from the file
    (the row is computed once; the returned dict is what was published)."""
    files.write_json(row, path)
    return json.loads(row.sparkSession.read.text(path).first()[0])


# ------------------------------------------------------------------- T ---
def run_trips(spark: SparkSession, sf_dir: str | None, out_dir: str, month: str | None = None,
              source_dir: str | None = None) -> dict:
    """T: raw → staged → quality gate → daily metrics (parquet) → summary JSON.

    With ``source_dir`` the month's own file is read
    (``<source_dir>/yellow_tripdata_<YYYY-MM>.parquet``, S10); otherwise the
    trips are derived from the driver tables of ``sf_dir``.
    """
    if month is not None:
        trips.check_month(month)
    if source_dir is not None:
        if month is None:
            raise ValueError("a month is required to pick the source file")
        path = files.monthly_file(source_dir, month)
        files.require_inputs(spark, {f"trips {month}": path})
        source = spark.read.parquet(path)
        absent = [d["column"] for d in files.schema_diff(source.schema, contracts.TRIPS) if d["issue"] == "missing"]
        if absent:
            raise ValueError(f"contract violations: columns {absent} are missing")
        raw = trips.raw_trips(source)
    else:
        raw = trips.raw_trips(adapters.trip_source(Tables(spark, sf_dir)))
        if month is not None:
            raw = trips.select_month(raw, month)
    raw = write_table(raw, f"{out_dir}/raw")
    report = trips.quality_report(raw).first().asDict()
    if not report["passed"]:
        raise RuntimeError("staging quality checks failed")
    staged = write_table(trips.staged_trips(raw), f"{out_dir}/staged")
    days = write_table(trips.daily_metrics(staged), f"{out_dir}/daily_metrics").count()
    summary = {"month": month, "metric_days": days, "quality": report}
    files.write_json(spark.createDataFrame([(json.dumps(summary),)], "summary string"), f"{out_dir}/summary")
    return summary


# ------------------------------------------------------------------- E ---
def run_revenue(spark: SparkSession, sf_dir: str | None, out_dir: str, incremental_load: bool = False,
                upsert: bool = False, source_dir: str | None = None) -> dict:
    """E: the revenue run, on the CSV files of ``source_dir`` or on entities
    derived from the driver tables of ``sf_dir``; ``incremental_load`` appends orders above the key
    watermark to the versioned fact instead of replacing it; ``upsert``
    applies the change set against the published fact instead (new, changed and
    removed orders, so corrections to old orders are picked up)."""
    mode = "upsert" if upsert else "incremental" if incremental_load else "full_refresh"
    if source_dir is not None:
        base = source_dir.rstrip("/")
        files.require_inputs(spark, {f"{e}.csv": f"{base}/{e}.csv" for e in contracts.REVENUE})
    run = Run(spark, out_dir, files.fingerprint(spark, [source_dir or sf_dir]), {"product": "revenue", "mode": mode})
    if source_dir is not None:
        raw = intake(spark, contracts.REVENUE, source_dir, out_dir, "revenue", run)
    else:
        t = Tables(spark, sf_dir)
        raw = {n: b(t) for n, b in adapters.REVENUE_SOURCES.items()}
    issues = contracts.check_schemas(raw, contracts.REVENUE)
    if issues:
        raise ValueError(f"contract violations: {issues}")
    bronze = run.layer("bronze", raw)
    s = revenue.Silver.from_silver(run.layer("silver", {n: revenue.SILVER[n](bronze[n]) for n in revenue.SILVER}))
    _set_aside({("revenue", e): df for e, df in bronze.items()}, out_dir, run)
    report, checks = _gated(run, lambda: revenue.quality_report(s))

    loaded = run.once("fact", lambda: _load_fact(spark, s, revenue_fact(spark, out_dir), run, mode))
    fact = revenue_fact(spark, out_dir).read(loaded["version"])
    models = revenue.gold_models(s, fact)
    gold = run.layer("gold", {k.removeprefix("gold_"): v for k, v in models.items() if k != "gold_fact_order"})
    gold = {**{f"gold_{k}": v for k, v in gold.items()}, "gold_fact_order": fact}
    tests = _tested(run, revenue.gold_tests(), gold)
    run.publish(fact_version=loaded["version"])

    observed = {layer: run.counts(layer) for layer in ("bronze", "silver", "gold")}
    observed["gold"]["fact_order"] = loaded["rows"]
    out = dict(_published_evidence(run, lambda: evidence.run_summary(
        _counts_frame(spark, observed), report, revenue.run_totals(fact), mode, round(time.time() - run.started, 3)), out_dir))
    run.finish()
    out["quality_checks"] = checks
    out["data_tests"] = len(tests)
    if loaded["changes"] is not None:
        out["fact_changes"] = loaded["changes"]
    return out


def revenue_fact(spark: SparkSession, out_dir: str) -> KeyedTable:
    """The order fact of a revenue run's folder. A run's version is there
    before it is published: readers take the one the pointer names."""
    return KeyedTable(spark, f"{out_dir}/tables/fact_order", "order_id")


def read_revenue_fact(spark: SparkSession, out_dir: str) -> DataFrame | None:
    """The published order fact."""
    pointer = runs.published(spark, out_dir)
    return None if pointer is None else revenue_fact(spark, out_dir).read(pointer["fact_version"])


def _load_fact(spark: SparkSession, s: revenue.Silver, table: KeyedTable, run: Run, mode: str) -> dict:
    """The fact's next version on top of the published one: its version, rows
    and change counts."""
    done = table.version_of(run.id)  # loaded, but the run died before its journal said so
    parent = None if run.parent is None else run.parent["fact_version"]
    changes = None
    if mode == "upsert" and parent is not None:
        current, existing = revenue.fact_order(s), table.read(parent)
        cs = run.table("changes/fact_order", lambda: incremental.changed_keys(existing, current, "order_id"))
        changes = {r["change_type"]: int(r["n"]) for r in cs.groupBy("change_type")
                   .agg(F.count(F.lit(1)).alias("n")).collect()}
        take = cs.where(F.col("change_type") != "removed").select("_key")
        taken = current.join(take, current["order_id"].eqNullSafe(take["_key"]), "left_semi")
        version = done or (table.merge(cs, taken, parent, run.id) if changes else parent)
    elif mode == "incremental" and parent is not None:
        new = revenue.fact_order(s, incremental.above(s.orders, "order_id", table.watermark(parent)))
        version = done or table.append(new, parent, run.id)
    else:
        version = done or table.replace(revenue.fact_order(s), run.id)
    return {"version": version, "rows": table.row_count(version), "changes": changes}


def latest_run(spark: SparkSession, out_dir: str) -> dict | None:
    """V5: the evidence of a product's newest published run, whatever the
    product; a run that was held or died is none."""
    row = (runs.journal(spark, out_dir).where("step = 'evidence'")
           .agg(F.max_by("detail", "at").alias("detail")).first())
    return None if row["detail"] is None else json.loads(row["detail"])


# ------------------------------------------------------------------- C ---
def run_client(spark: SparkSession, sf_dir: str | None, out_dir: str, client_id: str = client.DEFAULT_CLIENT_ID,
               reporting_period: str = client.DEFAULT_PERIOD, target_hours: int = 24,
               source_dir: str | None = None) -> dict:
    """C: delivery run → gold deliverables and the delivery manifest (V3), on
    the CSV files of ``source_dir`` or on the driver tables of ``sf_dir``."""
    if source_dir is not None:
        base = source_dir.rstrip("/")
        files.require_inputs(spark, {f"{e}.csv": f"{base}/{e}.csv" for e in contracts.CLIENT})
    run = Run(spark, out_dir, files.fingerprint(spark, [source_dir or sf_dir]),
              {"product": "client", "client_id": client_id, "period": reporting_period, "target_hours": target_hours})
    if source_dir is not None:
        raw = intake(spark, contracts.CLIENT, source_dir, out_dir, "client", run)
    else:
        t = Tables(spark, sf_dir)
        raw = {n: b(t) for n, b in adapters.CLIENT_SOURCES.items()}
    issues = contracts.check_schemas(raw, contracts.CLIENT)
    if issues:
        raise ValueError(f"contract violations: {issues}")
    bronze = run.layer("bronze", raw)
    s = client.Silver.from_silver(run.layer("silver", {n: client.SILVER[n](bronze[n]) for n in client.SILVER}))
    _set_aside({("client", e): df for e, df in bronze.items()}, out_dir, run)
    report, _ = _gated(run, lambda: client.quality_report(s))
    gold = run.layer("gold", {"gold_client_scorecard": client.client_scorecard(s, client_id, reporting_period),
                              "gold_account_health": client.account_health(s),
                              "gold_daily_operations": client.daily_operations(s)})
    _tested(run, client.gold_tests(), gold)
    run.publish()
    _export(run, gold, out_dir)
    out = _published_evidence(run, lambda: delivery_manifest(
        gold["gold_client_scorecard"], _counts_frame(spark, {"bronze": run.counts("bronze")}), report,
        client_id, reporting_period, round(time.time() - run.started, 3), target_hours), out_dir)
    run.finish()
    return dict(out)


def delivery_manifest(scorecard: DataFrame, counts: DataFrame, report: DataFrame, client_id: str,
                      reporting_period: str, duration: float, target_hours: int) -> DataFrame:
    """V3: one row — delivery, quality gate, SLA (measured), scorecard.

    ``counts`` has the source rows (table_name, row_count), ``report`` the gate
    checks (check_name, incidents); both are tens of rows and meet the
    scorecard in one aggregate over their tagged union.
    """
    card = scorecard.select(F.struct(*scorecard.columns).alias("card"))
    pair = "struct<name:string,n:bigint>"
    none = lambda t: F.lit(None).cast(t)
    kind = card.schema["card"].dataType
    u = (card.select("card", none(pair).alias("source"), none(pair).alias("check"))
         .unionByName(counts.select(none(kind).alias("card"), F.struct(F.col("table_name").alias("name"), F.col("row_count").alias("n"))
                                    .cast(pair).alias("source"), none(pair).alias("check")))
         .unionByName(report.select(none(kind).alias("card"), none(pair).alias("source"),
                                    F.struct(F.col("check_name").alias("name"), F.col("incidents").alias("n")).cast(pair).alias("check"))))
    g = u.agg(F.first("card", ignorenulls=True).alias("scorecard"),
              F.sort_array(F.collect_list("source")).alias("sources"), F.sort_array(F.collect_list("check")).alias("found"))
    clean = F.size(F.filter("found", lambda c: c["n"] == 0))
    passed = clean == F.size("found")
    score = F.when(F.size("found") == 0, F.lit(100)).otherwise(F.round(F.lit(100) * clean / F.size("found")).cast("int"))
    within = duration <= target_hours * 3600
    period = reporting_period[:7]
    return g.select(
        F.lit(client_id).alias("client_id"),
        F.lit(f"{client_id}-{period}").alias("delivery_id"),
        F.when(passed, "accepted").otherwise("held").alias("delivery_status"),
        F.lit(period).alias("reporting_period"),
        F.array(*[F.lit(d) for d in ("client_scorecard", "account_health", "daily_operations")]).alias("deliverables"),
        F.struct(F.when(passed, "passed").otherwise("failed").alias("status"),
                 F.map_from_entries("found").alias("checks"), score.alias("score"),
                 F.map_from_entries("sources").alias("source_rows")).alias("quality_gate"),
        F.struct(F.lit(target_hours).alias("target_hours"), F.lit(duration).alias("actual_duration_seconds"),
                 F.lit("within_target" if within else "missed").alias("status")).alias("sla"),
        "scorecard",
    )


# ------------------------------------------------------------------- M ---
def run_migration(spark: SparkSession, sf_dir: str | None, out_dir: str,
                  migration_id: str = migration.DEFAULT_MIGRATION_ID, target_hours: int = 24,
                  source_dir: str | None = None) -> dict:
    """M: both snapshots → source gate → reconciliation, queue, decision →
    migration manifest (V4). ``source_dir`` has the folders ``source`` and
    ``target`` with a CSV file an entity; else the snapshots are derived from
    the driver tables of ``sf_dir``."""
    raw = {}
    if source_dir is not None:
        base = source_dir.rstrip("/")
        files.require_inputs(spark, {f"{side}/{e}.csv": f"{base}/{side}/{e}.csv"
                                     for side in migration.SIDES for e in migration.ENTITIES})
    run = Run(spark, out_dir, files.fingerprint(spark, [source_dir or sf_dir]),
              {"product": "migration", "migration_id": migration_id, "target_hours": target_hours})
    if source_dir is not None:
        for side in migration.SIDES:
            found = intake(spark, contracts.MIGRATION, f"{base}/{side}", out_dir, side, run)
            raw.update({(side, e): df for e, df in found.items()})
    else:
        t = Tables(spark, sf_dir)
        for e in migration.ENTITIES:
            raw[("source", e)] = adapters.migration_source(t, e)
            raw[("target", e)] = adapters.migration_target(t, e)
    for side in migration.SIDES:
        names = {e: raw[(side, e)] for e in migration.ENTITIES}
        issues = [i for i in contracts.check_schemas(names, contracts.MIGRATION)
                  if i["issue"] in ("missing", "missing_entity", "extra")]  # target amounts may be wider decimals
        if issues:
            raise ValueError(f"contract violations in the {side}: {issues}")
    bronze = run.layer("bronze", raw)
    m = migration.Snapshots.from_silver(run.layer("silver", {k: migration.silver(k[1], b) for k, b in bronze.items()}))
    _set_aside({(f"migration_{side}", e): df for (side, e), df in bronze.items()}, out_dir, run)
    report, checks = _gated(run, lambda: migration.quality_report(m))
    found = run.table("exceptions/found", lambda: migration.exceptions(m))
    gold = run.layer("gold", {"gold_reconciliation": migration.reconciliation(m),
                              "gold_exception_queue": lambda: migration.numbered_queue(found)})
    ready = migration.cutover_readiness(gold["gold_exception_queue"], gold["gold_reconciliation"], migration_id)
    gold.update(run.layer("gold", {"gold_cutover_readiness": ready}))
    _tested(run, migration.gold_tests(), gold)
    run.publish()
    _export(run, gold, out_dir)
    out = dict(_published_evidence(run, lambda: migration_manifest(
        gold, report, migration_id, round(time.time() - run.started, 3), target_hours), out_dir))
    run.finish()
    out["quality_checks"] = checks
    return out


def migration_manifest(gold: dict, gate_report: DataFrame, migration_id: str, duration: float,
                       target_hours: int) -> DataFrame:
    """V4: decision, exceptions by severity (map), checklist and reconciliation
    rows (arrays of structs) in one row."""
    ready = gold["gold_cutover_readiness"]
    checklist = migration.cutover_checklist(ready, gate_report)
    sev = migration.severity_map(gold["gold_exception_queue"])
    recon = gold["gold_reconciliation"]
    parts = [
        ready.select(F.lit("d").alias("_k"), F.col("cutover_decision").alias("_d"),
                     F.lit(None).alias("_c"), F.lit(None).alias("_r"), F.lit(None).alias("_s")),
        checklist.select(F.lit("c").alias("_k"), F.lit(None).cast("string").alias("_d"),
                         F.struct(*checklist.columns).alias("_c"), F.lit(None).alias("_r"), F.lit(None).alias("_s")),
        recon.select(F.lit("r").alias("_k"), F.lit(None).cast("string").alias("_d"), F.lit(None).alias("_c"),
                     F.struct(*recon.columns).alias("_r"), F.lit(None).alias("_s")),
        sev.select(F.lit("s").alias("_k"), F.lit(None).cast("string").alias("_d"), F.lit(None).alias("_c"),
                   F.lit(None).alias("_r"), F.col("exceptions_by_severity").alias("_s")),
    ]
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p, allowMissingColumns=False)
    g = u.agg(F.first("_d", ignorenulls=True).alias("decision"),
              F.sort_array(F.collect_list("_c")).alias("checklist"),
              F.sort_array(F.collect_list("_r")).alias("reconciliation"),
              F.first("_s", ignorenulls=True).alias("exceptions_by_severity"))
    d = F.col("decision")
    return g.select(
        F.lit(migration_id).alias("migration_id"),
        d.alias("cutover_decision"),
        F.when(d == "HOLD", "review_required").otherwise("ready_for_signoff").alias("delivery_status"),
        "exceptions_by_severity", "checklist", "reconciliation",
        F.struct(F.lit(target_hours).alias("target_hours"), F.lit(duration).alias("actual_duration_seconds"),
                 F.lit("within_target" if duration <= target_hours * 3600 else "missed").alias("status")).alias("sla"),
    )
