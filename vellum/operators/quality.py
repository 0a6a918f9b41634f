"""Data-quality checks, fused, and the gate that blocks publication.

A check is declared once (``Check``) and evaluated as part of one report
DataFrame with the schema (check_name, entity, rule, incidents):

* row rules of one table (null key, domain, custom predicate) share one
  aggregate over that table — one scan, however many rules;
* duplicate keys deal the key column out by the key and count there: keys
  hardly repeat, so counting before the shuffle would only hold a map of all
  keys of a split (a hot key is a long run of rows for one count);
* orphans count child rows per foreign key first, then anti-join the
  parent keys, so the join input is bounded by distinct keys, not rows, and
  a hot foreign key cannot skew the join.

Both keep to the session's number of shuffle partitions. Joined up to a size
in bytes, as small partitions are otherwise, 64 MB of packed keys are millions
of groups, and a task's maps and sorts of them take over a gigabyte.

The report is small (one row per check); only the gate collects it.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellum.sources.tables import dealt, keyed_join

REPORT_SCHEMA = "check_name string, entity string, rule string, incidents long"


class QualityGateError(ValueError):
    """Raised when any check of a gate has incidents; carries the report."""

    def __init__(self, report: dict[str, int]):
        self.report = report
        super().__init__(f"Data quality checks failed: {report}")


@dataclass(frozen=True)
class Check:
    name: str
    entity: str
    rule: str                      # null_key | duplicate_key | orphan | domain | row_rule
    column: str | None = None
    values: tuple = ()
    parent: str | None = None
    parent_column: str | None = None
    null_violates: bool = False
    predicate: Column | None = field(default=None, compare=False, hash=False)


def null_key(name, entity, column) -> Check:
    return Check(name, entity, "null_key", column)


def duplicate_key(name, entity, column) -> Check:
    return Check(name, entity, "duplicate_key", column)


def orphan(name, entity, column, parent, parent_column=None) -> Check:
    return Check(name, entity, "orphan", column, parent=parent, parent_column=parent_column or column)


def domain(name, entity, column, values, null_violates=False) -> Check:
    return Check(name, entity, "domain", column, values=tuple(values), null_violates=null_violates)


def row_rule(name, entity, predicate: Column) -> Check:
    """Count rows where ``predicate`` is true (NULL counts as not violated)."""
    return Check(name, entity, "row_rule", predicate=predicate)


def _row_condition(c: Check) -> Column:
    if c.rule == "null_key":
        return F.col(c.column).isNull()
    if c.rule == "domain":
        bad = ~F.col(c.column).isin(*c.values)
        if c.null_violates:
            bad = bad | F.col(c.column).isNull()
        return bad
    return c.predicate


def _one(c: Check, incidents: Column) -> list[Column]:
    return [F.lit(c.name).alias("check_name"), F.lit(c.entity).alias("entity"),
            F.lit(c.rule).alias("rule"), incidents.cast("long").alias("incidents")]


def repeated_keys(df: DataFrame, key: str) -> DataFrame:
    """_k, _n: the key values (NULL included, as GROUP BY does) with >1 row."""
    keys = dealt(df.select(F.col(key).alias("_k")), "_k")
    return keys.groupBy("_k").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1)


def missing_parents(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """_k, _n: the values of ``fk`` without a parent row (NULL too, as NOT
    EXISTS) and their child rows."""
    per_key = child.groupBy(F.col(fk).alias("_k")).agg(F.count(F.lit(1)).alias("_n"))
    return keyed_join(per_key, dealt(parent.select(F.col(pk).alias("_k")), "_k"), "_k", "left_anti")


def duplicate_key_count(df: DataFrame, key: str) -> DataFrame:
    """Number of key values (NULL included, as GROUP BY does) with >1 row."""
    return repeated_keys(df, key).agg(F.count(F.lit(1)).alias("incidents"))


def orphan_count(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Child rows whose ``fk`` has no parent row (NULL fk counts, as NOT EXISTS)."""
    return missing_parents(child, fk, parent, pk).agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("incidents"))


def report(checks: list[Check], tables: dict[str, DataFrame]) -> DataFrame:
    """Evaluate ``checks`` against named tables → one report DataFrame."""
    parts: list[DataFrame] = []
    row_checks: dict[str, list[Check]] = {}
    for c in checks:
        if c.rule in ("null_key", "domain", "row_rule"):
            row_checks.setdefault(c.entity, []).append(c)
    for entity, cs in row_checks.items():
        # one aggregate per table for all its row-level rules
        agg = tables[entity].agg(*[F.count_if(_row_condition(c)).alias(f"c{i}") for i, c in enumerate(cs)])
        rows = F.array(*[F.struct(*_one(c, F.col(f"c{i}"))) for i, c in enumerate(cs)])
        parts.append(agg.select(F.explode(rows).alias("r")).select("r.*"))
    for c in checks:
        if c.rule == "duplicate_key":
            parts.append(duplicate_key_count(tables[c.entity], c.column).select(*_one(c, F.col("incidents"))))
        elif c.rule == "orphan":
            parts.append(orphan_count(tables[c.entity], c.column, tables[c.parent], c.parent_column)
                         .select(*_one(c, F.col("incidents"))))
    return reduce(DataFrame.unionByName, parts)


def summary(report_df: DataFrame) -> DataFrame:
    """Q15: status and score of a report (score = share of clean checks)."""
    g = report_df.agg(F.count(F.lit(1)).alias("checks"),
                      F.count_if(F.col("incidents") > 0).alias("failed_checks"),
                      F.coalesce(F.sum("incidents"), F.lit(0)).cast("long").alias("incidents"))
    return g.select(
        "checks", "failed_checks", "incidents",
        F.when(F.col("failed_checks") == 0, F.lit("passed")).otherwise(F.lit("failed")).alias("status"),
        F.round(F.lit(100.0) * (F.col("checks") - F.col("failed_checks")) / F.col("checks"), 2).alias("score"),
    )


def gate(report_df: DataFrame) -> dict[str, int]:
    """Q6: collect the (small) report; raise if any check has incidents."""
    result = {r["check_name"]: int(r["incidents"]) for r in report_df.collect()}
    if any(result.values()):
        raise QualityGateError(result)
    return result


# ------------------------------------------------------ generic model tests
@dataclass(frozen=True)
class Test:
    """A schema test on a published model (not_null, unique, accepted_values,
    relationships) with the failure count the test framework reports."""
    model: str
    column: str
    kind: str
    values: tuple = ()
    to: str | None = None
    field: str | None = None

    @property
    def name(self) -> str:
        return f"{self.kind}_{self.model}_{self.column}"


def test_failures(t: Test, models: dict[str, DataFrame]) -> DataFrame:
    df = models[t.model]
    c = F.col(t.column)
    if t.kind == "not_null":
        out = df.agg(F.count_if(c.isNull()).alias("failures"))
    elif t.kind == "unique":
        out = repeated_keys(df.where(c.isNotNull()), t.column).agg(F.count(F.lit(1)).alias("failures"))
    elif t.kind == "accepted_values":
        # one failure per distinct unexpected non-NULL value
        out = df.agg(F.count_distinct(F.when(~c.isin(*t.values), c)).alias("failures"))
    elif t.kind == "relationships":
        missing = missing_parents(df.where(c.isNotNull()), t.column, models[t.to], t.field)
        out = missing.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("failures"))
    else:
        raise ValueError(t.kind)
    return out.select(F.lit(t.name).alias("test_name"), F.lit(t.model).alias("model"),
                      F.lit(t.column).alias("column_name"), F.lit(t.kind).alias("rule"),
                      F.col("failures").cast("long").alias("failures"))


def _row_test(t: Test) -> Column:
    c = F.col(t.column)
    if t.kind == "not_null":
        return F.count_if(c.isNull())
    return F.count_distinct(F.when(~c.isin(*t.values), c))


def run_tests(tests: list[Test], models: dict[str, DataFrame]) -> DataFrame:
    """All tests as one report (test_name, model, column_name, rule, failures).

    ``models`` should be written tables, as a run publishes them: each is read
    a few times. The row-level tests of a model (not_null, accepted_values)
    share one aggregate over it.
    """
    used = {t.model for t in tests} | {t.to for t in tests if t.to}
    m = {k: models[k] for k in models if k in used}
    parts: list[DataFrame] = []
    by_model: dict[str, list[Test]] = {}
    for t in tests:
        by_model.setdefault(t.model, []).append(t)
    for model, ts in by_model.items():
        row = [t for t in ts if t.kind in ("not_null", "accepted_values")]
        if row:
            agg = m[model].agg(*[_row_test(t).alias(f"f{i}") for i, t in enumerate(row)])
            items = F.array(*[F.struct(F.lit(t.name).alias("test_name"), F.lit(t.model).alias("model"),
                                       F.lit(t.column).alias("column_name"), F.lit(t.kind).alias("rule"),
                                       F.col(f"f{i}").cast("long").alias("failures"))
                              for i, t in enumerate(row)])
            parts.append(agg.select(F.explode(items).alias("t")).select("t.*"))
        parts += [test_failures(t, m) for t in ts if t.kind not in ("not_null", "accepted_values")]
    return reduce(DataFrame.unionByName, parts)


# ------------------------------------------------------------- quarantine
def quarantine(df: DataFrame, rules: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Q12: split rows into (valid, quarantined-with-reasons).

    ``rules`` maps a reason to the condition that *violates* it; a NULL
    condition is not a violation. One pass computes the reason array; the
    two outputs are filters of it.
    """
    reasons = F.filter(F.array(*[F.when(cond, F.lit(reason)) for reason, cond in rules.items()]),
                       lambda x: x.isNotNull())
    tagged = df.withColumn("reasons", reasons)
    valid = tagged.where(F.size("reasons") == 0).drop("reasons")
    bad = tagged.where(F.size("reasons") > 0)
    return valid, bad
