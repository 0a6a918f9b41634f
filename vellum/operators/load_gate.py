"""The quality gate over a load, not over all that was loaded before (Q2–Q6).

``LoadGate.report`` gives what ``quality.report`` would give for the history and
the load together, from the load and stored facts:

* row rules (null keys, domains, predicates): the history's incidents, which
  its last commit holds, plus those of the load;
* duplicate keys: the history's, plus keys of the load that are repeated now
  and were not before (``KeyIndex.held`` knows their rows in the history);
* orphans: the history's open orphans, kept per key, without those whose
  parent has come, plus rows of the load whose parent neither the load nor the
  index of parents holds.

``accept`` stores the load's facts and commits them by one small file, written
last; a load that dies before leaves files that no commit names, and a load
with a tag is taken once. One writer at a time commits.
"""

from __future__ import annotations

import json
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vellum.operators import quality as Q
from vellum.operators.key_index import KeyIndex, as_json, from_json, key_counts
from vellum.sources import files
from vellum.sources.tables import materialized

_ROW_RULES = ("null_key", "domain", "row_rule")


class LoadGate:
    """The gate of ``checks`` with its stored state under ``base``. A load is a
    dict of entity → rows; an entity that is not in it has no new rows. A NULL
    key counts as a key for duplicates; a NULL foreign key is always an orphan."""

    def __init__(self, spark: SparkSession, base: str, checks: list[Q.Check]):
        self.spark, self.base, self.checks = spark, base.rstrip("/"), checks

    # ---------------------------------------------------------------- state
    def _commits(self) -> list[dict]:
        path = f"{self.base}/log"
        if not files.exists(self.spark, path):
            return []
        return sorted((json.loads(r["value"]) for r in self.spark.read.text(path).collect()), key=lambda c: c["version"])

    def state(self) -> dict:
        """The newest commit: version, tags, incidents, indexes, orphans."""
        commits = self._commits()
        tags = [c["tag"] for c in commits if c["tag"]]
        last = commits[-1] if commits else {"version": 0, "incidents": {}, "indexes": {}, "orphans": {}}
        return {**last, "tags": tags}

    def _keys(self) -> list[tuple[str, str]]:
        """(entity, column) of each index: checked keys and parents of foreign keys."""
        keys = {(c.entity, c.column) for c in self.checks if c.rule == "duplicate_key"}
        return sorted(keys | {(c.parent, c.parent_column) for c in self.checks if c.rule == "orphan"})

    def _index(self, state: dict, entity: str, column: str) -> KeyIndex:
        name = f"{entity}.{column}"
        return KeyIndex(self.spark, f"{self.base}/keys/{name}", from_json(state["indexes"].get(name, [])))

    # ---------------------------------------------------------------- facts
    def _counts(self, load: dict[str, DataFrame]) -> dict[tuple[str, str], DataFrame]:
        """The load's rows per key of every column that a check looks at, written once."""
        wanted = set(self._keys()) | {(c.entity, c.column) for c in self.checks if c.rule == "orphan"}
        return {(e, c): materialized(key_counts(load[e], c), name="load-keys") for e, c in sorted(wanted) if e in load}

    def _duplicates(self, state: dict, c: Q.Check, counts: dict) -> DataFrame:
        """Keys of the load that are repeated with it and were not before."""
        new = counts[(c.entity, c.column)]
        held, _ = self._index(state, c.entity, c.column).held(new)
        held = held.withColumnRenamed("_key", "_known")
        both = new.join(held, new["_key"].eqNullSafe(held["_known"]), "left").withColumn("_held", F.coalesce("_held", F.lit(0)))
        return both.agg(F.count_if((F.col("_held") <= 1) & (F.col("_held") + F.col("_n") > 1)).alias("incidents"))

    def _open_orphans(self, state: dict, c: Q.Check, counts: dict) -> DataFrame | None:
        """Orphans of the history and the load together: _key, _n."""
        parents = counts.get((c.parent, c.parent_column))
        arrived = None if parents is None else parents.select("_key").where("_key IS NOT NULL")

        def without(rows: DataFrame, known: DataFrame | None) -> DataFrame:
            return rows if known is None else rows.join(known.select("_key"), "_key", "left_anti")

        parts = []
        if c.name in state["orphans"]:
            parts.append(without(self.spark.read.parquet(f"{self.base}/{state['orphans'][c.name]}"), arrived))
        if (c.entity, c.column) in counts:
            left = without(counts[(c.entity, c.column)], arrived)
            held, _ = self._index(state, c.parent, c.parent_column).held(left.where("_key IS NOT NULL"))
            parts.append(without(left, held))
        if not parts:
            return None
        return reduce(DataFrame.unionByName, parts).groupBy("_key").agg(F.sum("_n").alias("_n"))

    def _evaluate(self, state: dict, load: dict[str, DataFrame], counts: dict) -> tuple[DataFrame, dict]:
        """The report, and the open orphans of each orphan check that the load can change."""
        stored, parts, orphans = state["incidents"], [], {}
        rows = [c for c in self.checks if c.rule in _ROW_RULES and c.entity in load]
        if rows:
            parts.append(Q.report(rows, load))
        for c in self.checks:
            if c.rule == "duplicate_key" and (c.entity, c.column) in counts:
                parts.append(self._duplicates(state, c, counts).select(*Q._one(c, F.col("incidents"))))
            elif c.rule == "orphan":
                still = self._open_orphans(state, c, counts)
                if still is not None:
                    orphans[c.name] = materialized(still, name="open-orphans")
                    parts.append(orphans[c.name].agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("incidents"))
                                 .select(*Q._one(c, F.col("incidents"))))
        # of what was stored, the open orphans are counted anew
        kept = [(c.name, c.entity, c.rule, 0 if c.name in orphans else stored.get(c.name, 0)) for c in self.checks]
        parts.append(self.spark.createDataFrame(kept, Q.REPORT_SCHEMA))
        report = (reduce(DataFrame.unionByName, parts).groupBy("check_name", "entity", "rule")
                  .agg(F.sum("incidents").alias("incidents")))
        return report, orphans

    # ------------------------------------------------------------ interface
    def report(self, load: dict[str, DataFrame]) -> DataFrame:
        """The report over the history and the load; nothing is stored of it."""
        return self._evaluate(self.state(), load, self._counts(load))[0]

    def accept(self, load: dict[str, DataFrame], tag: str | None = None, hold: bool = False) -> dict[str, int]:
        """Store the load's facts and return the report's incidents. With
        ``hold`` a report with incidents raises ``QualityGateError`` and
        nothing is committed. A tag that was accepted before changes nothing."""
        state = self.state()
        if tag and tag in state["tags"]:
            return state["incidents"]
        counts = self._counts(load)
        report, orphans = self._evaluate(state, load, counts)
        incidents = Q.gate(report) if hold else {r["check_name"]: int(r["incidents"]) for r in report.collect()}
        indexes, paths = dict(state["indexes"]), dict(state["orphans"])
        for entity, column in self._keys():
            if (entity, column) in counts:
                index = self._index(state, entity, column)
                segment = index.add(counts[(entity, column)])
                indexes[f"{entity}.{column}"] = as_json(index.segments + ([segment] if segment else []))
        for name, rows in orphans.items():
            paths[name] = f"orphans/{uuid.uuid4().hex[:12]}"
            rows.write.parquet(f"{self.base}/{paths[name]}")
        self._commit(state["version"] + 1, tag, incidents, indexes, paths)
        return incidents

    def compact(self) -> int:
        """One segment for each index; reports stay as they are."""
        state = self.state()
        indexes = {}
        for entity, column in self._keys():
            one = self._index(state, entity, column).compacted()
            indexes[f"{entity}.{column}"] = as_json([one]) if one else []
        return self._commit(state["version"] + 1, None, state["incidents"], indexes, state["orphans"])

    def _commit(self, version: int, tag: str | None, incidents: dict, indexes: dict, orphans: dict) -> int:
        row = {"version": version, "tag": tag, "incidents": incidents, "indexes": indexes, "orphans": orphans}
        files.put_text(self.spark, f"{self.base}/log/{version:08d}.json", json.dumps(row) + "\n")
        return version
