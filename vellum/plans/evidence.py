"""Run evidence (V1–V5): layer row counts, run summary, manifests.

Every count is a Spark aggregate; the evidence row is built by one
aggregate over a tagged union of the small per-table results (no joins of
one-row frames), then written as JSON by ``sources.files.write_json``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellum.functions import MONEY_TOTAL


def layer_counts(layers: dict[str, dict[str, DataFrame]]) -> DataFrame:
    """V1: (layer, table_name, row_count) for every table of every layer."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count"))
               .select(F.lit(layer).alias("layer"), F.lit(name).alias("table_name"), "row_count")
             for layer, tables in layers.items() for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def _entries(kind: str, value_type: str = "long"):
    return F.map_from_entries(F.collect_list(
        F.when(F.col("_kind") == kind, F.struct(F.col("_name"), F.col("_value").cast(value_type)))))


def run_summary(counts: DataFrame, report: DataFrame, totals: DataFrame, mode: str,
                duration_seconds: float | None = None) -> DataFrame:
    """V2: one evidence row — mode, rows per layer, checks, headline totals."""
    rows = counts.select(F.col("layer").alias("_kind"), F.col("table_name").alias("_name"),
                         F.col("row_count").cast(MONEY_TOTAL).alias("_value"))
    checks = report.select(F.lit("check").alias("_kind"), F.col("check_name").alias("_name"),
                           F.col("incidents").cast(MONEY_TOTAL).alias("_value"))
    total_cols = [c for c in totals.columns]
    tot = totals.select(F.explode(F.array(*[F.struct(F.lit("total").alias("_kind"), F.lit(c).alias("_name"),
                                                     F.col(c).cast(MONEY_TOTAL).alias("_value"))
                                           for c in total_cols])).alias("e")).select("e.*")
    u = rows.unionByName(checks).unionByName(tot)
    g = u.agg(_entries("bronze").alias("bronze_rows"), _entries("silver").alias("silver_rows"),
              _entries("gold").alias("gold_rows"), _entries("check").alias("quality_checks"),
              _entries("total", MONEY_TOTAL).alias("_totals"))
    out = g.select(
        F.lit(mode).alias("pipeline_mode"),
        "bronze_rows", "silver_rows", "gold_rows", "quality_checks",
        F.when(F.aggregate(F.map_values("quality_checks"), F.lit(0).cast("long"), lambda a, x: a + x) == 0,
               "passed").otherwise("failed").alias("quality_status"),
        *[F.col("_totals")[c].alias(c) for c in total_cols],
        F.current_timestamp().alias("generated_at_utc"),
        F.lit(duration_seconds).cast("double").alias("pipeline_duration_seconds"),
    )
    return out
