"""Attribute profile of a table — rows, NULLs and distinct values per column.

Exact counts take one grouped pass per column: rows are grouped by the value
(map-side first, so a value that fills the table is one row per task) and the
groups are counted. A pass reads one column, so together they read the table
once, and no row is multiplied by the number of columns. ``approx=True`` takes
mergeable HyperLogLog sketches in one aggregate instead, for tables that are
expensive to compute again.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellum.functions import ratio_pct
from vellum.sources.tables import dealt


def profile(df: DataFrame, table_name: str, columns: list[str] | None = None,
            approx: bool = False, rsd: float = 0.01) -> DataFrame:
    cols = columns or df.columns
    if approx:
        aggs = [F.count(F.lit(1)).alias("_rows")]
        for i, c in enumerate(cols):
            aggs += [F.count_if(F.col(c).isNull()).alias(f"_n{i}"), F.approx_count_distinct(c, rsd).alias(f"_d{i}")]
        rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"_n{i}").alias("null_count"),
                                  F.col(f"_d{i}").cast("long").alias("distinct_count")) for i, c in enumerate(cols)])
        return (df.agg(*aggs).select(F.col("_rows").alias("row_count"), F.explode(rows).alias("p"))
                .select(F.lit(table_name).alias("table_name"), "p.column_name", "row_count",
                        "p.null_count", "p.distinct_count"))
    parts = []
    for c in cols:
        groups = df.groupBy(F.col(c).alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
        counted = groups.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("row_count"),
                             F.coalesce(F.sum(F.when(F.col("_v").isNull(), F.col("_n"))), F.lit(0)).alias("null_count"),
                             F.count("_v").alias("distinct_count"))
        parts.append(counted.select(F.lit(table_name).alias("table_name"), F.lit(c).alias("column_name"),
                                    "row_count", "null_count", "distinct_count"))
    return reduce(DataFrame.unionByName, parts)


def value_counts(df: DataFrame, column: str, domain) -> DataFrame:
    """Exact counts of a column's values: value, in_domain, row_count. Rows
    are added up map-side first, so a value that fills the table is one row a
    task; counts of two loads add up to those of their union."""
    value = F.col(column)
    return (df.groupBy(value.alias("value")).agg(F.count(F.lit(1)).alias("row_count"))
            .select("value", F.coalesce(F.col("value").isin(*domain), F.lit(False)).alias("in_domain"), "row_count"))


def referential_coverage(child: DataFrame, fk: str, parent: DataFrame, pk: str,
                         label: str) -> DataFrame:
    """How many child rows find their parent (per-key counts joined to the
    distinct parent keys, so a hot foreign key is one row before the join)."""
    per_key = child.groupBy(F.col(fk).alias("_k")).agg(F.count(F.lit(1)).alias("_n"))
    parents = dealt(parent.select(F.col(pk).alias("_k")), "_k").distinct().withColumn("_hit", F.lit(True))
    j = per_key.join(parents, "_k", "left")
    g = j.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("child_rows"),
              F.coalesce(F.sum(F.when(F.col("_hit"), F.col("_n"))), F.lit(0)).alias("matched_rows"))
    return g.select(F.lit(label).alias("relationship"), F.col("child_rows").cast("long").alias("child_rows"),
                    F.col("matched_rows").cast("long").alias("matched_rows"),
                    ratio_pct("matched_rows", "child_rows").alias("coverage_pct"))
