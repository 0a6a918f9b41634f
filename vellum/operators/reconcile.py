"""Source-to-target reconciliation of two snapshots of one entity.

``reconcile_keys`` (G1) finds, per key: missing in target, unexpected in
target, duplicate keys on either side, and amount mismatches. Each side is
first reduced to one row per key (row count, min and max amount) with
map-side partial aggregation, so a key repeated on one side — even one key
holding a third of the rows — is a single row before the exchange; the
full outer join is then a join of unique keys and cannot skew.

Amount mismatch keeps the pairwise meaning of "some source row and some
target row of the key differ by at least the tolerance": over all pairs the
largest difference is max(s_max − t_min, t_max − s_min), so min/max per key
decide it exactly without enumerating pairs.

``reconcile_totals`` (G2) compares row counts and amount totals.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellum.functions import RECON_TOTAL

ISSUES = ("missing_in_target", "unexpected_in_target", "duplicate_source_key",
          "duplicate_target_key", "amount_mismatch")


def _per_key(df: DataFrame, key: str, amount: str | None, side: str) -> DataFrame:
    aggs = [F.count(F.lit(1)).alias(f"{side}_rows")]
    if amount:
        aggs += [F.min(amount).alias(f"{side}_min"), F.max(amount).alias(f"{side}_max")]
    # in a struct, a NULL key equals itself: the join then asks for the very
    # partitions of the counts, where a NULL-safe one would shuffle them again
    return df.groupBy(F.struct(F.col(key).alias("v")).alias(f"{side}_key")).agg(*aggs)


def reconcile_keys(source: DataFrame, target: DataFrame, key: str,
                   amount: str | None = None, tolerance: str = "0.01",
                   entity: str | None = None) -> DataFrame:
    """One row per (key, issue): entity, record_key, issue_type, source_rows,
    target_rows. NULL is a key like any other."""
    s = _per_key(source, key, amount, "s")
    t = _per_key(target, key, amount, "t")
    j = s.join(t, s["s_key"] == t["t_key"], "full_outer")
    sr, tr = F.col("s_rows"), F.col("t_rows")
    conds: list[tuple[str, Column]] = [
        ("missing_in_target", sr.isNotNull() & tr.isNull()),
        ("unexpected_in_target", sr.isNull() & tr.isNotNull()),
        ("duplicate_source_key", sr > 1),
        ("duplicate_target_key", tr > 1),
    ]
    if amount:
        tol = F.lit(tolerance).cast("decimal(12,2)")
        widest = F.greatest(F.abs(F.col("s_max") - F.col("t_min")), F.abs(F.col("t_max") - F.col("s_min")))
        conds.append(("amount_mismatch", sr.isNotNull() & tr.isNotNull() & (widest >= tol)))
    issues = F.filter(F.array(*[F.when(c, F.lit(name)) for name, c in conds]), lambda x: x.isNotNull())
    out = j.select(F.coalesce("s_key", "t_key")["v"].cast("string").alias("record_key"),
                   F.coalesce(sr, F.lit(0)).alias("source_rows"),
                   F.coalesce(tr, F.lit(0)).alias("target_rows"),
                   F.explode(issues).alias("issue_type"))
    return out.select(F.lit(entity or key).alias("entity"), "record_key", "issue_type",
                      "source_rows", "target_rows")


def reconcile_totals(source: DataFrame, target: DataFrame, entity: str,
                     amount: str | None = None, tolerance: str = "0.01") -> DataFrame:
    """One row: counts, amount totals, deltas and passed/review for an entity.

    Both sides go through one aggregate over their tagged union.
    """
    amt = F.col(amount) if amount else F.lit(None).cast(RECON_TOTAL)
    both = (source.select(F.lit(True).alias("_src"), amt.alias("_amt"))
            .unionByName(target.select(F.lit(False).alias("_src"), amt.alias("_amt"))))
    g = both.agg(F.count_if(F.col("_src")).alias("source_count"),
                 F.count_if(~F.col("_src")).alias("target_count"),
                 F.sum(F.when(F.col("_src"), F.col("_amt"))).alias("_s"),
                 F.sum(F.when(~F.col("_src"), F.col("_amt"))).alias("_t"))
    s_amt, t_amt = F.col("_s").cast(RECON_TOTAL), F.col("_t").cast(RECON_TOTAL)
    delta = F.coalesce(t_amt - s_amt, F.lit(0)).cast(RECON_TOTAL)
    tol = F.lit(tolerance).cast(RECON_TOTAL)
    return g.select(
        F.lit(entity).alias("entity"), "source_count", "target_count",
        (F.col("target_count") - F.col("source_count")).alias("row_count_delta"),
        s_amt.alias("source_amount"), t_amt.alias("target_amount"),
        delta.alias("amount_delta"),
        F.when((F.col("target_count") == F.col("source_count")) & (F.abs(delta) < tol), "passed")
         .otherwise("review").alias("reconciliation_status"),
    )
