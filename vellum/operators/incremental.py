"""Keyed incremental loads (S5), snapshot change sets (G3), versioned writes.

Watermark mode appends candidate rows whose key is above the largest key
already loaded; the watermark is one scalar aggregate collected to the
driver and used as a literal, so the candidate scan can prune files/row
groups on it. Upsert mode replaces every key present in the changes.
Both are ``anti join + union``; the existing side is never overwritten in
place — a new version folder is written and a pointer moved afterwards.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def watermark(existing: DataFrame, key: str):
    """``max(key)`` of the loaded table (a single scalar), None when it is empty."""
    row = existing.agg(F.max(key).alias("m")).first()
    return None if row is None else row["m"]


def above(candidates: DataFrame, key: str, mark) -> DataFrame:
    """The candidates with a key above the watermark; all of them on a first
    load, which has none."""
    return candidates if mark is None else candidates.where(F.col(key) > F.lit(mark))


def append_above_watermark(existing: DataFrame, candidates: DataFrame, key: str,
                           mark=None) -> DataFrame:
    """delete+insert of the candidates with ``key`` > watermark.

    Because the filter is strict the delete half never removes a row (D20),
    but it is kept so the result is right for any candidate set.
    """
    return upsert(existing, above(candidates, key, watermark(existing, key) if mark is None else mark), key)


def upsert(existing: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """Rows of ``existing`` whose key is not in ``changes``, plus ``changes``.
    NULL is a key like any other."""
    keys = changes.select(F.col(key).alias("_k")).distinct()
    return existing.join(keys, existing[key].eqNullSafe(keys["_k"]), "left_anti").unionByName(changes)


def _row_fingerprint(cols: list[str]) -> Column:
    """A 64-bit hash of a row. Spark's hash skips NULLs, so each column's NULL
    flag goes in beside its value: a value that moves between two columns of
    one type changes the hash."""
    return F.xxhash64(*[x for c in cols for x in (F.col(c).isNull(), F.col(c))])


def changed_keys(old: DataFrame, new: DataFrame, key: str, cols: list[str] | None = None) -> DataFrame:
    """Keys that are new, removed or changed between two snapshots: _key (of
    the key's own type; NULL is a key like any other), change_type, old_rows,
    new_rows.

    Each side is reduced per key to a fingerprint of its rows as a multiset
    (row count, min, max and sum of 64-bit row hashes), so repeated keys
    collapse before the full outer join and no group is ever collected; a
    key is changed when the fingerprints differ.
    """
    cols = cols or [c for c in old.columns if c != key]

    def per_key(df: DataFrame, p: str) -> DataFrame:
        h = _row_fingerprint(cols)
        return df.groupBy(F.col(key).alias(f"{p}_k")).agg(F.count(F.lit(1)).alias(f"{p}_n"),
                                                          F.min(h).alias(f"{p}_lo"), F.max(h).alias(f"{p}_hi"),
                                                          F.sum(h.cast("decimal(38,0)")).alias(f"{p}_sum"))

    o, n = per_key(old, "o"), per_key(new, "n")
    j = o.join(n, o["o_k"].eqNullSafe(n["n_k"]), "full_outer")
    on, nn = F.col("o_n"), F.col("n_n")
    differs = ((on != nn) | (F.col("o_lo") != F.col("n_lo")) | (F.col("o_hi") != F.col("n_hi"))
               | (F.col("o_sum") != F.col("n_sum")))
    kind = F.when(on.isNull(), "new").when(nn.isNull(), "removed").when(differs, "changed")
    return (j.select(F.coalesce("o_k", "n_k").alias("_key"), kind.alias("change_type"),
                     F.coalesce(on, F.lit(0)).alias("old_rows"), F.coalesce(nn, F.lit(0)).alias("new_rows"))
            .where(F.col("change_type").isNotNull()))


def change_set(old: DataFrame, new: DataFrame, key: str, cols: list[str] | None = None) -> DataFrame:
    """The changed keys as text: record_key, change_type, old_rows, new_rows."""
    return changed_keys(old, new, key, cols).select(F.col("_key").cast("string").alias("record_key"),
                                                    "change_type", "old_rows", "new_rows")


def apply_changes(existing: DataFrame, current: DataFrame, key: str,
                  changes: DataFrame | None = None) -> DataFrame:
    """G3 feeding S5 as a true upsert: keep unchanged rows of ``existing``,
    drop removed keys, take new and changed keys from ``current``.

    ``changes`` is what ``changed_keys`` returns, written by the caller when it
    is used more than once. Unlike the watermark mode this picks up
    corrections to old keys."""
    cs = changed_keys(existing, current, key) if changes is None else changes
    drop = cs.select("_key")
    take = cs.where(F.col("change_type") != "removed").select("_key")
    kept = existing.join(drop, existing[key].eqNullSafe(drop["_key"]), "left_anti")
    taken = current.join(take, current[key].eqNullSafe(take["_key"]), "left_semi")
    return kept.unionByName(taken)


# ------------------------------------------------------- versioned tables
# A table is a folder of immutable versions ``v=<n>`` plus a ``versions``
# log: a version becomes current when its number is appended to the log,
# after its data job committed. Nothing is overwritten or deleted, so a
# reader never sees a half-written version or a missing pointer.
def _log(base: str) -> str:
    return f"{base.rstrip('/')}/versions"


def current_version(spark: SparkSession, base: str) -> int | None:
    """Highest committed version, or None for a new table."""
    from vellum.sources.files import exists
    if not exists(spark, _log(base)):
        return None
    row = spark.read.parquet(_log(base)).agg(F.max("version").alias("v")).first()
    return None if row is None or row["v"] is None else int(row["v"])


def read_current(spark: SparkSession, base: str) -> DataFrame | None:
    v = current_version(spark, base)
    return None if v is None else spark.read.parquet(f"{base.rstrip('/')}/v={v}")


def write_version(df: DataFrame, base: str, partition_by: list[str] | None = None,
                  expected_schema=None) -> int:
    """Write ``df`` as the next version, then log it as current (last step).

    ``expected_schema`` enforces the fail-on-schema-change policy against
    the current version.
    """
    spark = df.sparkSession
    v = current_version(spark, base)
    if expected_schema is not None and v is not None:
        old = spark.read.parquet(f"{base.rstrip('/')}/v={v}").schema
        if [(f.name, f.dataType) for f in old] != [(f.name, f.dataType) for f in df.schema]:
            raise ValueError(f"schema change on {base}: {old.simpleString()} -> {df.schema.simpleString()}")
    nxt = 1 if v is None else v + 1
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(f"{base.rstrip('/')}/v={nxt}")
    spark.createDataFrame([(nxt,)], "version long").write.mode("append").parquet(_log(base))
    return nxt
