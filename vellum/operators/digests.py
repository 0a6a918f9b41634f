"""Reconciliation by digest tree: only buckets of keys that differ are joined.

A digest of a snapshot has one row per bucket of keys (a hash of the key):
the number of rows, four sums of row hashes (two independent 64-bit hashes in
halves, so the sums can't overflow), and whether the bucket may hold a key
twice. It is made once, when a snapshot is written, and stored beside it;
digests of two loads are merged without reading either load again. A second,
coarse level adds up ``fan`` neighbouring buckets.

Two digests are compared from the top: only coarse buckets that differ are
looked into, and only rows of differing buckets reach ``reconcile_keys``. A
bucket that may repeat a key is joined as well, since a repeated key is an
issue even where both sides agree. So the issues are the same as those of the
full join (but for a chance of about 2**-128 a bucket), while rows that are
shuffled grow with the differences.

The list of differing buckets is joined as the planner sees fit: broadcast
while it is small, else by a shuffle like the full join.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellum.operators.reconcile import reconcile_keys
from vellum.sources.tables import dealt, materialized

_SUMS = ["n_rows", "s1", "s2", "s3", "s4"]
_LOW = (1 << 32) - 1


@dataclass(frozen=True)
class Tree:
    """``buckets`` of keys (about one for a few hundred keys; digests are only
    comparable with the same number) and ``fan`` of them in a coarse one."""

    buckets: int = 1 << 16
    fan: int = 256


def bucket_of(key: str, tree: Tree) -> Column:
    return F.pmod(F.xxhash64(F.lit(17), key), F.lit(tree.buckets)).cast("int")


def _row_hashes(columns: list[str]) -> tuple[Column, Column]:
    """Two independent 64-bit hashes of a row. NULLs don't enter a hash, so their places do."""
    row = [F.col(f"`{c}`") for c in columns] + [F.col(f"`{c}`").isNull() for c in columns]
    return F.xxhash64(F.lit(1), *row), F.xxhash64(F.lit(2), *row)


def table_sums(columns: list[str]) -> list[Column]:
    """n_rows, s1, s2 of a whole table, as aggregates: tables with the same
    rows, each as often, have the same sums, and others don't (but for a
    chance of about 2**-128)."""
    return [F.count(F.lit(1)).alias("n_rows"),
            *[F.sum(h.cast("decimal(20,0)")).alias(f"s{i}") for i, h in enumerate(_row_hashes(columns), 1)]]


def digest(df: DataFrame, key: str, amount: str | None = None, tree: Tree = Tree()) -> DataFrame:
    """bucket, n_rows, s1…s4, repeats of a snapshot; empty buckets have no row.

    Keys hardly repeat, so rows are dealt by bucket as they are (a key and an
    amount, not its hashes) and added up per key there, which tells exactly
    which buckets repeat a key. NULL is a key like any other.
    """
    values = [c for c in (key, amount) if c]
    parts = [h for x in _row_hashes(values) for h in (x.bitwiseAND(F.lit(_LOW)), F.shiftrightunsigned(x, 32))]
    rows = dealt(df.select(*values, bucket_of(key, tree).alias("bucket")), "bucket")
    per_key = rows.groupBy("bucket", F.col(key).alias("_key")).agg(
        F.count(F.lit(1)).alias("n_rows"), *[F.sum(h).alias(f"s{i}") for i, h in enumerate(parts, 1)])
    return (per_key.groupBy("bucket")
            .agg(*[F.sum(c).alias(c) for c in _SUMS], (F.max("n_rows") > 1).alias("repeats")))


def merged(a: DataFrame, b: DataFrame) -> DataFrame:
    """The digest of the union of two loads. A bucket that both loads have
    rows in may repeat a key; the digests can't tell, so it counts as one
    that does until the union is digested anew."""
    both = a.unionByName(b).groupBy("bucket").agg(
        *[F.sum(c).alias(c) for c in _SUMS], F.max("repeats").alias("repeats"), F.count(F.lit(1)).alias("_loads"))
    return both.select("bucket", *_SUMS, (F.col("repeats") | (F.col("_loads") > 1)).alias("repeats"))


def _unequal(a: DataFrame, b: DataFrame, on: str) -> DataFrame:
    """The values of ``on`` under which two digests differ or repeat a key."""
    side = lambda d, x: d.select(F.col(on).alias(f"{x}_{on}"), F.col("repeats").alias(f"{x}_repeats"),
                                 F.struct(*_SUMS).alias(f"{x}_sums"))
    joined = side(a, "a").join(side(b, "b"), F.col(f"a_{on}") == F.col(f"b_{on}"), "full_outer")
    repeats = F.coalesce("a_repeats", F.lit(False)) | F.coalesce("b_repeats", F.lit(False))
    return joined.where(repeats | ~F.col("a_sums").eqNullSafe(F.col("b_sums"))).select(F.coalesce(f"a_{on}", f"b_{on}").alias(on))


def differing(a: DataFrame, b: DataFrame, tree: Tree = Tree()) -> DataFrame:
    """The buckets to look into, found from the coarse level down."""
    wide = lambda d: d.withColumn("coarse", F.floor(F.col("bucket") / tree.fan))
    up = lambda d: wide(d).groupBy("coarse").agg(*[F.sum(c).alias(c) for c in _SUMS], F.max("repeats").alias("repeats"))
    top = _unequal(up(a), up(b), "coarse")
    inside = lambda d: wide(d).join(top, "coarse", "left_semi")
    return _unequal(inside(a), inside(b), "bucket")


def in_question(df: DataFrame, key: str, buckets: DataFrame, tree: Tree = Tree()) -> DataFrame:
    """The rows of a snapshot whose bucket is listed."""
    return df.withColumn("_bucket", bucket_of(key, tree)).join(
        buckets.select(F.col("bucket").alias("_bucket")), "_bucket", "left_semi").drop("_bucket")


def reconcile_by_digest(source: DataFrame, target: DataFrame, key: str, amount: str | None = None,
                        tolerance: str = "0.01", entity: str | None = None, tree: Tree = Tree(),
                        source_digest: DataFrame | None = None, target_digest: DataFrame | None = None) -> DataFrame:
    """The rows of ``reconcile_keys``, joined for differing buckets only.
    Digests that aren't given are made and written here."""
    made = lambda df, d, side: d if d is not None else materialized(digest(df, key, amount, tree), name=f"digest-{side}")
    buckets = materialized(differing(made(source, source_digest, "source"), made(target, target_digest, "target"), tree),
                           name="differing")
    return reconcile_keys(in_question(source, key, buckets, tree), in_question(target, key, buckets, tree),
                          key, amount, tolerance, entity)
