"""W1 without a single partition: consecutive row numbers in a global order.

``row_number() over (order by …)`` with no PARTITION BY moves every row to
one task. Here the rows are range-partitioned on the order keys and sorted
inside each partition; a per-partition position comes from
``monotonically_increasing_id`` (partition id in the high bits, position in
the low 33 bits), and each partition's offset is the running total of the
partition sizes — a table with one row per partition, so its broadcast is
bounded by the partition count, not by the data.

The tagged frame is written once (parquet under the shared
``spark.checkpoint.dir``) so the count pass and the numbering pass read the
same positions even if an executor is lost in between.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vellum.sources.tables import materialized

_LOW_BITS = 33


def number_rows(df: DataFrame, order: list[Column], name: str = "row_number",
                partitions: int | None = None, checkpoint: bool = True) -> DataFrame:
    """Add ``name`` = 1..N following ``order`` (make the order total: ties
    get an arbitrary but consistent order)."""
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n, *order).sortWithinPartitions(*order)
    tagged = ranged.withColumn("_mid", F.monotonically_increasing_id())
    if checkpoint:
        tagged = materialized(tagged, name="numbering")
    pid = F.shiftright(F.col("_mid"), _LOW_BITS)
    pos = F.col("_mid").bitwiseAND(F.lit((1 << _LOW_BITS) - 1))
    sizes = tagged.groupBy(pid.alias("_pid")).agg(F.count(F.lit(1)).alias("_size"))
    # one row per partition: the running total is computed on a bounded table
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_pid", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    out = (tagged.withColumn("_pid", pid)
           .join(F.broadcast(offsets), "_pid")
           .withColumn(name, (F.col("_offset") + pos + 1).cast("long")))
    return out.drop("_mid", "_pid", "_offset")
