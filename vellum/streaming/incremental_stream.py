"""S5 on micro-batches: new order files arriving in a landing folder are
turned into fact rows, merged by key.

``readStream`` tracks which files were processed (exactly once through its
checkpoint); ``foreachBatch`` builds the rows of the batch's keys that no
earlier batch has loaded. Each micro-batch writes its rows into its own
``_batch=<id>`` folder with overwrite and only looks at the batches before
it, so a batch replayed after a failure rewrites the same rows. The rows
loaded in the end don't depend on how the arrivals were cut into batches:
there is no watermark that a later batch could fall under.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _loaded(spark: SparkSession, base: str) -> DataFrame | None:
    from vellum.sources.files import exists
    return spark.read.parquet(base) if exists(spark, base) else None


def fact_batch_writer(build_fact: Callable[[DataFrame], DataFrame], base: str, key: str = "order_id"):
    """foreachBatch function: fact rows for the batch's keys not loaded yet."""

    def write(batch: DataFrame, batch_id: int) -> None:
        loaded = _loaded(batch.sparkSession, base)
        new = batch
        if loaded is not None:
            keys = loaded.where(F.col("_batch") < batch_id).select(F.col(key).alias("_k"))
            new = batch.join(keys, batch[key].eqNullSafe(keys["_k"]), "left_anti")
        (build_fact(new).withColumn("_batch", F.lit(batch_id).cast("long"))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("_batch").parquet(base))

    return write


def run_available(spark: SparkSession, landing: str, schema: T.StructType,
                  build_fact: Callable[[DataFrame], DataFrame], base: str, checkpoint: str,
                  key: str = "order_id") -> None:
    """Process every file now in ``landing`` that earlier runs have not, then stop."""
    query = (spark.readStream.schema(schema).parquet(landing)
             .writeStream.foreachBatch(fact_batch_writer(build_fact, base, key))
             .option("checkpointLocation", checkpoint)
             .trigger(availableNow=True)
             .start())
    query.awaitTermination()


def read_fact(spark: SparkSession, base: str) -> DataFrame:
    return spark.read.parquet(base).drop("_batch")
