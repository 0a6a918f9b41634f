"""The order fact from arrivals of all its source tables, in any order.

Each source table lands in a folder of its own. A stream a table takes every
new file once, makes its rows silver and appends them to a versioned store
(``operators.versions``) keyed like the fact; the batch's number is the load's
tag, so a batch that is replayed is not stored twice.

A rebuild then reads the change feed of the stores: the rows appended since
the versions that the fact has seen. Their order ids are the touched keys. The
fact rows of those orders are built again from the stores' files that can hold
them, and merged; a refund or shipment that arrives long after its order (or
before it) reaches the fact like any other. The versions seen are the tag of
the fact's load, committed with it, so a rebuild that dies is repeated whole.
The cost follows the touched orders, not the stores.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vellum import contracts
from vellum.operators.versions import KeyedTable
from vellum.plans import revenue
from vellum.sources import files
from vellum.sources.tables import materialized

#: the source tables and the keys of their stores; the fact reads those keyed by order
STORE_KEYS = {"customers": "customer_id", "products": "product_id", "orders": "order_id", "order_items": "order_id",
              "payments": "order_id", "shipments": "order_id", "refunds": "order_id"}
FACT_TABLES = tuple(e for e, key in STORE_KEYS.items() if key == "order_id")


class ArrivingFact:
    """The fact under ``base`` and the stores it is built from."""

    def __init__(self, spark: SparkSession, base: str, schemas: dict = contracts.REVENUE,
                 silver: dict[str, Callable[[DataFrame], DataFrame]] = revenue.SILVER):
        self.spark, self.base, self.schemas, self.silver = spark, base.rstrip("/"), schemas, silver
        self.stores = {e: KeyedTable(spark, f"{self.base}/stores/{e}", key) for e, key in STORE_KEYS.items()}
        self.fact = KeyedTable(spark, f"{self.base}/fact", "order_id")

    # ------------------------------------------------------------- intake
    def _keep(self, entity: str) -> Callable[[DataFrame, int], None]:
        def keep(batch: DataFrame, number: int) -> None:
            store, tag = self.stores[entity], f"batch-{number}"
            if store.version_of(tag) is None:
                store.append(self.silver[entity](batch), tag=tag)

        return keep

    def take_in(self, landing: str) -> None:
        """Store every file that is new in ``<landing>/<entity>``, then stop."""
        queries = [self.spark.readStream.schema(self.schemas[e]).parquet(f"{landing}/{e}")
                   .writeStream.foreachBatch(self._keep(e)).option("checkpointLocation", f"{self.base}/streams/{e}")
                   .trigger(availableNow=True).start()
                   for e in STORE_KEYS if files.exists(self.spark, f"{landing}/{e}")]
        for q in queries:
            q.awaitTermination()

    # ------------------------------------------------------------ rebuild
    def seen(self) -> dict[str, int]:
        """The store versions that the newest fact version was built from."""
        version = self.fact.current()
        tag = None if version is None else self.fact.log().where(F.col("version") == version).first()["tag"]
        return {} if tag is None else json.loads(tag)

    def _of(self, entity: str, keys: DataFrame, now: dict[str, int]) -> DataFrame:
        if entity not in now:  # nothing has arrived yet
            return self.silver[entity](self.spark.createDataFrame([], self.schemas[entity]))
        return self.stores[entity].rows_of(keys, now[entity])

    def rebuild(self) -> int | None:
        """Bring the fact up to date with the stores: its new version, None
        if nothing has arrived for an order."""
        seen = self.seen()
        now = {e: v for e in FACT_TABLES if (v := self.stores[e].current()) is not None}
        fresh = [self.stores[e].added(seen.get(e), v) for e, v in now.items() if v != seen.get(e)]
        if not fresh:
            return None
        keys = materialized(reduce(DataFrame.unionByName, [df.select(F.col("order_id").alias("_key")) for df in fresh]).distinct(),
                            name="touched-orders")
        rows = revenue.fact_order(revenue.Silver.from_silver({e: self._of(e, keys, now) for e in FACT_TABLES}))
        tag = json.dumps(now, sort_keys=True)
        return self.fact.replace(rows, tag) if self.fact.current() is None else self.fact.merge(keys, rows, tag=tag)

    def compact(self, small_bytes: int) -> None:
        """Join small files: of the fact, and of the stores as far as the fact has seen them."""
        for e, version in self.seen().items():
            self.stores[e].compact(small_bytes, upto=version)
        if self.fact.current() is not None:
            tag = json.dumps(self.seen(), sort_keys=True)
            self.fact.compact(small_bytes, tag=tag)

    def read(self) -> DataFrame | None:
        return self.fact.read()
