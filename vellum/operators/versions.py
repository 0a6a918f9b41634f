"""Keyed tables whose versions share data files.

A version is a manifest: one row per data file with the least and greatest
key in it. Data files are never changed. An append adds files; a merge writes
again only the files that hold a touched key; the other files go on into the
next version as they are, so a load costs what it changes. A reader of an old
version keeps reading the files of that version. Compaction is a step of its
own.

Layout under ``base``: ``data/<load>/part-*`` (rows, in key ranges),
``manifest/v=<n>`` and ``log/<n>.json`` (the commit; written last). One writer at
a time commits to a table; a load that dies before its commit leaves files
that no version names.

The driver sees file names, key ranges and at most ``SPANS`` intervals of
touched keys, never keys or rows.
"""

from __future__ import annotations

import bisect
import json
import uuid

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vellum.sources import files
from vellum.sources.tables import materialized

#: intervals that stand for a set of keys when files are looked up
SPANS = 64
_LOG = "version long, parent long, kind string, tag string, schema string"


class KeyedTable:
    """A versioned table of rows with a ``key`` column (NULL is a key like any other)."""

    def __init__(self, spark: SparkSession, base: str, key: str):
        self.spark, self.base, self.key = spark, base.rstrip("/"), key

    # ------------------------------------------------------------- reading
    def log(self) -> DataFrame:
        """One row per committed version: version, parent, kind, tag, schema."""
        path = f"{self.base}/log"
        if not files.exists(self.spark, path):
            return self.spark.createDataFrame([], _LOG)
        return self.spark.read.schema(_LOG).json(path)

    def current(self) -> int | None:
        """The newest committed version, None for a new table."""
        return self.log().agg(F.max("version").alias("v")).first()["v"]

    def version_of(self, tag: str) -> int | None:
        """The version that a tagged load committed (a repeated load can be told)."""
        return self.log().where(F.col("tag") == tag).agg(F.max("version").alias("v")).first()["v"]

    def schema(self, version: int) -> T.StructType:
        row = self.log().where(F.col("version") == version).select("schema").first()
        if row is None:
            raise ValueError(f"{self.base} has no version {version}")
        return T.StructType.fromJson(json.loads(row["schema"]))

    def manifest(self, version: int) -> DataFrame:
        """The version's data files: file, load, kind, low, high, nulls, rows, bytes."""
        return self.spark.read.parquet(f"{self.base}/manifest/v={version}")

    def _rows(self, names: list[str], schema: T.StructType) -> DataFrame:
        if not names:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.base}/data/{n}" for n in names])

    def read(self, version: int | None = None) -> DataFrame | None:
        """The rows of a version (the newest by default), None for a new table."""
        version = self.current() if version is None else version
        if version is None:
            return None
        schema = self.schema(version)
        return self._rows([r.file for r in self.manifest(version).select("file").collect()], schema)

    def row_count(self, version: int) -> int:
        return int(self.manifest(version).agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("n")).first()["n"])

    def watermark(self, version: int):
        """The largest key, from the manifest alone."""
        return self.manifest(version).agg(F.max("high").alias("m")).first()["m"]

    def added(self, after: int | None, upto: int) -> DataFrame:
        """The change feed: rows that appends committed after one version and
        up to another; None is the time before the first."""
        loads = self.manifest(upto).where((F.col("kind") == "append") & (F.col("load") > F.lit(after or 0)))
        return self._rows([r.file for r in loads.select("file").collect()], self.schema(upto))

    # ------------------------------------------------- files that hold keys
    def _near(self, held: list[Row], keys: DataFrame) -> list[Row]:
        """The files whose key range meets one of a bounded number of intervals over ``keys``."""
        spans = (keys.repartitionByRange(SPANS, "_key").groupBy(F.spark_partition_id().alias("p"))
                 .agg(F.min("_key").alias("low"), F.max("_key").alias("high"), F.count_if(F.col("_key").isNull()).alias("nulls"))
                 .collect())
        nulls = any(s.nulls for s in spans)
        spans = sorted((s.low, s.high) for s in spans if s.low is not None)
        highs = [high for _, high in spans]

        def meets(f: Row) -> bool:
            if f.nulls and nulls:
                return True
            at = bisect.bisect_left(highs, f.low) if f.low is not None else len(spans)
            return at < len(spans) and spans[at][0] <= f.high

        return [f for f in held if meets(f)]

    def rows_of(self, keys: DataFrame, version: int) -> DataFrame:
        """The rows of a version whose key is in ``keys`` (column ``_key``),
        read from the files that can hold them."""
        near = self._near(self.manifest(version).collect(), keys)
        rows = self._rows([f.file for f in near], self.schema(version))
        return rows.join(keys, rows[self.key].eqNullSafe(keys["_key"]), "left_semi")

    def touched(self, keys: DataFrame, version: int) -> list[str]:
        """The files of a version that hold at least one of ``keys``: only the
        key column of the files in range is read."""
        schema = self.schema(version)
        near = self._rows([f.file for f in self._near(self.manifest(version).collect(), keys)], schema)
        if not near.inputFiles():
            return []
        held = near.select(F.col(self.key).alias("_held"), self._file().alias("file"))
        hit = held.join(keys, held["_held"].eqNullSafe(keys["_key"]), "left_semi")
        return [r.file for r in hit.select("file").distinct().collect()]

    @staticmethod
    def _file():
        return F.substring_index(F.col("_metadata.file_path"), "/data/", -1)

    # -------------------------------------------------------------- writing
    def _write(self, rows: DataFrame, kind: str, load: int) -> DataFrame:
        """Write rows in key ranges and return the manifest rows of the new
        files. A key that fills several files is cut by a hash of its rows."""
        name = f"{load:08d}-{uuid.uuid4().hex[:8]}"
        key = F.col(f"`{self.key}`")
        spread = F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns])
        (rows.repartitionByRange(key, spread).sortWithinPartitions(key)
         .write.option("compression", "zstd").parquet(f"{self.base}/data/{name}"))
        return (self.spark.read.schema(rows.schema).parquet(f"{self.base}/data/{name}")
                .select(key.alias("k"), self._file().alias("file"), F.col("_metadata.file_size").alias("bytes"))
                .groupBy("file").agg(F.lit(load).cast("long").alias("load"), F.lit(kind).alias("kind"), F.min("k").alias("low"),
                                     F.max("k").alias("high"), F.count_if(F.col("k").isNull()).alias("nulls"),
                                     F.count(F.lit(1)).alias("rows"), F.first("bytes").alias("bytes")))

    def _next(self) -> int:
        """A number above every version and every abandoned attempt."""
        n = (self.current() or 0) + 1
        while files.exists(self.spark, f"{self.base}/manifest/v={n}"):
            n += 1
        return n

    def _commit(self, manifest: DataFrame, version: int, parent: int | None, kind: str, tag: str | None, schema: T.StructType) -> int:
        manifest.coalesce(1).write.parquet(f"{self.base}/manifest/v={version}")
        row = {"version": version, "parent": parent, "kind": kind, "tag": tag, "schema": schema.json()}
        files.put_text(self.spark, f"{self.base}/log/{version:08d}.json", json.dumps(row) + "\n")
        return version

    def _check(self, rows: DataFrame, parent: int) -> T.StructType:
        old = self.schema(parent)
        if [(f.name, f.dataType) for f in old] != [(f.name, f.dataType) for f in rows.schema]:
            raise ValueError(f"schema change on {self.base}: {old.simpleString()} -> {rows.schema.simpleString()}")
        return old

    def replace(self, rows: DataFrame, tag: str | None = None) -> int:
        """A version with these rows alone (the first load, a full refresh)."""
        version = self._next()
        return self._commit(self._write(rows, "append", version), version, None, "replace", tag, rows.schema)

    def append(self, rows: DataFrame, parent: int | None = None, tag: str | None = None) -> int:
        """The parent's files and new ones with ``rows``; the first version of a new table."""
        parent = self.current() if parent is None else parent
        if parent is None:
            return self.replace(rows, tag)
        schema, version = self._check(rows, parent), self._next()
        manifest = self.manifest(parent).unionByName(self._write(rows, "append", version))
        return self._commit(manifest, version, parent, "append", tag, schema)

    def merge(self, keys: DataFrame, rows: DataFrame, parent: int | None = None, tag: str | None = None) -> int:
        """The parent without the rows of ``keys`` (column ``_key``), plus
        ``rows``. Files without a touched key are shared with the parent."""
        parent = self.current() if parent is None else parent
        schema, version = self._check(rows, parent), self._next()
        keys = materialized(keys.select("_key").distinct(), name="touched-keys")
        hit = self.touched(keys, parent)
        old = self._rows(hit, schema)
        new = old.join(keys, old[self.key].eqNullSafe(keys["_key"]), "left_anti").unionByName(rows)
        shared = self.manifest(parent).where(~F.col("file").isin(hit)) if hit else self.manifest(parent)
        return self._commit(shared.unionByName(self._write(new, "merge", version)), version, parent, "merge", tag, schema)

    def compact(self, small_bytes: int, upto: int | None = None, parent: int | None = None, tag: str | None = None) -> int:
        """Files below ``small_bytes`` written again in larger ones; the rows
        stay. ``upto`` leaves files of later loads alone, which a reader of
        the change feed has yet to see. Nothing to join: no new version."""
        parent = self.current() if parent is None else parent
        held = self.manifest(parent)
        small = held.where((F.col("bytes") < small_bytes) & (F.col("load") <= F.lit(parent if upto is None else upto)))
        names = [r.file for r in small.select("file").collect()]
        if len(names) < 2:
            return parent
        schema, version = self.schema(parent), self._next()
        manifest = held.where(~F.col("file").isin(names)).unionByName(self._write(self._rows(names, schema), "compact", version))
        return self._commit(manifest, version, parent, "compact", tag, schema)
