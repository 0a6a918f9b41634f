"""Readers for the driver's parquet tables (one file or folder per table)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Lazy parquet scan; Catalyst prunes columns and pushes filters into it."""
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(table_path(sf_dir, name))


class Tables:
    """Attribute access to the tables of one scale factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._cache: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in TABLES:
            raise AttributeError(name)
        if name not in self._cache:
            self._cache[name] = read_table(self.spark, self.sf_dir, name)
        return self._cache[name]


def dealt(df: DataFrame, key: str) -> DataFrame:
    """The rows in the session's number of partitions by ``key``, as the
    planner would deal them, but never joined to fewer: 64 MB of packed keys are
    millions of groups, and a task's maps and sorts of them over a gigabyte."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)


def keyed_join(left: DataFrame, right: DataFrame, on, how: str = "inner") -> DataFrame:
    """A join of two sides that both grow with the input: sorted and merged,
    never broadcast. The planner takes a side's size from its packed files, and
    10 MB of packed keys are millions of rows, which a broadcast would unpack on
    the driver and keep there, several at a time when a layer is written."""
    return left.join(right.hint("merge"), on, how)


def materialized(df: DataFrame, enabled: bool = True, name: str = "layer") -> DataFrame:
    """Write ``df`` once as parquet under the shared checkpoint folder and read it back.

    This is the layer boundary of a medallion run (silver, then gold built
    from the written silver): later plans start from the written files, the
    lineage is cut, and a lost executor does not force a recomputation of
    the layer below. Parquet (not a row checkpoint) keeps column pruning and
    filter pushdown for every reader of the layer. Rows stay where their task
    wrote them: dealing raw rows out by a key would put a hot key into one
    file and keep later joins from splitting it.
    """
    if not enabled:
        return df
    import uuid

    from vellum.session import work_dir
    return write_table(df, work_dir(df.sparkSession, f"{name}-{uuid.uuid4().hex[:12]}"))


def write_table(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` as parquet (zstd) at ``path`` and return the written table."""
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.parquet(path)


def materialize_all(frames: dict, name: str = "layer", parallel: int = 8) -> dict:
    """Materialize several independent tables as concurrent Spark jobs.

    Small tables of one layer do not fill a cluster on their own; submitting
    their writes from a few driver threads lets the scheduler run them side
    by side. Returns the read-back frames under the same keys.
    """
    from concurrent.futures import ThreadPoolExecutor
    items = list(frames.items())
    if not items:
        return {}
    label = lambda k: f"{name}-{k if isinstance(k, str) else '-'.join(k)}"
    with ThreadPoolExecutor(max_workers=max(1, min(parallel, len(items)))) as pool:
        futures = {k: pool.submit(materialized, df, True, label(k)) for k, df in items}
        return {k: f.result() for k, f in futures.items()}
