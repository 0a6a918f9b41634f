"""File intake and sinks: typed CSV snapshots under a contract (S1, Q1),
required-input checks (S7), schema introspection (S8), parquet snapshots
(S3/S4) and JSON evidence (S6).

Paths may be any Hadoop-compatible URI; existence checks go through
Spark's own file listing, never through the local file system.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

CSV_OPTIONS = {
    "header": "true",
    "mode": "PERMISSIVE",
    # keep surrounding spaces: trimming is a Silver rule, not a read option
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "emptyValue": "",
    "dateFormat": "yyyy-MM-dd",
}


#: for snapshots that are to read back as they were
EXACT_OPTIONS = {
    **CSV_OPTIONS,
    "nullValue": "\\N",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def monthly_file(source_dir: str, month: str) -> str:
    """The file of one month of trips (month validated by the caller)."""
    return f"{source_dir.rstrip('/')}/yellow_tripdata_{month}.parquet"


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None,
             corrupt_column: str | None = None, exact: bool = False) -> DataFrame:
    """Header CSV; with a contract schema there is no inference pass.

    Without a schema every column is read as text (bronze keeps the source
    as is). ``corrupt_column`` keeps unparseable lines for quarantine.
    """
    reader = spark.read.options(**(EXACT_OPTIONS if exact else CSV_OPTIONS))
    if schema is not None:
        if corrupt_column:
            schema = T.StructType(list(schema.fields) + [T.StructField(corrupt_column, T.StringType())])
            reader = reader.option("columnNameOfCorruptRecord", corrupt_column)
        reader = reader.schema(schema)
    return reader.csv(path)


def write_csv(df: DataFrame, path: str, exact: bool = False, compression: str = "none") -> None:
    """A CSV snapshot, packed if told so (a reader unpacks by the files' names). An ``exact`` one, which the reader is told as well,
    keeps a NULL and an empty text apart and times to the microsecond; in
    another, as in files that users deliver, both are read as NULL."""
    options = {**EXACT_OPTIONS, "emptyValue": '""'} if exact else CSV_OPTIONS
    df.write.mode("overwrite").options(**options).option("compression", compression).csv(path)


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Replace a parquet snapshot (dynamic partition overwrite when partitioned)."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by)
    w.parquet(path)


def append_parquet(df: DataFrame, path: str) -> None:
    """One more arrival in a landing folder (zstd)."""
    df.write.mode("append").option("compression", "zstd").parquet(path)


def write_json(df: DataFrame, path: str) -> None:
    """Evidence rows (structs, maps, arrays) as JSON lines, one file."""
    df.coalesce(1).write.mode("overwrite").json(path)


def put_text(spark: SparkSession, path: str, text: str) -> None:
    """A small new file that is there whole or not at all: written under a
    name that readers skip, then renamed. No job runs for it."""
    try:
        jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    except Exception:  # noqa: BLE001 - remote session: no gateway
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(path)
        return
    folder, name = path.rsplit("/", 1)
    hidden, final = jvm.org.apache.hadoop.fs.Path(f"{folder}/_{name}"), jvm.org.apache.hadoop.fs.Path(path)
    fs = final.getFileSystem(conf)
    out = fs.create(hidden, True)
    out.write(text.encode())
    out.close()
    if not fs.rename(hidden, final):
        raise FileExistsError(path)


def exists(spark: SparkSession, path: str) -> bool:
    """True if ``path`` exists, asked of the Hadoop file system the session
    uses (any URI scheme the cluster is configured for).

    A remote session without a JVM gateway falls back to resolving the path
    through a data source."""
    try:
        jvm = spark.sparkContext._jvm
        conf = spark.sparkContext._jsc.hadoopConfiguration()
    except Exception:  # noqa: BLE001 - remote session: no gateway
        jvm = None
    if jvm is not None:
        p = jvm.org.apache.hadoop.fs.Path(path)
        return bool(p.getFileSystem(conf).exists(p))
    from pyspark.errors import AnalysisException
    try:
        spark.read.format("binaryFile").load(path).schema  # noqa: B018 - resolves the path
    except AnalysisException as err:
        if "PATH_NOT_FOUND" in str(err) or "Path does not exist" in str(err):
            return False
        raise
    return True


def fingerprint(spark: SparkSession, paths: list[str]) -> str:
    """A digest of the names, sizes and times of all files under ``paths``
    (their contents are not read): equal as long as no file changes."""
    from pyspark.sql import functions as F
    listing = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(paths)
               .select(F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)").alias("h")))
    row = listing.agg(F.count(F.lit(1)).alias("n"), F.sum("h").alias("s")).first()
    return f"{row['n']}:{row['s']}"


def require_inputs(spark: SparkSession, paths: dict[str, str]) -> None:
    """Fail naming every missing input at once."""
    missing = [name for name, path in paths.items() if not exists(spark, path)]
    if missing:
        raise FileNotFoundError(f"Missing source files: {', '.join(missing)}")


def schema_diff(actual: T.StructType, contract: T.StructType) -> list[dict]:
    """Missing, extra and type-changed columns against a contract."""
    a = {f.name: f.dataType for f in actual}
    c = {f.name: f.dataType for f in contract}
    out = []
    for name, typ in c.items():
        if name not in a:
            out.append({"column": name, "issue": "missing", "expected": typ.simpleString(), "actual": None})
        elif a[name] != typ:
            out.append({"column": name, "issue": "type_changed", "expected": typ.simpleString(),
                        "actual": a[name].simpleString()})
    for name, typ in a.items():
        if name not in c:
            out.append({"column": name, "issue": "extra", "expected": None, "actual": typ.simpleString()})
    return out
