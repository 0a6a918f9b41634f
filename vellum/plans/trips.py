"""T — taxi trips: typed raw table, staging filter, daily metrics, quality.

One lazy plan: scan → project/cast → filter → group by date. The filters
are plain column predicates, so Catalyst pushes them into the parquet scan
when the raw table is read straight from files.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellum.functions import avg2, sum2

# Source column → (target name, type), and the month format
TRIP_COLUMNS = (
    ("VendorID", "vendor_id", "int"),
    ("tpep_pickup_datetime", "pickup_at", "timestamp_ntz"),
    ("tpep_dropoff_datetime", "dropoff_at", "timestamp_ntz"),
    ("passenger_count", "passenger_count", "double"),
    ("trip_distance", "trip_distance", "double"),
    ("RatecodeID", "rate_code_id", "int"),
    ("PULocationID", "pickup_location_id", "int"),
    ("DOLocationID", "dropoff_location_id", "int"),
    ("payment_type", "payment_type", "int"),
    ("fare_amount", "fare_amount", "double"),
    ("tip_amount", "tip_amount", "double"),
    ("tolls_amount", "tolls_amount", "double"),
    ("total_amount", "total_amount", "double"),
)
MONTH_PATTERN = re.compile(r"^\d{4}-(0[1-9]|1[0-2])$")


def _to_int(c: Column, source_type: str) -> Column:
    # The oracle engine rounds fractional values half-even when casting to
    # INTEGER, Spark truncates; rint keeps the oracle's result for doubles.
    if source_type in ("double", "float"):
        return F.rint(c).cast("int")
    return c.cast("int")


def raw_trips(source: DataFrame) -> DataFrame:
    """Rename the source columns and cast strictly (ANSI)."""
    types = dict(source.dtypes)
    cols = []
    for src, dst, typ in TRIP_COLUMNS:
        c = F.col(src)
        if typ == "int":
            c = _to_int(c, types.get(src, ""))
        else:
            c = c.cast(typ)
        cols.append(c.alias(dst))
    return source.select(*cols)


def accept_rule() -> Column:
    """Row passes staging (three-valued: NULL measures do not pass)."""
    return (F.col("pickup_at").isNotNull() & F.col("dropoff_at").isNotNull()
            & (F.col("dropoff_at") >= F.col("pickup_at"))
            & (F.col("trip_distance") >= 0) & (F.col("total_amount") >= 0))


def violation_rule() -> Column:
    """Disjunctive violation predicate (F8); NULL measures are not violations."""
    return (F.col("pickup_at").isNull() | F.col("dropoff_at").isNull()
            | (F.col("dropoff_at") < F.col("pickup_at"))
            | (F.col("trip_distance") < 0) | (F.col("total_amount") < 0))


def staged_trips(raw: DataFrame) -> DataFrame:
    """D-T2: keep trips with times set, drop-off ≥ pick-up, distance, total ≥ 0."""
    return raw.where(accept_rule())


def daily_metrics(staged: DataFrame) -> DataFrame:
    """D-T3: per pick-up date trips, passengers, revenue and averages.

    Partial aggregation happens map-side; the shuffle carries one row per
    (partition, date), so its size is bounded by the number of dates.
    """
    return (staged.groupBy(F.col("pickup_at").cast("date").alias("trip_date"))
            .agg(F.count(F.lit(1)).alias("trip_count"),
                 F.round(F.sum(F.coalesce(F.col("passenger_count"), F.lit(0.0))), 2).alias("passenger_count"),
                 sum2("total_amount").alias("gross_revenue"),
                 avg2("trip_distance").alias("avg_trip_distance"),
                 avg2("total_amount").alias("avg_total_amount")))


def quality_report(raw: DataFrame) -> DataFrame:
    """Q7 in one pass over raw: acceptance counts and the pass flag.

    ``invalid_rows_after_cleaning`` re-applies the violation rule to the
    accepted rows; ``null_measure_rows`` are the rows dropped without being
    a violation (NULL distance or total, three-valued logic).
    """
    accept = F.coalesce(accept_rule(), F.lit(False))
    violates = F.coalesce(violation_rule(), F.lit(False))
    agg = raw.agg(
        F.count(F.lit(1)).alias("raw_rows"),
        F.count_if(accept).alias("staged_rows"),
        F.count_if(violates).alias("invalid_rows_detected"),
        F.count_if(accept & violates).alias("invalid_rows_after_cleaning"),
        F.count_if(~accept & ~violates).alias("null_measure_rows"),
    )
    return agg.select(
        "raw_rows", "staged_rows",
        (F.col("raw_rows") - F.col("staged_rows")).alias("dropped_rows"),
        "invalid_rows_detected", "invalid_rows_after_cleaning", "null_measure_rows",
        ((F.col("staged_rows") > 0) & (F.col("invalid_rows_after_cleaning") == 0)).alias("passed"),
    )


def check_month(month: str) -> str:
    """``YYYY-MM`` or ValueError."""
    if not isinstance(month, str) or not MONTH_PATTERN.fullmatch(month):
        raise ValueError(f"not a month of the form YYYY-MM: {month!r}")
    return month


def month_bounds(month: str) -> tuple[str, str]:
    check_month(month)
    year, mon = int(month[:4]), int(month[5:])
    nxt = f"{year + (mon == 12):04d}-{(mon % 12) + 1:02d}-01"
    return f"{month}-01", nxt


def select_month(raw: DataFrame, month: str, column: str = "pickup_at") -> DataFrame:
    """Trips picked up in one month: a range predicate the scan can prune on."""
    start, end = month_bounds(month)
    c = F.col(column)
    return raw.where((c >= F.lit(start).cast("timestamp_ntz")) & (c < F.lit(end).cast("timestamp_ntz")))
