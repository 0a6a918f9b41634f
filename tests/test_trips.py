import datetime as dt

import pytest
from pyspark.sql import functions as F

from vellum.plans import trips

SCHEMA = ("vendor_id int, pickup_at timestamp_ntz, dropoff_at timestamp_ntz, passenger_count double, "
          "trip_distance double, total_amount double")
NOON = dt.datetime(2031, 7, 9, 12)


def _trips(spark, *rows):
    """Rows of (vendor, minutes from noon to pick-up, minutes of the trip, distance, total); None is NULL."""
    def at(minutes):
        return None if minutes is None else NOON + dt.timedelta(minutes=minutes)
    return spark.createDataFrame([(v, at(a), at(None if a is None or b is None else a + b), 1.0, d, t)
                                  for v, a, b, d, t in rows], SCHEMA)


@pytest.mark.parametrize("month", ["2031-00", "2031-1", "31-01", "2031/01", "", None, 203101])
def test_other_months_are_refused(month):
    with pytest.raises(ValueError):
        trips.check_month(month)


def test_month_bounds_over_the_year_end():
    assert trips.month_bounds("2031-11") == ("2031-11-01", "2031-12-01")
    assert trips.month_bounds("2031-12") == ("2031-12-01", "2032-01-01")


def test_acceptance_at_the_edges(spark):
    raw = _trips(spark,
                 (1, 0, 0, 0.0, 0.0),        # no duration, no distance, no charge: still a trip
                 (2, 0, -1, 4.2, 7.7), (3, 0, 5, -0.001, 7.7), (4, 0, 5, 4.2, -0.01),
                 (5, None, 5, 4.2, 7.7), (6, 0, None, 4.2, 7.7),
                 (7, 0, 5, None, 7.7), (8, 0, 5, 4.2, None))
    assert [r.vendor_id for r in trips.staged_trips(raw).collect()] == [1]
    r = trips.quality_report(raw).first()
    assert (r.raw_rows, r.staged_rows, r.dropped_rows) == (8, 1, 7)
    # NULL times are violations, NULL measures are only dropped
    assert (r.invalid_rows_detected, r.null_measure_rows, r.invalid_rows_after_cleaning, r.passed) == (5, 2, 0, True)


def test_nothing_accepted_does_not_pass(spark):
    assert trips.quality_report(_trips(spark, (1, 0, -5, 1.0, 1.0))).first().passed is False


def test_days_split_at_midnight_and_follow_the_pick_up(spark):
    raw = _trips(spark, (1, 719, 30, 0.125, 3.333), (2, 720, 1, 0.25, 3.333), (3, 720, 1, 0.25, 3.335))
    days = {r.trip_date.day: r for r in trips.daily_metrics(raw).collect()}
    assert (days[9].trip_count, days[9].avg_trip_distance, days[9].gross_revenue) == (1, 0.13, 3.33)
    # 6.668 and 3.334: three decimals are summed before anything is rounded
    assert (days[10].trip_count, days[10].gross_revenue, days[10].avg_total_amount, days[10].passenger_count) == (2, 6.67, 3.33, 2.0)


def test_columns_are_renamed_and_cast(spark):
    kinds = {"int": "long", "timestamp_ntz": "timestamp_ntz", "double": "double"}
    source = spark.range(1).select(*[F.lit(None).cast(kinds[t]).alias(name) for name, _, t in trips.TRIP_COLUMNS])
    assert trips.raw_trips(source).dtypes == [(new, t) for _, new, t in trips.TRIP_COLUMNS]


def test_fractional_codes_round_half_even(spark):
    source = spark.range(4).select(*[(F.col("id") + 0.5).alias(n) if n == "RatecodeID" else F.lit(None).cast(
        "timestamp_ntz" if t == "timestamp_ntz" else "double").alias(n) for n, _, t in trips.TRIP_COLUMNS])
    assert sorted(r.rate_code_id for r in trips.raw_trips(source).collect()) == [0, 2, 2, 4]


def test_a_month_holds_its_first_instant_and_not_the_next(spark):
    start, end = -12 * 60 - 8 * 1440, -12 * 60 + 23 * 1440  # 2031-07-01 and 2031-08-01, from noon of the 9th
    raw = _trips(spark, (1, start, 1, 1.0, 1.0), (2, start - 1, 5, 1.0, 1.0), (3, end, 1, 1.0, 1.0), (4, end - 1, 5, 1.0, 1.0))
    assert sorted(r.vendor_id for r in trips.select_month(raw, "2031-07").collect()) == [1, 4]
