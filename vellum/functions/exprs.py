"""Column expressions shared by the marts.

All are built-in Spark expressions (no Python UDF), so they stay inside
whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed types. Row-level money keeps the reference's DECIMAL(12,2).
# Aggregated money is DECIMAL(22,2) — the width Spark gives sum(decimal(12,2))
# — because a (12,2) total overflows at test scale already (deliberate
# deviation, see README "Semantics").
MONEY = "decimal(12,2)"
MONEY_TOTAL = "decimal(22,2)"
RECON_TOTAL = MONEY_TOTAL  # the reference uses (14,2); it overflows at 10^12
RATE = "decimal(12,2)"


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(c: str | Column) -> Column:
    """Cast to row-level money, DECIMAL(12,2), rounding half up."""
    return col(c).cast(MONEY)


def money_total(c: str | Column) -> Column:
    return col(c).cast(MONEY_TOTAL)


def norm_lower(c: str | Column) -> Column:
    """LOWER(TRIM(x)); trim removes spaces only, as in SQL."""
    return F.lower(F.trim(col(c)))


def norm_upper(c: str | Column) -> Column:
    return F.upper(F.trim(col(c)))


def ratio_pct(numer: str | Column, denom: str | Column) -> Column:
    """``100 * n / nullif(d, 0)`` as DECIMAL(12,2), NULL when d is 0 or NULL.

    Decimal arithmetic (not double) so the cast rounds an exact value.
    """
    n = col(numer).cast("decimal(20,0)")
    d = col(denom).cast("decimal(20,0)")
    return (F.lit(100).cast("decimal(3,0)") * n / F.nullif(d, F.lit(0).cast("decimal(20,0)"))).cast(RATE)


#: measured doubles are summed as decimals of this type: six places, no rounding to cents
MEASURE = "decimal(20,6)"


def sum2(c: str | Column) -> Column:
    """``round(sum(x), 2)`` of a measured double, rounded half up once."""
    return F.round(F.sum(col(c).cast(MEASURE)), 2).cast("double")


def avg2(c: str | Column) -> Column:
    """``round(avg(x), 2)`` of a measured double, rounded half up once.

    Values enter with six decimal places and are summed exactly; cents are
    only rounded to at the end, so neither ties such as 12.345 nor values
    with three decimals depend on an order or on binary floating point. The
    quotient is taken as a whole number of cents (a decimal quotient would
    be rounded once more). Result is DOUBLE.
    """
    total, n = F.sum(col(c).cast(MEASURE)), F.count(col(c)).cast("decimal(20,0)")
    twice = F.lit(2).cast("decimal(1,0)") * F.nullif(n, F.lit(0).cast("decimal(20,0)"))
    scaled = F.lit(200).cast("decimal(3,0)") * F.abs(total) + n
    cents = ((scaled - scaled % twice) / twice).cast("decimal(28,0)").cast("double")
    return F.signum(total.cast("double")) * cents / F.lit(100.0)


def days_between(start: str | Column, end: str | Column) -> Column:
    """``date_diff('day', start, end)``: calendar-day boundaries, end − start.

    Both sides are cast to DATE first so a 23:00 → 01:00 span counts 1.
    """
    return F.date_diff(col(end).cast("date"), col(start).cast("date"))


def title_label(c: str | Column) -> Column:
    """snake_case name → Title Case label (``duplicate_ids`` → ``Duplicate Ids``)."""
    return F.initcap(F.regexp_replace(col(c), "_", " "))


def display_time(c: str | Column) -> Column:
    """A timestamp as the dashboards show it, to the second: ``2024-03-05 14:30:09``."""
    return F.date_format(col(c), "yyyy-MM-dd HH:mm:ss")


def money_text(c: str | Column) -> Column:
    """``$1,234.50`` display text of a decimal, exact at any width; NULL stays NULL."""
    return F.concat(F.lit("$"), F.format_number(col(c), 2))


def avg_money(c: str | Column) -> Column:
    """``round(avg(x), 2)`` of a decimal column as DECIMAL(12,2).

    sum / count in decimal arithmetic, rounded half up once (a plain
    ``avg`` first rounds to 6 places, which can round twice).
    """
    x = col(c)
    mean = F.sum(x) / F.nullif(F.count(x).cast("decimal(20,0)"), F.lit(0).cast("decimal(20,0)"))
    return F.round(mean, 2).cast(MONEY)
