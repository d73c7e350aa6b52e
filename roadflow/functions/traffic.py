
from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadflow import fixed


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def congestion_index(total_vehicles: str | Column = "total_vehicles",
                     avg_speed: str | Column = "avg_speed_window") -> Column:
    """vehicles / speed; speed 0 or NULL gives NULL (never a division error)."""
    return _c(total_vehicles) / F.nullif(_c(avg_speed), F.lit(0.0))


# Averages of averages are summed as decimals: the sum is exact, so the result
# does not depend on the order in which shuffle blocks arrive (double sums do,
# and rounding to 2 places then flips half-way cases between runs). Exact sums
# also roll up exactly: a mean over days equals the mean of the daily sums.
EXACT_SUM_TYPE = T.DecimalType(38, 18)
_COUNT_TYPE = T.DecimalType(20, 0)


def exact_sum(c: str | Column) -> Column:
    """Aggregate: exact (decimal) sum of a double column. A value that has no such decimal (NaN, infinite,
    1e20 and more) is left out rather than stopping the query."""
    return F.try_sum(_c(c).try_cast(EXACT_SUM_TYPE))


def exact_ratio(total: str | Column, n: str | Column) -> Column:
    """total / n as a double; n = 0 (no values) gives NULL, as avg does."""
    return F.try_divide(_c(total), _c(n).cast(_COUNT_TYPE)).cast(T.DoubleType())


def exact_mean(c: str | Column) -> Column:
    """Aggregate: order-independent mean of a double column (NULLs skipped). A group with a value that
    has no exact decimal, or whose sum has none, gets the plain ``avg``."""
    total, n = exact_sum(c), F.count(_c(c))
    fits = (F.count(_c(c).try_cast(EXACT_SUM_TYPE)) == n) & ((n == 0) | total.isNotNull())
    return F.when(fits, exact_ratio(total, n)).otherwise(F.avg(_c(c)))


def mean_parts(c: str | Column, name: str) -> list[Column]:
    """Aggregates from which any coarser mean follows (``mean_of_parts``): the exact sum, the number of values and of those
    that the exact sum holds, and the plain sum for groups with a value that has no exact decimal."""
    return [exact_sum(c).alias(f"{name}_sum"), F.count(_c(c)).alias(f"{name}_n"),
            F.count(_c(c).try_cast(EXACT_SUM_TYPE)).alias(f"{name}_fit"), F.sum(_c(c)).alias(f"{name}_plain")]


def add_parts(name: str) -> list[Column]:
    """Aggregates that merge ``mean_parts``: all of them are additive."""
    return [F.try_sum(f"{name}_sum").alias(f"{name}_sum"), *[F.sum(f"{name}_{k}").alias(f"{name}_{k}") for k in ("n", "fit", "plain")]]


def mean_of_parts(name: str) -> Column:
    """The mean of the values behind merged ``mean_parts``, by the rule of ``exact_mean``."""
    total, n, fit = (F.col(f"{name}_{k}") for k in ("sum", "n", "fit"))
    exact = (fit == n) & ((n == 0) | total.isNotNull())
    return F.when(exact, exact_ratio(total, n)).otherwise(F.try_divide(F.col(f"{name}_plain"), n.cast("double")))


def speed_round(c: str | Column, scale: int = 2) -> Column:
    """HALF_UP rounding, as Spark's round (14.995 -> 15.0)."""
    return F.round(_c(c), scale)


def intervention_flag(rounded_speed: str | Column = "avg_speed_at_peak",
                      threshold: float = fixed.INTERVENTION_SPEED_BELOW) -> Column:
    """'YES' when the rounded peak speed is below the threshold; NULL speed -> 'NO'."""
    return F.when(_c(rounded_speed) < threshold, F.lit(fixed.INTERVENTION_YES)) \
        .otherwise(F.lit(fixed.INTERVENTION_NO))


def junction_status(speed: str | Column = "avg_speed_window",
                    critical_below: float = fixed.STATUS_CRITICAL_BELOW,
                    warning_below: float = fixed.STATUS_WARNING_BELOW) -> Column:
    """Critical / Warning / Normal with strict bounds; NULL speed -> NULL."""
    s = _c(speed)
    return (F.when(s < critical_below, F.lit(fixed.STATUS_CRITICAL))
            .when(s < warning_below, F.lit(fixed.STATUS_WARNING))
            .when(s.isNotNull(), F.lit(fixed.STATUS_NORMAL)))


def congestion_band(index: str | Column = "congestion_index",
                    medium_from: float = fixed.INDEX_BAND_MEDIUM_FROM,
                    high_from: float = fixed.INDEX_BAND_HIGH_FROM) -> Column:
    """low [.., 30) / medium [30, 60) / high [60, ..); NULL index -> NULL."""
    i = _c(index)
    return (F.when(i < medium_from, F.lit("low"))
            .when(i < high_from, F.lit("medium"))
            .when(i.isNotNull(), F.lit("high")))


def delta_from_reference(index: str | Column = "congestion_index",
                         reference: float = fixed.INDEX_REFERENCE) -> Column:
    return _c(index) - F.lit(reference)


def in_peak_band(volume: str | Column, low: int = fixed.PEAK_BAND_LOW,
                 high: int = fixed.PEAK_BAND_HIGH) -> Column:
    return _c(volume).between(low, high)


def marker_size(index: str | Column = "congestion_index",
                scale: float = fixed.MARKER_SCALE) -> Column:
    return _c(index) * F.lit(scale)


def area_from_name(name: str | Column = "name") -> Column:
    """Second-to-last word of a junction name; the whole name when it has one word."""
    n = _c(name)
    return F.coalesce(F.try_element_at(F.split(F.trim(n), r"\s+"), F.lit(-2)), F.trim(n))


def alert_message(status: str | Column = "status",
                  speed: str | Column = "avg_speed_window") -> Column:
    """Status-alert text; Normal and NULL statuses give NULL."""
    st = _c(status)
    shown = F.round(_c(speed), 1).cast("string")
    return (F.when(st == fixed.STATUS_CRITICAL,
                   F.concat(F.lit(fixed.CRITICAL_MESSAGE_PREFIX), shown,
                            F.lit(fixed.CRITICAL_MESSAGE_SUFFIX)))
            .when(st == fixed.STATUS_WARNING, F.lit(fixed.WARNING_MESSAGE)))


def alert_recommendation(status: str | Column = "status") -> Column:
    st = _c(status)
    return (F.when(st == fixed.STATUS_CRITICAL, F.lit(fixed.CRITICAL_RECOMMENDATION))
            .when(st == fixed.STATUS_WARNING, F.lit(fixed.WARNING_RECOMMENDATION)))


def timestamp_literal(value: dt.date | dt.datetime | str,
                      data_type: T.DataType = T.TimestampType()) -> Column:
    """A typed timestamp literal matching the column it is compared with.

    Comparing an NTZ column with an LTZ literal wraps the column in a cast and
    the predicate no longer reaches the Parquet reader; a literal of the
    column's own type keeps ``PushedFilters`` intact.
    """
    if isinstance(value, str):
        value = dt.datetime.fromisoformat(value)
    elif not isinstance(value, dt.datetime):
        value = dt.datetime(value.year, value.month, value.day)
    text = value.strftime("%Y-%m-%d %H:%M:%S.%f")
    if isinstance(data_type, T.TimestampNTZType):
        return F.lit(text).cast(T.TimestampNTZType())
    return F.lit(text).cast(T.TimestampType())
