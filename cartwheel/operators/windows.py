"""Window and time-series operators: cumulative periods (W4–W6), year-over-year
self-join (J6), same-weekday baseline (W7), z-score (W8) and its variants (X15).

All windows here run over daily aggregates (one row per date × small key),
whose size is bounded by the calendar, not by the fact table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.functions.exprs import period_start


def cumulative(df: DataFrame, value: str, date: str, keys: list[str], grain: str,
               name: str | None = None) -> DataFrame:
    """Running sum of ``value`` from the start of the week/month/year (ISO Monday weeks)."""
    w = (Window.partitionBy(*keys, period_start(date, grain)).orderBy(date)
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return df.withColumn(name or f"{value}_{grain[0]}td", F.sum(value).over(w))


def year_over_year(current: DataFrame, base: DataFrame, keys: list[str], date: str,
                   value: str, base_name: str) -> DataFrame:
    """Left-join each row to the same keys one year earlier.

    The prior date is ``add_months(date, -12)`` (Feb 29 → Feb 28, so both Feb 28
    and Feb 29 of a leap year share one base day; no fan-out). Equality on the
    computed date keeps it an equi-join.
    """
    prior = base.select(*keys, F.col(date).alias("_prior_date"), F.col(value).alias(base_name))
    return (current.withColumn("_prior_date", F.add_months(F.col(date), -12))
            .join(prior, [*keys, "_prior_date"], "left")
            .drop("_prior_date"))


def year_over_year_window(df: DataFrame, keys: list[str], date: str, value: str,
                          base_name: str) -> DataFrame:
    """Year-ago value of the same keys, read with two exact-offset RANGE frames
    instead of a self-join (so the input is evaluated once).

    ``add_months(d, -12)`` is always d - 365 or d - 366 days (Feb 29 maps to
    Feb 28, so Feb 28 and Feb 29 of a leap year share one base day); the frame
    at the matching offset holds the prior day's row, or nothing. Requires one
    row per (keys, date).
    """
    day = F.unix_date(F.col(date))
    w = Window.partitionBy(*keys).orderBy(day)
    at365 = F.max(value).over(w.rangeBetween(-365, -365))
    at366 = F.max(value).over(w.rangeBetween(-366, -366))
    prior = F.add_months(F.col(date), -12)
    return df.withColumn(base_name,
                         F.when(prior == F.date_sub(F.col(date), 365), at365)
                         .when(prior == F.date_sub(F.col(date), 366), at366))


def weekday_baseline(daily: DataFrame, date: str = "ordered_date", value: str = "order_count",
                     weeks: int = 12) -> DataFrame:
    """Average, sample stddev and count of the same weekday over the previous
    ``weeks`` occurrences (the current day excluded)."""
    w = Window.partitionBy(F.dayofweek(date)).orderBy(date).rowsBetween(-weeks, -1)
    return (daily.withColumn("baseline_avg", F.avg(value).over(w))
                 .withColumn("baseline_stddev", F.stddev_samp(value).over(w))
                 .withColumn("baseline_weeks", F.count(F.lit(1)).over(w)))


def zscore(value, avg, sd) -> Column:
    """(value - avg) / sd, NULL when sd is 0 or NULL."""
    c = (lambda x: F.col(x) if isinstance(x, str) else x)
    return F.try_divide(c(value) - c(avg), c(sd))


def week_over_week(daily: DataFrame, date: str = "ordered_date", value: str = "order_count") -> DataFrame:
    """Change against the same weekday one week earlier (exact date match)."""
    prior = daily.select(F.col(date).alias("_prior_date"), F.col(value).alias("prior_week_count"))
    return (daily.withColumn("_prior_date", F.date_sub(F.col(date), 7))
            .join(prior, "_prior_date", "left").drop("_prior_date")
            .withColumn("wow_change_rate",
                        F.round(F.try_divide((F.col(value) - F.col("prior_week_count")).cast("double"),
                                             F.col("prior_week_count").cast("double")), 4)))


def min_max_band(daily: DataFrame, date: str = "ordered_date", value: str = "order_count",
                 days: int = 28) -> DataFrame:
    """min–max band of the previous ``days`` days; flag values outside it."""
    w = Window.orderBy(date).rowsBetween(-days, -1)
    return (daily.withColumn("band_min", F.min(value).over(w))
                 .withColumn("band_max", F.max(value).over(w))
                 .withColumn("outside_band",
                             (F.col(value) < F.col("band_min")) | (F.col(value) > F.col("band_max"))))
