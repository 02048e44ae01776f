"""Reporting traps: YoY leap day (T11), cumulative resets (W4–W6), weekday
baseline (Q9), funnel channel coalescing (T7), exact ratio rounding."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from cartwheel.functions.exprs import guarded_rate
from cartwheel.operators.windows import (cumulative, weekday_baseline, year_over_year,
                                         year_over_year_window)
from cartwheel.operators.rollups import daily_funnel_base
from conftest import rows


def daily(spark, pairs):
    return spark.createDataFrame([("D", dt.date.fromisoformat(d), Decimal(v)) for d, v in pairs],
                                 "dept string, d date, v decimal(38,9)")


def test_yoy_leap_day_window_equals_self_join(spark):
    df = daily(spark, [("2023-02-28", "1"), ("2024-02-28", "2"), ("2024-02-29", "3"),
                       ("2025-02-28", "4"), ("2024-03-01", "5"), ("2023-03-01", "6")])
    w = rows(year_over_year_window(df, ["dept"], "d", "v", "base"), "d", "base")
    j = rows(year_over_year(df, df, ["dept"], "d", "v", "base"), "d", "base")
    assert w == j
    got = {str(d): b for d, b in w}
    assert got["2024-02-28"] == got["2024-02-29"] == Decimal("1")   # both use Feb 28, 2023
    assert got["2025-02-28"] == Decimal("2")                        # not Feb 29
    assert got["2024-03-01"] == Decimal("6")


def test_cumulative_resets(spark):
    df = daily(spark, [("2023-12-30", "1"), ("2023-12-31", "2"), ("2024-01-01", "4"),   # Sat Sun Mon
                       ("2024-01-31", "8"), ("2024-02-01", "16")])
    for g in ("week", "month", "year"):
        df = cumulative(df, "v", "d", ["dept"], g)
    got = {str(r.d): (int(r.v_wtd), int(r.v_mtd), int(r.v_ytd)) for r in df.collect()}
    assert got["2023-12-31"] == (3, 3, 3)          # Sunday closes the ISO week
    assert got["2024-01-01"] == (4, 4, 4)          # Monday, new month, new year
    assert got["2024-01-31"] == (8, 12, 12)
    assert got["2024-02-01"] == (24, 16, 28)       # same week (Wed–Thu), new month


def test_weekday_baseline_excludes_self_and_zero_variance(spark):
    start = dt.date(2024, 1, 1)
    data = [(start + dt.timedelta(days=7 * i), 10) for i in range(13)] + [(start + dt.timedelta(days=91), 100)]
    df = spark.createDataFrame(data, "ordered_date date, order_count long")
    b = {r.ordered_date: r for r in weekday_baseline(df).collect()}
    last = b[start + dt.timedelta(days=91)]
    assert last.baseline_weeks == 12 and last.baseline_avg == 10 and last.baseline_stddev == 0
    assert b[start].baseline_weeks == 0


def test_funnel_unknown_channel_grouped_once(spark):
    s = spark.createDataFrame([
        (dt.date(2024, 1, 1), None, 1, True, False, False, True, 0, 1),
        (dt.date(2024, 1, 1), None, 2, False, False, False, True, 0, 1),
        (dt.date(2024, 1, 1), "email", 1, True, True, True, False, 60, 3)],
        "session_date date, entry_traffic_source string, user_id long, viewed_product boolean, "
        "added_to_cart boolean, purchased boolean, is_bounce boolean, session_duration_seconds long, "
        "event_count long")
    got = {r.entry_traffic_source: (r.session_count, r.user_count) for r in daily_funnel_base(s).collect()}
    assert got == {"(unknown)": (2, 2), "email": (1, 1)}


def test_exact_rate_rounds_ties_half_up(spark):
    df = spark.createDataFrame([(Decimal("190937.61"), 8), (Decimal("1"), 0), (Decimal("-0.00015"), 1)],
                               "n decimal(38,9), d long")
    got = [r[0] for r in df.select(guarded_rate("n", "d")).collect()]
    assert got == [Decimal("23867.2013"), None, Decimal("-0.0002")]


def test_properties_on_driver_data(spark):
    """SURVEY §5: Σ session event_count = logged-in events; MTD on the last day
    of each month = that month's sum; reporting grains unique."""
    from cartwheel.plans.models import Models
    from conftest import SF_SMALL
    m = Models(spark, SF_SMALL)
    logged_in = m.stg_events.where("user_id IS NOT NULL").count()
    assert m.fct_sessions.agg(F.sum("event_count")).first()[0] == logged_in
    r = m.rpt_daily_revenue
    last = (r.groupBy("department_name", F.trunc("ordered_date", "month").alias("m"))
            .agg(F.max_by("net_revenue_mtd", "ordered_date").alias("mtd_end"),
                 F.sum("net_revenue").alias("month_sum")))
    assert last.where("mtd_end != month_sum").count() == 0
    assert r.groupBy("ordered_date", "department_name").count().where("count > 1").count() == 0


def test_two_level_counts_equal_plain_distinct_counts(spark):
    """Orders under several users or none, null sources and keys: the same numbers as plain distinct counts."""
    import random

    from cartwheel.operators.rollups import daily_revenue_base, session_rollup
    rng = random.Random(6)
    pick = rng.choice
    items = spark.createDataFrame(
        [(dt.date(2024, 1, 1 + i % 2), pick([1, 2, 3, None]), pick(["o1", "o2", "o3", "o4", None]), pick([7, 8, 9, None]), float(i), 1.0,
          pick(["returned", "complete", None])) for i in range(300)],
        "ordered_date date, product_id long, order_key string, user_id long, net_revenue double, net_gross_profit double, order_item_status string") \
        .withColumn("net_revenue", F.col("net_revenue").cast("decimal(18,9)")).withColumn("net_gross_profit", F.col("net_gross_profit").cast("decimal(18,9)"))
    products = spark.createDataFrame([(1, "A"), (2, "B"), (3, None)], "product_id long, department_name string")
    plain = (items.join(products, "product_id").where("department_name is not null").groupBy("ordered_date", "department_name")
             .agg(F.countDistinct("order_key"), F.count(F.lit(1)), F.countDistinct("user_id"), F.sum("net_revenue").cast("decimal(38,9)"),
                  F.sum("net_gross_profit").cast("decimal(38,9)"), F.count_if(F.col("order_item_status") == "returned")))
    assert rows(daily_revenue_base(items, products)) == rows(plain)
    events = spark.createDataFrame(
        [(f"k{i:03d}", pick(["s1", "s2", "s3"]), pick([1, None]), pick(["a", "b", None]), pick(["product", "cart", "home", None]),
          dt.datetime(2024, 1, 1, i % 24), pick(["x", None]), f"/{i}", pick(["c", None])) for i in range(200)],
        "event_key string, session_id string, user_id long, source_session_id string, event_type string, event_at timestamp, "
        "traffic_source string, uri string, browser string")
    first = lambda c: F.min_by(c, F.struct("event_at", "event_key"))
    is_ = lambda k: F.count_if(F.col("event_type") == k) > 0
    plain = events.groupBy("session_id", "user_id").agg(
        F.min("event_at"), F.max("event_at"), F.count(F.lit(1)), F.countDistinct("event_type"), is_("product"), is_("cart"), is_("purchase"),
        is_("cancel"), F.countDistinct("source_session_id"), first("traffic_source"), first("uri"), first("browser"))
    assert rows(session_rollup(events)) == rows(plain)
