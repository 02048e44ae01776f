"""Reporting marts: daily revenue, daily funnel, cohort retention."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.functions.exprs import guarded_rate, safe_ratio
from cartwheel.operators.rollups import (cohort_size, daily_funnel_base, daily_revenue_base,
                                         purchase_months, retention_base)
from cartwheel.operators.windows import cumulative, year_over_year_window

REVENUE_COLUMNS = ["ordered_date", "department_name", "order_count", "order_item_count",
                   "buyer_count", "returned_item_count", "net_revenue", "net_gross_profit",
                   "net_revenue_wtd", "net_revenue_mtd", "net_revenue_ytd",
                   "net_revenue_yoy_base", "net_revenue_yoy_rate"]


def rpt_daily_revenue(fct_order_items: DataFrame, dim_products: DataFrame, lines: DataFrame | None = None) -> DataFrame:
    """Date × department revenue with WTD/MTD/YTD running sums and YoY base/rate.

    The fact is aggregated once to the (small, calendar-bounded) daily grain.
    That grain is hash-partitioned by department once; the WTD/MTD/YTD windows
    (partitioned by department and period) and the year-ago lookup (RANGE
    frames per department) all reuse that partitioning, so the daily rows are
    shuffled a single time and the aggregate is evaluated once (``lines``, for plans that
    read no counts: see ``daily_revenue_base``).
    """
    products = dim_products.select("product_id", "department_name")
    # An explicit count keeps AQE from folding the (small) daily table into a
    # single task: departments' windows then run in parallel.
    n = int(fct_order_items.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    daily = daily_revenue_base(fct_order_items, products, lines).repartition(n, "department_name")
    cur = daily
    for grain in ("week", "month", "year"):
        cur = cumulative(cur, "net_revenue", "ordered_date", ["department_name"], grain,
                         name=f"net_revenue_{grain[0]}td")
    out = year_over_year_window(cur, ["department_name"], "ordered_date", "net_revenue",
                                "net_revenue_yoy_base")
    out = out.withColumn(
        "net_revenue_yoy_rate",
        guarded_rate(F.col("net_revenue") - F.col("net_revenue_yoy_base"),
                     F.col("net_revenue_yoy_base")).cast("decimal(18,4)"))
    return out.select(*REVENUE_COLUMNS)


def rpt_daily_funnel(fct_sessions: DataFrame) -> DataFrame:
    d = daily_funnel_base(fct_sessions)
    return d.select(
        "session_date", "entry_traffic_source", "session_count", "user_count",
        "product_view_sessions", "cart_sessions", "purchase_sessions", "bounce_sessions",
        "avg_session_seconds", "avg_events_per_session",
        safe_ratio("product_view_sessions", "session_count").alias("cvr_session_to_product"),
        safe_ratio("cart_sessions", "session_count").alias("cvr_session_to_cart"),
        safe_ratio("purchase_sessions", "session_count").alias("cvr_session_to_purchase"),
        safe_ratio("cart_sessions", "product_view_sessions").alias("cvr_product_to_cart"),
        safe_ratio("purchase_sessions", "cart_sessions").alias("cvr_cart_to_purchase"),
        safe_ratio("bounce_sessions", "session_count").alias("bounce_rate"),
    )


def rpt_user_cohort_retention(fct_orders: DataFrame, dim_users: DataFrame) -> DataFrame:
    users = dim_users.select("user_id", "signup_cohort_month")
    retention = retention_base(purchase_months(fct_orders, users))
    # One row per signup month: bounded by the calendar, so safe to broadcast.
    sizes = F.broadcast(cohort_size(users))
    return (retention.join(sizes, "signup_cohort_month", "inner")
            .select("signup_cohort_month", "activity_month", "months_since_signup",
                    "cohort_user_count", "retained_user_count",
                    safe_ratio("retained_user_count", "cohort_user_count").alias("retention_rate")))
