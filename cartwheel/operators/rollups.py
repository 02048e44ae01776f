"""Aggregations.

Every aggregate here is decomposable (count, sum, min, max, min_by, count_if)
or a distinct count, so Spark runs a partial aggregate before the shuffle and
a hot key is pre-reduced map-side. A single distinct count puts its column into
the first shuffle's key. Where two are asked for, rows are grouped with the one
value first and then counted, so that no row is copied (Spark's own plan is an
Expand that copies each input row once per distinct count).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from cartwheel.functions.exprs import (UNKNOWN_CHANNEL, month_start, months_between_starts, packed_key,
                                       recognized_or_zero, unpacked_key)
from cartwheel.operators.joins import join_near

# Aggregated money: the warehouse NUMERIC (38, 9).
MONEY_SUM = DecimalType(38, 9)


def first_by(value, *order) -> Column:
    """Value of the row that sorts first by ``order`` (ordered array_agg ... limit 1).

    A NULL value on the first row is returned as NULL; it is not skipped.
    """
    v = F.col(value) if isinstance(value, str) else value
    return F.min_by(v, F.struct(*[F.col(c) if isinstance(c, str) else c for c in order]))


def money_sum(c) -> Column:
    return F.sum(c).cast(MONEY_SUM)


def order_item_rollup(enriched: DataFrame, keys_packed: bool = False) -> DataFrame:
    """A1: per order key — counts, distinct products, gross/net sums, status counts.

    ``keys_packed``: the key is ``packed_key`` of the order key, as ``_order``.
    """
    key = packed_key("order_key").alias("_order") if keys_packed else F.col("order_key")
    return (enriched.where(F.col("order_key").isNotNull())
            .groupBy(key)
            .agg(F.count(F.lit(1)).alias("line_item_count"),
                 F.countDistinct("product_id").alias("distinct_product_count"),
                 money_sum("sale_price").alias("gross_revenue"),
                 money_sum(recognized_or_zero("is_revenue_recognized", "sale_price")).alias("net_revenue"),
                 money_sum(recognized_or_zero("is_revenue_recognized", "gross_profit")).alias("net_gross_profit"),
                 F.count_if(F.col("order_item_status") == "returned").alias("returned_item_count"),
                 F.count_if(F.col("order_item_status") == "cancelled").alias("cancelled_item_count")))


# Session flag of each kind of event.
FUNNEL_FLAGS = {"product": "viewed_product", "cart": "added_to_cart", "purchase": "purchased", "cancel": "cancelled"}


def session_rollup(sessionized: DataFrame, sources_as_set: bool = False) -> DataFrame:
    """A2/A3: per session — bounds, counts, entry touch (first by time, key), funnel flags.

    Rows are first grouped with the source session id, which makes its distinct
    count a plain one; event types are few and travel as sets.

    ``sources_as_set``: a session's source ids travel as a set too. Rows are then grouped
    once, and a reader that asks for no count of them moves none of them.
    """
    entry = F.struct("event_at", "event_key", F.struct("traffic_source", "uri", "browser").alias("touch"))
    seen = lambda kind: F.max(F.coalesce(F.col("event_type") == kind, F.lit(False)))
    if sources_as_set:
        grouped = (sessionized.groupBy("session_id", "user_id")
                   .agg(F.min("event_at").alias("session_started_at"), F.max("event_at").alias("session_ended_at"),
                        F.count(F.lit(1)).alias("event_count"),
                        F.size(F.collect_set("event_type")).cast("long").alias("distinct_event_type_count"),
                        F.min(entry)["touch"].alias("_entry"),
                        *[seen(kind).alias(name) for kind, name in FUNNEL_FLAGS.items()],
                        F.size(F.collect_set("source_session_id")).cast("long").alias("source_session_id_count")))
        return _entry_touch(grouped)
    by_source = (sessionized.groupBy("session_id", "user_id", "source_session_id")
                 .agg(F.min("event_at").alias("first_at"), F.max("event_at").alias("last_at"), F.count(F.lit(1)).alias("events"),
                      F.sort_array(F.collect_set("event_type")).alias("types"),
                      F.min_by(entry, F.struct("event_at", "event_key")).alias("entry"),
                      *[seen(kind).alias(kind) for kind in FUNNEL_FLAGS]))
    touch = F.min_by("entry", F.struct("entry.event_at", "entry.event_key"))["touch"]
    return _entry_touch(
        by_source.groupBy("session_id", "user_id")
        .agg(F.min("first_at").alias("session_started_at"),
             F.max("last_at").alias("session_ended_at"),
             F.sum("events").alias("event_count"),
             F.size(F.array_distinct(F.flatten(F.collect_set("types")))).cast("long").alias("distinct_event_type_count"),
             touch.alias("_entry"),
             *[F.max(kind).alias(name) for kind, name in FUNNEL_FLAGS.items()],
             F.count("source_session_id").alias("source_session_id_count")))


def _entry_touch(sessions: DataFrame) -> DataFrame:
    return (sessions.withColumns({"entry_traffic_source": F.col("_entry.traffic_source"),
                                  "entry_uri": F.col("_entry.uri"), "browser": F.col("_entry.browser")})
            .drop("_entry"))


def daily_revenue_base(items: DataFrame, products: DataFrame, lines: DataFrame | None = None) -> DataFrame:
    """A4 (+J5, F6): date × department — orders, items, buyers, net sums, returns.

    Items are grouped by order first, which carries the order's buyers (one, as a
    rule); its sums go with the first of them, so nothing counts twice. Order keys
    travel packed.

    ``lines``: rows that the items were made of, both dealt by order. Orders and buyers are
    then counted apart from the sums, which combine where the items lie. A reader that asks
    for sums alone moves no order and no buyer; one that asks for all has the items read twice.
    """
    grain = ["ordered_date", "department_name"]
    departments = products.select("product_id", "department_name")
    sold = (items.join(departments, "product_id", "inner") if lines is None
            else join_near(items, departments, "product_id", "order_id", "inner", lines)).where(F.col("department_name").isNotNull())
    if lines is not None:
        sums = (sold.groupBy(*grain)
                .agg(F.count(F.lit(1)).alias("order_item_count"), money_sum("net_revenue").alias("net_revenue"),
                     money_sum("net_gross_profit").alias("net_gross_profit"),
                     F.count_if(F.col("order_item_status") == "returned").alias("returned_item_count")))
        # One key that is never null, also where the date is: Spark drops a join that nobody reads from.
        counts = daily_revenue_base(items, products).groupBy(F.struct(*grain).alias("_grain")).agg(
            F.first("order_count").alias("order_count"), F.first("buyer_count").alias("buyer_count"))
        return (sums.withColumn("_grain", F.struct(*grain)).join(counts, "_grain", "left")
                .select(*grain, "order_count", "order_item_count", "buyer_count", "net_revenue", "net_gross_profit", "returned_item_count"))
    by_order = (sold
                .groupBy(*grain, packed_key("order_key").alias("order"))
                .agg(F.count(F.lit(1)).alias("items"), F.collect_set("user_id").alias("buyers"),
                     F.sum("net_revenue").alias("revenue"), F.sum("net_gross_profit").alias("profit"),
                     F.count_if(F.col("order_item_status") == "returned").alias("returned")))
    first = F.coalesce(F.col("at"), F.lit(0)) == 0
    by_buyer = (by_order.select(*grain, unpacked_key("order").alias("order_key"), "items", "revenue", "profit", "returned", F.posexplode_outer("buyers").alias("at", "user_id"))
                .groupBy(*grain, "user_id")
                .agg(F.count(F.when(first, F.col("order_key"))).alias("orders"),
                     *[F.sum(F.when(first, F.col(c))).alias(c) for c in ("items", "revenue", "profit", "returned")]))
    return (by_buyer.groupBy(*grain)
            .agg(F.sum("orders").alias("order_count"),
                 F.sum("items").alias("order_item_count"),
                 F.count("user_id").alias("buyer_count"),
                 money_sum("revenue").alias("net_revenue"),
                 money_sum("profit").alias("net_gross_profit"),
                 F.sum("returned").alias("returned_item_count")))


def daily_funnel_base(sessions: DataFrame) -> DataFrame:
    """A5 (+P18): date × entry channel. The channel is coalesced *before* grouping."""
    return (sessions.withColumn("entry_traffic_source",
                                F.coalesce("entry_traffic_source", F.lit(UNKNOWN_CHANNEL)))
            .groupBy("session_date", "entry_traffic_source")
            .agg(F.count(F.lit(1)).alias("session_count"),
                 F.countDistinct("user_id").alias("user_count"),
                 F.count_if("viewed_product").alias("product_view_sessions"),
                 F.count_if("added_to_cart").alias("cart_sessions"),
                 F.count_if("purchased").alias("purchase_sessions"),
                 F.count_if("is_bounce").alias("bounce_sessions"),
                 F.round(F.avg("session_duration_seconds"), 1).alias("avg_session_seconds"),
                 F.round(F.avg("event_count"), 2).alias("avg_events_per_session")))


def cohort_size(users: DataFrame) -> DataFrame:
    """Users per signup cohort month."""
    return users.groupBy("signup_cohort_month").agg(F.count(F.lit(1)).alias("cohort_user_count"))


def purchase_months(orders: DataFrame, users: DataFrame) -> DataFrame:
    """A7 (+J7, F7): distinct (user, cohort, activity month) with net revenue > 0.

    (user, month) pairs are de-duplicated before the join, so a heavy buyer
    crosses the join shuffle once per month, not once per order.
    """
    active = (orders.where(F.col("net_revenue") > 0)
              .select("user_id", month_start("ordered_date").alias("activity_month"))
              .distinct())
    return (active.join(users.select("user_id", "signup_cohort_month"), "user_id", "inner")
            .select("user_id", "signup_cohort_month", "activity_month")
            .distinct())


def retention_base(purchases: DataFrame) -> DataFrame:
    """A8 (+F8, P21): retained users per cohort × activity month, at or after signup."""
    return (purchases.where(F.col("activity_month") >= F.col("signup_cohort_month"))
            .groupBy("signup_cohort_month", "activity_month")
            .agg(F.countDistinct("user_id").alias("retained_user_count"))
            .withColumn("months_since_signup",
                        months_between_starts("activity_month", "signup_cohort_month")))


def daily_order_count(orders: DataFrame) -> DataFrame:
    """Orders per ordered date."""
    return orders.groupBy("ordered_date").agg(F.count(F.lit(1)).alias("order_count"))


def row_count(df: DataFrame, name: str = "row_count") -> DataFrame:
    """A10: one-row frame with the table's row count."""
    return df.agg(F.count(F.lit(1)).alias(name))


def keys_with_versions(history: DataFrame, key: str, min_versions: int = 2) -> DataFrame:
    """Keys with at least ``min_versions`` rows (GROUP BY key HAVING count >= n)."""
    return (history.groupBy(key).agg(F.count(F.lit(1)).alias("version_count"))
            .where(F.col("version_count") >= min_versions))


def duplicate_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Key combinations that occur more than once; NULL single keys ignored."""
    base = df.where(F.col(keys[0]).isNotNull()) if len(keys) == 1 else df
    return (base.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_records"))
            .where(F.col("n_records") > 1))


def max_loaded_at(df: DataFrame, col: str = "_ingested_at") -> DataFrame:
    """Latest load time of a table."""
    return df.agg(F.max(col).alias("max_loaded_at"))
