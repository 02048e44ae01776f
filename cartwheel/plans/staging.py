"""Staging models: rename to business names, re-key, normalise case, fix types.

Each builder selects an explicit column list from its source, so a source
that loses a column fails at analysis time (schema drift is caught early) and
Parquet reads only the columns a model needs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.functions.exprs import epoch_seconds, money, surrogate_key


def stg_orders(raw: DataFrame) -> DataFrame:
    return raw.select(
        surrogate_key("order_id", "user_id", epoch_seconds("created_at")).alias("order_key"),
        "order_id",
        "user_id",
        F.lower("status").alias("order_status"),
        F.lower("gender").alias("user_gender_at_order"),
        F.col("num_of_item").alias("item_count"),
        F.col("created_at").alias("ordered_at"),
        "shipped_at",
        "delivered_at",
        "returned_at",
        F.to_date("created_at").alias("ordered_date"),
        F.to_date("_ingested_at").alias("_load_generation"),
        "_ingested_at",
    )


def stg_order_items(raw: DataFrame) -> DataFrame:
    return raw.select(
        surrogate_key("id", "order_id", epoch_seconds("created_at")).alias("order_item_key"),
        F.col("id").alias("order_item_id"),
        "order_id",
        "user_id",
        "product_id",
        "inventory_item_id",
        F.lower("status").alias("order_item_status"),
        money("sale_price").alias("sale_price"),
        F.col("created_at").alias("ordered_at"),
        "shipped_at",
        "delivered_at",
        "returned_at",
        F.to_date("created_at").alias("ordered_date"),
        F.to_date("_ingested_at").alias("_load_generation"),
        "_ingested_at",
    )


def stg_products(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("id").alias("product_id"),
        F.col("name").alias("product_name"),
        F.col("brand").alias("brand_name"),
        F.col("category").alias("category_name"),
        F.col("department").alias("department_name"),
        "sku",
        money("cost").alias("unit_cost"),
        money("retail_price").alias("retail_price"),
        "distribution_center_id",
        "_ingested_at",
    )


def stg_users(raw: DataFrame) -> DataFrame:
    # Street address and geometry are never read (PII cut at the source).
    return raw.select(
        F.col("id").alias("user_id"),
        "first_name",
        "last_name",
        "email",
        "age",
        F.lower("gender").alias("gender"),
        "city",
        "state",
        "postal_code",
        "country",
        F.lower("traffic_source").alias("acquisition_channel"),
        F.col("created_at").alias("signed_up_at"),
        F.to_date("created_at").alias("signed_up_date"),
        "_ingested_at",
    )


def stg_events(raw: DataFrame) -> DataFrame:
    return raw.select(
        surrogate_key("id", "session_id", epoch_seconds("created_at")).alias("event_key"),
        F.col("id").alias("event_id"),
        "user_id",
        F.col("session_id").alias("source_session_id"),
        "sequence_number",
        F.lower("event_type").alias("event_type"),
        F.lower("traffic_source").alias("traffic_source"),
        "browser",
        "uri",
        "city",
        "state",
        "postal_code",
        "ip_address",
        F.col("created_at").alias("event_at"),
        F.to_date("created_at").alias("event_date"),
        F.to_date("_ingested_at").alias("_load_generation"),
        "_ingested_at",
    )


def stg_inventory_items(raw: DataFrame) -> DataFrame:
    # Denormalised product attributes of the source are not carried.
    return raw.select(
        F.col("id").alias("inventory_item_id"),
        "product_id",
        money("cost").alias("unit_cost"),
        F.col("created_at").alias("stocked_at"),
        "sold_at",
        F.to_date("created_at").alias("stocked_date"),
        F.col("product_distribution_center_id").alias("distribution_center_id"),
        "_ingested_at",
    )


def stg_distribution_centers(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("id").alias("distribution_center_id"),
        F.col("name").alias("distribution_center_name"),
        "latitude",
        "longitude",
        "_ingested_at",
    )


BUILDERS = {
    "orders": stg_orders,
    "order_items": stg_order_items,
    "products": stg_products,
    "users": stg_users,
    "events": stg_events,
    "inventory_items": stg_inventory_items,
    "distribution_centers": stg_distribution_centers,
}
