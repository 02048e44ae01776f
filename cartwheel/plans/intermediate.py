"""Intermediate models: enriched order items (one shared join) and sessionized events."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.functions.exprs import guarded_rate, is_revenue_recognized, money, packed_key, unpacked_key
from cartwheel.operators.joins import join_near
from cartwheel.operators.sessionize import sessionize
from cartwheel.params import Params


def int_order_items_enriched(stg_order_items: DataFrame, stg_orders: DataFrame,
                             stg_products: DataFrame, shared: bool = False) -> DataFrame:
    """Items + header key/status (generation-matched) + product attributes + margins.

    J1: header join on (order_id, load generation) — an order id reused by a
    later generation can never fan an item out; an item whose header is from
    another generation gets a NULL order key (trap T4). The generation is compared
    inside the join, not dealt by, so items that are already dealt by order_id stay.
    J2: products is a dimension. Both joins are left to Spark's size-checked
    broadcast (estimate vs autoBroadcastJoinThreshold, re-checked by AQE on the
    measured size); beyond it they are sort-merge joins whose skewed partitions
    AQE splits. Surrogate keys travel packed.

    ``shared``: several models read the frame in one plan, most of them by order. The
    lines then stay dealt by order, and products come to them. ``_is_line`` marks one row
    of each line, so that the lines can be read from the frame as well.
    """
    generation = F.col("_load_generation")
    orders = stg_orders.select(packed_key("order_key").alias("_order"), "order_id", "order_status",
                               F.col("item_count").alias("order_item_count"), generation.alias("_header_generation"))
    products = stg_products.select(
        "product_id", "product_name", "brand_name", "category_name", "department_name",
        "unit_cost", "retail_price", "distribution_center_id")
    if shared:
        repeat = F.row_number().over(Window.partitionBy("order_id", "_header_generation").orderBy("order_id"))
        orders = orders.withColumn("_header", repeat)
    items = stg_order_items.withColumn("_item", packed_key("order_item_key")).drop("order_item_key")
    same = (F.col("i.order_id") == F.col("o.order_id")) & generation.between(F.col("_header_generation"), F.col("_header_generation"))
    with_header = (items.alias("i")
                   .join(orders.alias("o"), same, "left")
                   .select("i.*", "_order", "order_status", "order_item_count", *(["_header"] if shared else [])))
    if shared:
        joined = join_near(with_header, products, "product_id", "order_id", pairs=stg_order_items, copy="_copy")
    else:
        joined = with_header.join(products, "product_id", "left")
    return joined.select(
        unpacked_key("_item").alias("order_item_key"),
        unpacked_key("_order").alias("order_key"),
        "order_item_id",
        "order_id",
        "user_id",
        "product_id",
        "inventory_item_id",
        "order_item_status",
        "order_status",
        "order_item_count",
        "product_name",
        "brand_name",
        "category_name",
        "department_name",
        "distribution_center_id",
        "sale_price",
        "unit_cost",
        "retail_price",
        money(F.col("sale_price") - F.col("unit_cost")).alias("gross_profit"),
        guarded_rate(F.col("retail_price") - F.col("sale_price"), F.col("retail_price"))
        .cast("decimal(18,4)").alias("discount_rate"),
        is_revenue_recognized("order_item_status").alias("is_revenue_recognized"),
        "ordered_at",
        "ordered_date",
        "_load_generation",
        "shipped_at",
        "delivered_at",
        "returned_at",
        *([((F.coalesce("_header", F.lit(1)) == 1) & (F.col("_copy") == 0)).alias("_is_line")] if shared else []),
    )


def int_events_sessionized(stg_events: DataFrame, params: Params | None = None,
                           incremental: bool = False, shared: bool = False) -> DataFrame:
    return sessionize(stg_events, params, incremental=incremental, shared=shared)
