"""Schema contracts of the two contracted marts (Q12) and their NOT NULL
columns (Q13). Fixed values: column names, types and constraints."""

from __future__ import annotations

from pyspark.sql.types import (BooleanType, DateType, DecimalType, LongType, StringType,
                               StructField, StructType, TimestampType)

_T = {"int64": LongType(), "string": StringType(), "timestamp": TimestampType(), "date": DateType(),
      "bool": BooleanType(), "money": DecimalType(18, 9), "rate": DecimalType(18, 4)}


def _schema(cols: list[tuple[str, str]]) -> StructType:
    return StructType([StructField(n, _T[t]) for n, t in cols])


DIM_USERS = _schema([
    ("user_id", "int64"), ("email_hash", "string"), ("email_domain", "string"), ("age", "int64"),
    ("age_group", "string"), ("gender", "string"), ("city", "string"), ("state", "string"),
    ("country", "string"), ("postal_code", "string"), ("acquisition_channel", "string"),
    ("signed_up_at", "timestamp"), ("signed_up_date", "date"), ("signup_cohort_month", "date"),
])
DIM_USERS_NOT_NULL = ("user_id",)

FCT_ORDER_ITEMS = _schema([
    ("order_item_key", "string"), ("order_key", "string"), ("order_item_id", "int64"),
    ("order_id", "int64"), ("user_id", "int64"), ("product_id", "int64"),
    ("distribution_center_id", "int64"), ("order_item_status", "string"), ("order_status", "string"),
    ("sale_price", "money"), ("unit_cost", "money"), ("gross_profit", "money"),
    ("discount_rate", "rate"), ("is_revenue_recognized", "bool"), ("net_revenue", "money"),
    ("net_gross_profit", "money"), ("ordered_at", "timestamp"), ("ordered_date", "date"),
    ("shipped_at", "timestamp"), ("delivered_at", "timestamp"), ("returned_at", "timestamp"),
    ("days_to_ship", "int64"), ("days_to_deliver", "int64"),
])
FCT_ORDER_ITEMS_NOT_NULL = ("order_item_key", "order_item_id", "order_id", "sale_price",
                            "is_revenue_recognized", "ordered_at", "ordered_date")

CONTRACTS = {
    "dim_users": (DIM_USERS, DIM_USERS_NOT_NULL),
    "fct_order_items": (FCT_ORDER_ITEMS, FCT_ORDER_ITEMS_NOT_NULL),
}
