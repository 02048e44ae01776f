"""The declared data checks, per model, as data (103 entries).

Fixed values: model, column, check kind and arguments, in declaration order.
"""

from __future__ import annotations

from cartwheel.operators.checks import CheckSpec as C
from cartwheel.operators.checks import RowsIn

STATUSES = ("cancelled", "complete", "processing", "returned", "shipped")
DEPARTMENTS = ("Men", "Women")
GENDERS = ("f", "m")
USER_CHANNELS = ("display", "email", "facebook", "organic", "search")
EVENT_TYPES = ("cancel", "cart", "department", "home", "product", "purchase")
EVENT_CHANNELS = ("adwords", "email", "facebook", "organic", "youtube")
AGE_GROUPS = ("10s", "20s", "30s", "40s", "50s", "60s+")

DECLARED_CHECKS: tuple[C, ...] = (
    # staging
    C("stg_orders", "order_key", "unique"),
    C("stg_orders", "order_key", "not_null"),
    C("stg_orders", "order_id", "not_null"),
    C("stg_orders", "user_id", "not_null"),
    C("stg_orders", "order_status", "accepted_values", STATUSES),
    C("stg_orders", "ordered_at", "not_null"),
    C("stg_orders", "item_count", "expression", ("> 0",)),
    C("stg_order_items", "order_item_key", "unique"),
    C("stg_order_items", "order_item_key", "not_null"),
    C("stg_order_items", "order_item_id", "not_null"),
    C("stg_order_items", "order_id", "not_null"),
    C("stg_order_items", "product_id", "not_null"),
    C("stg_order_items", "product_id", "relationships", ("stg_products", "product_id")),
    C("stg_order_items", "order_item_status", "accepted_values", STATUSES),
    C("stg_order_items", "sale_price", "not_null"),
    C("stg_order_items", "sale_price", "expression", (">= 0",)),
    C("stg_products", "product_id", "unique"),
    C("stg_products", "product_id", "not_null"),
    C("stg_products", "retail_price", "not_null"),
    C("stg_products", "retail_price", "expression", (">= 0",)),
    C("stg_products", "unit_cost", "not_null"),
    C("stg_products", "unit_cost", "expression", (">= 0",)),
    C("stg_products", "department_name", "accepted_values", DEPARTMENTS),
    C("stg_products", "distribution_center_id", "relationships",
      ("stg_distribution_centers", "distribution_center_id")),
    C("stg_users", "user_id", "unique"),
    C("stg_users", "user_id", "not_null"),
    C("stg_users", "gender", "accepted_values", GENDERS),
    C("stg_users", "acquisition_channel", "accepted_values", USER_CHANNELS),
    C("stg_users", "signed_up_at", "not_null"),
    C("stg_events", "event_key", "unique"),
    C("stg_events", "event_key", "not_null"),
    C("stg_events", "event_id", "not_null"),
    C("stg_events", "user_id", "relationships", ("stg_users", "user_id")),
    C("stg_events", "event_type", "not_null"),
    C("stg_events", "event_type", "accepted_values", EVENT_TYPES),
    C("stg_events", "traffic_source", "accepted_values", EVENT_CHANNELS),
    C("stg_events", "event_at", "not_null"),
    C("stg_inventory_items", "inventory_item_id", "unique"),
    C("stg_inventory_items", "inventory_item_id", "not_null"),
    C("stg_inventory_items", "product_id", "not_null"),
    C("stg_inventory_items", "product_id", "relationships", ("stg_products", "product_id")),
    C("stg_distribution_centers", "distribution_center_id", "unique"),
    C("stg_distribution_centers", "distribution_center_id", "not_null"),
    C("stg_distribution_centers", "distribution_center_name", "not_null"),
    # intermediate
    C("int_order_items_enriched", "order_item_key", "unique"),
    C("int_order_items_enriched", "order_item_key", "not_null"),
    C("int_order_items_enriched", "order_item_id", "not_null"),
    C("int_order_items_enriched", "is_revenue_recognized", "not_null"),
    C("int_events_sessionized", "event_key", "unique"),
    C("int_events_sessionized", "event_key", "not_null"),
    C("int_events_sessionized", "event_id", "not_null"),
    C("int_events_sessionized", "session_id", "not_null"),
    C("int_events_sessionized", "session_started_at", "not_null"),
    C("int_events_sessionized", "user_id", "not_null"),
    # core
    C("dim_users", "user_id", "unique"),
    C("dim_users", "age_group", "accepted_values", AGE_GROUPS),
    C("dim_products", "product_id", "unique"),
    C("dim_products", "product_id", "not_null"),
    C("dim_products", "retail_price", "not_null"),
    C("dim_products", "distribution_center_id", "relationships",
      ("dim_distribution_centers", "distribution_center_id")),
    C("dim_products_history", "product_history_key", "unique"),
    C("dim_products_history", "product_history_key", "not_null"),
    C("dim_products_history", "product_id", "not_null"),
    C("dim_products_history", "valid_from", "not_null"),
    C("dim_products_history", "is_current", "not_null"),
    C("dim_distribution_centers", "distribution_center_id", "unique"),
    C("dim_distribution_centers", "distribution_center_id", "not_null"),
    C("fct_orders", "order_key", "unique"),
    C("fct_orders", "order_key", "not_null"),
    C("fct_orders", "order_id", "not_null"),
    C("fct_orders", "user_id", "not_null"),
    C("fct_orders", "user_id", "relationships", ("dim_users", "user_id")),
    C("fct_orders", "net_revenue", "expression", (">= 0",)),
    C("fct_order_items", "order_item_key", "unique"),
    C("fct_order_items", "order_key", "relationships", ("fct_orders", "order_key")),
    C("fct_order_items", "user_id", "relationships", ("dim_users", "user_id")),
    C("fct_order_items", "product_id", "relationships", ("dim_products", "product_id")),
    C("fct_order_items", "order_item_status", "accepted_values", STATUSES),
    C("fct_user_events", "event_key", "unique"),
    C("fct_user_events", "event_key", "not_null"),
    C("fct_user_events", "event_id", "not_null"),
    C("fct_user_events", "session_id", "not_null"),
    C("fct_user_events", "event_type", "not_null"),
    C("fct_user_events", "event_type", "accepted_values", EVENT_TYPES),
    C("fct_user_events", "user_id", "not_null"),
    C("fct_user_events", "user_id", "relationships", ("dim_users", "user_id")),
    C("fct_sessions", "session_id", "unique"),
    C("fct_sessions", "session_id", "not_null"),
    C("fct_sessions", "user_id", "not_null"),
    C("fct_sessions", "user_id", "relationships", ("dim_users", "user_id")),
    C("fct_sessions", "session_duration_seconds", "expression", (">= 0",)),
    C("fct_sessions", "event_count", "expression", ("> 0",)),
    # reporting
    C("rpt_daily_revenue", "ordered_date", "not_null"),
    C("rpt_daily_revenue", "department_name", "not_null"),
    C("rpt_daily_revenue", "net_revenue", "not_null"),
    C("rpt_daily_revenue", "net_revenue", "expression", (">= 0",)),
    C("rpt_daily_revenue", None, "unique_combination", ("ordered_date", "department_name")),
    C("rpt_user_cohort_retention", "retention_rate", "expression", ("between 0 and 1",)),
    C("rpt_user_cohort_retention", "months_since_signup", "expression", (">= 0",)),
    C("rpt_user_cohort_retention", None, "unique_combination", ("signup_cohort_month", "activity_month")),
    C("rpt_daily_funnel", "session_count", "expression", ("> 0",)),
    C("rpt_daily_funnel", "cvr_session_to_purchase", "expression", ("between 0 and 1",)),
    C("rpt_daily_funnel", None, "unique_combination", ("session_date", "entry_traffic_source")),
)

assert len(DECLARED_CHECKS) == 103

# The order item fact selects from the enriched items row by row, and the order fact adds measures to the
# staged orders row by row (one rollup row an order key); their checked columns keep their values.
ROWS_IN = {"int_order_items_enriched": RowsIn("fct_order_items"),
           "stg_orders": RowsIn("fct_orders", {"item_count": "source_item_count"})}
# In shared models the enriched items mark one row of each staged line, and keep its checked columns too.
SHARED_ROWS_IN = {**ROWS_IN, "stg_order_items": RowsIn("fct_order_items", where="_is_line")}
