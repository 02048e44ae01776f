"""Query registry: name → (Spark builder, DuckDB oracle SQL or None).

Every Spark builder takes (spark, sf_dir) and returns a lazy DataFrame over the
whole driver tables (through the source adapter). Oracle SQL runs on DuckDB
with the driver tables registered as views of the same names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cartwheel.plans import oracle as O
from cartwheel.plans.models import Models

Builder = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Builder] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle_sql: str | None = None):
    def deco(fn: Builder) -> Builder:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle_sql is not None:
            ORACLES[name] = oracle_sql
        return fn
    return deco


def _model_query(attr: str, oracle_name: str | None = None):
    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        return getattr(Models(spark, sf_dir), attr)
    register(attr, O.model(oracle_name or attr))(build)


# Models 1–20, except the history dimension (see history queries).
for _name in ("stg_orders", "stg_order_items", "stg_products", "stg_users", "stg_events",
              "stg_inventory_items", "stg_distribution_centers",
              "int_order_items_enriched", "int_events_sessionized",
              "dim_distribution_centers", "dim_products", "dim_users",
              "fct_order_items", "fct_orders", "fct_sessions", "fct_user_events",
              "rpt_daily_revenue", "rpt_daily_funnel", "rpt_user_cohort_retention"):
    _model_query(_name)


def load_all() -> None:
    """Import the modules that register the non-model queries."""
    from cartwheel.plans import queries_ops  # noqa: F401


def queries() -> dict[str, Builder]:
    load_all()
    return dict(QUERIES)


def oracles() -> dict[str, str]:
    load_all()
    return dict(ORACLES)
