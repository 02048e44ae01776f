"""The model graph: raw → staging → intermediate → core → reporting.

``Models`` wires builders together lazily; each attribute is a DataFrame
(logical plan), built once per instance. Nothing is computed until an action
or a write. Inputs are either the driver tables (through the adapter) or any
mapping of source name → DataFrame (e.g. landed tables). ``shared`` is for a plan that
reads many of the models at once: what they read in common is then moved once for all.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from cartwheel.params import Params
from cartwheel.plans import core, intermediate, reporting, staging
from cartwheel.sources.adapter import raw_source


class Models:
    def __init__(self, spark: SparkSession, sf_dir: str | None = None,
                 raw: dict[str, DataFrame] | None = None, params: Params | None = None,
                 history: DataFrame | None = None, shared: bool = False):
        if sf_dir is None and raw is None:
            raise ValueError("give sf_dir or raw frames")
        self.spark = spark
        self.sf_dir = sf_dir
        self._raw = dict(raw or {})
        self.params = params or Params()
        self._history = history
        self.shared = shared

    # -- sources -------------------------------------------------------------
    def raw(self, name: str) -> DataFrame:
        if name not in self._raw:
            self._raw[name] = raw_source(self.spark, self.sf_dir, name, self.shared)
        return self._raw[name]

    def stg(self, name: str) -> DataFrame:
        return staging.BUILDERS[name](self.raw(name))

    @cached_property
    def stg_orders(self): return self.stg("orders")

    @cached_property
    def stg_order_items(self): return self.stg("order_items")

    @cached_property
    def stg_products(self): return self.stg("products")

    @cached_property
    def stg_users(self): return self.stg("users")

    @cached_property
    def stg_events(self): return self.stg("events")

    @cached_property
    def stg_inventory_items(self): return self.stg("inventory_items")

    @cached_property
    def stg_distribution_centers(self): return self.stg("distribution_centers")

    # -- intermediate --------------------------------------------------------
    @cached_property
    def int_order_items_enriched(self):
        return intermediate.int_order_items_enriched(self.stg_order_items, self.stg_orders,
                                                     self.stg_products, self.shared)

    @cached_property
    def int_events_sessionized(self):
        return intermediate.int_events_sessionized(self.stg_events, self.params, shared=self.shared)

    # -- core ----------------------------------------------------------------
    @cached_property
    def dim_distribution_centers(self):
        return core.dim_distribution_centers(self.stg_distribution_centers)

    @cached_property
    def dim_products(self):
        return core.dim_products(self.stg_products, self.stg_distribution_centers)

    @cached_property
    def dim_users(self):
        return core.dim_users(self.stg_users)

    @cached_property
    def fct_order_items(self):
        return core.fct_order_items(self.int_order_items_enriched)

    @cached_property
    def fct_orders(self):
        return core.fct_orders(self.stg_orders, self.int_order_items_enriched, self.shared)

    @cached_property
    def fct_sessions(self):
        return core.fct_sessions(self.int_events_sessionized, self.shared)

    @cached_property
    def fct_user_events(self):
        return core.fct_user_events(self.int_events_sessionized)

    @cached_property
    def dim_products_history(self):
        from cartwheel.operators.history import dim_products_history
        if self._history is None:
            raise ValueError("no product history given")
        return dim_products_history(self._history)

    # -- reporting -----------------------------------------------------------
    @cached_property
    def rpt_daily_revenue(self):
        return reporting.rpt_daily_revenue(self.fct_order_items, self.dim_products, self.stg_order_items if self.shared else None)

    @cached_property
    def rpt_daily_funnel(self):
        return reporting.rpt_daily_funnel(self.fct_sessions)

    @cached_property
    def rpt_user_cohort_retention(self):
        return reporting.rpt_user_cohort_retention(self.fct_orders, self.dim_users)
