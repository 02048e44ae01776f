"""The daily run (§3.1) as plain calls: load → freshness → snapshot → build
staging, intermediate, core, reporting, each layer followed by its checks.

Layout under ``root``:
  raw/<source>            landed sources (load strategies)
  snapshots/products      type-2 product history
  <layer>/<model>         materialized models (staging and the enriched items
                          stay views, as in the reference)
  audit/check=…/run_date=…  stored failing rows of 'warn' checks
Every write is idempotent: rerunning a date gives the same tables.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from cartwheel.operators import checks as Q
from cartwheel.operators.history import (PRODUCT_CHECK_COLS, PRODUCT_SNAPSHOT_COLS, dim_products_history,
                                         read_history, snapshot_run)
from cartwheel.operators.writers import read_table, store_failures, table_exists, write_incremental, write_table
from cartwheel.params import Params
from cartwheel.plans import core, intermediate, reporting, staging
from cartwheel.plans.contracts import CONTRACTS
from cartwheel.plans.declared_checks import DECLARED_CHECKS
from cartwheel.sources.loads import landed_days, read_landed, run_loads
from cartwheel.sources.registry import LANDINGS

# Physical layout per materialized model: (partition column, cluster columns).
LAYOUT = {
    "int_events_sessionized": ("event_date", ("user_id",)),
    "dim_distribution_centers": (None, ()),
    "dim_products": (None, ("product_id",)),
    "dim_products_history": (None, ("product_id",)),
    "dim_users": (None, ("user_id",)),
    "fct_order_items": ("ordered_date", ("product_id", "user_id")),
    "fct_orders": ("ordered_date", ("user_id",)),
    "fct_sessions": ("session_date", ("user_id",)),
    "fct_user_events": ("event_date", ("user_id", "event_type")),
    "rpt_daily_revenue": ("ordered_date", ()),
    "rpt_daily_funnel": ("session_date", ()),
    "rpt_user_cohort_retention": (None, ()),
}
INCREMENTAL = {"int_events_sessionized", "fct_user_events"}


@dataclass
class RunReport:
    loads: dict = field(default_factory=dict)
    freshness: list = field(default_factory=list)
    built: dict = field(default_factory=dict)
    checks: list = field(default_factory=list)


class DailyRun:
    def __init__(self, spark: SparkSession, root: str, params: Params, now: dt.datetime,
                 gate: bool = True, full_refresh: bool = False):
        self.spark, self.root, self.params, self.now, self.gate = spark, root.rstrip("/"), params, now, gate
        self.full_refresh = full_refresh
        self.report = RunReport()
        self.frames: dict[str, DataFrame] = {}

    # ------------------------------------------------------------------ steps
    def load(self, sources: dict[str, DataFrame], window: tuple | None = None) -> None:
        """Daily: the lookback window. First/ad-hoc load: an explicit window (Entry C)."""
        start, end = window or (None, None)
        self.report.loads = run_loads(self.spark, sources, f"{self.root}/raw",
                                      run_date=self.params.run_date, start=start, end=end,
                                      lookback=self.params.lookback_days, ingested_at=self.now)

    def raw(self, name: str) -> DataFrame:
        """Landed table, read once per run: the frame keeps its file index, so
        the (possibly thousands of) day directories are listed once."""
        key = f"raw:{name}"
        if key not in self.frames:
            self.frames[key] = read_landed(self.spark, f"{self.root}/raw", name)
        return self.frames[key]

    def freshness(self) -> None:
        """Observation only: recorded, never blocks the build (Q17)."""
        fr = Q.source_freshness({name: self.raw(name) for name in LANDINGS}, self.now)
        self.report.freshness = [r.asDict() for r in fr.collect()]  # one row per source

    def snapshot(self) -> None:
        """Type-2 product history, read from the landed products (before staging)."""
        snapshot_run(self.spark, f"{self.root}/snapshots/products", self.raw("products").select(*PRODUCT_SNAPSHOT_COLS),
                     "id", self.now, check_cols=PRODUCT_CHECK_COLS)

    def _materialize(self, name: str, df: DataFrame) -> DataFrame:
        if name in CONTRACTS:
            schema, not_null = CONTRACTS[name]
            df = Q.enforce_contract(df, schema, not_null)
        part, cluster = LAYOUT[name]
        path = f"{self.root}/{name}"
        if name in INCREMENTAL and part and not self.full_refresh:
            mode = write_incremental(self.spark, df, path, part, cluster)
        else:
            write_table(df, path, part, cluster)
            mode = "full"
        self.report.built[name] = mode
        return read_table(self.spark, path)

    def _check(self, models: list[str], singular: dict | None = None) -> None:
        specs = [s for s in DECLARED_CHECKS if s.model in models]
        results = []
        if specs:
            counts = Q.declared_check_counts(specs, lambda n: self.frames[n])
            results += [Q.CheckResult(r["check_name"], r["severity"], r["failures"])
                        for r in counts.collect()]  # one row per check
        for name, (severity, build) in (singular or {}).items():
            failing = build()
            n = (store_failures(failing, f"{self.root}/audit", name, self.params.run_date) if severity == "warn"
                 else failing.count())
            results.append(Q.CheckResult(name, severity, n))
        self.report.checks += results
        errors = [r for r in results if r.severity == "error" and r.failures]
        if errors and self.gate:
            raise Q.CheckFailed("; ".join(f"{r.name}: {r.failures}" for r in errors))

    # ------------------------------------------------------------------ layers
    def build_staging(self) -> None:
        for src, builder in staging.BUILDERS.items():
            self.frames[f"stg_{src}"] = builder(self.raw(src))
        self._check([f"stg_{src}" for src in staging.BUILDERS])

    def build_intermediate(self) -> None:
        f = self.frames
        # Consumed by its checks, fct_order_items and fct_orders: computed once
        # and kept (memory, spilling to disk; lost blocks are recomputed from
        # lineage) until the core layer is written.
        f["int_order_items_enriched"] = intermediate.int_order_items_enriched(
            f["stg_order_items"], f["stg_orders"], f["stg_products"]).persist(StorageLevel.MEMORY_AND_DISK)
        incremental = not self.full_refresh and table_exists(self.spark, f"{self.root}/int_events_sessionized")
        events = self.raw("events")
        if incremental:  # only the window's day folders and the read buffer are opened
            events = landed_days(events, *self.params.window(self.params.session_buffer_days))
        f["int_events_sessionized"] = self._materialize(
            "int_events_sessionized",
            intermediate.int_events_sessionized(staging.stg_events(events), self.params, incremental=incremental))
        self._check(["int_order_items_enriched", "int_events_sessionized"])

    def build_core(self) -> None:
        f = self.frames
        hist = read_history(self.spark, f"{self.root}/snapshots/products")
        built = {
            "dim_distribution_centers": core.dim_distribution_centers(f["stg_distribution_centers"]),
            "dim_products": core.dim_products(f["stg_products"], f["stg_distribution_centers"]),
            "dim_products_history": dim_products_history(hist),
            "dim_users": core.dim_users(f["stg_users"]),
            "fct_order_items": core.fct_order_items(f["int_order_items_enriched"]),
            "fct_orders": core.fct_orders(f["stg_orders"], f["int_order_items_enriched"]),
            "fct_sessions": core.fct_sessions(f["int_events_sessionized"]),
        }
        for name, df in built.items():
            f[name] = self._materialize(name, df)
        incremental = not self.full_refresh and table_exists(self.spark, f"{self.root}/fct_user_events")
        f["fct_user_events"] = self._materialize(
            "fct_user_events",
            core.fct_user_events(f["int_events_sessionized"], self.params, incremental=incremental))
        self._check(list(built) + ["fct_user_events"], {
            "assert_order_item_count_matches": ("warn", lambda: Q.check_order_item_count(f["fct_orders"])),
            "assert_no_order_before_signup": ("error", lambda: Q.check_no_order_before_signup(
                f["fct_orders"], f["dim_users"])),
            "assert_fact_not_silently_truncated": ("error", lambda: Q.check_fact_not_truncated(
                f["stg_orders"], f["fct_orders"])),
        })

    def build_reporting(self) -> None:
        f = self.frames
        built = {
            "rpt_daily_revenue": reporting.rpt_daily_revenue(f["fct_order_items"], f["dim_products"]),
            "rpt_daily_funnel": reporting.rpt_daily_funnel(f["fct_sessions"]),
            "rpt_user_cohort_retention": reporting.rpt_user_cohort_retention(f["fct_orders"], f["dim_users"]),
        }
        for name, df in built.items():
            f[name] = self._materialize(name, df)
        self._check(list(built), {
            "assert_daily_order_volume_not_anomalous": (
                "warn", lambda: Q.check_daily_order_volume(f["fct_orders"], self.params)),
        })


    def release(self) -> None:
        enriched = self.frames.get("int_order_items_enriched")
        if enriched is not None:
            enriched.unpersist()


def run_daily(spark: SparkSession, sources: dict[str, DataFrame], root: str, params: Params,
              now: dt.datetime, gate: bool = True, load_window: tuple | None = None,
              full_refresh: bool = False) -> RunReport:
    """One daily run. With ``gate`` an error-severity check failure stops the
    run before the next layer (raises ``CheckFailed``); without it failures
    are only recorded in the report. ``full_refresh`` rebuilds the incremental
    models from all landed events (needed when the session timeout changes)."""
    run = DailyRun(spark, root, params, now, gate, full_refresh)
    run.load(sources, load_window)
    run.freshness()
    run.snapshot()
    try:
        run.build_staging()
        run.build_intermediate()
        run.build_core()
    finally:
        run.release()
    run.build_reporting()
    return run.report
