"""Standalone operator queries (aggregations, windows, joins, checks, history,
load deltas, documented patterns), each over the whole driver tables, with
its DuckDB oracle where SQL can express it."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.functions.exprs import guarded_rate
from cartwheel.operators import checks as Q
from cartwheel.operators import history as H
from cartwheel.operators import patterns as X
from cartwheel.operators import rollups as A
from cartwheel.operators import windows as W
from cartwheel.operators.joins import asof_join
from cartwheel.operators.sessionize import sessionize
from cartwheel.operators.writers import read_table, store_failures, sync_columns, write_incremental, write_table
from cartwheel.params import Params
from cartwheel.plans import oracle as O
from cartwheel.plans.contracts import CONTRACTS
from cartwheel.plans.declared_checks import DECLARED_CHECKS, SHARED_ROWS_IN
from cartwheel.plans.models import Models
from cartwheel.plans.registry import register
from cartwheel.sources.adapter import raw_source
from cartwheel.session import checkpoint_dir
from cartwheel.sources.loads import insert_only_delta, load_full_replace, load_window_overwrite

# Fixed run parameters of the registered queries.
ORDERS_RUN_DATE = dt.date(2001, 8, 2)          # day after the last order day
EVENTS_RUN_DATE = dt.date(2024, 1, 17)         # inside the 30 days of events
SNAPSHOT_TS1 = "1995-01-01 00:00:00"           # first product snapshot
SNAPSHOT_TS2 = "1998-01-01 00:00:00"           # snapshot after the price change
FRESHNESS_NOW = dt.datetime(2026, 8, 18, 12, 0, 0)
RECENCY_NOW = dt.datetime(2024, 2, 1, 0, 0, 0)
STATE_WINDOW = ("1997-12-25", "1998-01-05")
OVERLAP_WATERMARK = "2024-01-28 00:00:00"
OVERLAP_DAYS = 3


def _m(spark: SparkSession, sf_dir: str, **kw) -> Models:
    return Models(spark, sf_dir, **kw)


# ====================================================================== aggregations
register("order_item_rollup", O.model("order_item_rollup"))(
    lambda spark, sf: A.order_item_rollup(_m(spark, sf).int_order_items_enriched))


@register("session_entry_touch", O.oracle("""
SELECT session_id, user_id,
       first(traffic_source ORDER BY event_at, event_key) AS entry_traffic_source,
       first(uri ORDER BY event_at, event_key) AS entry_uri,
       first(browser ORDER BY event_at, event_key) AS browser
FROM int_events_sessionized GROUP BY session_id, user_id""", "int_events_sessionized"))
def session_entry_touch(spark, sf):
    order = ("event_at", "event_key")
    return (_m(spark, sf).int_events_sessionized.groupBy("session_id", "user_id")
            .agg(A.first_by("traffic_source", *order).alias("entry_traffic_source"),
                 A.first_by("uri", *order).alias("entry_uri"),
                 A.first_by("browser", *order).alias("browser")))


@register("daily_revenue_base", O.model("daily_revenue"))
def daily_revenue_base(spark, sf):
    m = _m(spark, sf)
    return A.daily_revenue_base(m.fct_order_items, m.dim_products.select("product_id", "department_name"))


register("cohort_size", O.model("cohort_size"))(
    lambda spark, sf: A.cohort_size(_m(spark, sf).dim_users))


@register("purchase_months", O.model("purchase_months"))
def purchase_months(spark, sf):
    m = _m(spark, sf)
    return A.purchase_months(m.fct_orders, m.dim_users)


@register("retained_users", O.model("retention"))
def retained_users(spark, sf):
    m = _m(spark, sf)
    return A.retention_base(A.purchase_months(m.fct_orders, m.dim_users)).select(
        "signup_cohort_month", "activity_month", "months_since_signup", "retained_user_count")


register("daily_order_count", O.model("daily_order_count"))(
    lambda spark, sf: A.daily_order_count(_m(spark, sf).fct_orders))

_STG = ("stg_orders", "stg_order_items", "stg_products", "stg_users", "stg_events",
        "stg_inventory_items", "stg_distribution_centers")


@register("table_row_counts", O.oracle(
    " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in _STG),
    *_STG))
def table_row_counts(spark, sf):
    m = _m(spark, sf)
    parts = [A.row_count(getattr(m, t)).select(F.lit(t).alias("table_name"), "row_count") for t in _STG]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


#: The declared limits, and a source that never loaded: it must not look healthy.
_FRESH = {**Q.FRESHNESS, "orders_never_loaded": Q.Freshness(12, 36)}


def _freshness_sql(name: str, lim) -> str:
    """The rule: no rows, or older than the error limit, is an error; ages are compared in seconds."""
    source = "(SELECT * FROM raw_orders WHERE false)" if name == "orders_never_loaded" else f"raw_{name}"
    age = f"date_diff('second', date_trunc('second', max(_ingested_at)), TIMESTAMP '{FRESHNESS_NOW.isoformat(sep=' ')}')"
    status = "'exempt'" if lim.error_after_hours is None else (
        f"CASE WHEN count(_ingested_at) = 0 OR {age} > {lim.error_after_hours} * 3600 THEN 'error' "
        f"WHEN {age} > {lim.warn_after_hours} * 3600 THEN 'warn' ELSE 'pass' END")
    return (f"SELECT '{name}' AS source_name, max(_ingested_at) AS max_loaded_at, round({age} / 3600.0, 2) AS age_hours, "
            f"{status} AS freshness_status FROM {source}")


@register("source_freshness", O.oracle(" UNION ALL ".join(_freshness_sql(n, lim) for n, lim in sorted(_FRESH.items())),
                                       *[f"raw_{n}" for n in Q.FRESHNESS]))
def source_freshness(spark, sf):
    m = _m(spark, sf)
    tables = {n: m.raw(n) for n in Q.FRESHNESS} | {"orders_never_loaded": m.raw("orders").where(F.lit(False))}
    return Q.source_freshness(tables, FRESHNESS_NOW, _FRESH)


# ====================================================================== windows
@register("event_gaps", O.oracle("""
SELECT event_key, user_id, event_at,
       date_sub('minute', lag(event_at) OVER (PARTITION BY user_id ORDER BY event_at, event_key),
                event_at) AS minutes_since_prev_event
FROM stg_events WHERE user_id IS NOT NULL""", "stg_events"))
def event_gaps(spark, sf):
    return _m(spark, sf).int_events_sessionized.select(
        "event_key", "user_id", "event_at", "minutes_since_prev_event")


_BASELINE_CTE = {"baseline": """
SELECT ordered_date, order_count,
       avg(order_count) OVER w AS baseline_avg,
       stddev_samp(order_count) OVER w AS baseline_stddev,
       count(*) OVER w AS baseline_weeks
FROM daily_order_count
WINDOW w AS (PARTITION BY dayofweek(ordered_date) ORDER BY ordered_date
             ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING)"""}


@register("order_volume_baseline", O.oracle("""
SELECT ordered_date, order_count, round(baseline_avg, 1) AS baseline_avg, baseline_stddev,
       baseline_weeks,
       round((order_count - baseline_avg) / nullif(baseline_stddev, 0), 2) AS z_score
FROM baseline""", "daily_order_count", extra=_BASELINE_CTE))
def order_volume_baseline(spark, sf):
    return Q.order_volume_baseline(_m(spark, sf).fct_orders)


@register("order_volume_anomalies", O.oracle("""
SELECT ordered_date, order_count, round(baseline_avg, 1) AS baseline_avg,
       round((order_count - baseline_avg) / nullif(baseline_stddev, 0), 2) AS z_score
FROM baseline
WHERE baseline_weeks >= 8 AND baseline_stddev > 0
  AND abs((order_count - baseline_avg) / nullif(baseline_stddev, 0)) > 3""",
    "daily_order_count", extra=_BASELINE_CTE))
def order_volume_anomalies(spark, sf):
    """Q9's rule over the whole order history (no recent-window restriction)."""
    b = W.weekday_baseline(A.daily_order_count(_m(spark, sf).fct_orders))
    z = W.zscore("order_count", "baseline_avg", "baseline_stddev")
    return (b.where((F.col("baseline_weeks") >= 8) & (F.col("baseline_stddev") > 0) & (F.abs(z) > 3))
            .select("ordered_date", "order_count", F.round("baseline_avg", 1).alias("baseline_avg"),
                    F.round(z, 2).alias("z_score")))


@register("check_daily_order_volume", O.oracle(f"""
SELECT ordered_date, order_count, round(baseline_avg, 1) AS baseline_avg,
       round((order_count - baseline_avg) / nullif(baseline_stddev, 0), 2) AS z_score
FROM baseline
WHERE baseline_weeks >= 8 AND baseline_stddev > 0
  AND ordered_date >= DATE '{ORDERS_RUN_DATE}' - INTERVAL 3 DAY
  AND ordered_date < DATE '{ORDERS_RUN_DATE}'
  AND abs((order_count - baseline_avg) / nullif(baseline_stddev, 0)) > 3""",
    "daily_order_count", extra=_BASELINE_CTE))
def check_daily_order_volume(spark, sf):
    return Q.check_daily_order_volume(_m(spark, sf).fct_orders, Params(run_date=ORDERS_RUN_DATE))


@register("order_volume_wow", O.oracle("""
SELECT c.ordered_date, c.order_count, p.order_count AS prior_week_count,
       round(cast(c.order_count - p.order_count AS double) / nullif(p.order_count, 0), 4) AS wow_change_rate
FROM daily_order_count c
LEFT JOIN daily_order_count p ON p.ordered_date = c.ordered_date - 7""", "daily_order_count"))
def order_volume_wow(spark, sf):
    return W.week_over_week(A.daily_order_count(_m(spark, sf).fct_orders))


@register("order_volume_band", O.oracle("""
SELECT ordered_date, order_count,
       min(order_count) OVER w AS band_min, max(order_count) OVER w AS band_max,
       order_count < min(order_count) OVER w OR order_count > max(order_count) OVER w AS outside_band
FROM daily_order_count
WINDOW w AS (ORDER BY ordered_date ROWS BETWEEN 28 PRECEDING AND 1 PRECEDING)""", "daily_order_count"))
def order_volume_band(spark, sf):
    return W.min_max_band(A.daily_order_count(_m(spark, sf).fct_orders))


# ====================================================================== checks
@register("check_order_item_count", O.oracle("""
SELECT order_key, order_id, source_item_count, line_item_count,
       line_item_count - source_item_count AS diff, ordered_date
FROM fct_orders
WHERE line_item_count IS NOT NULL AND source_item_count != line_item_count""", "fct_orders"))
def check_order_item_count(spark, sf):
    return Q.check_order_item_count(_m(spark, sf).fct_orders)


@register("check_no_order_before_signup", O.oracle("""
SELECT o.order_id, o.user_id, o.ordered_at, u.signed_up_at
FROM fct_orders o JOIN dim_users u ON o.user_id = u.user_id
WHERE o.ordered_at < u.signed_up_at""", "fct_orders", "dim_users"))
def check_no_order_before_signup(spark, sf):
    m = _m(spark, sf)
    return Q.check_no_order_before_signup(m.fct_orders, m.dim_users)


@register("check_fact_not_truncated", O.oracle("""
SELECT staging_rows, fact_rows, staging_rows - fact_rows AS missing_rows
FROM (SELECT (SELECT count(*) FROM stg_orders) AS staging_rows,
             (SELECT count(*) FROM fct_orders) AS fact_rows) c
WHERE staging_rows != fact_rows""", "stg_orders", "fct_orders"))
def check_fact_not_truncated(spark, sf):
    m = _m(spark, sf)
    return Q.check_fact_not_truncated(m.stg_orders, m.fct_orders)


@register("check_equal_rowcount_items", O.oracle("""
SELECT rows_a, rows_b, rows_a - rows_b AS diff
FROM (SELECT (SELECT count(*) FROM stg_order_items) AS rows_a,
             (SELECT count(*) FROM fct_order_items) AS rows_b) c
WHERE rows_a != rows_b""", "stg_order_items", "fct_order_items"))
def check_equal_rowcount_items(spark, sf):
    m = _m(spark, sf)
    return Q.check_equal_rowcount(m.stg_order_items, m.fct_order_items)


@register("check_unique_order_item_key", O.oracle("""
SELECT order_item_key, count(*) AS n_records FROM stg_order_items
WHERE order_item_key IS NOT NULL GROUP BY order_item_key HAVING count(*) > 1""", "stg_order_items"))
def check_unique_order_item_key(spark, sf):
    return Q.check_unique(_m(spark, sf).stg_order_items, "order_item_key")


@register("check_unique_daily_revenue_grain", O.oracle("""
SELECT ordered_date, department_name, count(*) AS n_records FROM rpt_daily_revenue
GROUP BY ordered_date, department_name HAVING count(*) > 1""", "rpt_daily_revenue"))
def check_unique_daily_revenue_grain(spark, sf):
    return Q.check_unique(_m(spark, sf).rpt_daily_revenue, "ordered_date", "department_name")


@register("check_not_null_item_order_key", O.oracle("""
SELECT order_item_key, order_id, ordered_date FROM fct_order_items WHERE order_key IS NULL""",
    "fct_order_items"))
def check_not_null_item_order_key(spark, sf):
    return Q.check_not_null(_m(spark, sf).fct_order_items, "order_key").select(
        "order_item_key", "order_id", "ordered_date")


@register("check_accepted_values_department", O.oracle("""
SELECT product_id, department_name FROM stg_products
WHERE department_name NOT IN ('Men', 'Women')""", "stg_products"))
def check_accepted_values_department(spark, sf):
    return Q.check_accepted_values(_m(spark, sf).stg_products, "department_name",
                                   ("Men", "Women")).select("product_id", "department_name")


@register("check_expression_sale_price", O.oracle("""
SELECT order_item_key, sale_price FROM stg_order_items WHERE NOT (sale_price >= 0)""",
    "stg_order_items"))
def check_expression_sale_price(spark, sf):
    return Q.check_expression(_m(spark, sf).stg_order_items, "sale_price >= 0").select(
        "order_item_key", "sale_price")


@register("check_relationships_events_user", O.oracle("""
SELECT e.event_key, e.user_id FROM stg_events e
WHERE e.user_id IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM stg_users u WHERE u.user_id = e.user_id)""", "stg_events", "stg_users"))
def check_relationships_events_user(spark, sf):
    m = _m(spark, sf)
    return Q.check_relationships(m.stg_events, "user_id", m.stg_users, "user_id").select(
        "event_key", "user_id")


@register("check_relationships_item_order_key", O.oracle("""
SELECT i.order_item_key, i.order_key FROM fct_order_items i
WHERE i.order_key IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM fct_orders o WHERE o.order_key = i.order_key)""",
    "fct_order_items", "fct_orders"))
def check_relationships_item_order_key(spark, sf):
    m = _m(spark, sf)
    return Q.check_relationships(m.fct_order_items, "order_key", m.fct_orders, "order_key").select(
        "order_item_key", "order_key")


@register("check_relationships_product_dc", O.oracle("""
SELECT p.product_id, p.distribution_center_id FROM stg_products p
WHERE p.distribution_center_id IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM stg_distribution_centers d
                  WHERE d.distribution_center_id = p.distribution_center_id)""",
    "stg_products", "stg_distribution_centers"))
def check_relationships_product_dc(spark, sf):
    m = _m(spark, sf)
    return Q.check_relationships(m.stg_products, "distribution_center_id",
                                 m.stg_distribution_centers, "distribution_center_id").select(
        "product_id", "distribution_center_id")


@register("check_null_proportion_event_user", O.oracle("""
SELECT row_count, null_count,
       round(cast(null_count AS double) / nullif(row_count, 0), 4) AS null_proportion
FROM (SELECT count(*) AS row_count, cast(count_if(user_id IS NULL) AS bigint) AS null_count
      FROM stg_events) a
WHERE round(cast(null_count AS double) / nullif(row_count, 0), 4) > 0.05""", "stg_events"))
def check_null_proportion_event_user(spark, sf):
    return Q.check_null_proportion(_m(spark, sf).stg_events, "user_id", 0.05)


@register("check_recency_events", O.oracle(f"""
SELECT latest, round((epoch(TIMESTAMP '{RECENCY_NOW.isoformat(sep=' ')}') - floor(epoch(latest))) / 3600.0, 2)
           AS age_hours
FROM (SELECT max(event_at) AS latest FROM stg_events) l
WHERE latest IS NULL
   OR round((epoch(TIMESTAMP '{RECENCY_NOW.isoformat(sep=' ')}') - floor(epoch(latest))) / 3600.0, 2) > 24""",
    "stg_events"))
def check_recency_events(spark, sf):
    return Q.check_recency(_m(spark, sf).stg_events, "event_at", RECENCY_NOW, 24)


# ---- the same operators where rows of the whole tables fail
#: Buyers with an order on or after this day count as recent.
RECENT_ORDERS_FROM = "2001-01-01"


@register("check_relationships_events_recent_buyer", O.oracle(f"""
SELECT e.event_key, e.user_id FROM stg_events e
WHERE e.user_id IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM stg_orders o
                  WHERE o.user_id = e.user_id AND o.ordered_date >= DATE '{RECENT_ORDERS_FROM}')""",
    "stg_events", "stg_orders"))
def check_relationships_events_recent_buyer(spark, sf):
    """Events of users without a recent order."""
    m = _m(spark, sf)
    recent = m.stg_orders.where(F.col("ordered_date") >= F.lit(RECENT_ORDERS_FROM).cast("date"))
    return Q.check_relationships(m.stg_events, "user_id", recent, "user_id").select("event_key", "user_id")


@register("check_expression_discount_rate", O.oracle("""
SELECT order_item_key, discount_rate FROM int_order_items_enriched WHERE NOT (discount_rate >= 0)""",
    "int_order_items_enriched"))
def check_expression_discount_rate(spark, sf):
    return Q.check_expression(_m(spark, sf).int_order_items_enriched, "discount_rate >= 0").select(
        "order_item_key", "discount_rate")


@register("check_unique_order_line", O.oracle("""
SELECT order_id, order_item_id, count(*) AS n_records FROM stg_order_items
GROUP BY order_id, order_item_id HAVING count(*) > 1""", "stg_order_items"))
def check_unique_order_line(spark, sf):
    return Q.check_unique(_m(spark, sf).stg_order_items, "order_id", "order_item_id")


@register("check_equal_rowcount_matched_items", O.oracle("""
SELECT rows_a, rows_b, rows_a - rows_b AS diff
FROM (SELECT (SELECT count(*) FROM stg_order_items) AS rows_a,
             (SELECT count(*) FROM fct_order_items WHERE order_key IS NOT NULL) AS rows_b) c
WHERE rows_a != rows_b""", "stg_order_items", "fct_order_items"))
def check_equal_rowcount_matched_items(spark, sf):
    """Items whose header is missing do not count as matched."""
    m = _m(spark, sf)
    return Q.check_equal_rowcount(m.stg_order_items, m.fct_order_items.where(F.col("order_key").isNotNull()))


@register("check_orders_with_revenue_complete", O.oracle("""
SELECT staging_rows, fact_rows, staging_rows - fact_rows AS missing_rows
FROM (SELECT (SELECT count(*) FROM stg_orders) AS staging_rows,
             (SELECT count(*) FROM fct_orders WHERE net_revenue > 0) AS fact_rows) c
WHERE staging_rows != fact_rows""", "stg_orders", "fct_orders"))
def check_orders_with_revenue_complete(spark, sf):
    """Orders that bring no net revenue show up as missing rows."""
    m = _m(spark, sf)
    return Q.check_fact_not_truncated(m.stg_orders, m.fct_orders.where(F.col("net_revenue") > 0))


#: A backfill: every order day lies in the lookback.
_VOLUME_BACKFILL = Params(run_date=ORDERS_RUN_DATE, lookback_days=4000)


@register("check_daily_order_volume_backfill", O.oracle(f"""
SELECT ordered_date, order_count, round(baseline_avg, 1) AS baseline_avg,
       round((order_count - baseline_avg) / nullif(baseline_stddev, 0), 2) AS z_score
FROM baseline
WHERE baseline_weeks >= 8 AND baseline_stddev > 0
  AND ordered_date >= DATE '{ORDERS_RUN_DATE}' - INTERVAL {_VOLUME_BACKFILL.lookback_days} DAY
  AND ordered_date < DATE '{ORDERS_RUN_DATE}'
  AND abs((order_count - baseline_avg) / nullif(baseline_stddev, 0)) > 3""",
    "daily_order_count", extra=_BASELINE_CTE))
def check_daily_order_volume_backfill(spark, sf):
    return Q.check_daily_order_volume(_m(spark, sf).fct_orders, _VOLUME_BACKFILL)


@register("failure_trend", O.oracle(f"""
SELECT 'accepted_department' AS "check", DATE '{ORDERS_RUN_DATE}' AS run_date, count(*) AS failing_rows
FROM stg_products WHERE department_name NOT IN ('Men', 'Women') HAVING count(*) > 0
UNION ALL
SELECT 'unique_order_line', DATE '{ORDERS_RUN_DATE}', count(*)
FROM (SELECT 1 FROM stg_order_items GROUP BY order_id, order_item_id HAVING count(*) > 1) d HAVING count(*) > 0""",
    "stg_products", "stg_order_items"))
def failure_trend(spark, sf):
    """X12 over the failing rows of two checks, as the failure store keeps them."""
    failing = {"accepted_department": check_accepted_values_department(spark, sf),
               "unique_order_line": check_unique_order_line(spark, sf)}
    stored = [df.select(F.lit(name).alias("check"), F.lit(ORDERS_RUN_DATE).alias("run_date"))
              for name, df in failing.items()]
    return X.failure_trend(stored[0].unionByName(stored[1]))


# ====================================================================== history
def product_state_1(spark, sf) -> DataFrame:
    return raw_source(spark, sf, "products").select(*H.PRODUCT_SNAPSHOT_COLS)


def product_state_2(p1: DataFrame) -> DataFrame:
    """Second product state: the first 20 ids repriced ±15% by parity, the
    highest id removed and re-listed under the next id."""
    repriced = H.apply_keyed_updates(p1, H.price_change_updates(p1), "id", ["retail_price"])
    last = p1.orderBy(F.col("id").desc()).limit(1)
    relisted = (last.withColumn("id", F.col("id") + 1)
                .withColumn("sku", F.concat(F.col("sku"), F.lit("-R2"))))
    return repriced.join(last.select("id"), "id", "left_anti").unionByName(relisted)


def product_history(spark, sf) -> DataFrame:
    p1 = product_state_1(spark, sf)
    return H.history_from_states([(p1, SNAPSHOT_TS1), (product_state_2(p1), SNAPSHOT_TS2)])


def _models_with_history(spark, sf, **kw) -> Models:
    return Models(spark, sf, history=product_history(spark, sf), **kw)


_CHANGED = " OR ".join(f"NOT (p1.{c} IS NOT DISTINCT FROM p2.{c})" for c in H.PRODUCT_CHECK_COLS)
_P_COLS = ", ".join(H.PRODUCT_SNAPSHOT_COLS)
_HISTORY_CTES = {
    "p1": f"SELECT {_P_COLS} FROM raw_products",
    "upd": """SELECT id, cast(round(cast(retail_price AS decimal(18,2))
                   * CASE WHEN id % 2 = 0 THEN 1.15 ELSE 0.85 END, 2) AS double) AS retail_price
              FROM p1 ORDER BY id LIMIT 20""",
    "p2": """SELECT p1.id, p1.name, p1.brand, p1.category, p1.department, p1.sku, p1.cost,
                    coalesce(upd.retail_price, p1.retail_price) AS retail_price, p1.distribution_center_id
             FROM p1 LEFT JOIN upd ON p1.id = upd.id
             WHERE p1.id <> (SELECT max(id) FROM p1)
             UNION ALL
             SELECT id + 1, name, brand, category, department, sku || '-R2', cost, retail_price,
                    distribution_center_id
             FROM p1 WHERE id = (SELECT max(id) FROM p1)""",
    "snap": f"""
SELECT p1.*, md5(concat_ws('|', cast(p1.id AS varchar), '{SNAPSHOT_TS1}')) AS _scd_id,
       TIMESTAMP '{SNAPSHOT_TS1}' AS _updated_at, TIMESTAMP '{SNAPSHOT_TS1}' AS _valid_from,
       CASE WHEN p2.id IS NULL OR {_CHANGED} THEN TIMESTAMP '{SNAPSHOT_TS2}' END AS _valid_to
FROM p1 LEFT JOIN p2 ON p1.id = p2.id
UNION ALL
SELECT p2.*, md5(concat_ws('|', cast(p2.id AS varchar), '{SNAPSHOT_TS2}')) AS _scd_id,
       TIMESTAMP '{SNAPSHOT_TS2}' AS _updated_at, TIMESTAMP '{SNAPSHOT_TS2}' AS _valid_from,
       CAST(NULL AS TIMESTAMP) AS _valid_to
FROM p2 LEFT JOIN p1 ON p1.id = p2.id
WHERE p1.id IS NULL OR {_CHANGED}""",
    "dim_products_history": """
SELECT _scd_id AS product_history_key, id AS product_id, name AS product_name, brand AS brand_name,
       category AS category_name, department AS department_name, sku,
       cast(cost AS decimal(18,9)) AS unit_cost, cast(retail_price AS decimal(18,9)) AS retail_price,
       distribution_center_id, _valid_from AS valid_from, _valid_to AS valid_to,
       _valid_to IS NULL AS is_current
FROM snap""",
}
O.cte("p1", _HISTORY_CTES["p1"], "raw_products")
O.cte("upd", _HISTORY_CTES["upd"], "p1")
O.cte("p2", _HISTORY_CTES["p2"], "p1", "upd")
O.cte("snap", _HISTORY_CTES["snap"], "p1", "p2")
O.cte("dim_products_history", _HISTORY_CTES["dim_products_history"], "snap")


@register("dim_products_history", O.model("dim_products_history"))
def dim_products_history(spark, sf):
    return _models_with_history(spark, sf).dim_products_history


@register("keyed_update", O.oracle(f"""
SELECT p1.id, p1.name, p1.brand, p1.category, p1.department, p1.sku, p1.cost,
       coalesce(upd.retail_price, p1.retail_price) AS retail_price, p1.distribution_center_id
FROM p1 LEFT JOIN upd ON p1.id = upd.id""", "p1", "upd"))
def keyed_update(spark, sf):
    p1 = product_state_1(spark, sf)
    return H.apply_keyed_updates(p1, H.price_change_updates(p1), "id", ["retail_price"])


@register("load_insert_only_delta", O.oracle("""
SELECT p2.* FROM p2 WHERE NOT EXISTS (SELECT 1 FROM p1 WHERE p1.id = p2.id)""", "p1", "p2"))
def load_insert_only_delta(spark, sf):
    p1 = product_state_1(spark, sf)
    return insert_only_delta(product_state_2(p1), p1, "id")


@register("check_relationships_item_listed_product", O.oracle("""
SELECT i.order_item_key, i.product_id FROM stg_order_items i
WHERE i.product_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM p2 WHERE p2.id = i.product_id)""",
    "stg_order_items", "p2"))
def check_relationships_item_listed_product(spark, sf):
    """Items of a product that the second product state no longer lists."""
    listed = product_state_2(product_state_1(spark, sf))
    return Q.check_relationships(_m(spark, sf).stg_order_items, "product_id", listed, "id").select(
        "order_item_key", "product_id")


@register("upsert_products", O.oracle("""
SELECT p1.* FROM p1 WHERE NOT EXISTS (SELECT 1 FROM p2 WHERE p2.id = p1.id)
UNION ALL SELECT p2.* FROM p2""", "p1", "p2"))
def upsert_products(spark, sf):
    """The second product state merged into the first; the row it lacks stays."""
    p1 = product_state_1(spark, sf)
    return X.upsert(p1, product_state_2(p1), "id")


@register("periodic_snapshot_products", O.oracle(f"""
SELECT p1.*, DATE '{EVENTS_RUN_DATE}' AS snapshot_date FROM p1""", "p1"))
def periodic_snapshot_products(spark, sf):
    return X.periodic_snapshot(product_state_1(spark, sf), EVENTS_RUN_DATE)


@register("sync_columns_products", O.oracle("""
SELECT id, name, brand, category, department, CAST(NULL AS varchar) AS sku, cost, distribution_center_id FROM p1""",
    "p1"))
def sync_columns_products(spark, sf):
    """Existing rows without a SKU take the columns of a state that has one and lost the price."""
    p1 = product_state_1(spark, sf)
    return sync_columns(p1.drop("sku"), product_state_2(p1).drop("retail_price"))


@register("scd2_timestamp", O.oracle(f"""
SELECT p1.id, p1.retail_price, TIMESTAMP '{SNAPSHOT_TS1}' AS _valid_from,
       CASE WHEN q2.id IS NULL OR q2.updated_at > TIMESTAMP '{SNAPSHOT_TS1}' THEN TIMESTAMP '{SNAPSHOT_TS2}' END AS _valid_to
FROM p1 LEFT JOIN q2 ON p1.id = q2.id
UNION ALL
SELECT q2.id, q2.retail_price, q2.updated_at, CAST(NULL AS TIMESTAMP)
FROM q2 LEFT JOIN p1 ON p1.id = q2.id
WHERE p1.id IS NULL OR q2.updated_at > TIMESTAMP '{SNAPSHOT_TS1}'""", "p1", "p2",
    extra={"q2": f"""SELECT p2.*, CASE WHEN cost > 570 THEN TIMESTAMP '{SNAPSHOT_TS2}'
                                   ELSE TIMESTAMP '{SNAPSHOT_TS1}' END AS updated_at FROM p2"""}))
def scd2_timestamp(spark, sf):
    """A newer ``updated_at`` opens a version, whatever the values; other changes do not."""
    p1 = product_state_1(spark, sf)
    at = lambda ts: F.lit(ts).cast("timestamp")
    s1 = p1.withColumn("updated_at", at(SNAPSHOT_TS1))
    s2 = product_state_2(p1).withColumn("updated_at", F.when(F.col("cost") > 570, at(SNAPSHOT_TS2))
                                        .otherwise(at(SNAPSHOT_TS1)))
    by = {"strategy": "timestamp", "updated_at": "updated_at"}
    return H.scd2_apply(H.scd2_apply(None, s1, "id", SNAPSHOT_TS1, **by), s2, "id", SNAPSHOT_TS2, **by).select(
        "id", "retail_price", "_valid_from", "_valid_to")


@register("scd2_diff", O.oracle(f"""
SELECT product_history_key, product_id, retail_price, valid_from, valid_to, is_current
FROM dim_products_history
WHERE valid_from = TIMESTAMP '{SNAPSHOT_TS2}' OR valid_to = TIMESTAMP '{SNAPSHOT_TS2}'""",
    "dim_products_history"))
def scd2_diff(spark, sf):
    ts2 = F.lit(SNAPSHOT_TS2).cast("timestamp")
    h = _models_with_history(spark, sf).dim_products_history
    return h.where((F.col("valid_from") == ts2) | (F.col("valid_to") == ts2)).select(
        "product_history_key", "product_id", "retail_price", "valid_from", "valid_to", "is_current")


@register("scd2_multi_version_rows", O.oracle("""
SELECT product_id, product_name, retail_price, valid_from, valid_to
FROM dim_products_history
WHERE product_id IN (SELECT product_id FROM dim_products_history GROUP BY product_id HAVING count(*) > 1)
ORDER BY product_id, valid_from
LIMIT 40""", "dim_products_history"))
def scd2_multi_version_rows(spark, sf):
    return H.multi_version_rows(_models_with_history(spark, sf).dim_products_history)


@register("revenue_at_historical_price", O.oracle(f"""
SELECT i.order_item_key, i.order_id, i.product_id, i.ordered_at, i.sale_price,
       h.product_history_key, h.retail_price AS historical_retail_price,
       {O.exact_rate('h.retail_price - i.sale_price', 'h.retail_price')} AS historical_discount_rate
FROM fct_order_items i
LEFT JOIN dim_products_history h
  ON i.product_id = h.product_id AND i.ordered_at >= h.valid_from
 AND (h.valid_to IS NULL OR i.ordered_at < h.valid_to)""", "fct_order_items", "dim_products_history"))
def revenue_at_historical_price(spark, sf):
    m = _models_with_history(spark, sf)
    facts = m.fct_order_items.select("order_item_key", "order_id", "product_id", "ordered_at", "sale_price")
    hist = m.dim_products_history.select("product_id", "product_history_key",
                                         F.col("retail_price").alias("historical_retail_price"),
                                         "valid_from", "valid_to")
    return (asof_join(facts, hist, "product_id", "ordered_at")
            .withColumn("historical_discount_rate",
                        guarded_rate(F.col("historical_retail_price") - F.col("sale_price"),
                                     F.col("historical_retail_price")).cast("decimal(18,4)"))
            .drop("valid_from", "valid_to"))


@register("daily_state_from_history", O.oracle(f"""
SELECT cast(d.d AS date) AS snapshot_date, h.product_id, h.product_history_key, h.retail_price
FROM range(DATE '{STATE_WINDOW[0]}', DATE '{STATE_WINDOW[1]}' + INTERVAL 1 DAY, INTERVAL 1 DAY) d(d)
JOIN dim_products_history h
  ON cast(d.d AS date) >= cast(h.valid_from AS date)
 AND (h.valid_to IS NULL OR cast(d.d AS date) < cast(h.valid_to AS date))""", "dim_products_history"))
def daily_state_from_history(spark, sf):
    h = _models_with_history(spark, sf).dim_products_history
    return H.expand_history(h, *STATE_WINDOW).select(
        "snapshot_date", "product_id", "product_history_key", "retail_price")


# Window of the incremental runs: days read and days written.
_INC = Params(run_date=EVENTS_RUN_DATE)
_INC_READ = tuple(str(d) for d in _INC.window(_INC.session_buffer_days))
_INC_OUT = tuple(str(d) for d in _INC.window())


# ====================================================================== written, then read back
def _table(spark, name: str) -> str:
    """A new table folder that the driver and all executors share."""
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


@register("snapshot_run_products", O.model("dim_products_history"))
def snapshot_run_products(spark, sf):
    """Two snapshot runs on a stored history, the second one rerun, read back."""
    path = _table(spark, "products-history")
    p1 = product_state_1(spark, sf)
    H.snapshot_run(spark, path, p1, "id", SNAPSHOT_TS1, check_cols=H.PRODUCT_CHECK_COLS)
    for _ in range(2):
        H.snapshot_run(spark, path, product_state_2(p1), "id", SNAPSHOT_TS2, check_cols=H.PRODUCT_CHECK_COLS)
    return H.dim_products_history(H.read_history(spark, path))


#: A reload of these days, in which the source has lost one of them.
RELOAD = ("1997-03-01", "1997-03-31")
LOST_DAY = "1997-03-15"


@register("load_window_overwrite_orders", O.oracle(f"""
SELECT order_id, user_id, status, created_at,
       CASE WHEN cast(created_at AS date) BETWEEN DATE '{RELOAD[0]}' AND DATE '{RELOAD[1]}'
            THEN num_of_item + 1 ELSE num_of_item END AS num_of_item, cast(created_at AS date) AS _partition_date
FROM raw_orders WHERE created_at IS NOT NULL AND cast(created_at AS date) <> DATE '{LOST_DAY}'""", "raw_orders"))
def load_window_overwrite_orders(spark, sf):
    """All orders landed, then a month of them again with other item counts and without one day."""
    path = _table(spark, "orders")
    orders = raw_source(spark, sf, "orders").select("order_id", "user_id", "status", "created_at", "num_of_item")
    load_window_overwrite(spark, orders, path, "created_at", "1900-01-01", "2100-01-01", ("user_id",))
    again = orders.where(F.to_date("created_at") != F.lit(LOST_DAY).cast("date")).withColumn("num_of_item", F.col("num_of_item") + 1)
    load_window_overwrite(spark, again, path, "created_at", *RELOAD, ("user_id",))
    return spark.read.parquet(path)


@register("load_full_replace_users", O.oracle(
    "SELECT id, email, age, created_at FROM raw_users WHERE id % 3 <> 0", "raw_users"))
def load_full_replace_users(spark, sf):
    """All users landed, then replaced by two thirds of them."""
    path = _table(spark, "users")
    users = raw_source(spark, sf, "users").select("id", "email", "age", "created_at")
    load_full_replace(spark, users, path)
    load_full_replace(spark, users.where(F.col("id") % 3 != 0), path)
    return read_table(spark, path)


@register("write_incremental_events", O.oracle(f"""
SELECT event_key, user_id, event_type, event_date,
       CASE WHEN event_date BETWEEN DATE '{_INC_OUT[0]}' AND DATE '{_INC_OUT[1]}' THEN 2 ELSE 1 END AS version
FROM stg_events""", "stg_events"))
def write_incremental_events(spark, sf):
    """A first run of all days, then an increment that replaces the days of its window."""
    path = _table(spark, "events")
    events = _m(spark, sf).stg_events.select("event_key", "user_id", "event_type", "event_date")
    write_incremental(spark, events.withColumn("version", F.lit(1)), path, "event_date", ("user_id",))
    window = events.where(F.col("event_date").between(*_INC_OUT))
    write_incremental(spark, window.withColumn("version", F.lit(2)), path, "event_date", ("user_id",))
    return spark.read.parquet(path)


@register("sync_schema_events", O.oracle(f"""
SELECT event_key, event_date,
       CASE WHEN event_date BETWEEN DATE '{_INC_OUT[0]}' AND DATE '{_INC_OUT[1]}' THEN browser END AS browser
FROM stg_events""", "stg_events"))
def sync_schema_events(spark, sf):
    """An increment that adds a column and drops another; older days keep what they share."""
    path = _table(spark, "events")
    events = _m(spark, sf).stg_events
    write_incremental(spark, events.select("event_key", "user_id", "event_date"), path, "event_date")
    window = events.where(F.col("event_date").between(*_INC_OUT)).select("event_key", "browser", "event_date")
    write_incremental(spark, window, path, "event_date")
    return spark.read.parquet(path)


@register("write_contracted_users", O.model("dim_users"))
def write_contracted_users(spark, sf):
    """Q12/Q13: the user dimension under its contract, names, types and not-null columns asserted at the write."""
    path = _table(spark, "dim-users")
    schema, not_null = CONTRACTS["dim_users"]
    write_table(Q.enforce_contract(_m(spark, sf).dim_users, schema, not_null), path, cluster_by=("user_id",))
    return read_table(spark, path)


@register("failure_trend_stored", O.oracle(f"""
SELECT 'accepted_department' AS "check", DATE '{ORDERS_RUN_DATE - dt.timedelta(days=1)}' AS run_date, count(*) AS failing_rows
FROM stg_products WHERE department_name NOT IN ('Men', 'Women') AND product_id % 2 = 0 HAVING count(*) > 0
UNION ALL
SELECT 'accepted_department', DATE '{ORDERS_RUN_DATE}', count(*)
FROM stg_products WHERE department_name NOT IN ('Men', 'Women') HAVING count(*) > 0
UNION ALL
SELECT 'unique_order_line', DATE '{ORDERS_RUN_DATE}', count(*)
FROM (SELECT 1 FROM stg_order_items GROUP BY order_id, order_item_id HAVING count(*) > 1) d HAVING count(*) > 0""",
    "stg_products", "stg_order_items"))
def failure_trend_stored(spark, sf):
    """The trend over stored failures of two runs; the second run of a day replaces the first."""
    root, day_before = _table(spark, "audit"), ORDERS_RUN_DATE - dt.timedelta(days=1)
    failing = check_accepted_values_department(spark, sf)
    store_failures(failing.where(F.col("product_id") % 2 == 0), root, "accepted_department", day_before)
    store_failures(failing.where(F.col("product_id") % 3 == 0), root, "accepted_department", ORDERS_RUN_DATE)
    store_failures(failing, root, "accepted_department", ORDERS_RUN_DATE)
    store_failures(check_unique_order_line(spark, sf), root, "unique_order_line", ORDERS_RUN_DATE)
    stored = spark.read.option("mergeSchema", "true").parquet(root).select("check", F.col("run_date").cast("date").alias("run_date"))
    return X.failure_trend(stored)


@register("upsert_products_eligible", O.oracle("""
SELECT p1.* FROM p1 WHERE NOT (p1.cost > 570) OR NOT EXISTS (SELECT 1 FROM p2 WHERE p2.id = p1.id)
UNION ALL SELECT p2.* FROM p2 WHERE p2.cost > 570""", "p1", "p2"))
def upsert_products_eligible(spark, sf):
    """X5 with a target predicate: only dear products are eligible, and only such rows come in."""
    p1 = product_state_1(spark, sf)
    dear = F.col("cost") > 570
    return X.upsert(p1, product_state_2(p1).where(dear), "id", dear)


@register("landing_partition_scan", O.oracle("""
SELECT event_key, user_id, event_type, event_date AS ingest_date FROM stg_events
WHERE event_date IN (SELECT event_date FROM stg_events WHERE event_type = 'purchase' GROUP BY event_date
                     HAVING count(*) >= (SELECT avg(n) FROM (SELECT count(*) AS n FROM stg_events
                                                             WHERE event_type = 'purchase' GROUP BY event_date) d))""", "stg_events"))
def landing_partition_scan(spark, sf):
    """Landed events of the days with at least an average day's purchases, found at run time."""
    root = _table(spark, "landing")
    events = _m(spark, sf).stg_events.select("event_key", "user_id", "event_type", "event_date")
    X.write_landing(events, root, F.col("event_date"))
    by_day = (spark.read.parquet(root).where(F.col("event_type") == "purchase")
              .groupBy("ingest_date").agg(F.count(F.lit(1)).alias("n")))
    average = by_day.agg(F.avg("n").alias("average"))
    busy = by_day.join(F.broadcast(average), F.col("n") >= F.col("average"))  # one row on the right
    return X.scan_landing_days(spark, root, busy).select("event_key", "user_id", "event_type", "ingest_date")


# ====================================================================== sessionization variants
for _t in (720,):
    O.cte(f"int_events_sessionized_{_t}", O.sessionized_sql(_t), "stg_events")
    O.cte(f"fct_sessions_{_t}", O.sessions_sql(f"int_events_sessionized_{_t}"),
          f"int_events_sessionized_{_t}")


@register("fct_sessions_timeout_720", O.model("fct_sessions_720"))
def fct_sessions_timeout_720(spark, sf):
    return _m(spark, sf, params=Params(session_timeout_minutes=720)).fct_sessions


O.cte("int_events_sessionized_incremental", O.sessionized_sql(30, _INC_READ, _INC_OUT), "stg_events")


@register("int_events_sessionized_incremental", O.model("int_events_sessionized_incremental"))
def int_events_sessionized_incremental(spark, sf):
    return sessionize(_m(spark, sf).stg_events, _INC, incremental=True)


_CMP_COLS = "event_key, session_id, is_session_start, minutes_since_prev_event"


@register("compare_incremental_vs_full", O.oracle(f"""
(SELECT 'a_only' AS side, {_CMP_COLS} FROM full_slice
 EXCEPT ALL SELECT 'a_only' AS side, {_CMP_COLS} FROM int_events_sessionized_incremental)
UNION ALL
(SELECT 'b_only' AS side, {_CMP_COLS} FROM int_events_sessionized_incremental
 EXCEPT ALL SELECT 'b_only' AS side, {_CMP_COLS} FROM full_slice)""",
    "int_events_sessionized", "int_events_sessionized_incremental",
    extra={"full_slice": f"""SELECT * FROM int_events_sessionized
        WHERE event_date BETWEEN DATE '{_INC_OUT[0]}' AND DATE '{_INC_OUT[1]}'"""}))
def compare_incremental_vs_full(spark, sf):
    """X11 on T3: the incremental slice against the same days of a full build."""
    m = _m(spark, sf)
    cols = [c.strip() for c in _CMP_COLS.split(",")]
    full = m.int_events_sessionized.where(F.col("event_date").between(*_INC_OUT)).select(*cols)
    inc = sessionize(m.stg_events, _INC, incremental=True).select(*cols)
    return X.compare_relations(full, inc)


# ====================================================================== reporting extras
@register("product_margin", O.oracle(f"""
SELECT p.category_name, p.brand_name, count(*) AS order_item_count,
       cast(sum(i.net_revenue) AS decimal(38,9)) AS net_revenue,
       cast(sum(i.net_gross_profit) AS decimal(38,9)) AS net_gross_profit,
       {O.exact_rate('sum(i.net_gross_profit)', 'sum(i.net_revenue)')} AS net_margin_rate
FROM fct_order_items i JOIN dim_products p ON i.product_id = p.product_id
GROUP BY p.category_name, p.brand_name""", "fct_order_items", "dim_products"))
def product_margin(spark, sf):
    m = _m(spark, sf)
    return X.product_margin(m.fct_order_items, m.dim_products)


@register("incremental_overlap", O.oracle(f"""
SELECT user_id, event_key, event_at, event_type FROM (
  SELECT user_id, event_key, event_at, event_type,
         row_number() OVER (PARTITION BY user_id ORDER BY event_at DESC, event_key DESC) AS rn
  FROM stg_events
  WHERE user_id IS NOT NULL
    AND event_at >= TIMESTAMP '{OVERLAP_WATERMARK}' - INTERVAL {OVERLAP_DAYS} DAY
) r WHERE rn = 1""", "stg_events"))
def incremental_overlap(spark, sf):
    ev = _m(spark, sf).stg_events.where(F.col("user_id").isNotNull()).select(
        "user_id", "event_key", "event_at", "event_type")
    return X.overlap_increment(ev, "user_id", "event_at", OVERLAP_WATERMARK, OVERLAP_DAYS,
                               tiebreak=["event_key"])


_DEPTS = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")
_DEPT_LIST = ", ".join(f"'{d}'" for d in _DEPTS)


@register("revenue_pivot_department", O.oracle(
    "SELECT cast(date_trunc('month', ordered_date) AS date) AS ordered_month, "
    + ", ".join(f"cast(sum(CASE WHEN department_name = '{d}' THEN net_revenue END) AS decimal(38,9)) AS {d}"
                for d in _DEPTS)
    + ", cast(sum(CASE WHEN department_name IS NULL THEN net_revenue END) AS decimal(38,9)) AS unassigned"
    + f", cast(sum(CASE WHEN department_name NOT IN ({_DEPT_LIST}) THEN net_revenue END) AS decimal(38,9)) AS other"
    + " FROM daily_revenue GROUP BY 1", "daily_revenue"))
def revenue_pivot_department(spark, sf):
    """One column per department that the product dimension holds."""
    m = _m(spark, sf)
    daily = A.daily_revenue_base(m.fct_order_items, m.dim_products)
    return X.pivot_sum(daily.withColumn("ordered_month", F.trunc("ordered_date", "month")),
                       ["ordered_month"], "department_name", "net_revenue", X.pivot_names(m.dim_products, "department_name"))


@register("metric_total_revenue", O.oracle("""
SELECT cast(date_trunc('month', ordered_date) AS date) AS period_start,
       cast(sum(net_revenue) AS decimal(38,9)) AS total_revenue
FROM fct_orders GROUP BY 1""", "fct_orders"))
def metric_total_revenue(spark, sf):
    return X.metric(_m(spark, sf).fct_orders, "total_revenue", grain="month")


@register("channel_mapping", O.oracle(f"""
SELECT coalesce(s.channel, u.channel) AS channel, coalesce(s.session_count, 0) AS session_count,
       coalesce(u.user_count, 0) AS user_count
FROM (SELECT coalesce(m.channel, '(unmapped)') AS channel, count(*) AS session_count
      FROM fct_sessions f LEFT JOIN seed m
        ON m.vocabulary = 'events' AND m.source_value = f.entry_traffic_source
      GROUP BY 1) s
FULL OUTER JOIN
     (SELECT coalesce(m.channel, '(unmapped)') AS channel, count(*) AS user_count
      FROM dim_users d LEFT JOIN seed m
        ON m.vocabulary = 'users' AND m.source_value = d.acquisition_channel
      GROUP BY 1) u
  ON s.channel = u.channel""", "fct_sessions", "dim_users",
    extra={"seed": "SELECT * FROM (VALUES " + ", ".join(
        f"('{v}', '{s}', '{c}')" for v, s, c in X.CHANNEL_SEED_ROWS)
        + ") t(vocabulary, source_value, channel)"}))
def channel_mapping(spark, sf):
    m = _m(spark, sf)
    return X.channel_summary(m.fct_sessions, m.dim_users, X.read_channel_seed(spark))


# ====================================================================== declared checks (App. A)
def _check_oracle_sql() -> str:
    def model_of(name: str) -> str:
        return name

    parts = []
    for s in DECLARED_CHECKS:
        t = model_of(s.model)
        if s.kind == "not_null":
            q = f"SELECT count(*) FROM {t} WHERE {s.column} IS NULL"
        elif s.kind == "accepted_values":
            vals = ", ".join(f"'{v}'" for v in s.args)
            q = f"SELECT count(*) FROM {t} WHERE NOT ({s.column} IN ({vals}))"
        elif s.kind == "expression":
            q = f"SELECT count(*) FROM {t} WHERE NOT ({s.column} {s.args[0]})"
        elif s.kind in ("unique", "unique_combination"):
            cols = s.column if s.kind == "unique" else ", ".join(s.args)
            where = f" WHERE {s.column} IS NOT NULL" if s.kind == "unique" else ""
            q = f"SELECT count(*) FROM (SELECT {cols} FROM {t}{where} GROUP BY {cols} HAVING count(*) > 1) d"
        else:
            parent, field_ = s.args
            q = (f"SELECT count(*) FROM {t} c WHERE c.{s.column} IS NOT NULL AND NOT EXISTS "
                 f"(SELECT 1 FROM {parent} p WHERE p.{field_} = c.{s.column})")
        parts.append(f"SELECT '{s.name}' AS check_name, '{s.model}' AS model, '{s.kind}' AS kind, "
                     f"'{s.severity}' AS severity, cast(({q}) AS bigint) AS failures")
    needs = sorted({s.model for s in DECLARED_CHECKS} | {s.args[0] for s in DECLARED_CHECKS
                                                         if s.kind == "relationships"})
    return O.oracle("\nUNION ALL\n".join(parts), *needs)


@register("declared_check_counts", _check_oracle_sql())
def declared_check_counts(spark, sf):
    m = _models_with_history(spark, sf, shared=True)
    return Q.declared_check_counts(DECLARED_CHECKS, lambda name: getattr(m, name), SHARED_ROWS_IN)
