"""DuckDB oracle SQL for the correctness gate.

Each model is written again, independently, in DuckDB SQL as a named CTE;
``oracle(select, *ctes)`` assembles the WITH clause with every CTE the final
SELECT needs (dependencies first). Only the source adapter text is shared
with the Spark side, so both engines start from identical inputs.

DuckDB notes (see SURVEY T10): ``date_sub(unit, a, b)`` counts whole elapsed
units; ``epoch()`` is fractional, so floor before casting; decimal / decimal
is DOUBLE; ``arg_min`` skips NULL payloads, so ordered ``first()`` is used;
``count_if`` is HUGEINT, so counts are cast to BIGINT.
"""

from __future__ import annotations

from cartwheel.sources.adapter import RAW_INPUTS, duckdb_raw_cte

NULL_KEY = "'_dbt_utils_surrogate_key_null_'"


def sk(*exprs: str) -> str:
    parts = ", ".join(f"coalesce(cast({e} as varchar), {NULL_KEY})" for e in exprs)
    return f"md5(concat_ws('-', {parts}))"


def epoch_s(ts: str) -> str:
    return f"cast(floor(epoch({ts})) as bigint)"


def exact_rate(n: str, d: str, scale: int = 4) -> str:
    """round(n / d, scale) half away from zero, computed exactly.

    DuckDB divides decimals in DOUBLE, which misrounds exact ties such as
    190937.61 / 8 = 23867.20125. Both operands have at most nine fractional
    digits, so they are scaled to integers and rounded with integer division.
    Returns decimal(18, scale); NULL unless d > 0.
    """
    big_n = f"cast(cast(({n}) AS decimal(38,9)) * 1000000000 AS hugeint)"
    big_d = f"cast(cast(({d}) AS decimal(38,9)) * 1000000000 AS hugeint)"
    unit = 10 ** scale
    q = f"(sign({big_n}) * ((2 * abs({big_n}) * {unit} + {big_d}) // (2 * {big_d})))"
    return (f"CASE WHEN ({d}) > 0 THEN cast(cast({q} AS decimal(18,0)) * "
            f"cast(0.{'0' * (scale - 1)}1 AS decimal({scale + 1},{scale})) AS decimal(18,{scale})) END")


CTES: dict[str, tuple[str, tuple[str, ...]]] = {}


def cte(name: str, sql: str, *deps: str) -> None:
    CTES[name] = (sql, deps)


for _src in RAW_INPUTS:
    cte(f"raw_{_src}", duckdb_raw_cte(_src))

# ---------------------------------------------------------------- staging
cte("stg_orders", f"""
SELECT {sk('order_id', 'user_id', epoch_s('created_at'))} AS order_key,
       order_id, user_id, lower(status) AS order_status, lower(gender) AS user_gender_at_order,
       num_of_item AS item_count, created_at AS ordered_at, shipped_at, delivered_at, returned_at,
       cast(created_at AS date) AS ordered_date, cast(_ingested_at AS date) AS _load_generation,
       _ingested_at
FROM raw_orders""", "raw_orders")

cte("stg_order_items", f"""
SELECT {sk('id', 'order_id', epoch_s('created_at'))} AS order_item_key,
       id AS order_item_id, order_id, user_id, product_id, inventory_item_id,
       lower(status) AS order_item_status, cast(sale_price AS decimal(18,9)) AS sale_price,
       created_at AS ordered_at, shipped_at, delivered_at, returned_at,
       cast(created_at AS date) AS ordered_date, cast(_ingested_at AS date) AS _load_generation,
       _ingested_at
FROM raw_order_items""", "raw_order_items")

cte("stg_products", """
SELECT id AS product_id, name AS product_name, brand AS brand_name, category AS category_name,
       department AS department_name, sku, cast(cost AS decimal(18,9)) AS unit_cost,
       cast(retail_price AS decimal(18,9)) AS retail_price, distribution_center_id, _ingested_at
FROM raw_products""", "raw_products")

cte("stg_users", """
SELECT id AS user_id, first_name, last_name, email, age, lower(gender) AS gender, city, state,
       postal_code, country, lower(traffic_source) AS acquisition_channel,
       created_at AS signed_up_at, cast(created_at AS date) AS signed_up_date, _ingested_at
FROM raw_users""", "raw_users")

cte("stg_events", f"""
SELECT {sk('id', 'session_id', epoch_s('created_at'))} AS event_key,
       id AS event_id, user_id, session_id AS source_session_id, sequence_number,
       lower(event_type) AS event_type, lower(traffic_source) AS traffic_source, browser, uri,
       city, state, postal_code, ip_address, created_at AS event_at,
       cast(created_at AS date) AS event_date, cast(_ingested_at AS date) AS _load_generation,
       _ingested_at
FROM raw_events""", "raw_events")

cte("stg_inventory_items", """
SELECT id AS inventory_item_id, product_id, cast(cost AS decimal(18,9)) AS unit_cost,
       created_at AS stocked_at, sold_at, cast(created_at AS date) AS stocked_date,
       product_distribution_center_id AS distribution_center_id, _ingested_at
FROM raw_inventory_items""", "raw_inventory_items")

cte("stg_distribution_centers", """
SELECT id AS distribution_center_id, name AS distribution_center_name, latitude, longitude,
       _ingested_at
FROM raw_distribution_centers""", "raw_distribution_centers")

# ---------------------------------------------------------------- intermediate
cte("int_order_items_enriched", f"""
SELECT oi.order_item_key, o.order_key, oi.order_item_id, oi.order_id, oi.user_id, oi.product_id,
       oi.inventory_item_id, oi.order_item_status, o.order_status, o.item_count AS order_item_count,
       p.product_name, p.brand_name, p.category_name, p.department_name, p.distribution_center_id,
       oi.sale_price, p.unit_cost, p.retail_price,
       cast(oi.sale_price - p.unit_cost AS decimal(18,9)) AS gross_profit,
       {exact_rate('p.retail_price - oi.sale_price', 'p.retail_price')} AS discount_rate,
       oi.order_item_status NOT IN ('cancelled', 'returned') AS is_revenue_recognized,
       oi.ordered_at, oi.ordered_date, oi._load_generation, oi.shipped_at, oi.delivered_at,
       oi.returned_at
FROM stg_order_items oi
LEFT JOIN stg_orders o ON oi.order_id = o.order_id AND oi._load_generation = o._load_generation
LEFT JOIN stg_products p ON oi.product_id = p.product_id""",
    "stg_order_items", "stg_orders", "stg_products")


def sessionized_sql(timeout: int = 30, read_window: tuple[str, str] | None = None,
                    out_window: tuple[str, str] | None = None) -> str:
    """Sessionization in one window per user (the textbook form)."""
    read = (f" AND event_date BETWEEN DATE '{read_window[0]}' AND DATE '{read_window[1]}'"
            if read_window else "")
    out = (f" WHERE event_date BETWEEN DATE '{out_window[0]}' AND DATE '{out_window[1]}'"
           if out_window else "")
    return f"""
SELECT event_key, event_id, user_id,
       cast(user_id AS varchar) || '-' || strftime(session_started_at, '%Y%m%d%H%M%S') AS session_id,
       session_started_at, source_session_id, is_session_start, minutes_since_prev_event,
       event_type, traffic_source, browser, uri, event_at, event_date
FROM (
  SELECT *, last_value(CASE WHEN is_session_start = 1 THEN event_at END IGNORE NULLS) OVER (
              PARTITION BY user_id ORDER BY event_at, event_key
              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS session_started_at
  FROM (
    SELECT *, CAST(CASE WHEN minutes_since_prev_event IS NULL THEN 1
                        WHEN minutes_since_prev_event > {timeout} THEN 1 ELSE 0 END AS INTEGER)
              AS is_session_start
    FROM (
      SELECT event_key, event_id, user_id, source_session_id, event_type, traffic_source, browser,
             uri, event_at, event_date,
             date_sub('minute', lag(event_at) OVER (PARTITION BY user_id ORDER BY event_at, event_key),
                      event_at) AS minutes_since_prev_event
      FROM stg_events WHERE user_id IS NOT NULL{read}
    ) g
  ) f
) s{out}"""


cte("int_events_sessionized", sessionized_sql(30), "stg_events")

# ---------------------------------------------------------------- core
cte("dim_distribution_centers", """
SELECT distribution_center_id, distribution_center_name, latitude, longitude
FROM stg_distribution_centers""", "stg_distribution_centers")

cte("dim_products", f"""
SELECT p.product_id, p.product_name, p.brand_name, p.category_name, p.department_name, p.sku,
       p.unit_cost, p.retail_price,
       {exact_rate('p.retail_price - p.unit_cost', 'p.retail_price')} AS list_margin_rate,
       p.distribution_center_id, dc.distribution_center_name
FROM stg_products p
LEFT JOIN stg_distribution_centers dc ON p.distribution_center_id = dc.distribution_center_id""",
    "stg_products", "stg_distribution_centers")

cte("dim_users", """
SELECT user_id, sha256(lower(trim(email))) AS email_hash,
       lower(CASE WHEN len(string_split(email, '@')) >= 2 THEN string_split(email, '@')[2] END)
           AS email_domain,
       age,
       CASE WHEN age < 20 THEN '10s' WHEN age < 30 THEN '20s' WHEN age < 40 THEN '30s'
            WHEN age < 50 THEN '40s' WHEN age < 60 THEN '50s' ELSE '60s+' END AS age_group,
       gender, city, state, country, postal_code, acquisition_channel, signed_up_at,
       signed_up_date, cast(date_trunc('month', signed_up_date) AS date) AS signup_cohort_month
FROM stg_users""", "stg_users")

cte("fct_order_items", """
SELECT order_item_key, order_key, order_item_id, order_id, user_id, product_id,
       distribution_center_id, order_item_status, order_status, sale_price, unit_cost,
       gross_profit, discount_rate, is_revenue_recognized,
       cast(CASE WHEN is_revenue_recognized THEN sale_price ELSE 0 END AS decimal(18,9)) AS net_revenue,
       cast(CASE WHEN is_revenue_recognized THEN gross_profit ELSE 0 END AS decimal(18,9))
           AS net_gross_profit,
       ordered_at, ordered_date, shipped_at, delivered_at, returned_at,
       cast(date_diff('day', ordered_date, cast(shipped_at AS date)) AS bigint) AS days_to_ship,
       cast(date_diff('day', ordered_date, cast(delivered_at AS date)) AS bigint) AS days_to_deliver
FROM int_order_items_enriched""", "int_order_items_enriched")

cte("order_item_rollup", """
SELECT order_key,
       count(*) AS line_item_count,
       count(DISTINCT product_id) AS distinct_product_count,
       cast(sum(sale_price) AS decimal(38,9)) AS gross_revenue,
       cast(sum(CASE WHEN is_revenue_recognized THEN sale_price ELSE 0 END) AS decimal(38,9))
           AS net_revenue,
       cast(sum(CASE WHEN is_revenue_recognized THEN gross_profit ELSE 0 END) AS decimal(38,9))
           AS net_gross_profit,
       cast(count_if(order_item_status = 'returned') AS bigint) AS returned_item_count,
       cast(count_if(order_item_status = 'cancelled') AS bigint) AS cancelled_item_count
FROM int_order_items_enriched
WHERE order_key IS NOT NULL
GROUP BY order_key""", "int_order_items_enriched")

cte("fct_orders", f"""
SELECT o.order_key, o.order_id, o.user_id, o.order_status, o.user_gender_at_order,
       o.item_count AS source_item_count, r.line_item_count, r.distinct_product_count,
       r.gross_revenue, r.net_revenue, r.net_gross_profit, r.returned_item_count,
       r.cancelled_item_count,
       {exact_rate('r.net_revenue', 'r.line_item_count')} AS net_revenue_per_item,
       o.ordered_at, o.ordered_date, o.shipped_at, o.delivered_at, o.returned_at
FROM stg_orders o LEFT JOIN order_item_rollup r ON o.order_key = r.order_key""",
    "stg_orders", "order_item_rollup")

def sessions_sql(source: str) -> str:
    return f"""
SELECT session_id, user_id, session_started_at, session_ended_at,
       cast(session_started_at AS date) AS session_date,
       date_sub('second', session_started_at, session_ended_at) AS session_duration_seconds,
       event_count, distinct_event_type_count, entry_traffic_source, entry_uri, browser,
       viewed_product, added_to_cart, purchased, cancelled, event_count = 1 AS is_bounce,
       source_session_id_count
FROM (
  SELECT session_id, user_id,
         min(event_at) AS session_started_at, max(event_at) AS session_ended_at,
         count(*) AS event_count, count(DISTINCT event_type) AS distinct_event_type_count,
         first(traffic_source ORDER BY event_at, event_key) AS entry_traffic_source,
         first(uri ORDER BY event_at, event_key) AS entry_uri,
         first(browser ORDER BY event_at, event_key) AS browser,
         count_if(event_type = 'product') > 0 AS viewed_product,
         count_if(event_type = 'cart') > 0 AS added_to_cart,
         count_if(event_type = 'purchase') > 0 AS purchased,
         count_if(event_type = 'cancel') > 0 AS cancelled,
         count(DISTINCT source_session_id) AS source_session_id_count
  FROM {source}
  GROUP BY session_id, user_id
) r"""


cte("fct_sessions", sessions_sql("int_events_sessionized"), "int_events_sessionized")

cte("fct_user_events", """
SELECT event_key, event_id, user_id, session_id, event_type, traffic_source, browser, uri,
       source_session_id, is_session_start, minutes_since_prev_event, event_at, event_date
FROM int_events_sessionized""", "int_events_sessionized")

# ---------------------------------------------------------------- reporting
cte("daily_revenue", """
SELECT oi.ordered_date, p.department_name,
       count(DISTINCT oi.order_key) AS order_count,
       count(*) AS order_item_count,
       count(DISTINCT oi.user_id) AS buyer_count,
       cast(sum(oi.net_revenue) AS decimal(38,9)) AS net_revenue,
       cast(sum(oi.net_gross_profit) AS decimal(38,9)) AS net_gross_profit,
       cast(count_if(oi.order_item_status = 'returned') AS bigint) AS returned_item_count
FROM fct_order_items oi
JOIN dim_products p ON oi.product_id = p.product_id
WHERE p.department_name IS NOT NULL
GROUP BY oi.ordered_date, p.department_name""", "fct_order_items", "dim_products")

cte("rpt_daily_revenue", f"""
SELECT c.ordered_date, c.department_name, c.order_count, c.order_item_count, c.buyer_count,
       c.returned_item_count, c.net_revenue, c.net_gross_profit,
       c.net_revenue_wtd, c.net_revenue_mtd, c.net_revenue_ytd,
       py.net_revenue AS net_revenue_yoy_base,
       {exact_rate('c.net_revenue - py.net_revenue', 'py.net_revenue')} AS net_revenue_yoy_rate
FROM (
  SELECT *,
    cast(sum(net_revenue) OVER (PARTITION BY department_name, date_trunc('week', ordered_date)
         ORDER BY ordered_date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS decimal(38,9))
         AS net_revenue_wtd,
    cast(sum(net_revenue) OVER (PARTITION BY department_name, date_trunc('month', ordered_date)
         ORDER BY ordered_date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS decimal(38,9))
         AS net_revenue_mtd,
    cast(sum(net_revenue) OVER (PARTITION BY department_name, date_trunc('year', ordered_date)
         ORDER BY ordered_date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS decimal(38,9))
         AS net_revenue_ytd
  FROM daily_revenue
) c
LEFT JOIN daily_revenue py
  ON c.department_name = py.department_name
 AND py.ordered_date = cast(c.ordered_date - INTERVAL 1 YEAR AS date)""", "daily_revenue")

cte("rpt_daily_funnel", """
SELECT session_date, entry_traffic_source, session_count, user_count, product_view_sessions,
       cart_sessions, purchase_sessions, bounce_sessions, avg_session_seconds,
       avg_events_per_session,
       round(cast(product_view_sessions AS double) / nullif(session_count, 0), 4) AS cvr_session_to_product,
       round(cast(cart_sessions AS double) / nullif(session_count, 0), 4) AS cvr_session_to_cart,
       round(cast(purchase_sessions AS double) / nullif(session_count, 0), 4) AS cvr_session_to_purchase,
       round(cast(cart_sessions AS double) / nullif(product_view_sessions, 0), 4) AS cvr_product_to_cart,
       round(cast(purchase_sessions AS double) / nullif(cart_sessions, 0), 4) AS cvr_cart_to_purchase,
       round(cast(bounce_sessions AS double) / nullif(session_count, 0), 4) AS bounce_rate
FROM (
  SELECT session_date, coalesce(entry_traffic_source, '(unknown)') AS entry_traffic_source,
         count(*) AS session_count, count(DISTINCT user_id) AS user_count,
         cast(count_if(viewed_product) AS bigint) AS product_view_sessions,
         cast(count_if(added_to_cart) AS bigint) AS cart_sessions,
         cast(count_if(purchased) AS bigint) AS purchase_sessions,
         cast(count_if(is_bounce) AS bigint) AS bounce_sessions,
         round(avg(session_duration_seconds), 1) AS avg_session_seconds,
         round(avg(event_count), 2) AS avg_events_per_session
  FROM fct_sessions
  GROUP BY session_date, coalesce(entry_traffic_source, '(unknown)')
) d""", "fct_sessions")

cte("cohort_size", """
SELECT signup_cohort_month, count(*) AS cohort_user_count
FROM dim_users GROUP BY signup_cohort_month""", "dim_users")

cte("purchase_months", """
SELECT DISTINCT o.user_id, u.signup_cohort_month,
       cast(date_trunc('month', o.ordered_date) AS date) AS activity_month
FROM fct_orders o JOIN dim_users u ON o.user_id = u.user_id
WHERE o.net_revenue > 0""", "fct_orders", "dim_users")

cte("retention", """
SELECT signup_cohort_month, activity_month,
       cast(date_diff('month', signup_cohort_month, activity_month) AS integer) AS months_since_signup,
       count(DISTINCT user_id) AS retained_user_count
FROM purchase_months
WHERE activity_month >= signup_cohort_month
GROUP BY signup_cohort_month, activity_month""", "purchase_months")

cte("rpt_user_cohort_retention", """
SELECT r.signup_cohort_month, r.activity_month, r.months_since_signup, c.cohort_user_count,
       r.retained_user_count,
       round(cast(r.retained_user_count AS double) / nullif(c.cohort_user_count, 0), 4) AS retention_rate
FROM retention r JOIN cohort_size c ON r.signup_cohort_month = c.signup_cohort_month""",
    "retention", "cohort_size")

cte("daily_order_count", """
SELECT ordered_date, count(*) AS order_count FROM fct_orders GROUP BY ordered_date""", "fct_orders")


def _order(names: tuple[str, ...]) -> list[str]:
    seen: list[str] = []

    def visit(n: str) -> None:
        if n in seen:
            return
        for d in CTES[n][1]:
            visit(d)
        seen.append(n)

    for n in names:
        visit(n)
    return seen


def oracle(select: str, *needs: str, extra: dict[str, str] | None = None) -> str:
    """WITH <needed CTEs in dependency order> <select>.

    ``extra`` adds ad-hoc CTEs (name → SQL) placed after the registered ones.
    """
    parts = [f"{n} AS ({CTES[n][0]}\n)" for n in _order(needs)]
    parts += [f"{n} AS ({sql}\n)" for n, sql in (extra or {}).items()]
    with_clause = ("WITH " + ",\n".join(parts) + "\n") if parts else ""
    return with_clause + select.strip()


def model(name: str) -> str:
    """Oracle for a registered model: SELECT * FROM <name>."""
    return oracle(f"SELECT * FROM {name}", name)
