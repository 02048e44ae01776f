"""Models that one plan reads together: the same rows, with what they read in common moved once."""

import datetime as dt
import re

from pyspark.sql import functions as F

from cartwheel.functions.exprs import key_from_parts, key_of_parts, surrogate_key
from cartwheel.operators.joins import dealt_once, join_near
from cartwheel.operators.rollups import daily_revenue_base, session_rollup
from cartwheel.plans.models import Models
from cartwheel.plans.queries_ops import declared_check_counts
from conftest import SF_SMALL, SF_SMOKE, rows
from test_plans import no_broadcast, plan


def test_shared_models_hold_the_same_rows(spark):
    own, shared = Models(spark, SF_SMOKE), Models(spark, SF_SMOKE, shared=True)
    for name in ("stg_order_items", "int_order_items_enriched", "fct_order_items", "fct_orders", "int_events_sessionized", "fct_user_events",
                 "fct_sessions", "rpt_daily_revenue", "rpt_daily_funnel", "rpt_user_cohort_retention"):
        a, b = getattr(own, name), getattr(shared, name).drop("_is_line")
        assert [(f.name, f.dataType) for f in a.schema] == [(f.name, f.dataType) for f in b.schema], name
        assert rows(a) == rows(b), name


def test_one_row_of_each_line_is_marked_whatever_repeats(spark):
    """Lines read from the enriched rows are the staged lines, with repeated and null headers, products and lines."""
    from cartwheel.plans.intermediate import int_order_items_enriched
    day = lambda d: dt.date(2026, 8, d)
    null = lambda kind, *names: [F.lit(None).cast(kind).alias(n) for n in names]
    items = spark.createDataFrame([("a", 1, 1, day(17)), ("a", 1, 1, day(17)), ("b", 1, 2, day(18)), ("c", 2, 1, None), ("d", None, 1, day(17)), ("e", None, None, day(17)), (None, 3, 9, day(17))],
                                  "order_item_key string, order_id long, product_id long, _load_generation date").select(
        "*", *null("long", "order_item_id", "user_id", "inventory_item_id"), *null("string", "order_item_status"), *null("decimal(18,9)", "sale_price"),
        *null("date", "ordered_date"), *null("timestamp", "ordered_at", "shipped_at", "delivered_at", "returned_at"))
    heads = spark.createDataFrame([("h", 1, day(17)), ("h", 1, day(17)), ("i", 1, day(18)), ("j", 2, None), ("k", None, day(17)), ("l", 3, day(17))], "order_key string, order_id long, _load_generation date").select(
        "*", *null("string", "order_status"), *null("long", "item_count"))
    goods = spark.createDataFrame([(1,), (1,), (1,), (2,), (None,)], "product_id long").select(
        "product_id", *null("long", "distribution_center_id"), *null("decimal(18,9)", "unit_cost", "retail_price"), *null("string", "product_name", "brand_name", "category_name", "department_name"))
    cols = ("order_item_key", "order_id", "product_id", "order_key")
    own, shared = int_order_items_enriched(items, heads, goods), int_order_items_enriched(items, heads, goods, shared=True)
    assert rows(shared, *cols) == rows(own, *cols) and own.count() == 2 * 2 * 3 + 1 + 3 + 3 + 1 + 1
    assert rows(shared.where("_is_line"), *cols[:3]) == rows(items, *cols[:3])


def test_join_near_equals_a_join_whatever_repeats_or_is_null(spark):
    lines = spark.createDataFrame([(o, p, i) for i, (o, p) in enumerate([(1, 1), (1, 1), (1, 2), (2, 1), (2, 9), (None, 1), (None, 1), (None, 2), (3, None), (None, None)])],
                                  "o long, p long, i long").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "o")
    dim = spark.createDataFrame([(1, "a", None), (2, "b", 1), (2, "b", 1), (2, None, 2), (None, "n", 3), (7, "x", 4)], "p long, s string, n long")
    for how in ("left", "inner"):
        near = join_near(lines, dim, "p", "o", how)
        assert rows(near, "o", "p", "i", "s", "n") == rows(lines.join(dim, "p", how), "o", "p", "i", "s", "n"), how
        more = lines.select("o", "p").union(spark.createDataFrame([(8, 1), (None, 7), (9, None)], "o long, p long"))
        given = join_near(lines, dim, "p", "o", how, pairs=more, copy="c")
        assert rows(given.drop("c"), "o", "p", "i", "s", "n") == rows(near, "o", "p", "i", "s", "n")
        assert sorted(r.c for r in given.where("i = 2").collect()) == [0, 1, 2]
    with no_broadcast(spark):
        p = plan(join_near(lines, dim, "p", "o"))
    dealt = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", p)
    assert not [e for e in dealt if e.startswith("o#") and ", p#" in e], dealt    # lines are not dealt anew


def test_dealt_once_keeps_rows_and_columns(spark):
    df = spark.createDataFrame([(1, "a", None, 2.0), (None, None, 3, None), (1, "a", None, 2.0)], "k long, s string, n long, d double")
    out = dealt_once(df, ["k"], ["s", "n"])
    assert out.columns == df.columns and rows(out) == rows(df)


def test_readers_of_a_dealt_frame_share_its_exchange(spark):
    df = dealt_once(spark.read.parquet(f"{SF_SMALL}/lineitem.parquet"), ["l_orderkey"], ["l_partkey", "l_shipdate"])
    a = df.where("l_partkey > 3").select("l_orderkey", F.lit(1).alias("n"))
    b = df.where("l_orderkey is not null").groupBy("l_orderkey").agg(F.count("l_shipdate").alias("n"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        p = plan(a.union(b))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert p.count("FileScan parquet") == 1 and "ReusedExchange" in p


def test_declared_checks_deal_lines_and_events_once(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # exchanges are then reused in the plan already
    try:
        with no_broadcast(spark):
            p = plan(declared_check_counts(spark, SF_SMALL))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    scans = lambda table, column: len(re.findall(rf"FileScan parquet \S*\[[^\]]*{column}[^\]]*\][^\n]*{table}", p))
    dealt = [e for e in re.findall(r"(?<!Reused)Exchange hashpartitioning\(([^)]*)\)", p)]
    assert scans("lineitem.parquet", "l_linenumber") == 2        # the order items and the inventory items
    assert scans("orders.parquet", "o_orderkey") <= 2 and scans("events.parquet", "event_id") == 2
    assert not [e for e in dealt if e.startswith("order_id") and "product_id" in e], dealt
    assert not [e for e in dealt if e.startswith("ordered_date") and "user_id" in e], dealt   # no check asks for buyers


def test_sums_apart_equal_sums_with_the_orders(spark):
    day = dt.date(2024, 1, 1)
    items = spark.createDataFrame(
        [(day, 1, "k1", 7, 1, "returned"), (day, 1, "k1", 8, 2, "complete"), (day, 2, None, None, 4, None), (None, 1, "k2", 7, 8, "complete"),
         (None, 2, "k2", 7, 16, "complete"), (day, 9, "k3", 7, 32, "complete"), (day, None, "k4", 7, 64, "complete"), (day, 3, "k5", 7, 128, "complete")],
        "ordered_date date, product_id long, order_key string, user_id long, v long, order_item_status string").select(
        "*", F.col("v").cast("decimal(18,9)").alias("net_revenue"), (F.col("v") / 2).cast("decimal(18,9)").alias("net_gross_profit"), F.hash("order_key").cast("long").alias("order_id"))
    products = spark.createDataFrame([(1, "Men"), (2, "Women"), (2, "Men"), (3, None)], "product_id long, department_name string")
    a, b = daily_revenue_base(items, products), daily_revenue_base(items, products, items)
    assert a.columns == b.columns and rows(a) == rows(b) and a.count() == 4
    assert "buyers" not in plan(b.select("ordered_date", "net_revenue"))


def test_sessions_grouped_once_equal_sessions_grouped_by_source(spark):
    at = lambda m: dt.datetime(2024, 1, 1, 0, m)
    df = spark.createDataFrame(
        [("s", 1, "x", at(1), "b", "product", "email", "/1", "Chrome"), ("s", 1, "y", at(1), "a", "cart", None, "/2", None), ("s", 1, "y", at(2), "c", None, "email", "/3", "Safari"),
         ("s", 1, None, at(3), "d", "purchase", "organic", "/4", "Safari"), ("t", 2, None, at(0), "e", None, None, None, None), (None, 3, "z", None, None, "cancel", "email", "/5", "Chrome")],
        "session_id string, user_id long, source_session_id string, event_at timestamp, event_key string, event_type string, traffic_source string, uri string, browser string")
    a, b = session_rollup(df), session_rollup(df, sources_as_set=True)
    cols = sorted(a.columns)
    assert sorted(b.columns) == cols and rows(a, *cols) == rows(b, *cols)


def test_keys_are_made_from_their_parts_unless_they_differ(spark):
    df = spark.createDataFrame([(1, 2, None), (None, 3, None), (4, 5, "own"), (6, 7, None)], "a long, b long, t string")
    df = df.withColumn("k", F.when(F.col("a") == 6, None).otherwise(F.coalesce("t", surrogate_key("a", "b"))))
    out = df.withColumn("p", key_from_parts("k", "a", "b")).withColumn("again", key_of_parts("p", "a", "b")).collect()
    assert all(r.k == r.again for r in out) and [r.p.text for r in out] == [None, None, "own", None]
