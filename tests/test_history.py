"""Type-2 history over three runs, rerun no-op, disjoint intervals, as-of join,
timestamp strategy, keyed updates, daily state."""

import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from cartwheel.operators.history import (apply_keyed_updates, dim_products_history, expand_history,
                                         latest_per_key, scd2_apply)
from cartwheel.operators.joins import asof_join
from conftest import rows
from plain_forms import window_latest_per_key

S = "id long, name string, brand string, category string, department string, sku string, " \
    "cost double, retail_price double, distribution_center_id long"
CHECK = ("retail_price", "cost", "name", "brand", "category", "department", "distribution_center_id")
T1, T2, T3 = "2026-01-01 00:00:00", "2026-01-02 00:00:00", "2026-01-03 00:00:00"


def p(i, price=10.0, sku=None):
    return (i, f"n{i}", "b", "c", "Men", sku or f"s{i}", 5.0, price, 1)


def test_three_runs(spark):
    run1 = spark.createDataFrame([p(1), p(2), p(3)], S)
    run2 = spark.createDataFrame([p(1, 12.0), p(2, sku="changed"), p(3)], S)
    run3 = spark.createDataFrame([p(1, 12.0), p(2, sku="changed"), p(4)], S)
    run4 = spark.createDataFrame([p(1, 12.0), p(2, sku="changed"), p(3), p(4)], S)
    h = scd2_apply(None, run1, "id", T1, CHECK)
    h = scd2_apply(h, run2, "id", T2, CHECK)
    h = scd2_apply(h, run3, "id", T3, CHECK)
    h = scd2_apply(h, run4, "id", "2026-01-04 00:00:00", CHECK)
    got = rows(h, "id", "retail_price", "sku", "_valid_from", "_valid_to")
    ts = lambda s: dt.datetime.fromisoformat(s)
    assert got == sorted([
        (1, 10.0, "s1", ts(T1), ts(T2)), (1, 12.0, "s1", ts(T2), None),   # price change
        (2, 10.0, "s2", ts(T1), None),                                     # sku not tracked (T13)
        (3, 10.0, "s3", ts(T1), ts(T3)),                                   # vanished → closed
        (3, 10.0, "s3", ts("2026-01-04 00:00:00"), None),                  # returned → reopened
        (4, 10.0, "s4", ts(T3), None),
    ], key=repr)
    # rerun with the same state and ts is a no-op
    again = scd2_apply(h, run4, "id", "2026-01-04 00:00:00", CHECK)
    assert rows(again) == rows(h)
    # intervals per key are disjoint and at most one is open
    w = Window.partitionBy("id").orderBy("_valid_from")
    chk = h.withColumn("next_from", F.lead("_valid_from").over(w))
    assert chk.where("_valid_to IS NULL AND next_from IS NOT NULL").count() == 0
    assert chk.where("next_from < _valid_to").count() == 0
    dim = dim_products_history(h)
    assert dim.where("is_current").count() == 4
    assert dim.select("product_history_key").distinct().count() == dim.count()


def test_timestamp_strategy(spark):
    s = "id long, v string, updated_at timestamp"
    h = scd2_apply(None, spark.createDataFrame([(1, "a", dt.datetime(2026, 1, 1))], s), "id", T1,
                   strategy="timestamp", updated_at="updated_at")
    h2 = scd2_apply(h, spark.createDataFrame([(1, "b", dt.datetime(2026, 1, 5))], s), "id", T2,
                    strategy="timestamp", updated_at="updated_at")
    got = rows(h2, "v", "_valid_from", "_valid_to")
    assert got == [("a", dt.datetime(2026, 1, 1), dt.datetime(2026, 1, 5)),
                   ("b", dt.datetime(2026, 1, 5), None)]


def test_asof_join_half_open_interval_never_multiplies(spark):
    hist = spark.createDataFrame([
        (1, "v1", dt.datetime(2026, 1, 1), dt.datetime(2026, 1, 10)),
        (1, "v2", dt.datetime(2026, 1, 10), None)],
        "product_id long, version string, valid_from timestamp, valid_to timestamp")
    facts = spark.createDataFrame([
        ("before", 1, dt.datetime(2025, 12, 31)), ("start", 1, dt.datetime(2026, 1, 1)),
        ("inside", 1, dt.datetime(2026, 1, 5)), ("boundary", 1, dt.datetime(2026, 1, 10)),
        ("after", 1, dt.datetime(2027, 1, 1)), ("other", 2, dt.datetime(2026, 1, 5))],
        "f string, product_id long, ts timestamp")
    out = asof_join(facts, hist, "product_id", "ts")
    assert out.count() == facts.count()
    assert dict(rows(out, "f", "version")) == {
        "before": None, "start": "v1", "inside": "v1", "boundary": "v2", "after": "v2", "other": None}


def test_keyed_update_and_latest_per_key(spark):
    df = spark.createDataFrame([(1, 10.0), (2, 20.0), (3, 30.0)], "id long, price double")
    upd = spark.createDataFrame([(2, 25.0), (9, 1.0)], "id long, price double")
    assert rows(apply_keyed_updates(df, upd, "id", ["price"])) == [(1, 10.0), (2, 25.0), (3, 30.0)]
    ev = spark.createDataFrame([(1, 1, "a"), (1, 3, "c"), (1, 2, "b"), (2, 5, "x")], "k long, t long, v string")
    assert rows(latest_per_key(ev, "k", ["t"])) == rows(window_latest_per_key(ev, "k", ["t"]))


def test_expand_history(spark):
    h = spark.createDataFrame([
        (1, dt.datetime(2026, 1, 1, 12), dt.datetime(2026, 1, 3, 6)),
        (1, dt.datetime(2026, 1, 3, 6), None)], "product_id long, valid_from timestamp, valid_to timestamp")
    got = rows(expand_history(h, "2026-01-01", "2026-01-04"), "snapshot_date", "valid_from")
    assert [(str(a), b.day) for a, b in got] == [
        ("2026-01-01", 1), ("2026-01-02", 1), ("2026-01-03", 3), ("2026-01-04", 3)]


def test_asof_join_many_versions_and_a_hot_key(spark):
    """A product with 10,000 versions, several a day, and most facts: equal to the plain range join, each fact once."""
    t0 = 1_700_000_000
    hist = (spark.range(10_000).select(F.lit(1).cast("long").alias("product_id"), F.col("id").alias("version"),
                                       F.timestamp_seconds(F.lit(t0) + F.col("id") * 20_000).alias("valid_from"),
                                       F.when(F.col("id") < 9_999, F.timestamp_seconds(F.lit(t0) + (F.col("id") + 1) * 20_000)).alias("valid_to"))
            # a product with a gap between its versions, one whose first version is late, one without any
            .unionByName(spark.createDataFrame([(2, 1, dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)), (2, 2, dt.datetime(2024, 3, 1), None),
                                                (3, 1, dt.datetime(2030, 1, 1), None)],
                                               "product_id long, version long, valid_from timestamp, valid_to timestamp")))
    facts = spark.range(0, 20_000, 1, 4).select(
        F.col("id").alias("f"), F.when(F.col("id") % 50 == 0, F.lit(None)).when(F.col("id") % 10 < 7, 1).otherwise(2 + F.col("id") % 3).cast("long").alias("product_id"),
        F.when(F.col("id") % 97 != 0, F.timestamp_seconds(F.lit(t0 - 50_000) + F.pmod(F.col("id") * 7919, F.lit(20_000)) * 10_001)).alias("ts"))
    got = asof_join(facts, hist, "product_id", "ts")
    plain = facts.alias("a").join(hist.alias("h"), (F.col("a.product_id") == F.col("h.product_id")) & (F.col("ts") >= F.col("valid_from"))
                                  & (F.col("valid_to").isNull() | (F.col("ts") < F.col("valid_to"))), "left").select("f", "version", "valid_from", "valid_to")
    mine = got.select("f", "version", "valid_from", "valid_to")
    assert got.count() == 20_000 and mine.exceptAll(plain).isEmpty() and plain.exceptAll(mine).isEmpty()
    inner = asof_join(facts, hist, "product_id", "ts", how="inner")
    assert inner.count() == plain.where("version is not null").count() > 10_000
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "valid_from" not in plan.split("Join")[1].split("\n")[0]  # no range test inside a join
