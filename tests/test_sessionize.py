"""Sessionization: the reference's unit test, boundary cases, skew-safe plan
against the single-window brute force, and incremental vs full (T2, T3)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from cartwheel.operators.sessionize import assign_sessions, sessionize
from cartwheel.params import Params
from cartwheel.plans.models import Models
from conftest import SF_SMALL, rows
from plain_forms import assign_sessions_single_window

COLS = ("event_key string, event_id long, user_id long, event_at timestamp, event_date date, "
        "event_type string, source_session_id string, traffic_source string, browser string, uri string")


def ev(spark, data):
    out = []
    for key, eid, user, ts in data:
        t = dt.datetime.fromisoformat(ts)
        out.append((key, eid, user, t, t.date(), "home", "s", "organic", "Chrome", "/"))
    return spark.createDataFrame(out, COLS)


def test_session_splits_on_inactivity_gap(spark):
    """Same fixed rows and expectations as the reference's unit test."""
    df = ev(spark, [("k1", 1, 1, "2026-01-01 10:00:00"), ("k2", 2, 1, "2026-01-01 10:20:00"),
                    ("k3", 3, 1, "2026-01-01 11:00:00"), ("k4", 4, 1, "2026-01-01 11:10:00"),
                    ("k5", 5, 2, "2026-01-01 10:05:00"), ("k6", 6, None, "2026-01-01 10:06:00")])
    out = sessionize(df, Params(run_date=dt.date(2026, 1, 1)))
    assert rows(out, "event_key", "event_id", "session_id", "is_session_start") == [
        ("k1", 1, "1-20260101100000", 1), ("k2", 2, "1-20260101100000", 0),
        ("k3", 3, "1-20260101110000", 1), ("k4", 4, "1-20260101110000", 0),
        ("k5", 5, "2-20260101100500", 1)]


def test_gap_boundaries_and_ties(spark):
    df = ev(spark, [
        ("a1", 1, 7, "2026-01-01 09:00:00"), ("a2", 2, 7, "2026-01-01 09:30:00"),   # exactly 30 min: same
        ("a3", 3, 7, "2026-01-01 10:00:59"),                                          # 30 min 59 s: same
        ("a4", 4, 7, "2026-01-01 10:32:00"),                                          # 31 min: new
        ("b2", 6, 7, "2026-01-01 10:32:00"), ("b1", 5, 7, "2026-01-01 10:32:00"),   # ties by key
        ("c1", 7, 7, "2026-01-01 23:50:00"), ("c2", 8, 7, "2026-01-02 00:10:00"),   # across midnight
    ])
    out = {r.event_key: r for r in sessionize(df).collect()}
    assert [out[k].is_session_start for k in ("a1", "a2", "a3", "a4")] == [1, 0, 0, 1]
    assert out["a4"].minutes_since_prev_event == 31
    # a4 < b1 < b2 by key at the same instant: gaps of 0, same session
    assert out["b1"].minutes_since_prev_event == 0 and out["b1"].is_session_start == 0
    assert out["b1"].session_id == out["a4"].session_id == "7-20260101103200"
    assert out["c2"].session_id == out["c1"].session_id == "7-20260101235000"


@pytest.mark.parametrize("timeout,bucket", [(30, 3600), (30, 60), (720, 3600), (1440, 600)])
def test_bucketed_plan_equals_single_window(spark, timeout, bucket):
    """The skew-safe (user, bucket) plan matches the one-window-per-user form on
    the whole sf0.01 events, for short and long timeouts and tiny buckets
    (sessions spanning many buckets)."""
    stg = Models(spark, SF_SMALL).stg_events.where(F.col("user_id").isNotNull())
    cols = ("event_key", "minutes_since_prev_event", "is_session_start", "session_started_at", "session_id")
    a = assign_sessions(stg, timeout, bucket)
    b = assign_sessions_single_window(stg, timeout)
    assert rows(a, *cols) == rows(b, *cols)


def test_hot_user_spans_many_buckets(spark):
    """One user with a dense stream (one event per minute for 3 days): one
    session, spread over 72 hourly buckets, identical to the brute force."""
    base = dt.datetime(2026, 3, 1)
    data = [(f"h{i:05d}", i, 42, (base + dt.timedelta(minutes=i)).isoformat(sep=" ")) for i in range(3 * 1440)]
    data += [("z1", 99999, 43, "2026-03-01 00:00:00")]
    df = ev(spark, data)
    a = assign_sessions(df, 30, 3600)
    assert a.where("user_id = 42").select("session_id").distinct().count() == 1
    cols = ("event_key", "session_id", "is_session_start")
    assert rows(a, *cols) == rows(assign_sessions_single_window(df, 30), *cols)


def test_incremental_slice_matches_full_at_default_timeout(spark):
    """Incremental reads one buffer day, outputs only the window; flags and
    session ids equal the full build's; only the first-in-slice gaps differ."""
    m = Models(spark, SF_SMALL)
    p = Params(run_date=dt.date(2024, 1, 17))
    inc = sessionize(m.stg_events, p, incremental=True)
    start, end = p.window()
    full = m.int_events_sessionized.where(F.col("event_date").between(start, end))
    assert inc.agg(F.min("event_date"), F.max("event_date")).first() == (start, end)
    cols = ("event_key", "is_session_start", "session_id")
    assert rows(inc, *cols) == rows(full, *cols)


def test_buffer_must_cover_timeout():
    with pytest.raises(ValueError):
        Params(session_timeout_minutes=2880, session_buffer_days=1)


def test_dense_hour_is_spread_over_its_minutes(spark):
    """One user with 200,000 events inside one hour: no bucket holds more than a sixtieth and a bit,
    and flags, starts and ids equal the one-window form."""
    n = 200_000
    df = (spark.range(0, n, 1, 8)
          .select(F.format_string("k%07d", "id").alias("event_key"), F.col("id").alias("event_id"), F.lit(42).cast("long").alias("user_id"),
                  F.timestamp_micros(F.lit(1767261600_000_000) + F.pmod(F.col("id") * 7919, F.lit(n)) * F.lit(3600_000_000 // n)).alias("event_at"))
          .withColumn("event_date", F.to_date("event_at")))
    p = Params(run_date=dt.date(2026, 1, 1))
    per_bucket = df.groupBy("user_id", F.floor(F.unix_seconds("event_at") / p.session_bucket_seconds)).count()
    assert per_bucket.agg(F.max("count")).first()[0] <= n / 60 * 1.05
    cols = ("event_key", "minutes_since_prev_event", "is_session_start", "session_id")
    a, b = assign_sessions(df, 30, p.session_bucket_seconds).select(*cols), assign_sessions_single_window(df, 30).select(*cols)
    assert a.exceptAll(b).isEmpty() and a.count() == n
