"""Streaming form of the lookback re-processing: two arrivals (the second with
a late event) give the same sessions as one full batch build."""

import datetime as dt

from pyspark.sql import functions as F

from cartwheel.params import Params
from cartwheel.plans.intermediate import int_events_sessionized
from cartwheel.plans.staging import stg_events
from cartwheel.sources.adapter import raw_source
from cartwheel.streaming.sessions import day_ranges, start_sessionization_stream
from conftest import SF_SMOKE, rows

COLS = ("event_key", "session_id", "is_session_start", "event_date")


def arrivals(spark, tmp_path, raw, parts):
    """The target after each part has landed and the stream has run, and a full batch build."""
    landing, target, ckpt = (str(tmp_path / n) for n in ("landing", "sessions", "ckpt"))
    params = Params(run_date=dt.date(2024, 1, 30))
    for i, part in enumerate(parts):
        part.write.parquet(f"{landing}/batch={i}")
        start_sessionization_stream(spark, landing, raw.schema, target, ckpt, params).awaitTermination()
    return rows(spark.read.parquet(target), *COLS), rows(int_events_sessionized(stg_events(raw), params), *COLS)


def test_stream_matches_batch(spark, tmp_path):
    raw = raw_source(spark, SF_SMOKE, "events")
    d = F.to_date("created_at")
    early = raw.where(d < "2024-01-16")
    late = raw.where(d == "2024-01-03").limit(5)
    rest = raw.where(d >= "2024-01-16").unionByName(late)
    got, full = arrivals(spark, tmp_path, raw, [early.exceptAll(late), rest])
    assert got == full


def test_late_event_moves_the_next_days_session(spark, tmp_path):
    """A late 23:50 event joins the next day's 00:05 and 00:20 events to its own session."""
    raw = raw_source(spark, SF_SMOKE, "events")
    one = raw.limit(1)

    def event(i, at):
        at = F.lit(at).cast(raw.schema["created_at"].dataType)
        return one.withColumn("id", F.lit(i).cast(raw.schema["id"].dataType)).withColumn("created_at", at) \
            .withColumn("user_id", F.lit(1).cast(raw.schema["user_id"].dataType)).select(*raw.columns)

    first = event(1, "2024-01-01 12:00:00").unionByName(event(2, "2024-01-02 00:05:00")) \
        .unionByName(event(3, "2024-01-02 00:20:00"))
    late = event(4, "2024-01-01 23:50:00")
    got, full = arrivals(spark, tmp_path, first.unionByName(late), [first, late])
    assert got == full
    assert sorted(r[1] for r in got) == ["1-20240101120000"] + ["1-20240101235000"] * 3


def test_day_ranges():
    d = lambda n: dt.date(2024, 1, n)
    assert day_ranges([d(20), d(3), d(4)], 1) == [(d(3), d(5)), (d(20), d(21))]
