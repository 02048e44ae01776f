"""Gap-based sessionization.

Semantics: per logged-in user, events ordered by (event_at, event_key); the
gap to the previous event in whole minutes; a session starts at the first
event or when the gap is greater than the timeout; each event carries the
time of the latest session start at or before it; the session id is
'<user>-<yyyyMMddHHmmss of that start>'.

Physical plan, built for a user that may own a third of all events: events
are partitioned by (user, time bucket), not by user, so one user's history is
spread over many tasks. Bucket boundaries are stitched with per-bucket
summaries (one row per user × bucket: bounded by the time span, not by the
event count), built from a narrow (user, bucket, time) projection:
  1. lag() inside each bucket gives every gap except the bucket's first;
     the first event's predecessor is the previous non-empty bucket's last
     event (summary);
  2. starts inside a bucket are carried with last(ignore nulls); events before
     the bucket's first inner start take the bucket's first event (if it
     starts a session) or the latest start of earlier buckets (summary).
The wide event rows are shuffled once, by (user, bucket), and sorted once;
the summaries join on the same keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.functions.exprs import (epoch_seconds, in_window, key_from_parts, key_of_parts, session_id,
                                       whole_units_between)
from cartwheel.operators.joins import dealt_once
from cartwheel.params import Params

EVENT_COLUMNS = ["event_key", "event_id", "user_id", "source_session_id", "event_type",
                 "traffic_source", "browser", "uri", "event_at", "event_date"]

OUTPUT_COLUMNS = ["event_key", "event_id", "user_id", "session_id", "session_started_at",
                  "source_session_id", "is_session_start", "minutes_since_prev_event",
                  "event_type", "traffic_source", "browser", "uri", "event_at", "event_date"]


def sessionize(stg_events: DataFrame, params: Params | None = None, incremental: bool = False,
               timeout_minutes: int | None = None, bucket_seconds: int | None = None,
               shared: bool = False) -> DataFrame:
    """int_events_sessionized: full build, or the lookback slice when incremental.

    Incremental reads one buffer day more than it writes (F2), so the slice's
    first event can be judged against its predecessor; the buffer is trimmed
    from the output (F3) so its partition is never overwritten with a partial day.

    ``shared``: several models read the sessions in one plan. The events are dealt once
    for all of them, whole, and their keys are made from their parts where they are read.
    """
    params = params or Params()
    timeout = params.session_timeout_minutes if timeout_minutes is None else timeout_minutes
    bucket = params.session_bucket_seconds if bucket_seconds is None else bucket_seconds

    events = stg_events.select(*EVENT_COLUMNS).where(F.col("user_id").isNotNull())
    if incremental:
        events = events.where(in_window("event_date", *params.window(params.session_buffer_days)))

    if shared:
        parts = ("event_id", "source_session_id", epoch_seconds("event_at"))
        events = events.withColumns({"event_key": key_from_parts("event_key", *parts), "_bucket": bucket_of("event_at", bucket)})
        events = dealt_once(events, ["user_id", "_bucket"], EVENT_COLUMNS[:-1]).withColumn("event_key", key_of_parts("event_key", *parts))
    out = assign_sessions(events, timeout, bucket)
    if incremental:
        out = out.where(in_window("event_date", *params.window()))
    return out.select(*OUTPUT_COLUMNS)


def bucket_of(ts: str, bucket_seconds: int) -> Column:
    return F.floor(F.unix_seconds(F.col(ts)) / bucket_seconds)


def bucket_summaries(events: DataFrame, timeout_minutes: int, bucket_seconds: int,
                     user: str = "user_id", ts: str = "event_at") -> DataFrame:
    """One row per (user, bucket): the state a bucket needs from the user's
    earlier buckets, computed from a narrow projection (user, bucket, time).

    _prev_last      last event time of the previous non-empty bucket
    _first_ts       first event time in the bucket
    _first_starts   whether that first event starts a session
    _incoming_start latest session start of all earlier buckets
    Only event times matter here: events tied at one instant have a 0 gap, so
    the tie order (by key) never changes which instants start a session.
    """
    in_bucket = Window.partitionBy(user, "_bucket").orderBy(ts)
    by_bucket = Window.partitionBy(user).orderBy("_bucket")
    narrow = events.select(user, ts, "_bucket" if "_bucket" in events.columns else bucket_of(ts, bucket_seconds).alias("_bucket"))
    gap = whole_units_between("MINUTE", F.lag(ts).over(in_bucket), F.col(ts))
    local = narrow.withColumn("_local_start", F.when(gap > timeout_minutes, F.col(ts)))
    per_bucket = local.groupBy(user, "_bucket").agg(F.min(ts).alias("_first_ts"),
                                                    F.max(ts).alias("_last_ts"),
                                                    F.max("_local_start").alias("_last_local_start"))
    prev_last = F.lag("_last_ts").over(by_bucket)
    first_gap = whole_units_between("MINUTE", F.col("_prev_last"), F.col("_first_ts"))
    out = (per_bucket.withColumn("_prev_last", prev_last)
           .withColumn("_first_starts", F.col("_prev_last").isNull() | (first_gap > timeout_minutes))
           .withColumn("_bucket_last_start",
                       F.coalesce("_last_local_start", F.when(F.col("_first_starts"), F.col("_first_ts"))))
           .withColumn("_incoming_start",
                       F.last("_bucket_last_start", ignorenulls=True).over(
                           by_bucket.rowsBetween(Window.unboundedPreceding, -1))))
    return out.select(user, "_bucket", "_prev_last", "_first_ts", "_first_starts", "_incoming_start")


def assign_sessions(events: DataFrame, timeout_minutes: int, bucket_seconds: int = 3600,
                    user: str = "user_id", ts: str = "event_at", tiebreak: str = "event_key") -> DataFrame:
    """Add minutes_since_prev_event, is_session_start, session_started_at, session_id.

    The event rows are shuffled once, by (user, bucket), and sorted once; the
    bucket summaries (one small row per user × bucket) are joined on the same
    keys, so the events are not moved again.
    """
    in_bucket = Window.partitionBy(user, "_bucket").orderBy(ts, tiebreak)
    summaries = bucket_summaries(events, timeout_minutes, bucket_seconds, user, ts)
    ev = events if "_bucket" in events.columns else events.withColumn("_bucket", bucket_of(ts, bucket_seconds))
    ev = ev.withColumn("_prev_in_bucket", F.lag(ts).over(in_bucket))
    in_gap = whole_units_between("MINUTE", F.col("_prev_in_bucket"), F.col(ts))
    ev = ev.withColumn("_local_start",
                       F.last(F.when(in_gap > timeout_minutes, F.col(ts)), ignorenulls=True).over(
                           in_bucket.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    ev = ev.join(summaries, [user, "_bucket"], "left")
    first = F.col("_prev_in_bucket").isNull()
    gap = F.when(first, whole_units_between("MINUTE", F.col("_prev_last"), F.col(ts))).otherwise(in_gap)
    ev = (ev.withColumn("minutes_since_prev_event", gap)
            .withColumn("is_session_start",
                        F.when(F.col("minutes_since_prev_event").isNull()
                               | (F.col("minutes_since_prev_event") > timeout_minutes), 1)
                        .otherwise(0).cast("int"))
            .withColumn("session_started_at",
                        F.coalesce("_local_start", F.when(F.col("_first_starts"), F.col("_first_ts")),
                                   "_incoming_start")))
    return (ev.withColumn("session_id", session_id(user, "session_started_at"))
              .drop("_bucket", "_prev_in_bucket", "_local_start", "_prev_last", "_first_ts",
                    "_first_starts", "_incoming_start"))
