"""Structured Streaming form of the lookback re-processing (§2.10).

The reference has no stream source: late events are absorbed by re-reading a
lookback window in batch and replacing the day partitions it touches. The
streaming form keeps exactly those semantics: a file stream of landed events
drives ``foreachBatch``; each micro-batch only tells *which days* received
events, and those days (plus the read buffer) are re-sessionized from the
landed table with the same batch operator and written with dynamic partition
overwrite. Replaying a micro-batch after a failure rewrites the same
partitions with the same rows (idempotent sink), and the checkpoint location
(under the shared checkpoint folder) records which files were processed.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cartwheel.operators.writers import table_exists, write_incremental
from cartwheel.params import Params
from cartwheel.plans.staging import stg_events
from cartwheel.plans.intermediate import int_events_sessionized


def reprocess_days(spark: SparkSession, landed_events: DataFrame, days: list[dt.date], target: str,
                   params: Params) -> str:
    """Re-sessionize the given days and the buffer days after them (a late event
    also moves the session starts of the following day), and replace those
    partitions in the target. Returns the write mode used."""
    if not days:
        return "noop"
    if not table_exists(spark, target):
        out = int_events_sessionized(stg_events(landed_events), params)
    else:
        out = reduce(DataFrame.unionByName, [_range_sessions(landed_events, first, last, params)
                                             for first, last in day_ranges(days, params.session_buffer_days)])
    return write_incremental(spark, out, target, "event_date", ("user_id",))


def day_ranges(days: list[dt.date], after: int) -> list[tuple[dt.date, dt.date]]:
    """Inclusive ranges of the days, each with ``after`` days more; ranges that touch are one."""
    out: list[tuple[dt.date, dt.date]] = []
    for day in sorted(days):
        last = day + dt.timedelta(days=after)
        if out and day <= out[-1][1] + dt.timedelta(days=1):
            out[-1] = (out[-1][0], last)
        else:
            out.append((day, last))
    return out


def _range_sessions(landed_events: DataFrame, first: dt.date, last: dt.date, params: Params) -> DataFrame:
    """Sessionized events of [first, last]; the bounds on the event time reach the Parquet scan."""
    window = replace(params, run_date=last, lookback_days=(last - first).days)
    low, high = window.lookback_start(window.session_buffer_days), last + dt.timedelta(days=1)
    at = F.col("created_at")
    events = landed_events.where((at >= F.lit(str(low)).cast("timestamp")) & (at < F.lit(str(high)).cast("timestamp")))
    return int_events_sessionized(stg_events(events), window, incremental=True)


def start_sessionization_stream(spark: SparkSession, landing_path: str, schema, target: str,
                                checkpoint: str, params: Params | None = None,
                                trigger: dict | None = None) -> StreamingQuery:
    """Watch ``landing_path`` (Parquet files of raw events) and keep the
    sessionized table at ``target`` up to date, day partitions at a time."""
    params = params or Params()
    stream = spark.readStream.schema(schema).parquet(landing_path)

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        # Only the set of touched days leaves the cluster (bounded by the calendar).
        days = [r[0] for r in batch.select(F.to_date("created_at").alias("d"))
                .where(F.col("d").isNotNull()).distinct().collect()]
        landed = spark.read.schema(schema).parquet(landing_path)
        reprocess_days(spark, landed, days, target, params)

    writer = stream.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(**(trigger or {"availableNow": True}))
    return writer.start()
