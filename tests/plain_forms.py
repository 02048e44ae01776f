"""Textbook window forms the operators are compared with; one heavy key would be one task."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.functions.exprs import session_id, whole_units_between


def assign_sessions_single_window(events: DataFrame, timeout_minutes: int) -> DataFrame:
    w = Window.partitionBy("user_id").orderBy("event_at", "event_key")
    gap = whole_units_between("MINUTE", F.lag("event_at").over(w), F.col("event_at"))
    ev = events.withColumn("minutes_since_prev_event", gap)
    starts = F.col("minutes_since_prev_event").isNull() | (F.col("minutes_since_prev_event") > timeout_minutes)
    ev = ev.withColumn("is_session_start", F.when(starts, 1).otherwise(0).cast("int"))
    ev = ev.withColumn("session_started_at",
                       F.last(F.when(F.col("is_session_start") == 1, F.col("event_at")), ignorenulls=True)
                       .over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return ev.withColumn("session_id", session_id("user_id", "session_started_at"))


def window_latest_per_key(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    w = Window.partitionBy(key).orderBy(*[F.col(c).desc() for c in order])
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")
