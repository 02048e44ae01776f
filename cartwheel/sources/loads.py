"""Load strategies (S3–S8, S16): landing source tables idempotently.

partition_overwrite  delete the target's rows whose event day is in [start, end]
                     and insert the source rows of the same window. Days of the
                     window that get no source rows are emptied too (T1); rows
                     with a NULL event time are in no window (T12).
full_replace         rebuild the whole table.
merge_insert_only    append source rows whose key is absent; never update.

Running a load twice with the same arguments gives the same table.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.functions.exprs import in_window
from cartwheel.operators.writers import (ensure_table, read_table, table_exists, with_partition_date,
                                         write_partitions, write_table)
from cartwheel.params import Params
from cartwheel.sources.registry import (DAY_COLUMN, FULL_REPLACE, LANDINGS, MERGE_INSERT_ONLY,
                                        PARTITION_OVERWRITE, Landing)


def with_ingested_at(df: DataFrame, ts: dt.datetime | str) -> DataFrame:
    """S3: stamp the load time. The time is injected (not now()), so a rerun
    with the same arguments writes identical rows."""
    value = ts.isoformat(sep=" ") if isinstance(ts, dt.datetime) else str(ts)
    return df.withColumn("_ingested_at", F.lit(value).cast("timestamp"))


def insert_only_delta(src: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """Source rows whose key is not in the target (MERGE ... WHEN NOT MATCHED INSERT)."""
    return src.join(target.select(key).where(F.col(key).isNotNull()).distinct(), key, "left_anti")


def load_window_overwrite(spark: SparkSession, src: DataFrame, path: str, event_time: str,
                          start, end, cluster_by: tuple[str, ...] = (),
                          part: str = DAY_COLUMN) -> dict:
    """Replace the window [start, end] (inclusive) of a day-partitioned table.

    The source is read once, into the staged days; window days that got no rows
    are emptied by the same swap.
    """
    new = with_partition_date(src, event_time, part).where(in_window(part, start, end))
    ensure_table(spark, new, path, part)
    written, emptied = write_partitions(new, path, part, cluster_by, lambda day: str(start) <= day <= str(end))
    return {"written_days": written, "emptied_days": emptied}


def load_full_replace(spark: SparkSession, src: DataFrame, path: str) -> dict:
    """The whole table replaced in one swap."""
    write_table(src, path)
    return {"replaced": True}


def load_insert_only(spark: SparkSession, src: DataFrame, path: str, key: str) -> DataFrame:
    """Append rows with new keys. Returns the appended delta (lazy;
    computed once by the write)."""
    ensure_table(spark, src, path)
    target = read_table(spark, path, src.schema)
    delta = insert_only_delta(src, target, key)
    delta.write.mode("append").parquet(path)
    return delta


def load_table(spark: SparkSession, how: Landing, src: DataFrame, path: str,
               start=None, end=None, ingested_at=None) -> dict:
    """Load by the source's write mode; an unknown mode is an error."""
    if ingested_at is not None:
        src = with_ingested_at(src, ingested_at)
    if how.mode == PARTITION_OVERWRITE:
        if start is None or end is None:
            raise ValueError(f"{path}: {how.mode} needs a window")
        return load_window_overwrite(spark, src, path, how.event_time, start, end, how.sorted_by)
    if how.mode == FULL_REPLACE:
        return load_full_replace(spark, src, path)
    if how.mode == MERGE_INSERT_ONLY:
        load_insert_only(spark, src, path, how.key)
        return {"merged": True}
    raise ValueError(f"unknown write mode: {how.mode}")


def resolve_window(run_date: dt.date | None = None, start: dt.date | None = None,
                   end: dt.date | None = None, lookback: int | None = None) -> tuple[dt.date, dt.date]:
    """Explicit [start, end], or ``lookback`` days back from run_date (both inclusive)."""
    if (start is None) != (end is None):
        raise ValueError("start and end go together")
    if start is not None and end is not None:
        if start > end:
            raise ValueError("start after end")
        return start, end
    run_date = run_date or dt.date.today()
    days = Params.lookback_days if lookback is None else lookback
    return run_date - dt.timedelta(days=days), run_date


def run_loads(spark: SparkSession, sources: dict[str, DataFrame], root: str,
              run_date: dt.date | None = None, start: dt.date | None = None,
              end: dt.date | None = None, lookback: int | None = None,
              tables: list[str] | None = None, dry_run: bool = False,
              ingested_at=None) -> dict:
    """Load every (or the named) table. An unknown table name raises
    ``KeyError`` before anything is written. ``dry_run`` returns the plan text of
    each load's source instead of writing."""
    names = tables or list(LANDINGS)
    unknown = [n for n in names if n not in LANDINGS]
    if unknown:
        raise KeyError(f"unknown tables: {unknown}")
    w_start, w_end = resolve_window(run_date, start, end, lookback)
    report = {}
    for name in names:
        how = LANDINGS[name]
        path = f"{root.rstrip('/')}/{name}"
        if dry_run:
            report[name] = {"strategy": how.mode, "path": path,
                            "window": (str(w_start), str(w_end)) if how.event_time else None}
            continue
        report[name] = load_table(spark, how, sources[name], path, w_start, w_end, ingested_at)
    return report


def read_landed(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A landed table; a day-partitioned one keeps DAY_COLUMN, which ``landed_days`` prunes by."""
    return spark.read.parquet(f"{root.rstrip('/')}/{name}")


def landed_days(landed: DataFrame, start, end) -> DataFrame:
    """The rows of the days [start, end]: only those day folders are listed and opened."""
    return landed.where(in_window(DAY_COLUMN, start, end))


__all__ = ["with_ingested_at", "insert_only_delta", "load_window_overwrite", "load_full_replace",
           "load_insert_only", "load_table", "run_loads", "resolve_window", "read_landed",
           "landed_days", "table_exists"]
