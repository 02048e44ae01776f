"""Documented patterns (X1–X15) not shipped as models, plus the margin report.

X1 timestamp snapshots and X3 daily state live in ``history``; X10 checks in
``checks``; X15 variants in ``windows``.
"""

from __future__ import annotations

import csv
import datetime as dt
import os
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.functions.exprs import guarded_rate
from cartwheel.operators.history import latest_per_key
from cartwheel.operators.rollups import money_sum
from cartwheel.operators.writers import write_partitions, write_table

SEED_DIR = os.path.join(os.path.dirname(os.path.dirname(__file__)), "seeds")


# ---------------------------------------------------------------- X2 periodic snapshot
def periodic_snapshot(df: DataFrame, run_date: dt.date, path: str | None = None,
                      col: str = "snapshot_date") -> DataFrame:
    """The full current state stamped with the run date; when a path is given it
    replaces only that day's partition (rerun of a day is idempotent)."""
    out = df.withColumn(col, F.lit(run_date))
    if path:
        write_partitions(out, path, col)
    return out


# ---------------------------------------------------------------- X4 overlapping increment
def overlap_increment(src: DataFrame, key: str, updated_at: str, last_watermark, days: int,
                      tiebreak: list[str] | None = None) -> DataFrame:
    """Read rows with ``updated_at >= last_watermark - days`` and keep the latest
    row per key (re-reading the overlap is harmless: later dedupe/overwrite)."""
    lower = F.lit(str(last_watermark)).cast("timestamp") - F.expr(f"INTERVAL {int(days)} DAYS")
    recent = src.where(F.col(updated_at) >= lower)
    return latest_per_key(recent, key, [updated_at, *(tiebreak or [])])


# ---------------------------------------------------------------- X5 upsert
def upsert(target: DataFrame, src: DataFrame, key: str, predicate: Column | None = None) -> DataFrame:
    """Merge: source rows replace target rows with the same key, new keys are
    inserted. ``predicate`` limits which target rows are eligible for
    replacement (e.g. recent partitions); rows outside it pass through."""
    if predicate is None:
        eligible, fixed = target, None
    else:
        eligible = target.where(predicate)
        fixed = target.where(~predicate | predicate.isNull())
    merged = eligible.join(src.select(key).distinct(), key, "left_anti").unionByName(src)
    return merged if fixed is None else fixed.unionByName(merged)


# ---------------------------------------------------------------- X6 landing scan
def read_landing(spark: SparkSession, root: str, ingest_dates: list, col: str = "ingest_date") -> DataFrame:
    """Hive-partitioned Parquet landing; the filter on the partition column
    prunes directories before any file is opened."""
    return spark.read.parquet(root).where(F.col(col).isin([str(d) for d in ingest_dates]))


def write_landing(df: DataFrame, root: str, day: Column, col: str = "ingest_date") -> None:
    """Land rows in one folder per day."""
    write_table(df.withColumn(col, day), root, col)


def scan_landing_days(spark: SparkSession, root: str, days: DataFrame, col: str = "ingest_date") -> DataFrame:
    """The landed rows of the days in ``days`` (a column ``col``), which a query finds at run time.

    The days join on the partition column; where Spark broadcasts them, by their
    size, it prunes the scan with them (dynamic partition pruning) and opens no
    other folder.
    """
    return spark.read.parquet(root).join(days.select(col).distinct(), col, "left_semi")


# ---------------------------------------------------------------- X7 pivot
def pivot_names(dimension: DataFrame, col: str, limit: int = 1000) -> list[str]:
    """The values of ``col``, found in the dimension, ascending; more than ``limit`` make no table to read."""
    names = sorted(r[0] for r in dimension.select(col).where(F.col(col).isNotNull()).distinct().limit(limit + 1).collect())
    if len(names) > limit:
        raise ValueError(f"{col} has more than {limit} values")
    return names


def pivot_sum(df: DataFrame, keys: list[str], pivot: str, value: str, values: list,
              null_column: str = "unassigned", other_column: str = "other") -> DataFrame:
    """Sum ``value`` per keys with one column per pivot value, one for NULL and one for any other value,
    so that the columns always sum to the whole. The input is read once.
    """
    cell = lambda match, name: money_sum(F.when(match, F.col(value))).alias(name)
    at = F.col(pivot)
    return df.groupBy(*keys).agg(*[cell(at == v, str(v)) for v in values], cell(at.isNull(), null_column),
                                 cell(at.isNotNull() & ~at.isin(list(values)), other_column))


# ---------------------------------------------------------------- X8 metrics
@dataclass(frozen=True)
class Metric:
    measure: str
    agg: str
    time: str


METRICS = {
    "total_revenue": Metric("net_revenue", "sum", "ordered_date"),
    "gross_revenue": Metric("gross_revenue", "sum", "ordered_date"),
    "order_count": Metric("order_key", "count", "ordered_date"),
}


def metric(df: DataFrame, name: str, dims: tuple[str, ...] = (), grain: str = "month") -> DataFrame:
    """A metric defined once, sliced on request by time grain and dimensions."""
    m = METRICS[name]
    agg = money_sum(m.measure) if m.agg == "sum" else F.count(m.measure)
    return (df.groupBy(F.trunc(m.time, grain).alias("period_start"), *dims)
            .agg(agg.alias(name)))


# ---------------------------------------------------------------- X9 seed mapping
def _seed_rows(name: str = "channel_mapping.csv") -> list[tuple[str, str, str]]:
    with open(os.path.join(SEED_DIR, name), newline="") as fh:
        return [(r["vocabulary"], r["source_value"], r["channel"]) for r in csv.DictReader(fh)]


CHANNEL_SEED_ROWS = _seed_rows()


def read_channel_seed(spark: SparkSession) -> DataFrame:
    """The channel vocabulary seed (a few rows versioned with the code)."""
    return spark.createDataFrame(CHANNEL_SEED_ROWS, "vocabulary string, source_value string, channel string")


def map_channel(df: DataFrame, col: str, seed: DataFrame, vocabulary: str) -> DataFrame:
    """Add ``channel`` (unified vocabulary); unmapped values become '(unmapped)'."""
    m = seed.where(F.col("vocabulary") == vocabulary).select(F.col("source_value").alias(col), "channel")
    return df.join(m, col, "left").withColumn("channel", F.coalesce("channel", F.lit("(unmapped)")))


def channel_summary(sessions: DataFrame, users: DataFrame, seed: DataFrame) -> DataFrame:
    """Sessions (event vocabulary) and users (signup vocabulary) per unified channel."""
    s = (map_channel(sessions.select("entry_traffic_source"), "entry_traffic_source", seed, "events")
         .groupBy("channel").agg(F.count(F.lit(1)).alias("session_count")))
    u = (map_channel(users.select("acquisition_channel"), "acquisition_channel", seed, "users")
         .groupBy("channel").agg(F.count(F.lit(1)).alias("user_count")))
    return (s.join(u, "channel", "full_outer")
            .select("channel", F.coalesce("session_count", F.lit(0)).alias("session_count"),
                    F.coalesce("user_count", F.lit(0)).alias("user_count")))


# ---------------------------------------------------------------- X11 compare relations
def compare_relations(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows only in a ('a_only') or only in b ('b_only'), duplicates counted."""
    return (a.exceptAll(b).select(F.lit("a_only").alias("side"), "*")
            .unionByName(b.exceptAll(a).select(F.lit("b_only").alias("side"), "*")))


# ---------------------------------------------------------------- X12 failure trend
def failure_trend(audit: DataFrame) -> DataFrame:
    """Failing rows per check and run date, from the stored failures."""
    return audit.groupBy("check", "run_date").agg(F.count(F.lit(1)).alias("failing_rows"))


# ---------------------------------------------------------------- X13 / X14
def validate_schema(df: DataFrame) -> list[tuple[str, str]]:
    """Zero-row build: analyse the plan (names and types) without reading data."""
    return [(f.name, f.dataType.simpleString()) for f in df.limit(0).schema.fields]


def read_partition_range(spark: SparkSession, path: str, col: str, start, end) -> DataFrame:
    """A partitioned table can only be read with bounds on its partition column."""
    if start is None or end is None:
        raise ValueError(f"a filter on partition column {col!r} is required")
    return require_partition_filter(spark.read.parquet(path).where(F.col(col).between(
        F.lit(str(start)).cast("date"), F.lit(str(end)).cast("date"))), col)


def require_partition_filter(df: DataFrame, col: str) -> DataFrame:
    """``df``, if every scan of a table partitioned by ``col`` prunes by it; else ``ValueError``.

    The plan is asked, not the caller: a filter that does not reach the scan does not
    count, one that reaches it through a join (dynamic pruning) does. That the column
    is not null prunes nothing.
    """
    leaves = df._jdf.queryExecution().sparkPlan().collectLeaves()
    scans = [x for x in (leaves.apply(i) for i in range(leaves.size())) if x.getClass().getSimpleName() == "FileSourceScanExec"]
    for scan in scans:
        if col in list(scan.relation().partitionSchema().fieldNames()):
            seq = scan.partitionFilters()
            filters = [seq.apply(i).toString() for i in range(seq.size())]
            if not any(f"{col}#" in x and not x.startswith("isnotnull(") for x in filters):
                raise ValueError(f"a filter on partition column {col!r} is required")
    return df


# ---------------------------------------------------------------- margin analysis consumer
def product_margin(fct_order_items: DataFrame, dim_products: DataFrame) -> DataFrame:
    """Net revenue, net gross profit and margin rate by category and brand."""
    p = dim_products.select("product_id", "category_name", "brand_name")
    agg = (fct_order_items.join(p, "product_id", "inner")
           .groupBy("category_name", "brand_name")
           .agg(F.count(F.lit(1)).alias("order_item_count"),
                money_sum("net_revenue").alias("net_revenue"),
                money_sum("net_gross_profit").alias("net_gross_profit")))
    return agg.withColumn("net_margin_rate",
                          guarded_rate("net_gross_profit", "net_revenue").cast("decimal(18,4)"))
