"""Type-2 history (H1–H5, X1–X3) and keyed corrections.

A history table holds the tracked columns plus four tool columns:
``_scd_id`` (md5 of key|valid_from), ``_updated_at``, ``_valid_from`` and
``_valid_to`` (NULL = open). ``scd2_apply`` turns (history, new state) into the
next history in one pass: open rows are full-outer-joined to the state on the
key, and each joined row emits its kept/closed old version and, when needed,
a new version (``explode`` of a 0–2 element array). Closed rows pass through
untouched. No MERGE is needed, so plain Parquet works. ``snapshot_run`` keeps a
stored history: open versions are one partition, which each run replaces; the
versions that a run closes are a partition of their own, never written again. Both
go in by one swap, so a run that dies before it leaves the history as it was.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType, TimestampType

from cartwheel.operators.rollups import keys_with_versions
from cartwheel.operators.writers import commit, finish_swaps, partition_names, read_table, stage

TOOL_COLUMNS = ("_scd_id", "_updated_at", "_valid_from", "_valid_to")

# The columns whose change opens a new product version.
PRODUCT_CHECK_COLS = ("retail_price", "cost", "name", "brand", "category", "department",
                      "distribution_center_id")
PRODUCT_SNAPSHOT_COLS = ("id", "name", "brand", "category", "department", "sku", "cost",
                         "retail_price", "distribution_center_id")


def _ts(ts) -> Column:
    if isinstance(ts, Column):
        return ts
    if isinstance(ts, dt.datetime):
        ts = ts.isoformat(sep=" ")
    return F.lit(str(ts)).cast("timestamp")


def scd_id(key, ts) -> Column:
    k = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat_ws("|", F.coalesce(k.cast("string"), F.lit("")),
                             F.coalesce(ts.cast("string"), F.lit(""))))


def empty_history(state: DataFrame) -> DataFrame:
    schema = StructType(list(state.schema.fields) + [
        StructField("_scd_id", StringType()), StructField("_updated_at", TimestampType()),
        StructField("_valid_from", TimestampType()), StructField("_valid_to", TimestampType())])
    return state.sparkSession.createDataFrame([], schema)


def scd2_apply(history: DataFrame | None, state: DataFrame, key: str, ts,
               check_cols: tuple[str, ...] | None = None, strategy: str = "check",
               updated_at: str | None = None, hard_deletes: bool = True) -> DataFrame:
    """Next version of a type-2 history given the current full state.

    strategy='check': a key changed when any ``check_cols`` differs (NULL-safe);
    columns not listed never open a version (trap T13).
    strategy='timestamp': a key changed when ``updated_at`` is newer (X1); the
    new version's valid_from is that updated_at.
    New keys open a version; keys missing from the state are closed when
    ``hard_deletes`` (a key that returns later opens a new version). Re-running
    with the same state and ts changes nothing.
    """
    if strategy not in ("check", "timestamp"):
        raise ValueError(f"unknown snapshot strategy {strategy!r}")
    ts_c = _ts(ts)
    cols = state.columns
    if history is None:
        history = empty_history(state)
    open_h = history.where(F.col("_valid_to").isNull())
    closed_h = history.where(F.col("_valid_to").isNotNull())
    # a row without key would fit no version and vanish: it stops the run instead
    state = state.withColumn(key, F.coalesce(F.col(key), F.raise_error(F.lit(f"snapshot row without {key}")).cast(state.schema[key].dataType)))

    h, s = open_h.alias("h"), state.alias("s")
    joined = h.join(s, F.col(f"h.{key}") == F.col(f"s.{key}"), "full_outer")
    h_exists = F.col("h._scd_id").isNotNull()
    s_exists = F.col(f"s.{key}").isNotNull()
    if strategy == "check":
        same = reduce(lambda a, b: a & b,
                      [F.col(f"h.{c}").eqNullSafe(F.col(f"s.{c}")) for c in (check_cols or cols)])
        new_from = ts_c
    else:
        same = ~(F.col(f"s.{updated_at}") > F.col(f"h.{updated_at}"))
        new_from = F.col(f"s.{updated_at}").cast("timestamp")
    changed = h_exists & s_exists & ~same
    close = changed | (h_exists & ~s_exists & F.lit(hard_deletes))
    opens = s_exists & (~h_exists | changed)

    old_row = F.struct(*[F.col(f"h.{c}").alias(c) for c in cols],
                       F.col("h._scd_id").alias("_scd_id"),
                       F.col("h._updated_at").alias("_updated_at"),
                       F.col("h._valid_from").alias("_valid_from"),
                       F.when(close, ts_c if strategy == "check" else F.coalesce(new_from, ts_c))
                       .otherwise(F.col("h._valid_to")).alias("_valid_to"))
    new_row = F.struct(*[F.col(f"s.{c}").alias(c) for c in cols],
                       scd_id(F.col(f"s.{key}"), new_from).alias("_scd_id"),
                       new_from.alias("_updated_at"),
                       new_from.alias("_valid_from"),
                       F.lit(None).cast("timestamp").alias("_valid_to"))
    rows = F.filter(F.array(F.when(h_exists, old_row), F.when(opens, new_row)),
                    lambda r: r.isNotNull())
    moved = joined.select(F.explode(rows).alias("r")).select("r.*")
    return closed_h.unionByName(moved)


STATE = "_state"
OPEN = "open"


def snapshot_run(spark, path: str, state: DataFrame, key: str, ts, **how) -> DataFrame:
    """One snapshot run on the stored history at ``path``; returns the history after it.

    Only the open versions are read and written; what this run closes goes to
    ``closed-<ts>``. A rerun with the same state and ts changes nothing, whether the
    first one ended, died before the swap or died inside it.
    """
    finish_swaps(spark, path)
    old = None
    if OPEN in partition_names(spark, path, STATE):
        old = read_table(spark, path, empty_history(state).withColumn(STATE, F.lit("")).schema) \
            .where(F.col(STATE) == OPEN).drop(STATE)
    stamp = "".join(c if c.isalnum() else "-" for c in str(ts))
    moved = scd2_apply(old, state, key, ts, **how) \
        .withColumn(STATE, F.when(F.col("_valid_to").isNull(), OPEN).otherwise(f"closed-{stamp}"))
    commit(spark, path, stage(moved, path, STATE, (key,)), [f"{STATE}={OPEN}"])
    return read_history(spark, path)


def read_history(spark, path: str) -> DataFrame:
    """All versions of a stored history."""
    finish_swaps(spark, path)
    return read_table(spark, path).drop(STATE)


def dim_products_history(history: DataFrame) -> DataFrame:
    """H3: business names, exact money, validity interval and is_current."""
    return history.select(
        F.col("_scd_id").alias("product_history_key"),
        F.col("id").alias("product_id"),
        F.col("name").alias("product_name"),
        F.col("brand").alias("brand_name"),
        F.col("category").alias("category_name"),
        F.col("department").alias("department_name"),
        "sku",
        F.col("cost").cast("decimal(18,9)").alias("unit_cost"),
        F.col("retail_price").cast("decimal(18,9)").alias("retail_price"),
        "distribution_center_id",
        F.col("_valid_from").alias("valid_from"),
        F.col("_valid_to").alias("valid_to"),
        F.col("_valid_to").isNull().alias("is_current"),
    )


def multi_version_rows(history: DataFrame, key: str = "product_id", order: str = "valid_from",
                       limit: int | None = 40,
                       columns: tuple[str, ...] = ("product_id", "product_name", "retail_price",
                                                   "valid_from", "valid_to")) -> DataFrame:
    """H5/O1: versions of keys that have more than one version, ordered by key
    and valid_from, first ``limit`` rows (a top-N listing: TakeOrderedAndProject)."""
    multi = keys_with_versions(history, key).select(key)
    out = history.join(multi, key, "left_semi").select(*columns).orderBy(key, order)
    return out.limit(limit) if limit is not None else out


def apply_keyed_updates(df: DataFrame, updates: DataFrame, key: str, cols: list[str]) -> DataFrame:
    """UPDATE ... FROM — rows with a key in ``updates`` take its values
    for ``cols``; every other row is unchanged. Left join + coalesce."""
    u = updates.select(key, F.lit(True).alias("_u_hit"), *[F.col(c).alias(f"_u_{c}") for c in cols])
    joined = df.join(u, key, "left")
    hit = F.col("_u_hit").isNotNull()
    for c in cols:
        joined = joined.withColumn(c, F.when(hit, F.col(f"_u_{c}")).otherwise(F.col(c)))
    return joined.select(*df.columns)


def price_change_updates(products: DataFrame, count: int = 20, pct: float = 0.15,
                         key: str = "id", price: str = "retail_price") -> DataFrame:
    """O2: the first ``count`` ids by id, price moved +pct for even ids and -pct for
    odd ids, rounded to cents (exact decimal arithmetic)."""
    picked = products.select(key, price).orderBy(key).limit(count)
    factor = F.when(F.pmod(F.col(key), F.lit(2)) == 0, F.lit(1 + pct)).otherwise(F.lit(1 - pct))
    new_price = F.round(F.col(price).cast("decimal(18,2)") * factor.cast("decimal(4,2)"), 2)
    return picked.select(key, new_price.cast("double").alias(price))


def expand_history(history: DataFrame, start: dt.date | str, end: dt.date | str,
                   valid_from: str = "valid_from", valid_to: str = "valid_to") -> DataFrame:
    """Daily state over [start, end] — one row per (day, version) with
    ``day >= date(valid_from) AND (valid_to IS NULL OR day < date(valid_to))``.

    Each version explodes only its own days (a per-row date sequence), so the
    date spine is never range-joined against the whole history.
    """
    s, e = F.lit(str(start)).cast("date"), F.lit(str(end)).cast("date")
    first = F.greatest(F.to_date(valid_from), s)
    last = F.least(F.coalesce(F.date_sub(F.to_date(valid_to), 1), e), e)
    return (history.where(first <= last)
            .select(F.explode(F.sequence(first, last)).alias("snapshot_date"), "*"))


def history_from_states(states: list[tuple[DataFrame, str]], key: str = "id",
                        check_cols: tuple[str, ...] = PRODUCT_CHECK_COLS) -> DataFrame:
    """Apply successive (state, ts) snapshots to an empty history."""
    hist = None
    for state, ts in states:
        hist = scd2_apply(hist, state, key, ts, check_cols=check_cols)
    return hist


def latest_per_key(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Keep the newest row per key (X4 dedupe, latest wins) with max_by —
    a decomposable aggregate, so a hot key is reduced map-side instead of
    being sorted in one task."""
    others = [c for c in df.columns if c != key]
    ordering = F.struct(*[F.col(c) for c in order])
    return (df.groupBy(key).agg(F.max_by(F.struct(*[F.col(c) for c in others]), ordering).alias("_r"))
            .select(key, "_r.*"))
