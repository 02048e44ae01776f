"""The as-of (range) join, and rows that travel whole, so that several readers share one exchange.
Dimension joins are plain: Spark picks the side to broadcast by its size."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

DAY_SECONDS = 86_400


def packed(df: DataFrame, columns: list[str], into: str = "_whole") -> DataFrame:
    """``columns`` as one, the others beside it. Readers that need any of them move all of
    them: their exchanges are then equal, and Spark runs one for all."""
    return df.select(F.struct(*columns).alias(into), *[c for c in df.columns if c not in columns])


def unpacked(df: DataFrame, into: str = "_whole") -> DataFrame:
    """The columns of ``packed`` again. The partition id, which is never negative, keeps
    the reader's filters and column choice from moving below, where they would set the
    exchanges apart."""
    fenced = df.withColumn(into, F.when(F.spark_partition_id() >= 0, F.col(into)))
    return fenced.select(f"{into}.*", *[c for c in df.columns if c != into])


def dealt_once(df: DataFrame, by: list[str], columns: list[str]) -> DataFrame:
    """Rows dealt by ``by`` with ``columns`` whole, for several readers; what else a reader needs goes along."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return unpacked(packed(df, [c for c in columns if c not in by]).repartition(n, *by)).select(*df.columns)


def join_near(rows: DataFrame, dim: DataFrame, key: str, near: str, how: str = "left",
              pairs: DataFrame | None = None, copy: str | None = None) -> DataFrame:
    """``rows.join(dim, key, how)`` for rows that are dealt by ``near``: they stay where they
    lie. Only the (near, key) pairs that occur travel to ``dim``, and come back with what a
    reader needs of its rows. They meet in a window over (near, key), as a join on both
    would deal the rows anew.

    ``pairs``: rows dealt alike that hold all those pairs; joins that are given the same ones
    send them once. ``copy``: a column that numbers the rows that a row becomes, from 0."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    attributes = [c for c in dim.columns if c != key]
    asked = (rows if pairs is None else pairs).where(F.col(key).isNotNull()).select(near, key).distinct()
    found = (asked.join(dim, key, "inner").repartition(n, near)
             .select(near, key, F.lit(False).alias("_asks"), *[F.struct(c).alias(f"_found_{c}") for c in attributes]))
    pair = Window.partitionBy(near, key)
    met = (found.unionByName(rows.withColumn("_asks", F.lit(True)), allowMissingColumns=True)  # this way round Spark sees how both are dealt
           .withColumns({"_copies": F.count(F.when(~F.col("_asks"), 1)).over(pair),
                         **{f"_found_{c}": F.collect_list(f"_found_{c}").over(pair) for c in attributes}})
           .where("_asks"))
    each = F.explode_outer if how == "left" else F.explode
    return (met.withColumn("_copy", each(F.when(F.col("_copies") > 0, F.sequence(F.lit(0), F.col("_copies").cast("int") - 1))))
            .select(*rows.columns, *[F.get(f"_found_{c}", "_copy")[c].alias(c) for c in attributes],
                    *([F.coalesce("_copy", F.lit(0)).alias(copy)] if copy else [])))


def asof_join(facts: DataFrame, history: DataFrame, key: str, ts: str,
              valid_from: str = "valid_from", valid_to: str = "valid_to",
              how: str = "left", slice_seconds: int = DAY_SECONDS) -> DataFrame:
    """Attach the history version valid at each fact's time (half-open interval).

    Condition: same key AND valid_from <= ts AND (valid_to IS NULL OR ts < valid_to).
    Intervals per key are disjoint, so a fact matches at most one version and is
    never multiplied.

    Time is cut into slices. A (key, slice) that holds facts or new versions gets one
    row: the versions that begin in it, and the last one that began before, which is
    carried over from the slices before it. Facts join that row on (key, slice) and
    pick their version from it, so facts never meet all versions of their key, a
    frequent key is spread over its slices, and the history is read once.
    """
    f, h = facts, history
    slice_of = lambda c: F.floor(F.unix_micros(F.col(c).cast("timestamp")) / (slice_seconds * 1_000_000))
    hist_cols = [c for c in h.columns if c != key and c not in f.columns]
    version = F.struct(F.col(valid_from).alias("_from"), F.col(valid_to).alias("_to"),
                       F.struct(*[F.col(c) for c in hist_cols]).alias("_row"))
    begun = (h.where(F.col(key).isNotNull() & F.col(valid_from).isNotNull())
             .groupBy(F.col(key).alias("_key"), slice_of(valid_from).alias("_slice"))
             .agg(F.collect_list(version).alias("_begun")))
    asked = (f.where(F.col(key).isNotNull() & F.col(ts).isNotNull())
             .select(F.col(key).alias("_key"), slice_of(ts).alias("_slice")).distinct())
    by_slice = (begun.unionByName(asked, allowMissingColumns=True).groupBy("_key", "_slice")
                .agg(F.flatten(F.collect_list("_begun")).alias("_begun")))  # one list a slice: nulls are left out
    latest = lambda versions: F.reduce(versions, F.get(versions, 0), lambda a, x: F.when(x["_from"] >= a["_from"], x).otherwise(a))
    before = Window.partitionBy("_key").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    known = (by_slice.withColumn("_carried", F.last(F.when(F.size("_begun") > 0, latest(F.col("_begun"))), ignorenulls=True).over(before))
             .select("_key", "_slice", F.filter(F.concat("_begun", F.array("_carried")), lambda x: x.isNotNull()).alias("_known")))
    joined = f.alias("_f").join(known, (F.col(f"_f.{key}") == F.col("_key")) & (slice_of(f"_f.{ts}") == F.col("_slice")), how)
    found = latest(F.filter("_known", lambda x: x["_from"] <= F.col(f"_f.{ts}")))
    out = joined.withColumn("_found", found)
    valid = F.col("_found._to").isNull() | (F.col(f"_f.{ts}") < F.col("_found._to"))
    if how == "inner":
        out = out.where(F.col("_found").isNotNull() & valid)
    return out.select("_f.*", *[F.when(valid, F.col(f"_found._row.{c}")).alias(c) for c in hist_cols])
