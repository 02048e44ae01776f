"""Table writers (S8–S14, S18) over Parquet paths.

What replaces rows is staged first, in a hidden folder of the table, and then
swapped in by renames that a small journal describes. The journal is the commit:
before it is there the table is untouched, after it ``finish_swaps`` carries the
renames through, also when the process that wrote it is gone. New and emptied
partitions are one commit, nothing is read twice, and a result may be computed
from the very path that it replaces. (On a store without an atomic rename of
folders, readers can meet a swap half done; it is finished all the same.)
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cartwheel.session import checkpoint_dir

SWAP = "_swap"


# ---------------------------------------------------------------- the file system
def _fs(spark: SparkSession, path: str):
    """(the store's file system, a function that makes its paths)."""
    make = spark._jvm.org.apache.hadoop.fs.Path
    return make(path).getFileSystem(spark._jsc.hadoopConfiguration()), make


def _names(spark: SparkSession, path: str, hidden: bool = False) -> list[str]:
    """Names in a folder; Spark's readers skip those that start with _ or . and are no partition."""
    fs, make = _fs(spark, path)
    if not fs.exists(make(path)):
        return []
    names = (x.getPath().getName() for x in fs.listStatus(make(path)))
    return sorted(n for n in names if hidden or "=" in n or n[0] not in "_.")


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether the folder holds a data file. A file that cannot be read is an error of the read, not a missing table."""
    for name in _names(spark, path):
        if name.endswith(".parquet") or ("=" in name and table_exists(spark, f"{path}/{name}")):
            return True
    return False


def partition_names(spark: SparkSession, path: str, partition_by: str) -> list[str]:
    """Values of the partition folders, from the folder names alone."""
    return [n.split("=", 1)[1] for n in _names(spark, path) if n.startswith(f"{partition_by}=")]


def stage(df: DataFrame, path: str, partition_by: str | None = None, cluster_by: tuple[str, ...] = ()) -> str:
    """Write ``df`` to a hidden folder of the table; nothing reads it before ``commit``."""
    staged = f"{path}/{SWAP}/{uuid.uuid4().hex}.data"
    w = _layout(df, partition_by, tuple(cluster_by)).write
    if not partition_by:
        w.parquet(staged)
        return staged
    # Files are one per day at least: joining small partitions would only put all days into few tasks.
    conf, name = df.sparkSession.conf, "spark.sql.adaptive.coalescePartitions.enabled"
    before = conf.get(name)
    conf.set(name, "false")
    try:
        w.partitionBy(partition_by).parquet(staged)
    finally:
        conf.set(name, before)
    return staged


def commit(spark: SparkSession, path: str, staged: str, remove: list[str]) -> None:
    """Put the staged folders and files in place of those named in ``remove``: one journal, then the renames."""
    plan = {"staged": staged, "add": _names(spark, staged), "remove": sorted(remove)}
    fs, make = _fs(spark, path)
    draft, journal = staged.removesuffix(".data") + ".draft", staged.removesuffix(".data") + ".json"
    out = fs.create(make(draft), True)
    try:
        out.write(bytearray(json.dumps(plan).encode()))
    finally:
        out.close()
    fs.rename(make(draft), make(journal))  # from here on the swap is decided
    finish_swaps(spark, path)


def finish_swaps(spark: SparkSession, path: str) -> int:
    """Carry every decided swap through; each step can be repeated. Returns how many there were."""
    fs, make = _fs(spark, path)
    todo = [n for n in _names(spark, f"{path}/{SWAP}", hidden=True) if n.endswith(".json")]
    for name in todo:
        journal = f"{path}/{SWAP}/{name}"
        plan = json.loads("".join(r.value for r in spark.read.text(journal).collect()))  # a few names
        waiting = set(_names(spark, plan["staged"]))
        for n in plan["remove"]:
            if n not in plan["add"]:
                fs.delete(make(f"{path}/{n}"), True)
        for n in plan["add"]:
            if n in waiting:  # else it was moved before
                fs.delete(make(f"{path}/{n}"), True)
                fs.rename(make(f"{plan['staged']}/{n}"), make(f"{path}/{n}"))
        fs.delete(make(plan["staged"]), True)
        fs.delete(make(journal), False)
    return len(todo)


# ---------------------------------------------------------------- tables
def read_table(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """Read a Parquet table; with a schema an empty (just created) table reads as 0 rows."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)


def materialize(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint in the shared checkpoint folder."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def _layout(df: DataFrame, partition_by: str | None, cluster_by: tuple[str, ...]) -> DataFrame:
    """Rows of a day and of near cluster values go to the same tasks, sorted there, so that Parquet
    min/max statistics prune row groups.

    A rebalance, not a range exchange: its input is evaluated once, and adaptive
    execution splits a heavy day and joins light ones to the advisory partition size.
    """
    keys = [partition_by] if partition_by else list(cluster_by[:1])
    if not keys:
        return df
    return df.hint("rebalance", *keys).sortWithinPartitions(*dict.fromkeys([*keys, *cluster_by]))


def write_table(df: DataFrame, path: str, partition_by: str | None = None,
                cluster_by: tuple[str, ...] = (), mode: str = "overwrite") -> None:
    """The whole table replaced in one swap, or rows appended."""
    spark = df.sparkSession
    finish_swaps(spark, path)
    if mode == "overwrite":
        commit(spark, path, stage(df, path, partition_by, cluster_by), _names(spark, path))
        return
    w = _layout(df, partition_by, tuple(cluster_by)).write.mode(mode)
    (w.partitionBy(partition_by) if partition_by else w).parquet(path)


def write_partitions(df: DataFrame, path: str, partition_by: str, cluster_by: tuple[str, ...] = (),
                     emptied=None) -> tuple[list[str], list[str]]:
    """Replace the partitions that ``df`` has, and remove those that ``emptied`` says yes to, in one swap.

    Which partitions were written is read off the staged folders, so ``df`` is
    evaluated once. Returns (written, emptied).
    """
    spark = df.sparkSession
    finish_swaps(spark, path)
    staged = stage(df, path, partition_by, cluster_by)
    written = partition_names(spark, staged, partition_by)
    gone = [v for v in partition_names(spark, path, partition_by) if v not in written and emptied is not None and emptied(v)]
    commit(spark, path, staged, [f"{partition_by}={v}" for v in [*written, *gone]])
    return written, gone


def ensure_table(spark: SparkSession, df: DataFrame, path: str, partition_by: str | None = None) -> bool:
    """Create the table with df's schema and zero rows when it is missing.
    Returns True when it was created."""
    if table_exists(spark, path):
        return False
    w = df.limit(0).write.mode("ignore")
    if partition_by:
        w = w.partitionBy(partition_by)
    w.parquet(path)
    return True


def sync_columns(existing: DataFrame, new: DataFrame) -> DataFrame:
    """S14 (sync_all_columns): existing rows take the new column set — added
    columns are NULL, removed columns dropped."""
    return existing.unionByName(new.limit(0), allowMissingColumns=True).select(*new.columns)


def write_incremental(spark: SparkSession, df: DataFrame, path: str, partition_by: str,
                      cluster_by: tuple[str, ...] = ()) -> str:
    """First run writes everything; later runs replace only the
    partitions in ``df``. When the column set changed, the table with the new columns
    is staged beside the old one, which stays until the swap. Returns 'full' |
    'incremental' | 'resynced'."""
    finish_swaps(spark, path)
    if not table_exists(spark, path):
        write_table(df, path, partition_by, cluster_by)
        return "full"
    existing = spark.read.parquet(path)
    # The partition column comes back last and with a type inferred from the
    # directory names: compare it by name only.
    old_types = {f.name: f.dataType for f in existing.schema.fields if f.name != partition_by}
    new_types = {f.name: f.dataType for f in df.schema.fields if f.name != partition_by}
    if set(existing.columns) != set(df.columns) or old_types != new_types:
        touched = df.select(partition_by).distinct()
        kept = existing.join(touched, partition_by, "left_anti")
        write_table(sync_columns(kept, df).unionByName(df), path, partition_by, cluster_by)
        return "resynced"
    write_partitions(df, path, partition_by, cluster_by)
    return "incremental"


def store_failures(df: DataFrame, root: str, check_name: str, run_date) -> int:
    """Keep a check's failing rows under check=<name>/run_date=<d>, replacing
    that run's previous rows (idempotent rerun). Returns how many there are, counted on what was stored."""
    path = f"{root.rstrip('/')}/check={check_name}/run_date={run_date}"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).count()


def with_partition_date(df: DataFrame, event_time: str, name: str = "_partition_date") -> DataFrame:
    return df.withColumn(name, F.to_date(F.col(event_time)))
