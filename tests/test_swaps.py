"""Staged swaps: a write that dies loses nothing, whichever step it dies in; inputs are evaluated once."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from cartwheel.operators import patterns as X
from cartwheel.operators import writers as W
from cartwheel.operators.history import read_history, snapshot_run
from cartwheel.sources.loads import load_full_replace, load_window_overwrite
from conftest import rows

SCHEMA = "id long, created_at timestamp, v string"


class Died(Exception):
    pass


def day(n):
    return dt.datetime(2024, 1, n, 12)


def frame(spark, days, v):
    return spark.createDataFrame([(d, day(d), v) for d in days], SCHEMA)


def read(spark, path):
    return rows(spark.read.parquet(path), "id", "v")


def dies_at(monkeypatch, step):
    """Let the next swap die before its journal, or after ``step`` of its renames."""
    if step == "before":
        monkeypatch.setattr(W, "commit", lambda *a: (_ for _ in ()).throw(Died()))
        return
    real, done = W._fs, [0]

    def flaky(spark, path):
        fs, make = real(spark, path)

        class Fs:
            def __getattr__(self, name):
                def call(*a):
                    if name == "rename" and a[0].toString().find(".data/") >= 0:
                        if done[0] == step:
                            raise Died()
                        done[0] += 1
                    return getattr(fs, name)(*a)
                return call
        return Fs(), make

    monkeypatch.setattr(W, "_fs", flaky)


@pytest.mark.parametrize("step", ["before", 0, 1])
def test_window_load_that_dies(spark, tmp_path, monkeypatch, step):
    """Days 2 to 4 are reloaded without day 3: all old, or all new once the next call finishes the swap."""
    path = str(tmp_path / "t")
    load_window_overwrite(spark, frame(spark, range(1, 6), "old"), path, "created_at", "2024-01-01", "2024-01-05")
    with monkeypatch.context() as m:
        dies_at(m, step)
        with pytest.raises(Died):
            load_window_overwrite(spark, frame(spark, (2, 4), "new"), path, "created_at", "2024-01-02", "2024-01-04")
    finished = W.finish_swaps(spark, path)
    old, new = [(i, "old") for i in range(1, 6)], [(1, "old"), (2, "new"), (4, "new"), (5, "old")]
    assert read(spark, path) == (old if step == "before" else new)
    assert finished == (0 if step == "before" else 1) and W.finish_swaps(spark, path) == 0
    rep = load_window_overwrite(spark, frame(spark, (2, 4), "new"), path, "created_at", "2024-01-02", "2024-01-04")
    assert read(spark, path) == new and rep["written_days"] == ["2024-01-02", "2024-01-04"]


@pytest.mark.parametrize("step", ["before", 0])
def test_full_replace_that_dies(spark, tmp_path, monkeypatch, step):
    path = str(tmp_path / "t")
    load_full_replace(spark, frame(spark, (1, 2), "old"), path)
    with monkeypatch.context() as m:
        dies_at(m, step)
        with pytest.raises(Died):
            load_full_replace(spark, frame(spark, (3,), "new"), path)
    W.finish_swaps(spark, path)
    assert read(spark, path) == ([(1, "old"), (2, "old")] if step == "before" else [(3, "new")])


@pytest.mark.parametrize("step", ["before", 0, 1])
def test_snapshot_run_that_dies(spark, tmp_path, monkeypatch, step):
    """A run that dies between write and journal leaves the history; its rerun gives what one whole run gives."""
    state = lambda *r: spark.createDataFrame(r, "id long, price double")
    first, second = state((1, 1.0), (2, 2.0), (3, 3.0)), state((1, 1.5), (2, 2.0))
    whole, path = str(tmp_path / "whole"), str(tmp_path / "h")
    for p in (whole, path):
        snapshot_run(spark, p, first, "id", "2024-01-01 00:00:00")
    snapshot_run(spark, whole, second, "id", "2024-01-02 00:00:00")
    before = rows(read_history(spark, path))
    with monkeypatch.context() as m:
        if step == "before":
            m.setattr("cartwheel.operators.history.commit", lambda *a: (_ for _ in ()).throw(Died()))
        else:
            dies_at(m, step)
        with pytest.raises(Died):
            snapshot_run(spark, path, second, "id", "2024-01-02 00:00:00")
    if step == "before":
        assert rows(read_history(spark, path)) == before
    for _ in range(2):
        snapshot_run(spark, path, second, "id", "2024-01-02 00:00:00")
        assert rows(read_history(spark, path)) == rows(read_history(spark, whole))
    assert len(before) == 3 and read_history(spark, path).count() == 4


def test_closed_versions_are_not_written_again(spark, tmp_path):
    path = str(tmp_path / "h")
    for n in range(1, 5):
        snapshot_run(spark, path, spark.createDataFrame([(1, float(n)), (2, 2.0)], "id long, price double"), "id", f"2024-01-0{n} 00:00:00")
        closed = {f: f.stat().st_mtime_ns for f in (tmp_path / "h").glob("_state=closed*/*.parquet")}
        assert n == 1 or set(old) <= set(closed) and all(closed[f] == t for f, t in old.items())
        old = closed
    assert rows(read_history(spark, path).where("id = 1"), "price") == [(1.0,), (2.0,), (3.0,), (4.0,)]
    assert rows(read_history(spark, path).where("id = 2"), "price") == [(2.0,)]


def test_snapshot_refuses_a_row_without_key(spark, tmp_path):
    with pytest.raises(Exception, match="snapshot row without id"):
        snapshot_run(spark, str(tmp_path / "h"), spark.createDataFrame([(1, 1.0), (None, 2.0)], "id long, price double"), "id", "2024-01-01")


def test_replacing_writes_evaluate_their_input_once(spark, tmp_path):
    """Counted by an accumulator: no sampling pass, no second read for the days written."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    src = frame(spark, list(range(1, 9)) * 5, "x")
    load_window_overwrite(spark, src.mapInArrow(count, SCHEMA), str(tmp_path / "t"), "created_at", "2024-01-01", "2024-01-31", ("id",))
    assert seen.value == 40


def test_a_hot_day_is_split_and_sorted(spark, tmp_path):
    """Adaptive execution cuts a heavy day at the advisory size; light days stay one file."""
    path, name = str(tmp_path / "t"), "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    hot = spark.range(0, 200_000, 1, 8).select(F.col("id"), F.lit(day(1)).alias("created_at"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
    src = hot.unionByName(frame(spark, (2, 3), "x"))
    old = spark.conf.get(name)
    spark.conf.set(name, "2m")
    try:
        load_window_overwrite(spark, src, path, "created_at", "2024-01-01", "2024-01-31", ("id",))
    finally:
        spark.conf.set(name, old)
    files = {d.name: len(list(d.glob("*.parquet"))) for d in (tmp_path / "t").glob("_partition_date=*")}
    assert files["_partition_date=2024-01-01"] >= 4 and files["_partition_date=2024-01-02"] == 1
    assert spark.read.parquet(path).count() == 200_002


def test_a_broken_file_is_not_a_missing_table(spark, tmp_path):
    (tmp_path / "t").mkdir()
    assert not W.table_exists(spark, str(tmp_path / "t")) and not W.table_exists(spark, str(tmp_path / "none"))
    (tmp_path / "t" / "part-0.parquet").write_bytes(b"not a table")
    with pytest.raises(Exception, match="(?i)parquet|footer"):
        W.write_incremental(spark, spark.createDataFrame([(dt.date(2024, 1, 1), 1)], "d date, v long"), str(tmp_path / "t"), "d")


def test_pivot_holds_every_name(spark):
    dim = spark.createDataFrame([(n,) for n in "abcdefg"] + [(None,), ("a",)], "name string")
    names = X.pivot_names(dim, "name")
    assert names == list("abcdefg")
    facts = spark.createDataFrame([(1, n, 1.5) for n in ["a", "g", "g", None, "late"]], "k long, name string, v double") \
        .withColumn("v", F.col("v").cast("decimal(18,9)"))
    got = X.pivot_sum(facts, ["k"], "name", "v", names).first().asDict()
    assert float(sum(x for c, x in got.items() if c != "k" and x is not None)) == 7.5 and float(got["other"]) == 1.5
    with pytest.raises(ValueError):
        X.pivot_names(dim, "name", limit=3)


def test_partition_guard_asks_the_plan(spark, tmp_path):
    path = str(tmp_path / "t")
    X.write_landing(frame(spark, range(1, 9), "x"), path, F.to_date("created_at"))
    table = spark.read.parquet(path)
    for bad in (table, table.where("v = 'x'"), table.where("ingest_date is not null"),
                table.where(F.date_format("ingest_date", "EEEE") == F.col("v"))):
        with pytest.raises(ValueError):
            X.require_partition_filter(bad, "ingest_date")
    assert X.require_partition_filter(table.where("ingest_date >= DATE '2024-01-07'"), "ingest_date").count() == 2
    wanted = frame(spark, (3, 5), "y").where("id > 3").select(F.to_date("created_at").alias("ingest_date"))
    wanted.write.parquet(str(tmp_path / "days"))
    days = spark.read.parquet(str(tmp_path / "days")).where("ingest_date > DATE '2024-01-02'")
    joined = X.require_partition_filter(table.join(F.broadcast(days), "ingest_date"), "ingest_date")
    assert joined.count() == 1


def test_landing_scan_prunes_by_joined_days(spark, tmp_path):
    path = str(tmp_path / "t")
    X.write_landing(frame(spark, range(1, 9), "x"), path, F.to_date("created_at"))
    frame(spark, range(1, 9), "y").select(F.to_date("created_at").alias("ingest_date"), "id").write.parquet(str(tmp_path / "days"))
    days = spark.read.parquet(str(tmp_path / "days")).where("id in (3, 5)")
    got = X.scan_landing_days(spark, path, days)
    assert rows(got, "id") == [(3,), (5,)]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan
    files = [m for m in plan.split("\n") if "FileScan" in m and "ingest_date" in m]
    assert files
