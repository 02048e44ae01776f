"""Load strategies: window overwrite (T1, T12), full replace, insert-only,
dispatch errors (S7, S16), idempotence."""

import datetime as dt

import pytest

from cartwheel.sources.loads import (insert_only_delta, landed_days, load_full_replace, load_insert_only,
                                     load_table, load_window_overwrite, read_landed, resolve_window,
                                     run_loads, with_ingested_at)
from cartwheel.sources.registry import LANDINGS, Landing
from conftest import rows

SCHEMA = "id long, created_at timestamp, v string"


def d(day, hour=12):
    return dt.datetime(2024, 1, day, hour)


def read(spark, path):
    return rows(spark.read.parquet(path).drop("_partition_date"), "id", "v")


def test_window_overwrite_deletes_days_missing_from_source(spark, tmp_path):
    """Target D1–D5, source lacks D3, window D2–D4 → D3 rows are gone."""
    path = str(tmp_path / "events")
    target = spark.createDataFrame([(i, d(i), "old") for i in range(1, 6)], SCHEMA)
    load_window_overwrite(spark, target, path, "created_at", "2024-01-01", "2024-01-05")
    src = spark.createDataFrame([(2, d(2), "new"), (4, d(4), "new"), (9, None, "nulltime")], SCHEMA)
    for _ in range(2):  # rerun with the same arguments → same table
        rep = load_window_overwrite(spark, src, path, "created_at", "2024-01-02", "2024-01-04")
        assert read(spark, path) == [(1, "old"), (2, "new"), (4, "new"), (5, "old")]
    assert rep["written_days"] == ["2024-01-02", "2024-01-04"]


def test_null_event_time_is_in_no_window(spark, tmp_path):
    """A NULL event time is neither inserted nor deleted by a window load."""
    path = str(tmp_path / "t")
    src = spark.createDataFrame([(1, d(1), "a"), (2, None, "b")], SCHEMA)
    load_window_overwrite(spark, src, path, "created_at", "2024-01-01", "2024-01-31")
    assert read(spark, path) == [(1, "a")]


def test_full_replace(spark, tmp_path):
    path = str(tmp_path / "users")
    load_full_replace(spark, spark.createDataFrame([(1, d(1), "a"), (2, d(1), "b")], SCHEMA), path)
    load_full_replace(spark, spark.createDataFrame([(3, d(1), "c")], SCHEMA), path)
    assert read(spark, path) == [(3, "c")]


def test_insert_only_never_updates(spark, tmp_path):
    """target {1,2}, source {1 changed, 2, 3} → only 3 added, 1 unchanged; rerun no-op."""
    path = str(tmp_path / "products")
    load_insert_only(spark, spark.createDataFrame([(1, d(1), "a"), (2, d(1), "b")], SCHEMA), path, "id")
    src = spark.createDataFrame([(1, d(1), "CHANGED"), (2, d(1), "b"), (3, d(1), "c")], SCHEMA)
    for _ in range(2):
        load_insert_only(spark, src, path, "id")
        assert read(spark, path) == [(1, "a"), (2, "b"), (3, "c")]
    assert insert_only_delta(src, spark.read.parquet(path), "id").count() == 0


def test_unknown_strategy_and_table(spark, tmp_path):
    df = spark.createDataFrame([(1, d(1), "a")], SCHEMA)
    with pytest.raises(ValueError):
        load_table(spark, Landing("upsert_everything"), df, str(tmp_path / "x"))
    with pytest.raises(KeyError):
        run_loads(spark, {}, str(tmp_path), tables=["orders", "nope"])


def test_dry_run_writes_nothing(spark, tmp_path):
    rep = run_loads(spark, {}, str(tmp_path / "raw"), run_date=dt.date(2024, 1, 10), dry_run=True)
    assert rep["orders"]["window"] == ("2024-01-07", "2024-01-10")
    assert rep["users"]["window"] is None
    assert not (tmp_path / "raw").exists()


def test_ingested_at_is_injected(spark):
    df = with_ingested_at(spark.createDataFrame([(1, d(1), "a")], SCHEMA), dt.datetime(2026, 8, 17, 3))
    assert df.first()._ingested_at == dt.datetime(2026, 8, 17, 3)


def test_registry_strategies():
    assert LANDINGS["events"].mode == "partition_overwrite"
    assert LANDINGS["users"].mode == "full_replace"
    assert LANDINGS["products"].mode == "merge_insert_only"
    assert LANDINGS["orders"].key == "order_id"


def test_lone_window_bound_is_an_error():
    with pytest.raises(ValueError):
        resolve_window(start=dt.date(2024, 1, 1))


def test_landed_days_prunes_day_folders(spark, tmp_path, capsys):
    src = spark.createDataFrame([(i, d(i), "x") for i in range(1, 9)], SCHEMA)
    load_window_overwrite(spark, src, str(tmp_path / "events"), "created_at", "2024-01-01", "2024-01-31")
    got = landed_days(read_landed(spark, str(tmp_path), "events"), "2024-01-03", "2024-01-05").select("id")
    assert rows(got) == [(3,), (4,), (5,)]
    got.explain()
    assert "PartitionFilters: [isnotnull(_partition_date" in capsys.readouterr().out


def test_cli_unknown_table_exits_2(spark, tmp_path, capsys):
    from cartwheel.jobs import main
    assert main(["load", "--source-dir", "/nonexistent", "--root", str(tmp_path),
                 "--tables", "orders,nope"], spark=spark) == 2
    assert "nope" in capsys.readouterr().err
    assert main(["load", "--source-dir", "/root/testdata/sf0.001", "--root", str(tmp_path),
                 "--tables", "users", "--dry-run"], spark=spark) == 0
    assert not (tmp_path / "raw").exists()
