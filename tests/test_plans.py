"""Plan-shape guards for the scale properties (read from explain())."""

import contextlib
import io
import re

from cartwheel.operators.checks import declared_check_counts
from cartwheel.plans.declared_checks import DECLARED_CHECKS, ROWS_IN
from cartwheel.plans.models import Models
from conftest import SF_SMALL


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def test_sessionization_shuffles_events_by_user_and_bucket(spark):
    p = plan(Models(spark, SF_SMALL).int_events_sessionized)
    exchanges = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", p)
    by_bucket = [e for e in exchanges if "_bucket" in e]
    by_user_only = [e for e in exchanges if "_bucket" not in e]
    # wide event rows + narrow (user, bucket, time) projection
    assert len(by_bucket) == 2, exchanges
    # the only user-keyed exchange carries per-bucket summaries
    assert len(by_user_only) == 1, exchanges
    assert p.count("FileScan parquet") == 2


def test_revenue_report_reads_line_items_once(spark):
    p = plan(Models(spark, SF_SMALL).rpt_daily_revenue)
    assert len(re.findall(r"FileScan parquet \S*\[l_orderkey", p)) == 1
    assert "BroadcastExchange" in p            # size-checked product dimension


def test_distinct_counts_copy_no_rows(spark):
    m = Models(spark, SF_SMALL)
    for df in (m.fct_sessions, m.rpt_daily_revenue):
        assert "Expand" not in plan(df)


@contextlib.contextmanager
def no_broadcast(spark):
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def test_items_are_dealt_by_order_once_and_narrow(spark):
    with no_broadcast(spark):
        p = plan(Models(spark, SF_SMALL).int_order_items_enriched)
    dealt = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", p)
    assert len(dealt) == 5, dealt               # lines, two reads of orders, items and products by product
    assert not [e for e in dealt if "_load_generation" in e]


def test_revenue_counts_orders_by_packed_keys(spark):
    dealt = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan(Models(spark, SF_SMALL).rpt_daily_revenue))
    assert any(e.startswith("ordered_date") for e in dealt) and not [e for e in dealt if "order_key" in e], dealt


def test_line_count_joins_keep_their_partitions(spark):
    p = plan(Models(spark, SF_SMALL).stg_order_items)
    assert "REPARTITION_BY_NUM" in p            # AQE folds no such partitions into one task


def test_checks_of_item_models_read_one_frame(spark):
    m = Models(spark, SF_SMALL)
    specs = [s for s in DECLARED_CHECKS if s.model in ("int_order_items_enriched", "fct_order_items") and s.kind == "unique"]
    p = plan(declared_check_counts(specs, lambda n: getattr(m, n), ROWS_IN))
    assert len(specs) == 2 and len(re.findall(r"FileScan parquet \S*\[l_orderkey", p)) == 1
