"""Check operators: NULL rules, contracts (T9), runner severities, freshness,
generation mismatch (T4), revenue recognition (T5), age buckets (T6)."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from cartwheel.functions.exprs import age_group, is_revenue_recognized, packed_key, unpacked_key
from cartwheel.operators import checks as Q
from cartwheel.plans.intermediate import int_order_items_enriched
from cartwheel.plans.staging import stg_order_items, stg_orders, stg_products
from conftest import rows


def test_generic_checks_null_rules(spark):
    df = spark.createDataFrame([(1, "a", 5), (1, "b", None), (None, "z", -1), (None, None, 2)],
                               "k long, s string, n long")
    assert Q.check_not_null(df, "s").count() == 1
    assert rows(Q.check_unique(df, "k"), "k", "n_records") == [(1, 2)]           # NULL key ignored
    assert rows(Q.check_accepted_values(df, "s", ["a", "b"]), "s") == [("z",)]   # NULL passes
    assert rows(Q.check_expression(df, "n >= 0"), "n") == [(-1,)]               # NULL passes
    parent = spark.createDataFrame([(1,)], "k long")
    assert Q.check_relationships(df, "k", parent, "k").count() == 0             # NULL excluded
    assert Q.check_unique(df, "k", "s").count() == 0


def test_null_status_and_age(spark):
    """T5: NULL status → NULL recognition; T6: NULL age → '60s+'."""
    df = spark.createDataFrame([("returned", 15), ("complete", 35), (None, None)], "s string, age long")
    out = df.select(is_revenue_recognized("s").alias("r"), age_group("age").alias("g")).collect()
    assert [(r.r, r.g) for r in out] == [(False, "10s"), (True, "30s"), (None, "60s+")]


def test_generation_mismatch_gives_null_key_without_fanout(spark):
    """T4: items reloaded under a later generation find no header (NULL key);
    an order id reused across generations never fans an item out."""
    o = spark.createDataFrame([
        (10, 1, "Complete", "M", 2, dt.datetime(2024, 1, 1), None, None, None, dt.datetime(2026, 8, 17)),
        (10, 2, "Shipped", "F", 1, dt.datetime(2025, 1, 1), None, None, None, dt.datetime(2026, 8, 18))],
        "order_id long, user_id long, status string, gender string, num_of_item long, created_at timestamp, "
        "shipped_at timestamp, delivered_at timestamp, returned_at timestamp, _ingested_at timestamp")
    it = spark.createDataFrame([
        (1, 10, 1, 5, 1, "Complete", 9.5, dt.datetime(2024, 1, 1), None, None, None, dt.datetime(2026, 8, 17)),
        (2, 10, 1, 5, 2, "Returned", 3.0, dt.datetime(2024, 1, 1), None, None, None, dt.datetime(2026, 8, 19))],
        "id long, order_id long, user_id long, product_id long, inventory_item_id long, status string, "
        "sale_price double, created_at timestamp, shipped_at timestamp, delivered_at timestamp, "
        "returned_at timestamp, _ingested_at timestamp")
    p = spark.createDataFrame([(5, "n", "b", "c", "Men", "s", 2.0, 10.0, 1, dt.datetime(2026, 8, 17))],
                              "id long, name string, brand string, category string, department string, "
                              "sku string, cost double, retail_price double, distribution_center_id long, "
                              "_ingested_at timestamp")
    e = int_order_items_enriched(stg_order_items(it), stg_orders(o), stg_products(p))
    got = {r.order_item_id: r for r in e.collect()}
    assert len(got) == 2 and e.count() == 2
    assert got[1].order_key is not None and got[2].order_key is None
    assert got[1].gross_profit == Decimal("7.500000000")
    assert got[1].discount_rate == Decimal("0.0500") and got[2].is_revenue_recognized is False


def test_contract(spark):
    contract = StructType([StructField("id", LongType()), StructField("s", StringType())])
    ok = spark.createDataFrame([("a", 1)], "s string, id long")
    assert Q.enforce_contract(ok, contract, ["id"]).columns == ["id", "s"]
    with pytest.raises(Q.ContractError):
        Q.enforce_contract(spark.createDataFrame([(1,)], "id int"), contract)
    bad = spark.createDataFrame([(None, "a")], "id long, s string")
    with pytest.raises(Exception, match="not-null contract"):
        Q.enforce_contract(bad, contract, ["id"]).collect()


def test_runner_severity(spark):
    fail = lambda: spark.range(3)
    passing = lambda: spark.range(0)
    stored = []
    res = Q.run_checks({"w": ("warn", fail), "e": ("error", passing)}, store=lambda n, df: stored.append(n))
    assert [(r.name, r.failures) for r in res] == [("w", 3), ("e", 0)] and stored == ["w"]
    with pytest.raises(Q.CheckFailed):
        Q.run_checks({"e": ("error", fail)})


def test_freshness_statuses(spark):
    now = dt.datetime(2026, 8, 18, 12)
    mk = lambda h: spark.createDataFrame([(now - dt.timedelta(hours=h),)], "_ingested_at timestamp")
    tables = {"orders": mk(5), "users": mk(13), "inventory_items": mk(40), "events": mk(7), "products": mk(99)}
    got = {r.source_name: r.freshness_status for r in Q.source_freshness(tables, now).collect()}
    assert got == {"orders": "pass", "users": "warn", "inventory_items": "error",
                   "events": "warn", "products": "exempt"}


def test_truncation_and_declared_counts(spark):
    a, b = spark.range(5), spark.range(3)
    assert rows(Q.check_fact_not_truncated(a, b)) == [(5, 3, 2)]
    assert Q.check_fact_not_truncated(a, a).count() == 0
    spec = [Q.CheckSpec("t", "id", "not_null"), Q.CheckSpec("t", "id", "unique"),
            Q.CheckSpec("t", "id", "expression", ("< 3",))]
    got = {r.check_name: r.failures for r in Q.declared_check_counts(spec, lambda n: a).collect()}
    assert got == {"not_null__t__id": 0, "unique__t__id": 0, "expression__t__id": 2}


def test_contracted_marts_match_contracts(spark):
    from cartwheel.plans.contracts import CONTRACTS
    from cartwheel.plans.models import Models
    from conftest import SF_SMOKE
    m = Models(spark, SF_SMOKE)
    for name, (schema, not_null) in CONTRACTS.items():
        out = Q.enforce_contract(getattr(m, name), schema, not_null)
        assert out.count() > 0


def test_fused_check_engine_equals_generic_checks(spark):
    """The one-pass tagged-record engine agrees with each generic check run alone."""
    from cartwheel.plans.declared_checks import DECLARED_CHECKS
    from cartwheel.plans.queries_ops import _models_with_history
    from conftest import SF_SMOKE
    m = _models_with_history(spark, SF_SMOKE)
    get = lambda n: getattr(m, n)
    specs = [s for s in DECLARED_CHECKS if s.model in ("stg_order_items", "stg_events", "fct_order_items",
                                                        "rpt_daily_funnel", "dim_products")]
    fused = {r.check_name: r.failures for r in Q.declared_check_counts(specs, get).collect()}
    for s in specs:
        df = get(s.model)
        if s.kind == "not_null":
            n = Q.check_not_null(df, s.column).count()
        elif s.kind == "accepted_values":
            n = Q.check_accepted_values(df, s.column, s.args).count()
        elif s.kind == "expression":
            n = Q.check_expression(df, f"{s.column} {s.args[0]}").count()
        elif s.kind == "unique":
            n = Q.check_unique(df, s.column).count()
        elif s.kind == "unique_combination":
            n = Q.check_unique(df, *s.args).count()
        else:
            n = Q.check_relationships(df, s.column, get(s.args[0]), s.args[1]).count()
        assert fused[s.name] == n, s.name


def test_packed_keys_keep_every_text(spark):
    texts = [None, "", "a", "ab", "AB", "0ab", "no hex", "12", "d41d8cd98f00b204e9800998ecf8427e", "D41D8CD98F00B204E9800998ECF8427E"]
    df = spark.createDataFrame([(t,) for t in texts], "k string").select("k", packed_key("k").alias("p"))
    assert all(r.k == r.u for r in df.select("k", unpacked_key("p").alias("u")).collect())
    assert df.select("p").distinct().count() == len(texts)
    assert df.where("k like 'd41%'").select(F.length("p.digest").alias("n"), "p.text").first() == (16, None)


def test_headers_match_by_generation_whatever_repeats(spark):
    """Equal order ids join only within a generation; repeated headers repeat, null ids and generations find none."""
    day = [dt.date(2026, 8, 17), dt.date(2026, 8, 18), None]
    items = spark.createDataFrame(
        [(f"k{i}", o, g) for i, (o, g) in enumerate([(1, 0), (1, 1), (1, 2), (2, 0), (None, 0), (3, 1)])], "order_item_key string, order_id long, g int")
    heads = spark.createDataFrame([("h1", 1, 0), ("h2", 1, 1), ("h3", 1, 1), ("h4", 1, 2), ("h5", None, 0), (None, 3, 1)], "order_key string, order_id long, g int")
    pick = F.when(F.col("g") == 0, F.lit(day[0])).when(F.col("g") == 1, F.lit(day[1])).alias("_load_generation")
    null = lambda kind, *names: [F.lit(None).cast(kind).alias(n) for n in names]
    items = items.select("order_item_key", "order_id", pick, *null("long", "order_item_id", "user_id", "product_id", "inventory_item_id"),
                         *null("string", "order_item_status"), *null("decimal(18,9)", "sale_price"), *null("date", "ordered_date"),
                         *null("timestamp", "ordered_at", "shipped_at", "delivered_at", "returned_at"))
    heads = heads.select("order_key", "order_id", pick, *null("string", "order_status"), *null("long", "item_count"))
    goods = spark.range(0).select(*null("long", "product_id", "distribution_center_id"), *null("decimal(18,9)", "unit_cost", "retail_price"),
                                  *null("string", "product_name", "brand_name", "category_name", "department_name"))
    out = int_order_items_enriched(items, heads, goods)
    assert rows(out, "order_item_key", "order_key") == sorted(
        [("k0", "h1"), ("k1", "h2"), ("k1", "h3"), ("k2", None), ("k3", None), ("k4", None), ("k5", None)], key=repr)


def test_checks_declared_by_two_models_count_for_both(spark):
    """The fact selects from its base row by row: both models' checks are read from the fact."""
    base = spark.createDataFrame([("a", 1, 9), ("a", None, 8), ("b", 2, 7), (None, 2, 6)], "k string, n long, more long")
    frames = {"base": base, "fact": base.select("k", "n"), "ref": spark.createDataFrame([(1,)], "n long")}
    specs = [Q.CheckSpec(m, *s) for m in ("base", "fact") for s in (("k", "unique"), ("k", "not_null"), ("n", "relationships", ("ref", "n")))]
    specs.append(Q.CheckSpec("ref", "n", "relationships", ("base", "n")))
    asked = []

    def models(name):
        asked.append(name)
        return frames[name]

    plain = rows(Q.declared_check_counts(specs, models), "check_name", "model", "failures")
    assert {r[0]: r[2] for r in plain}["unique__fact__k"] == 1
    asked.clear()
    assert rows(Q.declared_check_counts(specs, models, {"base": "fact"}), "check_name", "model", "failures") == plain
    assert sorted(asked) == ["fact", "ref"]


def test_checks_are_read_by_the_names_of_the_model_read(spark):
    """A model that another one selects from under new names: rows, keys and parents are looked up under those."""
    base = spark.createDataFrame([("a", 1), ("a", -1), ("b", None), (None, 5)], "k string, n long")
    frames = {"base": base, "fact": base.select("k", F.col("n").alias("m")), "kid": spark.createDataFrame([("a",), ("z",), ("z",), (None,)], "k string")}
    specs = [Q.CheckSpec("base", "k", "unique"), Q.CheckSpec("base", "n", "expression", ("> 0",)), Q.CheckSpec("base", "n", "not_null"),
             Q.CheckSpec("base", None, "unique_combination", ("k", "n")), Q.CheckSpec("kid", "k", "relationships", ("base", "k")), Q.CheckSpec("base", "n", "relationships", ("base", "n"))]
    plain = rows(Q.declared_check_counts(specs, frames.get), "check_name", "failures")
    assert dict(plain) == {"unique__base__k": 1, "expression__base__n": 1, "not_null__base__n": 1, "unique_combination__base__k+n": 0,
                           "relationships__kid__k": 2, "relationships__base__n": 0}
    assert rows(Q.declared_check_counts(specs, frames.get, {"base": Q.RowsIn("fact", {"n": "m"})}), "check_name", "failures") == plain


def test_relationships_share_the_owners_of_a_unique_key(spark):
    """A parent key that is checked for uniqueness emits one record a row, with several children and repeated or null keys."""
    frames = {"p": spark.createDataFrame([(1,), (1,), (2,), (None,)], "k long"), "c": spark.createDataFrame([(1, 3), (3, 2), (3, None)], "a long, b long")}
    specs = [Q.CheckSpec("p", "k", "unique"), Q.CheckSpec("c", "a", "relationships", ("p", "k")), Q.CheckSpec("c", "b", "relationships", ("p", "k"))]
    assert {r.check_name: r.failures for r in Q.declared_check_counts(specs, frames.get).collect()} == {"unique__p__k": 1, "relationships__c__a": 2, "relationships__c__b": 1}
    counted = dict(enumerate(specs[:2]))
    assert Q._tags("p", counted, Q._key_groups(counted)).count("named_struct") == 1


def test_checks_of_marked_rows(spark):
    """A model whose rows are the marked ones of another: its checks see those alone, a key that both check is counted for each."""
    fact = spark.createDataFrame([("a", 1, True), ("a", 1, False), ("b", 2, True), ("b", 3, True), (None, None, True), (None, None, False), ("c", -1, False)], "k string, n long, line boolean")
    frames = {"fact": fact, "base": fact.where("line").drop("line"), "ref": spark.createDataFrame([(1,)], "n long")}
    each = [("k", "unique"), ("k", "not_null"), ("n", "expression", ("> 1",)), ("n", "accepted_values", (1, 2)), ("n", "relationships", ("ref", "n")), (None, "unique_combination", ("k", "n"))]
    specs = [Q.CheckSpec(m, *s) for m in ("base", "fact") for s in each] + [Q.CheckSpec("ref", "n", "relationships", (m, "n")) for m in ("base", "fact")]
    asked = []
    plain = rows(Q.declared_check_counts(specs, frames.get), "check_name", "model", "failures")
    marked = Q.declared_check_counts(specs, lambda m: asked.append(m) or frames[m], {"base": Q.RowsIn("fact", where="line")})
    assert rows(marked, "check_name", "model", "failures") == plain
    got = {(r[0], r[1]): r[2] for r in plain}
    assert (got["unique__base__k", "base"], got["unique__fact__k", "fact"]) == (1, 2)
    assert sorted(asked) == ["base", "fact", "ref"]    # base only as a parent
    counted = {0: Q._place(specs[0], {"base": Q.RowsIn("fact", where="line")}), 1: specs[6]}
    assert set(Q._key_groups(counted).values()) == {1}    # one record a key


def test_packed_keys_travel_as_bytes_or_as_text(spark):
    df = spark.createDataFrame([("12345",), ("123456",), ("no",)], "k string").select("k", packed_key("k").alias("p"))
    assert all((r.p.digest is None) != (r.p.text is None) for r in df.collect())
