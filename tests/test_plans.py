"""Shapes of the physical plans that have to hold at scale."""

import re

import pytest

from tidemart.catalog import ask


@pytest.fixture
def no_broadcast(spark):
    """Plans as they are when no side is small."""
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for k in keys:
        spark.conf.set(k, "-1")
    yield
    for k in keys:
        spark.conf.unset(k)


@pytest.mark.parametrize("name", ["q01_monthly_gmv_growth", "q08_cancellation_rate", "q16_top_category_per_month"])
def test_only_the_calendar_is_broadcast(warehouse, plan, no_broadcast, name):
    text = plan(ask(name, warehouse))
    assert text.count("BroadcastExchange") == 1 and "sequence(" in text


def test_small_dimensions_are_broadcast_by_size(warehouse, plan):
    assert "BroadcastHashJoin" in plan(warehouse.order_items())


@pytest.mark.parametrize("name", ["q04_top_products", "q05_top_sellers_share", "q11_state_sales", "q13_rising_return_rate"])
def test_top_k_never_sorts_everything(warehouse, plan, name):
    assert "TakeOrderedAndProject" in plan(ask(name, warehouse))


def test_no_cross_joins(warehouse, plan):
    for name in ("q05_top_sellers_share", "w09_share_of_total", "q06_repeat_customers", "a04_demo_change"):
        text = plan(ask(name, warehouse))
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_scan_reads_only_the_columns_it_needs(warehouse, plan):
    text = plan(warehouse.raw("order_items").groupBy("seller_id").sum("quantity"))
    schema = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert {c.split(":")[0] for c in schema.split(",")} == {"l_partkey", "l_suppkey", "l_quantity"}


def test_parts_of_the_star_that_are_left_out_cost_no_join(warehouse, plan):
    assert "Join" not in plan(warehouse.fact_orders(items=False))


def test_joins_on_the_order_share_the_shuffle_of_the_orders(warehouse, plan, no_broadcast):
    text = plan(warehouse.fact_orders(items=True, payments=True, shipments=True))
    by_order = [l for l in text.splitlines() if "hashpartitioning(order_id#" in l]
    # orders, shipments once each; items and payments after their own rollups
    assert len([l for l in by_order if "order_item_id" not in l and "payment_sequential" not in l]) == 4


def test_no_python_in_the_plans(warehouse, plan):
    for name in ("q01_monthly_gmv_growth", "dq10_standard_suite", "a10_fact_orders", "w07_dense_rank_in_group"):
        assert "Python" not in plan(ask(name, warehouse))


def test_distinct_parents_meet_counted_children(warehouse, plan, no_broadcast):
    """A foreign key most rows share is one row per task by the time it meets its parent: children and parents
    are counted before the one shuffle that brings them together, and no rows are joined."""
    text = plan(ask("dq03_referential_integrity", warehouse))
    assert "Join" not in text
    meeting = [i for i, line in enumerate(text.splitlines()) if "Exchange hashpartitioning(r#" in line][-1]
    below = text.splitlines()[meeting + 1]
    assert "HashAggregate" in below and "partial_sum(n#" in below and "partial_sum(parents#" in below


def exchanges(text):
    return [l for l in text.splitlines() if "Exchange hashpartitioning(" in l]


def test_orders_meet_their_customers_while_narrow(warehouse, plan, no_broadcast):
    """The shuffle by customer is below those by order: measures are never shuffled again."""
    text = plan(ask("a10_fact_orders", warehouse))
    assert "hashpartitioning(order_id#" in exchanges(text)[0]
    assert not [l for l in exchanges(text) if "order_item_id" in l or "payment_sequential" in l]


def test_one_shuffle_by_order_serves_copies_sums_and_joins(warehouse, plan, no_broadcast):
    for df in (warehouse.fact_order_items(False), warehouse.fact_payments, ask("dq16_model_unique", warehouse)):
        assert not [l for l in exchanges(plan(df)) if "order_item_id" in l or "payment_sequential" in l]
    # one distinct count per product in place, then products
    assert not [l for l in exchanges(plan(ask("a17_product_performance", warehouse))) if "order_id#" in l and "product_id#" in l]
    # lines meet products last: the topmost shuffle is by product
    assert "hashpartitioning(product_id#" in exchanges(plan(warehouse.fact_order_items()))[0]


def test_lines_of_other_orders_are_left_out_before_the_shuffle(spark, warehouse, plan, no_broadcast):
    recent = warehouse.table("orders").selectExpr("o_orderkey AS order_id").limit(20)
    kept = spark.createDataFrame(recent.collect(), recent.schema)
    text = plan(warehouse.lines_of(kept))
    assert text.index("REPARTITION_BY_COL") < text.index("BroadcastHashJoin") and "LeftSemi" in text
    want = warehouse.order_items(False).join(kept, "order_id", "left_semi")
    assert sorted(map(str, warehouse.lines_of(kept).collect())) == sorted(map(str, want.collect()))
