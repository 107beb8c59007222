from datetime import date, datetime
from decimal import Decimal as D

from pyspark.sql import functions as F

from tidemart.operators.dedup import dedup_latest
from tidemart.operators.split import split_orphans, split_quarantine
from tidemart.plans import silver

ORDERS = (
    "order_id string, customer_id string, order_status string, order_purchase_ts string,"
    " order_approved_ts string, payment_type string"
)


def test_dedup_takes_the_latest_and_nulls_last(rows):
    df = rows("id int, at string, v string", (1, "2024-01-01", "a"), (1, None, "b"), (1, "2024-01-02", "c"))
    assert dedup_latest(df, ["id"], ["at"]).collect() == [(1, "2024-01-02", "c")]


def test_dedup_tie_does_not_depend_on_partitioning(rows):
    df = rows("id int, at int, v string", *[(1, 5, f"v{i}") for i in range(40)])
    picks = {
        dedup_latest(df.repartition(n, "v"), ["id"], ["at"]).first().v for n in (1, 3, 7)
    }
    assert len(picks) == 1


def test_hot_key_is_cut_before_the_shuffle(spark, plan):
    df = spark.range(1000).selectExpr("id % 2 AS id", "id AS at")
    text = plan(dedup_latest(df, ["id"], ["at"]))
    below = text[text.index("Exchange hashpartitioning"):]
    assert "WindowGroupLimit" in below and "Partial" in below


def test_orders(rows):
    df = rows(
        ORDERS,
        ("o1", "c1", " Delivered ", "2024-01-01 10:00:00", "2024-01-01 11:00:00", "COD"),
        ("o1", "c1", " Delivered ", "2024-01-01 10:00:00", "2024-01-01 11:00:00", "COD"),
        ("o2", "c1", "CANCELLED", "2024-01-01 10:00:00", None, None),
        ("o3", "c1", "shipped", "2023-12-31 09:00:00", None, "UPI"),
        ("o4", "c2", "shipped", "garbage", None, "cod"),
        (None, "c2", "shipped", "2024-01-01 10:00:00", None, "UPI"),
        ("o5", None, "shipped", "2024-01-01 10:00:00", None, "UPI"),
    )
    out = silver.with_order_sequence(silver.clean_orders(df))
    got = {r.order_id: r for r in out.collect()}
    assert set(got) == {"o1", "o2", "o3", "o4"}
    assert [got[k].customer_order_seq for k in ("o3", "o1", "o2", "o4")] == [1, 2, 3, 1]
    assert [got[k].is_repeat_order for k in ("o3", "o1", "o2", "o4")] == [0, 1, 1, 0]
    assert [got[k].is_cod for k in ("o1", "o2", "o3", "o4")] == [1, None, 0, 0]
    assert got["o1"].order_status == "delivered" and got["o1"].order_month == 1
    assert got["o4"].order_purchase_ts is None and got["o4"].order_date is None
    flags = silver.with_repeat_flag(silver.clean_orders(df))
    assert {r.order_id: r.is_repeat_order for r in flags.collect()} == {
        k: r.is_repeat_order for k, r in got.items()
    }


def test_items_keep_positive_quantity_and_recompute_totals(rows):
    df = rows(
        "order_id string, order_item_id int, product_id string, seller_id string, quantity int,"
        " unit_price_inr double, discount_inr double, freight_inr double, line_total_inr double",
        ("o1", 1, "p1", "s1", 2, 10.005, 1.0, 5.0, 999.0),
        ("o1", 2, "p1", "s1", 0, 10.0, None, None, None),
        ("o1", 3, "p1", "s1", -2, 10.0, None, None, None),
        ("o1", 4, "p1", "s1", None, 10.0, None, None, None),
        ("o1", 5, "p1", "s1", 3, 10.0, None, None, None),
        ("o1", None, "p1", "s1", 1, 10.0, None, None, None),
        ("o1", 7, None, "s1", 1, 10.0, None, None, None),
    )
    got = {r.order_item_id: r.line_total_inr for r in silver.usable_items(df).collect()}
    assert got == {1: D("25.02"), 5: D("30.00")}


def test_products_payments_customers(rows):
    products = rows(
        "product_id string, product_name string, category string, subcategory string,"
        " brand string, mrp_inr double, weight_grams int",
        ("p1", "a", "HOME AND KITCHEN", None, None, -10.0, None), ("p2", "b", None, None, None, 5.5, 1),
    )
    got = {r.product_id: r for r in silver.clean_products(products).collect()}
    assert got["p1"].mrp_inr is None and got["p1"].category == "Home & Kitchen"
    assert got["p2"].mrp_inr == D("5.50")

    payments = rows(
        "order_id string, payment_sequential int, payment_type string, payment_installments int,"
        " payment_value_inr double, payment_status string",
        ("o1", 1, "UPI", 1, None, "success"), ("o1", 2, "UPI", 1, 7.0, None),
    )
    got = [tuple(r) for r in silver.clean_payments(payments).orderBy("payment_sequential").select(
        "payment_value_inr", "payment_value_missing", "payment_status").collect()]
    assert got == [(D("0.00"), 1, "paid"), (D("7.00"), 0, "unknown")]

    customers = rows(
        "customer_id string, city string, state string, signup_date string",
        ("c1", "bombay", None, "2024-01-01"), ("c1", "pune", " goa", "2024-02-01"), ("c2", None, "X", "?"),
    )
    got = {r.customer_id: r for r in silver.clean_customers(customers).collect()}
    assert (got["c1"].city, got["c1"].state, got["c1"].signup_date) == ("Pune", "Goa", date(2024, 2, 1))
    assert (got["c2"].city, got["c2"].signup_date) == ("Unknown", None)


SHIPMENTS = (
    "order_id string, carrier string, ship_ts string, estimated_delivery_date string,"
    " delivered_ts string, delivery_status string"
)


def test_every_shipment_is_on_exactly_one_side(rows):
    df = rows(
        SHIPMENTS,
        ("ok", "A", "2024-01-01 10:00:00", "2024-01-03", "2024-01-04 01:00:00", "d"),
        ("back", "A", "2024-01-10 10:00:00", "2024-01-03", "2024-01-05 01:00:00", "d"),
        ("far", "A", "2024-01-01 10:00:00", "2024-01-03", "2099-01-01 00:00:00", "d"),
        ("noship", "A", None, "2024-01-03", "2024-01-03 01:00:00", "d"),
        ("open", "A", "2024-01-01 10:00:00", "2024-01-03", None, "t"),
        ("ok", "A", "2024-01-01 10:00:00", "2024-01-03", None, "t"),
    )
    parsed = silver.parse_shipments(df)
    clean, bad = silver.split_shipments(parsed)
    good = {r.order_id: (r.delivery_days, r.is_late) for r in clean.collect()}
    assert good == {"ok": (3, 1), "noship": (None, 0), "open": (None, None)}
    assert {r.order_id: r.quarantine_reasons for r in bad.collect()} == {
        "back": ["delivered_before_shipped"], "far": ["delivered_in_far_future"],
    }


def test_split_with_null_condition_keeps_the_row(rows):
    df = rows("x int", (1,), (None,), (-1,))
    clean, bad = split_quarantine(df, {"negative": F.col("x") < 0, "one": F.col("x") == 1})
    assert [r.x for r in clean.collect()] == [None]
    assert sorted((r.x, r.quarantine_reasons[0]) for r in bad.collect()) == [(-1, "negative"), (1, "one")]


def test_orphans(rows):
    child = rows("order_id string, n int", ("a", 1), ("z", 2), (None, 3))
    parent = rows("order_id string", ("a",), ("a",), ("b",))
    known, orphans = split_orphans(child, parent, "order_id")
    assert [r.n for r in known.collect()] == [1]
    assert sorted(r.n for r in orphans.collect()) == [2, 3]


def test_returns_days(rows):
    df = rows(
        "return_id string, refund_amount_inr double, return_requested_ts string,"
        " return_completed_ts string",
        ("r1", 5.0, "2023-01-29 14:37:47", "2023-01-31 14:37:47"), ("r2", 5.0, "2023-01-29", None),
    )
    got = {r.return_id: r.days_to_return_complete for r in silver.clean_returns(df).collect()}
    assert got == {"r1": 2, "r2": None}
    assert datetime(2023, 1, 29, 14, 37, 47) in [r.return_requested_ts for r in silver.clean_returns(df).collect()]
