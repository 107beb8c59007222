"""Joins."""

from pyspark.sql import functions as F

from tidemart.catalog.history import two_snapshots
from tidemart.catalog.registry import query
from tidemart.operators.incremental import since_watermark
from tidemart.operators.asof import as_of_merge
from tidemart.operators.scd2 import as_of
from tidemart.operators.split import with_parent, without_parent
from tidemart.plans import marts
from tidemart.plans.silver import enrich_items


def order_batch(w):
    """Orders after a high-water mark: the parents a batch alone would know."""
    return since_watermark(w.orders(), "order_purchase_ts", "1998-01-01 00:00:00")


query("j01_lines_of_known_orders")(
    lambda w: with_parent(w.order_items(False), order_batch(w), "order_id").select(
        "order_id", "order_item_id"
    )
)
query("j02_orphan_lines")(
    lambda w: without_parent(w.order_items(False), order_batch(w), "order_id").select(
        "order_id", "order_item_id"
    )
)
query("j03_product_enrichment")(
    lambda w: enrich_items(w.order_items(False), w.products).select(
        "order_id", "order_item_id", "category", "subcategory", "brand"
    )
)


@query("j04_facts_with_orders")
def _(w):
    parts = {
        "fact_order_items": w.fact_order_items(False),
        "fact_payments": w.fact_payments,
        "fact_shipments": w.fact_shipments,
        "fact_returns": w.fact_returns,
    }
    out = None
    for name, df in parts.items():
        n = df.agg(
            F.count("*").alias("rows_n"), F.countDistinct("customer_id").alias("customers_n")
        ).select(F.lit(name).alias("fact"), "rows_n", "customers_n")
        out = n if out is None else out.unionByName(n)
    return out


query("j05_star_assembly")(
    lambda w: w.fact_orders(True, True, True, True)
    .groupBy("payment_status_final", "is_late", "order_status")
    .agg(
        F.count("*").alias("orders_n"),
        F.sum("gmv_inr").alias("gmv_inr"),
        F.sum("paid_inr").alias("paid_inr"),
        F.countDistinct("location_key").alias("places"),
    )
)
query("j06_fact_with_calendar")(
    lambda w: marts.with_calendar(
        w.fact_orders(items=False), w.dim_date, "fiscal_year", "quarter", "is_weekend"
    )
    .groupBy("fiscal_year", "quarter", "is_weekend")
    .agg(F.count("*").alias("orders_n"))
)
query("j07_returned_lines")(
    lambda w: w.fact_order_items(False)
    .select(*marts.LINE, "seller_id")
    .join(w.fact_returns.select(*marts.LINE, "return_id"), marts.LINE)
)
query("j08_line_return_flag")(
    lambda w: w.fact_order_items(False)
    .select(*marts.LINE)
    .join(
        w.fact_returns.select(*marts.LINE).distinct().withColumn("_hit", F.lit(1)),
        marts.LINE, "left",
    )
    .select(*marts.LINE, F.col("_hit").isNotNull().cast("int").alias("is_returned"))
)


@query("j09_dimension_keeps_all_rows")
def _(w):
    ordered = w.fact_orders(items=False).groupBy("customer_id").agg(F.count("*").alias("n"))
    return w.dim_customer.join(ordered, "customer_id", "left").select(
        "customer_id", F.coalesce("n", F.lit(0)).alias("orders_n")
    )


@query("j10_residual_range")
def _(w):
    """Orders placed on or after the customer's signup."""
    placed = w.orders().select("order_id", "customer_id", "order_date")
    return (
        w.customers.select("customer_id", "signup_date")
        .join(placed, "customer_id")
        .filter("order_date >= signup_date")
        .select("order_id", "customer_id")
    )


@query("j11_location_lookup")
def _(w):
    place = w.dim_location.select("city", "state", "region", "is_metro")
    return (
        w.dim_seller.select("seller_id", F.col("seller_city").alias("city"), F.col("seller_state").alias("state"))
        .join(place, ["city", "state"])
        .select("seller_id", "region", "is_metro")
    )


@query("j12_broken_references")
def _(w):
    """Lines whose product is not in the catalogue of premium-priced products; null passes."""
    catalogue = w.products.filter("mrp_inr >= 1000").select("product_id").distinct()
    lines = w.raw("order_items").filter("product_id is not null")
    missing = lines.join(catalogue, "product_id", "left_anti")
    return missing.groupBy("product_id").agg(F.count("*").alias("lines"))


@query("j13_seller_as_of_order")
def _(w):
    """Each line with the seller's attributes on the day of the order."""
    lines = w.fact_order_items(False).select("order_id", "order_item_id", "seller_id", "order_date")
    attributes = ["seller_city", "seller_rating", "business_type"]
    return as_of(lines, two_snapshots(w), "seller_id", "order_date", attributes)


@query("j13_seller_as_of_order_open_start")
def _(w):
    """As above, with first versions reaching back to the beginning."""
    lines = w.fact_order_items(False).select("order_id", "order_item_id", "seller_id", "order_date")
    found = as_of(lines, two_snapshots(w), "seller_id", "order_date", ["business_type"], open_start=True)
    return found.groupBy("business_type").agg(F.count("*").alias("lines"))


@query("j13_seller_as_of_order_merged")
def _(w):
    """The first of these as a merge in time, in buckets of 30 days."""
    lines = w.fact_order_items(False).select("order_id", "order_item_id", "seller_id", "order_date")
    attributes = ["seller_city", "seller_rating", "business_type"]
    return as_of_merge(lines, two_snapshots(w), "seller_id", "order_date", attributes, bucket_seconds=30 * 86_400)


@query("j13_last_purchase_before_event")
def _(w):
    """Each event with its user's purchase before or at it: as many versions as purchases."""
    events = w.table("events")
    bought = events.where("event_type = 'purchase'").select(
        "user_id", F.col("ts").alias("valid_from"), F.col("event_id").alias("purchase_id"), F.col("value").alias("paid"))
    return as_of_merge(
        events.select("event_id", "user_id", "ts", "event_type"), bought, "user_id", "ts", ["purchase_id", "paid"], end=None)


query("j14_raw_lines_with_category")(
    lambda w: w.raw("order_items")
    .join(w.raw("products").select("product_id", "category"), "product_id", "left")
    .groupBy("category")
    .agg(F.count("*").alias("lines"))
)


@query("j15_orders_with_line_totals")
def _(w):
    totals = w.fact_order_items(False).groupBy("order_id").agg(
        F.sum("line_total_inr").alias("items_total")
    )
    return w.fact_orders().select("order_id", "order_value_inr").join(totals, "order_id")
