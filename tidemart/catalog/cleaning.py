"""Filters, projections and cleaning."""

from pyspark.sql import functions as F

from tidemart.catalog.registry import query
from tidemart.functions import text
from tidemart.functions.dates import parse_date, parse_ts
from tidemart.operators.split import split_quarantine
from tidemart.plans import silver, star
from tidemart.sources.crosswalk import LATEST

ITEM_KEYS = ["order_id", "order_item_id", "product_id"]

query("pf01_required_keys")(
    lambda w: silver.require(w.raw("order_items"), ITEM_KEYS).select(
        *ITEM_KEYS, "seller_id", "unit_price_inr"
    )
)
query("pf02_positive_quantity")(
    lambda w: w.raw("order_items").filter("quantity > 0").select(
        "order_id", "order_item_id", "seller_id", "quantity"
    )
)


@query("pf03_canonical_city")
def _(w):
    city = text.standard_city(F.col("city"))
    return w.raw("customers").select("customer_id", city.alias("city"))


@query("pf04_canonical_payment_status")
def _(w):
    status = text.standard_payment_status(F.col("payment_status")).alias("payment_status")
    return w.raw("payments").groupBy(status).agg(F.count("*").alias("records"))


@query("pf05_canonical_category")
def _(w):
    category = text.standard_category(F.col("category"))
    return w.raw("products").select("product_id", category.alias("category"))


@query("pf06_clean_state")
def _(w):
    state = text.or_unknown(text.title(F.col("state")))
    return w.raw("customers").select("customer_id", state.alias("state"))


@query("pf07_unknown_fill")
def _(w):
    return w.raw("customers").select(
        "customer_id",
        text.or_unknown(F.col("city")).alias("city"),
        text.or_unknown(F.col("email")).alias("email"),
    )


query("pf08_negative_price_to_null")(lambda w: w.products.select("product_id", "mrp_inr"))
query("pf09_missing_payment_value")(
    lambda w: w.payments.select(
        "order_id", "payment_sequential", "payment_value_inr", "payment_value_missing"
    )
)


@query("pf10_order_status")
def _(w):
    status = text.normal_key(F.col("order_status")).alias("order_status")
    return w.raw("orders").groupBy(status).agg(F.count("*").alias("orders"))


query("pf11_cod_flag")(lambda w: w.orders().groupBy("is_cod").agg(F.count("*").alias("orders")))
query("pf12_order_date_parts")(
    lambda w: w.orders().select("order_id", "order_date", "order_year", "order_month")
)
query("pf13_line_total")(
    lambda w: w.order_items(False).select("order_id", "order_item_id", "line_total_inr")
)
query("pf14_delivery_days")(lambda w: w.shipments.select("order_id", "delivery_days"))
query("pf15_late_flag")(
    lambda w: w.shipments.groupBy("is_late").agg(F.count("*").alias("shipments"))
)
query("pf16_days_to_return_complete")(
    lambda w: w.returns.select("return_id", "days_to_return_complete")
)


@query("pf17_timeline_split")
def _(w):
    """Both halves, so that a row in neither or in both shows."""
    clean, bad = split_quarantine(w.parsed_shipments, silver.timeline_faults())
    reasons = F.concat_ws(",", "quarantine_reasons")
    return clean.select("order_id", F.lit("clean").alias("side"), F.lit("").alias("reasons")).unionByName(
        bad.select("order_id", F.lit("quarantine").alias("side"), reasons.alias("reasons"))
    )


query("pf18_stg_customers")(lambda w: w.stg_customers)
query("pf18_stg_sellers")(lambda w: w.stg_sellers)
query("pf18_stg_products")(lambda w: w.stg_products)
query("pf18_stg_orders")(lambda w: w.stg_orders("full"))
query("pf18_stg_order_items")(lambda w: w.stg_order_items())
query("pf18_stg_payments")(lambda w: w.stg_payments)
query("pf18_stg_shipments")(lambda w: w.stg_shipments)
query("pf18_stg_returns")(lambda w: w.stg_returns)

query("pf19_weight_band")(
    lambda w: w.products.groupBy(
        star.weight_band(F.col("weight_grams")).alias("weight_band")
    ).agg(F.count("*").alias("products"))
)
query("pf20_region")(
    lambda w: w.customers.groupBy(star.region_of(F.col("state")).alias("region")).agg(
        F.count("*").alias("customers_n")
    )
)
query("pf21_metro")(
    lambda w: w.dim_location.groupBy("is_metro").agg(F.count("*").alias("places"))
)
query("pf22_blank_to_unknown")(
    lambda w: w.raw("customers").select(
        "customer_id", text.blank_to_unknown(F.col("city")).alias("city")
    )
)
query("pf23_status_flags")(
    lambda w: w.fact_orders(items=False)
    .groupBy("order_status")
    .agg(*[F.sum(c).alias(c) for c in ("is_cancelled", "is_returned", "is_delivered")])
)
query("pf24_gross_line_value")(
    lambda w: w.fact_order_items(False).select(
        "order_id", "order_item_id", "gross_line_value_inr"
    )
)


@query("pf25_timestamp_text")
def _(w):
    """Times written out as text, one in nine of them broken, read back."""
    broken = F.col("o_orderkey") % 9 == 0
    written = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    texts = w.table("orders").select(
        "o_orderkey", F.when(broken, F.concat(F.lit("on "), written)).otherwise(written).alias("x")
    )
    return texts.select(
        "o_orderkey", parse_ts(F.col("x")).alias("parsed_ts"), parse_date(F.col("x")).alias("parsed_date")
    )


query("pf26_clean_customers")(lambda w: w.customers)
query("pf26_clean_sellers")(lambda w: w.sellers)
query("pf26_clean_products")(lambda w: w.products)
query("pf26_clean_orders")(lambda w: w.orders("full"))
query("pf26_clean_order_items")(
    lambda w: silver.of_known_orders(w.order_items(), w.orders()).drop("updated_ts")
)
query("pf26_clean_payments")(
    lambda w: silver.of_known_orders(w.payments, w.orders()).drop("updated_ts", *LATEST["payments"][1])
)
query("pf26_clean_shipments")(
    lambda w: silver.of_known_orders(w.shipments, w.orders()).drop(*LATEST["shipments"][1])
)
query("pf26_clean_returns")(lambda w: silver.of_known_orders(w.returns, w.orders()))
