"""Dimensions and facts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.contracts import METRO_CITIES, REGION_STATES
from tidemart.functions.dates import date_key, fiscal_year, month_start
from tidemart.functions.keys import surrogate_key
from tidemart.functions.text import blank_to_unknown
from tidemart.operators.summaries import distinct_union, strongest

STATUS_PRECEDENCE = ("refunded", "paid", "pending", "failed")

# ------------------------------------------------------------------ dimensions


def dim_date(spine: DataFrame) -> DataFrame:
    d = F.col("full_date")
    iso_day = F.weekday(d) + 1
    return spine.select(
        date_key(d).alias("date_key"),
        d,
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.dayofmonth(d).alias("day_of_month"),
        iso_day.alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.weekofyear(d).alias("week_of_year"),
        iso_day.isin(6, 7).alias("is_weekend"),
        (d == month_start(d)).alias("is_month_start"),
        (d == F.last_day(d)).alias("is_month_end"),
        fiscal_year(d).alias("fiscal_year"),
    )


def dim_customer(stg: DataFrame) -> DataFrame:
    return stg.select(
        "customer_id", "customer_name", "email", "phone", "city", "state", "pincode",
        "signup_date", "customer_segment",
    )


def weight_band(grams: Column, light: int = 500, medium: int = 5000) -> Column:
    return F.when(grams < light, "Light").when(grams < medium, "Medium").otherwise("Heavy")


def dim_product(stg: DataFrame) -> DataFrame:
    return stg.select(
        "product_id", "product_name", "category", "subcategory", "brand", "mrp_inr",
        "weight_grams", weight_band(F.col("weight_grams")).alias("weight_band"),
    )


def dim_seller(stg: DataFrame) -> DataFrame:
    return stg.select(
        "seller_id", "seller_name", "seller_city", "seller_state", "seller_tier",
        "seller_pincode", "onboarded_date", "seller_rating", "business_type",
    )


def region_of(state: Column) -> Column:
    """Sales region by state name, whatever its casing."""
    out = F.when(F.lit(False), F.lit(None))
    for region, states in REGION_STATES.items():
        out = out.when(F.lower(state).isin([s.lower() for s in states]), F.lit(region))
    return out.otherwise(F.lit("Other"))


def location_key(city: Column, state: Column) -> Column:
    """The same key for the dimension and the facts."""
    return surrogate_key(blank_to_unknown(city), blank_to_unknown(state))


def dim_location(customers: DataFrame, sellers: DataFrame) -> DataFrame:
    places = distinct_union(
        customers.select(
            blank_to_unknown(F.col("city")).alias("city"),
            blank_to_unknown(F.col("state")).alias("state"),
        ),
        sellers.select(
            blank_to_unknown(F.col("seller_city")), blank_to_unknown(F.col("seller_state"))
        ),
    )
    return places.select(
        location_key(F.col("city"), F.col("state")).alias("location_key"),
        "city",
        "state",
        region_of(F.col("state")).alias("region"),
        F.col("city").isin(*METRO_CITIES).alias("is_metro"),
    )


# --------------------------------------------------------------- order rollups


def order_item_metrics(items: DataFrame) -> DataFrame:
    """Item measures per order."""
    return items.groupBy("order_id").agg(
        F.count("*").alias("n_items"),
        F.sum("quantity").alias("total_units"),
        # sets as large as one order; two distinct counts would triple the lines before the shuffle
        F.size(F.collect_set("product_id")).cast("long").alias("n_distinct_products"),
        F.size(F.collect_set("seller_id")).cast("long").alias("n_distinct_sellers"),
        F.sum(F.col("unit_price_inr") * F.col("quantity")).alias("gross_merchandise_value_inr"),
        F.sum("discount_inr").alias("total_discount_inr"),
        F.sum("freight_inr").alias("total_freight_inr"),
        F.sum("line_total_inr").alias("order_line_total_inr"),
    )


def order_payments(payments: DataFrame) -> DataFrame:
    """Payment measures per order and its strongest payment outcome."""
    return payments.groupBy("order_id").agg(
        F.sum("payment_value_inr").alias("order_paid_inr"),
        F.max("payment_installments").alias("max_installments"),
        F.count("*").alias("n_payment_records"),
        strongest(F.col("payment_status"), STATUS_PRECEDENCE, "unknown").alias(
            "payment_status_final"
        ),
    )


# ------------------------------------------------------------------------ facts


def fact_orders(
    orders: DataFrame,
    items: DataFrame | None = None,
    payments: DataFrame | None = None,
    shipments: DataFrame | None = None,
    customers: DataFrame | None = None,
) -> DataFrame:
    """One row per order: item, payment and shipment measures and customer geography.

    Every side comes aggregated or unique per order, so no join multiplies rows. A side
    that is left out leaves its columns out, which spares a query the joins it does not use.
    Orders meet their customers while they are narrow, where a repeat flag has just dealt them
    by customer; all joins on the order then share one shuffle.
    """
    df = orders
    status = F.col("order_status")
    if customers is not None:
        df = df.join(customers.select("customer_id", "city", "state"), "customer_id", "left")
    columns = ["order_id", "customer_id", date_key(F.col("order_date")).alias("order_date_key")]
    if customers is not None:
        columns.append(location_key(F.col("city"), F.col("state")).alias("location_key"))
    columns += ["order_status", "payment_type", "is_cod"]
    columns += ["is_repeat_order"] if "is_repeat_order" in orders.columns else []
    if items is not None:
        df = df.join(order_item_metrics(items), "order_id", "left")
        for source, name in (
            ("gross_merchandise_value_inr", "gmv_inr"),
            ("order_line_total_inr", "order_value_inr"),
            ("total_units", "total_units"),
            ("n_items", "n_items"),
            ("total_discount_inr", "discount_inr"),
            ("total_freight_inr", "freight_inr"),
        ):
            columns.append(F.coalesce(F.col(source), F.lit(0)).alias(name))
    if payments is not None:
        df = df.join(order_payments(payments), "order_id", "left")
        columns.append(F.coalesce("order_paid_inr", F.lit(0)).alias("paid_inr"))
        columns.append("payment_status_final")
    if shipments is not None:
        sla = shipments.select("order_id", "delivery_days", "is_late")
        df = df.join(sla, "order_id", "left")
        columns += ["delivery_days", "is_late"]
    columns += [
        (status == name).cast("int").alias(f"is_{name}")
        for name in ("cancelled", "returned", "delivered")
    ]
    return df.select(*columns)


def _with_order(child: DataFrame, orders: DataFrame, *extra: str) -> DataFrame:
    return child.join(orders.select("order_id", "customer_id", "order_date", *extra), "order_id")


def fact_order_items(items: DataFrame, orders: DataFrame) -> DataFrame:
    attributes = [c for c in ("category", "brand") if c in items.columns]
    return _with_order(items, orders, "order_status").select(
        "order_id", "order_item_id", "product_id", "seller_id", "customer_id",
        date_key(F.col("order_date")).alias("order_date_key"),
        "order_date", "order_status", "quantity", "unit_price_inr", "discount_inr",
        "freight_inr", "line_total_inr",
        (F.col("unit_price_inr") * F.col("quantity")).cast("decimal(28,2)")
        .alias("gross_line_value_inr"),
        *attributes,
    )


def with_attributes(lines: DataFrame, products: DataFrame) -> DataFrame:
    """Lines that came without their product's attributes, with them: those of kept orders only meet products."""
    attributes = products.select("product_id", "category", "brand")
    return lines.join(attributes, "product_id", "left").select(*lines.columns, "category", "brand")


def fact_payments(payments: DataFrame, orders: DataFrame) -> DataFrame:
    return _with_order(payments, orders).select(
        "order_id", "payment_sequential", "customer_id",
        date_key(F.col("order_date")).alias("order_date_key"),
        "payment_type", "payment_status", "payment_installments", "payment_value_inr",
        "payment_value_missing",
    )


def fact_shipments(shipments: DataFrame, orders: DataFrame) -> DataFrame:
    return _with_order(shipments, orders).select(
        "order_id", "customer_id", date_key(F.col("order_date")).alias("order_date_key"),
        "carrier", "ship_ts", "estimated_delivery_date", "delivered_ts", "delivery_status",
        "delivery_days", "is_late",
    )


def fact_returns(returns: DataFrame, orders: DataFrame) -> DataFrame:
    """Dated by the return request."""
    return _with_order(returns, orders).select(
        "return_id", "order_id", "order_item_id", "product_id", "customer_id",
        date_key(F.col("return_requested_ts")).alias("return_date_key"),
        "return_reason", "return_status", "return_qty", "refund_amount_inr",
        "days_to_return_complete",
    )
