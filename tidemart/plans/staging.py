"""Typed, defaulted views over the clean entities."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.functions.text import normal_key, or_unknown


def stg_customers(df: DataFrame) -> DataFrame:
    return df.select(
        "customer_id", "customer_name", "email", "phone",
        or_unknown(F.col("city")).alias("city"),
        or_unknown(F.col("state")).alias("state"),
        "pincode",
        F.col("signup_date").cast("date").alias("signup_date"),
        "customer_segment",
    )


def stg_sellers(df: DataFrame) -> DataFrame:
    return df.select(
        "seller_id", "seller_name", "seller_city", "seller_state", "seller_tier",
        "seller_pincode",
        F.col("onboarded_date").cast("date").alias("onboarded_date"),
        "seller_rating", "business_type",
    )


def stg_products(df: DataFrame) -> DataFrame:
    return df.select(
        "product_id", "product_name", "category", "subcategory", "brand", "mrp_inr",
        "weight_grams",
    )


def stg_orders(df: DataFrame) -> DataFrame:
    """Sequence columns are passed on where the input has them."""
    sequence = [c for c in ("customer_order_seq", "is_repeat_order") if c in df.columns]
    return df.select(
        "order_id", "customer_id",
        normal_key(F.col("order_status")).alias("order_status"),
        F.col("order_purchase_ts").cast("timestamp_ntz").alias("order_purchase_ts"),
        F.col("order_approved_ts").cast("timestamp_ntz").alias("order_approved_ts"),
        F.col("order_date").cast("date").alias("order_date"),
        "payment_type", "is_cod", *sequence,
    )


def stg_order_items(df: DataFrame) -> DataFrame:
    """Product attributes are passed on where the input has them."""
    attributes = [c for c in ("category", "subcategory", "brand") if c in df.columns]
    return df.select(
        "order_id", "order_item_id", "product_id", "seller_id", "quantity", "unit_price_inr",
        F.coalesce("discount_inr", F.lit(0)).cast("decimal(18,4)").alias("discount_inr"),
        F.coalesce("freight_inr", F.lit(0)).cast("decimal(18,4)").alias("freight_inr"),
        "line_total_inr", *attributes,
    )


def stg_payments(df: DataFrame) -> DataFrame:
    return df.select(
        "order_id", "payment_sequential", "payment_type", "payment_installments",
        F.coalesce("payment_value_inr", F.lit(0)).cast("decimal(18,2)")
        .alias("payment_value_inr"),
        "payment_status",
        F.coalesce("payment_value_missing", F.lit(0)).alias("payment_value_missing"),
    )


def stg_shipments(df: DataFrame) -> DataFrame:
    return df.select(
        "order_id", "carrier",
        F.col("ship_ts").cast("timestamp_ntz").alias("ship_ts"),
        F.col("estimated_delivery_date").cast("date").alias("estimated_delivery_date"),
        F.col("delivered_ts").cast("timestamp_ntz").alias("delivered_ts"),
        "delivery_status", "delivery_days", "is_late",
    )


def stg_returns(df: DataFrame) -> DataFrame:
    return df.select(
        "return_id", "order_id", "order_item_id", "product_id", "return_reason",
        "return_status", "return_qty", "refund_amount_inr",
        F.col("return_requested_ts").cast("timestamp_ntz").alias("return_requested_ts"),
        F.col("return_completed_ts").cast("timestamp_ntz").alias("return_completed_ts"),
        "days_to_return_complete",
    )
