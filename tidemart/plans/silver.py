"""Cleaning of the eight feeds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.functions import dates, text
from tidemart.functions.ratio import money
from tidemart.operators.dedup import dedup_latest
from tidemart.operators.ranking import bucketed_row_number
from tidemart.operators.split import split_quarantine, with_parent

DELIVERY_HORIZON = "2099-01-01"


def require(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows whose critical columns are all set."""
    return df.dropna(how="any", subset=list(cols))


def clean_customers(df: DataFrame, latest=("signup_date",), tiebreak=None) -> DataFrame:
    kept = dedup_latest(require(df, ["customer_id"]), ["customer_id"], latest, tiebreak)
    return kept.withColumns(
        {
            "city": text.or_unknown(text.standard_city(F.col("city"))),
            "state": text.or_unknown(text.title(F.col("state"))),
            "signup_date": dates.parse_date(F.col("signup_date")),
        }
    )


def clean_sellers(df: DataFrame, latest=("onboarded_date",), tiebreak=None) -> DataFrame:
    kept = dedup_latest(require(df, ["seller_id"]), ["seller_id"], latest, tiebreak)
    return kept.withColumns(
        {
            "seller_city": text.standard_city(F.col("seller_city")),
            "seller_state": text.title(F.col("seller_state")),
            "onboarded_date": dates.parse_date(F.col("onboarded_date")),
        }
    )


def clean_products(df: DataFrame, latest=(), tiebreak=None) -> DataFrame:
    kept = dedup_latest(require(df, ["product_id"]), ["product_id"], latest, tiebreak)
    mrp = money(F.col("mrp_inr"))
    return kept.withColumns(
        {
            "category": text.standard_category(F.col("category")),
            "mrp_inr": F.when(mrp >= 0, mrp),
        }
    )


def clean_orders(df: DataFrame, latest=("order_approved_ts",), tiebreak=None) -> DataFrame:
    """Orders with parsed times and date parts, without the per-customer sequence."""
    kept = dedup_latest(
        require(df, ["order_id", "customer_id"]), ["order_id"], latest, tiebreak
    )
    purchased = dates.parse_ts(F.col("order_purchase_ts"))
    return kept.withColumns(
        {
            "order_status": text.normal_key(F.col("order_status")),
            "order_purchase_ts": purchased,
            "order_approved_ts": dates.parse_ts(F.col("order_approved_ts")),
            "order_date": F.to_date(purchased),
            "order_year": F.year(purchased),
            "order_month": F.month(purchased),
            "is_cod": (F.col("payment_type") == "COD").cast("int"),
        }
    )


def with_order_sequence(orders: DataFrame) -> DataFrame:
    """Position of each order in its customer's history, and whether it is a repeat.

    Counted per customer and day first, so a customer with very many orders is spread
    over the days they ordered on.
    """
    ranked = bucketed_row_number(
        orders, "customer_id", "order_date", ["order_purchase_ts", "order_id"],
        "customer_order_seq",
    )
    return ranked.withColumn(
        "is_repeat_order", (F.col("customer_order_seq") > 1).cast("int")
    )


def with_repeat_flag(orders: DataFrame) -> DataFrame:
    """Repeat flag alone: one aggregate per customer that combines before the shuffle."""
    first = orders.groupBy(F.col("customer_id").alias("_c")).agg(
        F.min(F.struct("order_purchase_ts", "order_id")).alias("_first")
    )
    return (
        orders.join(first, F.col("customer_id") == F.col("_c"))
        .withColumn("is_repeat_order", (F.col("order_id") != F.col("_first.order_id")).cast("int"))
        .drop("_c", "_first")
    )


def line_total(price: Column, quantity: Column, freight: Column) -> Column:
    """price*quantity + freight, to the cent."""
    return F.round(price * quantity + F.coalesce(freight, F.lit(0)), 2).cast("decimal(18,2)")


def usable_items(df: DataFrame, latest=(), tiebreak=None) -> DataFrame:
    """Lines with keys, one per (order, line), of positive quantity."""
    kept = dedup_latest(
        require(df, ["order_id", "order_item_id", "product_id"]),
        ["order_id", "order_item_id"], latest, tiebreak,
    )
    kept = kept.filter(F.col("quantity") > 0)
    price, freight = money(F.col("unit_price_inr")), money(F.col("freight_inr"), 4)
    return kept.withColumns(
        {
            "unit_price_inr": price,
            "discount_inr": money(F.col("discount_inr"), 4),
            "freight_inr": freight,
            "line_total_inr": line_total(price, F.col("quantity"), freight),
        }
    )


def unusable_item() -> Column:
    """Rows of the line feed that ``usable_items`` drops, alone or as the latest of their key. Every key of the
    feed has a usable line or such a row."""
    return F.col("product_id").isNull() | ~F.coalesce(F.col("quantity") > 0, F.lit(False))


def enrich_items(items: DataFrame, products: DataFrame) -> DataFrame:
    """Product attributes on each line; Spark broadcasts the four columns while they are small."""
    attributes = products.select("product_id", "category", "subcategory", "brand")
    return items.join(attributes, "product_id", "left")


def clean_payments(df: DataFrame, latest=(), tiebreak=None) -> DataFrame:
    kept = dedup_latest(df, ["order_id", "payment_sequential"], latest, tiebreak)
    value = money(F.col("payment_value_inr"))
    return kept.withColumns(
        {
            "payment_status": text.standard_payment_status(F.col("payment_status")),
            "payment_value_missing": value.isNull().cast("int"),
            "payment_value_inr": F.coalesce(value, F.lit(0)).cast("decimal(18,2)"),
        }
    )


def timeline_faults(horizon: str = DELIVERY_HORIZON) -> dict[str, Column]:
    return {
        "delivered_before_shipped": F.col("delivered_ts") < F.col("ship_ts"),
        "delivered_in_far_future": F.col("delivered_ts")
        >= F.lit(horizon).cast("timestamp_ntz"),
    }


def parse_shipments(df: DataFrame, latest=("delivered_ts",), tiebreak=None) -> DataFrame:
    """One shipment per order with parsed times."""
    typed = df.withColumns(
        {
            "ship_ts": dates.parse_ts(F.col("ship_ts")),
            "delivered_ts": dates.parse_ts(F.col("delivered_ts")),
            "estimated_delivery_date": dates.parse_date(F.col("estimated_delivery_date")),
        }
    )
    return dedup_latest(typed, ["order_id"], latest, tiebreak)


def split_shipments(
    parsed: DataFrame, horizon: str = DELIVERY_HORIZON
) -> tuple[DataFrame, DataFrame]:
    """(clean with delivery measures, impossible timelines)."""
    clean, quarantined = split_quarantine(parsed, timeline_faults(horizon))
    delivered = F.to_date("delivered_ts")
    clean = clean.withColumns(
        {
            "delivery_days": dates.days_between(F.col("ship_ts"), F.col("delivered_ts")),
            "is_late": (delivered > F.col("estimated_delivery_date")).cast("int"),
        }
    )
    return clean, quarantined


def clean_returns(df: DataFrame, latest=("return_requested_ts",), tiebreak=None) -> DataFrame:
    kept = dedup_latest(df, ["return_id"], latest, tiebreak)
    requested = dates.parse_ts(F.col("return_requested_ts"))
    completed = dates.parse_ts(F.col("return_completed_ts"))
    return kept.withColumns(
        {
            "refund_amount_inr": money(F.col("refund_amount_inr")),
            "return_requested_ts": requested,
            "return_completed_ts": completed,
            "days_to_return_complete": dates.days_between(requested, completed),
        }
    )


def of_known_orders(child: DataFrame, orders: DataFrame) -> DataFrame:
    return with_parent(child, orders, "order_id")
