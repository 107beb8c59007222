"""Key figures for the dashboard."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.operators.dedup import dedup_latest
from tidemart.functions.dates import month_start, parse_ts
from tidemart.functions.ratio import nullif_divide
from tidemart.functions.text import normal_key, title
from tidemart.operators.ranking import top_k
from tidemart.operators.summaries import sum_if, weighted_mean_parts



def k01(fact_orders: DataFrame) -> DataFrame:
    """Headline figures. GMV counts every order; orders and AOV leave cancelled ones out."""
    live = F.col("is_cancelled") == 0
    totals = fact_orders.agg(
        F.sum("gmv_inr").alias("gmv"),
        F.count_if(live).alias("orders"),
        sum_if(live, F.col("order_value_inr")).alias("_value"),
        F.sum("is_cancelled").alias("_cancelled"),
        F.sum("is_returned").alias("_returned"),
        F.count("*").alias("_all"),
    )
    return totals.select(
        "gmv", "orders",
        nullif_divide(F.col("_value"), F.col("orders")).alias("aov"),
        nullif_divide(F.col("_cancelled"), F.col("_all")).alias("cancel_rate"),
        nullif_divide(F.col("_returned"), F.col("_all")).alias("return_rate"),
    )


def k02(daily_sales: DataFrame) -> DataFrame:
    """Monthly trend."""
    return (
        daily_sales.groupBy(month_start(F.col("order_date")).alias("month"))
        .agg(F.sum("gmv_inr").alias("gmv"), F.sum("orders").alias("orders"))
        .orderBy("month")
    )


def k03(fact_order_items: DataFrame, k: int = 10) -> DataFrame:
    """Largest categories."""
    by_category = fact_order_items.groupBy("category").agg(F.sum("line_total_inr").alias("gmv"))
    return top_k(by_category, "gmv", ["category"], k)


def k04(seller_performance: DataFrame, k: int = 10) -> DataFrame:
    """Largest sellers."""
    best = top_k(seller_performance, "gmv_inr", ["seller_id"], k)
    return best.select("seller_name", F.col("gmv_inr").alias("gmv"))


def k05(fact_orders: DataFrame, dim_customer: DataFrame, k: int = 15) -> DataFrame:
    """Largest states."""
    by_state = (
        fact_orders.filter("is_cancelled = 0")
        .join(dim_customer.select("customer_id", "state"), "customer_id")
        .groupBy("state")
        .agg(F.sum("gmv_inr").alias("gmv"))
    )
    return top_k(by_state, "gmv", ["state"], k)


def k06(delivery_performance: DataFrame) -> DataFrame:
    """Mean delivery days and late share per carrier."""
    days, shipments = weighted_mean_parts(F.col("avg_delivery_days"), F.col("shipments"))
    totals = delivery_performance.groupBy("carrier").agg(
        days.alias("_days"), shipments.alias("_n"), F.sum("late_deliveries").alias("_late")
    )
    return totals.select(
        "carrier",
        nullif_divide(F.col("_days"), F.col("_n")).alias("avg_days"),
        nullif_divide(F.col("_late") * 100, F.col("_n")).alias("late_pct"),
    ).orderBy("avg_days", "carrier")


# ------------------------------------------------- straight from the raw feeds


def raw_lines(items: DataFrame, products: DataFrame) -> DataFrame:
    """Usable raw lines with their total and a title-cased category."""
    freight = F.coalesce("freight_inr", F.lit(0))
    category = products.select("product_id", title(F.col("category")).alias("category"))
    return items.filter("quantity > 0").join(category, "product_id", "left").withColumn(
        "line_total_inr", F.col("unit_price_inr") * F.col("quantity") + freight
    )


def raw_order_totals(lines: DataFrame) -> DataFrame:
    return lines.groupBy("order_id").agg(F.sum("line_total_inr").alias("gmv"))


def k07_head(orders: DataFrame, items: DataFrame, products: DataFrame) -> DataFrame:
    """Headline figures; cancelled orders are left out of GMV and AOV."""
    status = normal_key(F.col("order_status"))
    # only what is used: ties are broken by a hash of all columns there are
    narrow = orders.select("order_id", "order_purchase_ts", "order_status")
    valued = dedup_latest(narrow, ["order_id"], ["order_purchase_ts"]).join(
        raw_order_totals(raw_lines(items, products)), "order_id", "left"
    )
    live = ~status.eqNullSafe("cancelled")  # an unknown status is not cancelled
    totals = valued.agg(
        F.coalesce(sum_if(live, F.col("gmv")), F.lit(0)).alias("gmv"),
        F.count_if(live).alias("orders"),
        F.count_if(status == "cancelled").alias("_cancelled"),
        F.count_if(status == "returned").alias("_returned"),
        F.count("*").alias("_all"),
    )
    return totals.select(
        "gmv", "orders",
        nullif_divide(F.col("gmv"), F.greatest("orders", F.lit(1))).alias("aov"),
        nullif_divide(F.col("_cancelled"), F.col("_all")).alias("cancel_rate"),
        nullif_divide(F.col("_returned"), F.col("_all")).alias("return_rate"),
    )


def k07_trend(orders: DataFrame, items: DataFrame, products: DataFrame) -> DataFrame:
    """Monthly trend; orders without a readable time belong to no month."""
    month = month_start(parse_ts(F.col("order_purchase_ts"))).alias("month")
    narrow = orders.select("order_id", "order_purchase_ts")
    dated = dedup_latest(narrow, ["order_id"], ["order_purchase_ts"]).select("order_id", month)
    return (
        dated.filter("month is not null")
        .join(raw_order_totals(raw_lines(items, products)), "order_id", "left")
        .groupBy("month")
        .agg(F.coalesce(F.sum("gmv"), F.lit(0)).alias("gmv"), F.count("*").alias("orders"))
        .orderBy("month")
    )


def k07_categories(items: DataFrame, products: DataFrame, k: int = 10) -> DataFrame:
    """Largest categories; lines of unknown products are in none."""
    by_category = (
        raw_lines(items, products)
        .filter("category is not null")
        .groupBy("category")
        .agg(F.sum("line_total_inr").alias("gmv"))
    )
    return top_k(by_category, "gmv", ["category"], k)
