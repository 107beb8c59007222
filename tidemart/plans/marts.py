"""Business marts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.functions.ratio import exact_ratio, safe_divide, safe_ratio
from tidemart.operators.summaries import sum_if

LINE = ["order_id", "order_item_id"]


def with_calendar(fact: DataFrame, dim_date: DataFrame, *attributes: str) -> DataFrame:
    """Fact rows with attributes of their day.

    The calendar is the one side that is always broadcast: it has one row per day, so its
    size is bounded by the years covered and not by the facts.
    """
    days = F.broadcast(dim_date.select(F.col("date_key").alias("_day"), *attributes))
    return fact.join(days, F.col("order_date_key") == F.col("_day")).drop("_day")


def daily_sales(fact_orders: DataFrame, dim_date: DataFrame) -> DataFrame:
    live = F.col("is_cancelled") == 0
    by_day = (
        with_calendar(fact_orders, dim_date, "full_date")
        .groupBy(F.col("full_date").alias("order_date"), "order_date_key")
        .agg(
            F.count("*").alias("orders"),
            F.count_if(live).alias("valid_orders"),
            sum_if(live, F.col("gmv_inr")).alias("gmv_inr"),
            sum_if(live, F.col("total_units")).alias("units"),
            F.count_if(F.col("is_cancelled") == 1).alias("cancelled_orders"),
            F.count_if(F.col("is_returned") == 1).alias("returned_orders"),
            F.count_if(F.col("is_cod") == 1).alias("cod_orders"),
        )
    )
    return by_day.select(
        "order_date", "order_date_key", "orders", "valid_orders",
        F.coalesce("gmv_inr", F.lit(0)).alias("gmv_inr"),
        F.coalesce("units", F.lit(0)).alias("units"),
        safe_divide(F.col("gmv_inr"), F.col("valid_orders")).alias("aov_inr"),
        "cancelled_orders", "returned_orders", "cod_orders",
        safe_divide(F.col("cancelled_orders"), F.col("orders")).alias("cancellation_rate"),
        safe_divide(F.col("cod_orders"), F.col("orders")).alias("cod_share"),
    )


def _zero(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0)).alias(name)


def with_returns(items: DataFrame, returns: DataFrame, measure: Column, out: str) -> DataFrame:
    """Lines with a measure over their returns, null without one.

    Returns are summed up per line first, so lines are read and joined once and stay as many.
    """
    return items.join(returns.groupBy(*LINE).agg(measure.alias(out)), LINE, "left")


def seller_performance(
    dim_seller: DataFrame, fact_order_items: DataFrame, fact_returns: DataFrame
) -> DataFrame:
    """Return rate here is returned lines per unit sold."""
    lines = fact_order_items.select(*LINE, "seller_id", "quantity", "line_total_inr")
    sold = with_returns(lines, fact_returns, F.count("*"), "_back").groupBy("seller_id").agg(
        F.countDistinct("order_id").alias("orders"),
        F.sum("quantity").alias("units"),
        F.sum("line_total_inr").alias("gmv_inr"),
        F.sum("_back").alias("returned_lines"),
    )
    gmv, orders = F.coalesce("gmv_inr", F.lit(0)), F.col("orders")
    return (
        dim_seller.join(sold, "seller_id", "left")
        .select(
            "seller_id", "seller_name", "seller_state", "seller_tier", "seller_rating",
            "business_type", _zero("orders"), _zero("units"), _zero("gmv_inr"),
            _zero("returned_lines"),
            safe_divide(F.coalesce("returned_lines", F.lit(0)), F.col("units"))
            .alias("return_rate"),
            safe_ratio(gmv, orders, 2, num_scale=2).alias("avg_order_value_inr"),
        )
    )


def product_performance(
    dim_product: DataFrame, fact_order_items: DataFrame, fact_returns: DataFrame
) -> DataFrame:
    """Return rate here is units returned per unit sold."""
    sold = fact_order_items.groupBy("product_id").agg(
        F.sum("quantity").alias("units_sold"),
        F.sum("line_total_inr").alias("gmv_inr"),
        F.countDistinct("order_id").alias("orders"),
    )
    back = fact_returns.groupBy("product_id").agg(F.sum("return_qty").alias("units_returned"))
    return (
        dim_product.join(sold, "product_id", "left")
        .join(back, "product_id", "left")
        .select(
            "product_id", "product_name", "category", "subcategory", "brand", "mrp_inr",
            _zero("units_sold"), _zero("orders"), _zero("gmv_inr"), _zero("units_returned"),
            safe_divide(F.coalesce("units_returned", F.lit(0)), F.col("units_sold"))
            .alias("return_rate"),
        )
    )


def customer_summary(dim_customer: DataFrame, fact_orders: DataFrame) -> DataFrame:
    """First and last order count every order; orders and spend leave cancelled ones out."""
    live = F.col("is_cancelled") == 0
    history = fact_orders.groupBy("customer_id").agg(
        F.count_if(live).alias("orders"),
        sum_if(live, F.col("gmv_inr")).alias("total_spend_inr"),
        F.min("order_date_key").alias("first_order_date_key"),
        F.max("order_date_key").alias("last_order_date_key"),
    )
    spend = F.coalesce("total_spend_inr", F.lit(0))
    return dim_customer.join(history, "customer_id", "left").select(
        "customer_id", "customer_name", "city", "state", "customer_segment",
        _zero("orders"), _zero("total_spend_inr"),
        safe_ratio(spend, F.col("orders"), 2, num_scale=2).alias("aov_inr"),
        "first_order_date_key", "last_order_date_key",
        (F.coalesce("orders", F.lit(0)) > 1).alias("is_repeat_customer"),
    )


def delivery_performance(fact_shipments: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """By customer state and carrier. The shipment fact already carries its order's customer."""
    shipped = fact_shipments.filter("delivery_days is not null").join(
        dim_customer.select("customer_id", "state"), "customer_id"
    )
    totals = shipped.groupBy("state", "carrier").agg(
        F.count("*").alias("shipments"),
        F.sum("delivery_days").alias("_days"),
        F.sum("is_late").alias("late_deliveries"),
    )
    late = safe_divide(F.col("late_deliveries"), F.col("shipments"))
    return totals.select(
        "state", "carrier", "shipments",
        exact_ratio(F.col("_days"), F.col("shipments"), 2).alias("avg_delivery_days"),
        "late_deliveries",
        late.alias("late_rate"),
        (1 - late).alias("on_time_rate"),
    )
