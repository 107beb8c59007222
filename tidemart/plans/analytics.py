"""The seventeen business questions, each over facts, dimensions and marts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemart.functions.dates import month_gap, month_start
from tidemart.functions.ratio import exact_ratio, percent
from tidemart.functions.text import blank_to_unknown
from tidemart.operators.dedup import top_per_group
from tidemart.operators.ranking import (
    moving_average,
    rank_in_group,
    top_k,
    top_k_ranked,
)
from tidemart.operators.summaries import sum_if, weighted_mean_parts
from tidemart.plans.marts import LINE, with_calendar, with_returns

LIVE = "is_cancelled = 0"


def nulls_last(*cols: str):
    return [F.col(c).asc_nulls_last() for c in cols]


def whole(c):
    """Money rounded to the unit."""
    return F.round(c, 0).cast("decimal(38,0)")


def q01(fact_orders: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Monthly GMV and its growth over the previous month with orders."""
    monthly = (
        with_calendar(fact_orders.filter(LIVE), dim_date, "year", "month")
        .groupBy("year", "month")
        .agg(F.sum("gmv_inr").alias("gmv_inr"), F.count("*").alias("orders"))
    )
    # one row per month: the single-partition window is bounded by the calendar
    previous = F.lag("gmv_inr").over(Window.orderBy("year", "month"))
    growth = percent(
        F.col("gmv_inr") - F.col("prev_month_gmv"), F.col("prev_month_gmv"), 2, 2, 2
    )
    return (
        monthly.withColumn("prev_month_gmv", previous)
        .withColumn("mom_growth_pct", growth)
        .orderBy("year", "month")
    )


def q02(daily_sales: DataFrame) -> DataFrame:
    """Orders per day and their mean over seven rows."""
    total, days = moving_average(daily_sales, "order_date", "orders", 6)
    return (
        daily_sales.select("order_date", "orders")
        .withColumns({"_t": total, "_d": days})
        .select("order_date", "orders", exact_ratio(F.col("_t"), F.col("_d"), 1)
                .alias("orders_7d_avg"))
        .orderBy("order_date")
    )


def q03(fact_orders: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Average order value by month, with subtotals per year and overall (nulls)."""
    return (
        with_calendar(fact_orders.filter(LIVE), dim_date, "year", "month")
        .rollup("year", "month")
        .agg(F.count("*").alias("orders"), F.sum("order_value_inr").alias("_value"))
        .select(
            "year", "month", "orders",
            exact_ratio(F.col("_value"), F.col("orders"), 2, num_scale=2).alias("aov_inr"),
        )
        .orderBy(*nulls_last("year", "month"))
    )


def q04(product_performance: DataFrame, k: int = 20) -> DataFrame:
    """Best-selling products."""
    best = top_k_ranked(product_performance, "gmv_inr", ["product_id"], k, "gmv_rank")
    return best.select(
        "product_id", "product_name", "category", "brand", "units_sold", "gmv_inr", "gmv_rank"
    ).orderBy("gmv_rank", "product_id")


def q05(seller_performance: DataFrame, k: int = 10) -> DataFrame:
    """Best sellers and their share of all sales."""
    sellers = seller_performance.select("seller_id", "seller_name", "seller_state", "gmv_inr")
    total = sellers.agg(F.sum("gmv_inr")).scalar()
    best = top_k_ranked(sellers, "gmv_inr", ["seller_id"], k, "seller_rank", "dense_rank")
    return best.withColumn("_total", total).select(
        "seller_id", "seller_name", "seller_state", "gmv_inr",
        percent(F.col("gmv_inr"), F.col("_total"), 2, 2, 2).alias("pct_of_total_gmv"),
        "seller_rank",
    ).orderBy("seller_rank", "seller_id")


def q06(customer_summary: DataFrame) -> DataFrame:
    """Repeat customers and what they bring."""
    repeat = F.col("is_repeat_customer")
    totals = customer_summary.agg(
        F.count("*").alias("customers"),
        F.count_if(repeat).alias("repeat_customers"),
        F.sum("total_spend_inr").alias("total_revenue"),
        sum_if(repeat, F.col("total_spend_inr")).alias("_repeat_revenue"),
    )
    return totals.select(
        "customers", "repeat_customers",
        percent(F.col("repeat_customers"), F.col("customers")).alias("repeat_customer_pct"),
        "total_revenue",
        percent(F.col("_repeat_revenue"), F.col("total_revenue"), 2, 2, 2)
        .alias("pct_revenue_from_repeat"),
    )


def q07(dim_customer: DataFrame, fact_orders: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Customers of each signup month who ordered in each later month."""
    cohorts = dim_customer.select("customer_id", month_start(F.col("signup_date")).alias("cohort_month"))
    active = (
        with_calendar(fact_orders.filter(LIVE), dim_date, "full_date")
        .select("customer_id", month_start(F.col("full_date")).alias("order_month"))
        .distinct()  # a customer's orders of a month collapse before the join
    )
    return (
        cohorts.join(active, "customer_id")
        .filter("order_month >= cohort_month")
        .groupBy("cohort_month", "order_month")
        .agg(F.count("*").alias("active_customers"))
        .select(
            "cohort_month", "order_month",
            month_gap(F.col("cohort_month"), F.col("order_month")).alias("month_number"),
            "active_customers",
        )
        .orderBy("cohort_month", "order_month")
    )


def q08(fact_orders: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Cancellation rate by month and overall (nulls)."""
    dated = with_calendar(fact_orders, dim_date, "year", "month")
    return (
        dated.groupingSets([["year", "month"], []], "year", "month")
        .agg(F.count("*").alias("orders"), F.sum("is_cancelled").alias("cancelled"))
        .withColumn("cancellation_rate_pct", percent(F.col("cancelled"), F.col("orders")))
        .orderBy(*nulls_last("year", "month"))
    )


def q09(fact_order_items: DataFrame, fact_returns: DataFrame) -> DataFrame:
    """Units returned per units sold, by category."""
    lines = fact_order_items.select(*LINE, "category", "quantity")
    sold = with_returns(lines, fact_returns, F.sum("return_qty"), "_back").groupBy("category").agg(
        F.sum("quantity").alias("units_sold"), F.sum("_back").alias("_back")
    )
    units_returned = F.coalesce("_back", F.lit(0))
    return (
        sold.select(
            "category", "units_sold", units_returned.alias("units_returned"),
            percent(units_returned, F.col("units_sold")).alias("return_rate_pct"),
        )
        .orderBy(F.col("return_rate_pct").desc_nulls_first(), "category")
    )


def q10(fact_orders: DataFrame) -> DataFrame:
    """Cash on delivery against prepaid; orders of unknown payment form their own prepaid row."""
    cod = (F.col("is_cod") == 1).alias("_cod")
    return (
        fact_orders.groupBy(cod)
        .agg(
            F.count("*").alias("orders"),
            F.sum("gmv_inr").alias("_gmv"),
            F.sum("order_value_inr").alias("_value"),
            F.sum("is_cancelled").alias("_cancelled"),
            F.sum("is_returned").alias("_returned"),
        )
        .select(
            F.when(F.col("_cod"), "COD").otherwise("Prepaid").alias("payment_mode"),
            "orders",
            whole(F.col("_gmv")).alias("gmv_inr"),
            exact_ratio(F.col("_value"), F.col("orders"), 2, num_scale=2).alias("aov_inr"),
            percent(F.col("_cancelled"), F.col("orders")).alias("cancellation_rate_pct"),
            percent(F.col("_returned"), F.col("orders")).alias("return_rate_pct"),
        )
        .orderBy("payment_mode", "orders")
    )


def q11(fact_orders: DataFrame, dim_customer: DataFrame, k: int = 15) -> DataFrame:
    """Sales by customer state."""
    by_state = (
        fact_orders.filter(LIVE)
        .join(dim_customer.select("customer_id", "state"), "customer_id")
        .groupBy("state")
        .agg(
            F.count("*").alias("orders"),
            F.sum("gmv_inr").alias("_gmv"),
            F.sum("order_value_inr").alias("_value"),
        )
    )
    best = top_k_ranked(by_state, "_gmv", ["state"], k, "state_rank", "dense_rank")
    return best.select(
        "state", "orders", whole(F.col("_gmv")).alias("gmv_inr"),
        exact_ratio(F.col("_value"), F.col("orders"), 2, num_scale=2).alias("aov_inr"),
        "state_rank",
    ).orderBy("state_rank", "state")


def _carrier_totals(delivery_performance: DataFrame) -> DataFrame:
    days, shipments = weighted_mean_parts(F.col("avg_delivery_days"), F.col("shipments"))
    return delivery_performance.groupBy("carrier").agg(
        shipments.alias("shipments"), days.alias("_days"),
        F.sum("late_deliveries").alias("_late"),
    )


def q12(delivery_performance: DataFrame) -> DataFrame:
    """Delivery service level per carrier, from the state averages."""
    n, late = F.col("shipments"), F.col("_late")
    return (
        _carrier_totals(delivery_performance)
        .select(
            "carrier", "shipments",
            exact_ratio(F.col("_days"), n, 2, num_scale=2).alias("avg_delivery_days"),
            percent(late, n).alias("late_rate_pct"),
            percent(n - late, n).alias("on_time_rate_pct"),
        )
        .orderBy(F.col("on_time_rate_pct").desc_nulls_first(), "carrier")
    )


def q13(
    fact_order_items: DataFrame,
    dim_date: DataFrame,
    fact_returns: DataFrame,
    dim_product: DataFrame,
    cut: str = "2024-01-01",
    k: int = 25,
) -> DataFrame:
    """Products whose return rate rose after ``cut``: returned lines per unit sold.

    Returns are reduced to one row per line first, so several returns of a line count its
    quantity once. Rates are compared as fractions, without rounding.
    """
    sold = with_calendar(
        fact_order_items.select(*LINE, "product_id", "quantity", "order_date_key"),
        dim_date, "full_date",
    )
    returned = fact_returns.select(*LINE).distinct().withColumn("_hit", F.lit(1))
    period = F.when(F.col("full_date") < F.lit(cut).cast("date"), "H1").otherwise("H2")
    halves = (
        sold.join(returned, LINE, "left")
        .withColumn("period", period)
        .groupBy("product_id")
        .pivot("period", ["H1", "H2"])
        .agg(F.count("_hit").alias("back"), F.sum("quantity").alias("units"))
    )
    a, b = F.col("H1_back"), F.col("H1_units")
    c, d = F.col("H2_back"), F.col("H2_units")
    # products of counts as decimals: as whole numbers they could overflow
    wide = lambda x: x.cast("decimal(19,0)")
    rise = (wide(c) * wide(b) - wide(a) * wide(d)).cast("decimal(38,0)")
    rising = halves.filter((b > 0) & (d > 0) & (rise > 0)).select(
        "product_id",
        exact_ratio(a, b, 3).alias("h1_return_rate"),
        exact_ratio(c, d, 3).alias("h2_return_rate"),
        exact_ratio(rise, (wide(b) * wide(d)).cast("decimal(38,0)"), 3).alias("delta"),
    )
    named = rising.join(dim_product.select("product_id", "product_name", "category"), "product_id")
    return top_k(named, "delta", ["product_id"], k).select(
        "product_id", "product_name", "category", "h1_return_rate", "h2_return_rate", "delta"
    )


def q14(seller_performance: DataFrame) -> DataFrame:
    """Rank of each seller in its state."""
    selling = seller_performance.filter("gmv_inr > 0").select(
        "seller_state", "seller_id", "seller_name", "gmv_inr"
    )
    ranked = rank_in_group(selling, "seller_state", "gmv_inr", "rank_in_state")
    return ranked.orderBy("seller_state", "rank_in_state", "seller_id")


def q15(fact_orders: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Revenue of first and repeat orders by month."""
    again = F.col("is_repeat_order") == 1
    return (
        with_calendar(fact_orders.filter(LIVE), dim_date, "year", "month")
        .groupBy("year", "month")
        .agg(
            sum_if(F.col("is_repeat_order") == 0, F.col("gmv_inr")).alias("new_customer_gmv"),
            sum_if(again, F.col("gmv_inr")).alias("repeat_customer_gmv"),
            F.sum("gmv_inr").alias("_all"),
        )
        .select(
            "year", "month", "new_customer_gmv", "repeat_customer_gmv",
            percent(F.col("repeat_customer_gmv"), F.col("_all"), 2, 2, 2).alias("repeat_gmv_pct"),
        )
        .orderBy("year", "month")
    )


def q16(fact_order_items: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Best-selling category of each month."""
    monthly = (
        with_calendar(fact_order_items, dim_date, "year", "month")
        .groupBy("year", "month", "category")
        .agg(F.sum("line_total_inr").alias("_gmv"))
    )
    order = [F.col("_gmv").desc_nulls_first(), F.col("category").asc_nulls_last()]
    return (
        top_per_group(monthly, ["year", "month"], order)
        .select("year", "month", "category", whole(F.col("_gmv")).alias("gmv_inr"))
        .orderBy("year", "month")
    )


def q17(
    fact_shipments: DataFrame, dim_customer: DataFrame, dim_location: DataFrame
) -> DataFrame:
    """Delivery time in metro and other cities."""
    place = dim_customer.select(
        "customer_id",
        blank_to_unknown(F.col("city")).alias("city"),
        blank_to_unknown(F.col("state")).alias("state"),
    )
    return (
        fact_shipments.filter("delivery_days is not null")
        .join(place, "customer_id")
        .join(dim_location.select("city", "state", "is_metro"), ["city", "state"])
        .groupBy("is_metro")
        .agg(
            F.count("*").alias("shipments"),
            F.sum("delivery_days").alias("_days"),
            F.sum("is_late").alias("_late"),
            F.count("is_late").alias("_rated"),
        )
        .select(
            "is_metro", "shipments",
            exact_ratio(F.col("_days"), F.col("shipments"), 2).alias("avg_delivery_days"),
            percent(F.col("_late"), F.col("_rated")).alias("late_rate_pct"),
        )
    )
