"""Window functions, sorts and top-k."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemart.catalog.registry import query
from tidemart.functions.ratio import percent
from tidemart.operators.dedup import dedup_latest, top_per_group
from tidemart.operators.range_windows import over_order
from tidemart.operators.ranking import moving_average, rank_in_group, top_k, top_k_ranked
from tidemart.plans.marts import with_calendar
from tidemart.plans.silver import with_repeat_flag

query("w01_dedup_latest")(
    lambda w: dedup_latest(
        w.raw("order_items"), ["order_id", "order_item_id"], ["updated_ts"],
        ["product_id", "seller_id"],
    ).select("order_id", "order_item_id", "product_id", "seller_id", "updated_ts")
)
query("w02_customer_order_sequence")(
    lambda w: w.orders("full").select(
        "order_id", "customer_id", "customer_order_seq", "is_repeat_order"
    )
)
query("w02_repeat_flag")(
    lambda w: with_repeat_flag(w.orders()).select("order_id", "is_repeat_order")
)


def monthly_orders(w):
    return (
        with_calendar(w.fact_orders(items=False), w.dim_date, "year", "month")
        .groupBy("year", "month")
        .agg(F.count("*").alias("orders_n"))
    )


@query("w03_lag_over_months")
def _(w):
    order = Window.orderBy("year", "month")
    return monthly_orders(w).withColumn("previous", F.lag("orders_n").over(order))


@query("w04_moving_sum")
def _(w):
    daily = w.daily_sales.select("order_date", "units")
    total, days = moving_average(daily, "order_date", "units", 6)
    return daily.withColumns({"units_7d": total, "days": days})


@query("w04_moving_over_rows")
def _(w):
    """Over all events in order of time, however many: the value before, seven-row sums, running total."""
    events = w.table("events").select("ts", "event_id", F.col("value").cast("decimal(18,2)").alias("value"))
    return over_order(
        events, ["ts", "event_id"],
        {"previous": lambda o: F.lag("value").over(o), "moving_sum": lambda o: F.sum("value").over(o.rowsBetween(-6, 0))},
        back=6, totals={"running_total": "value"}, rows_per_part=1000,  # so that small tables are cut as well
    )


query("w05_rank_top")(
    lambda w: top_k_ranked(
        w.product_performance.select("product_id", "units_sold"), "units_sold", ["product_id"],
        50, "unit_rank",
    )
)
query("w06_dense_rank_top")(
    lambda w: top_k_ranked(
        w.product_performance.select("product_id", "units_returned"), "units_returned",
        ["product_id"], 50, "return_rank", "dense_rank",
    )
)


@query("w07_dense_rank_in_group")
def _(w):
    """Customers of a state by number of orders; equal counts share a rank."""
    summary = w.customer_summary.select("state", "customer_id", "orders")
    return rank_in_group(summary, "state", "orders", "rank_in_state")


query("w08_top_row_per_group")(
    lambda w: top_per_group(
        w.fact_order_items().groupBy("category", "brand").agg(F.sum("quantity").alias("units")),
        ["category"], [F.col("units").desc(), F.col("brand").asc()],
    )
)


@query("w09_share_of_total")
def _(w):
    by_category = w.fact_order_items().groupBy("category").agg(
        F.sum("line_total_inr").alias("gmv_inr")
    )
    # over the handful of groups, so the lines are read once
    total = F.sum("gmv_inr").over(Window.partitionBy())
    return by_category.withColumn("_t", total).select(
        "category", "gmv_inr", percent(F.col("gmv_inr"), F.col("_t"), 2, 2, 2).alias("share_pct")
    )


query("ag18_rank_of_aggregate")(
    lambda w: top_k_ranked(
        w.fact_orders(items=False).groupBy("customer_id").agg(F.count("*").alias("orders_n")),
        "orders_n", ["customer_id"], 25, "customer_rank", "dense_rank",
    )
)
query("sl01_order_by_keys")(lambda w: monthly_orders(w).orderBy("year", "month"))


@query("sl02_nulls_last")
def _(w):
    totals = w.fact_orders(items=False).groupBy("payment_type").agg(F.count("*").alias("orders_n"))
    return totals.orderBy(F.col("payment_type").asc_nulls_last())


query("sl03_top_k")(
    lambda w: top_k(
        w.product_performance.select("product_id", "gmv_inr"), "gmv_inr", ["product_id"], 25
    )
)


@query("sl04_derived_metric_nulls_first")
def _(w):
    """The largest rates, products never sold (null) before all others."""
    rate = percent(F.col("units_returned"), F.col("units_sold")).alias("return_rate_pct")
    rated = w.product_performance.select("product_id", rate)
    return rated.orderBy(F.col("return_rate_pct").desc_nulls_first(), "product_id").limit(40)
