"""Aggregations."""

from pyspark.sql import functions as F

from tidemart.catalog.registry import query
from tidemart.functions.ratio import nullif_divide, percent, safe_divide
from tidemart.functions.text import title
from tidemart.operators.summaries import distinct_union, strongest, sum_if, weighted_mean_parts
from tidemart.plans.analytics import nulls_last
from tidemart.plans.dashboard import raw_lines
from tidemart.plans.marts import with_calendar
from tidemart.plans.star import STATUS_PRECEDENCE, order_item_metrics

query("ag01_order_item_metrics")(
    lambda w: order_item_metrics(w.stg_order_items(False)).select(
        "order_id", "n_items", "total_units", "n_distinct_products", "n_distinct_sellers"
    )
)
query("ag02_payment_rollup")(
    lambda w: w.payments.groupBy("order_id").agg(
        F.sum("payment_value_inr").alias("paid"),
        F.max("payment_installments").alias("max_installments"),
        F.count("*").alias("records"),
    )
)
query("ag03_status_precedence")(
    lambda w: w.payments.groupBy("order_id").agg(
        strongest(F.col("payment_status"), STATUS_PRECEDENCE, "unknown").alias("status")
    )
)


@query("ag04_filtered_aggregates")
def _(w):
    live = F.col("is_cancelled") == 0
    return w.fact_orders().groupBy("payment_type").agg(
        F.count_if(live).alias("live_orders"),
        sum_if(live, F.col("gmv_inr")).alias("live_gmv"),
        sum_if(F.col("is_returned") == 1, F.col("total_units")).alias("returned_units"),
    )


query("ag05_count_distinct")(
    lambda w: w.fact_order_items(False).groupBy("product_id").agg(
        F.countDistinct("order_id").alias("orders_n")
    )
)
query("ag06_rollup")(
    lambda w: with_calendar(w.fact_orders(items=False), w.dim_date, "year", "month")
    .rollup("year", "month")
    .agg(F.count("*").alias("orders_n"), F.grouping_id().alias("level"))
    .orderBy(*nulls_last("year", "month"))
)
query("ag07_grouping_sets")(
    lambda w: w.fact_orders()
    .groupingSets([["order_status", "payment_type"], []], "order_status", "payment_type")
    .agg(
        F.count("*").alias("orders_n"),
        F.sum("gmv_inr").alias("gmv_inr"),
        F.grouping_id().alias("level"),
    )
)
query("ag08_group_by_expression")(
    lambda w: w.fact_orders(items=False)
    .groupBy((F.col("is_cod") == 1).alias("cod"))
    .agg(F.count("*").alias("orders_n"))
)


@query("ag09_conditional_pivot")
def _(w):
    """Units per category, before and after a day."""
    half = F.when(F.col("order_date") < F.lit("1998-01-01").cast("date"), "H1").otherwise("H2")
    return (
        w.fact_order_items()
        .withColumn("half", half)
        .groupBy("category")
        .pivot("half", ["H1", "H2"])
        .agg(F.sum("quantity"))
        .select("category", F.col("H1").alias("h1_units"), F.col("H2").alias("h2_units"))
    )


query("ag10_global_aggregate")(
    lambda w: w.fact_orders().agg(
        F.count("*").alias("orders_n"),
        F.sum("gmv_inr").alias("gmv_inr"),
        F.max("total_units").alias("max_units"),
    )
)


@query("ag11_weighted_average")
def _(w):
    days, n = weighted_mean_parts(F.col("avg_delivery_days"), F.col("shipments"))
    totals = w.delivery_performance.groupBy("state").agg(days.alias("d"), n.alias("n"))
    return totals.select("state", nullif_divide(F.col("d"), F.col("n")).alias("avg_days"))


@query("ag12_average_of_nullable_flag")
def _(w):
    """Orders without a known payment type do not count towards the mean."""
    by_status = w.orders().groupBy("order_status").agg(
        F.sum("is_cod").alias("s"), F.count("is_cod").alias("n")
    )
    return by_status.select("order_status", nullif_divide(F.col("s"), F.col("n")).alias("cod_share"))


query("ag13_distinct_keys")(lambda w: w.raw("order_items").select("order_id").distinct())
query("ag14_newest_timestamp")(
    lambda w: w.orders().agg(F.max("order_purchase_ts").alias("newest"))
)
query("ag15_safe_divide")(
    lambda w: w.daily_sales.select(
        "order_date", safe_divide(F.col("gmv_inr"), F.col("cod_orders")).alias("gmv_per_cod_order")
    )
)
query("ag16_nullif_divide")(
    lambda w: w.daily_sales.select(
        "order_date",
        nullif_divide(F.col("units"), F.col("returned_orders")).alias("units_per_return"),
        percent(F.col("cod_orders"), F.col("valid_orders")).alias("cod_pct"),
    )
)


@query("ag17_sample_group_aggregates")
def _(w):
    lines = raw_lines(w.raw("order_items"), w.raw("products"))
    return lines.groupBy("category").agg(
        F.countDistinct("order_id").alias("orders_n"),
        F.sum("line_total_inr").alias("total"),
        (F.sum("quantity").cast("double") / F.count("quantity")).alias("mean_quantity"),
    )


query("so01_union_distinct")(
    lambda w: distinct_union(
        w.customers.select("city", "state"),
        w.sellers.select(F.col("seller_city").alias("city"), F.col("seller_state").alias("state")),
    )
)
query("so02_drop_duplicates")(
    lambda w: w.raw("order_items").dropDuplicates(["order_id", "order_item_id"]).select(
        "order_id", "order_item_id"
    )
)


@query("so03_concatenate_with_new_column")
def _(w):
    """Older rows get null in a column only the newer ones have."""
    orders = w.orders().select("order_id", "order_date")
    cut = F.lit("1998-01-01").cast("date")
    newer = orders.filter(F.col("order_date") >= cut).withColumn("channel", F.lit("app"))
    return orders.filter(F.col("order_date") < cut).unionByName(newer, allowMissingColumns=True)


query("sl05_head_of_sorted")(
    lambda w: w.raw("products").groupBy(title(F.col("category")).alias("category"))
    .agg(F.count("*").alias("products_n"))
    .orderBy(F.col("products_n").desc(), "category")
    .limit(10)
)
