"""Dimensions, rollups, facts and marts."""

from tidemart.catalog.registry import query
from tidemart.plans import flows, star
from tidemart.session import scratch_dir
from tidemart.sinks.tables import write_by_month, write_table

query("a01_dim_date")(lambda w: w.dim_date)
query("a05_dim_customer")(lambda w: w.dim_customer)
query("a06_dim_product")(lambda w: w.dim_product)
query("a07_dim_seller")(lambda w: w.dim_seller)
query("a08_dim_location")(lambda w: w.dim_location)
query("a09_order_item_metrics")(lambda w: star.order_item_metrics(w.stg_order_items(False)))
query("a09_order_payments")(lambda w: star.order_payments(w.stg_payments))
query("a10_fact_orders")(lambda w: w.fact_orders(True, True, True, True, True))


@query("a11_fact_order_items")
def _(w):
    return w.fact_order_items()


@query("a11_fact_order_items_incremental")
def _(w):
    """Load up to a day, then refresh with everything: the look-back picks up what is new."""
    base = scratch_dir(w.spark, "a11")
    before = w.stg_orders().filter("order_date < '2001-01-01'")
    first = w.fact_order_items(orders=before)
    path = write_by_month(flows.by_month(first), base, "fact_order_items")
    flows.refresh_order_items(w.spark, path, w.lines_of, w.orders(), products=w.stg_products)
    return w.spark.read.parquet(path)


query("a12_fact_payments")(lambda w: w.fact_payments)
query("a13_fact_shipments")(lambda w: w.fact_shipments)
query("a14_fact_returns")(lambda w: w.fact_returns)
query("a15_daily_sales")(lambda w: w.daily_sales)


@query("a15_daily_sales_incremental")
def _(w):
    """Load up to the start of a month, then refresh: the look-back crosses the month."""
    base = scratch_dir(w.spark, "a15")
    daily = w.daily_sales
    path = write_table(daily.filter("order_date <= '2001-03-01'"), base, "daily_sales")
    flows.refresh_daily_sales(w.spark, path, w.fact_orders(), w.dim_date)
    return w.spark.read.parquet(path)


query("a16_seller_performance")(lambda w: w.seller_performance)
query("a17_product_performance")(lambda w: w.product_performance)
query("a18_customer_summary")(lambda w: w.customer_summary)
query("a19_delivery_performance")(lambda w: w.delivery_performance)
