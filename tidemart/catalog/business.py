"""Business questions and dashboard figures."""

from tidemart.catalog.registry import query
from tidemart.plans import analytics as a
from tidemart.plans import dashboard as k

RETURN_CUT = "1998-01-01"

query("q01_monthly_gmv_growth")(lambda w: a.q01(w.fact_orders(), w.dim_date))
query("q02_daily_orders_moving_average")(lambda w: a.q02(w.daily_sales))
query("q03_aov_rollup")(lambda w: a.q03(w.fact_orders(), w.dim_date))
query("q04_top_products")(lambda w: a.q04(w.product_performance))
query("q05_top_sellers_share")(lambda w: a.q05(w.seller_performance))
query("q06_repeat_customers")(lambda w: a.q06(w.customer_summary))
query("q07_cohort_retention")(
    lambda w: a.q07(w.dim_customer, w.fact_orders(items=False), w.dim_date)
)
query("q08_cancellation_rate")(lambda w: a.q08(w.fact_orders(items=False), w.dim_date))
query("q09_return_rate_by_category")(lambda w: a.q09(w.fact_order_items(), w.fact_returns))
query("q10_cod_vs_prepaid")(lambda w: a.q10(w.fact_orders()))
query("q11_state_sales")(lambda w: a.q11(w.fact_orders(), w.dim_customer))
query("q12_carrier_sla")(lambda w: a.q12(w.delivery_performance))
query("q13_rising_return_rate")(
    lambda w: a.q13(
        w.fact_order_items(enriched=False), w.dim_date, w.fact_returns, w.dim_product, RETURN_CUT
    )
)


@query("q14_seller_rank_in_state")
def _(w):
    return a.q14(w.seller_performance)


query("q15_new_vs_repeat_revenue")(lambda w: a.q15(w.fact_orders(repeat=True), w.dim_date))
query("q16_top_category_per_month")(lambda w: a.q16(w.fact_order_items(), w.dim_date))
query("q17_metro_delivery_days")(
    lambda w: a.q17(w.fact_shipments, w.dim_customer, w.dim_location)
)

query("k01_headline")(lambda w: k.k01(w.fact_orders()))
query("k02_monthly_trend")(lambda w: k.k02(w.daily_sales))
query("k03_top_categories")(lambda w: k.k03(w.fact_order_items()))
query("k04_top_sellers")(lambda w: k.k04(w.seller_performance))
query("k05_top_states")(lambda w: k.k05(w.fact_orders(), w.dim_customer))
query("k06_delivery_by_carrier")(lambda w: k.k06(w.delivery_performance))


def _raw(w):
    return w.raw("orders"), w.raw("order_items"), w.raw("products")


query("k07_raw_headline")(lambda w: k.k07_head(*_raw(w)))
query("k07_raw_monthly_trend")(lambda w: k.k07_trend(*_raw(w)))
query("k07_raw_top_categories")(lambda w: k.k07_categories(*_raw(w)[1:]))
