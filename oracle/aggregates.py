"""Aggregations, set operations, windows, sorts and top-k."""

from oracle.base import check, pct, quotient, safe, title
from oracle.business import RAW_LINES

check(
    "ag01_order_item_metrics",
    "order_id:i n_items:i total_units:i n_distinct_products:i n_distinct_sellers:i",
    "SELECT * FROM item_metrics",
)
check(
    "ag02_payment_rollup", "order_id:i paid:f max_installments:i records:i",
    "SELECT order_id, order_paid_inr AS paid, max_installments, n_payment_records AS records FROM pay_metrics",
)
check(
    "ag03_status_precedence", "order_id:i status:s",
    """SELECT order_id, CASE min(CASE payment_status WHEN 'refunded' THEN 1 WHEN 'paid' THEN 2
              WHEN 'pending' THEN 3 WHEN 'failed' THEN 4 ELSE 5 END) WHEN 1 THEN 'refunded'
              WHEN 2 THEN 'paid' WHEN 3 THEN 'pending' WHEN 4 THEN 'failed' ELSE 'unknown' END
              AS status
       FROM payments GROUP BY order_id""",
)
check(
    "ag04_filtered_aggregates", "payment_type:s live_orders:i live_gmv:f returned_units:i",
    """SELECT payment_type, count(*) FILTER (is_cancelled = 0) AS live_orders,
              sum(gmv_inr) FILTER (is_cancelled = 0) AS live_gmv,
              sum(total_units) FILTER (is_returned = 1) AS returned_units
       FROM fact_orders GROUP BY payment_type""",
)
check(
    "ag05_count_distinct", "product_id:i orders_n:i",
    "SELECT product_id, count(DISTINCT order_id) AS orders_n FROM fact_order_items GROUP BY 1",
)
check(
    "ag06_rollup", "year:i month:i orders_n:i level:i",
    """SELECT d.year, d.month, count(*) AS orders_n, grouping(d.year, d.month) AS level
       FROM fact_orders f JOIN dim_date d ON f.order_date_key = d.date_key
       GROUP BY ROLLUP (d.year, d.month)""",
)
check(
    "ag07_grouping_sets", "order_status:s payment_type:s orders_n:i gmv_inr:f level:i",
    """SELECT order_status, payment_type, count(*) AS orders_n, sum(gmv_inr) AS gmv_inr,
              grouping(order_status, payment_type) AS level
       FROM fact_orders GROUP BY GROUPING SETS ((order_status, payment_type), ())""",
)
check(
    "ag08_group_by_expression", "cod:b orders_n:i",
    "SELECT is_cod = 1 AS cod, count(*) AS orders_n FROM fact_orders GROUP BY is_cod = 1",
)
check(
    "ag09_conditional_pivot", "category:s h1_units:i h2_units:i",
    """SELECT category, sum(quantity) FILTER (order_date < DATE '1998-01-01') AS h1_units,
              sum(quantity) FILTER (order_date >= DATE '1998-01-01') AS h2_units
       FROM fact_order_items GROUP BY category""",
)
check(
    "ag10_global_aggregate", "orders_n:i gmv_inr:f max_units:i",
    "SELECT count(*) AS orders_n, sum(gmv_inr) AS gmv_inr, max(total_units) AS max_units FROM fact_orders",
)
check(
    "ag11_weighted_average", "state:s avg_days:f",
    f"""SELECT state, {quotient('sum(avg_delivery_days * shipments)', 'sum(shipments)')} AS avg_days
        FROM delivery_performance GROUP BY state""",
)
check(
    "ag12_average_of_nullable_flag", "order_status:s cod_share:f",
    "SELECT order_status, avg(is_cod) AS cod_share FROM clean_orders GROUP BY order_status",
)
check("ag13_distinct_keys", "order_id:i", "SELECT DISTINCT l_orderkey AS order_id FROM lineitem")
check("ag14_newest_timestamp", "newest:t", "SELECT max(o_orderdate) AS newest FROM orders")
check(
    "ag15_safe_divide", "order_date:d gmv_per_cod_order:f",
    f"SELECT order_date, {safe('gmv_inr', 'cod_orders')} AS gmv_per_cod_order FROM daily_sales",
)
check(
    "ag16_nullif_divide", "order_date:d units_per_return:f cod_pct:f",
    f"""SELECT order_date, {quotient('units', 'nullif(returned_orders, 0)')} AS units_per_return,
               {pct('cod_orders', 'valid_orders')} AS cod_pct FROM daily_sales""",
)
check(
    "ag17_sample_group_aggregates", "category:s orders_n:i total:f mean_quantity:f",
    f"""SELECT category, count(DISTINCT order_id) AS orders_n, sum(total) AS total,
               {quotient('sum(quantity)', 'count(quantity)')} AS mean_quantity
        FROM {RAW_LINES} AS l GROUP BY category""",
)
check(
    "ag18_rank_of_aggregate", "customer_id:i orders_n:i customer_rank:i",
    """SELECT customer_id, count(*) AS orders_n,
              dense_rank() OVER (ORDER BY count(*) DESC) AS customer_rank
       FROM clean_orders GROUP BY customer_id ORDER BY orders_n DESC, customer_id LIMIT 25""",
)
check(
    "so01_union_distinct", "city:s state:s",
    """SELECT city, state FROM customers UNION
       SELECT seller_city, seller_state FROM sellers""",
)
check(
    "so02_drop_duplicates", "order_id:i order_item_id:i",
    "SELECT DISTINCT order_id, order_item_id FROM raw_items",
)
check(
    "so03_concatenate_with_new_column", "order_id:i order_date:d channel:s",
    """SELECT order_id, order_date, CASE WHEN order_date >= DATE '1998-01-01' THEN 'app' END
              AS channel FROM clean_orders""",
)
check(
    "sl05_head_of_sorted", "category:s products_n:i",
    f"""SELECT {title('category')} AS category, count(*) AS products_n FROM raw_products
        GROUP BY 1 ORDER BY products_n DESC, category LIMIT 10""",
)

# -------------------------------------------------------------------- windows
check(
    "w01_dedup_latest", "order_id:i order_item_id:i product_id:i seller_id:i updated_ts:t",
    """SELECT * FROM raw_items QUALIFY row_number() OVER (PARTITION BY order_id, order_item_id
           ORDER BY updated_ts DESC, product_id DESC NULLS LAST, seller_id DESC) = 1""",
)
check(
    "w02_customer_order_sequence",
    "order_id:i customer_id:i customer_order_seq:i is_repeat_order:i",
    "SELECT *, CAST(customer_order_seq > 1 AS INTEGER) AS is_repeat_order FROM clean_orders",
)
check(
    "w02_repeat_flag", "order_id:i is_repeat_order:i",
    "SELECT order_id, CAST(customer_order_seq > 1 AS INTEGER) AS is_repeat_order FROM clean_orders",
)
MONTHS = """SELECT year(order_date) AS year, month(order_date) AS month, count(*) AS orders_n
            FROM clean_orders GROUP BY 1, 2"""
check(
    "w03_lag_over_months", "year:i month:i orders_n:i previous:i",
    f"SELECT *, lag(orders_n) OVER (ORDER BY year, month) AS previous FROM ({MONTHS})",
)
check(
    "w04_moving_sum", "order_date:d units:i units_7d:i days:i",
    """SELECT order_date, units, sum(units) OVER w AS units_7d, count(*) OVER w AS days
       FROM daily_sales WINDOW w AS (ORDER BY order_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""",
)
check(
    "w04_moving_over_rows", "ts:t event_id:i value:f previous:f moving_sum:f running_total:f",
    """SELECT ts, event_id, value, lag(value) OVER w AS previous,
              sum(value) OVER (w ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS moving_sum,
              sum(value) OVER (w ROWS UNBOUNDED PRECEDING) AS running_total
       FROM (SELECT ts, event_id, CAST(value AS DECIMAL(18, 2)) AS value FROM events)
       WINDOW w AS (ORDER BY ts, event_id)""",
)
check(
    "w05_rank_top", "product_id:i units_sold:i unit_rank:i",
    """SELECT product_id, units_sold, rank() OVER (ORDER BY units_sold DESC) AS unit_rank
       FROM product_performance ORDER BY units_sold DESC, product_id LIMIT 50""",
)
check(
    "w06_dense_rank_top", "product_id:i units_returned:i return_rank:i",
    """SELECT product_id, units_returned,
              dense_rank() OVER (ORDER BY units_returned DESC) AS return_rank
       FROM product_performance ORDER BY units_returned DESC, product_id LIMIT 50""",
)
check(
    "w07_dense_rank_in_group", "state:s customer_id:i orders:i rank_in_state:i",
    """SELECT state, customer_id, orders,
              dense_rank() OVER (PARTITION BY state ORDER BY orders DESC) AS rank_in_state
       FROM customer_summary""",
)
check(
    "w08_top_row_per_group", "category:s brand:s units:i",
    """SELECT category, brand, sum(quantity) AS units FROM fact_order_items
       GROUP BY category, brand
       QUALIFY row_number() OVER (PARTITION BY category ORDER BY sum(quantity) DESC, brand) = 1""",
)
check(
    "w09_share_of_total", "category:s gmv_inr:f share_pct:f",
    f"""SELECT category, gmv AS gmv_inr, {pct('gmv', 'all_gmv', 2, 2, 2)} AS share_pct
        FROM (SELECT category, sum(line_total_inr) AS gmv,
                     sum(sum(line_total_inr)) OVER () AS all_gmv
              FROM fact_order_items GROUP BY category)""",
)
check("sl01_order_by_keys", "year:i month:i orders_n:i", MONTHS)
check(
    "sl02_nulls_last", "payment_type:s orders_n:i",
    "SELECT payment_type, count(*) AS orders_n FROM clean_orders GROUP BY payment_type",
)
check(
    "sl03_top_k", "product_id:i gmv_inr:f",
    "SELECT product_id, gmv_inr FROM product_performance ORDER BY gmv_inr DESC, product_id LIMIT 25",
)
check(
    "sl04_derived_metric_nulls_first", "product_id:i return_rate_pct:f",
    f"""SELECT product_id, {pct('units_returned', 'units_sold')} AS return_rate_pct
        FROM product_performance ORDER BY return_rate_pct DESC NULLS FIRST, product_id LIMIT 40""",
)
