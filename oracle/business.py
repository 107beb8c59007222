"""Business questions and dashboard figures."""

from oracle.base import check, pct, quotient, ratio, title

_Q01 = """SELECT d.year, d.month, sum(f.gmv_inr) AS gmv_inr, count(*) AS orders
          FROM fact_orders f JOIN dim_date d ON f.order_date_key = d.date_key
          WHERE f.is_cancelled = 0 GROUP BY d.year, d.month"""
_PREV = "lag(gmv_inr) OVER (ORDER BY year, month)"
check(
    "q01_monthly_gmv_growth",
    "year:i month:i gmv_inr:f orders:i prev_month_gmv:f mom_growth_pct:f",
    f"""SELECT year, month, gmv_inr, orders, prev_month_gmv,
               {pct('gmv_inr - prev_month_gmv', 'prev_month_gmv', 2, 2, 2)} AS mom_growth_pct
        FROM (SELECT *, {_PREV} AS prev_month_gmv FROM ({_Q01}))""",
)
check(
    "q02_daily_orders_moving_average",
    "order_date:d orders:i orders_7d_avg:f",
    f"""SELECT order_date, orders, {ratio('t', 'n', 1)} AS orders_7d_avg
        FROM (SELECT order_date, orders, sum(orders) OVER w AS t, count(*) OVER w AS n
              FROM daily_sales
              WINDOW w AS (ORDER BY order_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW))""",
)
check(
    "q03_aov_rollup",
    "year:i month:i orders:i aov_inr:f",
    f"""SELECT d.year, d.month, count(*) AS orders,
               {ratio('sum(f.order_value_inr)', 'count(*)', 2, 2)} AS aov_inr
        FROM fact_orders f JOIN dim_date d ON f.order_date_key = d.date_key
        WHERE f.is_cancelled = 0 GROUP BY ROLLUP (d.year, d.month)""",
)
check(
    "q04_top_products",
    "product_id:i product_name:s category:s brand:s units_sold:i gmv_inr:f gmv_rank:i",
    """SELECT product_id, product_name, category, brand, units_sold, gmv_inr,
              rank() OVER (ORDER BY gmv_inr DESC) AS gmv_rank
       FROM product_performance ORDER BY gmv_inr DESC, product_id LIMIT 20""",
)
check(
    "q05_top_sellers_share",
    "seller_id:i seller_name:s seller_state:s gmv_inr:f pct_of_total_gmv:f seller_rank:i",
    f"""SELECT seller_id, seller_name, seller_state, gmv_inr,
               {pct('gmv_inr', 'total', 2, 2, 2)} AS pct_of_total_gmv,
               dense_rank() OVER (ORDER BY gmv_inr DESC) AS seller_rank
        FROM (SELECT *, sum(gmv_inr) OVER () AS total FROM seller_performance)
        ORDER BY gmv_inr DESC, seller_id LIMIT 10""",
)
_REPEAT = "FILTER (is_repeat_customer)"
check(
    "q06_repeat_customers",
    "customers:i repeat_customers:i repeat_customer_pct:f total_revenue:f"
    " pct_revenue_from_repeat:f",
    f"""SELECT count(*) AS customers, count(*) {_REPEAT} AS repeat_customers,
               {pct(f'count(*) {_REPEAT}', 'count(*)')} AS repeat_customer_pct,
               sum(total_spend_inr) AS total_revenue,
               {pct(f'sum(total_spend_inr) {_REPEAT}', 'sum(total_spend_inr)', 2, 2, 2)}
                   AS pct_revenue_from_repeat
        FROM customer_summary""",
)
check(
    "q07_cohort_retention",
    "cohort_month:d order_month:d month_number:i active_customers:i",
    """SELECT cohort_month, order_month,
              datediff('month', cohort_month, order_month) AS month_number,
              count(DISTINCT customer_id) AS active_customers
       FROM (SELECT customer_id, CAST(date_trunc('month', signup_date) AS DATE) AS cohort_month
             FROM customers)
       JOIN (SELECT f.customer_id, CAST(date_trunc('month', d.full_date) AS DATE) AS order_month
             FROM fact_orders f JOIN dim_date d ON f.order_date_key = d.date_key
             WHERE f.is_cancelled = 0) USING (customer_id)
       WHERE order_month >= cohort_month GROUP BY cohort_month, order_month""",
)
check(
    "q08_cancellation_rate",
    "year:i month:i orders:i cancelled:i cancellation_rate_pct:f",
    f"""SELECT d.year, d.month, count(*) AS orders, sum(f.is_cancelled) AS cancelled,
               {pct('sum(f.is_cancelled)', 'count(*)')} AS cancellation_rate_pct
        FROM fact_orders f JOIN dim_date d ON f.order_date_key = d.date_key
        GROUP BY GROUPING SETS ((d.year, d.month), ())""",
)
check(
    "q09_return_rate_by_category",
    "category:s units_sold:i units_returned:i return_rate_pct:f",
    f"""SELECT s.category, s.units_sold, coalesce(r.back, 0) AS units_returned,
               {pct('coalesce(r.back, 0)', 's.units_sold')} AS return_rate_pct
        FROM (SELECT category, sum(quantity) AS units_sold FROM fact_order_items
              GROUP BY category) s
        LEFT JOIN (SELECT oi.category, sum(r.return_qty) AS back FROM fact_returns r
                   JOIN fact_order_items oi ON r.order_id = oi.order_id
                    AND r.order_item_id = oi.order_item_id GROUP BY oi.category) r
          ON s.category = r.category""",
)
check(
    "q10_cod_vs_prepaid",
    "payment_mode:s orders:i gmv_inr:f aov_inr:f cancellation_rate_pct:f return_rate_pct:f",
    f"""SELECT CASE WHEN cod THEN 'COD' ELSE 'Prepaid' END AS payment_mode, count(*) AS orders,
               round(sum(gmv_inr), 0) AS gmv_inr,
               {ratio('sum(order_value_inr)', 'count(*)', 2, 2)} AS aov_inr,
               {pct('sum(is_cancelled)', 'count(*)')} AS cancellation_rate_pct,
               {pct('sum(is_returned)', 'count(*)')} AS return_rate_pct
        FROM (SELECT *, is_cod = 1 AS cod FROM fact_orders) GROUP BY cod""",
)
check(
    "q11_state_sales",
    "state:s orders:i gmv_inr:f aov_inr:f state_rank:i",
    f"""SELECT c.state, count(*) AS orders, round(sum(f.gmv_inr), 0) AS gmv_inr,
               {ratio('sum(f.order_value_inr)', 'count(*)', 2, 2)} AS aov_inr,
               dense_rank() OVER (ORDER BY sum(f.gmv_inr) DESC) AS state_rank
        FROM fact_orders f JOIN customers c ON f.customer_id = c.customer_id
        WHERE f.is_cancelled = 0 GROUP BY c.state
        ORDER BY sum(f.gmv_inr) DESC, c.state LIMIT 15""",
)
check(
    "q12_carrier_sla",
    "carrier:s shipments:i avg_delivery_days:f late_rate_pct:f on_time_rate_pct:f",
    f"""SELECT carrier, n AS shipments, {ratio('days', 'n', 2, 2)} AS avg_delivery_days,
               {pct('late', 'n')} AS late_rate_pct, {pct('n - late', 'n')} AS on_time_rate_pct
        FROM (SELECT carrier, sum(shipments) AS n, sum(late_deliveries) AS late,
                     sum(avg_delivery_days * shipments) AS days
              FROM delivery_performance GROUP BY carrier)""",
)
check(
    "q13_rising_return_rate",
    "product_id:i product_name:s category:s h1_return_rate:f h2_return_rate:f delta:f",
    f"""SELECT h.product_id, p.product_name, p.category, {ratio('a', 'b', 3)} AS h1_return_rate,
               {ratio('c', 'd', 3)} AS h2_return_rate,
               {ratio('c * b - a * d', 'b * d', 3)} AS delta
        FROM (SELECT product_id,
                     sum(hit) FILTER (full_date < DATE '1998-01-01') AS a,
                     sum(quantity) FILTER (full_date < DATE '1998-01-01') AS b,
                     sum(hit) FILTER (full_date >= DATE '1998-01-01') AS c,
                     sum(quantity) FILTER (full_date >= DATE '1998-01-01') AS d
              FROM (SELECT oi.product_id, d.full_date, oi.quantity,
                           CAST(EXISTS (SELECT 1 FROM fact_returns r
                                        WHERE r.order_id = oi.order_id
                                          AND r.order_item_id = oi.order_item_id) AS INTEGER)
                               AS hit
                    FROM fact_order_items oi JOIN dim_date d ON oi.order_date_key = d.date_key)
              GROUP BY product_id) h
        JOIN dim_product p ON h.product_id = p.product_id
        WHERE b > 0 AND d > 0 AND c * b > a * d
        ORDER BY delta DESC, h.product_id LIMIT 25""",
)
check(
    "q14_seller_rank_in_state",
    "seller_state:s seller_id:i seller_name:s gmv_inr:f rank_in_state:i",
    """SELECT seller_state, seller_id, seller_name, gmv_inr,
              dense_rank() OVER (PARTITION BY seller_state ORDER BY gmv_inr DESC)
                  AS rank_in_state
       FROM seller_performance WHERE gmv_inr > 0""",
)
check(
    "q15_new_vs_repeat_revenue",
    "year:i month:i new_customer_gmv:f repeat_customer_gmv:f repeat_gmv_pct:f",
    f"""SELECT d.year, d.month, sum(gmv_inr) FILTER (is_repeat_order = 0) AS new_customer_gmv,
               sum(gmv_inr) FILTER (is_repeat_order = 1) AS repeat_customer_gmv,
               {pct('sum(gmv_inr) FILTER (is_repeat_order = 1)', 'sum(gmv_inr)', 2, 2, 2)}
                   AS repeat_gmv_pct
        FROM fact_orders f JOIN dim_date d ON f.order_date_key = d.date_key
        WHERE f.is_cancelled = 0 GROUP BY d.year, d.month""",
)
check(
    "q16_top_category_per_month",
    "year:i month:i category:s gmv_inr:f",
    """SELECT year, month, category, round(gmv, 0) AS gmv_inr
       FROM (SELECT d.year, d.month, oi.category, sum(oi.line_total_inr) AS gmv
             FROM fact_order_items oi JOIN dim_date d ON oi.order_date_key = d.date_key
             GROUP BY d.year, d.month, oi.category)
       QUALIFY row_number() OVER (PARTITION BY year, month ORDER BY gmv DESC, category) = 1""",
)
check(
    "q17_metro_delivery_days",
    "is_metro:b shipments:i avg_delivery_days:f late_rate_pct:f",
    f"""SELECT l.is_metro, count(*) AS shipments,
               {ratio('sum(s.delivery_days)', 'count(*)', 2)} AS avg_delivery_days,
               {pct('sum(s.is_late)', 'count(s.is_late)')} AS late_rate_pct
        FROM fact_shipments s JOIN fact_orders o ON s.order_id = o.order_id
        JOIN customers c ON o.customer_id = c.customer_id
        JOIN dim_location l ON l.city = coalesce(nullif(trim(c.city), ''), 'Unknown')
         AND l.state = coalesce(nullif(trim(c.state), ''), 'Unknown')
        WHERE s.delivery_days IS NOT NULL GROUP BY l.is_metro""",
)
_LIVE = "FILTER (is_cancelled = 0)"
check(
    "k01_headline",
    "gmv:f orders:i aov:f cancel_rate:f return_rate:f",
    f"""SELECT sum(gmv_inr) AS gmv, count(*) {_LIVE} AS orders,
               {quotient(f'(sum(order_value_inr) {_LIVE})', f'(count(*) {_LIVE})')} AS aov,
               {quotient('sum(is_cancelled)', 'count(*)')} AS cancel_rate,
               {quotient('sum(is_returned)', 'count(*)')} AS return_rate
        FROM fact_orders""",
)
check(
    "k02_monthly_trend",
    "month:d gmv:f orders:i",
    """SELECT CAST(date_trunc('month', order_date) AS DATE) AS month, sum(gmv_inr) AS gmv,
              sum(orders) AS orders FROM daily_sales GROUP BY 1""",
)
check(
    "k03_top_categories",
    "category:s gmv:f",
    """SELECT category, sum(line_total_inr) AS gmv FROM fact_order_items GROUP BY category
       ORDER BY gmv DESC, category LIMIT 10""",
)
check(
    "k04_top_sellers",
    "seller_name:s gmv:f",
    """SELECT seller_name, gmv_inr AS gmv FROM seller_performance
       ORDER BY gmv_inr DESC, seller_id LIMIT 10""",
)
check(
    "k05_top_states",
    "state:s gmv:f",
    """SELECT c.state, sum(f.gmv_inr) AS gmv FROM fact_orders f
       JOIN customers c ON f.customer_id = c.customer_id
       WHERE f.is_cancelled = 0 GROUP BY c.state ORDER BY gmv DESC, c.state LIMIT 15""",
)
check(
    "k06_delivery_by_carrier",
    "carrier:s avg_days:f late_pct:f",
    f"""SELECT carrier,
               {quotient('sum(avg_delivery_days * shipments)', 'sum(shipments)')} AS avg_days,
               {quotient('sum(late_deliveries) * 100', 'sum(shipments)')} AS late_pct
        FROM delivery_performance GROUP BY carrier""",
)

RAW_LINES = f"""(SELECT i.*, {title('p.category')} AS category,
                        unit_price_inr * quantity + coalesce(freight_inr, 0) AS total
                 FROM raw_items i LEFT JOIN raw_products p USING (product_id)
                 WHERE quantity > 0)"""
_VALUED = f"""(SELECT o.*, lower(trim(order_status)) AS status, g.gmv FROM raw_orders o
               LEFT JOIN (SELECT order_id, sum(total) AS gmv FROM {RAW_LINES} AS l
                          GROUP BY order_id) g USING (order_id))"""
check(
    "k07_raw_headline",
    "gmv:f orders:i aov:f cancel_rate:f return_rate:f",
    f"""SELECT gmv, orders, {quotient('gmv', 'greatest(orders, 1)')} AS aov,
               {quotient('cancelled', 'n')} AS cancel_rate,
               {quotient('returned', 'n')} AS return_rate
        FROM (SELECT sum(gmv) FILTER (status <> 'cancelled') AS gmv,
                     count(*) FILTER (status <> 'cancelled') AS orders,
                     count(*) FILTER (status = 'cancelled') AS cancelled,
                     count(*) FILTER (status = 'returned') AS returned, count(*) AS n
              FROM {_VALUED} AS v)""",
)
check(
    "k07_raw_monthly_trend",
    "month:d gmv:f orders:i",
    f"""SELECT CAST(date_trunc('month', order_purchase_ts) AS DATE) AS month,
               coalesce(sum(gmv), 0) AS gmv, count(DISTINCT order_id) AS orders
        FROM {_VALUED} AS v GROUP BY 1""",
)
check(
    "k07_raw_top_categories",
    "category:s gmv:f",
    f"""SELECT category, sum(total) AS gmv FROM {RAW_LINES} AS l WHERE category IS NOT NULL
        GROUP BY category ORDER BY gmv DESC, category LIMIT 10""",
)
