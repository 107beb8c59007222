"""Scalar functions and the date spine."""

from oracle.base import check, dkey, key, title

check(
    "f01_f02_f03_f18_strings",
    "product_id:i lowered:s trimmed:s titled:s joined:s named:s id_text:s",
    rf"""SELECT product_id, lower(category) AS lowered, trim(category) AS trimmed,
               {title('category')} AS titled,
               regexp_replace(lower(category), '\s+and\s+', ' & ', 'g') AS joined,
               nullif(trim(product_name), '') AS named,
               coalesce(CAST(product_id AS VARCHAR), 'none') AS id_text
        FROM raw_products""",
)
check(
    "f04_flags", "order_id:i is_cod:i is_returned:i",
    """SELECT order_id, CAST(payment_type = 'COD' AS INTEGER) AS is_cod,
              CAST(order_status = 'returned' AS INTEGER) AS is_returned FROM clean_orders""",
)
check(
    "f05_f09_f10_f11_f19_dates",
    "order_id:i day:d year:i month:i days_to_approval:i month_start:d month_end:d fiscal_year:i"
    " months_since_1995:i",
    """SELECT order_id, CAST(order_purchase_ts AS DATE) AS day, year(order_purchase_ts) AS year,
              month(order_purchase_ts) AS month,
              datediff('day', CAST(order_purchase_ts AS DATE), CAST(order_approved_ts AS DATE))
                  AS days_to_approval,
              date_trunc('month', order_purchase_ts) AS month_start,
              last_day(order_purchase_ts) AS month_end,
              year(order_purchase_ts - INTERVAL 3 MONTH) AS fiscal_year,
              datediff('month', DATE '1995-01-01', order_purchase_ts) AS months_since_1995
       FROM clean_orders""",
)
check(
    "f06_date_key", "order_id:i date_key:i",
    f"SELECT order_id, {dkey('order_date')} AS date_key FROM clean_orders",
)
check(
    "f07_f08_calendar_parts",
    "date_key:i quarter:i day_of_week:i week_of_year:i month_name:s day_name:s",
    "SELECT * FROM dim_date",
)
check(
    "f12_rounding",
    "order_id:i order_item_id:i product_id:i seller_id:i whole:f cents:f distance:i capped:f",
    """SELECT order_id, order_item_id, product_id, seller_id, round(unit_price_inr, 0) AS whole,
              round(discount_inr, 2) AS cents, abs(quantity - 25) AS distance,
              least(unit_price_inr, 50000) AS capped FROM raw_items""",
)
check(
    "f13_surrogate_key", "customer_id:i key:s",
    f"SELECT customer_id, {key('city', 'state')} AS key FROM raw_customers",
)
check(
    "f14_interval_before_newest", "window_start:d by_key:d",
    """SELECT max(CAST(o_orderdate AS DATE)) - 3 AS window_start,
              max(CAST(o_orderdate AS DATE)) - 3 AS by_key FROM orders""",
)
check(
    "f15_compare_with_today", "after_day:i after_today:i",
    """SELECT count(*) FILTER (CAST(o_orderdate AS DATE) > DATE '2001-01-01') AS after_day,
              count(*) FILTER (CAST(o_orderdate AS DATE) > current_date) AS after_today
       FROM orders""",
)
check(
    "f16_numeric_coercion", "l_linenumber:i rows_n:i numbers:i total:f",
    """SELECT l_linenumber, count(*) AS rows_n,
              count(*) FILTER (l_linenumber <> 5) AS numbers,
              sum(l_quantity) FILTER (l_linenumber <> 5) AS total
       FROM lineitem GROUP BY l_linenumber""",
)
check(
    "f17_case_blind_membership", "known:i other:i",
    """SELECT count(*) FILTER (lower(trim(order_status)) IN ('delivered', 'shipped')) AS known,
              count(*) FILTER (lower(trim(order_status)) NOT IN ('delivered', 'shipped'))
                  AS other FROM raw_orders""",
)
check(
    "f20_content_digest", "rows_n:i length:i same:b moved:b renamed:b",
    """SELECT count(*) AS rows_n, 32 AS length, true AS same, false AS moved, false AS renamed
    FROM orders""",
)
check(
    "f20_content_tree_digest", "rows_n:i length:i same:b moved:b renamed:b twice:b",
    """SELECT count(*) AS rows_n, 64 AS length, true AS same, false AS moved, false AS renamed, false AS twice
    FROM orders""",
)
check(
    "src06_date_spine", "full_date:d",
    """SELECT unnest(generate_series(
           (SELECT date_trunc('year', min(l_shipdate)) FROM lineitem),
           (SELECT date_trunc('year', max(l_shipdate)) + INTERVAL 1 YEAR - INTERVAL 1 DAY
            FROM lineitem), INTERVAL 1 DAY)) AS full_date""",
)
