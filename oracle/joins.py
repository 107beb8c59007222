"""Joins."""

from oracle.base import check
from oracle.models import VERSIONS

_BATCH = "(SELECT order_id FROM clean_orders WHERE order_purchase_ts > TIMESTAMP '1998-01-01')"
check(
    "j01_lines_of_known_orders", "order_id:i order_item_id:i",
    f"SELECT * FROM items WHERE order_id IN {_BATCH}",
)
check(
    "j02_orphan_lines", "order_id:i order_item_id:i",
    f"SELECT * FROM items WHERE order_id NOT IN {_BATCH}",
)
check(
    "j03_product_enrichment", "order_id:i order_item_id:i category:s subcategory:s brand:s",
    "SELECT * FROM items",
)
check(
    "j04_facts_with_orders", "fact:s rows_n:i customers_n:i",
    " UNION ALL ".join(
        f"SELECT '{f}' AS fact, count(*) AS rows_n, count(DISTINCT customer_id) AS customers_n FROM {f}"
        for f in ("fact_order_items", "fact_payments", "fact_shipments", "fact_returns")
    ),
)
check(
    "j05_star_assembly",
    "payment_status_final:s is_late:i order_status:s orders_n:i gmv_inr:f paid_inr:f places:i",
    """SELECT payment_status_final, is_late, order_status, count(*) AS orders_n,
              sum(gmv_inr) AS gmv_inr, sum(paid_inr) AS paid_inr,
              count(DISTINCT location_key) AS places
       FROM fact_orders GROUP BY ALL""",
)
check(
    "j06_fact_with_calendar", "fiscal_year:i quarter:i is_weekend:b orders_n:i",
    """SELECT d.fiscal_year, d.quarter, d.is_weekend, count(*) AS orders_n
       FROM fact_orders f JOIN dim_date d ON f.order_date_key = d.date_key GROUP BY ALL""",
)
check(
    "j07_returned_lines", "order_id:i order_item_id:i return_id:s seller_id:i",
    """SELECT r.order_id, r.order_item_id, r.return_id, oi.seller_id FROM fact_returns r
       JOIN fact_order_items oi ON r.order_id = oi.order_id
        AND r.order_item_id = oi.order_item_id""",
)
check(
    "j08_line_return_flag", "order_id:i order_item_id:i is_returned:i",
    """SELECT oi.order_id, oi.order_item_id,
              CAST((oi.order_id, oi.order_item_id) IN
                   (SELECT (order_id, order_item_id) FROM fact_returns) AS INTEGER) AS is_returned
       FROM fact_order_items oi""",
)
check(
    "j09_dimension_keeps_all_rows", "customer_id:i orders_n:i",
    """SELECT c.customer_id, count(o.order_id) AS orders_n FROM customers c
       LEFT JOIN clean_orders o ON o.customer_id = c.customer_id GROUP BY c.customer_id""",
)
check(
    "j10_residual_range", "order_id:i customer_id:i",
    """SELECT o.order_id, o.customer_id FROM clean_orders o JOIN customers c
       ON o.customer_id = c.customer_id AND o.order_date >= c.signup_date""",
)
check(
    "j11_location_lookup", "seller_id:i region:s is_metro:b",
    """SELECT s.seller_id, l.region, l.is_metro FROM sellers s
       JOIN dim_location l ON l.city = s.seller_city AND l.state = s.seller_state""",
)
check(
    "j12_broken_references", "product_id:i lines:i",
    """SELECT product_id, count(*) AS lines FROM raw_items
       WHERE product_id IS NOT NULL
         AND product_id NOT IN (SELECT product_id FROM products WHERE mrp_inr >= 1000)
       GROUP BY product_id""",
)
_LOOKUP = f"""fact_order_items l LEFT JOIN ({VERSIONS}) h ON l.seller_id = h.seller_id
              AND l.order_date >= h.valid_from
              AND (h.valid_to IS NULL OR l.order_date < h.valid_to)"""
for _name in ("j13_seller_as_of_order", "j13_seller_as_of_order_merged"):
    check(
        _name,
        "order_id:i order_item_id:i seller_id:i order_date:d seller_city:s seller_rating:f"
        " business_type:s",
        f"""SELECT l.order_id, l.order_item_id, l.seller_id, l.order_date, h.seller_city,
                   h.seller_rating, h.business_type FROM {_LOOKUP}""",
    )
check(
    "j13_last_purchase_before_event",
    "event_id:i user_id:i ts:t event_type:s purchase_id:i paid:f",
    """SELECT e.event_id, e.user_id, e.ts, e.event_type, p.event_id AS purchase_id, p.value AS paid
       FROM events e ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'purchase') p
       ON e.user_id = p.user_id AND e.ts >= p.ts""",
)
check(
    "j13_seller_as_of_order_open_start", "business_type:s lines:i",
    f"""SELECT h.business_type, count(*) AS lines
        FROM {_LOOKUP.replace('l.order_date >= h.valid_from',
                              "(h.valid_from = TIMESTAMP '1996-01-01'"
                              " OR l.order_date >= h.valid_from)")}
        GROUP BY h.business_type""",
)
check(
    "j14_raw_lines_with_category", "category:s lines:i",
    """SELECT p.category, count(*) AS lines FROM raw_items i
       LEFT JOIN raw_products p USING (product_id) GROUP BY p.category""",
)
check(
    "j15_orders_with_line_totals", "order_id:i order_value_inr:f items_total:f",
    """SELECT f.order_id, f.order_value_inr, t.items_total FROM fact_orders f
       JOIN (SELECT order_id, sum(line_total_inr) AS items_total FROM fact_order_items
             GROUP BY order_id) t ON t.order_id = f.order_id""",
)
