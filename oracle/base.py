"""Shared pieces of the check SQL: the layers as common table expressions, and typed output."""

from __future__ import annotations

import re

_TYPES = {
    "i": "BIGINT", "f": "DOUBLE", "s": "VARCHAR", "b": "BOOLEAN", "d": "DATE", "t": "TIMESTAMP",
}
SQL: dict[str, str] = {}


def ratio(n: str, d: str, scale: int, ns: int = 0, ds: int = 0) -> str:
    """n/d rounded half away from zero, as integer division; ns/ds are the digits they carry."""
    top = f"CAST(({n}) * {10**ns} AS HUGEINT)"
    bottom = f"CAST(({d}) * {10**ds} AS HUGEINT)"
    shift = scale + ds - ns
    a, b = f"abs({top})", f"abs({bottom})"
    if shift >= 0:
        a = f"{a} * {10**shift}"
    else:
        b = f"{b} * {10**-shift}"
    return (
        f"(CASE WHEN {bottom} <> 0 THEN (CASE WHEN ({top} < 0) <> ({bottom} < 0) THEN -1 ELSE 1"
        f" END) * ((2 * {a} + {b}) // (2 * {b})) / {10**scale}.0 END)"
    )


def pct(n: str, d: str, scale: int = 2, ns: int = 0, ds: int = 0) -> str:
    return ratio(f"({n}) * 100", d, scale, ns, ds)


def quotient(n: str, d: str) -> str:
    return f"(CAST({n} AS DOUBLE) / CAST({d} AS DOUBLE))"


def safe(n: str, d: str) -> str:
    return (
        f"(CASE WHEN coalesce(CAST({d} AS DOUBLE), 0) = 0 THEN 0.0 ELSE {quotient(n, d)} END)"
    )


def title(x: str) -> str:
    return (
        f"array_to_string(list_transform(string_split(lower(trim({x})), ' '),"
        " lambda w: upper(w[1:1]) || w[2:]), ' ')"
    )


def blank(x: str) -> str:
    return f"coalesce(nullif(trim({x}), ''), 'Unknown')"


def key(*cols: str) -> str:
    parts = [f"coalesce(CAST({c} AS VARCHAR), '_dbt_utils_surrogate_key_null_')" for c in cols]
    return f"md5({' || chr(45) || '.join(parts)})"


def dkey(x: str) -> str:
    return f"CAST(strftime(CAST({x} AS DATE), '%Y%m%d') AS INTEGER)"


def values(items) -> str:
    return "[" + ", ".join("NULL" if v is None else f"'{v}'" for v in items) + "]"


def pick(items, k: str) -> str:
    items = list(items)
    return f"({values(items)})[CAST({k} % {len(items)} AS INTEGER) + 1]"


CITIES = (
    "BANGALORE", " Bengaluru ", "new delhi", "Mumbai", "bombay", "pune", "  ", "Hyderabad",
    "jaipur", None, "CALCUTTA", "Lucknow",
)
STATES = (
    "Karnataka", "karnataka ", "Delhi", "Maharashtra", "MAHARASHTRA", "jammu and kashmir",
    "West Bengal", "Telangana", "Rajasthan", "Uttar Pradesh", "Tamil Nadu", "Kerala", "Gujarat",
    "Punjab", "Haryana", "Bihar", "Odisha", "Assam", "Goa", "Sikkim", "Nagaland", "Tripura",
    "Madhya Pradesh", "Puducherry", "Ladakh",
)
CATEGORIES = (
    "HOME AND KITCHEN", "Home & Kitchen", " Fashion ", "toys & baby", "Electronics",
    "mobiles and accessories", "Beauty & Personal Care", "APPLIANCES", "books", "Grocery",
    "sports  and fitness", "Misc",
)
CARRIERS = ("Ekart", "Delhivery", "BlueDart", "XpressBees", "IndiaPost", "Shadowfax")
PAY_TYPES = ("COD", "UPI", "Credit Card", "Debit Card", "Wallet", "Net Banking")


def city(x: str) -> str:
    return (
        f"CASE lower(trim({x})) WHEN 'bangalore' THEN 'Bengaluru' WHEN 'bengaluru' THEN"
        " 'Bengaluru' WHEN 'new delhi' THEN 'Delhi' WHEN 'delhi' THEN 'Delhi'"
        " WHEN 'bombay' THEN 'Mumbai' WHEN 'mumbai' THEN 'Mumbai'"
        f" WHEN 'calcutta' THEN 'Kolkata' WHEN 'kolkata' THEN 'Kolkata' ELSE {title(x)} END"
    )


def category(x: str) -> str:
    return title(rf"regexp_replace(lower({x}), '\s+and\s+', ' & ', 'g')")


CTE: dict[str, str] = {
    # ------------------------------------------------------------- raw roles
    "raw_customers": f"""
        SELECT c_custkey AS customer_id, c_name AS customer_name, CAST(NULL AS VARCHAR) AS email,
               CAST(NULL AS VARCHAR) AS phone, {pick(CITIES, 'c_custkey')} AS city,
               {pick(STATES, 'c_nationkey')} AS state,
               CAST(c_nationkey + 110000 AS VARCHAR) AS pincode,
               DATE '1995-01-01' + CAST(c_custkey * 37 % 1500 AS INTEGER) AS signup_date,
               c_mktsegment AS customer_segment
        FROM customer""",
    "raw_sellers": f"""
        SELECT s_suppkey AS seller_id, s_name AS seller_name,
               {pick(CITIES, 's_suppkey')} AS seller_city,
               {pick(STATES, 's_nationkey')} AS seller_state, s_suppkey % 3 + 1 AS seller_tier,
               CAST(s_nationkey + 110000 AS VARCHAR) AS seller_pincode,
               DATE '1994-01-01' + CAST(s_suppkey * 53 % 1000 AS INTEGER) AS onboarded_date,
               CAST((CAST(floor(abs(s_acctbal)) AS BIGINT) % 41 + 10) * 0.1 AS DECIMAL(3,1))
                   AS seller_rating,
               {pick(('Manufacturer', 'Reseller', 'Distributor'), 's_suppkey')} AS business_type
        FROM supplier""",
    "raw_products": f"""
        SELECT nullif(p_partkey, 0) AS product_id, p_name AS product_name,
               {pick(CATEGORIES, 'p_partkey')} AS category, p_type AS subcategory,
               p_brand AS brand,
               CAST(p_retailprice AS DECIMAL(18,2)) * CASE WHEN p_partkey % 97 = 0 THEN -1 ELSE 1
                   END AS mrp_inr,
               CASE WHEN p_size < 50 THEN p_size * 200 END AS weight_grams
        FROM part""",
    "raw_orders": """
        SELECT o_orderkey AS order_id, o_custkey AS customer_id,
               CASE WHEN o_orderstatus = 'P' THEN 'CANCELLED'
                    WHEN o_orderstatus = 'F' AND o_orderpriority = '5-LOW' THEN 'Returned'
                    WHEN o_orderstatus = 'F' THEN 'Delivered '
                    WHEN o_orderpriority = '1-URGENT' THEN 'processing'
                    WHEN o_orderstatus = 'O' THEN 'shipped' ELSE 'CANCELLED' END AS order_status,
               o_orderdate AS order_purchase_ts,
               CASE WHEN o_orderkey % 50 <> 0
                    THEN o_orderdate + to_hours(CAST(o_orderkey % 48 AS INTEGER)) END
                   AS order_approved_ts,
               CASE o_orderpriority WHEN '1-URGENT' THEN 'COD' WHEN '5-LOW' THEN 'COD'
                    WHEN '2-HIGH' THEN 'UPI' WHEN '3-MEDIUM' THEN 'Credit Card' END
                   AS payment_type
        FROM orders""",
    "raw_items": """
        SELECT l_orderkey AS order_id, l_linenumber AS order_item_id,
               nullif(l_partkey, 0) AS product_id, l_suppkey AS seller_id,
               CASE WHEN l_partkey % 199 = 7 THEN 0 ELSE CAST(l_quantity AS INTEGER) END
                   AS quantity,
               CAST(l_extendedprice AS DECIMAL(18,2)) AS unit_price_inr,
               CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(4,2))
                   AS DECIMAL(18,4)) AS discount_inr,
               CASE WHEN l_tax <> 0 THEN CAST(CAST(l_extendedprice AS DECIMAL(18,2))
                   * CAST(l_tax AS DECIMAL(4,2)) AS DECIMAL(18,4)) END AS freight_inr,
               l_shipdate AS updated_ts
        FROM lineitem""",
    "raw_payments": f"""
        SELECT l_orderkey AS order_id, l_linenumber AS payment_sequential,
               {pick(PAY_TYPES, 'l_linenumber')} AS payment_type,
               l_linenumber % 4 + 1 AS payment_installments,
               CASE WHEN l_discount <> 0 THEN CAST(l_extendedprice AS DECIMAL(18,2)) END
                   AS payment_value_inr,
               CASE WHEN l_suppkey % 7 = 0 THEN NULL WHEN l_suppkey % 7 = 1 THEN 'declined'
                    WHEN l_returnflag = 'R' THEN 'Reversed' WHEN l_returnflag = 'A' THEN ' PAID '
                    ELSE 'in_process' END AS payment_status,
               l_shipdate AS updated_ts, l_partkey AS part_ref, l_suppkey AS seller_ref
        FROM lineitem""",
    "raw_shipments": f"""
        SELECT l_orderkey AS order_id, {pick(CARRIERS, 'l_suppkey')} AS carrier,
               CASE WHEN l_partkey % 50 <> 1
                    THEN l_shipdate + to_days(CAST(1 - l_partkey % 9 AS INTEGER)) END AS ship_ts,
               CAST(l_shipdate AS DATE) + CAST(l_linenumber % 3 - 1 AS INTEGER)
                   AS estimated_delivery_date,
               CASE WHEN l_linestatus = 'O' AND l_suppkey % 5 = 0 THEN NULL
                    WHEN l_partkey % 211 = 3 THEN TIMESTAMP '2099-01-01' ELSE l_shipdate END
                   AS delivered_ts,
               CASE WHEN l_linestatus = 'O' AND l_suppkey % 5 = 0 THEN 'in_transit'
                    ELSE 'delivered' END AS delivery_status,
               l_linenumber AS line_ref, l_partkey AS part_ref, l_suppkey AS seller_ref
        FROM lineitem""",
    "raw_returns": f"""
        SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS return_id,
               l_orderkey AS order_id, l_linenumber AS order_item_id,
               nullif(l_partkey, 0) AS product_id,
               {pick(('Defective', 'Wrong item', 'Better price available', 'Not needed'),
                     'l_partkey')} AS return_reason,
               {pick(('requested', 'approved', 'completed', 'rejected'), 'l_suppkey')}
                   AS return_status,
               CAST(l_quantity AS INTEGER) % 3 + 1 AS return_qty,
               round(CAST(l_extendedprice AS DECIMAL(18,2))
                   * (1 - CAST(l_discount AS DECIMAL(4,2))), 2) AS refund_amount_inr,
               l_shipdate + to_days(CAST(l_suppkey % 10 AS INTEGER)) AS return_requested_ts,
               CASE WHEN l_suppkey % 4 <> 0
                    THEN l_shipdate + to_days(CAST(l_suppkey % 10 + l_partkey % 15 AS INTEGER))
                    END AS return_completed_ts
        FROM lineitem WHERE l_returnflag = 'R'""",
    # ------------------------------------------------------------------ clean
    "customers": f"""
        SELECT * REPLACE (coalesce({city('city')}, 'Unknown') AS city,
                          coalesce({title('state')}, 'Unknown') AS state)
        FROM raw_customers WHERE customer_id IS NOT NULL""",
    "sellers": f"""
        SELECT * REPLACE ({city('seller_city')} AS seller_city,
                          {title('seller_state')} AS seller_state)
        FROM raw_sellers WHERE seller_id IS NOT NULL""",
    "products": f"""
        SELECT * REPLACE ({category('category')} AS category,
                          CASE WHEN mrp_inr >= 0 THEN mrp_inr END AS mrp_inr)
        FROM raw_products WHERE product_id IS NOT NULL""",
    "clean_orders": """
        SELECT * REPLACE (lower(trim(order_status)) AS order_status),
               CAST(order_purchase_ts AS DATE) AS order_date,
               year(order_purchase_ts) AS order_year, month(order_purchase_ts) AS order_month,
               CAST(payment_type = 'COD' AS INTEGER) AS is_cod,
               row_number() OVER (PARTITION BY customer_id ORDER BY order_purchase_ts, order_id)
                   AS customer_order_seq
        FROM raw_orders WHERE order_id IS NOT NULL AND customer_id IS NOT NULL""",
    "dedup_items": """
        SELECT * FROM raw_items
        WHERE order_id IS NOT NULL AND order_item_id IS NOT NULL AND product_id IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY order_id, order_item_id
            ORDER BY updated_ts DESC, product_id DESC, seller_id DESC) = 1""",
    "items": """
        SELECT i.*, round(unit_price_inr * quantity + coalesce(freight_inr, 0), 2)
                   AS line_total_inr, p.category, p.subcategory, p.brand
        FROM dedup_items i LEFT JOIN products p USING (product_id) WHERE quantity > 0""",
    "payments": """
        SELECT order_id, payment_sequential, payment_type, payment_installments,
               coalesce(payment_value_inr, 0) AS payment_value_inr,
               CASE lower(trim(payment_status)) WHEN 'declined' THEN 'failed'
                    WHEN 'reversed' THEN 'refunded' WHEN 'paid' THEN 'paid'
                    WHEN 'in_process' THEN 'pending' ELSE 'unknown' END AS payment_status,
               CAST(payment_value_inr IS NULL AS INTEGER) AS payment_value_missing
        FROM raw_payments
        QUALIFY row_number() OVER (PARTITION BY order_id, payment_sequential
            ORDER BY updated_ts DESC, part_ref DESC, seller_ref DESC) = 1""",
    "shipments_all": """
        SELECT *, coalesce(delivered_ts < ship_ts, false) AS backwards,
               coalesce(delivered_ts >= TIMESTAMP '2099-01-01', false) AS far_future
        FROM raw_shipments
        QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY delivered_ts DESC NULLS LAST,
            line_ref DESC, part_ref DESC, seller_ref DESC) = 1""",
    "shipments": """
        SELECT *, datediff('day', CAST(ship_ts AS DATE), CAST(delivered_ts AS DATE))
                   AS delivery_days,
               CAST(CAST(delivered_ts AS DATE) > estimated_delivery_date AS INTEGER) AS is_late
        FROM shipments_all WHERE NOT backwards AND NOT far_future""",
    "returns": """
        SELECT *, datediff('day', CAST(return_requested_ts AS DATE),
                           CAST(return_completed_ts AS DATE)) AS days_to_return_complete
        FROM raw_returns""",
    # ------------------------------------------------------------------- star
    "dim_date": """
        SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS full_date,
               year(d) AS year, quarter(d) AS quarter, month(d) AS month,
               strftime(d, '%B') AS month_name, day(d) AS day_of_month, isodow(d) AS day_of_week,
               strftime(d, '%A') AS day_name, week(d) AS week_of_year,
               isodow(d) IN (6, 7) AS is_weekend, day(d) = 1 AS is_month_start,
               d = last_day(d) AS is_month_end,
               CASE WHEN month(d) >= 4 THEN year(d) ELSE year(d) - 1 END AS fiscal_year
        FROM (SELECT CAST(unnest(generate_series(
                  (SELECT date_trunc('year', min(o_orderdate)) FROM orders),
                  (SELECT date_trunc('year', max(o_orderdate)) + INTERVAL 1 YEAR
                          - INTERVAL 1 DAY FROM orders), INTERVAL 1 DAY)) AS DATE) AS d)""",
    "dim_product": """
        SELECT *, CASE WHEN weight_grams < 500 THEN 'Light' WHEN weight_grams < 5000
                  THEN 'Medium' ELSE 'Heavy' END AS weight_band FROM products""",
    "dim_location": f"""
        SELECT {key('city', 'state')} AS location_key, city, state,
               CASE WHEN state IN ('Delhi', 'Punjab', 'Haryana', 'Uttar Pradesh', 'Uttarakhand',
                        'Rajasthan', 'Chandigarh', 'Jammu And Kashmir', 'Himachal Pradesh')
                        THEN 'North'
                    WHEN state IN ('Maharashtra', 'Gujarat', 'Goa', 'Madhya Pradesh',
                        'Chhattisgarh') THEN 'West'
                    WHEN state IN ('Karnataka', 'Tamil Nadu', 'Kerala', 'Telangana',
                        'Andhra Pradesh', 'Puducherry') THEN 'South'
                    WHEN state IN ('West Bengal', 'Bihar', 'Odisha', 'Jharkhand', 'Assam',
                        'Meghalaya', 'Manipur', 'Mizoram', 'Sikkim') THEN 'East'
                    ELSE 'Other' END AS region,
               city IN ('Mumbai', 'Delhi', 'Bengaluru', 'Hyderabad', 'Chennai', 'Kolkata',
                        'Pune', 'Ahmedabad', 'Chandigarh') AS is_metro
        FROM (SELECT {blank('city')} AS city, {blank('state')} AS state FROM customers
              UNION SELECT {blank('seller_city')}, {blank('seller_state')} FROM sellers)""",
    "item_metrics": """
        SELECT order_id, count(*) AS n_items, sum(quantity) AS total_units,
               count(DISTINCT product_id) AS n_distinct_products,
               count(DISTINCT seller_id) AS n_distinct_sellers,
               sum(unit_price_inr * quantity) AS gross_merchandise_value_inr,
               sum(discount_inr) AS total_discount_inr,
               sum(coalesce(freight_inr, 0)) AS total_freight_inr,
               sum(line_total_inr) AS order_line_total_inr
        FROM items GROUP BY order_id""",
    "pay_metrics": """
        SELECT order_id, sum(payment_value_inr) AS order_paid_inr,
               max(payment_installments) AS max_installments, count(*) AS n_payment_records,
               ['refunded', 'paid', 'pending', 'failed', 'unknown'][min(coalesce(nullif(
                   list_position(['refunded', 'paid', 'pending', 'failed'], payment_status), 0), 5))]
                   AS payment_status_final
        FROM payments GROUP BY order_id""",
    "fact_orders": f"""
        SELECT o.order_id, o.customer_id, {dkey('o.order_date')} AS order_date_key,
               {key(blank('c.city'), blank('c.state'))} AS location_key, o.order_status,
               o.payment_type, o.is_cod,
               CAST(o.customer_order_seq > 1 AS INTEGER) AS is_repeat_order,
               coalesce(i.gross_merchandise_value_inr, 0) AS gmv_inr,
               coalesce(i.order_line_total_inr, 0) AS order_value_inr,
               coalesce(i.total_units, 0) AS total_units, coalesce(i.n_items, 0) AS n_items,
               coalesce(i.total_discount_inr, 0) AS discount_inr,
               coalesce(i.total_freight_inr, 0) AS freight_inr,
               coalesce(p.order_paid_inr, 0) AS paid_inr, p.payment_status_final,
               s.delivery_days, s.is_late,
               CAST(o.order_status = 'cancelled' AS INTEGER) AS is_cancelled,
               CAST(o.order_status = 'returned' AS INTEGER) AS is_returned,
               CAST(o.order_status = 'delivered' AS INTEGER) AS is_delivered
        FROM clean_orders o LEFT JOIN item_metrics i USING (order_id)
             LEFT JOIN pay_metrics p USING (order_id) LEFT JOIN shipments s USING (order_id)
             LEFT JOIN customers c ON o.customer_id = c.customer_id""",
    "fact_order_items": f"""
        SELECT i.order_id, i.order_item_id, i.product_id, i.seller_id, o.customer_id,
               {dkey('o.order_date')} AS order_date_key, o.order_date, o.order_status, i.quantity,
               i.unit_price_inr, coalesce(i.discount_inr, 0) AS discount_inr,
               coalesce(i.freight_inr, 0) AS freight_inr, i.line_total_inr,
               i.unit_price_inr * i.quantity AS gross_line_value_inr, i.category, i.brand
        FROM items i JOIN clean_orders o USING (order_id)""",
    "fact_payments": f"""
        SELECT p.order_id, p.payment_sequential, o.customer_id,
               {dkey('o.order_date')} AS order_date_key, p.payment_type, p.payment_status,
               p.payment_installments, p.payment_value_inr, p.payment_value_missing
        FROM payments p JOIN clean_orders o USING (order_id)""",
    "fact_shipments": f"""
        SELECT s.order_id, o.customer_id, {dkey('o.order_date')} AS order_date_key, s.carrier,
               s.ship_ts, s.estimated_delivery_date, s.delivered_ts, s.delivery_status,
               s.delivery_days, s.is_late
        FROM shipments s JOIN clean_orders o USING (order_id)""",
    "fact_returns": f"""
        SELECT r.return_id, r.order_id, r.order_item_id, r.product_id, o.customer_id,
               {dkey('r.return_requested_ts')} AS return_date_key, r.return_reason,
               r.return_status, r.return_qty, r.refund_amount_inr, r.days_to_return_complete
        FROM returns r JOIN clean_orders o USING (order_id)""",
    # ------------------------------------------------------------------ marts
    "daily_sales": f"""
        SELECT d.full_date AS order_date, max(d.date_key) AS order_date_key,
               count(*) AS orders, count(*) FILTER (is_cancelled = 0) AS valid_orders,
               coalesce(sum(gmv_inr) FILTER (is_cancelled = 0), 0) AS gmv_inr,
               coalesce(sum(total_units) FILTER (is_cancelled = 0), 0) AS units,
               {safe('sum(gmv_inr) FILTER (is_cancelled = 0)',
                     'count(*) FILTER (is_cancelled = 0)')} AS aov_inr,
               count(*) FILTER (is_cancelled = 1) AS cancelled_orders,
               count(*) FILTER (is_returned = 1) AS returned_orders,
               count(*) FILTER (is_cod = 1) AS cod_orders,
               {safe('count(*) FILTER (is_cancelled = 1)', 'count(*)')} AS cancellation_rate,
               {safe('count(*) FILTER (is_cod = 1)', 'count(*)')} AS cod_share
        FROM fact_orders f JOIN dim_date d ON f.order_date_key = d.date_key
        GROUP BY d.full_date""",
    "seller_performance": f"""
        SELECT s.seller_id, s.seller_name, s.seller_state, s.seller_tier, s.seller_rating,
               s.business_type, coalesce(i.orders, 0) AS orders, coalesce(i.units, 0) AS units,
               coalesce(i.gmv_inr, 0) AS gmv_inr,
               coalesce(r.returned_lines, 0) AS returned_lines,
               {safe('coalesce(r.returned_lines, 0)', 'i.units')} AS return_rate,
               coalesce({ratio('coalesce(i.gmv_inr, 0)', 'i.orders', 2, 2)}, 0)
                   AS avg_order_value_inr
        FROM sellers s
        LEFT JOIN (SELECT seller_id, count(DISTINCT order_id) AS orders, sum(quantity) AS units,
                          sum(line_total_inr) AS gmv_inr FROM fact_order_items
                   GROUP BY seller_id) i USING (seller_id)
        LEFT JOIN (SELECT oi.seller_id, count(*) AS returned_lines FROM fact_returns r
                   JOIN fact_order_items oi ON r.order_id = oi.order_id
                    AND r.order_item_id = oi.order_item_id
                   GROUP BY oi.seller_id) r USING (seller_id)""",
    "product_performance": f"""
        SELECT p.product_id, p.product_name, p.category, p.subcategory, p.brand, p.mrp_inr,
               coalesce(i.units_sold, 0) AS units_sold, coalesce(i.orders, 0) AS orders,
               coalesce(i.gmv_inr, 0) AS gmv_inr, coalesce(r.units_returned, 0) AS units_returned,
               {safe('coalesce(r.units_returned, 0)', 'i.units_sold')} AS return_rate
        FROM dim_product p
        LEFT JOIN (SELECT product_id, sum(quantity) AS units_sold, sum(line_total_inr) AS gmv_inr,
                          count(DISTINCT order_id) AS orders FROM fact_order_items
                   GROUP BY product_id) i USING (product_id)
        LEFT JOIN (SELECT product_id, sum(return_qty) AS units_returned FROM fact_returns
                   GROUP BY product_id) r USING (product_id)""",
    "customer_summary": f"""
        SELECT c.customer_id, c.customer_name, c.city, c.state, c.customer_segment,
               coalesce(o.orders, 0) AS orders, coalesce(o.spend, 0) AS total_spend_inr,
               coalesce({ratio('coalesce(o.spend, 0)', 'o.orders', 2, 2)}, 0) AS aov_inr,
               o.first_order_date_key, o.last_order_date_key,
               coalesce(o.orders, 0) > 1 AS is_repeat_customer
        FROM customers c
        LEFT JOIN (SELECT customer_id, count(*) FILTER (is_cancelled = 0) AS orders,
                          sum(gmv_inr) FILTER (is_cancelled = 0) AS spend,
                          min(order_date_key) AS first_order_date_key,
                          max(order_date_key) AS last_order_date_key
                   FROM fact_orders GROUP BY customer_id) o USING (customer_id)""",
    "delivery_performance": f"""
        SELECT c.state, s.carrier, count(*) AS shipments,
               CAST({ratio('sum(s.delivery_days)', 'count(*)', 2)} AS DECIMAL(24,2))
                   AS avg_delivery_days,
               sum(s.is_late) AS late_deliveries, {safe('sum(s.is_late)', 'count(*)')} AS late_rate,
               1 - {safe('sum(s.is_late)', 'count(*)')} AS on_time_rate
        FROM fact_shipments s JOIN fact_orders o USING (order_id)
             JOIN customers c ON o.customer_id = c.customer_id
        WHERE s.delivery_days IS NOT NULL GROUP BY c.state, s.carrier""",
}


def _needed(body: str, found: set[str]) -> set[str]:
    for name, sql in CTE.items():
        if name not in found and re.search(rf"\b{name}\b", body):
            found.add(name)
            _needed(sql, found)
    return found


def with_layers(body: str) -> str:
    """Prefix the layers a statement mentions, in order of definition."""
    names = _needed(body, set())
    head = ", ".join(f"{n} AS ({CTE[n]})" for n in CTE if n in names)
    return f"WITH {head} {body}" if head else body


def check(name: str, columns: str, body: str) -> None:
    """Register the SQL of a query; ``columns`` is like ``"year:i gmv_inr:f"``."""
    cast = ", ".join(
        f'CAST("{c}" AS {_TYPES[t]}) AS "{c}"' for c, t in (x.split(":") for x in columns.split())
    )
    SQL[name] = with_layers(f"SELECT {cast} FROM ({body}) AS result")
