"""Filters, projections and cleaning."""

from oracle.base import blank, category, check, city, title
from oracle.models import CUSTOMER, PRODUCT, SELLER

KEYS = "order_id:i order_item_id:i product_id:i"
check(
    "pf01_required_keys", f"{KEYS} seller_id:i unit_price_inr:f",
    """SELECT * FROM raw_items WHERE order_id IS NOT NULL AND order_item_id IS NOT NULL
       AND product_id IS NOT NULL""",
)
check(
    "pf02_positive_quantity", "order_id:i order_item_id:i seller_id:i quantity:i",
    "SELECT * FROM raw_items WHERE quantity > 0",
)
check(
    "pf03_canonical_city", "customer_id:i city:s",
    f"SELECT customer_id, {city('city')} AS city FROM raw_customers",
)
check(
    "pf04_canonical_payment_status", "payment_status:s records:i",
    """SELECT CASE lower(trim(payment_status)) WHEN 'declined' THEN 'failed' WHEN 'reversed'
              THEN 'refunded' WHEN 'paid' THEN 'paid' WHEN 'in_process' THEN 'pending'
              ELSE 'unknown' END AS payment_status, count(*) AS records
       FROM raw_payments GROUP BY 1""",
)
check(
    "pf05_canonical_category", "product_id:i category:s",
    f"SELECT product_id, {category('category')} AS category FROM raw_products",
)
check(
    "pf06_clean_state", "customer_id:i state:s",
    f"SELECT customer_id, coalesce({title('state')}, 'Unknown') AS state FROM raw_customers",
)
check(
    "pf07_unknown_fill", "customer_id:i city:s email:s",
    """SELECT customer_id, coalesce(city, 'Unknown') AS city, coalesce(email, 'Unknown') AS email
       FROM raw_customers""",
)
check(
    "pf08_negative_price_to_null", "product_id:i mrp_inr:f",
    """SELECT product_id, CASE WHEN mrp_inr < 0 THEN NULL ELSE mrp_inr END AS mrp_inr
       FROM raw_products WHERE product_id IS NOT NULL""",
)
check(
    "pf09_missing_payment_value",
    "order_id:i payment_sequential:i payment_value_inr:f payment_value_missing:i",
    "SELECT * FROM payments",
)
check(
    "pf10_order_status", "order_status:s orders:i",
    "SELECT lower(trim(order_status)) AS order_status, count(*) AS orders FROM raw_orders GROUP BY 1",
)
check(
    "pf11_cod_flag", "is_cod:i orders:i",
    """SELECT CASE WHEN payment_type IS NULL THEN NULL WHEN payment_type = 'COD' THEN 1 ELSE 0
              END AS is_cod, count(*) AS orders FROM raw_orders GROUP BY 1""",
)
check(
    "pf12_order_date_parts", "order_id:i order_date:d order_year:i order_month:i",
    """SELECT order_id, CAST(order_purchase_ts AS DATE) AS order_date,
              year(order_purchase_ts) AS order_year, month(order_purchase_ts) AS order_month
       FROM raw_orders""",
)
check(
    "pf13_line_total", "order_id:i order_item_id:i line_total_inr:f", "SELECT * FROM items",
)
check("pf14_delivery_days", "order_id:i delivery_days:i", "SELECT * FROM shipments")
check(
    "pf15_late_flag", "is_late:i shipments:i",
    "SELECT is_late, count(*) AS shipments FROM shipments GROUP BY is_late",
)
check(
    "pf16_days_to_return_complete", "return_id:s days_to_return_complete:i",
    "SELECT * FROM returns",
)
check(
    "pf17_timeline_split", "order_id:i side:s reasons:s",
    """SELECT order_id, CASE WHEN backwards OR far_future THEN 'quarantine' ELSE 'clean' END AS side,
              concat_ws(',', CASE WHEN backwards THEN 'delivered_before_shipped' END,
                        CASE WHEN far_future THEN 'delivered_in_far_future' END) AS reasons
       FROM shipments_all""",
)
STG_ORDERS = (
    "order_id:i customer_id:i order_status:s order_purchase_ts:t order_approved_ts:t"
    " order_date:d payment_type:s is_cod:i customer_order_seq:i is_repeat_order:i"
)
ITEM = (
    "order_id:i order_item_id:i product_id:i seller_id:i quantity:i unit_price_inr:f"
    " discount_inr:f freight_inr:f line_total_inr:f category:s subcategory:s brand:s"
)
PAYMENT = (
    "order_id:i payment_sequential:i payment_type:s payment_installments:i payment_value_inr:f"
    " payment_status:s payment_value_missing:i"
)
SHIPMENT = (
    "order_id:i carrier:s ship_ts:t estimated_delivery_date:d delivered_ts:t delivery_status:s"
    " delivery_days:i is_late:i"
)
RETURN = (
    "return_id:s order_id:i order_item_id:i product_id:i return_reason:s return_status:s"
    " return_qty:i refund_amount_inr:f return_requested_ts:t return_completed_ts:t"
    " days_to_return_complete:i"
)
_ORDERS = "SELECT *, CAST(customer_order_seq > 1 AS INTEGER) AS is_repeat_order FROM clean_orders"
_STG_ITEMS = """SELECT * REPLACE (coalesce(freight_inr, 0) AS freight_inr,
                                  coalesce(discount_inr, 0) AS discount_inr) FROM items"""
check("pf18_stg_customers", CUSTOMER, "SELECT * FROM customers")
check("pf18_stg_sellers", SELLER, "SELECT * FROM sellers")
check("pf18_stg_products", PRODUCT, "SELECT * FROM products")
check("pf18_stg_orders", STG_ORDERS, _ORDERS)
check("pf18_stg_order_items", ITEM, _STG_ITEMS)
check("pf18_stg_payments", PAYMENT, "SELECT * FROM payments")
check("pf18_stg_shipments", SHIPMENT, "SELECT * FROM shipments")
check("pf18_stg_returns", RETURN, "SELECT * FROM returns")
check(
    "pf19_weight_band", "weight_band:s products:i",
    "SELECT weight_band, count(*) AS products FROM dim_product GROUP BY weight_band",
)
check(
    "pf20_region", "region:s customers_n:i",
    """SELECT region, count(*) AS customers_n FROM customers c
       JOIN (SELECT DISTINCT state, region FROM dim_location) USING (state) GROUP BY region""",
)
check(
    "pf21_metro", "is_metro:b places:i",
    "SELECT is_metro, count(*) AS places FROM dim_location GROUP BY is_metro",
)
check(
    "pf22_blank_to_unknown", "customer_id:i city:s",
    f"SELECT customer_id, {blank('city')} AS city FROM raw_customers",
)
check(
    "pf23_status_flags", "order_status:s is_cancelled:i is_returned:i is_delivered:i",
    """SELECT order_status, count(*) FILTER (order_status = 'cancelled') AS is_cancelled,
              count(*) FILTER (order_status = 'returned') AS is_returned,
              count(*) FILTER (order_status = 'delivered') AS is_delivered
       FROM clean_orders GROUP BY order_status""",
)
check(
    "pf24_gross_line_value", "order_id:i order_item_id:i gross_line_value_inr:f",
    "SELECT * FROM fact_order_items",
)
check(
    "pf25_timestamp_text", "o_orderkey:i parsed_ts:t parsed_date:d",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 9 <> 0 THEN o_orderdate END AS parsed_ts,
              CASE WHEN o_orderkey % 9 <> 0 THEN CAST(o_orderdate AS DATE) END AS parsed_date
       FROM orders""",
)
check("pf26_clean_customers", CUSTOMER, "SELECT * FROM customers")
check("pf26_clean_sellers", SELLER, "SELECT * FROM sellers")
check("pf26_clean_products", PRODUCT, "SELECT * FROM products")
check("pf26_clean_orders", f"{STG_ORDERS} order_year:i order_month:i", _ORDERS)
_KNOWN = "WHERE order_id IN (SELECT order_id FROM clean_orders)"
check("pf26_clean_order_items", ITEM, f"SELECT * FROM items {_KNOWN}")
check("pf26_clean_payments", PAYMENT, f"SELECT * FROM payments {_KNOWN}")
check("pf26_clean_shipments", SHIPMENT, f"SELECT * FROM shipments {_KNOWN}")
check("pf26_clean_returns", RETURN, f"SELECT * FROM returns {_KNOWN}")
