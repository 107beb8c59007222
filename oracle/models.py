"""Dimensions, rollups, facts, marts and seller history."""

from oracle.base import check, key

check(
    "a01_dim_date",
    "date_key:i full_date:d year:i quarter:i month:i month_name:s day_of_month:i day_of_week:i"
    " day_name:s week_of_year:i is_weekend:b is_month_start:b is_month_end:b fiscal_year:i",
    "SELECT * FROM dim_date",
)
CUSTOMER = (
    "customer_id:i customer_name:s email:s phone:s city:s state:s pincode:s signup_date:d"
    " customer_segment:s"
)
SELLER = (
    "seller_id:i seller_name:s seller_city:s seller_state:s seller_tier:i seller_pincode:s"
    " onboarded_date:d seller_rating:f business_type:s"
)
PRODUCT = (
    "product_id:i product_name:s category:s subcategory:s brand:s mrp_inr:f weight_grams:i"
)
check("a05_dim_customer", CUSTOMER, "SELECT * FROM customers")
check("a06_dim_product", f"{PRODUCT} weight_band:s", "SELECT * FROM dim_product")
check("a07_dim_seller", SELLER, "SELECT * FROM sellers")
check(
    "a08_dim_location", "location_key:s city:s state:s region:s is_metro:b",
    "SELECT * FROM dim_location",
)
check(
    "a09_order_item_metrics",
    "order_id:i n_items:i total_units:i n_distinct_products:i n_distinct_sellers:i"
    " gross_merchandise_value_inr:f total_discount_inr:f total_freight_inr:f"
    " order_line_total_inr:f",
    "SELECT * FROM item_metrics",
)
check(
    "a09_order_payments",
    "order_id:i order_paid_inr:f max_installments:i n_payment_records:i payment_status_final:s",
    "SELECT * FROM pay_metrics",
)
check(
    "a10_fact_orders",
    "order_id:i customer_id:i order_date_key:i location_key:s order_status:s payment_type:s"
    " is_cod:i is_repeat_order:i gmv_inr:f order_value_inr:f total_units:i n_items:i"
    " discount_inr:f freight_inr:f paid_inr:f payment_status_final:s delivery_days:i is_late:i"
    " is_cancelled:i is_returned:i is_delivered:i",
    "SELECT * FROM fact_orders",
)
LINE = (
    "order_id:i order_item_id:i product_id:i seller_id:i customer_id:i order_date_key:i"
    " order_date:d order_status:s quantity:i unit_price_inr:f discount_inr:f freight_inr:f"
    " line_total_inr:f gross_line_value_inr:f category:s brand:s"
)
check("a11_fact_order_items", LINE, "SELECT * FROM fact_order_items")
check(
    "a11_fact_order_items_incremental",
    f"{LINE} order_year:i order_month:i",
    """SELECT *, year(order_date) AS order_year, month(order_date) AS order_month
       FROM fact_order_items""",
)
check(
    "a12_fact_payments",
    "order_id:i payment_sequential:i customer_id:i order_date_key:i payment_type:s"
    " payment_status:s payment_installments:i payment_value_inr:f payment_value_missing:i",
    "SELECT * FROM fact_payments",
)
check(
    "a13_fact_shipments",
    "order_id:i customer_id:i order_date_key:i carrier:s ship_ts:t estimated_delivery_date:d"
    " delivered_ts:t delivery_status:s delivery_days:i is_late:i",
    "SELECT * FROM fact_shipments",
)
check(
    "a14_fact_returns",
    "return_id:s order_id:i order_item_id:i product_id:i customer_id:i return_date_key:i"
    " return_reason:s return_status:s return_qty:i refund_amount_inr:f"
    " days_to_return_complete:i",
    "SELECT * FROM fact_returns",
)
DAILY = (
    "order_date:d order_date_key:i orders:i valid_orders:i gmv_inr:f units:i aov_inr:f"
    " cancelled_orders:i returned_orders:i cod_orders:i cancellation_rate:f cod_share:f"
)
check("a15_daily_sales", DAILY, "SELECT * FROM daily_sales")
check("a15_daily_sales_incremental", DAILY, "SELECT * FROM daily_sales")
check(
    "a16_seller_performance",
    "seller_id:i seller_name:s seller_state:s seller_tier:i seller_rating:f business_type:s"
    " orders:i units:i gmv_inr:f returned_lines:i return_rate:f avg_order_value_inr:f",
    "SELECT * FROM seller_performance",
)
check(
    "a17_product_performance",
    "product_id:i product_name:s category:s subcategory:s brand:s mrp_inr:f units_sold:i orders:i"
    " gmv_inr:f units_returned:i return_rate:f",
    "SELECT * FROM product_performance",
)
check(
    "a18_customer_summary",
    "customer_id:i customer_name:s city:s state:s customer_segment:s orders:i total_spend_inr:f"
    " aov_inr:f first_order_date_key:i last_order_date_key:i is_repeat_customer:b",
    "SELECT * FROM customer_summary",
)
check(
    "a19_delivery_performance",
    "state:s carrier:s shipments:i avg_delivery_days:f late_deliveries:i late_rate:f"
    " on_time_rate:f",
    "SELECT * FROM delivery_performance",
)

# ------------------------------------------------------------- seller history
# The lowest id changes in the second snapshot; the highest id is missing in it.
CHANGED = """SELECT * REPLACE (
        CASE WHEN low THEN least(5.0, seller_rating + 0.4) ELSE seller_rating END
            AS seller_rating,
        CASE WHEN low THEN 'Pune' ELSE seller_city END AS seller_city,
        CASE WHEN low THEN 'Brand Store' ELSE business_type END AS business_type)
    FROM (SELECT *, seller_id = (SELECT min(seller_id) FROM sellers) AS low,
                 seller_id = (SELECT max(seller_id) FROM sellers) AS high FROM sellers)"""
VERSIONS = f"""
    SELECT * EXCLUDE (low, high), TIMESTAMP '1996-01-01' AS valid_from,
           CASE WHEN low OR high THEN TIMESTAMP '1998-01-01' END AS valid_to
    FROM (SELECT *, seller_id = (SELECT min(seller_id) FROM sellers) AS low,
                 seller_id = (SELECT max(seller_id) FROM sellers) AS high FROM sellers)
    UNION ALL
    SELECT * EXCLUDE (low, high), TIMESTAMP '1998-01-01', CAST(NULL AS TIMESTAMP)
    FROM ({CHANGED}) WHERE low"""
check("a02_scd2_two_snapshots", f"{SELLER} valid_from:t valid_to:t", VERSIONS)
check(
    "a02_scd2_persisted",
    f"{SELLER} valid_from:t valid_to:t",
    f"""SELECT * REPLACE (CASE WHEN valid_from = TIMESTAMP '1998-01-01'
                          THEN TIMESTAMP '1999-01-01' ELSE valid_to END AS valid_to)
        FROM ({VERSIONS})
        UNION ALL
        SELECT *, TIMESTAMP '1999-01-01', CAST(NULL AS TIMESTAMP) FROM sellers
        WHERE seller_id IN ((SELECT min(seller_id) FROM sellers),
                            (SELECT max(seller_id) FROM sellers))""",
)
check("a04_demo_change", SELLER, f"SELECT * EXCLUDE (low, high) FROM ({CHANGED})")
check(
    "a03_dim_seller_history",
    "seller_version_key:s seller_id:i seller_name:s seller_city:s seller_state:s seller_tier:i"
    " seller_rating:f business_type:s effective_start_date:t effective_end_date:t is_current:b",
    f"""SELECT {key('seller_id', "strftime(valid_from, '%Y-%m-%d %H:%M:%S')")}
                   AS seller_version_key, *, valid_from AS effective_start_date,
               valid_to AS effective_end_date, valid_to IS NULL AS is_current
        FROM ({VERSIONS})""",
)
