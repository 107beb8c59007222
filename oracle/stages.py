"""Reads, writes, landing, incremental operators, stages and streams."""

from oracle.base import check
from oracle.models import CUSTOMER, SELLER
from oracle.quality import TABLES, union

check(
    "src01_csv_scan",
    CUSTOMER.replace("signup_date:d", "signup_date:s").replace("customer_id:i", "customer_id:s"),
    "SELECT * FROM raw_customers",
)
check(
    "src01_csv_corrupt_rows", "corrupt:b rows_n:i units:i",
    """SELECT order_item_id = 6 AS corrupt, count(*) AS rows_n,
              sum(CASE WHEN order_item_id <> 6 THEN quantity END) AS units
       FROM raw_items GROUP BY 1""",
)
_KEY = {
    "customers": "customer_id", "sellers": "seller_id", "products": "product_id",
    "orders": "order_id", "order_items": "order_id", "payments": "order_id",
    "shipments": "order_id", "returns": "return_id",
}
check(
    "src02_declared_schemas", "feed:s rows_n:i keyed:i",
    union(*[
        f"SELECT '{t}' AS feed, count(*) AS rows_n, count({_KEY[t]}) AS keyed FROM {source}"
        for t, source in TABLES.items()
    ]),
)
check("src03_parquet_scan", SELLER, "SELECT * FROM sellers")
check(
    "src05_entity_fallback", "c_custkey:i c_name:s c_nationkey:i c_acctbal:f c_mktsegment:s",
    "SELECT * FROM customer",
)
check(
    "snk01_write_and_append", "category:s products_n:i",
    "SELECT category, 2 * count(*) AS products_n FROM products GROUP BY category",
)
check(
    "snk02_partitioned_by_month", "order_year:i order_month:i payment_type:s orders_n:i",
    """SELECT order_year, order_month,
              CASE WHEN order_year = 1997 THEN 'rewritten' ELSE payment_type END AS payment_type,
              count(*) AS orders_n
       FROM clean_orders GROUP BY 1, 2, 3""",
)
check(
    "snk03_quarantine_write", "reason:s rows_n:i",
    """SELECT 'kept' AS reason, count(*) AS rows_n FROM shipments_all
       WHERE NOT backwards AND NOT far_future
       UNION ALL SELECT 'delivered_before_shipped', count(*) FROM shipments_all
       WHERE backwards HAVING count(*) > 0
       UNION ALL SELECT 'delivered_in_far_future', count(*) FROM shipments_all
       WHERE far_future HAVING count(*) > 0""",
)
check(
    "snk06_idempotent_landing", "ingest_date:s batches:i rows_n:i landed_of_five:i",
    """SELECT '2024-01-01' AS ingest_date, 3 AS batches, 2 * count(*) + count(payment_type) AS rows_n,
              4 AS landed_of_five FROM raw_orders
       UNION ALL SELECT '2024-01-02', 1, count(*), 4 FROM raw_orders""",
)
check(
    "snk07_latest_batch", "payment_type:s orders_n:i",
    "SELECT payment_type, count(*) AS orders_n FROM raw_orders GROUP BY payment_type",
)
check(
    "snk08_materialisations", "state:s paid:f",
    """SELECT c.state, sum(p.order_paid_inr) AS paid FROM clean_orders o
       JOIN pay_metrics p ON p.order_id = o.order_id
       JOIN customers c ON c.customer_id = o.customer_id GROUP BY c.state""",
)
check(
    "snk11_stage_metrics", "entity:s observed:i stored:i",
    union(*[
        f"SELECT '{n}' AS entity, count(*) AS observed, count(*) AS stored FROM {t}"
        for n, t in (("orders", "clean_orders"), ("payments", "payments"), ("returns", "returns"))
    ]),
)

# ---------------------------------------------------------------- incremental
check(
    "s01_watermark", "order_id:i mark:t",
    """SELECT order_id, order_purchase_ts AS mark FROM clean_orders
       WHERE order_purchase_ts = (SELECT max(order_purchase_ts) FROM clean_orders)""",
)
_CUT = "TIMESTAMP '2000-07-01'"
check(
    "s02_after_watermark", "order_id:i",
    f"SELECT order_id FROM clean_orders WHERE order_purchase_ts > {_CUT}",
)
check(
    "s02_after_watermark_with_lookback", "order_id:i",
    f"SELECT order_id FROM clean_orders WHERE order_purchase_ts >= {_CUT} - INTERVAL 3 DAY",
)
check(
    "s03_watermark_advances", "taken:i mark:t",
    f"""SELECT count(*) AS taken, max(order_purchase_ts) AS mark FROM clean_orders
        WHERE order_purchase_ts < {_CUT}
        UNION ALL
        SELECT count(*), max(order_purchase_ts) FROM clean_orders
        WHERE order_purchase_ts >
              (SELECT max(order_purchase_ts) FROM clean_orders WHERE order_purchase_ts < {_CUT})""",
)
check(
    "s04_write_modes", "entity:s rows_n:i",
    """SELECT 'orders' AS entity, count(*) AS rows_n FROM clean_orders
       UNION ALL SELECT 'customers', count(*) FROM customers""",
)
_UPSERTED = """SELECT order_id, order_status,
                      CASE WHEN order_date >= DATE '1999-01-01' AND order_status = 'returned'
                           THEN 2002 ELSE order_year END AS order_year, order_month,
                      CASE WHEN order_date >= DATE '1999-01-01' THEN 'second' END AS batch
               FROM clean_orders"""
for _name in ("s05_upsert", "s05_upsert_after_broken_swap", "s05_upsert_bucketed", "s09_upsert_twice"):
    check(_name, "order_id:i order_status:s order_year:i order_month:i batch:s", _UPSERTED)
_NEWEST = """(SELECT max(order_date) - 3 FROM clean_orders WHERE order_date <= DATE '2000-03-01')"""
check(
    "s06_lookback_days", "order_id:i order_date:d",
    f"SELECT order_id, order_date FROM clean_orders WHERE order_date >= {_NEWEST}",
)
check(
    "s07_lookback_key", "order_id:i order_date_key:i",
    f"""SELECT order_id, CAST(strftime(order_date, '%Y%m%d') AS INTEGER) AS order_date_key
        FROM clean_orders WHERE order_date >= {_NEWEST}""",
)


def sizes(**tables: str) -> str:
    return union(*[
        f"SELECT '{n}' AS entity, count(*) AS rows_n FROM {t}" for n, t in tables.items()
    ])


CLEAN = dict(
    orders="clean_orders", order_items="items", payments="payments", shipments="shipments",
    returns="returns", customers="customers", sellers="sellers", products="products",
)
check("s08_window_load", "entity:s rows_n:i", sizes(**CLEAN))
check(
    "s08_window_load_effect", "in_window:b changed:b orders_n:i",
    """SELECT order_date >= DATE '2001-01-10' AS in_window, order_date >= DATE '2001-01-10' AS changed,
              count(*) AS orders_n FROM clean_orders GROUP BY ALL""",
)
check(
    "p01_landing", "source:s batches:i rows_n:i loaded_again:i",
    union(*[
        f"SELECT '{t}' AS source, 1 AS batches, count(*) AS rows_n, 0 AS loaded_again FROM {s}"
        for t, s in TABLES.items()
    ]),
)
check(
    "p01_landed_feed_in_declared_types",
    "order_item_id:i lines:i units:i with_product:i",
    """SELECT order_item_id, count(*) AS lines, sum(quantity) AS units,
              count(product_id) AS with_product FROM raw_items GROUP BY order_item_id""",
)
check(
    "src01_csv_feeds_to_clean_orders", "part:s rows_n:i",
    """SELECT 'orders' AS part, count(*) AS rows_n FROM clean_orders
       UNION ALL SELECT 'order_items', count(*) FROM raw_items WHERE order_item_id <> 6
       UNION ALL SELECT 'corrupt', count(*) FROM raw_items WHERE order_item_id = 6""",
)
check(
    "p03_raw_to_clean_in_two_runs",
    "order_id:i customer_id:i order_status:s customer_order_seq:i is_repeat_order:i order_year:i"
    " order_month:i",
    "SELECT *, CAST(customer_order_seq > 1 AS INTEGER) AS is_repeat_order FROM clean_orders",
)
check(
    "p03_raw_to_clean_row_counts", "entity:s rows_n:i",
    # lines that waited for their order in the first run are clean after the second
    f"""{sizes(**CLEAN)}
        UNION ALL SELECT 'order_items_orphan', 0
        UNION ALL SELECT 'shipments_bad_dates', count(*) FROM shipments_all
        WHERE backwards OR far_future""",
)
check(
    "p04_clean_to_staging", "order_year:i category:s lines:i total:f",
    """SELECT year(order_date) AS order_year, category, count(*) AS lines,
              sum(line_total_inr) AS total FROM fact_order_items GROUP BY 1, 2""",
)

# -------------------------------------------------------------------- streams
_VALUE = "CAST(value AS DECIMAL(18,2))"
check(
    "st01_file_ingest", "event_type:s events_n:i total:f",
    f"SELECT event_type, count(*) AS events_n, sum({_VALUE}) AS total FROM events GROUP BY event_type",
)
for _name in ("st02_stream_dedup", "st02_stream_dedup_however_late"):
    check(
        _name, "event_id:i ts:t event_type:s value:f",
        f"SELECT event_id, ts, event_type, {_VALUE} AS value FROM events",
    )
_DAYS = f"""SELECT CAST(ts AS DATE) AS day, count(*) AS events, sum({_VALUE}) AS total
            FROM events GROUP BY 1"""
check(
    "st03_daily_rollup_closed_days", "day:d events:i total:f",
    f"""SELECT * FROM ({_DAYS}) AS days WHERE CAST(day AS TIMESTAMP) + INTERVAL 1 DAY
        <= (SELECT max(ts) - INTERVAL 3 DAY FROM events)""",
)
check("st04_stream_upsert", "day:d events:i total:f", _DAYS)
