"""Quality rules, gate and model tests."""

from oracle.base import check

SHORT = "table:s check:s severity:s n_violations:i n_total:i"
TABLES = {
    "customers": "raw_customers", "sellers": "raw_sellers", "products": "raw_products",
    "orders": "raw_orders", "order_items": "raw_items", "payments": "raw_payments",
    "shipments": "raw_shipments", "returns": "raw_returns",
}
ACCEPTED = {
    "category": ["mobiles & accessories", "electronics", "fashion", "home & kitchen",
                 "beauty & personal care", "appliances", "books", "grocery", "toys & baby",
                 "sports & fitness"],
    "order_status": ["delivered", "shipped", "processing", "cancelled", "returned"],
    "payment_status": ["paid", "pending", "failed", "refunded"],
}


def repeated(keys: str) -> str:
    return f"count(*) OVER (PARTITION BY {keys}) > 1"


def missing(col: str, parent: str, ref: str) -> str:
    return f"{col} IS NOT NULL AND {col} NOT IN (SELECT {ref} FROM {parent} WHERE {ref} IS NOT NULL)"


def outside(col: str) -> str:
    members = ", ".join(f"'{v}'" for v in ACCEPTED[col])
    return f"{col} IS NOT NULL AND lower(trim({col})) NOT IN ({members})"


def rule(table: str, name: str, severity: str, bad: str, detail: str, source: str = "") -> str:
    return f"""SELECT '{table}' AS "table", '{name}' AS "check", '{severity}' AS severity,
        count(*) FILTER (bad) AS n_violations, count(*) AS n_total, '{detail}' AS detail
        FROM (SELECT coalesce({bad}, false) AS bad FROM {source or TABLES[table]})"""


def pk(table: str, keys: str) -> str:
    return rule(table, "pk_unique", "reject", repeated(keys), f"key {keys.replace(',', ' + ')}")


def nn(table: str, cols: str) -> str:
    bad = " OR ".join(f"{c} IS NULL" for c in cols.split(","))
    return rule(table, "critical_not_null", "reject", bad, f"required: {cols.replace(',', ' + ')}")


def ri(table: str, col: str, parent: str, source: str = "") -> str:
    return rule(
        table, "referential_integrity", "quarantine",
        missing(col, source or TABLES[parent], col), f"{col} without its row in {parent}",
    )


def accepted(table: str, col: str) -> str:
    return rule(table, f"valid_{col}", "correct", outside(col), f"none of {len(ACCEPTED[col])} accepted values")


MRP = rule("products", "non_negative_mrp_inr", "quarantine", "mrp_inr <= 0", "zero or below")
QUANTITY = rule("order_items", "non_negative_quantity", "reject", "quantity <= 0", "zero or below")
PRICE = rule("order_items", "non_negative_unit_price_inr", "quarantine", "unit_price_inr < 0", "below zero")
ORDERED = rule(
    "shipments", "date_order_delivered_ts_ge_ship_ts", "quarantine", "delivered_ts < ship_ts",
    "delivered_ts precedes ship_ts",
)


def future(table: str, col: str, horizon: str) -> str:
    return rule(table, f"future_{col}", "quarantine", f"{col} > TIMESTAMP '{horizon}'", f"after {horizon}")


def duration(days: int) -> str:
    return rule(
        "shipments", "delivery_duration_sane", "allow",
        f"floor(epoch(delivered_ts - ship_ts) / 86400) > {days}", f"over {days} days under way",
    )


def union(*parts: str) -> str:
    return " UNION ALL ".join(parts)


SUITE = union(
    pk("customers", "customer_id"), nn("customers", "customer_id"),
    pk("sellers", "seller_id"), nn("sellers", "seller_id"),
    pk("products", "product_id"), nn("products", "product_id"), MRP,
    accepted("products", "category"),
    pk("orders", "order_id"), nn("orders", "order_id,customer_id,order_purchase_ts"),
    ri("orders", "customer_id", "customers"), accepted("orders", "order_status"),
    pk("order_items", "order_id,order_item_id"),
    nn("order_items", "order_id,order_item_id,product_id"),
    ri("order_items", "order_id", "orders"), ri("order_items", "product_id", "products"),
    ri("order_items", "seller_id", "sellers"), QUANTITY, PRICE,
    pk("payments", "order_id,payment_sequential"), ri("payments", "order_id", "orders"),
    accepted("payments", "payment_status"),
    ri("shipments", "order_id", "orders"), ORDERED, future("shipments", "delivered_ts", "2100-01-01"),
    duration(45),
    pk("returns", "return_id"), ri("returns", "order_id", "orders"),
)
RATED = f"""SELECT *, CAST(n_violations AS DOUBLE) / n_total AS violation_rate,
                   n_violations = 0 AS passed FROM ({SUITE})"""

check("dq01_primary_key_unique", SHORT,
      union(pk("order_items", "order_id,order_item_id"), pk("orders", "order_id")))
check("dq02_critical_not_null", SHORT,
      union(nn("order_items", "order_id,product_id"), nn("orders", "order_id,order_approved_ts")))
LATE_ORDERS = "(SELECT * FROM raw_orders WHERE order_purchase_ts >= TIMESTAMP '1997-01-01')"
FIRST_SELLERS = "(SELECT * FROM raw_sellers WHERE seller_tier < 3)"
check(
    "dq03_referential_integrity", SHORT,
    union(ri("order_items", "order_id", "orders", LATE_ORDERS),
          ri("order_items", "product_id", "products"),
          ri("order_items", "seller_id", "sellers", FIRST_SELLERS)),
)
check("dq04_non_negative", SHORT, union(MRP, QUANTITY, PRICE))
check(
    "dq05_valid_values", SHORT,
    union(accepted("products", "category"), accepted("orders", "order_status"),
          accepted("payments", "payment_status")),
)
check("dq06_date_order", SHORT, ORDERED)
check(
    "dq07_future_dates", SHORT,
    union(future("shipments", "delivered_ts", "2100-01-01"),
          future("returns", "return_requested_ts", "2001-06-01")),
)
check("dq08_delivery_duration", SHORT, duration(5))
check(
    "dq09_violation_rate", "detail:s violation_rate:f passed:b",
    f"""SELECT detail, CAST(n_violations AS DOUBLE) / n_total AS violation_rate,
               n_violations = 0 AS passed
        FROM ({union(nn('orders', 'order_approved_ts'), nn('orders', 'order_id'))})""",
)
check("dq10_standard_suite", f"{SHORT} detail:s violation_rate:f passed:b", RATED)
BREACHES = f"""SELECT * FROM ({RATED}) WHERE (severity = 'reject' AND violation_rate > 0.05)
               OR (severity = 'quarantine' AND violation_rate > 0.10)"""
check("dq12_threshold_breaches", "table:s check:s severity:s violation_rate:f", BREACHES)
check(
    "p02_gate_results_and_breaches", f"{SHORT} detail:s over_limit:b goes_on:b",
    f"""SELECT *, (severity = 'reject' AND violation_rate > 0.05)
                  OR (severity = 'quarantine' AND violation_rate > 0.10) AS over_limit,
               true AS goes_on FROM ({RATED})""",
)
_HELD = f"""(SELECT count(*) FROM raw_products WHERE mrp_inr <= 0)
            + (SELECT count(*) FROM raw_shipments WHERE delivered_ts < ship_ts)
            + (SELECT count(*) FROM raw_items
               WHERE {missing('product_id', 'raw_products', 'product_id')})"""
check(
    "dq13_quality_gate",
    "severity:s checks:i with_findings:i violations:i gate_passed:b quarantined_rows:i",
    f"""SELECT severity, count(*) AS checks, count(*) FILTER (NOT passed) AS with_findings,
               sum(n_violations) AS violations,
               (SELECT count(*) FROM ({BREACHES})) = 0 AS gate_passed, {_HELD} AS quarantined_rows
        FROM ({RATED}) GROUP BY severity""",
)
_LAST = {
    "customers": "customer_segment", "sellers": "business_type", "products": "weight_grams",
    "orders": "payment_type", "order_items": "freight_inr", "payments": "payment_status",
    "shipments": "delivery_status", "returns": "return_completed_ts",
}
check(
    "dq14_required_columns", "feed:s missing:s missing_in_whole:s rejected_rows:i",
    union(*[
        f"SELECT '{t}' AS feed, '{c}' AS missing, '' AS missing_in_whole, count(*) AS rejected_rows FROM {TABLES[t]}"
        for t, c in _LAST.items()
    ]),
)

# ------------------------------------------------------------------ model tests
MODELS = {
    "stg_customers": "customers", "stg_sellers": "sellers", "stg_products": "products",
    "stg_orders": "clean_orders", "stg_order_items": "items", "stg_payments": "payments",
    "stg_shipments": "shipments", "stg_returns": "returns", "int_order_payments": "pay_metrics",
    "int_order_item_metrics": "item_metrics", "customers": "customers",
    "dim_customer": "customers", "dim_seller": "sellers",
}
TESTED = "table:s check:s n_violations:i passed:b"


def finding(table: str, name: str, count: str) -> str:
    return f"""SELECT '{table}' AS "table", '{name}' AS "check", n AS n_violations, n = 0 AS passed
               FROM (SELECT ({count}) AS n)"""


def source(model: str) -> str:
    return MODELS.get(model, model)


def t_not_null(model: str, col: str) -> str:
    return finding(model, f"not_null_{col}", f"SELECT count(*) FROM {source(model)} WHERE {col} IS NULL")


def repeats(table: str, cols: str) -> str:
    return f"""SELECT count(*) FROM (SELECT {cols} FROM {table} GROUP BY {cols}
               HAVING count(*) > 1)"""


def t_unique(model: str, col: str) -> str:
    count = f"""SELECT count(*) FROM (SELECT {col} FROM {source(model)}
                WHERE {col} IS NOT NULL GROUP BY {col} HAVING count(*) > 1)"""
    return finding(model, f"unique_{col}", count)


def t_combination(model: str, *cols: str) -> str:
    return finding(model, f"unique_combination_{'_'.join(cols)}",
                   repeats(source(model), ", ".join(cols)))


def t_values(model: str, col: str, values: list[str]) -> str:
    members = ", ".join(f"'{v}'" for v in values)
    return finding(model, f"accepted_values_{col}",
                   f"SELECT count(*) FROM {source(model)} WHERE {col} NOT IN ({members})")


def t_range(model: str, col: str, bad: str) -> str:
    return finding(model, f"accepted_range_{col}", f"SELECT count(*) FROM {source(model)} WHERE {bad}")


def t_parent(model: str, col: str, parent: str, ref: str) -> str:
    return finding(model, f"relationships_{col}",
                   f"SELECT count(*) FROM {source(model)} WHERE {missing(col, source(parent), ref)}")


SEGMENTS = ["BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
PAY = [*ACCEPTED["payment_status"], "unknown"]
STG_KEYS = [
    ("stg_customers", "customer_id"), ("stg_sellers", "seller_id"),
    ("stg_products", "product_id"), ("stg_orders", "order_id"), ("stg_returns", "return_id"),
    ("int_order_payments", "order_id"), ("int_order_item_metrics", "order_id"),
]
NOT_NULL = [t_not_null(m, c) for m, c in STG_KEYS] + [
    t_not_null("stg_orders", "customer_id"), t_not_null("stg_order_items", "order_id"),
    t_not_null("stg_shipments", "order_id"),
]
UNIQUE = [t_unique(m, c) for m, c in STG_KEYS]
VALUES = [
    t_values("stg_customers", "customer_segment", SEGMENTS),
    t_values("stg_orders", "order_status", ACCEPTED["order_status"]),
    t_values("stg_payments", "payment_status", PAY),
]
PARENTS = [
    t_parent("stg_orders", "customer_id", "stg_customers", "customer_id"),
    t_parent("stg_order_items", "order_id", "stg_orders", "order_id"),
    t_parent("stg_payments", "order_id", "stg_orders", "order_id"),
]
check("dq15_model_not_null", TESTED, union(*NOT_NULL))
check("dq16_model_unique", TESTED, union(*UNIQUE))
check(
    "dq16_unique_counts_keys", "check:s n_violations:i passed:b",
    union(*[
        finding("raw", f"unique_{c}", f"SELECT count(*) FROM (SELECT {c} FROM raw_items WHERE {c}"
                f" IS NOT NULL GROUP BY {c} HAVING count(*) > 1)")
        for c in ("order_id", "product_id")
    ]),
)
check(
    "dq17_model_unique_combination", "table:s n_violations:i passed:b",
    union(finding("order_items", "x", repeats("raw_items", "order_id, order_item_id")),
          finding("payments", "x", repeats("payments", "order_id, payment_sequential"))),
)
check("dq18_model_accepted_values", TESTED, union(*VALUES))
check(
    "dq19_model_accepted_range", "table:s n_violations:i passed:b",
    union(
        finding("raw_order_items", "x",
                "SELECT count(*) FROM raw_items WHERE quantity < 1 OR quantity > 40"),
        finding("stg_order_items", "x", "SELECT count(*) FROM items WHERE quantity < 1"),
        finding("seller_performance", "x",
                "SELECT count(*) FROM seller_performance WHERE return_rate < 0 OR return_rate > 1"),
    ),
)
check("dq20_model_relationships", TESTED, union(*PARENTS))
check(
    "dq21_unreconciled_orders", "order_id:i order_value_inr:f items_total:f diff:f",
    """SELECT f.order_id, f.gmv_inr AS order_value_inr, t.total AS items_total,
              abs(f.gmv_inr - t.total) AS diff
       FROM fact_orders f JOIN (SELECT order_id, sum(line_total_inr) AS total
                                FROM fact_order_items GROUP BY order_id) t
         ON t.order_id = f.order_id
       WHERE abs(f.gmv_inr - t.total) > 1.0""",
)
check(
    "dq22_future_orders", "order_id:i order_date:d",
    "SELECT order_id, order_date FROM clean_orders WHERE order_date > DATE '2001-06-30'",
)
BUILD = """SELECT 'orders_were_built' AS "check", (SELECT count(*) FROM fact_orders) AS n,
                  (SELECT count(*) FROM fact_orders) > 0 AS passed
           UNION ALL SELECT 'orders_without_id', n, n = 0
           FROM (SELECT count(*) AS n FROM fact_orders WHERE order_id IS NULL)
           UNION ALL SELECT 'days_below_zero', n, n = 0
           FROM (SELECT count(*) AS n FROM daily_sales WHERE gmv_inr < 0)"""
check("dq23_build_checks", "check:s n:i passed:b", BUILD)

_REASONS = union(
    "SELECT 'products' AS \"table\", 'non_negative_mrp_inr' AS reason FROM raw_products WHERE mrp_inr <= 0",
    "SELECT 'order_items', 'non_negative_unit_price_inr' FROM raw_items WHERE unit_price_inr < 0",
    f"SELECT 'order_items', 'referential_integrity_order_id' FROM raw_items WHERE {missing('order_id', LATE_ORDERS, 'order_id')}",
    f"SELECT 'order_items', 'referential_integrity_product_id' FROM raw_items WHERE {missing('product_id', 'raw_products', 'product_id')}",
    f"SELECT 'order_items', 'referential_integrity_seller_id' FROM raw_items WHERE {missing('seller_id', FIRST_SELLERS, 'seller_id')}",
    f"SELECT 'payments', 'referential_integrity_order_id' FROM raw_payments WHERE {missing('order_id', LATE_ORDERS, 'order_id')}",
    f"SELECT 'shipments', 'referential_integrity_order_id' FROM raw_shipments WHERE {missing('order_id', LATE_ORDERS, 'order_id')}",
    f"SELECT 'returns', 'referential_integrity_order_id' FROM raw_returns WHERE {missing('order_id', LATE_ORDERS, 'order_id')}",
    "SELECT 'orders', 'referential_integrity_customer_id' FROM raw_orders WHERE order_purchase_ts >= TIMESTAMP '1997-01-01' AND "
    f"{missing('customer_id', 'raw_customers', 'customer_id')}",
    "SELECT 'shipments', 'date_order_delivered_ts_ge_ship_ts' FROM raw_shipments WHERE delivered_ts < ship_ts",
    "SELECT 'shipments', 'future_delivered_ts' FROM raw_shipments WHERE delivered_ts > TIMESTAMP '2100-01-01'",
)
check(
    "snk04_gate_quarantine", "table:s reason:s rows_n:i",
    f'SELECT "table", reason, count(*) AS rows_n FROM ({_REASONS}) GROUP BY ALL',
)

# ------------------------------------------------------------- the whole build
DAY = "dim_date"
CORE_KEYS = [
    ("dim_date", "date_key"), ("dim_customer", "customer_id"), ("dim_product", "product_id"),
    ("dim_seller", "seller_id"), ("dim_location", "location_key"), ("fact_orders", "order_id"),
    ("fact_returns", "return_id"), ("daily_sales", "order_date"),
    ("seller_performance", "seller_id"), ("product_performance", "product_id"),
    ("customer_summary", "customer_id"),
]
ZERO = [  # first snapshot: one open version per seller
    finding("dim_seller_history", name, "SELECT 0") for name in
    ("not_null_seller_version_key", "unique_seller_version_key", "not_null_seller_id",
     "not_null_is_current")
]
check(
    "p05_build_and_test", TESTED,
    union(
        *NOT_NULL, *UNIQUE, *VALUES, *PARENTS, *ZERO,
        *[t(m, c) for m, c in CORE_KEYS for t in (t_not_null, t_unique)],
        t_range("stg_order_items", "quantity", "quantity < 1"),
        t_combination("stg_order_items", "order_id", "order_item_id"),
        t_not_null("fact_orders", "customer_id"),
        t_parent("fact_orders", "customer_id", "dim_customer", "customer_id"),
        t_parent("fact_orders", "order_date_key", DAY, "date_key"),
        t_range("fact_orders", "gmv_inr", "gmv_inr < 0"),
        t_not_null("fact_order_items", "product_id"),
        t_parent("fact_order_items", "product_id", "dim_product", "product_id"),
        t_parent("fact_order_items", "seller_id", "dim_seller", "seller_id"),
        t_parent("fact_order_items", "order_date_key", DAY, "date_key"),
        t_range("fact_order_items", "quantity", "quantity < 1"),
        t_combination("fact_order_items", "order_id", "order_item_id"),
        t_values("fact_payments", "payment_status", PAY),
        t_combination("fact_payments", "order_id", "payment_sequential"),
        t_not_null("fact_shipments", "order_id"),
        t_parent("fact_returns", "order_id", "fact_orders", "order_id"),
        t_range("daily_sales", "gmv_inr", "gmv_inr < 0"),
        t_range("seller_performance", "return_rate", "return_rate < 0 OR return_rate > 1"),
        t_combination("delivery_performance", "state", "carrier"),
        finding("fact_orders", "order_value_reconciles",
                """SELECT count(*) FROM fact_orders f JOIN (SELECT order_id,
                   sum(line_total_inr) AS total FROM fact_order_items GROUP BY order_id) t
                   USING (order_id) WHERE abs(f.order_value_inr - t.total) > 1.0"""),
        finding("stg_orders", "no_future_order_dates",
                "SELECT count(*) FROM clean_orders WHERE order_date > current_date"),
        f'''SELECT 'build' AS "table", "check", n AS n_violations, passed FROM ({BUILD})''',
    ),
)
