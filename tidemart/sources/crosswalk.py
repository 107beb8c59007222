"""The given star-schema tables in the roles of the eight raw feeds.

Row-local projections only (no join, no shuffle): each feed is a view over one table.
Where the tables lack an attribute, it is derived from a key column, including the untidy
spellings and impossible values the cleaning rules exist for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.functions.text import sql_literal

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
BUSINESS_TYPES = ("Manufacturer", "Reseller", "Distributor")
CARRIERS = ("Ekart", "Delhivery", "BlueDart", "XpressBees", "IndiaPost", "Shadowfax")
PAY_TYPES = ("COD", "UPI", "Credit Card", "Debit Card", "Wallet", "Net Banking")
REASONS = ("Defective", "Wrong item", "Better price available", "Not needed")
RETURN_STATUSES = ("requested", "approved", "completed", "rejected")


def pick(values: tuple, index: Column) -> Column:
    """Value at a zero-based position."""
    array = F.expr(f"array({', '.join(map(sql_literal, values))})")
    return F.element_at(array, (index + 1).cast("int"))


def _cycle(values: tuple, key: str) -> Column:
    return pick(values, F.col(key) % len(values))


def _dec(c: str, scale: int = 2) -> Column:
    return F.col(c).cast(f"decimal(18,{scale})")


def _plus_days(ts: Column, days: Column) -> Column:
    return (ts + F.make_dt_interval(days.cast("int"))).cast("timestamp_ntz")


def customers(t: DataFrame) -> DataFrame:
    return t.select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        F.lit(None).cast("string").alias("email"),
        F.lit(None).cast("string").alias("phone"),
        _cycle(CITIES, "c_custkey").alias("city"),
        _cycle(STATES, "c_nationkey").alias("state"),
        (F.col("c_nationkey") + 110000).cast("string").alias("pincode"),
        F.date_add(F.lit("1995-01-01").cast("date"), (F.col("c_custkey") * 37 % 1500).cast("int"))
        .cast("string")
        .alias("signup_date"),
        F.col("c_mktsegment").alias("customer_segment"),
    )


def sellers(t: DataFrame) -> DataFrame:
    return t.select(
        F.col("s_suppkey").alias("seller_id"),
        F.col("s_name").alias("seller_name"),
        _cycle(CITIES, "s_suppkey").alias("seller_city"),
        _cycle(STATES, "s_nationkey").alias("seller_state"),
        (F.col("s_suppkey") % 3 + 1).cast("int").alias("seller_tier"),
        (F.col("s_nationkey") + 110000).cast("string").alias("seller_pincode"),
        F.date_add(F.lit("1994-01-01").cast("date"), (F.col("s_suppkey") * 53 % 1000).cast("int"))
        .cast("string")
        .alias("onboarded_date"),
        ((F.floor(F.abs("s_acctbal")) % 41 + 10) * F.lit("0.1").cast("decimal(2,1)"))
        .cast("decimal(3,1)")
        .alias("seller_rating"),
        _cycle(BUSINESS_TYPES, "s_suppkey").alias("business_type"),
    )


def products(t: DataFrame) -> DataFrame:
    price = _dec("p_retailprice")
    return t.select(
        F.nullif(F.col("p_partkey"), F.lit(0)).alias("product_id"),
        F.col("p_name").alias("product_name"),
        _cycle(CATEGORIES, "p_partkey").alias("category"),
        F.col("p_type").alias("subcategory"),
        F.col("p_brand").alias("brand"),
        F.when(F.col("p_partkey") % 97 == 0, -price).otherwise(price).cast("decimal(18,2)")
        .alias("mrp_inr"),
        F.when(F.col("p_size") < 50, F.col("p_size") * 200).cast("int").alias("weight_grams"),
    )


def orders(t: DataFrame) -> DataFrame:
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    spelled = (
        F.when((status == "F") & (priority == "5-LOW"), "Returned")
        .when(status == "F", "Delivered ")
        .when((status == "O") & (priority == "1-URGENT"), "processing")
        .when(status == "O", "shipped")
        .otherwise("CANCELLED")
    )
    paid_by = (
        F.when(priority.isin("1-URGENT", "5-LOW"), "COD")
        .when(priority == "2-HIGH", "UPI")
        .when(priority == "3-MEDIUM", "Credit Card")
    )
    approved = F.col("o_orderdate") + F.make_dt_interval(
        F.lit(0), (F.col("o_orderkey") % 48).cast("int")
    )
    return t.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        spelled.alias("order_status"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("order_purchase_ts"),
        F.when(F.col("o_orderkey") % 50 != 0, approved).cast("timestamp_ntz")
        .alias("order_approved_ts"),
        paid_by.alias("payment_type"),
    )


def _line_product() -> Column:
    return F.nullif(F.col("l_partkey"), F.lit(0)).alias("product_id")


def order_items(t: DataFrame) -> DataFrame:
    price, tax = _dec("l_extendedprice"), F.col("l_tax").cast("decimal(4,2)")
    return t.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("order_item_id"),
        _line_product(),
        F.col("l_suppkey").alias("seller_id"),
        F.when(F.col("l_partkey") % 199 == 7, 0)
        .otherwise(F.col("l_quantity").cast("int"))
        .alias("quantity"),
        price.alias("unit_price_inr"),
        (price * F.col("l_discount").cast("decimal(4,2)")).cast("decimal(18,4)")
        .alias("discount_inr"),
        F.when(tax != 0, price * tax).cast("decimal(18,4)").alias("freight_inr"),
        F.lit(None).cast("decimal(18,2)").alias("line_total_inr"),
        F.col("l_shipdate").cast("timestamp_ntz").alias("updated_ts"),
    )


def payments(t: DataFrame) -> DataFrame:
    flag, seller = F.col("l_returnflag"), F.col("l_suppkey") % 7
    status = (
        F.when(seller == 0, F.lit(None))
        .when(seller == 1, "declined")
        .when(flag == "R", "Reversed")
        .when(flag == "A", " PAID ")
        .otherwise("in_process")
    )
    return t.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("payment_sequential"),
        _cycle(PAY_TYPES, "l_linenumber").alias("payment_type"),
        (F.col("l_linenumber") % 4 + 1).cast("int").alias("payment_installments"),
        F.when(F.col("l_discount") != 0, _dec("l_extendedprice")).alias("payment_value_inr"),
        status.alias("payment_status"),
        F.col("l_shipdate").cast("timestamp_ntz").alias("updated_ts"),
        F.col("l_partkey").alias("part_ref"),
        F.col("l_suppkey").alias("seller_ref"),
    )


def shipments(t: DataFrame) -> DataFrame:
    arrival = F.col("l_shipdate").cast("timestamp_ntz")
    shipped = _plus_days(arrival, 1 - F.col("l_partkey") % 9)
    delivered = (
        F.when((F.col("l_linestatus") == "O") & (F.col("l_suppkey") % 5 == 0), F.lit(None))
        .when(F.col("l_partkey") % 211 == 3, F.lit("2099-01-01").cast("timestamp_ntz"))
        .otherwise(arrival)
    )
    return t.select(
        F.col("l_orderkey").alias("order_id"),
        _cycle(CARRIERS, "l_suppkey").alias("carrier"),
        F.when(F.col("l_partkey") % 50 != 1, shipped).alias("ship_ts"),
        F.to_date(_plus_days(arrival, F.col("l_linenumber") % 3 - 1)).alias(
            "estimated_delivery_date"
        ),
        delivered.alias("delivered_ts"),
        F.when(delivered.isNull(), "in_transit").otherwise("delivered").alias("delivery_status"),
        F.col("l_linenumber").alias("line_ref"),
        F.col("l_partkey").alias("part_ref"),
        F.col("l_suppkey").alias("seller_ref"),
    )


def returns(t: DataFrame) -> DataFrame:
    requested = _plus_days(F.col("l_shipdate").cast("timestamp_ntz"), F.col("l_suppkey") % 10)
    completed = _plus_days(requested, F.col("l_partkey") % 15)
    net = _dec("l_extendedprice") * (1 - F.col("l_discount").cast("decimal(4,2)"))
    return t.filter("l_returnflag = 'R'").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("return_id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("order_item_id"),
        _line_product(),
        _cycle(REASONS, "l_partkey").alias("return_reason"),
        _cycle(RETURN_STATUSES, "l_suppkey").alias("return_status"),
        (F.col("l_quantity").cast("int") % 3 + 1).alias("return_qty"),
        F.round(net, 2).cast("decimal(18,2)").alias("refund_amount_inr"),
        requested.alias("return_requested_ts"),
        F.when(F.col("l_suppkey") % 4 != 0, completed).alias("return_completed_ts"),
    )


ROLES = {
    "customers": ("customer", customers),
    "sellers": ("supplier", sellers),
    "products": ("part", products),
    "orders": ("orders", orders),
    "order_items": ("lineitem", order_items),
    "payments": ("lineitem", payments),
    "shipments": ("lineitem", shipments),
    "returns": ("lineitem", returns),
}

# Columns that settle which copy of a repeated key is the latest.
LATEST = {
    "customers": (("signup_date",), ()),
    "sellers": (("onboarded_date",), ()),
    "products": ((), ("product_name",)),
    "orders": (("order_approved_ts",), ()),
    "order_items": (("updated_ts",), ("product_id", "seller_id")),
    "payments": (("updated_ts",), ("part_ref", "seller_ref")),
    "shipments": (("delivered_ts",), ("line_ref", "part_ref", "seller_ref")),
    "returns": (("return_requested_ts",), ()),
}


def raw_feed(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    table, role = ROLES[name]
    return role(spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet"))
