"""Scalar functions over the given tables."""

from pyspark.sql import functions as F

from tidemart.catalog.registry import query
from tidemart.functions import dates, keys, text
from tidemart.sources.calendar import spine_over


@query("f01_f02_f03_f18_strings")
def _(w):
    raw = F.col("category")
    return w.raw("products").select(
        "product_id",
        F.lower(raw).alias("lowered"),
        F.trim(raw).alias("trimmed"),
        text.title(raw).alias("titled"),
        F.regexp_replace(F.lower(raw), r"\s+and\s+", " & ").alias("joined"),
        F.nullif(F.trim("product_name"), F.lit("")).alias("named"),
        F.coalesce(F.col("product_id").cast("string"), F.lit("none")).alias("id_text"),
    )


query("f04_flags")(
    lambda w: w.orders().select(
        "order_id",
        (F.col("payment_type") == "COD").cast("int").alias("is_cod"),
        (F.col("order_status") == "returned").cast("int").alias("is_returned"),
    )
)


@query("f05_f09_f10_f11_f19_dates")
def _(w):
    purchased, approved = F.col("order_purchase_ts"), F.col("order_approved_ts")
    day = F.to_date(purchased)
    return w.orders().select(
        "order_id",
        day.alias("day"),
        F.year(purchased).alias("year"),
        F.month(purchased).alias("month"),
        dates.days_between(purchased, approved).alias("days_to_approval"),
        dates.month_start(purchased).alias("month_start"),
        F.last_day(day).alias("month_end"),
        dates.fiscal_year(day).alias("fiscal_year"),
        dates.month_gap(F.lit("1995-01-01").cast("date"), dates.month_start(purchased)).alias(
            "months_since_1995"
        ),
    )


query("f06_date_key")(
    lambda w: w.orders().select("order_id", dates.date_key(F.col("order_date")).alias("date_key"))
)
query("f07_f08_calendar_parts")(
    lambda w: w.dim_date.select(
        "date_key", "quarter", "day_of_week", "week_of_year", "month_name", "day_name"
    )
)


@query("f12_rounding")
def _(w):
    price = F.col("unit_price_inr")
    return w.raw("order_items").select(
        "order_id", "order_item_id", "product_id", "seller_id",
        F.round(price, 0).alias("whole"),
        F.round(F.col("discount_inr"), 2).alias("cents"),
        F.abs(F.col("quantity") - 25).alias("distance"),
        F.least(price, F.lit(50000).cast("decimal(18,2)")).alias("capped"),
    )


query("f13_surrogate_key")(
    lambda w: w.raw("customers").select(
        "customer_id", keys.surrogate_key(F.col("city"), F.col("state")).alias("key")
    )
)


@query("f14_interval_before_newest")
def _(w):
    newest = F.max("order_date")
    return w.orders().agg(
        F.date_sub(F.coalesce(newest, F.lit("1900-01-01").cast("date")), 3).alias("window_start"),
        F.date_sub(dates.key_to_date(F.max(dates.date_key(F.col("order_date")))), 3).alias("by_key"),
    )


query("f15_compare_with_today")(
    lambda w: w.orders().agg(
        F.count_if(F.col("order_date") > F.lit("2001-01-01").cast("date")).alias("after_day"),
        F.count_if(F.col("order_date") > F.current_date()).alias("after_today"),
    )
)


@query("f16_numeric_coercion")
def _(w):
    """Numbers written as text, some broken, read back; what does not parse is null."""
    written = F.concat(F.when(F.col("l_linenumber") == 5, "~").otherwise(""), F.col("l_quantity").cast("int"))
    value = written.try_cast("double")
    return w.table("lineitem").groupBy("l_linenumber").agg(
        F.count("*").alias("rows_n"), F.count(value).alias("numbers"), F.sum(value).alias("total")
    )


query("f17_case_blind_membership")(
    lambda w: w.raw("orders").agg(
        F.count_if(text.normal_key(F.col("order_status")).isin("delivered", "shipped")).alias("known"),
        F.count_if(~text.normal_key(F.col("order_status")).isin("delivered", "shipped")).alias("other"),
    )
)


@query("f20_content_digest")
def _(w):
    """The digest depends on neither row order, partitioning nor column order, but on the column
    that a value stands in, beside a null too, and on column names."""
    t = w.table("orders").withColumn("spare", F.lit(None).cast("string"))
    moved = t.withColumn("spare", F.col("o_orderstatus")).withColumn("o_orderstatus", F.lit(None).cast("string"))
    forms = {
        "same": t.repartition(7, "o_custkey").select(*reversed(t.columns)),
        "moved": moved,
        "renamed": t.withColumnRenamed("spare", "other"),
    }
    out = keys.batch_digest(t).select(F.col("rows").alias("rows_n"), "digest", F.length("digest").alias("length"))
    for name, df in forms.items():
        other = keys.batch_digest(df).select(F.col("rows").alias("rows_n"), F.col("digest").alias("_other"))
        out = out.join(other, "rows_n").withColumn(name, F.col("digest") == F.col("_other")).drop("_other")
    return out.drop("digest")


@query("f20_content_tree_digest")
def _(w):
    """As above by the tree that landing uses, and beside one row less and one row twice."""
    t = w.table("orders").withColumn("spare", F.lit(None).cast("string"))
    one = t.where(F.col("o_orderkey") == t.agg(F.min("o_orderkey")).scalar())
    forms = {
        "same": t.repartition(7, "o_custkey").select(*reversed(t.columns)),
        "moved": t.withColumn("spare", F.col("o_orderstatus")).withColumn("o_orderstatus", F.lit(None).cast("string")),
        "renamed": t.withColumnRenamed("spare", "other"),
        "twice": t.unionAll(one),
    }
    rows, digest = keys.tree_digest(t)
    return w.spark.range(1).select(
        F.lit(rows).cast("long").alias("rows_n"), F.lit(len(digest)).alias("length"),
        *[F.lit(keys.tree_digest(df)[1] == digest).alias(name) for name, df in forms.items()])


query("src06_date_spine")(
    lambda w: spine_over(w.table("lineitem").select(F.to_date("l_shipdate").alias("d")), "d")
)
