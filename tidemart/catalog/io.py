"""Reads, writes and landing."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.catalog.registry import query
from tidemart.contracts import FEEDS
from tidemart.operators.split import split_quarantine
from tidemart.plans import silver, staging
from tidemart.session import scratch_dir
from tidemart.sinks import landing
from tidemart.sinks.tables import counted, write_by_month, write_table
from tidemart.sources.feeds import load_entity, parse_csv_feed, read_parquet_entity


def write_csv(df: DataFrame, path: str) -> None:
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss")
        .option("compression", "gzip")
        .csv(path)
    )


def feed_files(w, base: str, names=tuple(FEEDS)) -> str:
    """The feeds as CSV files with their declared columns."""
    for name in names:
        write_csv(w.raw(name).select(*FEEDS[name].struct.fieldNames()), f"{base}/{name}.csv")
    return base


@query("src01_csv_scan")
def _(w):
    base = feed_files(w, scratch_dir(w.spark, "csv"), ("customers",))
    return parse_csv_feed(w.spark, f"{base}/customers.csv", "customers", f"{base}/parsed")[0]


def broken_items(w, path: str) -> None:
    """Line feed with a broken number on every line numbered six."""
    lines = w.raw("order_items").select(*FEEDS["order_items"].struct.fieldNames())
    quantity = F.col("quantity").cast("string")
    broken = F.when(F.col("order_item_id") == 6, F.lit("many")).otherwise(quantity)
    write_csv(lines.withColumn("quantity", broken), path)


@query("src01_csv_corrupt_rows")
def _(w):
    """Parsed and set-aside rows of a feed."""
    base = scratch_dir(w.spark, "csv")
    broken_items(w, f"{base}/order_items.csv")
    sides = parse_csv_feed(w.spark, f"{base}/order_items.csv", "order_items", f"{base}/parsed")
    parts = [
        df.agg(F.count("*").alias("rows_n"), F.sum("quantity").alias("units")).select(
            F.lit(corrupt).alias("corrupt"), "rows_n", "units"
        )
        for corrupt, df in zip((False, True), sides)
    ]
    return reduce(DataFrame.unionByName, parts)


@query("src02_declared_schemas")
def _(w):
    """All eight feeds read back with their schemas: rows, and rows with a complete key."""
    base, parts = feed_files(w, scratch_dir(w.spark, "csv")), []
    for name, feed in FEEDS.items():
        df, _ = parse_csv_feed(w.spark, f"{base}/{name}.csv", name, f"{base}/parsed/{name}")
        complete = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in feed.primary_key])
        parts.append(
            df.agg(F.count("*").alias("rows_n"), F.count_if(complete).alias("keyed")).select(
                F.lit(name).alias("feed"), "rows_n", "keyed"
            )
        )
    return reduce(DataFrame.unionByName, parts)


@query("src03_parquet_scan")
def _(w):
    base = scratch_dir(w.spark, "entity")
    write_table(w.sellers, base, "sellers")
    return read_parquet_entity(w.spark, base, "sellers")


query("src05_entity_fallback")(lambda w: load_entity(w.spark, w.sf_dir, "customer"))


@query("snk01_write_and_append")
def _(w):
    base = scratch_dir(w.spark, "write")
    products = w.products
    for mode in ("overwrite", "overwrite", "append"):
        path = write_table(products, base, "products", mode=mode)
    back = w.spark.read.parquet(path)
    return back.groupBy("category").agg(F.count("*").alias("products_n"))


@query("snk02_partitioned_by_month")
def _(w):
    """One year written again touches its own partitions only."""
    base = scratch_dir(w.spark, "orders")
    orders = w.orders()
    write_by_month(orders, base, "orders")
    path = write_by_month(
        orders.filter("order_year = 1997").withColumn("payment_type", F.lit("rewritten")),
        base, "orders", only_present=True,
    )
    return w.spark.read.parquet(path).groupBy("order_year", "order_month", "payment_type").agg(
        F.count("*").alias("orders_n")
    )


@query("snk03_quarantine_write")
def _(w):
    base = scratch_dir(w.spark, "silver")
    clean, bad = split_quarantine(w.parsed_shipments, silver.timeline_faults())
    write_table(clean, base, "shipments")
    write_table(bad, f"{base}/_quarantine", "shipments_bad_dates")
    kept = read_parquet_entity(w.spark, base, "shipments").select(F.lit("kept").alias("reason"))
    aside = read_parquet_entity(w.spark, f"{base}/_quarantine", "shipments_bad_dates").select(
        F.explode("quarantine_reasons").alias("reason")
    )
    return kept.unionByName(aside).groupBy("reason").agg(F.count("*").alias("rows_n"))


@query("snk06_idempotent_landing")
def _(w):
    """A feed lands once; the same content is skipped. Other content lands, also where a value only
    moved to a column that was null, and so do other dates."""
    base, spark = scratch_dir(w.spark, "bronze"), w.spark
    orders = w.raw("orders").withColumn("spare", F.lit(None).cast("string"))
    moved = orders.withColumns({"spare": F.col("payment_type"), "payment_type": F.lit(None).cast("string")})
    attempts = (
        (orders, "2024-01-01"),
        (orders.repartition(3, "customer_id"), "2024-01-01"),
        (moved, "2024-01-01"),
        (orders.filter("payment_type is not null"), "2024-01-01"),
        (orders, "2024-01-02"),
    )
    seen = [landing.land(spark, df, "orders", day, base) for df, day in attempts]
    landed = sum(new for new, _ in seen)
    return landing.manifest(spark, base).groupBy("ingest_date").agg(
        F.count("*").alias("batches"), F.sum("rows").alias("rows_n")
    ).withColumn("landed_of_five", F.lit(landed).cast("bigint"))


@query("snk07_latest_batch")
def _(w):
    base, spark = scratch_dir(w.spark, "bronze"), w.spark
    orders = w.raw("orders")
    landing.land(spark, orders.filter("payment_type is not null"), "orders", "2024-01-01", base)
    landing.land(spark, orders, "orders", "2024-01-02", base)
    latest = landing.read_latest(spark, base, "orders")
    return latest.groupBy("payment_type").agg(F.count("*").alias("orders_n"))


@query("snk08_materialisations")
def _(w):
    """A view, an inlined frame and a written table in one query."""
    base, spark = scratch_dir(w.spark, "tables"), w.spark
    staging.stg_orders(w.orders()).createOrReplaceTempView("tidemart_stg_orders")
    spent = w.payments.groupBy("order_id").agg(F.sum("payment_value_inr").alias("paid"))
    customers = spark.read.parquet(write_table(w.dim_customer, base, "dim_customer"))
    return (
        spark.table("tidemart_stg_orders").join(spent, "order_id").join(customers, "customer_id")
        .groupBy("state").agg(F.sum("paid").alias("paid"))
    )


@query("snk11_stage_metrics")
def _(w):
    """Counts taken by the writes themselves."""
    base, parts = scratch_dir(w.spark, "metrics"), []
    for name, df in (("orders", w.orders()), ("payments", w.payments), ("returns", w.returns)):
        watched, seen = counted(df, name)
        write_table(watched, base, name)
        stored = w.spark.read.parquet(f"{base}/{name}").agg(F.count("*").alias("stored"))
        parts.append(
            stored.select(
                F.lit(name).alias("entity"), F.lit(seen.get["rows"]).cast("bigint").alias("observed"),
                "stored",
            )
        )
    return reduce(DataFrame.unionByName, parts)
