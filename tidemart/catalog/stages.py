"""Incremental operators and whole stages."""

from datetime import date
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.catalog.io import broken_items, feed_files
from tidemart.catalog.quality import SEGMENTS
from tidemart.catalog.registry import query
from tidemart.operators import incremental as inc
from tidemart.plans import flows, silver
from tidemart.plans.flows import MONTH
from tidemart.session import path_exists, remove_path, scratch_dir
from tidemart.sinks import landing
from tidemart.sinks.tables import LOADED, write_by_month, write_table
from tidemart.sources.crosswalk import LATEST

CUT = "2000-07-01 00:00:00"


@query("s01_watermark")
def _(w):
    """Marks recorded out of order: the highest stays."""
    path = f"{scratch_dir(w.spark, 'state')}/marks"
    orders = w.orders()
    newest = orders.agg(F.max("order_purchase_ts"), F.min("order_purchase_ts")).first()
    for mark in newest:
        inc.write_watermark(w.spark, path, "orders", mark)
    mark = inc.read_watermark(w.spark, path, "orders")
    return orders.filter(F.col("order_purchase_ts") >= F.lit(str(mark)).cast("timestamp_ntz")).select(
        "order_id", F.lit(str(mark)).cast("timestamp_ntz").alias("mark")
    )


query("s02_after_watermark")(
    lambda w: inc.since_watermark(w.orders(), "order_purchase_ts", CUT).select("order_id")
)
query("s02_after_watermark_with_lookback")(
    lambda w: inc.since_watermark(w.orders(), "order_purchase_ts", CUT, 3).select("order_id")
)


def delivered(w, late: bool):
    """Feeds of two deliveries: the first holds orders before the cut but for every 50th, which
    arrive late; the second those, three days again and all later ones. Other feeds as they are."""
    at, odd = F.col("order_purchase_ts"), F.col("order_id") % 50 == 0
    first = (at < CUT) & ~odd
    second = odd | (at >= F.lit(CUT).cast("timestamp_ntz") - F.expr("interval 3 days"))

    def read(name: str) -> DataFrame:
        df = w.raw(name)
        return df.filter(second if late else first) if name == "orders" else df

    return read


def silver_in_two_runs(w, base: str) -> None:
    flows.bronze_to_silver(w.spark, delivered(w, late=False), base, latest=LATEST)
    flows.bronze_to_silver(w.spark, delivered(w, late=True), base, incremental=True, latest=LATEST)


@query("s03_watermark_advances")
def _(w):
    """Two runs: each takes what is newer than the last mark, then moves the mark to its maximum."""
    path = f"{scratch_dir(w.spark, 'state')}/marks"
    runs = []
    for feed in (w.orders().filter(F.col("order_purchase_ts") < CUT), w.orders()):
        mark = inc.read_watermark(w.spark, path, "orders")
        taken = inc.since_watermark(feed, "order_purchase_ts", mark)
        rows, newest = taken.agg(F.count("*"), F.max("order_purchase_ts")).first()
        inc.write_watermark(w.spark, path, "orders", newest)
        runs.append(F.struct(F.lit(rows).cast("bigint").alias("taken"), F.lit(str(newest)).cast("timestamp_ntz").alias("mark")))
    return w.spark.range(1).select(F.inline(F.array(*runs)))


@query("s04_write_modes")
def _(w):
    """Facts upserted and dimensions overwritten twice: nothing doubles."""
    base = scratch_dir(w.spark, "modes")
    orders, customers = w.orders(), w.customers
    for _ in range(2):
        inc.upsert(w.spark, f"{base}/orders", orders, ["order_id"], MONTH)
        write_table(customers, base, "customers")
    sizes = [
        w.spark.read.parquet(f"{base}/{n}").agg(F.count("*").alias("rows_n")).select(
            F.lit(n).alias("entity"), "rows_n"
        )
        for n in ("orders", "customers")
    ]
    return reduce(DataFrame.unionByName, sizes)


def upserted(w, times: int) -> DataFrame:
    """Orders to the middle of 1999, then a batch from 1999 on: some known, some moved, all
    marked in a new column."""
    path = f"{scratch_dir(w.spark, 'upsert')}/orders"
    orders = w.orders().select("order_id", "order_status", "order_date", *MONTH)
    inc.upsert(w.spark, path, orders.filter("order_date < '1999-07-01'"), ["order_id"], MONTH)
    batch = orders.filter("order_date >= '1999-01-01'")
    moved = F.when(F.col("order_status") == "returned", 2002).otherwise(F.col("order_year"))
    batch = batch.withColumns({"order_year": moved, "batch": F.lit("second")})
    for _ in range(times):
        try:
            inc.upsert(w.spark, path, batch, ["order_id"], MONTH)
        except OSError:  # a run that broke is repeated
            inc.upsert(w.spark, path, batch, ["order_id"], MONTH)
    return w.spark.read.option("mergeSchema", True).parquet(path).select(
        "order_id", "order_status", "order_year", "order_month", "batch"
    )


query("s05_upsert")(lambda w: upserted(w, 1))


@query("s05_upsert_after_broken_swap")
def _(w):
    """The swap of the second batch breaks after old partitions are gone; the upsert is repeated."""
    swap, broken = inc._swap, []

    def breaks(spark, path, stage):
        if path_exists(spark, path) and not broken:
            broken.append(path)
            remove_path(spark, f"{path}/order_year=1999")
            raise OSError("lost while swapping")
        swap(spark, path, stage)

    inc._swap = breaks
    try:
        return upserted(w, 2)
    finally:
        inc._swap = swap


@query("s05_upsert_bucketed")
def _(w):
    """The same batches into a table bucketed by its key, with a break in the second swap and a rebucketing."""
    path = scratch_dir(w.spark, "bucketed")
    orders = w.orders().select("order_id", "order_status", "order_date", "order_year", "order_month")
    inc.upsert_bucketed(w.spark, path, orders.filter("order_date < '1999-07-01'"), ["order_id"], 8)
    moved = F.when(F.col("order_status") == "returned", 2002).otherwise(F.col("order_year"))
    batch = orders.filter("order_date >= '1999-01-01'").withColumns({"order_year": moved, "batch": F.lit("second")})
    move, moves = inc.move_folder, []

    def breaks(spark, source, target):
        moves.append(target)
        if len(moves) == 3:
            raise OSError("lost while swapping")
        move(spark, source, target)

    inc.move_folder = breaks
    try:
        inc.upsert_bucketed(w.spark, path, batch, ["order_id"])
    except OSError:
        inc.upsert_bucketed(w.spark, path, batch.limit(0), ["order_id"])  # finishes what broke
    finally:
        inc.move_folder = move
    inc.rebucket(w.spark, path, 16)
    return inc.read_bucketed(w.spark, path).select("order_id", "order_status", "order_year", "order_month", "batch")


query("s09_upsert_twice")(lambda w: upserted(w, 2))


@query("s06_lookback_days")
def _(w):
    orders = w.orders().select("order_id", "order_date")
    return inc.lookback(orders, orders.filter("order_date <= '2000-03-01'"), "order_date", 3)


@query("s07_lookback_key")
def _(w):
    facts = w.fact_orders(items=False).select("order_id", "order_date_key")
    return inc.lookback_key(facts, facts.filter("order_date_key <= 20000301"), "order_date_key", 3)


@query("s08_window_load")
def _(w):
    base = scratch_dir(w.spark, "window")
    write_silver(w, f"{base}/silver")
    flows.load_staging(w.spark, f"{base}/silver", f"{base}/staging")
    flows.load_staging(w.spark, f"{base}/silver", f"{base}/staging", since=date(2001, 1, 1))
    return row_counts(w.spark, f"{base}/staging", (*flows.FULL_LOAD, *flows.WINDOW_LOAD))


@query("s08_window_load_effect")
def _(w):
    """Clean orders change everywhere; a window load brings only the window's changes."""
    base = scratch_dir(w.spark, "window")
    write_silver(w, f"{base}/silver")
    flows.load_staging(w.spark, f"{base}/silver", f"{base}/staging")
    loaded = w.spark.read.parquet(f"{base}/staging/orders")  # the clean orders, by month as they were
    write_table(loaded.withColumn("payment_type", F.lit("changed")), f"{base}/silver", "orders", MONTH)
    flows.load_staging(w.spark, f"{base}/silver", f"{base}/staging", since=date(2001, 1, 10))
    orders = w.spark.read.parquet(f"{base}/staging/orders")
    return orders.groupBy(
        (F.col("order_date") >= "2001-01-10").alias("in_window"),
        F.col("payment_type").eqNullSafe("changed").alias("changed"),
    ).agg(F.count("*").alias("orders_n"))


def write_silver(w, base: str) -> None:
    """Clean entities. Orders come first and are read back as the parents of the lines, which meet them in the
    shuffle that drops copies, and their products after that."""
    orders = w.spark.read.parquet(write_by_month(w.orders(), base, "orders"))
    lines = w.order_items(enriched=False).join(orders.select("order_id", *MONTH), "order_id")
    write_by_month(silver.enrich_items(lines, w.products), base, "order_items")
    for name in flows.FULL_LOAD:
        write_table(getattr(w, name), base, name)


def row_counts(spark, base: str, names) -> DataFrame:
    parts = [
        spark.read.parquet(f"{base}/{n}").agg(F.count("*").alias("rows_n")).select(
            F.lit(n).alias("entity"), "rows_n"
        )
        for n in names
    ]
    return reduce(DataFrame.unionByName, parts)


@query("p01_landing")
def _(w):
    """All feeds landed twice on one day: one batch each."""
    base = scratch_dir(w.spark, "landing")
    raw = feed_files(w, f"{base}/raw")
    landing.land_all(w.spark, raw, "2024-01-01", f"{base}/bronze")
    again = landing.land_all(w.spark, raw, "2024-01-01", f"{base}/bronze")
    landed = landing.manifest(w.spark, f"{base}/bronze")
    return landed.groupBy("source").agg(
        F.count("*").alias("batches"), F.sum("rows").alias("rows_n")
    ).withColumn("loaded_again", F.lit(again.total(LOADED)).cast("bigint"))


@query("p01_landed_feed_in_declared_types")
def _(w):
    """From CSV files over landing to typed lines."""
    base = scratch_dir(w.spark, "landing")
    raw = feed_files(w, f"{base}/raw", ("order_items", "returns"))
    landing.land_all(w.spark, raw, "2024-01-01", f"{base}/bronze")
    lines = landing.bronze_reader(w.spark, f"{base}/bronze")("order_items")
    return lines.groupBy("order_item_id").agg(
        F.count("*").alias("lines"), F.sum("quantity").alias("units"),
        F.count("product_id").alias("with_product"),
    )


@query("src01_csv_feeds_to_clean_orders")
def _(w):
    """From CSV files with broken lines to clean orders, and the broken lines set aside."""
    base = scratch_dir(w.spark, "csv")
    raw = feed_files(w, f"{base}/raw", ("orders",))
    broken_items(w, f"{base}/raw/order_items.csv")
    read = flows.csv_reader(w.spark, raw, base)
    orders, items = silver.clean_orders(read("orders")), read("order_items")
    corrupt = w.spark.read.parquet(f"{base}/_quarantine/order_items_corrupt")
    counts = {
        "orders": orders.filter("order_date is not null"), "order_items": items, "corrupt": corrupt,
    }
    parts = [
        df.agg(F.count("*").alias("rows_n")).select(F.lit(name).alias("part"), "rows_n")
        for name, df in counts.items()
    ]
    return reduce(DataFrame.unionByName, parts)


@query("p03_raw_to_clean_in_two_runs")
def _(w):
    """An initial and an incremental run end with the same orders as one full run."""
    base = scratch_dir(w.spark, "silver")
    silver_in_two_runs(w, base)
    return w.spark.read.parquet(f"{base}/orders").select(
        "order_id", "customer_id", "order_status", "customer_order_seq", "is_repeat_order",
        *MONTH,
    )


@query("p03_raw_to_clean_row_counts")
def _(w):
    base = scratch_dir(w.spark, "silver")
    silver_in_two_runs(w, base)
    facts = ("orders", "order_items", "payments", "shipments", "returns")
    kept = row_counts(w.spark, base, (*facts, "customers", "sellers", "products"))
    return kept.unionByName(
        row_counts(w.spark, f"{base}/_quarantine", ("order_items_orphan", "shipments_bad_dates"))
    )


@query("p04_clean_to_staging")
def _(w):
    base = scratch_dir(w.spark, "staging")
    flows.bronze_to_silver(w.spark, w.raw, f"{base}/silver", latest=LATEST)
    flows.load_staging(w.spark, f"{base}/silver", f"{base}/staging")
    lines = w.spark.read.parquet(f"{base}/staging/order_items")
    return lines.groupBy("order_year", "category").agg(
        F.count("*").alias("lines"), F.sum("line_total_inr").alias("total")
    )


@query("p05_build_and_test")
def _(w):
    """Feeds to tested marts; every declared test and build check with its findings."""
    base = scratch_dir(w.spark, "all")
    _, tests, checks = flows.run_all(w.spark, w.raw, base, "2002-01-01 00:00:00", LATEST, SEGMENTS)
    return tests.unionByName(
        checks.select(
            F.lit("build").alias("table"), "check", F.col("n").alias("n_violations"), "passed"
        )
    )
