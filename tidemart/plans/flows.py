"""Whole stages: raw feeds to clean tables, clean tables to staging, staging to tested marts."""

from __future__ import annotations

from collections.abc import Callable, Collection, Mapping
from dataclasses import dataclass
from datetime import date
from functools import cache, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.contracts import CUSTOMER_SEGMENTS
from tidemart.operators.checks import (
    QUARANTINE, breaches, confirmed, find, flag_rows, results_of, run_rules, sendable, standard_suite,
)
from tidemart.operators.dedup import CARRIED
from tidemart.operators.incremental import (
    delete_insert,
    finish_upsert,
    lookback_start,
    months_since,
    upsert,
)
from tidemart.operators.scd2 import history_dimension, read_history, take_snapshot
from tidemart.plans import marts, model_tests, silver, staging, star
from tidemart.session import PACKED, Scratch, path_exists
from tidemart.sinks.tables import LOADED, SET_ASIDE, RowLog, counted, rows_seen, write_by_month, write_table
from tidemart.sources.calendar import spine_over
from tidemart.sources.feeds import parse_csv_feed, read_parquet_entity

Reader = Callable[[str], DataFrame]
MONTH = ("order_year", "order_month")
SELLER_CHECKS = ("seller_rating", "business_type", "seller_city", "seller_state")

# ------------------------------------------------------------------ quality gate


@dataclass
class GateResult:
    passed: bool
    results: DataFrame
    breaches: DataFrame
    quarantined: int


def quality_gate(
    spark: SparkSession,
    tables: Mapping[str, DataFrame],
    accepted: Mapping[str, tuple[str, ...]],
    out: str,
    fail_fast: bool = True,
) -> GateResult:
    """Check all feeds, write quarantined rows per table, and decide whether to go on.

    The results are written before they are looked at, so the feeds are scanned once for them.
    """
    tables = dict(tables)
    if not tables:
        raise ValueError("no feeds to check")
    rules = standard_suite(tables, dict(accepted))
    # counts per rule, and the keys that lack their parent: kept, so that each feed is counted once.
    # Long keys were compared as hashes; feeds are read again only where hashes repeat
    findings = kept_findings(find(tables, rules, hashed=True), out)
    write_table(results_of(confirmed(findings, tables, rules), tables, rules), out, "results")
    results = read_parquet_entity(spark, out, "results")
    over = breaches(results)
    with_findings = {
        r["table"]
        for r in results.filter(
            (F.col("severity") == QUARANTINE) & ~F.col("passed")
        ).select("table").distinct().collect()  # at most one row per feed
    }
    sent = sendable(findings)
    quarantined = 0
    for name in sorted(with_findings):
        found = quarantined_rows(tables, name, rules, findings, sent)
        bad, seen = counted(found, f"quarantine_{name}")
        write_table(bad, out, f"{name}_quarantine")
        quarantined += rows_seen(seen)
    passed = over.isEmpty() or not fail_fast
    return GateResult(passed, results, over, quarantined)


def kept_findings(findings: DataFrame, out: str) -> DataFrame:
    """Findings as a table below ``out``: feeds are counted once, whatever looks at them later."""
    write_table(findings, out, "findings")
    return findings.sparkSession.read.schema(findings.schema).parquet(f"{out}/findings")


def quarantined_rows(
    tables: dict[str, DataFrame], name: str, rules, findings: DataFrame | None = None, sent: Collection[int] = ()
) -> DataFrame:
    """Rows of a feed that break any quarantine rule, with the rules' names."""
    flagged = flag_rows(tables, name, rules, "quarantine_reasons", findings=findings, sent=sent)
    return flagged.filter(F.size("quarantine_reasons") > 0)


# --------------------------------------------------------------- raw to clean


def csv_reader(spark: SparkSession, raw_dir: str, out: str) -> Reader:
    """Reads CSV feeds of a folder, each parsed once into ``out/_parsed``.

    Rows that do not parse are written to ``out/_quarantine``.
    """

    @cache
    def read(name: str) -> DataFrame:
        path = f"{raw_dir.rstrip('/')}/{name}.csv"
        good, corrupt = parse_csv_feed(spark, path, name, f"{out}/_parsed/{name}")
        write_table(corrupt, f"{out}/_quarantine", f"{name}_corrupt")
        return good

    return read


def _store(
    spark: SparkSession,
    df: DataFrame,
    out: str,
    name: str,
    keys: tuple[str, ...],
    fresh: bool,
    gone: DataFrame | None = None,
    kept: bool = False,
) -> None:
    """Fact write: a fresh table, or an upsert of the months the batch touches.

    ``gone`` holds the keys the batch names beside its own, so a row that its batch no longer supports leaves.
    """
    if fresh:
        write_by_month(df, out, name)
    else:
        upsert(spark, f"{out}/{name}", df, keys, MONTH, new_columns=False, gone=gone, kept=kept)


#: a batch of at least this share of the stored orders is taken to touch most of them
LARGE_BATCH = 1 / 8


def _is_large(batch: DataFrame, stored: DataFrame) -> bool:
    """Of kept orders: file footers tell. Finding which stored ones such a batch touches would cost more
    than it spares; results are the same."""
    return batch.count() >= stored.count() * LARGE_BATCH


def _resequenced(spark: SparkSession, path: str, batch: DataFrame, large: bool = False) -> DataFrame:
    """Batch orders, and the earlier orders of the same customers whose position they shift.

    An order that moved to another customer also shifts the orders of the customer it left.
    Positions are worked out on the few columns they depend on; whole rows are fetched only
    for orders that have to be written. Beside a ``large`` batch the stored orders of all
    customers are looked at; those of untouched ones keep their positions.
    """
    stored = spark.read.parquet(path)
    place = ["order_id", "customer_id", "order_date", "order_purchase_ts"]
    earlier = stored.select(*place, F.col("customer_order_seq").alias("_was"))
    if not large:
        left = stored.select("order_id", "customer_id").join(batch.select("order_id"), "order_id", "left_semi")
        customers = batch.select("customer_id").unionByName(left.select("customer_id")).distinct()
        earlier = earlier.join(customers, "customer_id", "left_semi")
    merged = delete_insert(earlier, batch.select(*place), ["order_id"])
    placed = silver.with_order_sequence(merged).filter(
        ~F.col("_was").eqNullSafe(F.col("customer_order_seq"))
    )
    placed = placed.select("order_id", "customer_order_seq", "is_repeat_order")
    shifted = stored.drop("customer_order_seq", "is_repeat_order").join(
        batch.select("order_id"), "order_id", "left_anti"
    )
    return batch.unionByName(shifted.select(*batch.columns)).join(placed, "order_id")


#: the month of a row's order as YYYYMM: 0 where the order has none, null where it is not known.
#: One number, as it is shuffled with each row
ORDER = f"{CARRIED}order"


def _of_orders(child: DataFrame, parents: DataFrame, how: str = "inner") -> DataFrame:
    """Rows with the month of their order, carried beside their own columns."""
    year, month = (F.col(c) for c in MONTH)
    at = F.coalesce(year * 100 + month, F.lit(0)).cast("int")
    return child.join(parents.select("order_id", at.alias(ORDER)), "order_id", how)


def _by_order_month(df: DataFrame) -> DataFrame:
    at = F.nullif(F.col(ORDER), F.lit(0))
    year, month = F.floor(at / 100).cast("int"), (at % 100).cast("int")
    return df.withColumns(dict(zip(MONTH, (year, month)))).drop(ORDER)


def _with_waiting(
    spark: SparkSession, path: str, items: DataFrame, parents: DataFrame, feed: DataFrame, fresh: bool
) -> DataFrame:
    """Lines of this run, and earlier orphans its feed does not name, whose orders may have arrived since."""
    if fresh or not path_exists(spark, path):
        return items
    keys = ["order_id", "order_item_id"]
    waiting = spark.read.parquet(path)
    named = feed.select(*keys).join(waiting.select(*keys), keys, "left_semi")
    waiting = waiting.join(named, keys, "left_anti")
    return _of_orders(waiting, parents, "left").select(*items.columns).unionByName(items)


def _at_orders(feed: DataFrame) -> DataFrame:
    """A feed whose copies share their order, dealt by it: one shuffle, and one sort by the key that starts
    with the order, serve the copies and the meeting with the orders. Rows without an order belong to none."""
    return feed.filter(F.col("order_id").isNotNull()).repartition("order_id")


FACT_KEYS = {
    "order_items": ("order_id", "order_item_id"),
    "payments": ("order_id", "payment_sequential"),
    "shipments": ("order_id",),
    "returns": ("return_id",),
}


def bronze_to_silver(
    spark: SparkSession,
    raw: Reader,
    out: str,
    incremental: bool = False,
    latest: Mapping[str, tuple[tuple[str, ...], tuple[str, ...]]] | None = None,
) -> RowLog:
    """Clean all feeds into ``out``.

    An incremental run takes every row its reader gives: what is new is decided by what was
    landed (``landing.bronze_reader(after=...)``), not by event times, so late, unreadable and
    wrongly dated rows are neither lost nor able to hold back later ones. Batches are upserts
    by key; a key the batch names leaves the place its older copy had, also where the new copy
    is set aside or dropped.

    Orders are written first and read back as the parents of everything else, so lines of
    earlier orders stay valid in an incremental run. What is used more than once is kept in
    the shared scratch folder, so each feed is parsed and deduplicated once. A run that broke
    is simply repeated.
    """
    log = RowLog()
    with Scratch(spark, "bronze_to_silver", PACKED) as scratch:
        _clean_feeds(spark, scratch, raw, out, incremental, latest or {}, log)
    return log


def _clean_feeds(
    spark: SparkSession,
    scratch: Scratch,
    raw: Reader,
    out: str,
    incremental: bool,
    latest: Mapping[str, tuple[tuple[str, ...], tuple[str, ...]]],
    log: RowLog,
) -> None:
    aside = f"{out}/_quarantine"
    waiting, bad_path = f"{aside}/order_items_orphan", f"{aside}/shipments_bad_dates"
    for path in (f"{out}/orders", *(f"{out}/{n}" for n in FACT_KEYS), bad_path):
        finish_upsert(spark, path)

    def settle(name: str, transform, feed: DataFrame | None = None) -> DataFrame:
        order, tiebreak = latest.get(name, (None, None))
        extra = {} if order is None else {"latest": order, "tiebreak": tiebreak or None}
        return transform(raw(name) if feed is None else feed, **extra)

    def store(outcome: str, df: DataFrame, entity: str, write) -> None:
        df, seen = counted(df, entity)
        write(df)
        log.add(entity, outcome, rows_seen(seen))

    fresh = not incremental or not path_exists(spark, f"{out}/orders")
    orders = scratch.keep(settle("orders", silver.clean_orders), "orders")
    large = not fresh and _is_large(orders, spark.read.parquet(f"{out}/orders"))
    if fresh:
        orders = silver.with_order_sequence(orders)
    else:
        orders = _resequenced(spark, f"{out}/orders", orders, large)
    store(LOADED, orders, "orders",
          lambda df: _store(spark, df, out, "orders", ("order_id",), fresh))

    for name, transform in (
        ("customers", silver.clean_customers),
        ("sellers", silver.clean_sellers),
        ("products", silver.clean_products),
    ):
        write_table(settle(name, transform), out, name)

    products = spark.read.parquet(f"{out}/products")
    returns = settle("returns", silver.clean_returns)
    parents = spark.read.parquet(f"{out}/orders").select("order_id", *MONTH)
    if not fresh:
        returns = scratch.keep(returns, "returns")
        if not large:  # the stored orders that this run's rows belong to, looked up once
            ids = [raw("order_items"), raw("payments"), raw("shipments"), returns]
            if path_exists(spark, waiting):
                ids.append(spark.read.parquet(waiting))
            wanted = reduce(DataFrame.unionAll, [df.select("order_id") for df in ids]).distinct()
            parents = scratch.keep(parents.join(wanted, "order_id", "left_semi"), "parents")
    lines = settle("order_items", silver.usable_items, _at_orders(raw("order_items")))
    lines = _with_waiting(spark, waiting, _of_orders(lines, parents, "left"), parents, raw("order_items"), fresh)
    items = scratch.keep(silver.enrich_items(lines, products), "order_items")
    shipments = settle("shipments", silver.parse_shipments, _at_orders(raw("shipments")))
    shipments = scratch.keep(_of_orders(shipments, parents), "shipments")
    on_time, bad_dates = silver.split_shipments(shipments)
    payments = settle("payments", silver.clean_payments, _at_orders(raw("payments")))
    known = F.col(ORDER).isNotNull()
    facts = {
        "order_items": items.filter(known),
        "payments": _of_orders(payments, parents),
        "shipments": on_time,
        "returns": _of_orders(returns, parents),
    }
    # Keys this run names whose rows do not survive cleaning. Of a stored row the order is known for good, so a
    # named line, payment or shipment that finds no order has no older copy; payments lose no other rows.
    gone = {}
    if not fresh:
        dropped = raw("order_items").filter(silver.unusable_item()).select(*FACT_KEYS["order_items"])
        gone["order_items"] = scratch.keep(dropped.dropna().distinct(), "dropped_items")
        gone["shipments"] = shipments.select("order_id")
        gone["returns"] = returns.select("return_id").dropna()
        facts["returns"] = scratch.keep(facts["returns"], "returns_of_orders")
    for name, df in facts.items():
        df, new_table = _by_order_month(df), fresh or not path_exists(spark, f"{out}/{name}")
        if name != "payments" and not new_table:  # what was kept above is not stored again
            _store(spark, df, out, name, FACT_KEYS[name], False, gone[name], kept=True)
            log.add(name, LOADED, df.count())
            continue
        store(LOADED, df, name,
              lambda d, n=name, f=new_table: _store(spark, d, out, n, FACT_KEYS[n], f))

    store(SET_ASIDE, items.filter(~known).select(*[c for c in lines.columns if c != ORDER]), "order_items",
          lambda df: write_table(df, aside, "order_items_orphan"))
    store(SET_ASIDE, bad_dates.drop(ORDER), "shipments",
          lambda df: write_table(df, aside, "shipments_bad_dates") if fresh
          else upsert(spark, bad_path, df, ("order_id",), new_columns=False, gone=gone["shipments"], kept=True))


# ----------------------------------------------------------- clean to staging

FULL_LOAD = ("customers", "sellers", "products", "payments", "shipments", "returns")
WINDOW_LOAD = {"orders": ("order_id",), "order_items": ("order_id", "order_item_id")}


def load_staging(
    spark: SparkSession, silver_base: str, out: str, since: date | None = None
) -> None:
    """Copy clean entities to a staging area; with ``since``, large facts load that window only.

    For a staging area outside the lake (``write_jdbc``) or on another store; within the lake
    the models read the clean tables directly.
    """
    for name in FULL_LOAD:
        write_table(read_parquet_entity(spark, silver_base, name), out, name)
    for name, keys in WINDOW_LOAD.items():
        df = read_parquet_entity(spark, silver_base, name)
        if since is None or not path_exists(spark, f"{out}/{name}"):
            write_table(df, out, name, MONTH)
            continue
        df = df.filter(months_since(since))
        if name == "orders":
            df = df.filter(F.col("order_date") >= F.lit(since))
        else:  # lines carry no date of their own, only the month of their order
            orders = read_parquet_entity(spark, silver_base, "orders").filter(months_since(since))
            window = orders.filter(F.col("order_date") >= F.lit(since)).select("order_id")
            df = df.join(window, "order_id", "left_semi")
        upsert(spark, f"{out}/{name}", df, keys, MONTH, new_columns=False)


# ------------------------------------------------------------ staging to marts


def snapshot_sellers(spark: SparkSession, base: str, sellers: DataFrame, as_of: str) -> DataFrame:
    take_snapshot(spark, base, sellers, "seller_id", SELLER_CHECKS, as_of)
    return read_history(spark, base)


def seller_history(history: DataFrame) -> DataFrame:
    return history_dimension(
        history, "seller_id",
        ("seller_name", "seller_city", "seller_state", "seller_tier", "seller_rating",
         "business_type"),
    )


def by_month(df: DataFrame, key: str = "order_date_key") -> DataFrame:
    """Month columns to partition a fact by, from its date key."""
    return df.withColumn("order_year", F.floor(F.col(key) / 10000).cast("int")).withColumn(
        "order_month", F.floor(F.col(key) / 100).cast("int") % 100
    )


def refresh_order_items(
    spark: SparkSession,
    path: str,
    items: DataFrame | Callable[[DataFrame], DataFrame],
    orders: DataFrame,
    days: int = 3,
    as_of: date | None = None,
    products: DataFrame | None = None,
) -> None:
    """Incremental line fact: lines of recent orders replace their older copies.

    ``items`` and ``orders`` are the clean entities; where they are partitioned by the month
    of the order, only the recent months of both are read. Lines that have to be cleaned first
    come from a function of the recent orders, and meet ``products`` afterwards, so that older
    ones are neither cleaned nor shuffled.
    """
    finish_upsert(spark, path)
    start = lookback_start(spark.read.parquet(path), "order_date", days, as_of)
    recent = orders.filter(months_since(start)).filter(F.col("order_date") >= F.lit(start))
    with Scratch(spark, "refresh", PACKED) as scratch:
        if callable(items):
            recent = scratch.keep(recent, "recent")
            items = items(recent)
        elif set(MONTH) <= set(items.columns):
            items = items.filter(months_since(start))
        batch = star.fact_order_items(staging.stg_order_items(items), staging.stg_orders(recent))
        if products is not None:
            batch = star.with_attributes(batch, products)
        upsert(spark, path, by_month(batch), ("order_id", "order_item_id"), MONTH, new_columns=False)


def refresh_daily_sales(
    spark: SparkSession,
    path: str,
    fact_orders: DataFrame,
    dim_date: DataFrame,
    days: int = 3,
    as_of: date | None = None,
) -> None:
    """Incremental daily mart: the last days are computed again."""
    finish_upsert(spark, path)
    start = lookback_start(spark.read.parquet(path), "order_date_key", days, as_of)
    if set(MONTH) <= set(fact_orders.columns):
        fact_orders = fact_orders.filter(months_since(start))
    recent = fact_orders.filter(F.col("order_date_key") >= int(start.strftime("%Y%m%d")))
    upsert(spark, path, marts.daily_sales(recent, dim_date), ("order_date",), new_columns=False)


def build_models(
    spark: SparkSession, clean_base: str, out: str, as_of: str, incremental: bool = False
) -> dict[str, DataFrame]:
    """Write every model below ``out/<layer>`` and return them as read back.

    Facts are partitioned by month. An incremental build refreshes the line fact and the
    daily mart in place of rebuilding them.
    """
    models: dict[str, DataFrame] = {}
    lines_path, days_path = f"{out}/marts/fact_order_items", f"{out}/analytics/daily_sales"
    incremental = incremental and path_exists(spark, lines_path) and path_exists(spark, days_path)
    run_day = date.fromisoformat(as_of[:10])

    def keep(layer: str, name: str, df: DataFrame) -> DataFrame:
        write_table(df, f"{out}/{layer}", name)
        models[name] = read_parquet_entity(spark, f"{out}/{layer}", name)
        return models[name]

    def keep_fact(name: str, df: DataFrame, key: str = "order_date_key") -> DataFrame:
        models[name] = spark.read.parquet(write_by_month(by_month(df, key), f"{out}/marts", name))
        return models[name]

    clean = {n: read_parquet_entity(spark, clean_base, n) for n in (*FULL_LOAD, *WINDOW_LOAD)}
    views = {name: getattr(staging, f"stg_{name}")(df) for name, df in clean.items()}
    models.update({f"stg_{name}": df for name, df in views.items()})
    models["int_order_item_metrics"] = star.order_item_metrics(views["order_items"])
    models["int_order_payments"] = star.order_payments(views["payments"])
    orders = views["orders"]

    history = snapshot_sellers(spark, f"{out}/snapshots/sellers", views["sellers"], as_of)
    days = keep("marts", "dim_date", star.dim_date(spine_over(orders, "order_date")))
    customers = keep("marts", "dim_customer", star.dim_customer(views["customers"]))
    products = keep("marts", "dim_product", star.dim_product(views["products"]))
    sellers = keep("marts", "dim_seller", star.dim_seller(views["sellers"]))
    keep("marts", "dim_seller_history", seller_history(history))
    keep("marts", "dim_location", star.dim_location(views["customers"], views["sellers"]))

    facts = keep_fact("fact_orders", star.fact_orders(
        orders, views["order_items"], views["payments"], views["shipments"], views["customers"]))
    if incremental:
        refresh_order_items(spark, lines_path, clean["order_items"], clean["orders"], as_of=run_day)
        lines = models["fact_order_items"] = spark.read.parquet(lines_path)
    else:
        lines = keep_fact("fact_order_items", star.fact_order_items(views["order_items"], orders))
    keep_fact("fact_payments", star.fact_payments(views["payments"], orders))
    shipped = keep_fact("fact_shipments", star.fact_shipments(views["shipments"], orders))
    returned = keep_fact(
        "fact_returns", star.fact_returns(views["returns"], orders), "return_date_key"
    )

    if incremental:
        refresh_daily_sales(spark, days_path, facts, days, as_of=run_day)
        models["daily_sales"] = spark.read.parquet(days_path)
    else:
        keep("analytics", "daily_sales", marts.daily_sales(facts, days))
    keep("analytics", "seller_performance", marts.seller_performance(sellers, lines, returned))
    keep("analytics", "product_performance", marts.product_performance(products, lines, returned))
    keep("analytics", "customer_summary", marts.customer_summary(customers, facts))
    keep("analytics", "delivery_performance", marts.delivery_performance(shipped, customers))
    return models


def check_models(models: Mapping[str, DataFrame], segments=CUSTOMER_SEGMENTS) -> DataFrame:
    """Result of every declared test, including the two that list offending rows."""
    results = run_rules(dict(models), model_tests.all_tests(segments))
    listed = {
        ("order_value_reconciles", "fact_orders"): model_tests.unreconciled_orders(
            models["fact_orders"], models["fact_order_items"]
        ),
        ("no_future_order_dates", "stg_orders"): model_tests.future_orders(models["stg_orders"]),
    }
    out = results.select("table", "check", "n_violations", "passed")
    for (check, table), rows in listed.items():
        n = F.count("*")
        out = out.unionByName(
            rows.agg(n.alias("n_violations")).select(
                F.lit(table).alias("table"), F.lit(check).alias("check"), "n_violations",
                (F.col("n_violations") == 0).alias("passed"),
            )
        )
    return out


def run_all(
    spark: SparkSession,
    raw: Reader,
    base: str,
    as_of: str,
    latest=None,
    segments=CUSTOMER_SEGMENTS,
) -> tuple[dict[str, DataFrame], DataFrame, DataFrame]:
    """Feeds to tested marts in order: (models, test results, build checks)."""
    bronze_to_silver(spark, raw, f"{base}/silver", latest=latest)
    models = build_models(spark, f"{base}/silver", base, as_of)
    tests = check_models(models, segments)
    checks = model_tests.build_checks(models["fact_orders"], models["daily_sales"])
    return models, tests, checks
