"""Quality rules, gate and model tests."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.catalog.registry import query
from tidemart.contracts import CATEGORIES, FEEDS, ORDER_STATUSES, PAYMENT_STATUSES
from tidemart.operators import checks as c
from tidemart.plans import flows, model_tests, star
from tidemart.session import scratch_dir
from tidemart.sinks.tables import write_table
from tidemart.sources.feeds import missing_columns

SEGMENTS = ("BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
ACCEPTED = {
    "category": CATEGORIES, "order_status": ORDER_STATUSES, "payment_status": PAYMENT_STATUSES,
}
SHORT = ("table", "check", "severity", "n_violations", "n_total")


def feeds(w) -> dict[str, DataFrame]:
    return {name: w.raw(name) for name in FEEDS}


def narrow_parents(w) -> dict[str, DataFrame]:
    """Feeds whose parents are a batch: orders since 1997 and sellers of the first tiers."""
    tables = feeds(w)
    tables["orders"] = tables["orders"].filter("order_purchase_ts >= '1997-01-01'")
    tables["sellers"] = tables["sellers"].filter("seller_tier < 3")
    return tables


def only(w, *make, tables=None):
    tables = tables or feeds(w)
    return c.run_rules(tables, [m(tables) for m in make]).select(*SHORT)


query("dq01_primary_key_unique")(
    lambda w: only(
        w,
        lambda t: c.primary_key_unique(t["order_items"], "order_items", ["order_id", "order_item_id"]),
        lambda t: c.primary_key_unique(t["orders"], "orders", ["order_id"]),
    )
)
query("dq02_critical_not_null")(
    lambda w: only(
        w,
        lambda t: c.not_null(t["order_items"], "order_items", ["order_id", "product_id", "absent"]),
        lambda t: c.not_null(t["orders"], "orders", ["order_id", "order_approved_ts"]),
    )
)
query("dq03_referential_integrity")(
    lambda w: only(
        w,
        lambda t: c.referential_integrity(t["order_items"], "order_items", "order_id", "orders", "order_id"),
        lambda t: c.referential_integrity(t["order_items"], "order_items", "product_id", "products", "product_id"),
        lambda t: c.referential_integrity(t["order_items"], "order_items", "seller_id", "sellers", "seller_id"),
        tables=narrow_parents(w),
    )
)
query("dq04_non_negative")(
    lambda w: only(
        w,
        lambda t: c.non_negative(t["products"], "products", "mrp_inr", allow_zero=False),
        lambda t: c.non_negative(t["order_items"], "order_items", "quantity", allow_zero=False),
        lambda t: c.non_negative(t["order_items"], "order_items", "unit_price_inr"),
    )
)
query("dq05_valid_values")(
    lambda w: only(
        w,
        lambda t: c.valid_values(t["products"], "products", "category", CATEGORIES),
        lambda t: c.valid_values(t["orders"], "orders", "order_status", ORDER_STATUSES),
        lambda t: c.valid_values(t["payments"], "payments", "payment_status", PAYMENT_STATUSES),
    )
)
query("dq06_date_order")(
    lambda w: only(w, lambda t: c.date_order(t["shipments"], "shipments", "ship_ts", "delivered_ts"))
)
query("dq07_future_dates")(
    lambda w: only(
        w,
        lambda t: c.future_dates(t["shipments"], "shipments", "delivered_ts"),
        lambda t: c.future_dates(t["returns"], "returns", "return_requested_ts", "2001-06-01"),
    )
)
query("dq08_delivery_duration")(
    lambda w: only(
        w, lambda t: c.delivery_duration(t["shipments"], "shipments", max_days=5)
    )
)


def suite(w):
    tables = feeds(w)
    return c.run_rules(tables, c.standard_suite(tables, ACCEPTED))


query("dq09_violation_rate")(
    lambda w: c.run_rules(
        feeds(w),
        [c.not_null(w.raw("orders"), "orders", ["order_approved_ts"]),
         c.not_null(w.raw("orders"), "orders", ["order_id"])],
    ).select("detail", "violation_rate", "passed")
)
query("dq10_standard_suite")(lambda w: suite(w).select(*SHORT, "detail", "violation_rate", "passed"))
query("dq12_threshold_breaches")(
    lambda w: c.breaches(suite(w)).select("table", "check", "severity", "violation_rate")
)


@query("dq13_quality_gate")
def _(w):
    gate = flows.quality_gate(w.spark, feeds(w), ACCEPTED, scratch_dir(w.spark, "gate"))
    return c.severity_report(gate.results).withColumns(
        {
            "gate_passed": F.lit(gate.passed),
            "quarantined_rows": F.lit(gate.quarantined).cast("bigint"),
        }
    )


@query("p02_gate_results_and_breaches")
def _(w):
    """What a lenient run leaves behind: all results, marked where they are over the limit."""
    gate = flows.quality_gate(w.spark, feeds(w), ACCEPTED, scratch_dir(w.spark, "gate"), False)
    over = gate.breaches.select("table", "check", "detail", F.lit(True).alias("_over"))
    return gate.results.join(over, ["table", "check", "detail"], "left").select(
        *SHORT, "detail", F.coalesce("_over", F.lit(False)).alias("over_limit"),
        F.lit(gate.passed).alias("goes_on"),
    )


@query("dq14_required_columns")
def _(w):
    """Each feed with one required column taken away: what the presence check reports."""
    parts = []
    for name, df in feeds(w).items():
        victim = FEEDS[name].required[-1]
        missing = ",".join(missing_columns(df.drop(victim), name))
        whole = ",".join(missing_columns(df, name))
        parts.append(
            df.agg(F.count("*").alias("rejected_rows")).select(
                F.lit(name).alias("feed"), F.lit(missing).alias("missing"),
                F.lit(whole).alias("missing_in_whole"), "rejected_rows",
            )
        )
    return reduce(DataFrame.unionByName, parts)


def tested(w, kinds: tuple[str, ...], table: str | None = None):
    """Model tests of some kinds on the staging models and rollups."""
    models = {
        "stg_customers": w.stg_customers, "stg_sellers": w.stg_sellers,
        "stg_products": w.stg_products, "stg_orders": w.stg_orders(),
        "stg_order_items": w.stg_order_items(False), "stg_payments": w.stg_payments,
        "stg_shipments": w.stg_shipments, "stg_returns": w.stg_returns,
        "int_order_payments": star.order_payments(w.stg_payments),
        "int_order_item_metrics": star.order_item_metrics(w.stg_order_items(False)),
    }
    rules = model_tests.staging_tests(SEGMENTS) + model_tests.intermediate_tests()
    mine = [r for r in rules if r.check.startswith(kinds)]
    return c.run_rules(models, mine).select("table", "check", "n_violations", "passed")


query("dq15_model_not_null")(lambda w: tested(w, ("not_null",)))
query("dq16_model_unique")(
    lambda w: tested(w, ("unique_order_id", "unique_customer_id", "unique_seller_id",
                         "unique_product_id", "unique_return_id"))
)


@query("dq16_unique_counts_keys")
def _(w):
    """On the raw lines, where keys do repeat: number of repeated keys."""
    rules = [
        c.model_test("order_items", "unique", "order_id"),
        c.model_test("order_items", "unique", "product_id"),
    ]
    return c.run_rules(feeds(w), rules).select("check", "n_violations", "passed")


@query("dq17_model_unique_combination")
def _(w):
    rules = [
        c.model_test("order_items", "unique_combination", ("order_id", "order_item_id")),
        c.model_test("payments", "unique_combination", ("order_id", "payment_sequential")),
    ]
    tables = feeds(w) | {"payments": w.stg_payments}
    return c.run_rules(tables, rules).select("table", "n_violations", "passed")


query("dq18_model_accepted_values")(lambda w: tested(w, ("accepted_values",)))


@query("dq19_model_accepted_range")
def _(w):
    models = {
        "raw_order_items": w.raw("order_items"), "stg_order_items": w.stg_order_items(False),
        "seller_performance": w.seller_performance,
    }
    rules = [
        c.model_test("raw_order_items", "accepted_range", "quantity", min=1, max=40),
        c.model_test("stg_order_items", "accepted_range", "quantity", min=1),
        c.model_test("seller_performance", "accepted_range", "return_rate", min=0, max=1),
    ]
    return c.run_rules(models, rules).select("table", "n_violations", "passed")


query("dq20_model_relationships")(lambda w: tested(w, ("relationships",)))
query("dq21_unreconciled_orders")(
    # gross value against line totals, so that freight shows up as a difference
    lambda w: model_tests.unreconciled_orders(
        w.fact_orders().withColumn("order_value_inr", F.col("gmv_inr")), w.fact_order_items(False)
    )
)
query("dq22_future_orders")(lambda w: model_tests.future_orders(w.stg_orders(), "2001-06-30"))
query("dq23_build_checks")(lambda w: model_tests.build_checks(w.fact_orders(), w.daily_sales))


@query("snk04_gate_quarantine")
def _(w):
    """Rows per broken rule, written per feed and read back."""
    tables, base, parts = narrow_parents(w), scratch_dir(w.spark, "quarantine"), []
    rules = [r for r in c.standard_suite(tables, ACCEPTED) if r.severity == c.QUARANTINE]
    findings = flows.kept_findings(c.find(tables, rules), f"{base}/gate")
    sent = c.sendable(findings)
    for name in tables:
        rows = flows.quarantined_rows(tables, name, rules, findings, sent)
        back = w.spark.read.parquet(write_table(rows, base, name))
        parts.append(
            back.select(F.lit(name).alias("table"), F.explode("quarantine_reasons").alias("reason"))
        )
    return reduce(DataFrame.unionByName, parts).groupBy("table", "reason").agg(
        F.count("*").alias("rows_n")
    )
