"""All layers over one set of raw feeds, derived lazily.

Each property is a plain, lazy DataFrame (only the plan is kept, never the rows), so a query
pulls in only the feeds, columns and joins it uses. ``orders(...)``/``fact_orders(...)`` take the optional parts as arguments because
an unused join on a non-unique side cannot be pruned by the optimizer.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import cache, cached_property

from pyspark.sql import DataFrame, SparkSession

from tidemart.operators.keysets import of_keys
from tidemart.plans import marts, silver, staging, star
from tidemart.sources.calendar import spine_over
from tidemart.sources.crosswalk import LATEST, raw_feed

Reader = Callable[[str], DataFrame]


class Warehouse:
    def __init__(
        self,
        raw: Reader,
        latest: Mapping[str, tuple[tuple[str, ...], tuple[str, ...]]] | None = None,
    ):
        """``raw`` reads a feed by name; ``latest`` gives (order, tiebreak) columns per feed."""
        self.raw = cache(raw)
        self.orders = cache(self.orders)
        self.order_items = cache(self.order_items)
        self._latest = latest or {}
        self.spark: SparkSession | None = None
        self.sf_dir = ""

    @classmethod
    def over_tables(cls, spark: SparkSession, sf_dir: str) -> Warehouse:
        warehouse = cls(lambda name: raw_feed(spark, sf_dir, name), LATEST)
        warehouse.spark, warehouse.sf_dir = spark, sf_dir.rstrip("/")
        return warehouse

    def table(self, name: str) -> DataFrame:
        """A given table as it is."""
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def _clean(self, name: str, transform, feed: DataFrame | None = None) -> DataFrame:
        feed = self.raw(name) if feed is None else feed
        if name not in self._latest:
            return transform(feed)
        latest, tiebreak = self._latest[name]
        return transform(feed, latest, tiebreak or None)

    def _by_order(self, name: str, transform, feed: DataFrame | None = None) -> DataFrame:
        """A feed whose copies share their order, cleaned where its order's rows are: the one shuffle
        serves the copies, sums per order and joins with the order."""
        feed = self.raw(name) if feed is None else feed
        return self._clean(name, transform, feed.repartition("order_id"))

    # ------------------------------------------------------------------ clean

    @cached_property
    def customers(self) -> DataFrame:
        return self._clean("customers", silver.clean_customers)

    @cached_property
    def sellers(self) -> DataFrame:
        return self._clean("sellers", silver.clean_sellers)

    @cached_property
    def products(self) -> DataFrame:
        return self._clean("products", silver.clean_products)

    def orders(self, sequence: str | None = None) -> DataFrame:
        """``sequence``: None, "flag" (repeat flag only) or "full" (position and flag)."""
        orders = self._clean("orders", silver.clean_orders)
        if sequence == "full":
            return silver.with_order_sequence(orders)
        return silver.with_repeat_flag(orders) if sequence == "flag" else orders

    def order_items(self, enriched: bool = True) -> DataFrame:
        items = self._by_order("order_items", silver.usable_items)
        return silver.enrich_items(items, self.products) if enriched else items

    def lines_of(self, orders: DataFrame) -> DataFrame:
        """Clean lines of some orders, which are kept ones; lines of others are left out first."""
        feed = of_keys(self.raw("order_items"), "order_id", orders, "order_id")
        return self._by_order("order_items", silver.usable_items, feed)

    @cached_property
    def payments(self) -> DataFrame:
        return self._clean("payments", silver.clean_payments)

    @cached_property
    def parsed_shipments(self) -> DataFrame:
        return self._clean("shipments", silver.parse_shipments)

    @cached_property
    def shipments(self) -> DataFrame:
        return silver.split_shipments(self.parsed_shipments)[0]

    @cached_property
    def returns(self) -> DataFrame:
        return self._clean("returns", silver.clean_returns)

    # ---------------------------------------------------------------- staging
    # Orphans are not filtered again here: every fact below joins to orders.

    @cached_property
    def stg_customers(self) -> DataFrame:
        return staging.stg_customers(self.customers)

    @cached_property
    def stg_sellers(self) -> DataFrame:
        return staging.stg_sellers(self.sellers)

    @cached_property
    def stg_products(self) -> DataFrame:
        return staging.stg_products(self.products)

    def stg_orders(self, sequence: str | None = None) -> DataFrame:
        return staging.stg_orders(self.orders(sequence))

    def stg_order_items(self, enriched: bool = True) -> DataFrame:
        return staging.stg_order_items(self.order_items(enriched))

    @cached_property
    def stg_payments(self) -> DataFrame:
        return staging.stg_payments(self._by_order("payments", silver.clean_payments))

    @cached_property
    def stg_shipments(self) -> DataFrame:
        return staging.stg_shipments(self.shipments)

    @cached_property
    def stg_returns(self) -> DataFrame:
        return staging.stg_returns(self.returns)

    # ------------------------------------------------------------------- star

    @cached_property
    def dim_date(self) -> DataFrame:
        orders = self.raw("orders")
        return star.dim_date(
            spine_over(
                orders.select(silver.dates.parse_date(orders["order_purchase_ts"]).alias("d")), "d"
            )
        )

    @cached_property
    def dim_customer(self) -> DataFrame:
        return star.dim_customer(self.stg_customers)

    @cached_property
    def dim_product(self) -> DataFrame:
        return star.dim_product(self.stg_products)

    @cached_property
    def dim_seller(self) -> DataFrame:
        return star.dim_seller(self.stg_sellers)

    @cached_property
    def dim_location(self) -> DataFrame:
        return star.dim_location(self.stg_customers, self.stg_sellers)

    def fact_orders(
        self,
        items: bool = True,
        payments: bool = False,
        shipments: bool = False,
        geography: bool = False,
        repeat: bool = False,
    ) -> DataFrame:
        return star.fact_orders(
            self.stg_orders("flag" if repeat else None),
            self.stg_order_items(enriched=False) if items else None,
            self.stg_payments if payments else None,
            self.stg_shipments if shipments else None,
            self.stg_customers if geography else None,
        )

    def fact_order_items(self, enriched: bool = True, orders: DataFrame | None = None) -> DataFrame:
        """``orders`` are staged ones, all by default. Lines meet them where they are, and products after that."""
        lines = star.fact_order_items(
            self.stg_order_items(False), self.stg_orders() if orders is None else orders
        )
        return star.with_attributes(lines, self.stg_products) if enriched else lines

    @cached_property
    def fact_payments(self) -> DataFrame:
        return star.fact_payments(self.stg_payments, self.stg_orders())

    @cached_property
    def fact_shipments(self) -> DataFrame:
        return star.fact_shipments(self.stg_shipments, self.stg_orders())

    @cached_property
    def fact_returns(self) -> DataFrame:
        return star.fact_returns(self.stg_returns, self.stg_orders())

    # ------------------------------------------------------------------ marts

    @cached_property
    def daily_sales(self) -> DataFrame:
        return marts.daily_sales(self.fact_orders(), self.dim_date)

    @cached_property
    def seller_performance(self) -> DataFrame:
        return marts.seller_performance(
            self.dim_seller, self.fact_order_items(enriched=False), self.fact_returns
        )

    @cached_property
    def product_performance(self) -> DataFrame:
        return marts.product_performance(
            self.dim_product, self.fact_order_items(enriched=False), self.fact_returns
        )

    @cached_property
    def customer_summary(self) -> DataFrame:
        return marts.customer_summary(self.dim_customer, self.fact_orders())

    @cached_property
    def delivery_performance(self) -> DataFrame:
        return marts.delivery_performance(self.fact_shipments, self.dim_customer)


class Marts:
    """The same names over tables that ``build_models`` has written."""

    def __init__(self, models: Mapping[str, DataFrame]):
        self._models = models

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in self._models:
            raise AttributeError(name)
        return self._models[name]

    def fact_orders(self, **parts: bool) -> DataFrame:
        return self._models["fact_orders"]

    def fact_order_items(self, enriched: bool = True) -> DataFrame:
        return self._models["fact_order_items"]
