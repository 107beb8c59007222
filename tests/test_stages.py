"""The stages on literal feeds: a first load, a late batch, and the whole build."""

from datetime import date

from pyspark.sql import functions as F

from tidemart.catalog.io import write_csv
from tidemart.contracts import FEEDS
from tidemart.operators.dedup import dedup_latest
from tidemart.operators.incremental import _stored
from tidemart.plans import flows, silver
from tidemart.plans.warehouse import Marts
from tidemart.session import Scratch, scratch_dir
from tidemart.sinks import landing
from tidemart.sinks.tables import write_table

TEXT = {
    "customers": [("c1", "Asha", None, None, "bombay", "maharashtra", "4", "2023-01-05", "New"),
                  ("c2", "Ravi", None, None, None, None, "5", "2023-02-05", "Regular")],
    "sellers": [("s1", "Acme", "Pune", "maharashtra", 1, "4", "2022-01-01", 4.0, "Reseller")],
    "products": [("p1", "Mug", "HOME AND KITCHEN", "Cups", "B", 100.0, 400),
                 ("p2", "Pen", "books", "Pens", "B", -5.0, None)],
}
FIRST = {
    "orders": [("o1", "c1", "delivered", "2023-03-01 10:00:00", "2023-03-01 10:05:00", "COD"),
               ("o2", "c1", "cancelled", "2023-03-30 10:00:00", None, "UPI")],
    "order_items": [("o1", 1, "p1", "s1", 2, 50.0, 1.0, 5.0, None), ("o2", 1, "p2", "s1", 1, 10.0, None, None, None),
                    ("o9", 1, "p1", "s1", 1, 7.0, None, None, None)],
    "payments": [("o1", 1, "COD", 1, 105.0, "PAID"), ("o2", 1, "UPI", 1, None, "declined")],
    "shipments": [("o1", "Ekart", "2023-03-02 08:00:00", "2023-03-04", "2023-03-05 09:00:00", "delivered"),
                  ("o2", "Ekart", "2023-04-02 08:00:00", "2023-04-04", "2023-04-01 09:00:00", "delivered")],
    "returns": [("r1", "o1", 1, "p1", "Defective", "completed", 1, 50.0, "2023-03-08 10:00:00", "2023-03-10 10:00:00")],
}
SECOND = {  # an older order (o0), the order of a waiting line (o9), a line for an earlier order
    "orders": [("o0", "c1", "delivered", "2023-03-29 09:00:00", None, "UPI"),
               ("o9", "c2", "delivered", "2023-04-02 09:00:00", None, "UPI")],
    "order_items": [("o0", 1, "p1", "s1", 1, 20.0, None, None, None), ("o1", 2, "p2", "s1", 4, 2.0, None, None, None)],
    "payments": [("o2", 1, "UPI", 1, 10.0, "success")], "shipments": [], "returns": [],
}


def reader(spark, feeds):
    return lambda name: spark.createDataFrame({**TEXT, **feeds}[name], FEEDS[name].struct)


def test_two_runs_and_build(spark):
    base = scratch_dir(spark, "stages")
    silver = f"{base}/silver"
    first = flows.bronze_to_silver(spark, reader(spark, FIRST), silver)
    assert first.total("set aside") == 2  # waiting line and impossible shipment
    for _ in range(2):  # the second of these repeats a finished run
        flows.bronze_to_silver(spark, reader(spark, SECOND), silver, incremental=True)

    def kept(name, *cols):
        return sorted(tuple(r) for r in spark.read.parquet(f"{silver}/{name}").select(*cols).collect())

    assert kept("orders", "order_id", "customer_order_seq", "is_repeat_order") == [
        ("o0", 2, 1), ("o1", 1, 0), ("o2", 3, 1), ("o9", 1, 0),
    ]
    assert kept("order_items", "order_id", "order_item_id") == [
        ("o0", 1), ("o1", 1), ("o1", 2), ("o2", 1), ("o9", 1),
    ]
    assert kept("payments", "order_id", "payment_status") == [("o1", "paid"), ("o2", "paid")]
    assert spark.read.parquet(f"{silver}/_quarantine/order_items_orphan").count() == 0
    assert kept("_quarantine/shipments_bad_dates", "order_id") == [("o2",)]

    flows.load_staging(spark, silver, f"{base}/staging")
    flows.load_staging(spark, silver, f"{base}/staging", since=date(2023, 3, 30))
    models = flows.build_models(spark, f"{base}/staging", base, "2024-01-01 00:00:00")
    failed = flows.check_models(models).filter("not passed").collect()
    assert failed == []
    facts = {r.order_id: (int(r.gmv_inr), int(r.order_value_inr), r.n_items) for r in models["fact_orders"].collect()}
    assert facts == {"o0": (20, 20, 1), "o1": (108, 113, 2), "o2": (10, 10, 1), "o9": (7, 7, 1)}
    assert models["dim_date"].count() == 365
    marts = Marts(models)
    assert marts.customer_summary.filter("is_repeat_customer").count() == 1
    assert models["seller_performance"].first().returned_lines == 1

    again = flows.build_models(spark, f"{base}/staging", base, "2024-02-01 00:00:00", incremental=True)
    for name in ("fact_order_items", "daily_sales"):
        assert again[name].count() == {"fact_order_items": 5, "daily_sales": 4}[name]
    assert again["dim_seller_history"].count() == 1
    total = again["fact_order_items"].agg(F.sum("line_total_inr")).first()[0]
    assert int(total) == 150


def test_csv_files_over_landing_to_clean(spark):
    base = scratch_dir(spark, "bronze")
    read = reader(spark, FIRST)
    for name in FEEDS:
        read(name).write.option("header", True).csv(f"{base}/raw/{name}.csv")
    landed = landing.land_all(spark, f"{base}/raw", "2024-01-01", f"{base}/bronze")
    assert len(landed.entities()) == 8
    flows.bronze_to_silver(spark, landing.bronze_reader(spark, f"{base}/bronze"), f"{base}/a")
    flows.bronze_to_silver(spark, flows.csv_reader(spark, f"{base}/raw", f"{base}/b"), f"{base}/b")
    flows.bronze_to_silver(spark, read, f"{base}/c")
    for name in FEEDS:
        contents = {
            tuple(sorted(map(repr, spark.read.parquet(f"{base}/{x}/{name}").collect()))) for x in "abc"
        }
        assert len(contents) == 1, name


def test_late_unreadable_and_misdated_orders_are_kept_and_sides_swap(spark):
    """Two deliveries end as one delivery of the newest rows does."""
    first = {
        "orders": [("o1", "c1", "delivered", "2023-03-10 10:00:00", None, "UPI"), ("o8", "c1", "delivered", "2099-01-01 00:00:00", None, "UPI"),
                   ("o5", "c1", "delivered", "2023-03-20 10:00:00", None, "UPI"), ("o6", "c1", "delivered", "2023-03-25 10:00:00", None, "UPI")],
        "order_items": [("o1", 1, "p1", "s1", 2, 5.0, None, None, None), ("o1", 2, "p1", "s1", 1, 5.0, None, None, None)],
        "payments": [], "returns": [],
        "shipments": [("o1", "E", "2023-03-12 08:00:00", "2023-03-14", "2023-03-11 08:00:00", "delivered"),
                      ("o5", "E", "2023-03-22 08:00:00", "2023-03-24", "2023-03-23 08:00:00", "delivered")],
    }
    second = {
        "orders": [("o0", "c1", "delivered", "2023-01-01 10:00:00", None, "UPI"), ("o7", "c2", "delivered", "soon", None, "UPI"),
                   ("o9", "c2", "delivered", "2023-04-01 10:00:00", None, "UPI"),
                   ("o5", "c2", "delivered", "2023-03-20 10:00:00", None, "UPI")],  # moved to another customer
        "order_items": [("o0", 1, "p1", "s1", 1, 7.0, None, None, None), ("o1", 2, "p1", "s1", 0, 5.0, None, None, None)],
        "payments": [], "returns": [],
        "shipments": [("o1", "E", "2023-03-12 08:00:00", "2023-03-14", "2023-03-13 08:00:00", "delivered"),   # corrected
                      ("o5", "E", "2023-03-22 08:00:00", "2023-03-24", "2023-03-21 08:00:00", "delivered")],  # newly bad
    }
    keys = {"orders": 1, "order_items": 2, "shipments": 1}
    merged = {n: list({r[: keys.get(n, 1)]: r for r in [*first[n], *second[n]]}.values()) for n in first}
    base = scratch_dir(spark, "late")
    flows.bronze_to_silver(spark, reader(spark, first), f"{base}/two")
    flows.bronze_to_silver(spark, reader(spark, second), f"{base}/two", incremental=True)
    flows.bronze_to_silver(spark, reader(spark, merged), f"{base}/one")
    for name in ("orders", "order_items", "shipments", "_quarantine/shipments_bad_dates", "_quarantine/order_items_orphan"):
        one, two = (spark.read.parquet(f"{base}/{x}/{name}") for x in ("one", "two"))
        columns = sorted(one.columns)
        assert sorted(map(repr, one.select(columns).collect())) == sorted(map(repr, two.select(columns).collect())), name


def test_written_files_are_compressed(rows, spark, tmp_path):
    """CSV feeds and tables are written small and read back as they were."""
    df = rows("a string, b int", *[(f"value {i % 5}", i) for i in range(500)])
    write_csv(df, f"{tmp_path}/feed.csv")
    write_table(df, str(tmp_path), "table")
    csv, table = list(tmp_path.glob("feed.csv/part-*")), list(tmp_path.glob("table/part-*"))
    assert csv and all(f.name.endswith(".csv.gz") for f in csv)
    assert table and all(".zst" in f.name for f in table)
    back = spark.read.option("header", True).schema(df.schema).csv(f"{tmp_path}/feed.csv")
    for again in (back, spark.read.parquet(f"{tmp_path}/table")):
        assert sorted(again.collect()) == sorted(df.collect())


def test_copies_and_orders_share_one_shuffle(spark, rows, plan):
    """Without broadcasts, lines are shuffled once to meet their orders and to lose their copies."""
    lines = rows(FEEDS["order_items"].struct, *FIRST["order_items"], ("o1", 1, "p2", "s1", 3, 50.0, 1.0, 5.0, None))
    parents = rows("order_id string, order_year int, order_month int", ("o1", 2023, 3), ("o2", None, None))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = silver.usable_items(flows._of_orders(lines, parents, "left"), (), ("product_id",))
        assert plan(kept).count("Exchange hashpartitioning") == 2  # the lines, and the orders
        found = {r.order_id: (r.product_id, r[flows.ORDER]) for r in kept.collect()}
        months = {(r.order_id, r.order_year, r.order_month) for r in flows._by_order_month(kept).collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # an order without a month is known all the same; that of o9 is not
    assert found["o1"] == ("p2", 202303) and found["o2"] == ("p2", 0) and found["o9"][1] is None
    assert months == {("o1", 2023, 3), ("o2", None, None), ("o9", None, None)}


def test_what_a_job_carries_settles_no_ties(rows):
    df = rows("k int, v string", *[(k % 7, f"v{k}") for k in range(70)])
    plain = {(r.k, r.v) for r in dedup_latest(df, ["k"], []).collect()}
    carried = dedup_latest(df.withColumn("__order", F.hash("v")), ["k"], []).collect()
    assert {(r.k, r.v) for r in carried} == plain


def kept_names(monkeypatch):
    """Names of the tables that stages and upserts store on their way."""
    names, keep = [], Scratch.keep
    monkeypatch.setattr(Scratch, "keep", lambda self, df, name: names.append(name) or keep(self, df, name))
    return names


def test_a_large_batch_is_stored_once_and_leaves_what_a_small_one_does(spark, monkeypatch):
    """Neither the keys of whole feeds nor copies of stored batches are written; a key whose new row is
    dropped still leaves, as do copies of returns that have moved to an unknown order."""
    late = {**SECOND,
            "order_items": [*SECOND["order_items"], ("o1", 1, None, "s1", 3, 5.0, None, None, None),
                            ("o2", 1, "p2", "s1", 0, 10.0, None, None, None), ("o9", 2, "p1", "s1", 0, 1.0, None, None, None)],
            "payments": [*SECOND["payments"], ("o7", 1, "UPI", 1, 1.0, "PAID"), (None, 1, "UPI", 1, 1.0, "PAID")],
            "shipments": [("o1", "Ekart", "2023-03-06 08:00:00", "2023-03-04", "2023-03-05 09:00:00", "delivered"),
                          (None, "Ekart", None, None, None, None)],
            "returns": [("r1", "o7", 1, "p1", "Defective", "completed", 1, 50.0, "2023-03-09 10:00:00", None)]}
    found = []
    for share in (1 / 8, 100):
        monkeypatch.setattr(flows, "LARGE_BATCH", share)
        base = scratch_dir(spark, "large")
        flows.bronze_to_silver(spark, reader(spark, FIRST), base)
        names = kept_names(monkeypatch)
        flows.bronze_to_silver(spark, reader(spark, late), base, incremental=True)
        monkeypatch.undo()
        assert not [n for n in names if n.startswith("named")] and names.count("batch") == 2, names
        assert ("parents" in names) == (share == 100)
        tables = (*flows.FACT_KEYS, "orders", "_quarantine/order_items_orphan", "_quarantine/shipments_bad_dates")
        stored = {n: _stored(spark, f"{base}/{n}", False) for n in tables}  # None for one without any month
        rows = {n: sorted(map(str, df.collect())) if df else [] for n, df in stored.items()}
        found.append(rows)
        keys = {(r.order_id, r.order_item_id) for r in spark.read.parquet(f"{base}/order_items").collect()}
        assert keys == {("o0", 1), ("o1", 2), ("o9", 1)}
        assert [r.order_id for r in spark.read.parquet(f"{base}/_quarantine/shipments_bad_dates").collect()] == ["o1", "o2"]
        assert rows["returns"] == rows["shipments"] == rows["_quarantine/order_items_orphan"] == []
    assert found[0] == found[1]


def test_lines_are_sorted_once_for_copies_and_orders(rows, plan):
    lines = rows("order_id long, order_item_id int, product_id long, quantity int, unit_price_inr double,"
                 " discount_inr double, freight_inr double", (1, 1, 1, 1, 1.0, None, None))
    orders = rows("order_id long, order_year int, order_month int", (1, 2023, 1)).repartition("order_id").hint("merge")
    met = flows._of_orders(silver.usable_items(flows._at_orders(lines)), orders, "left")
    left = plan(met).split("SortMergeJoin")[1].split("hashpartitioning")[0]
    assert left.count("Sort [") == 1, plan(met)
