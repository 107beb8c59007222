from datetime import date, datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidemart.operators import incremental as inc
from tidemart.session import Scratch, path_exists, remove_path, scratch_dir
from tidemart.sinks import landing, runlog
from tidemart.sinks.tables import counted, write_by_month, write_jdbc, write_table
from tidemart.sources.feeds import load_entity, parse_csv_feed, read_csv_feed


def content(spark, path, *cols):
    df = spark.read.option("mergeSchema", True).parquet(path)
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


def test_upsert_replaces_adds_and_repeats(spark, rows):
    path = f"{scratch_dir(spark, 't')}/t"
    inc.upsert(spark, path, rows("k int, v string", (1, "a"), (2, "b"), (3, "c")), ["k"])
    batch = rows("k int, v string, extra int", (3, "C", 7), (4, "D", 8))
    for _ in range(2):
        inc.upsert(spark, path, batch, ["k"])
        assert content(spark, path, "k", "v", "extra") == [
            (1, "a", None), (2, "b", None), (3, "C", 7), (4, "D", 8),
        ]


def test_upsert_moves_a_key_between_partitions_and_leaves_others_alone(spark, rows):
    path = f"{scratch_dir(spark, 't')}/t"
    schema = "k int, m int, v string"
    inc.upsert(spark, path, rows(schema, (1, 1, "a"), (2, 1, "b"), (3, 2, "c"), (4, 3, "d")), ["k"], ["m"])
    untouched = [f.path for f in spark.read.format("binaryFile").load(f"{path}/m=1").select("path").collect()]
    inc.upsert(spark, path, rows(schema, (3, 3, "C")), ["k"], ["m"])
    assert content(spark, path, "k", "m", "v") == [(1, 1, "a"), (2, 1, "b"), (3, 3, "C"), (4, 3, "d")]
    assert not path_exists(spark, f"{path}/m=2"), "emptied partition stays behind"
    again = [f.path for f in spark.read.format("binaryFile").load(f"{path}/m=1").select("path").collect()]
    assert sorted(untouched) == sorted(again)


def test_upsert_without_moving_keys(spark, rows):
    path = f"{scratch_dir(spark, 't')}/t"
    schema = "k int, m int, v string"
    inc.upsert(spark, path, rows(schema, (1, 1, "a"), (2, 2, "b")), ["k"], ["m"])
    inc.upsert(spark, path, rows(schema, (2, 2, "B"), (5, 9, "e")), ["k"], ["m"], keys_move=False)
    assert content(spark, path, "k", "m", "v") == [(1, 1, "a"), (2, 2, "B"), (5, 9, "e")]


def test_rows_without_a_partition_value(spark, rows):
    path = f"{scratch_dir(spark, 't')}/t"
    schema = "k int, m int, v string"
    inc.upsert(spark, path, rows(schema, (1, None, "a"), (2, 1, "b")), ["k"], ["m"])
    inc.upsert(spark, path, rows(schema, (1, 1, "A")), ["k"], ["m"])
    assert content(spark, path, "k", "m", "v") == [(1, 1, "A"), (2, 1, "b")]


def test_unexpected_columns_are_refused_where_none_are_promised(spark, rows):
    path = f"{scratch_dir(spark, 't')}/t"
    inc.upsert(spark, path, rows("k int, v string", (1, "a")), ["k"])
    with pytest.raises(ValueError, match="differ"):
        inc.upsert(spark, path, rows("k int, v string, w int", (1, "a", 2)), ["k"], new_columns=False)


def test_upsert_on_a_composite_key(spark, rows):
    path = f"{scratch_dir(spark, 't')}/t"
    inc.upsert(spark, path, rows("a int, b int, v int", (1, 1, 10), (1, 2, 20)), ["a", "b"])
    inc.upsert(spark, path, rows("a int, b int, v int", (1, 2, 21)), ["a", "b"])
    assert content(spark, path, "a", "b", "v") == [(1, 1, 10), (1, 2, 21)]


def test_watermark_never_goes_back(spark):
    path = f"{scratch_dir(spark, 's')}/marks"
    assert inc.read_watermark(spark, path, "orders") is None
    newest = datetime(2024, 5, 1, 12)
    for mark in (datetime(2024, 1, 1), newest, datetime(2024, 3, 1)):
        inc.write_watermark(spark, path, "orders", mark)
    inc.write_watermark(spark, path, "other", datetime(2025, 1, 1))
    assert inc.read_watermark(spark, path, "orders") == newest


@pytest.mark.parametrize("kind", ["string", "timestamp_ntz"])
def test_since_watermark_is_strict_and_looks_back_on_request(rows, kind):
    df = rows("ts string", ("2024-01-01 00:00:00",), ("2024-01-03 00:00:00",), ("2024-01-05 00:00:00",), ("junk",))
    if kind != "string":
        df = df.select(F.col("ts").try_cast(kind).alias("ts"))
    mark = datetime(2024, 1, 3)
    assert inc.since_watermark(df, "ts", mark).count() == 1
    assert inc.since_watermark(df, "ts", mark, 2).count() == 3
    assert inc.since_watermark(df, "ts", None).count() == 4


def test_watermark_filter_reaches_the_scan(warehouse, plan):
    df = inc.since_watermark(warehouse.table("orders"), "o_orderdate", datetime(2000, 1, 1))
    assert "GreaterThan(o_orderdate" in plan(df)


def test_lookback_crosses_the_month(rows):
    days = rows("d date, k int", (date(2024, 2, 28), 20240228), (date(2024, 2, 29), 20240229), (date(2024, 3, 1), 20240301))
    target = days.filter("k = 20240301")
    assert [r.k for r in inc.lookback(days, target, "d", 1).orderBy("k").collect()] == [20240229, 20240301]
    assert [r.k for r in inc.lookback_key(days, target, "k", 1).orderBy("k").collect()] == [20240229, 20240301]
    empty = days.limit(0)
    assert inc.lookback(days, empty, "d", 3).count() == inc.lookback_key(days, empty, "k", 3).count() == 3


def test_partition_pruning_of_a_month(spark, warehouse, plan):
    path = write_by_month(warehouse.orders(), scratch_dir(spark, "o"), "orders")
    df = spark.read.parquet(path).filter("order_year = 1998 and order_month = 3")
    assert "PartitionFilters: [isnotnull(order_year" in plan(df)


def test_look_back_reads_recent_months_only(spark, warehouse, plan):
    path = write_by_month(warehouse.orders(), scratch_dir(spark, "o"), "orders")
    start = inc.lookback_start(spark.read.parquet(path), "order_date", 3)
    text = plan(spark.read.parquet(path).filter(inc.months_since(start)))
    assert "PartitionFilters: [((order_year" in text or "PartitionFilters: [(((order_year" in text


def test_landing_is_idempotent_per_content_and_date(spark, rows):
    base = scratch_dir(spark, "bronze")
    df = rows("order_id string", ("a",), ("b",))
    assert landing.land(spark, df, "orders", "2024-01-01", base) == (True, 2)
    assert landing.land(spark, df.orderBy(F.desc("order_id")), "orders", "2024-01-01", base) == (False, 2)
    assert landing.land(spark, df.limit(1), "orders", "2024-01-02", base)[0]
    assert landing.manifest(spark, base).count() == 2
    assert landing.read_latest(spark, base, "orders").count() == 1


def test_feed_without_required_columns_is_rejected_whole(spark, rows):
    base = scratch_dir(spark, "raw")
    rows("order_id string, carrier string", ("o", "c"), ("p", "c")).write.option("header", True).csv(f"{base}/shipments.csv")
    log = landing.land_all(spark, base, "2024-01-01", f"{base}/bronze")
    assert [tuple(r) for r in log.frame(spark).collect()] == [("shipments", "rejected", 2)]


RETURNS_HEADER = "return_id,order_id,order_item_id,product_id,return_reason,return_status,return_qty,refund_amount_inr,return_requested_ts,return_completed_ts"


def csv_file(spark, name, *lines):
    path = f"{scratch_dir(spark, 'csv')}/{name}.csv"
    spark.createDataFrame([("\n".join(lines),)], "value string").coalesce(1).write.text(path)
    return path


def test_csv_feed_with_schema_and_corrupt_rows(spark):
    path = csv_file(
        spark, "returns", RETURNS_HEADER,
        "RET00000000,ORD000000004,1,PROD0000071,Better price available,completed,2,56286.0,2023-01-29 14:37:47,2023-01-31 14:37:47",
        "RET1,ORD1,one,P,,,2,1.0,,",
    )
    good, corrupt = parse_csv_feed(spark, path, "returns", scratch_dir(spark, "parsed"))
    assert good.select("return_id").count() == 1, "broken or not, whatever columns are read"
    row = good.first()
    assert (row.return_qty, row.refund_amount_inr, good.count()) == (2, 56286.0, 1)
    assert corrupt.first()._corrupt_record.startswith("RET1,ORD1,one")


def test_csv_feed_with_swapped_header_fails(spark):
    swapped = RETURNS_HEADER.replace("return_id,order_id", "order_id,return_id")
    path = csv_file(spark, "returns", swapped, "O,R,1,P,,,2,1.0,,")
    with pytest.raises(Exception, match="header|conform"):
        read_csv_feed(spark, path, "returns").collect()


def test_entity_fallback_order(spark, rows):
    base = scratch_dir(spark, "e")
    rows("x int", (1,)).write.option("header", True).csv(f"{base}/a.csv")
    assert load_entity(spark, base, "a").first().x == 1
    rows("x int", (2,)).write.parquet(f"{base}/a.parquet")
    assert load_entity(spark, base, "a").first().x == 2
    write_table(rows("x int", (3,)), base, "a")
    assert load_entity(spark, base, "a").first().x == 3
    with pytest.raises(FileNotFoundError):
        load_entity(spark, base, "b")


def test_jdbc_write_is_parallel_and_keeps_the_table(spark, monkeypatch):
    """The call that would be made; no database is started for it."""
    from pyspark.sql.readwriter import DataFrameWriter

    seen = {}
    monkeypatch.setattr(DataFrameWriter, "option", lambda self, k, v: seen.update({k: v}) or self)

    def jdbc(self, url, table, mode=None, properties=None):
        seen.update(url=url, table=table, properties=properties, tasks=self._df.rdd.getNumPartitions())

    monkeypatch.setattr(DataFrameWriter, "jdbc", jdbc)
    write_jdbc(spark.range(100), "jdbc:x", "staging.orders", "overwrite", {"user": "u"}, 4)
    assert seen == {
        "numPartitions": 4, "batchsize": 10000, "truncate": True, "url": "jdbc:x",
        "table": "staging.orders", "properties": {"user": "u"}, "tasks": 4,
    }


def test_counts_ride_on_the_write(spark, rows):
    df, seen = counted(rows("x int", (1,), (2,)), "w", total=F.sum("x"))
    write_table(df, scratch_dir(spark, "w"), "t")
    assert (seen.get["rows"], seen.get["total"]) == (2, 3)


@pytest.mark.parametrize("parts", [(), ("m",)])
def test_upsert_after_a_broken_swap_has_every_row(spark, rows, monkeypatch, parts):
    path = f"{scratch_dir(spark, 't')}/t"
    schema = "k int, m int, v string"
    inc.upsert(spark, path, rows(schema, *[(k, k % 3, "old") for k in range(10)]), ["k"], parts)
    batch = rows(schema, (1, 2, "new"), (11, 4, "new"))
    swap = inc._swap

    def breaks(spark, path, stage):
        inc.remove_path(spark, f"{path}/m=1" if parts else path)
        raise OSError("lost")

    monkeypatch.setattr(inc, "_swap", breaks)
    with pytest.raises(OSError):
        inc.upsert(spark, path, batch, ["k"], parts)
    monkeypatch.setattr(inc, "_swap", swap)
    inc.upsert(spark, path, batch, ["k"], parts)
    expected = sorted([(k, k % 3, "old") for k in range(10) if k != 1] + [(1, 2, "new"), (11, 4, "new")], key=repr)
    assert content(spark, path, "k", "m", "v") == expected
    assert not inc.finish_upsert(spark, path)


def test_a_stage_without_a_plan_is_dropped(spark, rows):
    path = f"{scratch_dir(spark, 't')}/t"
    inc.upsert(spark, path, rows("k int, v string", (1, "a")), ["k"])
    rows("k int, v string", (9, "half")).write.parquet(f"{inc._pending(path)}/new")
    inc.upsert(spark, path, rows("k int, v string", (2, "b")), ["k"])
    assert content(spark, path, "k", "v") == [(1, "a"), (2, "b")]


def test_keys_that_leave_without_a_new_row(spark, rows):
    path = f"{scratch_dir(spark, 't')}/t"
    schema = "k int, m int, v string"
    inc.upsert(spark, path, rows(schema, (1, 1, "a"), (2, 1, "b"), (3, 2, "c")), ["k"], ["m"])
    inc.upsert(spark, path, rows(schema, (2, 1, "B")), ["k"], ["m"], gone=rows("k int", (2,), (3,), (7,)))
    assert content(spark, path, "k", "m", "v") == [(1, 1, "a"), (2, 1, "B")]
    assert not path_exists(spark, f"{path}/m=2")


def test_look_back_ignores_days_after_the_run(rows):
    days = rows("d date, k int", (date(2024, 2, 28), 20240228), (date(2099, 1, 1), 20990101))
    assert inc.lookback_start(days, "d", 3, date(2024, 3, 1)) == date(2024, 2, 25)
    assert inc.lookback_start(days, "k", 3, date(2024, 3, 1)) == date(2024, 2, 25)


def test_a_value_moved_beside_a_null_lands_again(spark, rows):
    base, schema = scratch_dir(spark, "bronze"), "order_id string, a string, b string"
    assert landing.land(spark, rows(schema, ("1", None, "x")), "orders", "2024-01-01", base)[0]
    assert landing.land(spark, rows(schema, ("1", "x", None)), "orders", "2024-01-01", base)[0]
    renamed = rows("order_id string, a string, c string", ("1", None, "x"))
    assert landing.land(spark, renamed, "orders", "2024-01-01", base)[0]


def test_landed_values_that_do_not_parse_are_set_aside(spark, rows):
    base = scratch_dir(spark, "bronze")
    schema = "order_id string, order_item_id string, product_id string, seller_id string, quantity string"
    landing.land(spark, rows(schema, ("o", "1", "p", "s", "many"), ("o", "2", "p", "s", "3"), ("o", "3", "p", "s", None)),
                 "order_items", "2024-01-01", base)
    good = landing.bronze_reader(spark, base, f"{base}/out")("order_items")
    assert sorted((r.order_item_id, r.quantity) for r in good.collect()) == [(2, 3), (3, None)]
    aside = spark.read.parquet(f"{base}/out/_quarantine/order_items_corrupt")
    assert [r.quantity for r in aside.collect()] == ["many"]


def test_batches_landed_after_a_moment(spark, rows):
    base = scratch_dir(spark, "bronze")
    landing.land(spark, rows("order_id string", ("1",)), "orders", "2024-01-01", base)
    since = landing.manifest(spark, base).agg(F.max("landed_at")).first()[0]
    landing.land(spark, rows("order_id string", ("2",)), "orders", "2024-01-02", base)
    landing.land(spark, rows("order_id string", ("3",)), "orders", "2024-01-02", base)
    assert sorted(r.order_id for r in landing.bronze_reader(spark, base, after=since)("orders").collect()) == ["2", "3"]
    assert landing.bronze_reader(spark, base, after=since)("payments").count() == 0


def files_of(spark, path):
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
    return {r.path: r.modificationTime for r in files.select("path", "modificationTime").collect()}


def test_bucketed_upsert_touches_its_buckets_only(spark, rows):
    path = f"{scratch_dir(spark, 't')}/t"
    schema = "k int, v string"
    inc.upsert_bucketed(spark, path, rows(schema, *[(k, "old") for k in range(40)]), ["k"], 8)
    before = files_of(spark, path)
    batch = rows("k int, v string, extra int", (3, "new", 1), (77, "new", 2))
    for _ in range(2):
        inc.upsert_bucketed(spark, path, batch, ["k"])
    after = files_of(spark, path)
    homes = {r[inc.BUCKET] for r in inc.with_bucket(batch, ["k"], 8).collect()}
    same = {f for f in before if not any(f"{inc.BUCKET}={b}/" in f for b in homes)}
    assert same and all(after.get(f) == before[f] for f in same)
    found = sorted((r.k, r.v, r.extra) for r in inc.read_bucketed(spark, path).collect())
    assert found == sorted([(k, "old", None) for k in range(40) if k != 3] + [(3, "new", 1), (77, "new", 2)])


@pytest.mark.parametrize("at", [1, 2, 3])
def test_bucketed_upsert_after_a_broken_swap(spark, rows, monkeypatch, at):
    path = f"{scratch_dir(spark, 't')}/t"
    schema = "k int, v string"
    inc.upsert_bucketed(spark, path, rows(schema, *[(k, "old") for k in range(20)]), ["k"], 4)
    batch, move, moves = rows(schema, *[(k, "new") for k in range(10, 30)]), inc.move_folder, []

    def breaks(spark, source, target):
        moves.append(target)
        if len(moves) == at:
            remove_path(spark, target)  # deleted, not yet moved
            raise OSError("lost")
        move(spark, source, target)

    monkeypatch.setattr(inc, "move_folder", breaks)
    with pytest.raises(OSError):
        inc.upsert_bucketed(spark, path, batch, ["k"])
    monkeypatch.setattr(inc, "move_folder", move)
    inc.upsert_bucketed(spark, path, rows(schema, (99, "last")), ["k"])
    found = sorted((r.k, r.v) for r in inc.read_bucketed(spark, path).collect())
    assert found == [(k, "old") for k in range(10)] + [(k, "new") for k in range(10, 30)] + [(99, "last")]


def test_bucketed_keys_that_leave_and_other_keys(spark, rows):
    path = f"{scratch_dir(spark, 't')}/t"
    schema = "k string, v int"
    inc.upsert_bucketed(spark, path, rows(schema, ("a", 1), ("b", 2), (None, 3)), ["k"], 64)
    inc.upsert_bucketed(spark, path, rows(schema, ("a", 9)), ["k"], gone=rows("k string", ("b",), ("zz",)))
    assert sorted((r.k or "", r.v) for r in inc.read_bucketed(spark, path).collect()) == [("", 3), ("a", 9)]
    assert len(inc.leaf_folders(spark, path, 1)) == 2, "an emptied bucket leaves no folder"
    with pytest.raises(ValueError, match="bucketed by"):
        inc.upsert_bucketed(spark, path, rows(schema, ("a", 1)), ["v"])
    inc.rebucket(spark, path, 2)
    assert inc.read_layout(spark, path) == (["k"], 2)
    inc.upsert_bucketed(spark, path, rows(schema, ("a", 10)), ["k"], 64)
    assert sorted((r.k or "", r.v) for r in inc.read_bucketed(spark, path).collect()) == [("", 3), ("a", 10)]


def test_a_thousand_marks_leave_a_bounded_number_of_files(spark):
    path = f"{scratch_dir(spark, 's')}/marks"
    start = datetime(2024, 1, 1)
    for i in range(1000):
        inc.write_watermark(spark, path, "orders", start + timedelta(seconds=i * 37 % 1000))
    assert inc.read_watermark(spark, path, "orders") == start + timedelta(seconds=999)
    assert len(runlog.entries(spark, f"{path}/orders")) <= runlog.FOLD_AT + 1
    inc.write_watermark(spark, path, "orders", start, restart=True)
    assert inc.read_watermark(spark, path, "orders") == start


def test_two_landers_of_one_batch_leave_one_entry_and_logs_fold(spark, rows, monkeypatch):
    base = scratch_dir(spark, "l")
    df, none = rows("order_id string", ("1",)), spark.createDataFrame([], landing.MANIFEST)
    seen = landing.manifest
    monkeypatch.setattr(landing, "manifest", lambda *a: none)  # neither sees the other
    for _ in range(2):
        assert landing.land(spark, df, "orders", "2024-01-01", base)[0]
    monkeypatch.setattr(landing, "manifest", seen)
    assert landing.manifest(spark, base).count() == len(runlog.entries(spark, f"{base}/_manifest")) == 1
    monkeypatch.setattr(landing, "FOLD_AT", 3)
    for day in range(2, 9):
        landing.land(spark, df, "orders", f"2024-01-0{day}", base)
    assert landing.manifest(spark, base).count() == 8
    assert len(runlog.entries(spark, f"{base}/_manifest")) <= 4
    assert not landing.land(spark, df, "orders", "2024-01-05", base)[0], "an entry in a fold counts"


def test_rows_that_stay_beside_a_large_batch(spark, rows, plan, monkeypatch):
    """Found on the keys alone: whole rows are not shuffled for it, and a null key stays."""
    monkeypatch.setattr(inc, "SENT_BATCH", 0)
    old = rows("k int, v string", (1, "a"), (2, "b"), (2, "c"), (3, "d"), (None, "e"))
    with Scratch(spark, "staying") as scratch:
        leaving = rows("k int", (1,), (3,), (4,), (5,), (None,)).distinct()
        left = inc._staying(scratch, old, leaving, ["k"])
        assert "Exchange hashpartitioning" not in plan(left)
        assert sorted(r.v for r in left.collect()) == ["b", "c", "e"]


def test_upsert_of_a_large_batch_equals_one_of_a_small(spark, rows, monkeypatch):
    table = rows("k int, v string, m int", (1, "a", 1), (2, "b", 1), (3, "c", 2), (None, "d", 2), (4, "e", 3))
    batch = rows("k int, v string, m int", (1, "A", 2), (3, "C", 2), (9, "I", 4))
    found = []
    for limit in (1 << 17, 0):
        monkeypatch.setattr(inc, "SENT_BATCH", limit)
        path = f"{scratch_dir(spark, 'large')}/t"
        for df in (table, batch):
            inc.upsert(spark, path, df, ["k"], ["m"])
        found.append(sorted(map(repr, spark.read.parquet(path).collect())))
    assert found[0] == found[1] and len(found[0]) == 6


def test_first_batch_of_a_date_is_parsed_once(spark, rows, monkeypatch):
    """Its digest is taken from what was written; nothing is left beside it, also where a landing breaks."""
    base, read = scratch_dir(spark, "l"), []
    digest = landing.tree_digest
    monkeypatch.setattr(landing, "tree_digest", lambda df, *a: read.append((df.inputFiles(), a)) or digest(df, *a))
    df = rows("order_id string, n int", *[(str(i % 5), i) for i in range(9)])
    for again, order in ((True, "n"), (False, "order_id"), (False, "n")):
        assert landing.land(spark, df.orderBy(F.desc(order)), "orders", "2024-01-01", base) == (again, 9)
    assert [bool(files) for files, _ in read] == [True, False, False] and {a for _, a in read} == {(9,)}
    assert landing.land(spark, df.limit(0), "orders", "2024-01-01", base) == (True, 0)
    assert landing.land(spark, df.limit(0), "returns", "2024-01-01", base) == (True, 0)
    assert not landing.land(spark, df.limit(0), "returns", "2024-01-01", base)[0]
    monkeypatch.setattr(landing, "tree_digest", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        landing.land(spark, df, "orders", "2024-01-02", base)
    for source in ("orders", "returns"):
        assert [str(p) for p in Path(base, source, "_landing").iterdir()] == []
    monkeypatch.undo()
    assert landing.land(spark, df, "orders", "2024-01-02", base) == (True, 9)
    assert sorted(map(tuple, landing.read_latest(spark, base, "orders").select(*df.columns).collect())) == sorted(map(tuple, df.collect()))
