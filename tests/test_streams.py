from datetime import datetime, timedelta

from tidemart.session import hadoop_path, scratch_dir
from tidemart.streaming import streams as st

SCHEMA = "id int, ts timestamp_ntz, v decimal(18,2)"
DAY = datetime(2024, 1, 1)


def arrive(spark, base, *rows):
    data = [(i, DAY + timedelta(days=d, hours=3), v) for i, d, v in rows]
    spark.createDataFrame(data, "id int, ts timestamp_ntz, v int").selectExpr(
        "id", "ts", "CAST(v AS decimal(18,2)) AS v"
    ).coalesce(1).write.mode("append").parquet(f"{base}/in")


def stream(spark, base):
    return st.file_stream(spark, f"{base}/in", SCHEMA, files_per_batch=1)


def test_new_files_are_taken_once(spark):
    base = scratch_dir(spark, "s")
    for batch in ([(1, 0, 1)], [(2, 0, 1), (3, 0, 1)]):
        arrive(spark, base, *batch)
        for _ in range(2):
            st.ingest_new_files(stream(spark, base), f"{base}/out", f"{base}/cp")
    assert sorted(r.id for r in spark.read.parquet(f"{base}/out").collect()) == [1, 2, 3]


def test_copies_within_the_late_bound_are_dropped(spark):
    base = scratch_dir(spark, "s")
    for batch in ([(1, 0, 1), (1, 0, 1)], [(1, 1, 1), (2, 1, 1)], [(2, 2, 9)]):
        arrive(spark, base, *batch)
        st.append_closed(st.dedup_stream(stream(spark, base), ["id"], "ts"), f"{base}/out", f"{base}/cp")
    out = spark.read.parquet(f"{base}/out").collect()
    assert sorted(r.id for r in out) == [1, 2]
    assert set(out[0].asDict()) == {"id", "ts", "v"}


def test_closed_days_only_and_late_rows_counted(spark):
    base = scratch_dir(spark, "s")
    target, cp = f"{base}/days", f"{base}/cp"
    for batch in ([(1, 0, 5)], [(2, 2, 7)], [(3, 1, 1)], [(4, 4, 2)], [(5, 5, 2)]):
        arrive(spark, base, *batch)
        st.append_closed(st.daily_rollup(stream(spark, base), "ts", "v"), target, cp)
    days = {(r.day - DAY.date()).days: (r.events, int(r.total)) for r in spark.read.parquet(target).collect()}
    assert days == {0: (1, 5), 1: (1, 1)}, "days 2, 4 and 5 can still change"


def test_updates_replace_the_row_of_a_day(spark):
    base = scratch_dir(spark, "s")
    target, cp = f"{base}/mart", f"{base}/cp"
    for batch in ([(1, 0, 5), (2, 1, 1)], [(3, 1, 4)], [(4, 2, 7)]):
        arrive(spark, base, *batch)
        rollup = st.daily_rollup(stream(spark, base), "ts", "v")
        st.upsert_updates(spark, rollup, ["day"], target, cp)
    days = {(r.day - DAY.date()).days: (r.events, int(r.total)) for r in spark.read.parquet(target).collect()}
    assert days == {0: (1, 5), 1: (2, 5), 2: (1, 7)}


def test_a_batch_rewrites_the_buckets_of_its_own_groups(spark):
    base = scratch_dir(spark, "s")
    target, cp = f"{base}/mart", f"{base}/cp"

    def update():
        rollup = st.daily_rollup(stream(spark, base), "ts", "v")
        st.upsert_updates(spark, rollup, ["day"], target, cp)
        files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(target)
        return {r.path: r.modificationTime for r in files.select("path", "modificationTime").collect()}

    arrive(spark, base, *[(i, i % 12, 1) for i in range(24)])
    before = update()
    arrive(spark, base, (99, 11, 1))
    after = update()
    assert len(before) > 3 and len(set(before) - set(after)) == 1  # one file gone, one new, the rest as they were
    assert all(before[f] == after[f] for f in set(before) & set(after))


def test_days_do_not_depend_on_the_session_zone(spark):
    base = scratch_dir(spark, "s")
    arrive(spark, base, (1, 0, 5))
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    try:
        rollup = st.daily_rollup(stream(spark, base), "ts", "v")
        st.upsert_updates(spark, rollup, ["day"], f"{base}/mart", f"{base}/cp")
        assert spark.read.parquet(f"{base}/mart").first().day == DAY.date()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_late_first_copies_are_kept_once_and_only_their_day_is_read(spark):
    base = scratch_dir(spark, "s")
    target = f"{base}/out"

    def take(*rows):
        arrive(spark, base, *rows)
        st.dedup_into(spark, lambda: stream(spark, base), ["id"], "ts", target, f"{base}/cp")
        return sorted((r.id, (r.ts - DAY).days) for r in spark.read.parquet(target).collect())

    first = [(1, 0, 1), (2, 30, 1), (3, 31, 1), (3, 31, 1)]
    assert take(*first) == [(1, 0), (2, 30), (3, 31)]
    assert take((4, 1, 1), (4, 1, 1), (1, 0, 1)) == [(1, 0), (2, 30), (3, 31), (4, 1)]  # 30 days late, and a repeat
    folders = {r.name: r for r in spark.read.format("binaryFile").load(target).selectExpr("path AS name", "modificationTime").collect()}
    for name in folders:  # days that later late rows do not belong to may even be unreadable
        if "event_day=2024-01-02" not in name and "event_day=2024-01-03" not in name:
            fs, file = hadoop_path(spark, name)
            fs.create(file, True).close()
    arrive(spark, base, (4, 1, 1), (5, 2, 1), (5, 2, 1))
    st.dedup_into(spark, lambda: stream(spark, base), ["id"], "ts", target, f"{base}/cp")
    schema = "id int, ts timestamp_ntz, v decimal(18,2), event_day date"
    kept = spark.read.schema(schema).parquet(target).where("event_day between '2024-01-02' and '2024-01-03'")
    assert sorted(r.id for r in kept.collect()) == [4, 5]


def test_a_batch_repeated_after_a_break_adds_nothing(spark):
    base = scratch_dir(spark, "s")
    target = f"{base}/out"
    arrive(spark, base, (1, 0, 1), (2, 9, 1), (None, 0, 1))
    for cp in ("cp", "lost"):  # progress is lost, the table is not
        st.dedup_into(spark, lambda: stream(spark, base), ["id"], "ts", target, f"{base}/{cp}")
    assert sorted((r.id or 0) for r in spark.read.parquet(target).collect()) == [0, 1, 2]
