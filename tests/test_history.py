from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemart.operators.asof import as_of_merge
from tidemart.operators.scd2 import _done, _open_keys, as_of, first_versions, read_history, scd2, take_snapshot
from tidemart.plans.flows import seller_history
from tidemart.session import remove_path, scratch_dir

S = "seller_id int, seller_name string, seller_city string, seller_rating double"
CHECK = ["seller_city", "seller_rating"]
T1, T2, T3 = (datetime(2024, m, 1) for m in (1, 2, 3))


def versions(history, key=1):
    rows = history.filter(F.col("seller_id") == key).orderBy("valid_from").collect()
    return [(r.seller_city, r.seller_rating, r.valid_from, r.valid_to) for r in rows]


def at(t):
    return F.lit(str(t))


def test_change_closes_and_opens(rows):
    h = first_versions(rows(S, (1, "A", "Goa", 4.0), (2, "B", "Goa", 3.0)), at(T1))
    h = scd2(h, rows(S, (1, "A", "Pune", 4.4), (2, "B", "Goa", 3.0)), "seller_id", CHECK, at(T2))
    assert versions(h) == [("Goa", 4.0, T1, T2), ("Pune", 4.4, T2, None)]
    assert versions(h, 2) == [("Goa", 3.0, T1, None)]


def test_untracked_change_makes_no_version_and_keeps_the_old_value(rows):
    h = first_versions(rows(S, (1, "A", "Goa", 4.0)), at(T1))
    h = scd2(h, rows(S, (1, "renamed", "Goa", 4.0)), "seller_id", CHECK, at(T2))
    assert len(versions(h)) == 1 and h.first().seller_name == "A"


def test_null_counts_as_a_value(rows):
    h = first_versions(rows(S, (1, "A", "Goa", None)), at(T1))
    same = scd2(h, rows(S, (1, "A", "Goa", None)), "seller_id", CHECK, at(T2))
    assert len(versions(same)) == 1
    changed = scd2(h, rows(S, (1, "A", "Goa", 4.1)), "seller_id", CHECK, at(T2))
    assert [v[1] for v in versions(changed)] == [None, 4.1]


def test_delete_and_return(rows):
    one, two = rows(S, (1, "A", "Goa", 4.0), (2, "B", "Goa", 1.0)), rows(S, (2, "B", "Goa", 1.0))
    h = scd2(first_versions(one, at(T1)), two, "seller_id", CHECK, at(T2))
    assert versions(h) == [("Goa", 4.0, T1, T2)]
    h = scd2(h, one, "seller_id", CHECK, at(T3))
    assert versions(h) == [("Goa", 4.0, T1, T2), ("Goa", 4.0, T3, None)]
    kept = scd2(first_versions(one, at(T1)), two, "seller_id", CHECK, at(T2), close_deletes=False)
    assert versions(kept) == [("Goa", 4.0, T1, None)]


def test_stored_history_equals_the_pure_one_and_repeats(spark, rows):
    base = scratch_dir(spark, "h")
    states = [
        (T1, rows(S, (1, "A", "Goa", 4.0), (2, "B", "Goa", 1.0))),
        (T2, rows(S, (1, "A", "Pune", 4.0))),
        (T3, rows(S, (1, "A", "Pune", 4.0), (2, "B", "Goa", 1.0))),
    ]
    pure = first_versions(states[0][1], at(T1))
    for t, df in states[1:]:
        pure = scd2(pure, df, "seller_id", CHECK, at(t))
    for t, df in [*states, states[-1], states[-1]]:
        take_snapshot(spark, base, df, "seller_id", CHECK, str(t))
    stored = read_history(spark, base)
    key = lambda df: sorted(map(repr, df.select(*pure.columns).collect()))
    assert key(stored) == key(pure)


def states(rows, n):
    """Runs with changes, deletions, returns, nulls and untracked changes."""
    import random

    r, held, out = random.Random(5), {k: ("A", "Goa", 4.0) for k in range(12)}, []
    for i in range(n):
        for k in r.sample(range(15), 3):
            if k in held and r.random() < 0.4:
                del held[k]
            else:
                held[k] = (f"name{i}", r.choice(["Goa", "Pune", None]), r.choice([4.0, 4.1, None]))
        out.append((datetime(2024, 1, 1 + i), rows(S, *[(k, *v) for k, v in sorted(held.items())])))
    return out


def test_ten_runs_of_deltas_equal_the_pure_form_folded_or_not(spark, rows):
    some = states(rows, 10)
    pure = first_versions(some[0][1], at(some[0][0]))
    for t, df in some[1:]:
        pure = scd2(pure, df, "seller_id", CHECK, at(t))
    key = lambda df: sorted(map(repr, df.select(*pure.columns).collect()))
    for fold_after in (3, 100):
        base = scratch_dir(spark, "h")
        for t, df in some:
            take_snapshot(spark, base, df, "seller_id", CHECK, str(t), fold_after=fold_after)
        take_snapshot(spark, base, some[-1][1], "seller_id", CHECK, str(some[-1][0]), fold_after=fold_after)
        assert key(read_history(spark, base)) == key(pure), fold_after
        assert len(_done(spark, f"{base}/opened")) <= fold_after + 1
    kept, some = scratch_dir(spark, "h"), some[:5]
    for t, df in some:
        take_snapshot(spark, kept, df, "seller_id", CHECK, str(t), close_deletes=False, fold_after=3)
    pure = first_versions(some[0][1], at(some[0][0]))
    for t, df in some[1:]:
        pure = scd2(pure, df, "seller_id", CHECK, at(t), close_deletes=False)
    assert key(read_history(spark, kept)) == key(pure)


def test_one_changed_key_writes_one_row(spark, rows, plan):
    base = scratch_dir(spark, "h")
    many = [(k, f"n{k}", "Goa", 4.0) for k in range(500)]
    take_snapshot(spark, base, rows(S, *many), "seller_id", CHECK, str(T1))
    many[7] = (7, "n7", "Pune", 4.0)
    many[9] = (9, "renamed", "Goa", 4.0)  # not a checked column
    take_snapshot(spark, base, rows(S, *many), "seller_id", CHECK, str(T2))
    written = [spark.read.parquet(f"{base}/{kind}/run=2024-02-01T000000").collect() for kind in ("opened", "closed")]
    assert [[r.seller_id for r in part] for part in written] == [[7], [7]]
    scans = plan(_open_keys(spark, base, "2024-02-01T000000", "seller_id"))
    assert "seller_city" not in scans, "attributes are not read to find what changed"


def test_a_run_that_broke_before_its_end_does_not_count(spark, rows):
    base = scratch_dir(spark, "h")
    take_snapshot(spark, base, rows(S, (1, "A", "Goa", 4.0)), "seller_id", CHECK, str(T1))
    take_snapshot(spark, base, rows(S, (1, "A", "Pune", 4.0)), "seller_id", CHECK, str(T2))
    remove_path(spark, f"{base}/runs/run=2024-02-01T000000")  # as if it had stopped before the mark
    assert versions(read_history(spark, base)) == [("Goa", 4.0, T1, None)]
    take_snapshot(spark, base, rows(S, (1, "A", "Delhi", 4.0)), "seller_id", CHECK, str(T3))
    assert versions(read_history(spark, base)) == [("Goa", 4.0, T1, T3), ("Delhi", 4.0, T3, None)]


def test_point_in_time(rows):
    h = first_versions(rows(S, (1, "A", "Goa", 4.0)), at(T2))
    h = scd2(h, rows(S, (1, "A", "Pune", 4.0)), "seller_id", CHECK, at(T3))
    facts = rows("id int, seller_id int, ts timestamp_ntz", (1, 1, T1), (2, 1, T2), (3, 1, T3), (4, 9, T3))
    found = {r.id: r.seller_city for r in as_of(facts, h, "seller_id", "ts", ["seller_city"]).collect()}
    assert found == {1: None, 2: "Goa", 3: "Pune", 4: None}
    early = as_of(facts, h, "seller_id", "ts", ["seller_city"], open_start=True)
    assert {r.id: r.seller_city for r in early.collect()} == {1: "Goa", 2: "Goa", 3: "Pune", 4: None}


@pytest.mark.parametrize("bucket", [60, 86_400, 10**10])
def test_merge_in_time_equals_the_join(rows, bucket):
    h = first_versions(rows(S, (1, "A", "Goa", 4.0), (2, "B", None, 1.0), (None, "N", "Nowhere", 0.0)), at(T1))
    h = scd2(h, rows(S, (1, "A", "Pune", 4.0)), "seller_id", CHECK, at(T2))  # 2 is closed
    h = scd2(h, rows(S, (1, "A", "Goa", 4.0), (2, "B", "Agra", 1.0)), "seller_id", CHECK, at(T3))
    times = [T1 - timedelta(1), T1, T1 + timedelta(seconds=1), T2, T2 + timedelta(3), T3, T3 + timedelta(400), None]
    facts = rows("id int, seller_id int, ts timestamp_ntz, seller_name string",
                 *[(i * 10 + (k or 0), k, t, "fact") for i, t in enumerate(times) for k in (1, 2, 9, None)])
    for open_start in (False, True):
        key = lambda df: sorted(map(repr, df.collect()))
        merged = as_of_merge(facts, h, "seller_id", "ts", ["seller_city"], open_start=open_start, bucket_seconds=bucket)
        joined = as_of(facts, h, "seller_id", "ts", ["seller_city"], open_start=open_start)
        assert merged.columns == joined.columns and key(merged) == key(joined)
    assert as_of_merge(facts.limit(0), h, "seller_id", "ts", ["seller_city"]).count() == 0
    assert as_of_merge(facts, h.limit(0), "seller_id", "ts", ["seller_city"]).where("seller_city is not null").count() == 0


def test_merge_of_a_key_with_very_many_versions(spark, plan):
    """100,000 versions and facts of one key: a join on the key would meet five billion pairs."""
    start = "timestamp_ntz '2024-01-01'"
    versions = spark.range(100_000).selectExpr(
        "1 AS k", f"timestampadd(SECOND, cast(id * 100 AS int), {start}) AS valid_from", "id AS version")
    facts = spark.range(100_000).selectExpr(
        "1 AS k", "id", f"timestampadd(SECOND, cast(id * 100 + id % 100 AS int), {start}) AS ts")
    found = as_of_merge(facts, versions, "k", "ts", ["version"], end=None)
    assert found.where("version <> id or version is null").count() == 0 and found.count() == 100_000
    assert "CartesianProduct" not in plan(found) and "BroadcastNestedLoop" not in plan(found)


def test_history_dimension(warehouse):
    h = first_versions(warehouse.stg_sellers, at(T1))
    dim = seller_history(h)
    assert dim.select("seller_version_key").distinct().count() == dim.count()
    assert dim.filter("not is_current").count() == 0
