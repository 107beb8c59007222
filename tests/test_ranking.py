import random
from collections import defaultdict

import pytest

from tidemart.operators.ranking import bucketed_row_number, rank_in_group, top_k_ranked


def expected(data, kind):
    """Brute-force rank per group, largest value first, nulls last."""
    groups = defaultdict(list)
    for g, i, v in data:
        groups[g].append((v, i))
    out = {}
    for g, items in groups.items():
        values = [v for v, _ in items]
        for v, i in items:
            larger = [x for x in values if x is not None and (v is None or x > v)]
            out[i] = 1 + (len(set(larger)) if kind == "dense_rank" else len(larger))
    return out


def skewed(n=900, seed=5):
    rng = random.Random(seed)
    return [
        ("hot" if rng.random() < 0.6 else f"g{rng.randrange(5)}" if rng.random() < 0.9 else None,
         i, None if rng.random() < 0.05 else rng.randrange(60))
        for i in range(n)
    ]


@pytest.mark.parametrize("kind", ["rank", "dense_rank"])
@pytest.mark.parametrize("buckets", [2, 16])
def test_rank_in_group_equals_brute_force(spark, kind, buckets):
    data = skewed()
    df = spark.createDataFrame(data, "g string, i int, v int")
    ranked = rank_in_group(df, "g", "v", "r", kind, buckets)
    got = {r.i: r.r for r in ranked.collect()}
    assert got == expected(data, kind)


def test_bucketed_row_number_is_one_sequence(spark):
    data = [(1 if i % 3 else 2, i // 50, i * 7 % 150, i) for i in range(600)]
    df = spark.createDataFrame(data, "g int, day int, ts int, id int")
    got = {r.id: r.n for r in bucketed_row_number(df, "g", "day", ["day", "ts", "id"], "n").collect()}
    for g in (1, 2):
        order = [id_ for *_, id_ in sorted(d for d in data if d[0] == g)]
        assert [got[i] for i in order] == list(range(1, len(order) + 1))


def test_windows_see_distinct_values_by_bucket_only(spark, plan):
    df = spark.createDataFrame(skewed(100), "g string, i int, v int")
    text = plan(rank_in_group(df, "g", "v", "r"))
    windows = [w for w in text.splitlines() if "Window [" in w]
    by_value = [w for w in windows if "_v#" in w]
    assert len(by_value) == 1 and "_vb#" in by_value[0].rsplit("], [", 2)[1]
    assert not any("i#" in w for w in windows), "no row of the input is sorted in a window"


def test_rank_of_prefix_is_rank_of_whole(spark, plan):
    data = [(i, v) for i, v in enumerate([5, 9, 9, 7, 7, 7, 3, 1])]
    df = spark.createDataFrame(data, "id int, v int")
    top = top_k_ranked(df, "v", ["id"], 4, "r", "rank")
    assert [(r.id, r.r) for r in top.orderBy("r", "id").collect()] == [(1, 1), (2, 1), (3, 3), (4, 3)]
    assert "TakeOrderedAndProject" in plan(top)
    dense = top_k_ranked(df, "v", ["id"], 7, "r", "dense_rank")
    assert [r.r for r in dense.orderBy("r", "id").collect()] == [1, 1, 2, 2, 2, 3, 4]


def test_rows_are_dealt_once_for_their_number_in_a_group(rows, plan):
    """Also with nulls, whose rows form a group and a bucket of their own."""
    data = [(1, 1, 5), (1, 1, 3), (1, 2, 1), (None, 1, 2), (None, None, 4), (None, None, 1), (2, None, 7), (2, 1, 9)]
    df = rows("g int, b int, v int", *data)
    out = bucketed_row_number(df, "g", "b", ["v"], "n")
    got = sorted(((r.g, r.b, r.v, r.n) for r in out.collect()), key=str)
    seen = lambda g, b, v: sum(
        1 for x, y, z in data if x == g and ((y is not None, y or 0, z) <= (b is not None, b or 0, v)))
    assert got == sorted(((g, b, v, seen(g, b, v)) for g, b, v in data), key=str)
    assert out.columns == ["g", "b", "v", "n"]
    whole = plan(out).split("== Initial Plan ==")[-1]
    assert whole.count("Exchange hashpartitioning") <= 4, whole  # rows; totals by place, by group, by place again
