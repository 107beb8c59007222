import hashlib
from collections import Counter
from datetime import date, datetime
from decimal import Decimal as D
from fractions import Fraction

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemart.functions import dates, keys, ratio, text
from tidemart.plans import star


def one(df, column):
    return [r[0] for r in df.select(column).collect()]


def test_exact_ratio_rounds_half_away_from_zero(rows):
    df = rows("n long, d long", (1005, 1000), (-1005, 1000), (1, 3), (2, 3), (5, 0), (None, 2), (1, -8))
    out = one(df, ratio.exact_ratio(F.col("n"), F.col("d"), 2))
    assert out == [D("1.01"), D("-1.01"), D("0.33"), D("0.67"), None, None, D("-0.13")]


def test_exact_ratio_with_decimal_inputs(rows):
    df = rows("n decimal(18,2), d decimal(18,4)", (D("10.05"), D("2.0000")), (D("0.01"), D("0.0300")))
    out = one(df, ratio.exact_ratio(F.col("n"), F.col("d"), 1, num_scale=2, den_scale=4))
    assert out == [D("5.0"), D("0.3")]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(-10**12, 10**12), st.integers(1, 10**9)), min_size=1, max_size=60))
def test_exact_ratio_matches_fractions(spark, pairs):
    df = spark.createDataFrame(pairs, "n long, d long")
    for (n, d), got in zip(pairs, one(df, ratio.exact_ratio(F.col("n"), F.col("d"), 3))):
        scaled = abs(Fraction(n * 1000, d))
        digits = int(scaled + Fraction(1, 2))
        assert got == D(digits if n >= 0 else -digits).scaleb(-3)


def test_safe_and_nullif_divide(rows):
    df = rows("n int, d int", (6, 4), (6, 0), (6, None), (None, 3))
    assert one(df, ratio.safe_divide(F.col("n"), F.col("d"))) == [1.5, 0.0, 0.0, None]
    assert one(df, ratio.nullif_divide(F.col("n"), F.col("d"))) == [1.5, None, None, None]


def test_money_reads_text_and_drops_garbage(rows):
    assert one(rows("x string", ("12.345",), ("abc",), (None,)), ratio.money(F.col("x"))) == [
        D("12.35"), None, None,
    ]


@pytest.mark.parametrize(
    "given_, expected",
    [("BANGALORE", "Bengaluru"), (" Bengaluru ", "Bengaluru"), ("New Delhi", "Delhi"),
     ("pune", "Pune"), ("  ", ""), (None, None), ("navi mumbai", "Navi Mumbai")],
)
def test_city(rows, given_, expected):
    assert one(rows("x string", (given_,)), text.standard_city(F.col("x"))) == [expected]


def test_payment_status(rows):
    df = rows("x string", ("PAID",), ("success",), ("in_process",), ("declined",), (" Reversed",), ("???",), (None,))
    assert one(df, text.standard_payment_status(F.col("x"))) == [
        "paid", "paid", "pending", "failed", "refunded", "unknown", "unknown",
    ]


def test_category(rows):
    df = rows("x string", ("HOME AND KITCHEN",), (" Fashion ",), ("toys & baby",), ("Sports  and  Fitness",), (None,))
    assert one(df, text.standard_category(F.col("x"))) == [
        "Home & Kitchen", "Fashion", "Toys & Baby", "Sports & Fitness", None,
    ]


def test_blank_to_unknown(rows):
    df = rows("x string", ("  ",), ("",), (None,), (" Goa ",))
    assert one(df, text.blank_to_unknown(F.col("x"))) == ["Unknown"] * 3 + ["Goa"]


def test_times_that_do_not_parse_are_null(rows):
    df = rows("x string", ("2024-02-30",), ("garbage",), ("2024-01-31 10:00:00",), (None,))
    assert one(df, dates.parse_ts(F.col("x"))) == [None, None, datetime(2024, 1, 31, 10), None]


def test_date_parts(rows):
    df = rows("x date", (date(2024, 3, 31),), (date(2024, 4, 1),))
    x = F.col("x")
    assert one(df, dates.date_key(x)) == [20240331, 20240401]
    assert one(df, dates.fiscal_year(x)) == [2023, 2024]
    assert one(df, dates.month_start(x)) == [date(2024, 3, 1), date(2024, 4, 1)]
    assert one(df, dates.month_gap(F.lit("2023-01-01").cast("date"), x)) == [14, 15]


def test_whole_days_elapsed_are_not_calendar_days(rows):
    df = rows("a timestamp_ntz, b timestamp_ntz",
              (datetime(2024, 1, 1, 23), datetime(2024, 1, 3, 1)),
              (datetime(2024, 1, 3), datetime(2024, 1, 2, 12)))
    assert one(df, dates.whole_days_elapsed(F.col("a"), F.col("b"))) == [1, -1]
    assert one(df, dates.days_between(F.col("a"), F.col("b"))) == [2, -1]


def test_surrogate_key_tells_null_from_text(rows):
    df = rows("a string, b string", ("x", None), ("x", "null"), ("x", None))
    a, b, c = one(df, keys.surrogate_key(F.col("a"), F.col("b")))
    assert a == c != b


def test_batch_digest_ignores_order_but_not_copies(rows):
    schema = "a int, b string"
    digest = lambda *d: keys.batch_digest(rows(schema, *d)).first()
    assert digest((1, "x"), (2, "y")) == digest((2, "y"), (1, "x"))
    assert digest((1, "x"), (2, "y")) != digest((1, "x"), (2, "y"), (2, "y"), (2, "y"))
    assert digest((1, "x")) != digest((1, None))


def test_region_ignores_casing_and_weight_band_of_null_is_heavy(rows):
    states = rows("x string", ("Jammu And Kashmir",), ("Kerala",), ("Nagaland",), ("Unknown",))
    assert one(states, star.region_of(F.col("x"))) == ["North", "South", "Other", "Other"]
    grams = rows("x int", (499,), (500,), (4999,), (5000,), (None,))
    assert one(grams, star.weight_band(F.col("x"))) == ["Light", "Medium", "Medium", "Heavy", "Heavy"]


def test_tree_digest_is_blind_to_order_only(rows, monkeypatch):
    df = rows("a string, b int", *[(None if i % 3 else f"v{i}", i % 40) for i in range(200)])
    digests = set()
    for leaf in (1, 20, 4096):
        monkeypatch.setattr(keys, "LEAF_ROWS", leaf)
        forms = [df, df.repartition(5), df.orderBy("b").select("b", "a"), df.coalesce(1)]
        same = {keys.tree_digest(f) for f in forms}
        assert len(same) == 1 and same.copy().pop()[0] == 200
        others = [df.limit(199), df.unionAll(df.limit(1)), df.withColumnRenamed("a", "c"),
                  df.selectExpr("cast(b AS string) AS a", "b"), df.selectExpr("coalesce(a, '') AS a", "b")]
        digests = {keys.tree_digest(f)[1] for f in others}
        assert len(digests) == 5 and same.pop()[1] not in digests
    none = df.limit(0)
    assert keys.tree_digest(none)[0] == 0 and keys.tree_digest(none)[1] != keys.tree_digest(none.withColumnRenamed("a", "c"))[1]


def test_tree_digest_shuffles_bytes_and_keeps_its_value(rows, monkeypatch):
    """Row digests travel as 32 bytes; the digest is the one that their hexadecimal text gives."""
    data = [(f"v{i}", i % 7) for i in range(60)] + [("v0", 0)] * 3
    df = rows("a string, b int", *data)
    row_digests = keys.row_digests(df)
    assert dict(row_digests.dtypes) == {"d": "binary", "n": "bigint"}
    assert {len(r.d) for r in row_digests.collect()} == {32} and row_digests.count() == 60
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    copies = Counter(sha('{"a":"%s","b":%d}' % r) for r in data)
    monkeypatch.setattr(keys, "LEAF_ROWS", 20)  # one level of ranges below the root
    leaves = {}
    for d, n in sorted(copies.items()):
        leaves.setdefault(d[0], []).append(f"{d}:{n}")
    nodes = sorted(f"{p}:{sha(','.join(e))}" for p, e in leaves.items())
    root = ":" + sha(",".join(nodes))
    assert keys.tree_digest(df) == (63, sha("\x1f".join(["a", "b", "63", root])))


def test_tree_digest_counts_rows_in_the_tree(rows, monkeypatch):
    """Whatever number is expected, the digest is the one of rows counted beforehand."""
    monkeypatch.setattr(keys, "LEAF_ROWS", 4)
    df = rows("a string, b int", *[(f"v{i % 50}", i % 7) for i in range(90)], ("v1", 1), ("v1", 1))
    counted = keys.tree_digest(df)
    assert counted[0] == 92
    monkeypatch.setattr(type(df), "count", lambda self: 1 / 0)
    assert {keys.tree_digest(df, expected) for expected in (0, 3, 60, 92, 5000)} == {counted}
