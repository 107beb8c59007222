"""Windows by parts against the window over everything."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemart.operators.range_windows import over_order

EXPRS = {
    "previous": lambda w: F.lag("v").over(w),
    "third_last": lambda w: F.lag("v", 3, -1).over(w),
    "moving": lambda w: F.sum("v").over(w.rowsBetween(-4, 0)),
}


@pytest.mark.parametrize("rows_per_part", [1, 2, 7, 60, 10**6])
def test_parts_of_any_size(rows, rows_per_part):
    data = [(i * i % 37 if i % 9 else None, i, i % 5 if i % 4 else None) for i in range(120)]
    data += [(20, 1000 + i, 1) for i in range(60)]  # a value that many rows share
    df = rows("at int, id int, v int", *data)
    found = over_order(df, ["at", "id"], EXPRS, 4, {"total": "v"}, rows_per_part)
    w = Window.orderBy("at", "id")
    whole = df.withColumns({n: make(w) for n, make in EXPRS.items()} | {
        "total": F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0))})
    assert found.columns == whole.columns
    assert sorted(map(repr, found.collect())) == sorted(map(repr, whole.collect()))


def test_one_row_and_none(rows):
    df = rows("at int, id int, v int", (1, 1, None))
    assert over_order(df, ["at"], EXPRS, 4, {"total": "v"}).first().total is None
    assert over_order(df.limit(0), ["at"], EXPRS, 4, {"total": "v"}).count() == 0
