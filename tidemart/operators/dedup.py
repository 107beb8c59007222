"""Keep one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemart.functions.keys import row_hash

#: begins the names of columns a job carries beside a row's own; they settle no ties
CARRIED = "__"


def latest_first(columns: Sequence[str]) -> list[Column]:
    return [F.col(c).desc_nulls_last() for c in columns]


def dedup_latest(
    df: DataFrame,
    keys: Sequence[str],
    order_cols: Sequence[str],
    tiebreak: Sequence[str] | None = None,
) -> DataFrame:
    """The latest row per key; ties fall to ``tiebreak``, by default a hash of the other columns.

    Filtering on row_number()=1 lets Spark cut every key to one row before the shuffle
    (WindowGroupLimit), so a key with very many copies never meets in one task.
    """
    order = latest_first(order_cols)
    if tiebreak is None:
        rest = [c for c in df.columns if c not in keys and c not in order_cols and not c.startswith(CARRIED)]
        order += [row_hash(rest).desc()] if rest else []
    else:
        order += latest_first(tiebreak)
    w = Window.partitionBy(*keys).orderBy(*(order or [F.lit(1)]))
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def top_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row of each group in the given order."""
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")
