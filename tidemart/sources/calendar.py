"""Date spines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _days(first: Column, last: Column) -> Column:
    return F.explode(F.sequence(first, last, F.expr("interval 1 day"))).alias("full_date")


def date_spine(spark: SparkSession, first: str, last: str) -> DataFrame:
    """One row per day, both ends included."""
    return spark.range(1).select(_days(F.lit(first).cast("date"), F.lit(last).cast("date")))


def spine_over(df: DataFrame, col: str) -> DataFrame:
    """One row per day of all calendar years the column touches, so that no date misses.

    At most one row per day of the years 1 to 9999, whatever the size of ``df``.
    """
    span = df.agg(F.min(col).alias("a"), F.max(col).alias("b"))
    return span.filter("a is not null").select(
        _days(F.make_date(F.year("a"), F.lit(1), F.lit(1)),
              F.make_date(F.year("b"), F.lit(12), F.lit(31)))
    )
