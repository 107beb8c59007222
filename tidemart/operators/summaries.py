"""Aggregations that recur across models."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sum_if(condition: Column, value: Column) -> Column:
    """sum(value) filter (where condition)."""
    return F.sum(F.when(condition, value))


def strongest(status: Column, precedence: Sequence[str], default: str) -> Column:
    """First status of ``precedence`` that any row of the group has."""
    out = F.when(F.lit(False), F.lit(default))
    for value in precedence:
        out = out.when(F.bool_or(status == value), F.lit(value))
    return out.otherwise(F.lit(default))


def weighted_mean_parts(mean: Column, weight: Column) -> tuple[Column, Column]:
    """(sum of mean*weight, sum of weight) for a mean over groups of unequal size."""
    return F.sum(mean * weight), F.sum(weight)


def distinct_union(left: DataFrame, right: DataFrame) -> DataFrame:
    """Set union."""
    return left.union(right).distinct()
