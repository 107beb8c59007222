"""Splits that set rows aside instead of dropping them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REASONS = "quarantine_reasons"


def reasons_of(conditions: dict[str, Column]) -> Column:
    """Array of the names of the conditions that hold; a null condition does not hold."""
    return F.array_compact(
        F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in conditions.items()])
    )


def split_quarantine(
    df: DataFrame, conditions: dict[str, Column]
) -> tuple[DataFrame, DataFrame]:
    """(clean, quarantined with reasons); every input row is in exactly one of them."""
    bad = reduce(
        lambda a, b: a | b, [F.coalesce(c, F.lit(False)) for c in conditions.values()]
    )
    return df.filter(~bad), df.filter(bad).withColumn(REASONS, reasons_of(conditions))


def with_parent(child: DataFrame, parent: DataFrame, on: str) -> DataFrame:
    """Children whose key exists in parent."""
    return child.join(parent.select(on), on, "left_semi")


def without_parent(child: DataFrame, parent: DataFrame, on: str) -> DataFrame:
    """Children whose key is missing in parent."""
    return child.join(parent.select(on), on, "left_anti")


def split_orphans(child: DataFrame, parent: DataFrame, on: str) -> tuple[DataFrame, DataFrame]:
    """(children with a parent, orphans)."""
    return with_parent(child, parent, on), without_parent(child, parent, on)
