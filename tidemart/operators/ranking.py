"""Ranks and sequences that never need a whole group, or the whole table, in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_KINDS = {"row_number": F.row_number, "rank": F.rank, "dense_rank": F.dense_rank}


def top_k(df: DataFrame, value: str, ids: Sequence[str], k: int) -> DataFrame:
    """k largest rows by value, ties by id."""
    return df.orderBy(F.col(value).desc_nulls_last(), *[F.col(c) for c in ids]).limit(k)


def top_k_ranked(
    df: DataFrame, value: str, ids: Sequence[str], k: int, rank_col: str, kind: str = "rank"
) -> DataFrame:
    """k largest rows with their rank in the whole table.

    Cut first, rank after: all larger values are inside the cut, so ranks of the prefix
    are ranks of the whole, and the one-task window sees k rows.
    """
    w = Window.orderBy(F.col(value).desc_nulls_last())
    return top_k(df, value, ids, k).withColumn(rank_col, _KINDS[kind]().over(w))


def _before(df: DataFrame, group: str, bucket: str, size: Column, descending: bool) -> DataFrame:
    """(_g, _b, _before): what the earlier buckets of the group hold in total."""
    order = F.col("_b").desc() if descending else F.col("_b").asc()
    earlier = (
        Window.partitionBy("_g").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    )
    totals = df.groupBy(F.col(group).alias("_g"), F.col(bucket).alias("_b")).agg(size.alias("_n"))
    return totals.select("_g", "_b", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))


def bucketed_row_number(
    df: DataFrame, group: str, bucket: str, order: Sequence[str], out: str
) -> DataFrame:
    """row_number() inside ``group``, computed per (group, bucket) plus the rows of earlier buckets.

    ``bucket`` must be a monotonic function of the order. A group of any size then spreads
    over its buckets; only the bucket totals of a group meet in one task.
    """
    # a struct equals another with nulls in the same places: the rows are dealt by it once, for their
    # local number and for meeting the totals, where a null-safe join would deal whole rows again
    place = lambda g, b: F.struct(F.col(g).alias("g"), F.col(b).alias("b")).alias("_at")
    inner = Window.partitionBy("_at").orderBy(*order)
    before = _before(df, group, bucket, F.count("*"), descending=False)
    numbered = df.select("*", place(group, bucket)).withColumn("_local", F.row_number().over(inner))
    return (
        numbered.join(before.select(place("_g", "_b"), "_before"), "_at")
        .withColumn(out, (F.col("_before") + F.col("_local")).cast("int"))
        .drop("_at", "_before", "_local")
    )


def value_buckets(df: DataFrame, group: str, value: str, out: str, buckets: int = 64) -> DataFrame:
    """Add a monotonic bucket number of ``value`` inside each group, cut at approximate quantiles.

    The cuts only balance the work; any cuts give the same ranks.
    """
    points = [i / buckets for i in range(1, buckets)]
    cuts = df.groupBy(F.col(group).alias("_cg")).agg(
        F.percentile_approx(F.col(value).cast("double"), points, 1000).alias("_cuts")
    )
    return (
        df.join(cuts, df[group].eqNullSafe(cuts["_cg"]))
        .withColumn(
            out, F.size(F.filter("_cuts", lambda cut: cut <= F.col(value).cast("double")))
        )
        .drop("_cg", "_cuts")
    )


def rank_in_group(
    df: DataFrame, group: str, value: str, out: str, kind: str = "dense_rank", buckets: int = 64
) -> DataFrame:
    """rank() or dense_rank() by falling value inside each group; null values come last.

    Ranks are worked out on the distinct values of a group, counted map-side and cut into
    value buckets, so neither a large group nor a value most of its rows share gathers in
    one task. The rows then look their rank up.
    """
    step = F.lit(1) if kind == "dense_rank" else F.col("_n")
    values = df.groupBy(F.col(group).alias("_vg"), F.col(value).alias("_v")).agg(
        F.count("*").alias("_n")
    )
    cut = value_buckets(values, "_vg", "_v", "_vb", buckets)
    higher = (
        Window.partitionBy("_vg", "_vb")
        .orderBy(F.col("_v").desc_nulls_last())
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    local = cut.withColumn("_local", F.coalesce(F.sum(step).over(higher), F.lit(0)))
    before = _before(cut, "_vg", "_vb", F.sum(step), descending=True)
    ranks = local.join(
        before, local["_vg"].eqNullSafe(before["_g"]) & local["_vb"].eqNullSafe(before["_b"])
    ).select("_vg", "_v", (F.col("_before") + F.col("_local") + 1).cast("int").alias(out))
    return df.join(
        ranks, df[group].eqNullSafe(ranks["_vg"]) & df[value].eqNullSafe(ranks["_v"])
    ).drop("_vg", "_v")


def moving_average(
    df: DataFrame, order: str, num: str, rows: int
) -> tuple[Column, Column]:
    """(sum, count) of ``num`` over the current and the ``rows`` previous rows.

    Meant for calendar-grained frames, whose length is bounded by the number of days.
    """
    w = Window.orderBy(order).rowsBetween(-rows, 0)
    return F.sum(num).over(w), F.count(num).over(w)
