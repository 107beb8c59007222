"""Connected components by alternating stars, as joins and group-bys over an edge table.

Each step replaces the edges by as many or fewer edges that join the same components: every node
is tied to the least node it sees, first from its larger neighbours, then from its smaller ones.
The number of steps grows with the logarithm of the longest path. Each step is written to the
shared scratch folder, so a lost executor costs that step only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.session import Scratch, remove_path


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return (
        both.join(least, "a").where((F.col("b") > F.col("a")) & (F.col("b") != F.col("m")))
        .select(F.col("b").alias("a"), F.col("m").alias("b"))
    )


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").where(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionAll(least.select("a", F.col("m").alias("b"))).distinct()


def _unsettled(edges: DataFrame) -> bool:
    """Is any node tied to two others, or both tied and tied to? Stars have neither."""
    ends = edges.select(F.explode(F.array(
        F.struct(F.col("a").alias("node"), F.lit(1).alias("tied"), F.lit(0).alias("centre")),
        F.struct(F.col("b").alias("node"), F.lit(0).alias("tied"), F.lit(1).alias("centre")),
    )).alias("end")).select("end.*")
    seen = ends.groupBy("node").agg(F.sum("tied").alias("tied"), F.max("centre").alias("centre"))
    return not seen.where(F.col("tied") + F.col("centre") > 1).isEmpty()


def components(edges: DataFrame, scratch: Scratch, label: str = "components") -> DataFrame:
    """(node, component) for every node of an edge; component is the least node reachable.

    ``edges`` has two columns a, b of one orderable type. Rows with a null end or equal ends
    join nothing; nodes without a true edge are not returned. No edges: no rows.
    """
    spark = edges.sparkSession
    proper = edges.where(F.col("a") != F.col("b"))
    current = scratch.keep(
        proper.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), f"{label}-0")
    step = 0
    while _unsettled(current):
        step += 1
        following = scratch.keep(_small_star(_large_star(current)), f"{label}-{step}")
        remove_path(spark, f"{scratch.base}/{label}-{step - 1}")
        current = following
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(
        current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
