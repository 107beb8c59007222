"""Windows over a whole ordered table, in as many tasks as its rows need.

``Window.orderBy`` without a partition puts all rows into one task. Here the rows are dealt to parts by ranges
of the order; a part gets as its halo the last rows before it, and running totals start from what earlier
parts sum up to. Per part, one row of counts and totals passes through the driver: MAX_PARTS at most.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tidemart.session import Scratch

PART, HALO = "_part", "_halo"
MAX_PARTS = 10_000


def over_order(
    df: DataFrame,
    order: Sequence[str],
    exprs: Mapping[str, Callable[[WindowSpec], Column]],
    back: int,
    totals: Mapping[str, str] | None = None,
    rows_per_part: int = 1_000_000,
) -> DataFrame:
    """``df`` with columns worked out over all its rows in one order.

    ``exprs`` gives each new column over a window it is handed, looking back ``back`` rows at most
    (``lag``, or a frame of preceding rows); ``totals`` names running totals and the columns they sum, up to
    and with the row itself (null values count nothing). ``order`` is total: rows that agree in all of it
    may come in any order. Nulls come first. An empty table stays empty.

    The dealt rows are written once, as the cuts are drawn from a sample and must stay the same; the
    result is written as well, so that the dealt rows can go.
    """
    spark, totals = df.sparkSession, dict(totals or {})
    with Scratch(spark, "range-parts") as scratch:
        parts = min(MAX_PARTS, 1 + df.count() // rows_per_part)
        # cut on all order columns, so a value that many rows share is cut by the next column
        dealt = scratch.keep(df.repartitionByRange(parts, *order).withColumn(PART, F.spark_partition_id()), "dealt")
        held = dealt.groupBy(PART).agg(F.count("*").alias("_n"), *[F.sum(c).alias(t) for t, c in totals.items()])
        kinds = {t: held.schema[t].dataType.simpleString() for t in totals}
        rows = held.orderBy(PART).collect()

        follow, before, so_far = [], [], dict.fromkeys(totals)
        for i, r in enumerate(rows):
            before.append((r[PART], *so_far.values()))
            so_far = {t: r[t] if v is None else v if r[t] is None else v + r[t] for t, v in so_far.items()}
            gap = 0  # rows between the end of this part and a later one's start
            for later in rows[i + 1 :]:
                if gap >= back:
                    break
                follow.append((r[PART], later[PART], back - gap))
                gap += later["_n"]

        own = dealt.withColumn(HALO, F.lit(False))
        if follow:
            last = Window.partitionBy(PART).orderBy(*[F.col(c).desc() for c in order])
            tails = dealt.withColumn("_from_end", F.row_number().over(last)).where(F.col("_from_end") <= back)
            to = spark.createDataFrame(follow, f"{PART} int, _to int, _need int")
            halo = tails.join(F.broadcast(to), PART).where("_from_end <= _need")
            own = own.unionByName(halo.select(*df.columns, F.col("_to").alias(PART), F.lit(True).alias(HALO)))
        window = Window.partitionBy(PART).orderBy(*order)
        found = own.withColumns({name: make(window) for name, make in exprs.items()}).where(~F.col(HALO))
        if totals:
            frame = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
            found = found.withColumns({t: F.sum(c).over(frame) for t, c in totals.items()})
            schema = ", ".join([f"{PART} int", *[f"_before_{t} {kind}" for t, kind in kinds.items()]])
            found = found.join(F.broadcast(spark.createDataFrame(before, schema)), PART).withColumns({
                t: F.coalesce(F.col(t) + F.col(f"_before_{t}"), F.col(t), F.col(f"_before_{t}")).cast(kinds[t])
                for t in totals
            })
        return Scratch(spark, "range-windows").keep(found.select(*df.columns, *exprs, *totals), "found")
