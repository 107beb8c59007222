"""Point-in-time lookup as a merge: linear in facts and versions, whatever one key holds of either."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemart.operators.scd2 import FROM, TO

#: where versions without a start begin
EVER = "0001-01-01 00:00:00"


def as_of_merge(
    fact: DataFrame,
    history: DataFrame,
    key: str,
    ts: str,
    attributes: Sequence[str],
    start: str = FROM,
    end: str | None = TO,
    open_start: bool = False,
    bucket_seconds: int = 86_400,
) -> DataFrame:
    """``scd2.as_of`` for keys with many versions: left lookup of the version valid at ``ts``.

    Facts and versions of a key are put in order of time together, and the version last begun is carried
    to the facts after it: one shuffle and one sort of both, where a join on the key would compare each
    fact with each version. Work is cut by key and time bucket, so a key with a third of all rows
    is as many groups as it has buckets; the version a bucket begins with comes from the bucket totals.

    Start inclusive, end exclusive; ``end`` None: a version lasts until the next. Versions of a key
    do not overlap; of those that begin at once the greatest counts. A null start reaches back for ever,
    as does a key's first version with ``open_start``. Facts without key or time find nothing and
    are not shuffled.
    """
    begin = F.coalesce(F.col(start).cast("timestamp_ntz"), F.lit(EVER).cast("timestamp_ntz"))
    known = history.where(F.col(key).isNotNull())
    if open_start:
        firsts = known.groupBy(F.col(key).alias("_fk")).agg(F.min(start).alias("_first"))
        known = known.join(firsts, F.col(key) == F.col("_fk"))
        begin = F.when(F.col(start).eqNullSafe(F.col("_first")), F.lit(EVER).cast("timestamp_ntz")).otherwise(begin)
    until = F.col(end).cast("timestamp_ntz") if end else F.lit(None).cast("timestamp_ntz")
    version = F.struct(until.alias("_until"), *[F.col(a).alias(a) for a in attributes])
    versions = known.select(F.col(key).alias("_k"), begin.alias("_at"), version.alias("_v"))
    kind, empty = versions.schema["_k"].dataType, versions.schema["_v"].dataType
    complete = F.col(key).isNotNull() & F.col(ts).isNotNull()
    facts = fact.where(complete).select(
        F.col(key).cast(kind).alias("_k"), F.col(ts).cast("timestamp_ntz").alias("_at"),
        F.struct(*fact.columns).alias("_f"))
    events = versions.withColumn("_f", F.lit(None).cast(facts.schema["_f"].dataType)).unionByName(
        facts.withColumn("_v", F.lit(None).cast(empty)))
    seconds = F.timestamp_diff("SECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col("_at"))
    events = events.withColumn("_b", F.floor(seconds / bucket_seconds))

    # the last version of each bucket, and of all buckets before one: a row per key and bucket
    last = F.max(F.when(F.col("_v").isNotNull(), F.struct("_at", "_v")))
    earlier = Window.partitionBy("_k").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        events.groupBy("_k", "_b").agg(last.alias("_last"))
        .select(F.col("_k").alias("_ck"), F.col("_b").alias("_cb"), F.last("_last", ignorenulls=True).over(earlier).alias("_before"))
        .where("_before is not null")
    )
    so_far = Window.partitionBy("_k", "_b").orderBy("_at", F.col("_f").isNotNull(), "_v").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    found = (
        events.join(carried, (F.col("_k") == F.col("_ck")) & (F.col("_b") == F.col("_cb")), "left")
        .withColumn("_hit", F.coalesce(F.last("_v", ignorenulls=True).over(so_far), F.col("_before._v")))
        .where("_f is not null")
        .withColumn("_valid", F.col("_hit._until").isNull() | (F.col("_at") < F.col("_hit._until")))
    )
    out = found.select("_f.*", *[F.when(F.col("_valid"), F.col(f"_hit.{a}")).alias(a) for a in attributes])
    types = {f.name: f.dataType for f in empty.fields}
    rest = fact.where(~complete).select("*", *[F.lit(None).cast(types[a]).alias(a) for a in attributes])
    return out.unionByName(rest)
