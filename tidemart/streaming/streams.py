"""File-source streams that run until the data at hand is used up.

Progress lives in the checkpoint, so a restarted query goes on where it stopped and takes
each file once.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from tidemart.operators.incremental import read_watermark, upsert_bucketed, write_watermark
from tidemart.session import path_exists

LATE_BOUND = "3 days"
EVENT_TIME = "_event_time"


def file_stream(
    spark: SparkSession,
    path: str,
    schema,
    files_per_batch: int | None = None,
    fmt: str = "parquet",
    names: str | None = None,
) -> DataFrame:
    """Files of a folder as they arrive; ``names`` is a pattern for their names."""
    reader = spark.readStream.schema(schema).format(fmt)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if names:
        reader = reader.option("pathGlobFilter", names)
    return reader.load(path)


def with_event_time(df: DataFrame, ts: str, late: str) -> DataFrame:
    """Watermarked event time of a local timestamp.

    Watermarks need an instant. The local time is read as UTC whatever the session's zone,
    so that one-day windows are the days of the data.
    """
    micros = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col(ts))
    return df.withColumn(EVENT_TIME, F.timestamp_micros(micros)).withWatermark(EVENT_TIME, late)


def utc_day(instant: Column) -> Column:
    return F.date_from_unix_date(F.floor(F.unix_seconds(instant) / 86400).cast("int"))


def _finish(writer: DataStreamWriter, checkpoint: str) -> None:
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def ingest_new_files(stream: DataFrame, target: str, checkpoint: str) -> None:
    """Append what arrived since the last run to a Parquet table, exactly once."""
    _finish(stream.writeStream.format("parquet").option("path", target), checkpoint)


def dedup_stream(
    stream: DataFrame, keys: Sequence[str], ts: str, late: str = LATE_BOUND
) -> DataFrame:
    """First copy of each key; copies are remembered for the late bound only."""
    marked = with_event_time(stream, ts, late)
    return marked.dropDuplicatesWithinWatermark(list(keys)).drop(EVENT_TIME)


DAY = "event_day"


def dedup_into(
    spark: SparkSession,
    stream: Callable[[], DataFrame],
    keys: Sequence[str],
    ts: str,
    target: str,
    checkpoint: str,
    late: str = LATE_BOUND,
) -> None:
    """Each key once in a table by day, however late its copies arrive.

    Two tiers. Inside the late bound copies are told by the state store, as in ``dedup_stream``; what that
    query takes for too late is lost to it. So a second query over the same files looks at rows behind the
    newest time seen less the bound, and adds those that their day's partition does not hold yet: only
    the partitions of late rows are read, keys alone. Copies of one key are taken to carry one time.

    A batch that is repeated after a break adds nothing: the first one after each start is compared
    with its days' partitions as late rows are. Rows without a time are kept in a partition of their own.
    """
    started: list[int] = []

    def on_time(batch: DataFrame, batch_id: int) -> None:
        batch = _by_day(batch, ts)
        _append_days(batch if started else _not_stored(spark, batch, keys, target), target)
        started.append(batch_id)

    def behind(batch: DataFrame, batch_id: int) -> None:
        newest = batch.agg(F.max(ts)).first()[0]
        mark = max((m for m in (newest, read_watermark(spark, f"{checkpoint}/seen", "rows")) if m), default=None)
        if mark is not None:
            bound = F.lit(str(mark)).cast("timestamp_ntz") - F.expr(f"interval {late}")
            first = Window.partitionBy(*keys).orderBy(ts)
            old = (
                batch.where((F.col(ts) < bound) | F.col(ts).isNull())
                .withColumn("_copy", F.row_number().over(first)).where("_copy = 1").drop("_copy")
            )
            _append_days(_not_stored(spark, _by_day(old, ts), keys, target), target)
            write_watermark(spark, f"{checkpoint}/seen", "rows", mark)

    timed = stream().where(F.col(ts).isNotNull())
    _finish(dedup_stream(timed, keys, ts, late).writeStream.foreachBatch(on_time), f"{checkpoint}/on_time")
    _finish(stream().writeStream.foreachBatch(behind), f"{checkpoint}/behind")


def _by_day(df: DataFrame, ts: str) -> DataFrame:
    return df.withColumn(DAY, F.col(ts).cast("date"))


def _append_days(df: DataFrame, target: str) -> None:
    df.hint("rebalance", F.col(DAY)).write.mode("append").partitionBy(DAY).parquet(target)


def _not_stored(spark: SparkSession, batch: DataFrame, keys: Sequence[str], target: str) -> DataFrame:
    """Rows whose key their day's partition does not hold."""
    if not path_exists(spark, target):
        return batch
    days = [r[0] for r in batch.select(DAY).distinct().collect()]  # a row per day
    stored = spark.read.schema(batch.schema).parquet(target).where(
        F.col(DAY).isin([d for d in days if d is not None]) | (F.col(DAY).isNull() & F.lit(None in days)))
    same = [batch[c].eqNullSafe(stored[c]) for c in (*keys, DAY)]
    return batch.join(stored.select(*keys, DAY), reduce(lambda a, b: a & b, same), "left_anti")


def daily_rollup(stream: DataFrame, ts: str, value: str, late: str = LATE_BOUND) -> DataFrame:
    """Count and total per day."""
    return (
        with_event_time(stream, ts, late)
        .groupBy(F.window(EVENT_TIME, "1 day").alias("w"))
        .agg(F.count("*").alias("events"), F.sum(value).alias("total"))
        .select(utc_day(F.col("w.start")).alias("day"), "events", "total")
    )


def append_closed(rollup: DataFrame, target: str, checkpoint: str) -> None:
    """Write windows once they can no longer change."""
    writer = rollup.writeStream.outputMode("append").format("parquet").option("path", target)
    _finish(writer, checkpoint)


def upsert_updates(
    spark: SparkSession, rollup: DataFrame, keys: Sequence[str], target: str, checkpoint: str, buckets: int = 16
) -> None:
    """Keep a mart current: every changed group replaces its row. Repeating a batch is harmless.

    The mart is bucketed by its key (``incremental.read_bucketed`` reads it), so a micro-batch rewrites
    the buckets of its own groups only.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        upsert_bucketed(spark, target, batch, keys, buckets)

    _finish(rollup.writeStream.outputMode("update").foreachBatch(apply), checkpoint)
