"""Shards by extendible hashing: a bucket splits on one more bit of the key's hash if it is too large.

A shard is a prefix of hash bits. The empty prefix is the first bucket; a bucket whose records exceed
the byte limit is split on its next bit, others stay whole, until every shard fits. Since bytes only
fall along a prefix, a row's shard is its shortest prefix that fits. It is read from a directory
indexed by a fixed number of bits, a few more than an even split needs; only rows of entries that
are still too large go to the next round, with a longer index.

A key whose rows exceed the limit cannot be split by its own hash. Such rows are told apart by
a hash of key, content and, for identical rows, a copy number, and split on with its bits.

Defined cases: null keys hash as the text `null`. Null text counts no bytes. A single record larger than
the limit is a shard of its own, flagged. Repeated rows are all kept. An empty table has no shards.
Key and text are read; other columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from math import ceil, log2

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemart.session import Scratch

BITS = 60  # of a hash: 15 hexadecimal digits


@dataclass(frozen=True)
class ShardParams:
    limit_bytes: int = 16 << 20
    #: bits of the directory beyond those an even split needs, and bits added in later rounds
    spare_bits: int = 3
    more_bits: int = 8


def _hash(text: Column) -> Column:
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, BITS // 4), 16, 10).cast("long")


def _key_text(keys: Sequence[str]) -> Column:
    return F.concat_ws("\x1f", *[F.coalesce(F.col(k).cast("string"), F.lit("null")) for k in keys])


def _name(prefix: Column, depth: Column, before: Column) -> Column:
    bits = F.when(depth > 0, F.lpad(F.conv(prefix, 10, 2), depth, F.lit("0"))).otherwise("")
    return F.concat(before, bits)


def _round(rows: DataFrame, known: int, index: int, limit: int) -> DataFrame:
    """Directory of one round over rows (h, before, n_bytes): for each prefix of ``index`` bits, the
    shard that covers it, or null if it is too large at that depth. ``known`` bits are split already."""
    entry = F.shiftright("h", BITS - index)
    counts = rows.groupBy("before", entry.alias("entry")).agg(F.sum("n_bytes").alias("bytes"), F.count("*").alias("n"))
    depths = F.sequence(F.lit(known), F.lit(index))
    prefixes = (
        counts.withColumn("depth", F.explode(depths))
        .withColumn("prefix", F.expr(f"shiftright(entry, {index} - depth)"))
    )
    fitting = (
        prefixes.groupBy("before", "depth", "prefix").agg(F.sum("bytes").alias("bytes"), F.sum("n").alias("n"))
        .where((F.col("bytes") <= limit) | (F.col("n") == 1))
    )
    return (
        prefixes.select("before", "entry", "depth", "prefix").join(fitting, ["before", "depth", "prefix"])
        .groupBy("before", "entry").agg(F.min(F.struct("depth", "prefix", "bytes", "n")).alias("shard"))
    )


def _split(rows: DataFrame, index: int, params: ShardParams, scratch: Scratch, label: str) -> tuple[DataFrame | None, DataFrame]:
    """(rows with their shard, rows that BITS bits leave in too large buckets)."""
    done, known = None, 0
    while True:
        directory = scratch.keep(_round(rows, known, index, params.limit_bytes), f"{label}-{index}")
        dealt = (
            rows.withColumn("entry", F.shiftright("h", BITS - index))
            .join(directory, ["before", "entry"], "left").drop("entry")
        )
        found = dealt.where(F.col("shard").isNotNull()).select(
            "doc_id", "n_bytes", "content", "key", _name(F.col("shard.prefix"), F.col("shard.depth"), F.col("before")).alias("shard"),
            F.col("shard.bytes").alias("shard_bytes"), F.col("shard.n").alias("shard_rows"))
        done = found if done is None else done.unionAll(found)
        rows = scratch.keep(dealt.where(F.col("shard").isNull()).drop("shard"), f"{label}-left-{index}")
        if index == BITS or rows.isEmpty():
            return done, rows
        known, index = index + 1, min(BITS, index + params.more_bits)


def shard(docs: DataFrame, params: ShardParams = ShardParams(), keys: Sequence[str] = ("doc_id",)) -> DataFrame:
    """(doc_id, n_bytes, shard, shard_bytes, shard_rows, oversized), one row per row of ``docs``.

    ``shard`` is `b` and the bits of the prefix. Rows that share a key share a shard unless the key
    alone exceeds the limit.
    """
    return _assigned(docs, params, keys).drop("content", "key")


def _identity(keys: Sequence[str]) -> tuple[Column, Column]:
    """Hashes of a row's text and of its key."""
    return F.xxhash64("text"), _hash(_key_text(keys))


def _assigned(docs: DataFrame, params: ShardParams, keys: Sequence[str]) -> DataFrame:
    """What shard() returns and the hashes of text and key, (content, key)."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "shards")
    n_bytes = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    content, key = _identity(keys)
    rows = scratch.keep(docs.select(
        "doc_id", n_bytes.alias("n_bytes"), content.alias("content"), key.alias("key"), key.alias("h"),
        F.lit("b").alias("before")), "rows")
    total = rows.agg(F.sum("n_bytes")).first()[0] or 0
    even = ceil(log2(max(1.0, total / params.limit_bytes)))
    done, left = _split(rows, min(BITS, even + params.spare_bits), params, scratch, "key")
    if not left.isEmpty():
        bits = F.lpad(F.conv("h", 10, 2), BITS, "0")
        copies = (
            left.groupBy("doc_id", "content", "key", "h", "before", "n_bytes").agg(F.count("*").alias("copies"))
            .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
            .select("doc_id", "n_bytes", "content", "key", F.concat("before", bits, F.lit(".")).alias("before"),
                    _hash(F.concat_ws("\x1f", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), "content", "copy")).alias("h"))
        )
        more, stuck = _split(scratch.keep(copies, "copies"), params.more_bits, params, scratch, "row")
        last = stuck.select("doc_id", "n_bytes", "content", "key", F.concat("before", F.lpad(F.conv("h", 10, 2), BITS, "0")).alias("shard"),
                            F.col("n_bytes").alias("shard_bytes"), F.lit(1).cast("long").alias("shard_rows"))
        done = done.unionAll(more).unionAll(last)
    return done.withColumn("oversized", F.col("shard_bytes") > params.limit_bytes)


#: rows that one task numbers among rows of the same id and text
RUN = 1 << 16


def write_shards(docs: DataFrame, path: str, params: ShardParams = ShardParams(), keys: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Writes the rows of ``docs`` below ``path``, one folder per shard, and returns the assignment.

    Each row is written once, in the shard of its key and text. Rows that share id, key and text and that
    were split over several shards are numbered, in runs, and take the shards' places in turn. Rows of
    one shard are written together. The folders are named by a column `shard`, with underscores before it
    if the table has one of that name.
    """
    spark = docs.sparkSession
    column, mark = "shard", "_placed"
    while column in docs.columns:
        column = f"_{column}"
    while any(c.startswith(mark) for c in docs.columns):
        mark = f"_{mark}"
    own = [f"{mark}_{n}" for n in ("id", "content", "key")]
    run, at, copy, n = (f"{mark}_{n}" for n in ("run", "at", "copy", "n"))
    scratch = Scratch(spark, "written")
    assigned = scratch.keep(_assigned(docs, params, keys).select("doc_id", "content", "key", "shard"), "assigned")
    identity = lambda content, key: [
        c.alias(name) for c, name in zip((_key_text(["doc_id"]), content, key), own)]
    places = (
        assigned.select(*identity(F.col("content"), F.col("key")), F.col("shard").alias(column))
        .groupBy(*own, column).agg(F.count("*").alias(n))
    )
    homes = places.groupBy(*own).agg(F.min(column).alias(column), F.max(column).alias(f"{mark}_last"))
    rows = docs.select("*", *identity(*_identity(keys))).join(homes, own)
    split = F.col(column) != F.col(f"{mark}_last")
    whole = rows.where(~split).select(*docs.columns, column)
    # kept, so that a row's number is the same whenever it is read
    many = scratch.keep(
        rows.where(split).select(*docs.columns, *own, F.monotonically_increasing_id().alias(at))
        .withColumn(run, F.floor(F.col(at) / RUN)), "many")
    before = Window.partitionBy(*own).orderBy(run).rowsBetween(Window.unboundedPreceding, -1)
    runs = many.groupBy(*own, run).agg(F.count("*").alias(n)).select(
        *own, run, F.coalesce(F.sum(n).over(before), F.lit(0)).alias(n))
    numbered = (
        many.withColumn(copy, F.row_number().over(Window.partitionBy(*own, run).orderBy(at)))
        .join(runs, [*own, run]).withColumn(copy, F.col(copy) + F.col(n)).drop(n, run, at)
    )
    until = Window.partitionBy(*own).orderBy(column).rowsBetween(Window.unboundedPreceding, 0)
    slots = (
        places.join(homes.where(split).select(*own), own).withColumn(at, F.sum(n).over(until))
        .select(*own, column, F.explode(F.sequence(F.col(at) - F.col(n) + 1, F.col(at))).alias(copy))
    )
    dealt = numbered.join(slots, [*own, copy]).select(*docs.columns, column)
    whole.unionAll(dealt).repartition(column).write.mode("overwrite").partitionBy(column).parquet(path)
    return assigned.select("doc_id", "shard")
