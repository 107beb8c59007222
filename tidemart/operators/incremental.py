"""Watermarks, look-back windows and idempotent upserts on Parquet tables."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime, timedelta
from functools import reduce
from urllib.parse import quote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.functions.dates import parse_ts
from tidemart.session import PACKED, Scratch, leaf_folders, move_folder, path_exists, remove_path
from tidemart.sinks.runlog import FOLD_AT, create_if_absent, drop_entries, entries

# ------------------------------------------------------------------ watermark


MARK = "%Y-%m-%dT%H-%M-%S.%f"


def _marks(spark: SparkSession, folder: str) -> dict[str, datetime]:
    """File names of a log of marks; a name says its mark, so reading a log is listing it."""
    return {n: datetime.strptime(n.removeprefix("mark="), MARK) for n in entries(spark, folder) if n.startswith("mark=")}


def read_watermark(spark: SparkSession, path: str, name: str):
    """Highest value recorded under ``name``, or None before the first run."""
    return max(_marks(spark, f"{path}/{name}").values(), default=None)


def write_watermark(
    spark: SparkSession, path: str, name: str, mark, restart: bool = False
) -> None:
    """Record a mark. A crash never loses the previous mark, and marks that a later one covers
    go once there are many; ``restart`` begins a new log after a full reload."""
    folder = f"{path}/{name}"
    if mark is not None:
        if isinstance(mark, str):
            mark = datetime.fromisoformat(mark)
        fresh = f"mark={mark.strftime(MARK)}"
        create_if_absent(spark, f"{folder}/{fresh}")
    elif not restart:
        return
    marks = _marks(spark, folder)
    if restart:
        drop_entries(spark, folder, [n for n in marks if mark is None or n != fresh])
    elif len(marks) > FOLD_AT:
        last = max(marks, key=marks.get)
        drop_entries(spark, folder, [n for n in marks if n != last])


def since_watermark(df: DataFrame, ts: str, mark, lookback_days: int = 0) -> DataFrame:
    """Rows newer than the mark; with a look-back, rows from that many days before it on.

    Applied to the raw column so that the filter reaches the scan; a text column is parsed.
    """
    if mark is None:
        return df
    at = F.col(ts) if dict(df.dtypes)[ts] != "string" else parse_ts(F.col(ts))
    start = F.lit(str(mark)).cast("timestamp_ntz")
    if not lookback_days:
        return df.filter(at > start)
    return df.filter(at >= start - F.expr(f"interval {int(lookback_days)} days"))


# ------------------------------------------------------------------ look-back

EARLIEST = date(1900, 1, 1)


def lookback_start(target: DataFrame, col: str, days: int, as_of: date | None = None) -> date:
    """The day ``days`` before the target's newest; a date column or an integer YYYYMMDD key.

    Days after ``as_of`` do not count: one wrong date would stop all later refreshes. One value
    on the driver, so that filters made of it are literals the scan can use.
    """
    if as_of is not None:
        is_key = dict(target.dtypes)[col] != "date"
        target = target.filter(F.col(col) <= F.lit(int(as_of.strftime("%Y%m%d")) if is_key else as_of))
    newest = target.agg(F.max(col).alias("newest")).first()["newest"]
    if newest is None:
        return EARLIEST
    if isinstance(newest, int):  # days are subtracted from the date, not from the key
        newest = datetime.strptime(str(newest), "%Y%m%d").date()
    return newest - timedelta(days=days)


def lookback(batch: DataFrame, target: DataFrame, col: str, days: int) -> DataFrame:
    """Batch rows dated from ``days`` before the target's newest date on; all if it is empty."""
    return batch.filter(F.col(col) >= F.lit(lookback_start(target, col, days)))


def lookback_key(batch: DataFrame, target: DataFrame, key: str, days: int) -> DataFrame:
    """``lookback`` on an integer date key."""
    start = lookback_start(target, key, days)
    return batch.filter(F.col(key) >= int(start.strftime("%Y%m%d")))


def months_since(day: date, year: str = "order_year", month: str = "order_month") -> Column:
    """Partitions from the month of ``day`` on."""
    y, m = F.col(year), F.col(month)
    return (y > day.year) | ((y == day.year) & (m >= day.month))


# --------------------------------------------------------------------- upsert


def delete_insert(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target without the batch's keys, plus the batch; new columns are null in old rows."""
    kept = target.join(batch.select(*keys).distinct(), list(keys), "left_anti")
    return kept.unionByName(batch, allowMissingColumns=True)


def _in_partitions(partition_by: Sequence[str], rows) -> Column:
    same = [
        reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.lit(r[c])) for c in partition_by])
        for r in rows
    ]
    return reduce(lambda a, b: a | b, same, F.lit(False))


def _folder_value(value) -> str:
    """A partition value as it appears in a folder name."""
    return "__HIVE_DEFAULT_PARTITION__" if value is None else quote(str(value), safe=" -_.+@,")


def _pending(path: str) -> str:
    """Where the new content of a table waits for its swap: beside the table, hidden from readers."""
    folder, _, name = path.rstrip("/").rpartition("/")
    return f"{folder}/_pending_{name}"


def finish_upsert(spark: SparkSession, path: str) -> bool:
    """Complete the swap that an earlier upsert of ``path`` began; whether there was one.

    A stage whose plan was not written yet is dropped: the table itself is untouched then.
    """
    stage = _pending(path)
    if not path_exists(spark, stage):
        return False
    complete = path_exists(spark, f"{stage}/plan/_SUCCESS")
    if complete:
        _swap(spark, path, stage)
    remove_path(spark, stage)
    return complete


def _swap(spark: SparkSession, path: str, stage: str) -> None:
    """Put the staged content in place, folder by folder. A folder leaves the stage as it arrives, so the
    swap can be repeated from wherever it broke. Nothing is written again: on stores that rename, moving is free."""
    plan = spark.read.schema(PLAN).json(f"{stage}/plan").first()
    parts = list(plan["partition_by"])
    if not parts:
        move_folder(spark, f"{stage}/new", path)
        return
    for folder in leaf_folders(spark, f"{stage}/new", len(parts)):
        move_folder(spark, f"{stage}/new/{folder}", f"{path}/{folder}")
    for folder in plan["emptied"]:  # a partition left without rows is not overwritten
        remove_path(spark, f"{path}/{folder}")


def _write_stage(df: DataFrame, stage: str, partition_by: Sequence[str]) -> None:
    if partition_by:
        # gathers each partition's rows; AQE cuts and merges them to the advisory file size
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    df.write.mode("overwrite").option("compression", PACKED).partitionBy(*partition_by).parquet(stage)


PLAN = "partition_by array<string>, emptied array<string>"


def upsert(
    spark: SparkSession,
    path: str,
    batch: DataFrame,
    keys: Sequence[str],
    partition_by: Sequence[str] = (),
    keys_move: bool = True,
    new_columns: bool = True,
    gone: DataFrame | None = None,
    kept: bool = False,
) -> None:
    """Delete+insert a batch into a Parquet table, rewriting only the partitions it touches.

    Touched are the batch's own partitions and those that hold an older copy of its keys;
    finding the latter reads the key columns of the whole table. Where a key can never
    change its partition, ``keys_move=False`` leaves that scan out. A batch may bring new
    columns; ``new_columns=False`` promises it does not and spares the look into every file.
    ``gone`` names keys that leave the table without a new row. The batch and these keys are stored
    once before they are looked at, unless they are ``kept``: read from files already, without a shuffle.

    The new content is written beside the table first, with a plan once it is complete. The
    swap reads these only. If it breaks, the next upsert of the table (or ``finish_upsert``)
    completes it before anything else; a break before the plan leaves the table as it was.
    """
    finish_upsert(spark, path)
    with Scratch(spark, "upsert", PACKED) as scratch:
        emptied = _stage(
            spark, scratch, path, batch, list(keys), list(partition_by), keys_move, new_columns, gone, kept
        )
    if emptied is not None:
        plan = spark.createDataFrame([(list(partition_by), emptied)], PLAN)
        plan.coalesce(1).write.mode("overwrite").json(f"{_pending(path)}/plan")
        finish_upsert(spark, path)


def _stored(spark: SparkSession, path: str, new_columns: bool) -> DataFrame | None:
    """The table, or None if it is not there or has no file, as a partitioned one without rows."""
    if not path_exists(spark, path):
        return None
    try:
        return spark.read.option("mergeSchema", new_columns).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "UNABLE_TO_INFER_SCHEMA":
            raise
        return None


def _stage(
    spark: SparkSession,
    scratch: Scratch,
    path: str,
    batch: DataFrame,
    keys: list[str],
    partition_by: list[str],
    keys_move: bool,
    new_columns: bool,
    gone: DataFrame | None,
    kept: bool,
) -> list[str] | None:
    """Write the new content of the touched partitions; folders that end up empty, or None if
    there is nothing to swap."""
    stage = f"{_pending(path)}/new"
    target = _stored(spark, path, new_columns)
    if target is None:
        _write_stage(batch, stage, partition_by)
        return []
    batch = batch if kept else scratch.keep(batch, "batch")
    if not new_columns and set(batch.columns) != set(target.columns):
        raise ValueError(f"batch and table differ: {batch.columns} / {target.columns}")
    # keys may repeat here: they are only looked for, and the batch is read from files each time
    leaving = batch.select(*keys)
    if gone is not None:
        gone = gone.select(*keys)
        leaving = leaving.unionByName(gone if kept else scratch.keep(gone.distinct(), "gone"))
    if not partition_by:
        _write_stage(_replaced(_staying(scratch, target, leaving, keys), batch), stage, ())
        return []

    # only folder names reach the driver: at most one row per partition of the table
    touched = batch.select(*partition_by).distinct().collect()
    if keys_move or gone is not None:  # partitions of the batch are rewritten whatever else they hold
        others = target.select(*keys, *partition_by).filter(~_in_partitions(partition_by, touched))
        touched += others.join(leaving, keys, "left_semi").select(*partition_by).distinct().collect()
    if not touched:
        return None
    old = target.filter(_in_partitions(partition_by, touched))
    _write_stage(_replaced(_staying(scratch, old, leaving, keys), batch), stage, partition_by)
    filled = set(leaf_folders(spark, stage, len(partition_by)))
    folders = ["/".join(f"{c}={_folder_value(row[c])}" for c in partition_by) for row in touched]
    return [f for f in folders if f not in filled]


#: keys of a batch that is small enough to be sent to all tasks
SENT_BATCH = 1 << 17


def _staying(scratch: Scratch, old: DataFrame, leaving: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``old`` whose keys do not leave.

    Beside a large batch they are found on the keys alone. A batch that names nearly all of them
    leaves few, whose keys go to the tasks, and no whole row is shuffled for it.
    """
    going = leaving.count()
    if going > SENT_BATCH:
        named = [F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]
        left = scratch.keep(old.select(*keys).join(leaving, keys, "left_anti").select(*named).distinct(), "staying")
        if left.count() < going:
            # a key with a null is equal to no other: the join on keys leaves its rows in place
            same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)])
            return old.join(left, same, "left_semi")
    return old.join(leaving, keys, "left_anti")


def _replaced(staying: DataFrame, batch: DataFrame) -> DataFrame:
    return staying.unionByName(batch, allowMissingColumns=True)


# ------------------------------------------------------------- bucketed upsert

#: names the folder of a row in a bucketed table
BUCKET = "key_bucket"
LAYOUT = "keys array<string>, buckets int"


def _layout_path(path: str) -> str:
    folder, _, name = path.rstrip("/").rpartition("/")
    return f"{folder}/_layout_{name}"


def read_layout(spark: SparkSession, path: str) -> tuple[list[str], int] | None:
    """(keys, buckets) a table was made with; None if it is no bucketed table."""
    if not path_exists(spark, f"{_layout_path(path)}/_SUCCESS"):
        return None
    row = spark.read.schema(LAYOUT).json(_layout_path(path)).first()
    return list(row["keys"]), row["buckets"]


def _write_layout(spark: SparkSession, path: str, keys: Sequence[str], buckets: int) -> None:
    row = spark.createDataFrame([(list(keys), buckets)], LAYOUT)
    row.coalesce(1).write.mode("overwrite").json(_layout_path(path))


def with_bucket(df: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    """Keys are hashed as text, so that a key of another whole-number width keeps its bucket."""
    texts = [F.col(k).cast("string") for k in keys]
    return df.withColumn(BUCKET, F.pmod(F.xxhash64(*texts), F.lit(buckets)).cast("int"))


def read_bucketed(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("mergeSchema", True).parquet(path).drop(BUCKET)


def upsert_bucketed(
    spark: SparkSession,
    path: str,
    batch: DataFrame,
    keys: Sequence[str],
    buckets: int = 64,
    new_columns: bool = True,
    gone: DataFrame | None = None,
) -> None:
    """``upsert`` of a table without natural partitions: a fixed hash of the key names a row's folder.

    A key cannot leave its bucket, so an upsert looks for older copies in the batch's buckets only,
    and reads and rewrites these alone; files of other buckets stay as they are. The number of buckets
    is fixed when the table is made (later calls use it); ``rebucket`` changes it.
    """
    known = read_layout(spark, path)
    if known is None:
        if path_exists(spark, path):
            raise ValueError(f"{path} is no bucketed table")
        _write_layout(spark, path, keys, buckets)
        known = list(keys), buckets
    if known[0] != list(keys):
        raise ValueError(f"{path} is bucketed by {known[0]}, not by {list(keys)}")
    marked = with_bucket(batch, keys, known[1])
    if gone is not None:
        gone = with_bucket(gone.select(*keys), keys, known[1])
    finish_upsert(spark, path)
    with Scratch(spark, "upsert", PACKED) as scratch:
        marked = scratch.keep(marked, "marked")
        homes = marked.select(BUCKET)
        if gone is not None:
            gone = scratch.keep(gone, "gone_keys")
            homes = homes.union(gone.select(BUCKET))
        touched = [r[0] for r in homes.distinct().collect()]  # at most as many as there are buckets
        stored = _stored(spark, path, new_columns)
        if not touched:
            return
        stage = f"{_pending(path)}/new"
        content = marked
        if stored is not None:
            if not new_columns and set(marked.columns) != set(stored.columns):
                raise ValueError(f"batch and table differ: {marked.columns} / {stored.columns}")
            leaving = marked.select(BUCKET, *keys)
            if gone is not None:
                leaving = leaving.unionByName(gone)
            # the bucket is part of the join, and a literal filter for the scan
            old = stored.where(F.col(BUCKET).isin(touched))
            content = _replaced(old.join(leaving.distinct(), [BUCKET, *keys], "left_anti"), marked)
        _write_stage(content, stage, [BUCKET])
        filled = set(leaf_folders(spark, stage, 1))
        emptied = [f for f in (f"{BUCKET}={b}" for b in touched) if f not in filled]
        plan = spark.createDataFrame([([BUCKET], emptied)], PLAN)
        plan.coalesce(1).write.mode("overwrite").json(f"{_pending(path)}/plan")
    finish_upsert(spark, path)


def rebucket(spark: SparkSession, path: str, buckets: int) -> None:
    """Deal a bucketed table to another number of buckets, by way of a table beside it."""
    keys, before = read_layout(spark, path)
    finish_upsert(spark, path)
    if buckets == before:
        return
    fresh = f"{path.rstrip('/')}_rebucketed"
    remove_path(spark, fresh)
    _write_stage(with_bucket(read_bucketed(spark, path), keys, buckets), fresh, [BUCKET])
    # the old layout goes first: a break from here on leaves a table that refuses upserts, and a whole copy
    remove_path(spark, _layout_path(path))
    move_folder(spark, fresh, path)
    _write_layout(spark, path, keys, buckets)
