"""What the operators share: reading the given tables, folds, slices of Arrow batches."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text worked on at a time in a task. numpy holds some twenty times as much for it;
#: a longer document is a slice of its own.
SLICE_BYTES = 1 << 19


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(doc_id: str, n: int) -> Column:
    """crc32 of the id as text, mod n; null ids count as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % n


def text_bytes(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(UTF-8 bytes, n + 1 offsets) of a string column without copying; nulls are empty."""
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    if array.null_count:
        array = array.fill_null("")
    array = array.cast(pa.large_string())
    offsets = np.frombuffer(array.buffers()[1], dtype=np.int64)
    offsets = offsets[array.offset : array.offset + len(array) + 1]
    data = array.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    start = int(offsets[0]) if len(offsets) else 0
    return data[start : int(offsets[-1])], offsets - start


def lowered(array: pa.Array) -> pa.Array:
    """Lower-cased texts; one task's worth of them exists beside the originals."""
    return pc.utf8_lower(array)


def slices(
    batches: Iterator[pa.RecordBatch], column: str = "text", size: int = SLICE_BYTES, lower: bool = False
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Each batch cut into runs of rows of about `size` bytes: (rows, bytes, offsets).

    With ``lower``, the bytes are those of the lower-cased texts; the rows stay as they are.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        data, offsets = text_bytes(lowered(batch.column(column)) if lower else batch.column(column))
        first = 0
        while first < batch.num_rows:
            last = int(np.searchsorted(offsets, offsets[first] + size, side="right")) - 1
            last = max(first + 1, min(last, batch.num_rows))
            own = offsets[first : last + 1]
            yield batch.slice(first, last - first), data[own[0] : own[-1]], own - own[0]
            first = last


def to_batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema)],
        schema=schema,
    )


_held: dict = {}


def held(key, make):
    """What later tasks of an operator find again in a worker process (an encoder, an automaton): one
    thing at a time, gone as soon as the process works for another operator (``lean``)."""
    if key not in _held:
        _held.clear()
        _held[key] = make()
    return _held[key]


def lean(run, key=None):
    """``run`` over a task's batches, for processes that serve many operators in a row: what another one
    held is let go first, and freed memory goes back to the machine at the end, as a worker that sits idle
    would otherwise keep the most it ever had."""

    def wrapped(batches):
        if key not in _held:
            _held.clear()
        yield from run(batches)
        give_back()

    return wrapped


def give_back() -> None:
    """Return freed memory to the machine; allocators keep it otherwise."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library: it keeps what it keeps
        pass


def release(spark: SparkSession) -> None:
    """Let go of shuffle files that no plan refers to any more.

    Spark deletes them when the driver collects its garbage, which a driver that does little may
    not do for half an hour; a job that has just written a large intermediate table asks for it.
    """
    gc.collect()
    spark._jvm.System.gc()
