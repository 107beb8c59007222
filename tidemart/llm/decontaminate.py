"""Benchmark decontamination with an Aho-Corasick automaton over the test items.

Texts are normalised to words (A-Z lower-cased; runs of ASCII letters, digits and non-ASCII
characters) joined by spaces. The windows of all items, 13 words or a whole shorter item, form one
automaton; a document is normalised and read once, and what is found is mapped back to word
numbers and to character offsets of the original text. Every word inside an occurrence is hit.

The automaton is built in the tasks from a broadcast list of windows of at most BLOCK_CHARS
characters. A larger benchmark is cut into that many more blocks by a hash of the window; each block
is one pass over the documents, done before the next block is sent, and a document's findings are merged.

Defined cases: null or empty text has no words, is not contaminated. Null or wordless items have no
windows; a null item_id is listed as `null`; items that repeat an id count as one. Repeated rows:
one result each. Empty tables: no rows, or no findings. Only doc_id, item_id and text are read.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import pairwise

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.llm.common import held, lean, text_bytes, to_batch
from tidemart.session import Scratch

BLOCK_CHARS = 2_000_000

#: ASCII letters in lower case and digits stay, other ASCII becomes a space, UTF-8 bytes stay
_NORMAL = bytes(
    b + 0x20 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256)
)
_FOUND = "doc_id long, hash long, n_words long, hits array<struct<first:long,last:long>>, " \
    "spans array<struct<start:long,end:long>>, items array<string>"


@dataclass(frozen=True)
class DecontaminationParams:
    window: int = 13
    #: contaminated if at least this percentage of the words is hit
    percent: int = 5


def normal_words(raw: bytes) -> list[bytes]:
    return raw.translate(_NORMAL).split()


def item_windows(benchmark: DataFrame, params: DecontaminationParams) -> DataFrame:
    """(window, items): each distinct window with the ids of the items that hold it."""

    def run(frames):
        for frame in frames:
            ids, found = [], []
            for item, text in zip(frame["item_id"], frame["text"]):
                words = normal_words(text.encode()) if text else []
                n = min(params.window, len(words))
                for i in range(len(words) - n + 1 if n else 0):
                    ids.append(item)
                    found.append(b" ".join(words[i : i + n]).decode())
            yield pd.DataFrame({"item": pd.Series(ids, dtype=object), "window": pd.Series(found, dtype=object)})

    item = F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item_id")
    return (
        benchmark.select(item, "text").mapInPandas(run, "item string, window string").distinct()
        .groupBy("window").agg(F.array_sort(F.collect_list("item")).alias("items"))
    )


class Automaton:
    """All windows as one automaton over normalised text with a space at either end."""

    def __init__(self, windows: list[tuple[str, list[str]]]):
        self.tree = ahocorasick.Automaton()
        for number, (window, items) in enumerate(windows):
            self.tree.add_word(f" {window} ", (number, window.count(" ") + 1, items))
        self.tree.make_automaton()
        self.empty = not windows

    def occurrences(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """(merged runs of hit words as (first, last), items found)."""
        if self.empty or not words:
            return [], set()
        text = f" {b' '.join(words).decode()} "
        found = list(self.tree.iter(text))
        if not found:
            return [], set()
        # the space that closes word j is the space numbered j + 1
        spaces = np.flatnonzero(np.frombuffer(text.encode("utf-32-le"), np.uint32) == 0x20)
        items: set[str] = set()
        seen: set[int] = set()
        runs = []
        for end, (number, length, owners) in found:
            last = int(np.searchsorted(spaces, end)) - 1
            runs.append((last - length + 1, last))
            if number not in seen:
                seen.add(number)
                items.update(owners)
        return merge(runs), items


def merge(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted disjoint runs that cover the same words; touching runs are joined."""
    out: list[tuple[int, int]] = []
    for first, last in sorted(runs):
        if out and first <= out[-1][1] + 1:
            out[-1] = out[-1][0], max(out[-1][1], last)
        else:
            out.append((first, last))
    return out


def char_spans(raw: bytes, runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """[start, end) of runs of words, in characters of the original text."""
    inside = np.frombuffer(raw.translate(_NORMAL), np.uint8) != 0x20
    edges = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8)))
    starts, ends = edges[::2], edges[1::2]
    chars = np.concatenate([[0], np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)])
    return [(int(chars[starts[a]]), int(chars[ends[b]])) for a, b in runs]


class _Sent:
    """A broadcast list of windows, and what tells it from others in a worker process."""

    def __init__(self, spark, windows):
        self.broadcast = spark.sparkContext.broadcast((id(self), windows))
        self.id = f"{spark.sparkContext.applicationId}-{self.broadcast._jbroadcast.id()}"

    def __getstate__(self):
        return {"broadcast": self.broadcast, "id": self.id}

    @property
    def value(self):
        return self.broadcast.value


def _scan(docs: DataFrame, sent: _Sent) -> DataFrame:
    spans = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    hits = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))
    schema = pa.schema([("doc_id", pa.int64()), ("hash", pa.int64()), ("n_words", pa.int64()), ("hits", hits),
                        ("spans", spans), ("items", pa.list_(pa.string()))])

    def run(batches):
        automaton = held(sent.id, lambda: Automaton(sent.value[1]))
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            raw = data.tobytes()
            counts, own_hits, own_spans, items = [], [], [], []
            for a, b in pairwise(offsets.tolist()):
                words = normal_words(raw[a:b])
                runs, found = automaton.occurrences(words)
                counts.append(len(words))
                own_hits.append([{"first": x, "last": y} for x, y in runs])
                own_spans.append([{"start": x, "end": y} for x, y in char_spans(raw[a:b], runs)] if runs else [])
                items.append(sorted(found))
            yield to_batch(schema, batch.column("doc_id").cast(pa.int64()), batch.column("hash"),
                           counts, own_hits, own_spans, items)

    return docs.select("doc_id", F.xxhash64("text").alias("hash"), "text").mapInArrow(lean(run, sent.id), _FOUND)


@F.pandas_udf(T.ArrayType(T.StructType([T.StructField("first", T.LongType()), T.StructField("last", T.LongType())])))
def _merged(hits: pd.Series) -> pd.Series:
    return hits.map(lambda rows: [{"first": a, "last": b} for a, b in merge([(r["first"], r["last"]) for r in rows])])


def _blocks(benchmark: DataFrame, params: DecontaminationParams) -> tuple[DataFrame, int]:
    """The windows, and in how many blocks of BLOCK_CHARS they are looked for."""
    windows = item_windows(benchmark, params)
    total = windows.agg(F.sum(F.length("window") + F.length(F.array_join("items", ",")))).first()[0] or 0
    return windows, max(1, -(-total // BLOCK_CHARS))


def _content(windows: DataFrame) -> list[tuple[str, list[str]]]:
    """A block's windows on the driver, on their way to the tasks: bounded by BLOCK_CHARS."""
    return [(r["window"], list(r["items"])) for r in windows.collect()]


def find(docs: DataFrame, benchmark: DataFrame, params: DecontaminationParams = DecontaminationParams()) -> DataFrame:
    """One row per row of ``docs``: doc_id, text_hash, n_words, hits (word runs), spans (character runs of the
    original text), items (ids, sorted as strings), n_hit, n_items, contaminated."""
    spark = docs.sparkSession
    windows, blocks = _blocks(benchmark, params)
    passes = []
    for k in range(blocks):
        own = windows if blocks == 1 else windows.where(F.pmod(F.xxhash64("window"), F.lit(blocks)) == k)
        sent = _Sent(spark, _content(own))
        one = _scan(docs, sent)
        if blocks > 1:
            # a block is done before the next one's windows come to the driver, which holds one block at a time
            one = Scratch(spark, f"decontamination-{k}").keep(one if k == 0 else one.where(F.size("hits") > 0), "found")
            sent.broadcast.destroy()
        passes.append(one)
    found = passes[0]
    if blocks > 1:
        # rows with equal id and text find the same: their findings are merged as sets
        some = passes[0].where(F.size("hits") > 0)
        for one in passes[1:]:
            some = some.unionAll(one.where(F.size("hits") > 0))
        joined = some.groupBy("doc_id", "hash").agg(
            _flat("hits").alias("all_hits"), _flat("spans").alias("all_spans"), _flat("items").alias("all_items"))
        joined = joined.withColumnsRenamed({"doc_id": "id", "hash": "h"})
        found = (
            passes[0].join(joined, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("hash") == F.col("h")), "left")
            .select(
                "doc_id", "hash", "n_words",
                F.when(F.col("h").isNull(), F.col("hits")).otherwise(_merged(F.coalesce("all_hits", "hits"))).alias("hits"),
                F.coalesce("all_spans", "spans").alias("spans"),
                F.array_sort(F.array_distinct(F.coalesce("all_items", "items"))).alias("items"),
            )
        )
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda n, r: n + r["last"] - r["first"] + 1)
    return (
        found.select("doc_id", F.col("hash").alias("text_hash"), "n_words", "hits", "spans", "items", n_hit.alias("n_hit"),
                     F.size("items").cast("long").alias("n_items"))
        .withColumn("contaminated", is_contaminated(params))
    )


def _flat(name: str) -> Column:
    return F.array_distinct(F.flatten(F.collect_list(name)))


def is_contaminated(params: DecontaminationParams) -> Column:
    return (F.col("n_hit") > 0) & (F.col("n_hit") * 100 >= F.col("n_words") * params.percent)


def keep_clean(docs: DataFrame, benchmark: DataFrame, params: DecontaminationParams = DecontaminationParams()) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with all their columns.

    With one block of windows, rows pass through as Arrow batches and no text is shuffled; with more, a row's
    findings come from several passes, and contaminated rows are taken out by id and text.
    """
    spark = docs.sparkSession
    windows, blocks = _blocks(benchmark, params)
    if blocks == 1:
        sent, at = _Sent(spark, _content(windows)), docs.columns.index("text")

        def run(batches):
            automaton = held(sent.id, lambda: Automaton(sent.value[1]))
            for batch in batches:
                data, offsets = text_bytes(batch.column(at))
                raw, kept = data.tobytes(), []
                for a, b in pairwise(offsets.tolist()):
                    words = normal_words(raw[a:b])
                    n_hit = sum(y - x + 1 for x, y in automaton.occurrences(words)[0])
                    kept.append(not (n_hit > 0 and n_hit * 100 >= len(words) * params.percent))
                yield batch.filter(pa.array(kept, pa.bool_()))

        return docs.mapInArrow(lean(run, sent.id), docs.schema)
    found = find(docs, benchmark, params).where("contaminated")
    found = found.select(F.col("doc_id").alias("bad_id"), F.col("text_hash").alias("bad_text")).distinct()
    same = docs["doc_id"].eqNullSafe(found["bad_id"]) & (F.xxhash64(docs["text"]) == found["bad_text"])
    return docs.join(found, same, "left_anti")
