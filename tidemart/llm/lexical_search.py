"""Ranked lexical search: an inverted index in shards, searched by Block-Max MaxScore.

Terms are runs of ASCII letters and digits and of all characters beyond ASCII, A-Z lower-cased. A term's
weight is w = floor(1000 ln((2N + 2) / (2 df + 1))); with n terms in a document, N documents that have
terms and L terms in all, m = 50 + (50 n N div L), and a document's score is the sum over the query's
distinct terms of w * (10^9 tf div (1000 tf + 20 m)).

Index. Each task numbers the documents it reads; up to `shard_bytes` of text are a shard. A shard has a
row per term: its postings (gap and tf as variable bytes) in blocks of `block`, for each block the last
document, where it ends, and its impacts: the pairs (tf, n) of which none is beaten in both, from
which the block's highest score is exact for any N and L. So one pass over the texts builds the index,
and collection statistics are sums over its rows. Texts are not shuffled.
Search. Queries are dealt to blocks of `items`. The postings of a block's terms meet in a group per
shard and block of queries: one shard's lists at most. There each query keeps a heap of k documents, whose
least score is the threshold. Lists are ordered by their highest score; as many of the low ones as cannot
reach the threshold together are not essential. Documents of the essential lists are candidates; on
the others, from the highest down, a candidate goes as soon as the bounds of the lists, or the maximum of
the block it would be in, show that it stays below the threshold; only blocks with candidates left are
decompressed. Heaps of the shards are merged by a ranked window, cut to k in each task before the shuffle.

Defined cases: null and empty texts have no terms: such documents are not counted and not found, such
items find nothing. Rows with one doc_id are documents each; null ids rank last among equal scores. Rows
of items that agree in id and text are one item. Empty tables give no rows. Only doc_id and text, item_id
and text are read; doc_id is a whole number.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemart.llm.common import lean, slices, to_batch
from tidemart.llm.grams import LOWER, runs
from tidemart.session import Scratch

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
IN_TERM = np.zeros(256, bool)
IN_TERM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
#: documents between two looks at the threshold
STRIDE = 4096
#: (block of queries, term) pairs that are sent to all tasks; more are joined by a shuffle
SENT_TERMS = 1 << 20
_INDEX = pa.schema([("shard", pa.int64()), ("term", pa.string()), ("df", pa.int64()), ("n_terms", pa.int64()),
                    ("blocks", pa.binary()), ("impacts", pa.binary()), ("postings", pa.binary())])


@dataclass(frozen=True)
class SearchParams:
    k: int = 50
    block: int = 128
    shard_bytes: int = 16 << 20
    items: int = 500


# ----------------------------------------------------------------------- index


def terms_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, pa.DictionaryArray]:
    """(document of each term, the terms)."""
    starts, ends, doc = runs(IN_TERM[data], offsets)
    size = ends - starts
    after = np.cumsum(size)
    at = np.repeat(starts - (after - size), size) + np.arange(after[-1] if len(after) else 0)
    places = np.concatenate([[0], after]).astype(np.int32)
    words = pa.Array.from_buffers(
        pa.string(), len(size), [None, pa.py_buffer(places), pa.py_buffer(np.ascontiguousarray(LOWER[data[at]]))])
    return doc, words.dictionary_encode()


def to_bytes(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Variable-byte form (seven bits a byte, the last byte of a number below 128), end of each number."""
    values = values.astype(np.int64)
    size = 1 + sum((values >= 1 << 7 * k).astype(np.int64) for k in range(1, 5))
    ends = np.cumsum(size)
    out = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint8)
    for k in range(5):
        on = size > k
        out[(ends - size)[on] + k] = values[on] >> 7 * k & 127 | np.where(size[on] > k + 1, 128, 0)
    return out, ends


def from_bytes(data: np.ndarray) -> np.ndarray:
    last = data < 128
    first = np.concatenate([[0], np.flatnonzero(last)[:-1] + 1])
    place = np.arange(len(data)) - np.repeat(first, np.diff(np.append(first, len(data))))
    return np.add.reduceat((data & 127).astype(np.int64) << 7 * place, first)


def frontier(block: np.ndarray, tf: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(block, tf, n) of the postings that no other of their block beats by higher tf and lower n."""
    order = np.lexsort((-tf, n, block))
    block, tf, n = block[order], tf[order], n[order]
    step = int(tf.max(initial=0)) + 1
    best = np.maximum.accumulate(block * step + tf)
    keep = np.ones(len(block), bool)
    keep[1:] = (best[1:] > best[:-1]) | (block[1:] != block[:-1])
    return block[keep], tf[keep], n[keep]


def _column(flat: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Binary values: flat's bytes cut at the ends (in items of flat)."""
    places = (np.concatenate([[0], ends]) * flat.itemsize).astype(np.int32)
    return pa.Array.from_buffers(
        pa.binary(), len(ends), [None, pa.py_buffer(places), pa.py_buffer(np.ascontiguousarray(flat))])


class ShardBuilder:
    """Documents of a shard, gathered slice by slice."""

    def __init__(self, block: int):
        self.block = block
        self.ids: list[pa.Array] = []
        self.n: list[np.ndarray] = []
        self.doc: list[np.ndarray] = []
        self.tf: list[np.ndarray] = []
        self.term: list[pa.DictionaryArray] = []
        self.size = self.docs = 0

    def add(self, ids: pa.Array, data: np.ndarray, offsets: np.ndarray) -> None:
        doc, words = terms_of(data, offsets)
        key = doc * max(1, len(words.dictionary)) + words.indices.to_numpy()
        some, tf = np.unique(key, return_counts=True)
        self.doc.append((some // max(1, len(words.dictionary)) + self.docs).astype(np.int32))
        self.tf.append(tf.astype(np.int32))
        self.term.append(pa.DictionaryArray.from_arrays(
            pa.array(some % max(1, len(words.dictionary)), pa.int32()), words.dictionary))
        self.n.append(np.bincount(doc, minlength=len(ids)).astype(np.int32))
        self.ids.append(ids.cast(pa.int64()))
        self.size += len(data)
        self.docs += len(ids)

    def rows(self, shard: int):
        """The row of the documents (term null), then a row for each term."""
        ids, n = pa.concat_arrays(self.ids), np.concatenate(self.n)
        # documents without terms are never met: their numbers stay, so that numbers need no change
        yield to_batch(
            _INDEX, [shard], [None], [int((n > 0).sum())], [int(n.sum())],
            [ids.is_null().to_numpy(zero_copy_only=False).tobytes()], [n.tobytes()],
            [ids.fill_null(0).to_numpy().tobytes()])
        terms = pa.chunked_array(self.term).unify_dictionaries()
        names = terms.chunk(0).dictionary
        term = np.concatenate([c.indices.to_numpy() for c in terms.chunks])
        order = np.argsort(term, kind="stable")  # documents stay in order
        term, doc, tf = term[order], np.concatenate(self.doc)[order], np.concatenate(self.tf)[order]
        if not len(term):
            return
        df = np.bincount(term, minlength=len(names))
        before = np.cumsum(df) - df
        place = np.arange(len(term)) - before[term]
        opens = place % self.block == 0
        block = np.cumsum(opens) - 1
        gap = np.where(opens, doc, doc - np.concatenate([[0], doc[:-1]]))
        data, ends = to_bytes(np.stack([gap, tf], axis=1).ravel())
        lasts = np.flatnonzero(np.append(opens[1:], True))
        end_byte = ends[2 * lasts + 1]  # of each block
        blocks_of = np.bincount(term[lasts], minlength=len(names))
        first_byte = np.concatenate([[0], end_byte])[np.cumsum(blocks_of) - blocks_of]
        b, best_tf, least_n = frontier(block, tf.astype(np.int64), n[doc].astype(np.int64))
        impacts = np.bincount(b, minlength=len(lasts))
        head = np.stack([doc[lasts], end_byte - first_byte[term[lasts]], impacts], axis=1).astype(np.uint32)
        columns = [
            names, pa.array(df, pa.int64()),
            _column(head.ravel(), 3 * np.cumsum(blocks_of)),
            _column(np.stack([best_tf, least_n], axis=1).astype(np.uint32).ravel(),
                    2 * np.cumsum(np.bincount(term[lasts][b], minlength=len(names)))),
            _column(data, end_byte[np.cumsum(blocks_of) - 1]),
        ]
        for at in range(0, len(names), 20_000):
            name, count, head, impact, body = (c.slice(at, 20_000) for c in columns)
            yield to_batch(_INDEX, np.full(len(name), shard), name, count, pa.nulls(len(name), pa.int64()), head, impact, body)


def build_index(docs: DataFrame, params: SearchParams = SearchParams()) -> DataFrame:
    """Rows (shard, term, df, n_terms, blocks, impacts, postings); a shard's documents are the row without term.

    Shards are numbered by task, so the rows are to be written once and read from there.
    """

    def run(batches):
        task, number = TaskContext.get().partitionId(), 0
        builder = ShardBuilder(params.block)
        for rows, data, offsets in slices(batches):
            builder.add(rows.column("doc_id"), data, offsets)
            if builder.size >= params.shard_bytes:
                yield from builder.rows(task << 32 | number)
                number, builder = number + 1, ShardBuilder(params.block)
        if builder.docs:
            yield from builder.rows(task << 32 | number)

    return docs.select("doc_id", "text").mapInArrow(
        lean(run), "shard long, term string, df long, n_terms long, blocks binary, impacts binary, postings binary")


# ---------------------------------------------------------------------- search


class TermList:
    """A term's postings in one shard; blocks are decompressed when first asked for."""

    def __init__(self, row, weight: int, ratio, m: np.ndarray):
        self.weight, self.m = weight, m
        head = np.frombuffer(row.blocks, np.uint32).reshape(-1, 3).astype(np.int64)
        self.last, self.end = head[:, 0], head[:, 1]
        pairs = np.frombuffer(row.impacts, np.uint32).reshape(-1, 2).astype(np.int64)
        self.block_max = np.maximum.reduceat(
            weight * gain(pairs[:, 0], ratio(pairs[:, 1])), np.cumsum(head[:, 2]) - head[:, 2])
        self.bound = int(self.block_max.max())
        self.data = np.frombuffer(row.postings, np.uint8)
        self.known: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def block(self, b: int) -> tuple[np.ndarray, np.ndarray]:
        """(documents, what the term adds to their scores)."""
        if b not in self.known:
            pairs = from_bytes(self.data[self.end[b - 1] if b else 0 : self.end[b]]).reshape(-1, 2)
            doc = np.cumsum(pairs[:, 0])
            self.known[b] = doc, self.weight * gain(pairs[:, 1], self.m[doc])
        return self.known[b]

    def between(self, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
        first, last = np.searchsorted(self.last, [low, high - 1])
        found = [self.block(b) for b in range(first, min(last + 1, len(self.last)))]
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        doc, score = (np.concatenate(x) for x in zip(*found))
        a, b = np.searchsorted(doc, [low, high])
        return doc[a:b], score[a:b]


def gain(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return 1_000_000_000 * tf // (1000 * tf + 20 * m)


def best_documents(lists: list[TermList], n_docs: int, k: int, ids: np.ndarray, stride: int = STRIDE):
    """(documents, scores) of the k best by score, then by id, in no order; Block-Max MaxScore."""
    lists = sorted(lists, key=lambda x: x.bound)
    reach = np.cumsum([x.bound for x in lists])  # of each list with all below it
    heap_doc, heap_score, threshold = np.zeros(0, np.int64), np.zeros(0, np.int64), 1
    for low in range(0, n_docs, stride):
        high = min(low + stride, n_docs)
        essential = int(np.searchsorted(reach, threshold))  # the lists below reach less than it
        if essential == len(lists):
            break
        score = np.zeros(high - low, np.int64)
        for one in lists[essential:]:
            doc, more = one.between(low, high)
            score[doc - low] += more
        candidate = np.flatnonzero(score)
        for i in range(essential - 1, -1, -1):
            one, below = lists[i], reach[i - 1] if i else 0
            candidate = candidate[score[candidate] + reach[i] >= threshold]
            if not len(candidate):
                break
            at = np.searchsorted(one.last, candidate + low)
            inside = at < len(one.last)
            most = np.zeros(len(candidate), np.int64)
            most[inside] = one.block_max[at[inside]]
            hopeful = score[candidate] + most + below >= threshold
            candidate, at, inside = candidate[hopeful], at[hopeful], inside[hopeful]
            for b in np.unique(at[inside]):
                doc, more = one.block(int(b))
                own = candidate[at == b]
                spot = np.minimum(np.searchsorted(doc, own + low), len(doc) - 1)
                hit = doc[spot] == own + low
                score[own[hit]] += more[spot[hit]]
        candidate = candidate[score[candidate] >= threshold]
        heap_doc = np.concatenate([heap_doc, candidate + low])
        heap_score = np.concatenate([heap_score, score[candidate]])
        if len(heap_doc) >= k:
            best = np.lexsort((ids[heap_doc], -heap_score))[:k]
            heap_doc, heap_score = heap_doc[best], heap_score[best]
            threshold = max(threshold, int(heap_score[-1]))
    return heap_doc, heap_score


def _queries(items: DataFrame, params: SearchParams) -> tuple[DataFrame, int]:
    """(item_id, text_key, part, term): the distinct terms of each item, dealt to parts; how many parts."""
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    keyed = (
        items.select("item_id", "text", F.md5("text").alias("text_key"))
        .dropDuplicates(["item_id", "text_key"])
        .select("item_id", "text_key", F.array_distinct(F.regexp_extract_all(lower, F.lit(TERM), F.lit(0))).alias("terms"))
    )
    parts = max(1, -(-keyed.count() // params.items))
    part = F.pmod(F.xxhash64("item_id", "text_key"), F.lit(parts)).cast("int")
    return keyed.select("item_id", "text_key", part.alias("part"), F.explode("terms").alias("term")), parts


def _shard_best(n_docs: int, n_terms: int, params: SearchParams):
    """Of one shard and part: the k best documents of each query."""

    def ratio(n: np.ndarray) -> np.ndarray:
        return 50 + 50 * n.astype(np.int64) * n_docs // n_terms

    def run(group: pd.DataFrame) -> pd.DataFrame:
        own = group[group["term"].isna()].iloc[0]
        ids, null = np.frombuffer(own.postings, np.int64), np.frombuffer(own.blocks, bool)
        m = ratio(np.frombuffer(own.impacts, np.int32))
        order = np.where(null, np.iinfo(np.int64).max, ids)
        lists = {
            row.term: TermList(row, int(row.weight), ratio, m)
            for row in group[group["term"].notna()].itertuples(index=False)
        }
        out = []
        for query in json.loads(own.queries):
            mine = [lists[t] for t in query["t"] if t in lists]
            doc, score = best_documents(mine, len(ids), params.k, order) if mine else ((), ())
            out += [(query.get("i"), query["k"], None if null[d] else int(ids[d]), int(s)) for d, s in zip(doc, score)]
        return pd.DataFrame(out, columns=["item_id", "text_key", "doc_id", "score"], dtype=object)

    return run


def search(index: DataFrame, items: DataFrame, params: SearchParams = SearchParams()) -> DataFrame:
    """(item_id, rank, doc_id, score): each item's k best documents with a score above 0."""
    documents, postings = index.where("term is null"), index.where("term is not null")
    n_docs, n_terms = documents.agg(F.sum("df"), F.sum("n_terms")).first()
    n_docs, n_terms = n_docs or 0, n_terms or 1
    asked, parts = _queries(items, params)
    wanted = asked.select("part", "term").distinct()
    if wanted.count() <= SENT_TERMS:
        wanted = F.broadcast(wanted)
    met = postings.join(wanted, "term").select("shard", "part", "term", "df", "blocks", "impacts", "postings")
    # a term's documents are counted once, whatever number of parts ask for it
    held = met.groupBy("term", "part").agg(F.sum("df").alias("df")).groupBy("term").agg(F.max("df").alias("df"))
    weight = F.floor(1000 * F.log((2.0 * n_docs + 2) / (2.0 * F.col("df") + 1))).cast("long")
    weights = held.select("term", weight.alias("weight")).where("weight > 0")
    queries = (
        asked.join(weights, "term")
        .groupBy("part", "item_id", "text_key").agg(F.collect_list("term").alias("terms"))
        .groupBy("part").agg(F.to_json(F.collect_list(F.struct(
            F.col("item_id").alias("i"), F.col("text_key").alias("k"), F.col("terms").alias("t")))).alias("queries"))
    )
    # each shard's documents once per part of the query set, with the queries of the part
    heads = (
        documents.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))).join(queries, "part")
        .select("shard", "part", "term", F.lit(0).cast("long").alias("weight"), "blocks", "impacts", "postings", "queries")
    )
    lists = met.join(weights, "term").select(
        "shard", "part", "term", "weight", "blocks", "impacts", "postings", F.lit(None).cast("string").alias("queries"))
    kind = items.schema["item_id"].dataType.simpleString()
    best = heads.unionByName(lists).groupBy("shard", "part").applyInPandas(
        _shard_best(n_docs, n_terms, params), f"item_id {kind}, text_key string, doc_id long, score long")
    rank = F.row_number().over(
        Window.partitionBy("item_id", "text_key").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
    return best.withColumn("rank", rank).where(F.col("rank") <= params.k).select("item_id", "rank", "doc_id", "score")


def search_documents(docs: DataFrame, items: DataFrame, params: SearchParams = SearchParams()) -> DataFrame:
    """Index ``docs`` and search it; the index is removed, the result (k rows an item) stays in scratch."""
    spark = docs.sparkSession
    with Scratch(spark, "lexical-index") as scratch:
        index = scratch.keep(build_index(docs, params), "index")
        return Scratch(spark, "lexical-search").keep(search(index, items, params), "found")
