"""Phrases that occur together more often than their parts suggest, by direct-address tiling.

Everything is counted per language. A text is lower-cased (A-Z), cut into pieces at .,;:!? and line ends, and
those into words at spaces and tabs. A phrase of 2 or 3 words with a >= `least` occurrences is a candidate;
a cut after its first words gives l and r, the counts of both parts, and the score floor(10^6 a a / (l r));
its lowest cut counts. A candidate inside a longer one that has at least half its occurrences is dropped.

How it is counted
    Every word of a candidate, and both pairs of a candidate of three, are as frequent as it is, so rare
    ones are left out before longer phrases are counted. Chunks of text are encoded once: a chunk has a
    dictionary of its own words with their counts, and its words as numbers in it. Counts are summed over
    the chunks, frequent words are ranked by frequency, and each chunk's dictionary is joined with the
    ranks, so that chunks get ids of the whole corpus and no task holds its vocabulary.
    Pairs of ids are counted chunk by chunk in tiles of the id x id square: frequent words have low ids,
    so a few tiles hold most pairs; a tile with enough of them is an array addressed by both ids, counted
    by bincount, the others are sorted coordinates. Spark sums the entries over the chunks.
    Frequent pairs are ranked again and are the "words" of the next round: a phrase of three words is the
    pair (rank of its first two, third word), counted the same way. Up to `sent` ranked pairs are sent to
    all tasks; beyond, each chunk's pairs are joined with the ranks as its words were.

Defined cases: null text is empty; null language is `und`. Documents of one language never form phrases
across each other. Repeated rows count each. Equal scores fall to more occurrences, then to the phrase
in byte order. Empty tables give no rows. Only text and lang are read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemart.llm.common import lean, slices, to_batch
from tidemart.llm.grams import LOWER, runs
from tidemart.session import Scratch

#: bytes that end a piece, and those that end a word
BREAK = np.zeros(256, bool)
BREAK[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
IN_WORD = ~BREAK
IN_WORD[[0x20, 0x09]] = False
#: a tile is an array if it has at least one pair for so many of its places
DENSE = 16
#: words of one frequency that are numbered together, on average
NUMBERED = 100_000
#: pairs that are counted at a time: what a task holds beside its chunk
COUNTED = 1 << 19
#: shares of a language that are ranked by themselves first
SHARES = 64
_CHUNK = pa.schema([("chunk", pa.int64()), ("lang", pa.string()), ("word", pa.string()), ("local", pa.int32()),
                    ("n", pa.int64()), ("tokens", pa.binary())])
_COUNTS = pa.schema([("lang", pa.string()), ("pair", pa.int64()), ("n", pa.int64())])


@dataclass(frozen=True)
class PhraseParams:
    least: int = 10
    top: int = 2000
    chunk_bytes: int = 8 << 20
    tile: int = 1024
    sent: int = 1 << 20


# ------------------------------------------------------------------- encoding


class ChunkBuilder:
    def __init__(self):
        self.words: list[pa.DictionaryArray] = []
        self.lang: list[np.ndarray] = []  # of each word
        self.opens: list[np.ndarray] = []  # is a word the first of its piece
        self.size = 0

    def add(self, data: np.ndarray, offsets: np.ndarray, lang: np.ndarray) -> None:
        starts, ends, doc = runs(IN_WORD[data], offsets)
        size = ends - starts
        after = np.cumsum(size)
        at = np.repeat(starts - (after - size), size) + np.arange(after[-1] if len(after) else 0)
        places = np.concatenate([[0], after]).astype(np.int32)
        words = pa.Array.from_buffers(
            pa.string(), len(size), [None, pa.py_buffer(places), pa.py_buffer(np.ascontiguousarray(LOWER[data[at]]))])
        breaks = np.cumsum(BREAK[data]) if len(data) else np.zeros(0, np.int64)
        opens = np.ones(len(size), bool)
        opens[1:] = (doc[1:] != doc[:-1]) | (breaks[starts[1:]] != breaks[starts[:-1]])
        self.words.append(words.dictionary_encode())
        self.lang.append(lang[doc])
        self.opens.append(opens)
        self.size += len(data)

    def rows(self, chunk: int, langs: list[str]):
        """Per language a row of tokens (word null) and a row for each word."""
        words = pa.chunked_array(self.words).unify_dictionaries()
        names = words.chunk(0).dictionary
        word = np.concatenate([c.indices.to_numpy() for c in words.chunks])
        lang, opens = np.concatenate(self.lang), np.concatenate(self.opens)
        for code in np.unique(lang):
            own = np.flatnonzero(lang == code)
            some, local, n = np.unique(word[own], return_inverse=True, return_counts=True)
            # -1 before each piece but the first
            at = np.arange(len(own)) + np.cumsum(opens[own]) - 1
            tokens = np.full(at[-1] + 1, -1, np.int32)
            tokens[at] = local
            yield to_batch(_CHUNK, [chunk], [langs[code]], [None], [None], [len(own)], [tokens.tobytes()])
            for first in range(0, len(some), 20_000):
                part = slice(first, first + 20_000)
                count = len(some[part])
                yield to_batch(
                    _CHUNK, np.full(count, chunk), [langs[code]] * count, names.take(pa.array(some[part])),
                    np.arange(first, first + count, dtype=np.int32), n[part], pa.nulls(count, pa.binary()))


def encode(docs: DataFrame, params: PhraseParams) -> DataFrame:
    """Chunks: (chunk, lang, word, local, n, tokens). Chunks are numbered by task: to be written once."""

    def run(batches):
        task, number, builder = TaskContext.get().partitionId(), 0, ChunkBuilder()
        codes: dict[str, int] = {}
        for rows, data, offsets in slices(batches):
            mine = [codes.setdefault(x, len(codes)) for x in rows.column("lang").to_pylist()]
            builder.add(data, offsets, np.array(mine, np.int64))
            if builder.size >= params.chunk_bytes:
                yield from builder.rows(task << 32 | number, list(codes))
                number, builder = number + 1, ChunkBuilder()
        if builder.size:
            yield from builder.rows(task << 32 | number, list(codes))

    named = docs.select("text", F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"))
    return named.mapInArrow(lean(run), "chunk long, lang string, word string, local int, n long, tokens binary")


# -------------------------------------------------------------------- ranking


def ranked(counts: DataFrame, item: str) -> DataFrame:
    """Adds ``id``: 0, 1, ... per language by falling ``n``.

    Items of one frequency are numbered in shares, so no task meets all of the many rare ones.
    """
    shares = 1 + counts.count() // NUMBERED
    share = F.when(F.col("n") < 1000, F.pmod(F.xxhash64(item), F.lit(shares))).otherwise(0).cast("int")
    dealt = counts.withColumn("share", share)
    sizes = dealt.groupBy("lang", "n", "share").agg(F.count("*").alias("size"))
    before = F.sum("size").over(Window.partitionBy("lang").orderBy(F.desc("n"), "share")) - F.col("size")
    within = F.row_number().over(Window.partitionBy("lang", "n", "share").orderBy(item)) - 1
    return (
        dealt.withColumn("within", within)
        .join(sizes.select("lang", "n", "share", before.alias("before")), ["lang", "n", "share"])
        .select(*counts.columns, (F.col("before") + F.col("within")).alias("id"))
    )


def renumbered(tokens: DataFrame, local_ids: DataFrame) -> DataFrame:
    """(chunk, lang, tokens): local numbers replaced by ``id``, those without one by -1."""

    def run(mine: pa.Table, ids: pa.Table) -> pa.Table:
        if not mine.num_rows:
            return mine
        local = np.frombuffer(mine.column("tokens")[0].as_py(), np.int32)
        to = np.full(max(local.max(initial=-1) + 2, 2), -1, np.int32)
        to[ids.column("local").to_numpy()] = ids.column("id").to_numpy()
        to[-1] = -1  # breaks
        return mine.set_column(2, "tokens", pa.array([to[local].tobytes()], pa.binary()))

    return _met(tokens, local_ids, run, "chunk long, lang string, tokens binary")


def _met(tokens: DataFrame, local_ids: DataFrame, run, made: str) -> DataFrame:
    """``run`` over each chunk's tokens of a language and the ids of its local numbers."""
    keys = ["chunk", "lang"]
    # named anew: both sides stem from one table
    ids = local_ids.select(*[F.col(c).alias(c) for c in (*keys, "local", "id")])
    return tokens.select(*keys, "tokens").groupBy(*keys).cogroup(ids.groupBy(*keys)).applyInArrow(run, made)


# -------------------------------------------------------------------- counting


def count_pairs(first: np.ndarray, second: np.ndarray, tile: int) -> tuple[np.ndarray, np.ndarray]:
    """(first << 32 | second, how often) of the pairs that occur, in no order."""
    first, second = first.astype(np.int64), second.astype(np.int64)
    if not len(first):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    across = int(second.max()) // tile + 1
    tile_of = first // tile * across + second // tile
    tiles, size = np.unique(tile_of, return_counts=True) if int(tile_of.max()) > 1 << 24 else (
        np.arange(int(tile_of.max()) + 1), np.bincount(tile_of))
    keys, counts, sparse = [], [], np.ones(len(first), bool)
    for dense in tiles[size * DENSE >= tile * tile]:
        own = np.flatnonzero(tile_of == dense)
        sparse[own] = False
        row, column = int(dense) // across * tile, int(dense) % across * tile
        array = np.bincount((first[own] - row) * tile + second[own] - column, minlength=tile * tile)
        at = np.flatnonzero(array)
        keys.append((at // tile + row) << 32 | at % tile + column)
        counts.append(array[at])
    some, n = np.unique(first[sparse] << 32 | second[sparse], return_counts=True)
    return np.concatenate([*keys, some]), np.concatenate([*counts, n])


def _pairs_of(tokens: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(words, pair of each word and the next; -1 if one of them is none)."""
    word = np.frombuffer(tokens, np.int32).astype(np.int64)
    pair = np.full(len(word), -1, np.int64)
    both = np.flatnonzero((word[:-1] >= 0) & (word[1:] >= 0))
    pair[both] = word[both] << 32 | word[both + 1]
    return word, pair


def _rows(lang: str, pair: np.ndarray, n: np.ndarray):
    for at in range(0, len(pair), 100_000):
        part = slice(at, at + 100_000)
        yield to_batch(_COUNTS, [lang] * len(pair[part]), pair[part], n[part])


def _count_two(chunks: DataFrame, tile: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            for lang, tokens in zip(batch.column("lang").to_pylist(), batch.column("tokens")):
                _, pair = _pairs_of(tokens.as_py())
                pair = pair[pair >= 0]
                for at in range(0, len(pair), COUNTED):
                    part = pair[at : at + COUNTED]
                    yield from _rows(lang, *count_pairs(part >> 32, part & 0xFFFFFFFF, tile))

    return chunks.select("lang", "tokens").mapInArrow(lean(run), "lang string, pair long, n long")


def _three_of(lang: str, word: np.ndarray, rank: np.ndarray, tile: int):
    """Counts of (rank of a frequent pair, the word after it), the last two being frequent as well."""
    at = np.flatnonzero((rank[:-1] >= 0) & (rank[1:] >= 0)) if len(rank) else np.zeros(0, np.int64)
    yield from _rows(lang, *count_pairs(rank[at], word[at + 2], tile))


def _count_three(chunks: DataFrame, pairs: DataFrame, params: PhraseParams) -> DataFrame:
    made = "lang string, pair long, n long"
    if pairs.count() <= params.sent:
        known = {}
        # as Arrow: rows as Python objects would be fifty times as large
        every = pairs.select("lang", "pair", F.col("id").cast("int").alias("id")).toArrow()
        for lang in every.column("lang").unique().to_pylist():
            own = every.filter(pc.equal(every.column("lang"), lang))
            pair, rank = own.column("pair").to_numpy(), own.column("id").to_numpy()
            order = np.argsort(pair)
            known[lang] = pair[order], rank[order]
        sent = chunks.sparkSession.sparkContext.broadcast(known)

        def run(batches):
            for batch in batches:
                for lang, tokens in zip(batch.column("lang").to_pylist(), batch.column("tokens")):
                    if lang in sent.value:
                        pair_of, id_of = sent.value[lang]
                        word, pair = _pairs_of(tokens.as_py())
                        spot = np.minimum(np.searchsorted(pair_of, pair), len(pair_of) - 1)
                        rank = np.where(pair_of[spot] == pair, id_of[spot], -1)
                        yield from _three_of(lang, word, rank, params.tile)

        return chunks.select("lang", "tokens").mapInArrow(lean(run), made)

    def own_pairs(batches):
        schema = pa.schema([("chunk", pa.int64()), ("lang", pa.string()), ("pair", pa.int64()), ("local", pa.int32())])
        for batch in batches:
            for chunk, lang, tokens in zip(*(batch.column(c) for c in ("chunk", "lang", "tokens"))):
                pair = np.unique(_pairs_of(tokens.as_py())[1])
                pair = pair[pair >= 0]
                for at in range(0, len(pair), 100_000):
                    part = pair[at : at + 100_000]
                    yield to_batch(schema, [chunk.as_py()] * len(part), [lang.as_py()] * len(part), part,
                                   np.arange(at, at + len(part), dtype=np.int32))

    def run_joined(mine: pa.Table, ids: pa.Table) -> pa.Table:
        out = []
        if mine.num_rows and ids.num_rows:
            word, pair = _pairs_of(mine.column("tokens")[0].as_py())
            some, at = np.unique(pair, return_inverse=True)
            local = np.full(len(some), -1, np.int64)
            local[ids.column("local").to_numpy() + np.searchsorted(some, 0)] = ids.column("id").to_numpy()
            out = list(_three_of(mine.column("lang")[0].as_py(), word, local[at], params.tile))
        return pa.Table.from_batches(out, _COUNTS)

    local = chunks.mapInArrow(lean(own_pairs), "chunk long, lang string, pair long, local int")
    return _met(chunks, local.join(pairs.select("lang", "pair", "id"), ["lang", "pair"]), run_joined, made)


def _frequent(counts: DataFrame, least: int, *item: str) -> DataFrame:
    return counts.groupBy("lang", *item).agg(F.sum("n").alias("n")).where(F.col("n") >= least)


# --------------------------------------------------------------------- scoring


def _score(a: str, left: str, right: str) -> Column:
    """floor(10^6 a a / (left right)), exact: products of up to 38 digits."""
    wide = {c: f"cast({c} AS decimal(15, 0))" for c in (a, left, right)}
    return F.expr(f"(cast(1000000 AS decimal(7, 0)) * {wide[a]} * {wide[a]}) div ({wide[left]} * {wide[right]})")


def phrases(docs: DataFrame, params: PhraseParams = PhraseParams()) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``top`` phrases."""
    spark = docs.sparkSession
    with Scratch(spark, "collocations") as scratch:
        encoded = scratch.keep(encode(docs, params), "encoded")
        own_words = encoded.where("word is not null")
        words = scratch.keep(ranked(scratch.keep(_frequent(own_words, params.least, "word"), "frequent"), "word"), "words")
        local = own_words.select("chunk", "lang", "word", "local").join(words.select("lang", "word", "id"), ["lang", "word"])
        chunks = scratch.keep(renumbered(encoded.where("word is null"), local), "chunks")
        two = scratch.keep(_frequent(_count_two(chunks, params.tile), params.least, "pair"), "two")
        pairs = scratch.keep(ranked(two, "pair"), "pairs")
        three = scratch.keep(_frequent(_count_three(chunks, pairs, params), params.least, "pair"), "three")
        totals = encoded.where("word is null").groupBy("lang").agg(F.sum("n").alias("n"))
        found = _best(words, pairs, three, totals, params.top)
        return Scratch(spark, "collocations-found").keep(found, "found")


def _best(words: DataFrame, pairs: DataFrame, three: DataFrame, totals: DataFrame, top: int) -> DataFrame:
    first, second = F.shiftright("pair", 32), F.col("pair").bitwiseAND(0xFFFFFFFF)

    def word(place: str) -> DataFrame:
        return words.select("lang", F.col("id").alias(place), F.col("word").alias(f"word_{place}"), F.col("n").alias(f"n_{place}"))

    two = pairs.select("lang", "pair", "id", F.col("n").alias("a"), first.alias("i"), second.alias("j"))
    # of three words: those of the pair that opens it, and the count of the pair that ends it
    long = three.select("lang", first.alias("id"), second.alias("k"), F.col("n").alias("a")).join(
        two.select("lang", "id", "i", "j", F.col("a").alias("n_ij")), ["lang", "id"])
    ending = two.select("lang", F.col("i").alias("j"), F.col("j").alias("k"), F.col("a").alias("n_jk"))
    long = long.join(ending, ["lang", "j", "k"])
    inside = (
        long.select("lang", "a", F.explode(F.array(F.struct("i", "j"), F.struct(F.col("j").alias("i"), F.col("k").alias("j")))).alias("p"))
        .groupBy("lang", "p.i", "p.j").agg(F.max("a").alias("longer"))
    )
    named_two = (
        two.join(inside, ["lang", "i", "j"], "left").where("longer is null or 100 * longer < 50 * a")
        .join(word("i"), ["lang", "i"]).join(word("j"), ["lang", "j"])
        .select("lang", F.concat_ws(" ", "word_i", "word_j").alias("phrase"), "a",
                F.col("n_i").alias("l"), F.col("n_j").alias("r"), _score("a", "n_i", "n_j").alias("score"))
    )
    named_three = (
        long.join(word("i"), ["lang", "i"]).join(word("j"), ["lang", "j"]).join(word("k"), ["lang", "k"])
        .withColumns({"early": _score("a", "n_i", "n_jk"), "late": _score("a", "n_ij", "n_k")})
        .select("lang", F.concat_ws(" ", "word_i", "word_j", "word_k").alias("phrase"), "a",
                F.expr("if(early <= late, n_i, n_ij)").alias("l"), F.expr("if(early <= late, n_jk, n_k)").alias("r"),
                F.least("early", "late").alias("score"))
    )
    # the best of each share first: the last step sees SHARES * top rows of a language, whatever its size
    best_first = F.desc("score"), F.desc("a"), F.col("phrase")
    share = Window.partitionBy("lang", "share").orderBy(*best_first)
    best = (
        named_two.unionByName(named_three).withColumn("share", F.pmod(F.xxhash64("phrase"), F.lit(SHARES)))
        .withColumn("rank", F.row_number().over(share)).where(F.col("rank") <= top)
        .withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best_first))).where(F.col("rank") <= top)
    )
    return best.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
