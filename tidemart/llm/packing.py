"""Best-fit packing of tokenised documents by minimum bin slack.

A document's token ids (with a closing id) are one piece, or, if longer than a sequence, cut into
pieces of the full length and a rest. Pieces of one length are alike, so a plan needs only how many
there are of each length: at most `capacity` counts, however many documents. The plan repeats one
step: seed a sequence with the longest piece left and find, by a subset-sum over the lengths left
(a bit set of reachable sums, each length as often as it is left), the fullest combination for the
room that remains; make that combination as often as the counts allow. Spark numbers the pieces of
each length and looks up the place of each number.

Defined cases: null text is empty and has the closing id only. Repeated rows are packed each. An
empty table packs nothing. Only doc_id and text are read. Numbering needs no order between alike
pieces; rows that agree in id, piece and content are interchangeable.
"""

from __future__ import annotations

import json
import os
import zlib
from array import array
from dataclasses import dataclass
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemart.llm.common import held, lean, text_bytes, to_batch
from tidemart.session import Scratch

#: pieces of one length that are numbered together, at least; their square root if that is more
NUMBERED = 500


@dataclass(frozen=True)
class PackParams:
    tokenizer: str  # path of a tokenizer file, the same on every machine
    capacity: int = 2048
    closing_id: int = 0
    #: words whose ids a process remembers
    remembered: int = 700_000


#: What makes the ids of a text those of its words in a row. A tokenizer of this make lower-cases,
#: drops white space, and splits words and marks apart before it merges; others encode whole texts.
_NORMALIZERS = {"NFC", "Lowercase", "Replace"}


def splits_at_spaces(described: dict) -> bool:
    """Does a tokenizer (its file, read as JSON) never look across white space, and drop it?"""
    normal = described.get("normalizer") or {}
    steps = normal.get("normalizers", [normal])
    split = described.get("pre_tokenizer") or {}
    first = (split.get("pretokenizers") or [split])[0]
    return (
        {s.get("type") for s in steps} <= _NORMALIZERS and any(s.get("type") == "Lowercase" for s in steps)
        and all(s.get("pattern", {}).get("Regex") == r"\s+" and s.get("content") == " " for s in steps if s.get("type") == "Replace")
        and first.get("type") == "Split" and first.get("behavior") == "Removed" and first.get("invert") is True
    )


class Encoder:
    """Token ids of texts as little-endian unsigned 32-bit numbers.

    Where the tokenizer drops white space and never looks across it, and lower-cases, a text's ids are those
    of its words in a row; the ids of words seen before are remembered, up to a bound. That is read off the
    tokenizer's file; with any other, each text is encoded as a whole.
    """

    SPACES = bytes.maketrans(b"\t\n\r", b"   ")

    def __init__(self, path: str, remembered: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark deals out the cores
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            self.by_words = splits_at_spaces(json.load(file))
        #: words with such a string in them are ids of their own there
        self.special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.remembered, self.known, self.new = remembered, {b"": b""}, 0

    def _encode(self, texts: list[bytes]) -> list[bytes]:
        got = self.tokenizer.encode_batch_fast([t.decode() for t in texts], add_special_tokens=False)
        return [array("I", e.ids).tobytes() for e in got]

    def _learn(self, words: set[bytes]) -> dict[bytes, bytes]:
        """Ids of words not remembered; as many are as there is room for."""
        # a word that ends in one point or comma: the ids of the rest, then those of the mark
        marked = {w for w in words if len(w) > 1 and w[-1:] in b".," and 97 <= w[-2] <= 122}
        need = (words - marked) | {w[:-1] for w in marked} | ({w[-1:] for w in marked})
        plain = [w for w in need if w not in self.known]
        learnt = dict(zip(plain, self._encode(plain)))
        found = {**learnt, **{w: self.known[w] for w in need if w in self.known}}
        for w in marked:
            learnt[w] = found[w[:-1]] + found[w[-1:]]
        self.new += len(words)
        if self.new > 16 * self.remembered:  # texts have become others
            self.known, self.new = {b"": b""}, 0
        for w, ids in learnt.items():
            if len(self.known) >= self.remembered:
                break
            self.known[w] = ids
        return {**found, **learnt}

    def encode(self, text: bytes) -> bytes:
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[bytes]) -> list[bytes]:
        """Ids of each text; words that are new to several are learnt once."""
        if not self.by_words:
            return self._encode(texts)
        whole = {i for i, t in enumerate(texts) if any(s in t for s in self.special)}
        out: list = [None] * len(texts)
        for i, ids in zip(whole, self._encode([texts[i] for i in whole]) if whole else ()):
            out[i] = ids
        # lower-casing ASCII before the tokenizer does changes nothing but the number of words
        parts = {i: t.lower().translate(self.SPACES).split(b" ") for i, t in enumerate(texts) if i not in whole}
        found = {i: list(map(self.known.get, words)) for i, words in parts.items()}
        missing: dict[int, list[int]] = {}
        for i, ids in found.items():
            at, places = -1, []
            try:
                while True:
                    at = ids.index(None, at + 1)
                    places.append(at)
            except ValueError:
                pass
            missing[i] = places
        learnt = self._learn({parts[i][k] for i, places in missing.items() for k in places})
        for i, places in missing.items():
            for k in places:
                found[i][k] = learnt[parts[i][k]]
            out[i] = b"".join(found[i])
        return out


def pieces(docs: DataFrame, params: PackParams, with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32), and ids (little-endian 32-bit) if asked for."""
    fields = [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
              ("ids_crc32", pa.int64())] + ([("ids", pa.binary())] if with_ids else [])
    schema = pa.schema(fields)
    closing = np.array([params.closing_id], "<u4").tobytes()
    step, key = 4 * params.capacity, ("encoder", params.tokenizer, params.remembered)

    def run(batches):
        encoder = held(key, lambda: Encoder(params.tokenizer, params.remembered))
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            ids_of_docs = batch.column("doc_id").cast(pa.int64()).to_pylist()
            raw = data.tobytes()
            for first in range(0, len(ids_of_docs), 250):
                rows, last = [], min(first + 250, len(ids_of_docs))
                encoded = encoder.encode_all([raw[offsets[i] : offsets[i + 1]] for i in range(first, last)])
                for i, own in zip(range(first, last), encoded):
                    ids = own + closing
                    for n, at in enumerate(range(0, len(ids), step)):
                        part = ids[at : at + step]
                        rows.append((ids_of_docs[i], n, at // 4, len(part) // 4, zlib.crc32(part), part)[: len(fields)])
                yield to_batch(schema, *zip(*rows))

    made = "doc_id long, piece int, start long, length long, ids_crc32 long" + (", ids binary" if with_ids else "")
    return docs.select("doc_id", "text").mapInArrow(lean(run, key), made)


def fullest(counts: dict[int, int], room: int) -> dict[int, int]:
    """How often to take each length so that the sum is the largest that fits into ``room``."""
    if room <= 0:
        return {}
    mask, reach, steps = (1 << (room + 1)) - 1, 1, []
    for length in sorted((n for n, c in counts.items() if c > 0 and n <= room), reverse=True):
        left, times = min(counts[length], room // length), 1
        while left:
            take = min(times, left)
            steps.append((reach, length, take))
            reach |= reach << (length * take) & mask
            left -= take
            times *= 2
        if reach >> room & 1:
            break
    target = reach.bit_length() - 1
    taken: dict[int, int] = {}
    for before, length, take in reversed(steps):
        if not before >> target & 1:
            taken[length] = taken.get(length, 0) + take
            target -= length * take
    return taken


def plan(counts: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """(lengths of a sequence with how often each, number of such sequences) until nothing is left."""
    left = {n: c for n, c in counts.items() if c}
    out = []
    for seed in sorted(left, reverse=True):
        while left[seed]:
            left[seed] -= 1
            made = fullest(left, capacity - seed)
            left[seed] += 1
            made[seed] = made.get(seed, 0) + 1
            times = min(left[n] // k for n, k in made.items())
            for n, k in made.items():
                left[n] -= k * times
            out.append((made, times))
    return out


def segments(made: list[tuple[dict[int, int], int]]) -> dict[int, np.ndarray]:
    """For each length rows (first number, first sequence, offset), by rising first number."""
    used: dict[int, int] = {}
    rows: dict[int, list[tuple[int, int, int]]] = {}
    sequence = 0
    for lengths, times in made:
        offset = 0
        for n, k in sorted(lengths.items(), reverse=True):
            for _ in range(k):
                rows.setdefault(n, []).append((used.get(n, 0), sequence, offset))
                used[n] = used.get(n, 0) + times
                offset += n
        sequence += times
    return {n: np.array(r, np.int64) for n, r in rows.items()}


def numbered(parts: DataFrame, largest: int) -> DataFrame:
    """Adds ``number``: 0, 1, ... within each length.

    The ``largest`` count of a length is cut into shares of about its square root, so neither the
    numbering within a share nor the sums over the shares of a length meet more rows than that.
    """
    share = max(1, -(-largest // max(NUMBERED, isqrt(largest))))
    key = [c for c in ("doc_id", "piece", "start", "ids_crc32") if c in parts.columns]
    dealt = parts.withColumn("share", F.pmod(F.xxhash64(*key), F.lit(share)).cast("int"))
    sizes = dealt.groupBy("length", "share").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("share")) - F.col("n")
    within = F.row_number().over(Window.partitionBy("length", "share").orderBy(*key)) - 1
    return (
        dealt.withColumn("within", within)
        .join(sizes.select("length", "share", before.alias("before")), ["length", "share"])
        .withColumn("number", F.col("within") + F.col("before")).drop("share", "within", "before")
    )


def pack(docs: DataFrame, params: PackParams, with_ids: bool = False) -> DataFrame:
    """The pieces with their sequence_id and offset in it."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "packing")
    parts = scratch.keep(pieces(docs, params, with_ids), "pieces")
    counts = {r["length"]: r["n"] for r in parts.groupBy("length").agg(F.count("*").alias("n")).collect()}
    places = spark.sparkContext.broadcast(segments(plan(counts, params.capacity)))
    extra = [c for c in ("ids",) if c in parts.columns]
    schema = pa.schema(
        [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
         ("ids_crc32", pa.int64()), *[(c, pa.binary()) for c in extra], ("sequence_id", pa.int64()), ("offset", pa.int64())])
    names = ["doc_id", "piece", "start", "length", "ids_crc32", *extra]

    def place(batches):
        for batch in batches:
            length, number = batch.column("length").to_numpy(), batch.column("number").to_numpy()
            sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            for n in np.unique(length):
                own = np.flatnonzero(length == n)
                rows = places.value[int(n)]
                at = np.searchsorted(rows[:, 0], number[own], side="right") - 1
                sequence[own] = rows[at, 1] + number[own] - rows[at, 0]
                offset[own] = rows[at, 2]
            yield to_batch(schema, *[batch.column(c) for c in names], sequence, offset)

    made = "doc_id long, piece int, start long, length long, ids_crc32 long, " + "".join(f"{c} binary, " for c in extra)
    return numbered(parts, max(counts.values(), default=0)).select(*names, "number").mapInArrow(
        lean(place), made + "sequence_id long, offset long")
