"""Language identification by compression: the language whose dictionary helps most.

For each language a raw-content zstandard dictionary is made of pieces of labelled texts, each from a place
in its text that a hash chooses. Every language of the labelled rows has one. A text is
lower-cased and compressed, in chunks, with every dictionary; the language with the smallest total wins. Chunks keep
a long text from becoming its own dictionary. When the runner-up needs nearly as few bytes, the
margin is narrow and the text is rejected.

Defined cases: null text or text without a letter: `und`, score 0, rejected. Equal sizes: the
language with more labelled rows, then the first by name, and rejected. Only one language known:
that one, score 1. None known (no labelled rows, empty table): `und`. Repeated rows: one result
each. Only doc_id, text and lang are read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemart.llm.common import lean, lowered, remainder, text_bytes, to_batch

UNKNOWN = "und"


@dataclass(frozen=True)
class LangParams:
    #: pieces of a language's dictionary and characters of each: bounds a dictionary, not their number
    pieces: int = 128
    piece_chars: int = 384
    chunk_bytes: int = 2048
    level: int = 9
    #: rejected if the runner-up needs less than this share of bytes more
    narrow: float = 0.01


def _piece(params: LangParams) -> Column:
    spare = F.greatest(F.length("text") - params.piece_chars, F.lit(0))
    place = F.pmod(F.xxhash64(F.lit("piece"), "text"), spare + 1).cast("int")
    return F.lower(F.substring("text", place + 1, F.lit(params.piece_chars)))


def fit(docs: DataFrame, params: LangParams = LangParams()) -> list[tuple[str, bytes]]:
    """(language, dictionary) by falling number of labelled rows, from rows outside the held-out fold.

    The pieces are those with the least hashes among a language's texts: a bounded sample spread
    over the whole table, in which a text that is copied often counts once.
    """
    known = docs.where(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & (F.length("text") > 0) & (remainder("doc_id", 4) != 2)
    ).select("lang", _piece(params).alias("piece")).withColumn("h", F.xxhash64("piece"))
    sizes = known.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").collect()
    names = [r["lang"] for r in sizes]
    if not names:
        return []
    # the least of each of 64 shares first, then the least of those: however many tasks and texts a
    # language has, the last step sees 64 * pieces rows of it
    share, whole = Window.partitionBy("lang", "share").orderBy("h"), Window.partitionBy("lang").orderBy("h")
    chosen = (
        known.groupBy("lang", "h").agg(F.count("*").alias("copies"))
        .withColumn("share", F.pmod(F.xxhash64("h"), F.lit(64)))
        .withColumn("rank", F.row_number().over(share)).where(F.col("rank") <= params.pieces)
        .withColumn("rank", F.row_number().over(whole)).where(F.col("rank") <= params.pieces).select("lang", "h")
    )
    # at most pieces * languages rows of two values
    rows = known.join(F.broadcast(chosen), ["lang", "h"]).groupBy("lang", "h").agg(F.first("piece").alias("piece")).collect()
    pieces: dict[str, list[tuple[int, str]]] = {}
    for r in rows:
        pieces.setdefault(r["lang"], []).append((r["h"], r["piece"]))
    return [(n, "\n".join(p for _, p in sorted(pieces[n])).encode()) for n in names if n in pieces]


def _lettered() -> Column:
    return F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))


def _compressors(dictionaries: list[tuple[str, bytes]], level: int) -> list[zstandard.ZstdCompressor]:
    made = []
    for _, content in dictionaries:
        d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        d.precompute_compress(level=level)
        made.append(zstandard.ZstdCompressor(dict_data=d, write_content_size=False, write_dict_id=False))
    return made


def judge(text: memoryview, compressors: list, chunk: int) -> tuple[int, float]:
    """(best dictionary, share by which the runner-up needs more bytes)."""
    sizes = [sum(len(c.compress(text[i : i + chunk])) for i in range(0, len(text), chunk)) for c in compressors]
    best = min(range(len(sizes)), key=lambda i: (sizes[i], i))
    if len(sizes) == 1:
        return best, 1.0
    second = min(s for i, s in enumerate(sizes) if i != best)
    return best, (second - sizes[best]) / second


def identify(docs: DataFrame, dictionaries: list[tuple[str, bytes]], params: LangParams = LangParams()) -> DataFrame:
    """(doc_id, lang_pred, score, margin, rejected); score rises from 0.5 with the margin."""
    sent = docs.sparkSession.sparkContext.broadcast(dictionaries)
    schema = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64()),
                        ("margin", pa.float64()), ("rejected", pa.bool_())])

    def run(batches):
        names, compressors = [n for n, _ in sent.value], _compressors(sent.value, params.level)
        for batch in batches:
            data, offsets = text_bytes(lowered(batch.column("text")))
            view, lettered = memoryview(data), batch.column("lettered").to_pylist()
            langs, scores, margins = [], np.zeros(len(lettered)), np.zeros(len(lettered))
            for i, has_letter in enumerate(lettered):
                if not has_letter or not names:
                    langs.append(UNKNOWN)
                    continue
                best, margins[i] = judge(view[offsets[i] : offsets[i + 1]], compressors, params.chunk_bytes)
                langs.append(names[best])
                scores[i] = 1 / (1 + np.exp(-50 * margins[i])) if len(names) > 1 else 1.0
            unknown = np.array([n == UNKNOWN for n in langs], bool)
            yield to_batch(schema, batch.column("doc_id").cast(pa.int64()), langs, scores, margins,
                           unknown | (margins < params.narrow))

    return docs.select("doc_id", "text", _lettered().alias("lettered")).mapInArrow(
        lean(run), "doc_id long, lang_pred string, score double, margin double, rejected boolean")


def keep_identified(docs: DataFrame, params: LangParams = LangParams()) -> DataFrame:
    """The rows of ``docs`` whose language is found with a sufficient margin, with all their columns.

    Rows pass through as Arrow batches: a task holds one batch and its texts in lower case.
    """
    sent = docs.sparkSession.sparkContext.broadcast(fit(docs, params))
    at, n = docs.columns.index("text"), len(docs.columns)

    def run(batches):
        compressors = _compressors(sent.value, params.level)
        for batch in batches:
            data, offsets = text_bytes(lowered(batch.column(at)))
            view, has_letter = memoryview(data), batch.column(n).to_pylist()
            kept = [
                bool(compressors) and has_letter[i]
                and judge(view[offsets[i] : offsets[i + 1]], compressors, params.chunk_bytes)[1] >= params.narrow
                for i in range(batch.num_rows)
            ]
            yield batch.select(range(n)).filter(pa.array(kept, pa.bool_()))

    flag = "lettered"
    while flag in docs.columns:
        flag = f"_{flag}"
    return docs.select("*", _lettered().alias(flag)).mapInArrow(lean(run), docs.schema)
