"""Quality rules: counts over words and lines, and compression bands.

A text that passes the base rules (enough words, not mostly repeated windows) is compressed whole and
in fixed chunks with zstandard. The ratio, compressed over raw bytes, must lie in the band for the
length: below it the text repeats itself, above it there is nothing to compress (keys, encoded data).
Short texts compress badly, so their bands lie higher. A rest shorter than a chunk is judged in a last
chunk that ends with the text, so every byte of a text of a chunk or more lies in one; shorter texts have none.

Defined cases: null or empty text has no words and fails the base rules. Texts shorter than the
first band have no upper or lower limit. Repeated rows: one result each; an empty table: none. Only
doc_id and text are read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from tidemart.llm.common import slices, to_batch
from tidemart.llm.textstats import TextCounts


@dataclass(frozen=True)
class RuleParams:
    min_words: int = 20
    repeat_window: int = 8
    max_repeat_percent: int = 30
    level: int = 3
    #: bytes from which on, least and largest ratio of the whole text
    bands: tuple[tuple[int, float, float], ...] = (
        (64, 0.25, 1.05), (256, 0.20, 0.95), (1024, 0.16, 0.85), (4096, 0.13, 0.78), (16384, 0.10, 0.72),
    )
    chunk_bytes: int = 4096
    chunk_band: tuple[float, float] = (0.11, 0.80)


FIELDS = [("doc_id", pa.int64()), ("n_words", pa.int64()), ("word_chars", pa.int64()), ("n_symbols", pa.int64()),
          ("n_dup_lines", pa.int64()), ("n_repeat_words", pa.int64()), ("base_failed", pa.bool_()), ("kept", pa.bool_()),
          ("ratio", pa.float64()), ("least_chunk", pa.float64()), ("largest_chunk", pa.float64()), ("reason", pa.string())]
SCHEMA = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "base_failed boolean, kept boolean, ratio double, least_chunk double, largest_chunk double, reason string")


def ratios(raw: bytes, compressor, chunk: int) -> tuple[float, float, float]:
    """(ratio of the whole, least and largest ratio of chunks or nan); the last chunk ends with the text."""
    whole = len(compressor.compress(raw)) / len(raw)
    starts = list(range(0, len(raw) - chunk + 1, chunk))
    if starts and len(raw) % chunk:
        starts.append(len(raw) - chunk)
    each = [len(compressor.compress(raw[i : i + chunk])) / chunk for i in starts]
    return whole, min(each, default=np.nan), max(each, default=np.nan)


def verdict(size: int, whole: float, least: float, largest: float, params: RuleParams) -> str | None:
    """Why the bands reject a text, or None."""
    band = next(((lo, hi) for start, lo, hi in reversed(params.bands) if size >= start), None)
    if band is None:
        return None
    if whole < band[0] or least < params.chunk_band[0]:
        return "repetitive"
    if whole > band[1] or largest > params.chunk_band[1]:
        return "incompressible"
    return None


def judge(docs: DataFrame, params: RuleParams = RuleParams()) -> DataFrame:
    """Counts, ratios and verdict (SCHEMA) for every row of ``docs``."""
    schema = pa.schema(FIELDS)

    def run(batches):
        compressor = zstandard.ZstdCompressor(level=params.level, write_content_size=False)
        for rows, data, offsets in slices(batches):
            t = TextCounts(data, offsets)
            repeat = t.per_doc(t.repeated_words(params.repeat_window)).astype(np.int64)
            words = t.n_words.astype(np.int64)
            failed = (words < params.min_words) | (100 * repeat > params.max_repeat_percent * words)
            ratio, reasons = np.full((t.n_docs, 3), np.nan), []
            for i in range(t.n_docs):
                raw = data[offsets[i] : offsets[i + 1]].tobytes()
                if raw:
                    ratio[i] = ratios(raw, compressor, params.chunk_bytes)
                reasons.append("base" if failed[i] else verdict(len(raw), *ratio[i], params))
            empty = np.isnan(ratio)
            shown = [pa.array(ratio[:, k], pa.float64(), mask=empty[:, k]) for k in range(3)]
            yield to_batch(schema, rows.column("doc_id").cast(pa.int64()), words, t.word_chars(), t.n_symbols(),
                           t.n_dup_lines(), repeat, failed, [r is None for r in reasons], *shown, reasons)

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)
