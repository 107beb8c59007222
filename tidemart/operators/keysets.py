"""Sets of keys that are small enough to be sent to all tasks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
#: rows of keys that are sent to all tasks; more are joined by Spark's own choice
SENT_KEYS = 1 << 20
WORD, BITS = "_word", "_bits"


def word_of(key: Column) -> Column:
    """Whole numbers share a word with their 63 neighbours."""
    return F.shiftright(key.cast("long"), 6)


def _place(key: Column) -> Column:
    return key.cast("long").bitwiseAND(F.lit(63)).cast("int")


def packed(keys: DataFrame, key: str) -> DataFrame:
    """(word, bits) of whole-number keys, exact, one row for up to 64 of them; nulls are left out."""
    at = F.col(key)
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), _place(at))
    return keys.where(at.isNotNull()).groupBy(word_of(at).alias(WORD)).agg(F.bit_or(bit).alias(BITS))


def holds(key: Column, bits: Column) -> Column:
    """Is the key's bit set in the word it has met; false where it has met none."""
    return F.coalesce(F.bit_get(bits, _place(key)) == 1, F.lit(False))


def of_keys(df: DataFrame, col: str, keys: DataFrame, key: str) -> DataFrame:
    """Rows whose ``col`` is among ``keys``, which are kept ones: they are counted first.

    While whole numbers pack into ``SENT_KEYS`` words, rows meet them where they are and none is shuffled.
    """
    whole = all(isinstance(t.schema[c].dataType, WHOLE) for t, c in ((df, col), (keys, key)))
    words = packed(keys, key) if whole else None
    if words is None or words.count() > SENT_KEYS:
        return df.join(keys.select(F.col(key).alias(WORD)), F.col(col) == F.col(WORD), "left_semi")
    met = (word_of(F.col(col)) == F.col(WORD)) & holds(F.col(col), F.col(BITS))
    return df.join(F.broadcast(words), met, "left_semi")
