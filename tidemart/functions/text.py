"""Standardisation of free-text attributes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemart.contracts import CITY_NAMES, PAYMENT_STATUS_NAMES

UNKNOWN = "Unknown"


def sql_literal(value: str | None) -> str:
    """A text constant as SQL. One parsed expression is far cheaper to build than a column
    object per constant."""
    if value is None:
        return "null"
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def canonicalize(c: Column, lookup: dict[str, str], fallback: Column) -> Column:
    """Canonical spelling by trimmed, case-blind lookup; ``fallback`` where it is not listed."""
    pairs = ", ".join(f"{sql_literal(k)}, {sql_literal(v)}" for k, v in lookup.items())
    table = F.expr(f"map({pairs})")
    return F.coalesce(table[F.lower(F.trim(c))], fallback)


def title(c: Column) -> Column:
    return F.initcap(F.trim(c))


def standard_city(c: Column) -> Column:
    return canonicalize(c, CITY_NAMES, title(c))


def standard_payment_status(c: Column) -> Column:
    return canonicalize(c, PAYMENT_STATUS_NAMES, F.lit("unknown"))


# The patterns that decide a category's spelling.
SPELLED_AND, LEFT_OVER_AND = r"\s+and\s+", r"\bAnd\b"


def standard_category(c: Column) -> Column:
    """One casing and '&' for a spelled-out 'and'."""
    joined = F.trim(F.regexp_replace(F.lower(c), SPELLED_AND, " & "))
    return F.regexp_replace(F.initcap(joined), LEFT_OVER_AND, "&")


def or_unknown(c: Column) -> Column:
    return F.coalesce(c, F.lit(UNKNOWN))


def blank_to_unknown(c: Column) -> Column:
    """Null, empty and all-blank text read as Unknown."""
    return or_unknown(F.nullif(F.trim(c), F.lit("")))


def normal_key(c: Column) -> Column:
    """Form used for case-blind set membership."""
    return F.lower(F.trim(c))
