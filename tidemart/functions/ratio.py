"""Money and ratio arithmetic that gives the same digits on every run and partitioning."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"
_WIDE = "decimal(38,0)"


def money(c: Column, scale: int = 2) -> Column:
    """A money amount as exact decimal; text that is no number becomes null."""
    return c.try_cast(f"decimal(18,{scale})")


def _unscaled(c: Column, scale: int) -> Column:
    return (c * F.lit(10**scale)).cast(_WIDE) if scale else c.cast(_WIDE)


def exact_ratio(
    num: Column, den: Column, scale: int, num_scale: int = 0, den_scale: int = 0
) -> Column:
    """num/den rounded half away from zero to ``scale`` digits, by integer division.

    ``num_scale``/``den_scale`` say how many fractional digits the inputs carry. A zero
    or null denominator gives null.
    """
    top, bottom = _unscaled(num, num_scale), _unscaled(den, den_scale)
    shift = scale + den_scale - num_scale
    a, b = F.abs(top), F.abs(bottom)
    if shift >= 0:
        a = a * F.lit(Decimal(10**shift))
    else:
        b = b * F.lit(Decimal(10**-shift))
    halves = (a * 2 + b).cast(_WIDE)
    digits = F.call_function("div", halves, (b * 2).cast(_WIDE))
    sign = F.when((top < 0) != (bottom < 0), -1).otherwise(1)
    value = (digits * sign).cast("decimal(20,0)") * F.lit(Decimal(1).scaleb(-scale))
    return F.when(bottom != 0, value.cast(f"decimal(24,{scale})"))


def percent(part: Column, whole: Column, scale: int = 2, part_scale=0, whole_scale=0) -> Column:
    """100*part/whole, rounded; null when whole is zero."""
    return exact_ratio(part * 100, whole, scale, part_scale, whole_scale)


def safe_divide(num: Column, den: Column) -> Column:
    """Quotient; 0 where the denominator is null or 0, null where only the numerator is null."""
    empty = F.coalesce(den.cast("double"), F.lit(0.0)) == 0.0
    return F.when(empty, F.lit(0.0)).otherwise(num.cast("double") / den.cast("double"))


def nullif_divide(num: Column, den: Column) -> Column:
    """Quotient; null where the denominator is 0."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def safe_ratio(num: Column, den: Column, scale: int, num_scale=0, den_scale=0) -> Column:
    """``exact_ratio`` with the zero default of ``safe_divide``."""
    empty = F.coalesce(den, F.lit(0)) == 0
    return F.when(empty, F.lit(Decimal(0))).otherwise(
        exact_ratio(num, den, scale, num_scale, den_scale)
    ).cast(f"decimal(24,{scale})")
