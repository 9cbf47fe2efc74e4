"""Money and other numbers.

``round2`` and the like mention their input several times. Inside a larger job, compute the
input in a projection of its own first, as ``functions.frames`` does; Catalyst keeps such
projections apart, so each value is computed once and the generated code stays small.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# From 2**46 on, neighbouring doubles lie further apart than a cent: nothing to round.
_ROUND_LIMIT = float(2**46)
# Veltkamp's constant for splitting a double into two halves.
_SPLIT = float(2**27 + 1)


# A Java literal suffix as in ``12f``; the ``f`` of ``inf`` is none.
_SUFFIX = "(?<![nN])[dDfF]$"


def to_double(value: Column) -> Column:
    """Number from text; null when it is not one."""
    return F.when(~value.rlike(_SUFFIX), value.try_cast("double"))


def to_long(value: Column) -> Column:
    return value.try_cast("bigint")


def round2(value: Column, factor: float = 100.0) -> Column:
    """Two decimals (or ``1 / factor``), nearest to the exact binary value, ties to even.

    ``round`` works on the shortest decimal text, so 2.675 (in binary a little less) would
    give 2.68. Here the part lost in ``value * factor`` is kept and decides near-ties.
    """
    scale = F.lit(factor)
    scaled = value * scale
    spread = value * F.lit(_SPLIT)
    high = spread - (spread - value)
    low = value - high
    lost = (high * scale - scaled) + low * scale
    whole = F.rint(scaled)
    rest = scaled - whole
    return (
        F.when(F.abs(value) >= _ROUND_LIMIT, value)
        .when((rest == 0.5) & (lost > 0), (whole + 1.0) / scale)
        .when((rest == -0.5) & (lost < 0), (whole - 1.0) / scale)
        .otherwise(whole / scale)
    )


def amount_of(number: Column, in_cents: bool = False) -> Column:
    """The number to be rounded: in units, and 0.0 for null and NaN."""
    number = F.coalesce(F.nanvl(number, F.lit(0.0)), F.lit(0.0))
    return number / F.lit(100.0) if in_cents else number


def money(value: Column, in_cents: bool = False) -> Column:
    """Amount in currency units with two decimals; 0.0 for null, NaN and what is no number."""
    return round2(amount_of(to_double(value.cast("string")), in_cents))


def net_amount(amount: Column, refunded: Column) -> Column:
    return round2(amount - refunded)
