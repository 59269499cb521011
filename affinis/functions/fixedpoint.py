"""Fixed-point scores.

A DOUBLE sum depends on the order in which tasks deliver their rows, so two
runs can rank near-equal items differently. Scores that are summed are first
turned into whole numbers of 1e-10 ("units"); whole-number sums are exact in
any order, and therefore at any number of partitions.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

UNITS = 1e10
_LOW_BITS = 20
_TOTAL = "decimal(38,0)"
_POWERS, _STEP = (30, 0, -30, -60, -90), 30


def to_units(value: Column) -> Column:
    return F.round(value * F.lit(UNITS)).cast("bigint")


def exact_sum(units: Column) -> Column:
    """Sum of BIGINT units that cannot overflow.

    High and low bits are summed apart in plain longs, which stays in generated
    code and costs far less than a wide decimal per input row.
    """
    high = F.sum(F.shiftright(units, _LOW_BITS)).cast(_TOTAL)
    low = F.sum(units.bitwiseAND(F.lit((1 << _LOW_BITS) - 1))).cast(_TOTAL)
    return (high * F.lit(1 << _LOW_BITS).cast("decimal(10,0)") + low).cast(_TOTAL)


def from_units(total: Column) -> Column:
    return total.cast("double") / F.lit(UNITS)


def exact_total(value: Column) -> Column:
    """Sum of doubles that does not depend on the order of rows, without a grid that has to suit their size.

    Each value is cut into whole numbers of 2^30, 1, 2^-30, 2^-60 and 2^-90 of at
    most 30 bits (the first has the rest), which are summed apart in plain longs.
    All steps but the rounding to 2^-90 are exact.
    """
    total = above = None
    parts = []
    for power in _POWERS:
        upto = F.rint(value * F.lit(2.0**-power))
        parts.append(F.sum((upto if above is None else upto - above * F.lit(2.0**_STEP)).cast("bigint")).cast("double"))
        above = upto
    for power, part in reversed(list(zip(_POWERS, parts))):
        scaled = part * F.lit(2.0**power)
        total = scaled if total is None else total + scaled
    return total


def to_40_bits(value: Column) -> Column:
    """A double with the last 13 bits rounded off, so that quotients equal but for their rounding are equal."""
    wide = value * F.lit(float((1 << 13) + 1))
    return wide - (wide - value)


def to_parts(values: np.ndarray) -> list[np.ndarray]:
    """The whole numbers that ``exact_total`` sums for each value, as arrays."""
    above, parts = None, []
    for power in _POWERS:
        upto = np.rint(values * 2.0**-power)
        parts.append((upto if above is None else upto - above * 2.0**_STEP).astype(np.int64))
        above = upto
    return parts


def from_parts(parts: list[np.ndarray]) -> np.ndarray:
    """Totals of sums of ``to_parts``, by the steps of ``exact_total``."""
    total = None
    for power, part in reversed(list(zip(_POWERS, parts))):
        scaled = part.astype(np.float64) * 2.0**power
        total = scaled if total is None else total + scaled
    return total


def one_part(values: np.ndarray) -> np.ndarray:
    """``from_parts(to_parts(values))``, for totals of one value each: what is below the last power is rounded off."""
    return np.rint(values * 2.0 ** -_POWERS[-1]) * 2.0 ** _POWERS[-1] + 0.0


def forty_bits(values: np.ndarray) -> np.ndarray:
    """``to_40_bits`` of an array."""
    wide = values * float((1 << 13) + 1)
    return wide - (wide - values)


def percent(value: Column, places: int = 4) -> Column:
    """A fraction as text such as ``12.3456%``; NULL stays NULL."""
    return F.concat(F.bround(value * 100, places).cast("string"), F.lit("%"))
