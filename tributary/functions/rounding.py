"""Rounding of doubles by their exact value."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_SPLITTER = float(2**27 + 1)


def rounded(number: Column, digits: int) -> Column:
    """Nearest multiple of 10^-digits, half to even, for at most 7 digits.

    Spark's `round` and `bround` look at the printed digits: 0.00015 counts as a
    tie, although the double is a little smaller.  Here the doubled, scaled number
    is computed with its rounding error (Dekker 1971), which decides such cases.
    """
    scale = float(10**digits)
    high = number * _SPLITTER - (number * _SPLITTER - number)
    low = number - high
    doubled = number * (2 * scale)
    error = (high * (2 * scale) - doubled) + low * (2 * scale)
    below = F.floor((doubled - 1) / 2)
    odd = (doubled % 2 != 0) & (doubled == F.floor(doubled))
    up = (error > 0) | ((error == 0) & (below % 2 != 0))
    nearest = F.when(odd, below + up.cast("int")).otherwise(F.floor((doubled + 1) / 2))
    return nearest / scale
