"""Amounts from text and annual amounts in one currency."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tributary.fixed_values import FREQUENCY_MULTIPLIER, USD_RATE
from tributary.functions.text import mapped, strip

_GROUP = r"[0-9]+(?:_[0-9]+)*"
_NUMBER = rf"^[+-]?(?:{_GROUP}[.]?(?:{_GROUP})?|[.]{_GROUP})(?:[eE][+-]?{_GROUP})?$"
_INFINITE = r"(?i)^[+-]?inf(?:inity)?$"


def parsed_amount(text: Column) -> Column:
    """Number in a text such as `$85,000`; null for anything else."""
    bare = strip(F.regexp_replace(text.cast("string"), "[$€£,]", ""))
    number = F.regexp_replace(bare, "_", "").try_cast("double")
    return F.when(bare.rlike(_NUMBER) | bare.rlike(_INFINITE), number)


def annual_amount(
    amount: Column,
    frequency: Column,
    currency: Column,
    multipliers: dict = FREQUENCY_MULTIPLIER,
    rates: dict = USD_RATE,
) -> Column:
    """Amount × payments per year × rate, null if a code is not listed."""
    return amount * mapped(frequency, multipliers) * mapped(currency, rates)
