"""Namespaced identifiers such as GT-000042."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tributary.fixed_values import COMPANY_A, COMPANY_B, ID_WIDTH
from tributary.functions.text import strip

_INTEGER = r"^[+-]?[0-9]+(_[0-9]+)*$"
_INTEGER_WITH_FRACTION = r"^[+-]?[0-9]+(_[0-9]+)*([.][0-9]+)?$"


def padded_integer(text: Column, pattern: str = _INTEGER, width: int = ID_WIDTH) -> Column:
    """Integer text padded with zeros to `width`, null if it is not a number.

    Longer numbers keep all their digits, a sign takes part in the width, and a
    fraction is cut off where the pattern allows one.
    """
    number = strip(text)
    whole = F.regexp_replace(F.regexp_replace(number, "[.].*$", ""), "[+_-]", "")
    digits = F.regexp_replace(whole, "^0+(?=[0-9])", "")
    sign = F.when(number.startswith("-") & (digits != "0"), "-").otherwise("")
    padding = F.lit(width) - F.length(sign) - F.length(digits)
    zeros = F.when(padding > 0, F.repeat(F.lit("0"), padding)).otherwise("")
    return F.when(number.rlike(pattern), F.concat(sign, zeros, digits))


def company_a_id(raw: Column, prefix: str = "GT-") -> Column:
    """Integer, or a number that lost its integer type to missing neighbours."""
    return F.coalesce(F.concat(F.lit(prefix), padded_integer(raw, _INTEGER_WITH_FRACTION)), raw)


def company_b_id(raw: Column, prefix: str = "AC-") -> Column:
    """Integer after the last underscore."""
    number = padded_integer(F.element_at(F.split(raw, "_"), -1))
    return F.coalesce(F.concat(F.lit(prefix), number), raw)


def namespaced_id(raw: Column, origin: Column) -> Column:
    """Identifier by company; unconvertible and foreign ones stay as they are."""
    text = raw.cast("string")
    return (
        F.when(origin == COMPANY_A, company_a_id(text))
        .when(origin == COMPANY_B, company_b_id(text))
        .otherwise(text)
    )
