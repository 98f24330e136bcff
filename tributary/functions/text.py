"""Text cleaning and matching keys."""

from __future__ import annotations

import unicodedata
from functools import reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tributary.fixed_values import NA_TOKENS

# Unicode white space plus the four ASCII separators that \s leaves out
WHITESPACE = r"(?U)[\s\x1c-\x1f]"

_NAME_SEPARATORS = str.maketrans("-',", "   ")


def _tidy(name):
    if name is None:
        return None
    return " ".join(unicodedata.normalize("NFC", name).translate(_NAME_SEPARATORS).split()).title()


@F.pandas_udf(T.StringType())
def clean_name(names: pd.Series) -> pd.Series:
    """NFC, separators to blanks, single blanks, title case; null stays null.

    An Arrow function because Spark has no Unicode normalisation and `initcap`
    leaves `3rd` and `o.brien` as they are.
    """
    return names.map(_tidy)


def full_name(first: Column, last: Column) -> Column:
    return F.concat(first, F.lit(" "), last)


def strip(text: Column) -> Column:
    return F.regexp_replace(text, f"^{WHITESPACE}+|{WHITESPACE}+$", "")


def match_key(text: Column) -> Column:
    """Lower case without outer white space; an empty text stays a key."""
    return strip(F.lower(text))


def block_key(text: Column) -> Column:
    """First character in upper case, `?` where there is none."""
    return F.coalesce(F.upper(F.nullif(F.substring(text, 1, 1), F.lit(""))), F.lit("?"))


def token_sorted(text: Column) -> Column:
    """Words of the text in code-point order, joined by one blank."""
    words = F.filter(F.split(text, f"{WHITESPACE}+"), lambda word: word != "")
    return F.array_join(F.array_sort(words), " ")


def missing_to_null(text: Column, tokens=NA_TOKENS) -> Column:
    """Null for the untrimmed texts that files use for "missing"."""
    return F.when(~text.isin(list(tokens)), text)


def mapped(code: Column, mapping: dict) -> Column:
    """Value of a small code list; null for codes that are not in it."""
    entries = [F.lit(part) for pair in mapping.items() for part in pair]
    return F.try_element_at(F.create_map(*entries), code)


def check_label(check: Column) -> Column:
    """Short label of a quality check: without its type, with `emp_id`."""
    return F.replace(
        F.regexp_replace(check, "^.*?: ", ""), F.lit("employee_id"), F.lit("emp_id")
    )


def conjunction(conditions) -> Column:
    return reduce(lambda left, right: left & right, conditions)
