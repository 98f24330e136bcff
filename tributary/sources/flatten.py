"""Nested objects as parent_child columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _leaves(fields: list[T.StructField], parents: tuple[str, ...], keep: tuple[str, ...]):
    for field in fields:
        path = (*parents, field.name)
        if isinstance(field.dataType, T.StructType) and field.name not in keep:
            yield from _leaves(field.dataType.fields, path, ())
        else:
            yield path


def _field(path: tuple[str, ...]) -> Column:
    column = F.col(f"`{path[0]}`")
    for name in path[1:]:
        column = column.getField(name)
    return column


def flatten(df: DataFrame, separator: str = "_", keep: tuple[str, ...] = ()) -> DataFrame:
    """Every object field as a column of its own, at any depth.

    Arrays and the columns named in `keep` stay whole.
    """
    paths = _leaves(df.schema.fields, (), keep)
    return df.select(*[_field(path).alias(separator.join(path)) for path in paths])
