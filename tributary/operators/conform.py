"""Bringing sources to one schema and stacking them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tributary.fixed_values import (
    CANONICAL_COLUMNS,
    COMPANY_UNKNOWN,
    EMPLOYMENT_CODES,
    ORIGIN_BY_SOURCE,
)
from tributary.functions.text import mapped


def tag_source(df: DataFrame, tag: str) -> DataFrame:
    return df.withColumn("source", F.lit(tag))


def map_codes(df: DataFrame, column: str, mapping: dict = EMPLOYMENT_CODES) -> DataFrame:
    """Replace short codes by their values, codes that are not listed by null."""
    return df.withColumn(column, mapped(F.col(column), mapping))


def map_codes_from(df: DataFrame, column: str, table: DataFrame) -> DataFrame:
    """The same with a table `(code, value)` of any size; Spark picks the join."""
    values = table.select(F.col("code").alias("_code"), F.col("value").alias("_value"))
    joined = df.join(values, F.col(column) == F.col("_code"), "left")
    return joined.select(
        *[F.col("_value").alias(name) if name == column else F.col(name) for name in df.columns]
    )


def unmapped_values(df: DataFrame, column: str, mapping: dict) -> DataFrame:
    """Distinct non-null values that the mapping does not know."""
    unknown = F.col(column).isNotNull() & mapped(F.col(column), mapping).isNull()
    return df.where(unknown).select(column).distinct()


def origin_of(source: Column, origins: dict = ORIGIN_BY_SOURCE) -> Column:
    return F.coalesce(mapped(source, origins), F.lit(COMPANY_UNKNOWN))


def conform(
    df: DataFrame,
    source: str,
    renames: dict | None = None,
    columns: list[str] = CANONICAL_COLUMNS,
    origins: dict = ORIGIN_BY_SOURCE,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Renamed to the canonical columns: absent ones null, others left out.

    `keep` names helper columns, such as the input order, that stay.
    """
    renamed = df.withColumnsRenamed(renames or {}).withColumns(
        {"source": F.lit(source), "company_origin": origin_of(F.lit(source), origins)}
    )
    fields = [
        F.col(name).cast("string") if name in renamed.columns
        else F.lit(None).cast("string").alias(name)
        for name in columns
    ]
    return renamed.select(*fields, *keep)


def empty_frame(spark: SparkSession, columns: list[str] = CANONICAL_COLUMNS) -> DataFrame:
    return spark.createDataFrame([], T.StructType([T.StructField(c, T.StringType()) for c in columns]))


def stack(frames: list[DataFrame], spark: SparkSession | None = None, columns=CANONICAL_COLUMNS):
    """Union by name, columns missing on one side as null; canonical if no frame is given."""
    if not frames:
        return empty_frame(spark or SparkSession.active(), columns)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
