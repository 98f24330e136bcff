"""File sources.

Each reader returns the rows, the dead letters (what could not be read, and
why) and the expected columns that are absent.  A missing path gives an empty
frame and a dead letter, so that a job goes on with its other sources.
"""

from __future__ import annotations

import json
from typing import NamedTuple
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.fixed_values import (
    BENEFIT_TAGS,
    BENEFITS,
    EMPLOYMENT_CODES,
    NA_TOKENS,
    NESTED_SCHEMA,
    PAGE_SIZE,
    PAYROLL,
    PAYROLL_COLUMNS,
    ROSTER_A,
    ROSTER_B,
    ROSTER_COLUMNS,
)
from tributary.functions.text import conjunction, missing_to_null
from tributary.operators.conform import empty_frame, map_codes, tag_source
from tributary.sources.flatten import flatten
from tributary.sources.workbook_source import NAME as WORKBOOKS
from tributary.sources.workbook_source import reachable, register
from tributary.sources.workbooks import parse_workbooks
from tributary.staging import stage

DEAD_LETTERS = "source string, path string, reason string, record string"
SCHEMA_ISSUES = "source string, column string"

class SourceRead(NamedTuple):
    rows: DataFrame
    dead_letters: DataFrame
    schema_issues: DataFrame


def input_order(source_rank: int, record: Column, position: Column) -> Column:
    """Order of a row: source, file, block in the file, record, position in the record."""
    return F.struct(
        F.lit(source_rank).alias("source"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        record.cast("bigint").alias("record"),
        position.cast("bigint").alias("position"),
    )


def missing_columns(spark: SparkSession, tag: str, expected, actual) -> DataFrame:
    absent = [(tag, name) for name in expected if name not in actual]
    return spark.createDataFrame(absent, SCHEMA_ISSUES)


def _dead(rows: DataFrame, tag: str, reason: Column, record: Column) -> DataFrame:
    return rows.select(
        F.lit(tag).alias("source"),
        F.col("_file").alias("path"),
        reason.alias("reason"),
        record.cast("string").alias("record"),
    )


def _unreadable(spark, tag, path, error, columns, with_order) -> SourceRead:
    reason = error if isinstance(error, str) else error.getCondition() or "UNREADABLE"
    letter = spark.createDataFrame([(tag, str(path), reason, None)], DEAD_LETTERS)
    rows = tag_source(empty_frame(spark, [c for c in columns if c != "source"]), tag)
    if with_order:
        order = "struct<source: int, file: string, block: bigint, record: bigint, position: bigint>"
        rows = rows.withColumn("_ord", F.lit(None).cast(order))
    return SourceRead(rows, letter, spark.createDataFrame([], SCHEMA_ISSUES))


def _files_by_header(spark: SparkSession, path: str, options: dict) -> list[tuple[list[str], list[str]]]:
    """Column names and the files that begin with them, for all files under `path`.

    One pass over the lines keeps the first of each file; one file is looked at directly.
    """
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), "value",
        F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id()).alias("place"),
    )
    files = lines.inputFiles()
    if len(files) <= 1:
        return [(spark.read.options(**options).csv(path).columns, [path])]
    first = lines.groupBy("file").agg(F.min_by("value", "place").alias("line"))
    groups: dict[str, list[str]] = {}
    for row in first.orderBy("file").toLocalIterator():
        file = unquote(row.file)
        cut = row.line.count('"') % 2  # the names go on in the next line
        groups.setdefault(file if cut else row.line, []).append(file)
    by_names: dict[tuple[str, ...], list[str]] = {}
    for members in groups.values():
        names = tuple(spark.read.options(**options).csv(members[0]).columns)
        by_names.setdefault(names, []).extend(members)
    return [(list(names), members) for names, members in by_names.items()]


def read_delimited(
    spark: SparkSession,
    path: str,
    tag: str = ROSTER_A,
    expected: list[str] = ROSTER_COLUMNS,
    source_rank: int = 1,
    na_tokens: list[str] = NA_TOKENS,
    multi_line: bool = True,
) -> SourceRead:
    """CSV with a header, all columns as text, NA tokens as null.

    Files of a folder may have their columns in different orders, or lack some:
    each is read by its own header, and what it lacks is null.  Short records are
    filled with nulls; records with more fields than the header are dead letters.
    Set `multi_line=False` for files without line breaks inside quotes: Spark can
    then split large files.
    """
    options = {"header": True, "multiLine": multi_line, "quote": '"', "escape": '"'}
    try:
        groups = _files_by_header(spark, path, options)
    except AnalysisException as error:
        return _unreadable(spark, tag, path, error, expected, True)
    groups = [(header, files) for header, files in groups if header]
    if not groups:
        return _unreadable(spark, tag, path, "NO_HEADER", expected, True)
    reads = [
        _read_with_header(spark, files, header, tag, expected, source_rank, na_tokens, options)
        for header, files in groups
    ]
    rows, letters, issues = reads[0]
    for read in reads[1:]:
        rows = rows.unionByName(read.rows, allowMissingColumns=True)
        letters = letters.unionAll(read.dead_letters)
        issues = issues.unionAll(read.schema_issues)
    return SourceRead(rows, letters, issues.distinct())


def _read_with_header(
    spark: SparkSession,
    files: list[str],
    header: list[str],
    tag: str,
    expected: list[str],
    source_rank: int,
    na_tokens: list[str],
    options: dict,
) -> SourceRead:
    fields = ", ".join(f"`{name}` string" for name in [*header, "_broken"])
    # Spark marks records of any other length; the commas outside quotes tell long ones
    read = (
        spark.read.schema(fields)
        .options(
            **options, mode="PERMISSIVE", columnNameOfCorruptRecord="_broken",
            emptyValue="", columnPruning=False,
        )
        .csv(files)
        .select(
            "*",
            F.col("_metadata.file_path").alias("_file"),
            input_order(source_rank, F.monotonically_increasing_id(), F.lit(0)).alias("_ord"),
        )
    )
    unquoted = F.regexp_replace("_broken", '"[^"]*"', "")
    # Spark refuses queries on `_broken` alone, so the condition looks at a field too
    filled = F.col("_broken").isNotNull() | F.col(f"`{header[0]}`").isNotNull()
    is_long = F.coalesce(
        F.when(filled, F.regexp_count(unquoted, F.lit(",")) >= len(header)), F.lit(False)
    )
    values = [missing_to_null(F.col(f"`{name}`"), na_tokens).alias(name) for name in header]
    return SourceRead(
        tag_source(read.where(~is_long).select(*values, "_ord"), tag),
        _dead(read.where(is_long), tag, F.lit("more fields than the header"), F.col("_broken")),
        missing_columns(spark, tag, expected, header),
    )


def read_nested(
    spark: SparkSession,
    path: str,
    tag: str = ROSTER_B,
    schema: str = NESTED_SCHEMA,
    records: str = "employees",
    source_rank: int = 2,
    code_column: str | None = "employment_type",
    codes: dict = EMPLOYMENT_CODES,
    multi_line: bool = True,
) -> SourceRead:
    """JSON documents with an array of objects, one flat row per object.

    The schema is given, so no pass over the files is spent on finding it.  A
    file holds one document and is one task; a large export should come as a
    folder of page files, or with `multi_line=False` as files of one page per
    line, which Spark can split.  `_file`, `_document` and `_position` tell
    where an object stood.
    """
    try:
        documents = (
            spark.read.schema(f"{schema}, _broken string")
            .options(multiLine=multi_line, mode="PERMISSIVE", columnNameOfCorruptRecord="_broken")
            .json(path)
            .select(records, "_broken", "_metadata")
            .withColumns(
                {"_file": F.col("_metadata.file_path"), "_document": F.monotonically_increasing_id()}
            )
        )
    except AnalysisException as error:
        nested = spark.createDataFrame([], schema).select(F.explode(records).alias("r"))
        columns = flatten(nested.select("r.*")).columns
        return _unreadable(spark, tag, path, error, columns, True)
    exploded = documents.select(
        "_file", "_document", "_metadata", F.posexplode(records).alias("_position", "r")
    )
    flat = flatten(
        exploded.select(
            "r.*", "_file", "_document", "_position",
            input_order(source_rank, F.col("_document"), F.col("_position")).alias("_ord"),
        ),
        keep=("_ord",),
    )
    if code_column and code_column in flat.columns:
        flat = map_codes(flat, code_column, codes)
    empty = F.col(records).isNull() | (F.size(records) == 0)
    bad = documents.where(F.col("_broken").isNotNull() | empty)
    reason = F.when(F.col("_broken").isNotNull(), "malformed document").otherwise("no records")
    return SourceRead(
        tag_source(flat, tag),
        _dead(bad, tag, reason, F.col("_broken")),
        spark.createDataFrame([], SCHEMA_ISSUES),
    )


def page_statistics(
    rows: DataFrame,
    document: tuple[str, ...] = ("_file", "_document"),
    position: str = "_position",
    page_size: int = PAGE_SIZE,
) -> DataFrame:
    """Records, first and last offset of each page of a document."""
    page = (F.floor(F.col(position) / page_size) + 1).cast("int").alias("page")
    return rows.groupBy(*document, page).agg(
        F.count("*").alias("records"),
        F.min(position).alias("first_offset"),
        F.max(position).alias("last_offset"),
    )


def read_tagged(
    spark: SparkSession,
    path: str,
    tag: str = BENEFITS,
    row_tag: str = "enrollment",
    expected: list[str] = BENEFIT_TAGS,
) -> SourceRead:
    """XML elements as rows of text; rows without an expected child are dead letters.

    A child that is present but empty is not missing and gives null.
    """
    fields = ", ".join(f"`{name}` string" for name in [*expected, "_broken"])
    try:
        read = (
            spark.read.format("xml").schema(fields)
            .options(
                rowTag=row_tag, mode="PERMISSIVE", columnNameOfCorruptRecord="_broken",
                ignoreSurroundingSpaces=False,
            )
            .load(path)
            .select(*expected, "_broken", F.col("_metadata.file_path").alias("_file"))
        )
    except AnalysisException as error:
        return _unreadable(spark, tag, path, error, expected, False)
    whole = F.col("_broken").isNull() & conjunction(F.col(name).isNotNull() for name in expected)
    absent = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in expected]))
    reason = F.when(F.col("_broken").isNotNull(), "malformed element").otherwise(
        F.concat(F.lit("missing "), F.array_join(absent, ", "))
    )
    rows = read.where(whole).select(*[F.nullif(F.col(c), F.lit("")).alias(c) for c in expected])
    return SourceRead(
        tag_source(rows, tag),
        _dead(read.where(~whole), tag, reason, F.coalesce("_broken", F.to_json(F.struct(*expected)))),
        spark.createDataFrame([], SCHEMA_ISSUES),
    )


def read_workbooks(
    spark: SparkSession,
    path: str,
    tag: str = PAYROLL,
    expected: list[str] = PAYROLL_COLUMNS,
    renames: dict | None = None,
    na_tokens: list[str] = NA_TOKENS,
) -> SourceRead:
    """First sheet of each workbook, header in its first row, cells as text.

    Each workbook is a task that reads its rows from the file in place; in a store that
    only Spark's readers open, the file is handed over whole.  The sheet's own `source`
    column becomes `company_origin` before the tag is added.
    """
    renames = {"source": "company_origin"} if renames is None else renames
    try:
        found = spark.read.format("binaryFile").load(path)
    except AnalysisException as error:
        columns = [renames.get(c, c) for c in expected]
        return _unreadable(spark, tag, path, error, columns, False)
    files = sorted(found.inputFiles())  # their names alone
    if all(reachable(file) for file in files[:1]):
        register(spark)
        parsed = spark.read.format(WORKBOOKS).option("files", json.dumps(files)).load()
    else:
        parsed = parse_workbooks(found.select("path", "content"))
    return workbook_rows(stage(parsed, "workbooks"), tag, expected, renames, na_tokens)


def workbook_rows(
    parsed: DataFrame, tag: str, expected: list[str], renames: dict, na_tokens=NA_TOKENS
) -> SourceRead:
    """Rows, dead letters and absent columns of parsed workbooks."""
    cell = {name: missing_to_null(F.try_element_at("cells", F.lit(name)), na_tokens) for name in expected}
    rows = parsed.where("row > 1").select(
        *[column.alias(name) for name, column in cell.items()]
    ).withColumnsRenamed(renames)
    header = F.map_values("cells")
    absent = F.array_except(F.array(*[F.lit(name) for name in expected]), header)
    issues = parsed.where("row = 1").select(
        F.lit(tag).alias("source"), F.explode(absent).alias("column")
    )
    broken = parsed.where("error is not null").withColumnRenamed("path", "_file")
    return SourceRead(
        tag_source(rows, tag),
        _dead(broken, tag, F.lit("malformed workbook"), F.col("error")),
        issues.distinct(),
    )
