"""Spreadsheet files as a data source of Spark: `spark.read.format("workbooks").load(path)`.

Each file is a partition. A task opens it where it lies and reads the first sheet row by
row from the archive, so neither a file nor a sheet is held whole. A defect in a file shows
only where it stands; since no row of a defective file counts, a file is gone through twice:
once to see whether it can be read to its end, and then for its rows.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from tributary.sources.workbooks import PARSED, named_rows

NAME = "workbooks"

_BATCH_ROWS = 5_000
_FIELDS = pa.schema([
    ("path", pa.string()), ("row", pa.int64()), ("cells", pa.map_(pa.string(), pa.string())), ("error", pa.string())])


def reachable(uri: str) -> bool:
    """Whether files of this address can be opened in place, not only by Spark's readers."""
    try:
        fs.FileSystem.from_uri(uri)
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError, ValueError):
        return False
    return True


def _opened(address: str) -> tuple[fs.FileSystem, str]:
    """File system and path of an address, or of a local path."""
    return fs.FileSystem.from_uri(address) if re.match("[a-z][a-z0-9+.-]*:/", address) else (fs.LocalFileSystem(), address)


@dataclass
class WorkbookFile(InputPartition):
    address: str  # of the file or of the folder it was found in
    path: str | None = None


class WorkbookReader(DataSourceReader):
    def __init__(self, options: dict):
        self.options = options

    def partitions(self) -> list[WorkbookFile]:
        if "files" in self.options:
            return [WorkbookFile(address) for address in json.loads(self.options["files"])]
        address = self.options["path"]
        system, root = _opened(address)
        found = system.get_file_info(root)
        entries = [found] if found.is_file else system.get_file_info(fs.FileSelector(root, recursive=True))
        files = [e.path for e in entries if e.is_file and not e.base_name.startswith((".", "_"))]
        return [WorkbookFile(address, path) for path in sorted(files)]

    def read(self, partition: WorkbookFile) -> Iterator[pa.RecordBatch]:
        name = partition.path or partition.address
        try:
            system, path = _opened(partition.address)
            path = partition.path or path
            with system.open_input_file(path) as file:
                for _ in named_rows(file):
                    pass
        except Exception as error:
            yield _batch(name, [(None, None)], f"{type(error).__name__}: {error}")
            return
        with system.open_input_file(path) as file:
            rows = []
            for row in named_rows(file):
                rows.append(row)
                if len(rows) == _BATCH_ROWS:
                    yield _batch(name, rows)
                    rows = []
            if rows:
                yield _batch(name, rows)


def _batch(name: str, rows: list[tuple], error: str | None = None) -> pa.RecordBatch:
    cells = [None if own is None else list(own.items()) for _, own in rows]
    return pa.RecordBatch.from_arrays([
        pa.array([name] * len(rows)), pa.array([number for number, _ in rows], pa.int64()),
        pa.array(cells, _FIELDS.field("cells").type), pa.array([error] * len(rows), pa.string())], schema=_FIELDS)


class WorkbookSource(DataSource):
    """Options: `path`, a file or folder; or `files`, a JSON list of addresses."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return PARSED

    def reader(self, schema) -> WorkbookReader:
        return WorkbookReader(self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(WorkbookSource)
