"""Cells of spreadsheet files (Office Open XML) with the standard library."""

from __future__ import annotations

import datetime
import io
import re
import zipfile
from collections.abc import Iterator
from typing import BinaryIO
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame

PARSED = "path string, row bigint, cells map<string, string>, error string"

_BATCH_ROWS = 5_000
_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_LINK = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
_DATE_FORMATS = {*range(14, 23), *range(45, 48)}  # number formats built into the file type


def _parts(archive: zipfile.ZipFile, name: str, tag: str) -> list:
    if name not in archive.namelist():
        return []
    return list(ElementTree.fromstring(archive.read(name)).iter(_MAIN + tag))


def _text(element) -> str:
    return "".join(part.text or "" for part in element.iter(_MAIN + "t"))


def _date_styles(archive: zipfile.ZipFile) -> set[int]:
    """Numbers of the cell styles that show a date."""
    custom = {
        int(each.get("numFmtId"))
        for each in _parts(archive, "xl/styles.xml", "numFmt")
        if re.search("[ymdhs]", re.sub(r'"[^"]*"|\[[^\]]*\]|\\.', "", each.get("formatCode", "").lower()))
    }
    styles = [
        int(xf.get("numFmtId", 0))
        for block in _parts(archive, "xl/styles.xml", "cellXfs")
        for xf in block
    ]
    return {i for i, number in enumerate(styles) if number in _DATE_FORMATS | custom}


def _first_sheet(archive: zipfile.ZipFile) -> tuple[str, datetime.datetime]:
    """Path of the first sheet and day zero of its dates."""
    book = ElementTree.fromstring(archive.read("xl/workbook.xml"))
    link = next(book.iter(_MAIN + "sheet")).get(_LINK)
    links = ElementTree.fromstring(archive.read("xl/_rels/workbook.xml.rels"))
    target = next(each.get("Target") for each in links if each.get("Id") == link)
    late = any(each.get("date1904") in ("1", "true") for each in book.iter(_MAIN + "workbookPr"))
    zero = datetime.datetime(1904, 1, 1) if late else datetime.datetime(1899, 12, 30)
    return target.lstrip("/") if target.startswith("/") else f"xl/{target}", zero


def _value(cell, shared: list[str], dates: set[int], zero: datetime.datetime) -> str | None:
    kind = cell.get("t", "n")
    if kind == "inlineStr":
        return _text(cell)
    raw = cell.findtext(_MAIN + "v")
    if raw is None:
        return None
    if kind == "s":
        return shared[int(raw)]
    if kind == "b":
        return "True" if raw == "1" else "False"
    if kind == "n" and int(cell.get("s", 0)) in dates:
        moment = zero + datetime.timedelta(days=float(raw))
        return moment.isoformat(" ") if moment.time() != datetime.time() else moment.date().isoformat()
    return raw


def _rows(file: BinaryIO) -> Iterator[tuple[int, dict[str, str]]]:
    """Row number and cells by column letters; rows without any value are left out."""
    with zipfile.ZipFile(file) as archive:
        shared = [_text(item) for item in _parts(archive, "xl/sharedStrings.xml", "si")]
        dates = _date_styles(archive)
        sheet, zero = _first_sheet(archive)
        with archive.open(sheet) as stream:
            number = 0
            parser = ElementTree.iterparse(stream, ("start", "end"))
            data = None
            for event, element in parser:
                if event == "start":
                    data = element if element.tag == _MAIN + "sheetData" else data
                    continue
                if element.tag != _MAIN + "row":
                    continue
                number = int(element.get("r", number + 1))
                cells = {}
                for place, cell in enumerate(element.iter(_MAIN + "c")):
                    value = _value(cell, shared, dates, zero)
                    if value is not None:
                        letters = re.sub("[0-9]", "", cell.get("r", "")) or f"#{place}"
                        cells[letters] = value
                if data is not None:
                    data.clear()  # else every row would stay in the tree, if only as an empty one
                if cells:
                    yield number, cells


def named_rows(file: BinaryIO) -> Iterator[tuple[int, dict[str, str]]]:
    """Row number, 1 for the header, and cells by header name, one row after the other.

    Blank rows between others come as empty ones.
    """
    rows = _rows(file)
    first, header = next(rows, (1, {}))
    yield 1, {name: name for name in header.values()}
    last = first
    for number, cells in rows:
        for blank in range(last + 1, number):
            yield blank - first + 1, {}
        yield number - first + 1, {header[c]: value for c, value in cells.items() if c in header}
        last = number


def _parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for path, content in zip(batch["path"], batch["content"]):
            try:  # a sheet holds at most 2**20 rows; none of them counts if one is defective
                parsed = [(path, number, cells, None) for number, cells in named_rows(io.BytesIO(content))]
            except Exception as error:
                parsed = [(path, None, None, f"{type(error).__name__}: {error}")]
            for start in range(0, len(parsed), _BATCH_ROWS):
                yield pd.DataFrame(
                    parsed[start : start + _BATCH_ROWS], columns=["path", "row", "cells", "error"]
                )


def parse_workbooks(files: DataFrame) -> DataFrame:
    """Rows of the first sheet of each (path, content); row 1 is the header.

    A defect in a file gives one row with an error.
    """
    return files.select("path", "content").mapInPandas(_parse, PARSED)
