"""Workbook files as sheet rows.

``scan_workbooks`` lists and reads files with Spark's binary source, which packs
them into tasks by size. ``sheet_rows`` turns each file into rows of cell texts:
the one place where Python touches the data, a file at a time inside the tasks.
A file is the unit that cannot be split (it is one compressed stream), so its rows
are passed on in batches and it is never held as a whole table.
"""

from __future__ import annotations

import io
import sys
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import WORKBOOK_SIGNATURE, WORKBOOK_SUFFIX
from ..functions import file_service, file_year

# The reader travels with the plan, so executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# A file gives its sheet rows and, last, one status row without row_idx: number of
# rows, number of the last one, width of the sheet, and the error if it could not be
# read to the end.
ROW_SCHEMA = (
    "arquivo string, row_idx int, cells array<string>, linhas bigint, ultima int, largura int, erro string"
)
_ARROW_SCHEMA = pa.schema([
    ("arquivo", pa.string()),
    ("row_idx", pa.int32()),
    ("cells", pa.list_(pa.string())),
    ("linhas", pa.int64()),
    ("ultima", pa.int32()),
    ("largura", pa.int32()),
    ("erro", pa.string()),
])
ROWS_PER_BATCH = 2000

# OpenDocument namespaces.
_OFFICE = "{urn:oasis:names:tc:opendocument:xmlns:office:1.0}"
_TABLE = "{urn:oasis:names:tc:opendocument:xmlns:table:1.0}"
_TEXT = "{urn:oasis:names:tc:opendocument:xmlns:text:1.0}"


def scan_workbooks(spark: SparkSession, folder: str, glob: str = "*" + WORKBOOK_SUFFIX) -> DataFrame:
    """Files of a folder: (arquivo, length, modificationTime, content).

    Content is read only by plans that use it.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(folder)
    return files.select(
        F.col("_metadata.file_name").alias("arquivo"), "length", "modificationTime", "content"
    )


def is_workbook(content: Column) -> Column:
    """True if the bytes start with the signature of a zip archive."""
    return F.coalesce(
        F.substring(content, 1, 2) == F.lit(WORKBOOK_SIGNATURE).cast("binary"), F.lit(False)
    )


def file_metadata(files: DataFrame, name: str = "arquivo") -> DataFrame:
    """Adds servico and ano_arquivo, both taken from the file name."""
    return files.withColumn("servico", file_service(F.col(name))).withColumn(
        "ano_arquivo", file_year(F.col(name))
    )


def sheet_rows(files: DataFrame) -> DataFrame:
    """Rows of the first sheet of each file (arquivo, content), blanks as null.

    A file that cannot be read stops only itself: its status row carries the error.
    """
    return files.select("arquivo", "content").mapInArrow(_read_batches, ROW_SCHEMA)


def with_status(rows: DataFrame) -> DataFrame:
    """Sheet rows (arquivo, row_idx, cells) from elsewhere, with the status rows a reader gives."""
    status = rows.groupBy("arquivo").agg(
        F.count(F.lit(1)).alias("linhas"), F.max("row_idx").alias("ultima"),
        F.max(F.size("cells")).alias("largura"),
    ).withColumn("erro", F.lit(None).cast("string"))
    return rows.unionByName(status, allowMissingColumns=True)


def _read_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for name, content in zip(batch.column("arquivo"), batch.column("content")):
            yield from _read_file(name.as_py(), content)


def _read_file(name: str, content: pa.Scalar) -> Iterator[pa.RecordBatch]:
    rows, count, last, width, error = [], 0, None, 0, None
    try:
        data = content.as_buffer()
        with zipfile.ZipFile(pa.BufferReader(data) if data else io.BytesIO()) as book:
            with book.open("content.xml") as xml:
                for last, cells in _first_sheet(xml):
                    rows.append({"arquivo": name, "row_idx": last, "cells": cells})
                    count, width = count + 1, max(width, len(cells))
                    if len(rows) == ROWS_PER_BATCH:
                        yield pa.RecordBatch.from_pylist(rows, _ARROW_SCHEMA)
                        rows = []
    except Exception as exc:  # any defect of the file goes to the report
        error = f"{type(exc).__name__}: {exc}"
    rows.append({"arquivo": name, "linhas": count, "ultima": last, "largura": width, "erro": error})
    yield pa.RecordBatch.from_pylist(rows, _ARROW_SCHEMA)


def _first_sheet(xml) -> Iterator[tuple[int, list[str | None]]]:
    """(row number, cell texts) of each row that is not blank."""
    sheet, number = None, 0
    for event, node in ElementTree.iterparse(xml, events=("start", "end")):
        if event == "start":
            if sheet is None and node.tag == _TABLE + "table":
                sheet = node
        elif node is sheet:
            return
        elif sheet is not None and node.tag == _TABLE + "table-row":
            repeat = int(node.get(_TABLE + "number-rows-repeated", 1))
            row = _row_cells(node)
            if row:
                for _ in range(repeat):
                    yield number, row
                    number += 1
            else:
                number += repeat
            sheet.clear()  # rows already passed on are not kept


def _row_cells(row: ElementTree.Element) -> list[str | None]:
    """Cell texts with repeats written out; blanks at the end of the row are left away."""
    cells: list[str | None] = []
    blanks = 0
    for cell in row:
        if cell.tag not in (_TABLE + "table-cell", _TABLE + "covered-table-cell"):
            continue
        repeat = int(cell.get(_TABLE + "number-columns-repeated", 1))
        text = _cell_text(cell)
        if text is None:
            blanks += repeat
        else:
            cells.extend([None] * blanks + [text] * repeat)
            blanks = 0
    return cells


def _cell_text(cell: ElementTree.Element) -> str | None:
    kind = cell.get(_OFFICE + "value-type")
    if kind in ("float", "percentage", "currency"):
        text = cell.get(_OFFICE + "value", "")
        return text.removesuffix(".0") or None
    if kind == "date":
        return cell.get(_OFFICE + "date-value")
    if kind == "time":
        return cell.get(_OFFICE + "time-value")
    if kind == "boolean":
        return cell.get(_OFFICE + "boolean-value")
    lines = [_inline_text(p) for p in cell if p.tag == _TEXT + "p"]
    return "\n".join(lines) or None


def _inline_text(node: ElementTree.Element) -> str:
    """Text of a paragraph; notes attached to it are left out."""
    parts = [node.text or ""]
    for child in node:
        if child.tag == _TEXT + "s":
            parts.append(" " * int(child.get(_TEXT + "c", 1)))
        elif child.tag == _TEXT + "tab":
            parts.append("\t")
        elif child.tag != _OFFICE + "annotation":
            parts.append(_inline_text(child))
        parts.append(child.tail or "")
    return "".join(parts)
