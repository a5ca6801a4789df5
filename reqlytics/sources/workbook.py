"""Cells of a workbook's first sheet as text: a small per-file decoder used inside tasks."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from datetime import datetime, timedelta
from xml.etree import ElementTree as ET

import pandas as pd

BATCH_ROWS = 20_000
COLUMNS = ["source_path", "source_row_number", "cells"]
MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
LINKS = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
EPOCH = datetime(1899, 12, 30)
BUILT_IN_DATES = {*range(14, 23), 45, 46, 47}


def _text(node) -> str:
    return "".join(t.text or "" for t in node.iter(f"{MAIN}t"))


def _part(book: zipfile.ZipFile, name: str):
    return ET.parse(book.open(name)).getroot() if name in book.namelist() else None


def _first_sheet(book: zipfile.ZipFile) -> str:
    sheet = _part(book, "xl/workbook.xml").find(f"{MAIN}sheets/{MAIN}sheet")
    links = {r.get("Id"): r.get("Target") for r in _part(book, "xl/_rels/workbook.xml.rels")}
    target = links[sheet.get(f"{LINKS}id")]
    return target.lstrip("/") if target.startswith("/") else f"xl/{target}"


def _date_styles(book: zipfile.ZipFile) -> set[int]:
    root = _part(book, "xl/styles.xml")
    if root is None:
        return set()
    custom = {
        int(f.get("numFmtId"))
        for f in root.iter(f"{MAIN}numFmt")
        if re.search(r"[ymdhs]", re.sub(r'"[^"]*"|\[[^\]]*\]', "", f.get("formatCode", "").lower()))
    }
    styles = root.find(f"{MAIN}cellXfs")
    formats = [] if styles is None else [int(x.get("numFmtId", 0)) for x in styles]
    return {i for i, f in enumerate(formats) if f in BUILT_IN_DATES or f in custom}


def _number(text: str, is_date: bool) -> str:
    value = float(text)
    if is_date:
        return str(EPOCH + timedelta(seconds=round(value * 86400)))
    return str(int(value)) if value.is_integer() and "e" not in text.lower() else text


def _column(reference: str) -> int:
    index = 0
    for letter in re.match(r"[A-Z]+", reference).group():
        index = index * 26 + ord(letter) - 64
    return index - 1


def sheet_rows(content: bytes) -> Iterator[tuple[int, list[str | None]]]:
    """``(sheet row number, cells)``; rows the file leaves out come as empty rows."""
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        strings = _part(book, "xl/sharedStrings.xml")
        shared = [] if strings is None else [_text(s) for s in strings.iter(f"{MAIN}si")]
        dates = _date_styles(book)
        last = 0
        for _, row in ET.iterparse(book.open(_first_sheet(book))):
            if row.tag != f"{MAIN}row":
                continue
            number = int(row.get("r", last + 1))
            yield from ((n, []) for n in range(last + 1, number))
            cells: list[str | None] = []
            for cell in row.iter(f"{MAIN}c"):
                at = _column(cell.get("r")) if cell.get("r") else len(cells)
                cells.extend([None] * (at + 1 - len(cells)))
                kind, value = cell.get("t"), cell.find(f"{MAIN}v")
                if kind == "inlineStr":
                    cells[at] = _text(cell)
                elif value is None or value.text is None:
                    continue
                elif kind == "s":
                    cells[at] = shared[int(value.text)]
                elif kind in ("str", "e"):
                    cells[at] = value.text
                elif kind == "b":
                    cells[at] = "True" if value.text == "1" else "False"
                else:
                    cells[at] = _number(value.text, int(cell.get("s", 0)) in dates)
            yield number, cells
            row.clear()
            last = number


def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """``(path, content)`` files to rows, a bounded number of rows at a time."""
    for batch in batches:
        for path, content in zip(batch["path"], batch["content"]):
            rows: list[tuple[str, int, list[str | None]]] = []
            for number, cells in sheet_rows(content):
                rows.append((path, number, cells))
                if len(rows) >= BATCH_ROWS:
                    yield pd.DataFrame(rows, columns=COLUMNS)
                    rows = []
            if rows:
                yield pd.DataFrame(rows, columns=COLUMNS)
