"""Service-request workbooks of the ``customer`` table: one per nation and 50,000 keys, built where Spark holds the rows."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator
from xml.sax.saxutils import escape

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F

from fixtures import derived

KEYS = 50_000
NS = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
REL = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
PARTS = {
    "xl/workbook.xml": f'<workbook {NS} xmlns:r="{REL}"><sheets><sheet name="1998" sheetId="1" r:id="rId1"/></sheets></workbook>',
    "xl/_rels/workbook.xml.rels": '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
    f'<Relationship Id="rId1" Type="{REL}/worksheet" Target="worksheets/sheet1.xml"/></Relationships>',
    "xl/styles.xml": f'<styleSheet {NS}><cellXfs><xf numFmtId="0"/></cellXfs></styleSheet>',
}


def sheet(rows: list[list]) -> bytes:
    """A workbook of these rows: whole numbers are numbers, texts are shared or inline by turns, None is no cell."""
    shared: dict[str, int] = {}
    lines = []
    for number, row in enumerate(rows, 1):
        cells = []
        for place, value in enumerate(row):
            at = f"{chr(65 + place)}{number}"
            if isinstance(value, int):
                cells.append(f'<c r="{at}"><v>{value}</v></c>')
            elif value is not None and place % 2:
                cells.append(f'<c r="{at}" t="inlineStr"><is><t xml:space="preserve">{escape(value)}</t></is></c>')
            elif value is not None:
                cells.append(f'<c r="{at}" t="s"><v>{shared.setdefault(value, len(shared))}</v></c>')
        if cells:
            lines.append(f'<row r="{number}">{"".join(cells)}</row>')
    texts = "".join(f'<si><t xml:space="preserve">{escape(t)}</t></si>' for t in shared)
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as book:
        for name, content in PARTS.items():
            book.writestr(name, content)
        book.writestr("xl/sharedStrings.xml", f"<sst {NS}>{texts}</sst>")
        book.writestr("xl/worksheets/sheet1.xml", f"<worksheet {NS}><sheetData>{''.join(lines)}</sheetData></worksheet>")
    return out.getvalue()


def workbooks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(path, content)``: requests of every customer; each eleventh key leaves a blank row."""
    key = F.col("c_custkey")
    place = F.when(key % 4 == 0, F.concat("c_name", F.lit("\n2nd & <last> floor"))).otherwise(F.col("c_name"))
    rows = derived.table(spark, sf_dir, "customer").select(
        F.concat_ws("-", "c_nationkey", F.floor(key / KEYS)).alias("path"),
        F.struct(
            key.alias("key"),
            (key % 11 == 0).alias("blank"),
            F.col("c_mktsegment").alias("issue"),
            place.alias("place"),
            F.when(key % 5 != 0, " done ").alias("status"),
            (key % 400).cast("int").alias("hours"),
            F.when(key % 3 == 0, "repeated").otherwise("not repeated").alias("flag"),
        ).alias("row"),
    )
    books = rows.groupBy("path").agg(F.array_sort(F.collect_list("row")).alias("rows"))  # KEYS rows at most
    headers = list(derived.HEADERS)

    def build(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            made = []
            for rows in frame["rows"]:
                body = [
                    [] if r["blank"] else [r["issue"], r["place"], r["status"], int(r["hours"]), "1998-01-01", r["flag"]]
                    for r in rows
                ]
                made.append(sheet([["requests"], headers, *body]))
            yield pd.DataFrame({"path": frame["path"], "content": made})

    import fixtures.workbooks as here

    cloudpickle.register_pickle_by_value(here)
    return books.mapInPandas(build, "path string, content binary")
