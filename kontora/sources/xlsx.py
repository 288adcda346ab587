"""Workbooks without other libraries: a Data Source to read, a writer for sheets.

``register(spark)`` adds the format ``xlsx``; each file is one partition.
"""

from __future__ import annotations

import glob
import os
import re
import zipfile
from collections.abc import Iterable, Iterator
from datetime import date, datetime, timedelta
from typing import NamedTuple
from xml.etree import ElementTree
from xml.sax.saxutils import escape

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from kontora.functions.rules import ILLEGAL_CELL

SCHEMA = "file_idx int, source_file string, sheet_idx int, source_sheet string, row_idx bigint, cells array<struct<kind:string,str:string,ts:timestamp_ntz>>"
#: Fixed values of the format.
_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
_PACKAGE = "{http://schemas.openxmlformats.org/package/2006/relationships}"
_EPOCH, _EPOCH_1904 = datetime(1899, 12, 30), datetime(1904, 1, 1)
_DATE_FORMATS = frozenset([*range(14, 23), *range(27, 37), *range(45, 48), *range(50, 59)])
_ILLEGAL = re.compile(ILLEGAL_CELL)

Cell = tuple[str, str | None, datetime | None]


def discover(folder: str, pattern: str = "*.xlsx") -> list[str]:
    """Files in sorted order; their places are their ``file_idx``."""
    return sorted(glob.glob(os.path.join(folder, pattern)))


def _column(ref: str) -> int:
    n = 0
    for c in ref:
        if not c.isalpha():
            break
        n = n * 26 + ord(c.upper()) - 64
    return n - 1


def _text(node) -> str:
    return "".join(t.text or "" for t in node.iter(f"{_MAIN}t"))


class Book:
    """Sheets of a workbook, values only, formulas as their cached values."""

    def __init__(self, path: str):
        self.zip = zipfile.ZipFile(path)
        names = set(self.zip.namelist())
        root = ElementTree.fromstring(self.zip.read("xl/workbook.xml"))
        rels = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(self.zip.read("xl/_rels/workbook.xml.rels")).iter(f"{_PACKAGE}Relationship")}
        place = lambda t: t.lstrip("/") if t.startswith("/") else f"xl/{t}"
        self.sheets = [(s.get("name"), place(rels[s.get(f"{_REL}id")])) for s in root.iter(f"{_MAIN}sheet")]
        pr = root.find(f"{_MAIN}workbookPr")
        self.epoch = _EPOCH_1904 if pr is not None and pr.get("date1904") in ("1", "true") else _EPOCH
        self.strings = [_text(si) for si in ElementTree.fromstring(self.zip.read("xl/sharedStrings.xml")).iter(f"{_MAIN}si")] if "xl/sharedStrings.xml" in names else []
        self.dates = self._date_styles() if "xl/styles.xml" in names else set()

    def _date_styles(self) -> set[int]:
        root = ElementTree.fromstring(self.zip.read("xl/styles.xml"))
        own = {int(f.get("numFmtId")): f.get("formatCode", "") for f in root.iter(f"{_MAIN}numFmt")}
        plain = lambda code: re.sub(r'"[^"]*"|\[[^\]]*\]|\\.', "", code)
        dated = lambda i: i in _DATE_FORMATS or bool(re.search("[dmyhs]", plain(own.get(i, "")), re.I))
        styles = root.find(f"{_MAIN}cellXfs")
        return {k for k, x in enumerate(styles if styles is not None else []) if dated(int(x.get("numFmtId", 0)))}

    def _cell(self, c) -> Cell:
        kind, value = c.get("t", "n"), c.find(f"{_MAIN}v")
        if kind == "inlineStr":
            return "str", _text(c), None
        raw = value.text if value is not None else None
        if raw is None:
            return "none", None, None
        if kind == "s":
            return "str", self.strings[int(raw)], None
        if kind in ("str", "e"):
            return "str", raw, None
        if kind == "b":
            return "bool", raw, None
        if kind == "d":
            return "date", raw, datetime.fromisoformat(raw.rstrip("Z"))
        if int(c.get("s", 0)) in self.dates:
            return "date", raw, self.epoch + timedelta(seconds=round(float(raw) * 86400))
        return "num", raw, None

    def rows(self, part: str) -> Iterator[tuple[int, list[Cell]]]:
        """(row, cells) with gaps filled, streamed."""
        at = -1
        with self.zip.open(part) as f:
            for _, node in ElementTree.iterparse(f):
                if node.tag == f"{_MAIN}row":
                    at = int(node.get("r")) - 1 if node.get("r") else at + 1
                    cells: list[Cell] = []
                    for c in node.iter(f"{_MAIN}c"):
                        k = _column(c.get("r")) if c.get("r") else len(cells)
                        cells += [("none", None, None)] * (k - len(cells))
                        cells.append(self._cell(c))
                    yield at, cells
                    node.clear()


class _File(InputPartition):
    def __init__(self, index: int, path: str):
        self.index, self.path = index, path


class XlsxReader(DataSourceReader):
    def __init__(self, options):
        self.files = discover(options["path"], options.get("glob", "*.xlsx")) if os.path.isdir(options["path"]) else [options["path"]]

    def partitions(self):
        return [_File(i, p) for i, p in enumerate(self.files)]

    def read(self, partition):
        book = Book(partition.path)
        for k, (name, part) in enumerate(book.sheets):
            for row, cells in book.rows(part):
                yield partition.index, os.path.basename(partition.path), k, name, row, cells


class XlsxSource(DataSource):
    @classmethod
    def name(cls):
        return "xlsx"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return XlsxReader(self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(XlsxSource)


def read(spark: SparkSession, path: str, pattern: str = "*.xlsx") -> DataFrame:
    """Rows of all sheets of a workbook or of a folder of workbooks."""
    register(spark)
    return spark.read.format("xlsx").option("glob", pattern).load(path)


class Sheet(NamedTuple):
    name: str
    columns: list[str]
    rows: Iterable[tuple]
    note: str = ""
    widths: dict[str, int] | None = None
    #: column -> value whose cells are red
    red: dict[str, str] | None = None


def _letters(k: int) -> str:
    out, k = "", k + 1
    while k:
        k, r = divmod(k - 1, 26)
        out = chr(65 + r) + out
    return out


def _written(k: int, row: int, value, style: int = 0) -> str:
    ref = f'r="{_letters(k)}{row}"' + (f' s="{style}"' if style else "")
    if value is None:
        return ""
    if isinstance(value, bool):
        return f'<c {ref} t="b"><v>{int(value)}</v></c>'
    if isinstance(value, (int, float)):
        return f"<c {ref}><v>{value}</v></c>"
    if isinstance(value, datetime):
        value = value.replace(tzinfo=None)
        return f'<c r="{_letters(k)}{row}" s="4"><v>{(value - _EPOCH).total_seconds() / 86400!r}</v></c>'
    if isinstance(value, date):
        return _written(k, row, datetime(value.year, value.month, value.day))
    return f'<c {ref} t="inlineStr"><is><t xml:space="preserve">{escape(_ILLEGAL.sub("", str(value)))}</t></is></c>'


def _sheet_xml(sheet: Sheet, header: bool) -> Iterator[str]:
    yield '<?xml version="1.0" encoding="UTF-8"?><worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main">'
    if header:
        yield '<sheetViews><sheetView workbookViewId="0"><pane ySplit="3" topLeftCell="A4" activePane="bottomLeft" state="frozen"/></sheetView></sheetViews>'
    widths = sheet.widths or {}
    if sheet.columns:
        yield "<cols>" + "".join(f'<col min="{i}" max="{i}" width="{widths.get(c, 16)}" customWidth="1"/>' for i, c in enumerate(sheet.columns, 1)) + "</cols>"
    yield "<sheetData>"
    row = 0
    if header:
        yield f'<row r="1">{_written(0, 1, sheet.note, 2)}</row><row r="2">{_written(0, 2, "")}</row>'
        yield '<row r="3">' + "".join(_written(k, 3, c, 1) for k, c in enumerate(sheet.columns)) + "</row>"
        row = 3
    red = sheet.red or {}
    for values in sheet.rows:
        row += 1
        marks = [3 if sheet.columns and red.get(sheet.columns[k]) == v and v is not None else 0 for k, v in enumerate(values)]
        yield f'<row r="{row}">' + "".join(_written(k, row, v, m) for k, (v, m) in enumerate(zip(values, marks, strict=True))) + "</row>"
    yield "</sheetData></worksheet>"


_STYLES = (
    '<?xml version="1.0" encoding="UTF-8"?><styleSheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><fonts count="4"><font/><font><b/></font><font><b/><i/></font>'
    '<font><color rgb="FFC00000"/></font></fonts><fills count="1"><fill><patternFill patternType="none"/></fill></fills><borders count="1"><border/></borders><cellStyleXfs count="1"><xf/></cellStyleXfs>'
    '<cellXfs count="5"><xf/><xf fontId="1" applyFont="1"/><xf fontId="2" applyFont="1"/><xf fontId="3" applyFont="1"/><xf numFmtId="22" applyNumberFormat="1"/></cellXfs></styleSheet>'
)


def write_workbook(path: str, sheets: list[Sheet], header: bool = True) -> dict[str, int]:
    """Write sheets as a stream; returns rows by sheet.

    With ``header`` row 1 is the note, row 2 is blank, row 3 names the columns and
    data start in row 4, where panes are frozen.  Names are cut to 31 characters.
    """
    counts: dict[str, int] = {}

    def counted(s: Sheet) -> Iterator[tuple]:
        counts[s.name] = 0
        for r in s.rows:
            counts[s.name] += 1
            yield tuple(r)

    ids = range(1, len(sheets) + 1)
    head = '<?xml version="1.0" encoding="UTF-8"?>'
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        kinds = "".join(f'<Override PartName="/xl/worksheets/sheet{i}.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>' for i in ids)
        z.writestr(
            "[Content_Types].xml",
            head + '<Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/>'
            '<Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/>'
            f'<Override PartName="/xl/styles.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.styles+xml"/>{kinds}</Types>',
        )
        relation = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
        z.writestr("_rels/.rels", f'{head}<Relationships xmlns="{_PACKAGE[1:-1]}"><Relationship Id="rId1" Type="{relation}/officeDocument" Target="xl/workbook.xml"/></Relationships>')
        own = "".join(f'<Relationship Id="rId{i}" Type="{relation}/worksheet" Target="worksheets/sheet{i}.xml"/>' for i in ids)
        z.writestr("xl/_rels/workbook.xml.rels", f'{head}<Relationships xmlns="{_PACKAGE[1:-1]}">{own}<Relationship Id="rId0" Type="{relation}/styles" Target="styles.xml"/></Relationships>')
        listed = "".join(f'<sheet name="{escape(s.name[:31], {chr(34): "&quot;"})}" sheetId="{i}" r:id="rId{i}"/>' for i, s in enumerate(sheets, 1))
        z.writestr("xl/workbook.xml", f'{head}<workbook xmlns="{_MAIN[1:-1]}" xmlns:r="{relation}"><sheets>{listed}</sheets></workbook>')
        z.writestr("xl/styles.xml", _STYLES)
        for i, s in enumerate(sheets, 1):
            with z.open(f"xl/worksheets/sheet{i}.xml", "w") as f:
                for part in _sheet_xml(s._replace(rows=counted(s)), header):
                    f.write(part.encode("utf-8"))
    return counts


def sheet_of(df: DataFrame, name: str, note: str = "", **options) -> Sheet:
    """A sheet of an ordered DataFrame, streamed partition by partition."""
    return Sheet(name, df.columns, df.toLocalIterator(), note, **options)
