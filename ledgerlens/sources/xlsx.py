"""Excel workbooks with the standard library: first-sheet reader as a Spark data source, and a small writer.

The reader makes one partition per file. Cells come as text with their kind, so the schema is decided above it.
"""

from __future__ import annotations

import datetime as dt
import io
import re
import zipfile
from collections.abc import Iterable, Iterator
from xml.etree import ElementTree as ET
from xml.sax.saxutils import escape

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

_NS = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
#: Number formats of the file format that show dates, and its limit of rows.
_DATE_FORMATS = {*range(14, 23), *range(45, 48)}
MAX_ROWS = 1_048_576
_BAD = re.compile("[\x00-\x08\x0b\x0c\x0e-\x1f]")


def _column(ref: str) -> int:
    n = 0
    for ch in ref:
        if not ch.isalpha():
            break
        n = n * 26 + ord(ch.upper()) - 64
    return n - 1


def _texts(node: ET.Element) -> str:
    """The text of a string item without phonetic hints."""
    return "".join(t.text or "" for part in node if part.tag in (_NS + "t", _NS + "r") for t in ([part] if part.tag == _NS + "t" else part.iter(_NS + "t")))


class Workbook:
    """The first sheet of a workbook as rows of Python values."""

    def __init__(self, data: bytes) -> None:
        self.zip = zipfile.ZipFile(io.BytesIO(data))
        names = set(self.zip.namelist())
        book = ET.fromstring(self.zip.read("xl/workbook.xml"))
        props = book.find(_NS + "workbookPr")
        self.epoch = dt.datetime(1904, 1, 1) if props is not None and props.get("date1904") in ("1", "true") else dt.datetime(1899, 12, 30)
        first = book.find(f"{_NS}sheets/{_NS}sheet")
        if first is None:
            raise ValueError("a workbook without sheets")
        rels = ET.fromstring(self.zip.read("xl/_rels/workbook.xml.rels"))
        target = next(r.get("Target") for r in rels if r.get("Id") == first.get(_REL + "id"))
        self.sheet = target.lstrip("/") if target.startswith("/") else "xl/" + target
        self.strings = [_texts(si) for si in ET.fromstring(self.zip.read("xl/sharedStrings.xml"))] if "xl/sharedStrings.xml" in names else []
        self.dates = self._date_styles() if "xl/styles.xml" in names else []

    def _date_styles(self) -> list[bool]:
        styles = ET.fromstring(self.zip.read("xl/styles.xml"))
        own = {int(f.get("numFmtId")): f.get("formatCode", "") for f in styles.iter(_NS + "numFmt")}
        xfs = styles.find(_NS + "cellXfs")
        out = []
        for xf in xfs if xfs is not None else []:
            k = int(xf.get("numFmtId", 0))
            code = re.sub(r'"[^"]*"|\[[^\]]*\]|\\.', "", own.get(k, ""))
            out.append(k in _DATE_FORMATS or bool(re.search("[ymdhs]", code, re.I)))
        return out

    def _value(self, c: ET.Element):
        kind, v = c.get("t", "n"), c.find(_NS + "v")
        if kind == "inlineStr":
            node = c.find(_NS + "is")
            return None if node is None else _texts(node)
        if v is None or v.text is None:
            return None
        if kind == "s":
            return self.strings[int(v.text)]
        if kind == "b":
            return v.text == "1"
        if kind in ("str", "d"):
            return v.text
        if kind == "e":
            return None
        x = float(v.text)
        style = int(c.get("s", 0))
        if style < len(self.dates) and self.dates[style]:
            return self.epoch + dt.timedelta(days=x)
        return int(x) if x.is_integer() and abs(x) < 2**53 else x

    def rows(self) -> Iterator[tuple[int, list]]:
        """(absolute row number from 0, values); rows that aren't stored are left out."""
        at = -1
        with self.zip.open(self.sheet) as f:
            for _, node in ET.iterparse(f):
                if node.tag != _NS + "row":
                    continue
                at = int(node.get("r", at + 2)) - 1
                out: list = []
                for c in node:
                    if c.tag != _NS + "c":
                        continue
                    k = _column(c.get("r", "")) if c.get("r") else len(out)
                    out += [None] * (k + 1 - len(out))
                    out[k] = self._value(c)
                yield at, out
                node.clear()


def as_text(v) -> str | None:
    if v is None:
        return None
    if isinstance(v, bool):
        return "true" if v else "false"
    if isinstance(v, dt.datetime):
        return v.date().isoformat() if v.time() == dt.time() else v.isoformat(sep=" ")
    return repr(v) if isinstance(v, float) else str(v)


class _File(InputPartition):
    def __init__(self, path: str, order: int) -> None:
        self.path, self.order = path, order


class XlsxSource(DataSource):
    """``spark.read.format("xlsx_rows").option("paths", "a\\nb")``: (file_order, file, row_no, cells, error). An unreadable file gives one row with its error."""

    @classmethod
    def name(cls) -> str:
        return "xlsx_rows"

    def schema(self) -> str:
        return "file_order int, file string, row_no long, cells array<string>, error string"

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options["paths"].split("\n"))


class _Reader(DataSourceReader):
    def __init__(self, paths: list[str]) -> None:
        self.paths = paths

    def partitions(self) -> list[InputPartition]:
        return [_File(p, i) for i, p in enumerate(self.paths)]

    def read(self, part: InputPartition) -> Iterator[tuple]:
        name = part.path.rpartition("/")[2]
        try:
            with open(part.path.removeprefix("file://"), "rb") as f:
                book = Workbook(f.read())
            for at, cells in book.rows():
                yield part.order, name, at, [as_text(v) for v in cells], None
        except Exception as e:  # noqa: BLE001 - the other files go on
            yield part.order, name, -1, [], f"{type(e).__name__}: {e}"


def _cell(v, ref: str) -> str:
    if v is None or isinstance(v, float) and v != v:
        return ""
    if isinstance(v, bool):
        return f'<c r="{ref}" t="b"><v>{int(v)}</v></c>'
    if isinstance(v, (int, float)) or type(v).__name__ == "Decimal":
        return f'<c r="{ref}"><v>{v}</v></c>'
    if isinstance(v, (dt.date, dt.datetime)):
        t = v if isinstance(v, dt.datetime) else dt.datetime(v.year, v.month, v.day)
        d = t.replace(tzinfo=None) - dt.datetime(1899, 12, 30)
        return f'<c r="{ref}" s="1"><v>{d.days + d.seconds / 86400:.10g}</v></c>'
    return f'<c r="{ref}" t="inlineStr"><is><t xml:space="preserve">{escape(_BAD.sub("", str(v)))}</t></is></c>'


def _letters(k: int) -> str:
    s = ""
    k += 1
    while k:
        k, r = divmod(k - 1, 26)
        s = chr(65 + r) + s
    return s


def write_workbook(path: str, sheets: dict[str, tuple[list[str], Iterable[Iterable]]]) -> None:
    """Sheets as name: (header, rows). More rows than a sheet can hold raise ValueError and leave no file."""
    import os

    part = path + ".part"
    head = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>\n'
    main = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    rel = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    pack = "http://schemas.openxmlformats.org/package/2006"
    kind = "application/vnd.openxmlformats-officedocument.spreadsheetml"
    try:
        with zipfile.ZipFile(part, "w", zipfile.ZIP_DEFLATED) as z:
            n = len(sheets)
            z.writestr("[Content_Types].xml", f'{head}<Types xmlns="{pack}/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="{kind}.sheet.main+xml"/><Override PartName="/xl/styles.xml" ContentType="{kind}.styles+xml"/>' + "".join(f'<Override PartName="/xl/worksheets/sheet{i}.xml" ContentType="{kind}.worksheet+xml"/>' for i in range(1, n + 1)) + "</Types>")
            z.writestr("_rels/.rels", f'{head}<Relationships xmlns="{pack}/relationships"><Relationship Id="rId1" Type="{rel}/officeDocument" Target="xl/workbook.xml"/></Relationships>')
            z.writestr("xl/workbook.xml", f'{head}<workbook {main} xmlns:r="{rel}"><sheets>' + "".join(f'<sheet name="{escape(s, {chr(34): "&quot;"})}" sheetId="{i}" r:id="rId{i}"/>' for i, s in enumerate(sheets, 1)) + "</sheets></workbook>")
            z.writestr("xl/_rels/workbook.xml.rels", f'{head}<Relationships xmlns="{pack}/relationships">' + "".join(f'<Relationship Id="rId{i}" Type="{rel}/worksheet" Target="worksheets/sheet{i}.xml"/>' for i in range(1, n + 1)) + f'<Relationship Id="rId{n + 1}" Type="{rel}/styles" Target="styles.xml"/></Relationships>')
            z.writestr("xl/styles.xml", f'{head}<styleSheet {main}><fonts count="1"><font/></fonts><fills count="1"><fill/></fills><borders count="1"><border/></borders><cellStyleXfs count="1"><xf/></cellStyleXfs><cellXfs count="2"><xf numFmtId="0"/><xf numFmtId="14" applyNumberFormat="1"/></cellXfs></styleSheet>')
            for i, (name, (header, rows)) in enumerate(sheets.items(), 1):
                with z.open(f"xl/worksheets/sheet{i}.xml", "w") as f:
                    f.write(f"{head}<worksheet {main}><sheetData>".encode())
                    r = 0
                    for row in _chain(header, rows):
                        r += 1
                        if r > MAX_ROWS:
                            raise ValueError(f"sheet {name!r} exceeds {MAX_ROWS} rows")
                        f.write((f'<row r="{r}">' + "".join(_cell(v, f"{_letters(k)}{r}") for k, v in enumerate(row)) + "</row>").encode())
                    f.write(b"</sheetData></worksheet>")
        os.replace(part, path)
    finally:
        if os.path.exists(part):
            os.remove(part)


def _chain(header: list[str], rows: Iterable[Iterable]) -> Iterator[Iterable]:
    yield header
    yield from rows
