"""Workbooks for hand-over: a file per movie, written and read by tasks. Parquet is the store; a sheet has at most a
million rows, and more are an error."""

from __future__ import annotations

import io
import json
import re
import zipfile
from collections.abc import Iterator
from datetime import datetime, timedelta
from functools import reduce
from itertools import islice
from xml.etree import ElementTree
from xml.sax.saxutils import escape

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from trackloom.sources.files import FolderWriter

MAX_ROWS = 1_048_575
#: Fixed values of the format.
MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
REL = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
PACKAGE = "http://schemas.openxmlformats.org/package/2006"
HEAD = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'


def _column(i: int) -> str:
    name = ""
    while i >= 0:
        name, i = chr(65 + i % 26) + name, i // 26 - 1
    return name


def _cell(value: object, at: str) -> str:
    if value is None or value != value:
        return ""
    if isinstance(value, bool):
        return f'<c r="{at}" t="b"><v>{int(value)}</v></c>'
    if not isinstance(value, (int, float)):
        return f'<c r="{at}" t="inlineStr"><is><t xml:space="preserve">{escape(str(value))}</t></is></c>'
    return f'<c r="{at}"><v>{value!r}</v></c>'


class Workbook:
    """An .xlsx file, built sheet by sheet and row by row; sheets: (name, header) in order."""

    def __init__(self, sheets: list[tuple[str, list[str]]]):
        self.sheets, self.buffer, self.open, self.at, self.row = sheets, io.BytesIO(), None, -1, 0
        self.zip = zipfile.ZipFile(self.buffer, "w", zipfile.ZIP_DEFLATED)
        z = self.zip
        kinds = "".join(
            f'<Override PartName="/xl/worksheets/sheet{i}.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>' for i in range(1, len(sheets) + 1)
        )
        z.writestr(
            "[Content_Types].xml",
            f'{HEAD}<Types xmlns="{PACKAGE}/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/>{kinds}</Types>',
        )
        z.writestr(
            "_rels/.rels",
            f'{HEAD}<Relationships xmlns="{PACKAGE}/relationships"><Relationship Id="rId1" Type="{REL}/officeDocument" Target="xl/workbook.xml"/></Relationships>',
        )
        names = "".join(f'<sheet name="{escape(n)}" sheetId="{i}" r:id="rId{i}"/>' for i, (n, _) in enumerate(sheets, 1))
        z.writestr("xl/workbook.xml", f'{HEAD}<workbook xmlns="{MAIN}" xmlns:r="{REL}"><sheets>{names}</sheets></workbook>')
        links = "".join(f'<Relationship Id="rId{i}" Type="{REL}/worksheet" Target="worksheets/sheet{i}.xml"/>' for i in range(1, len(sheets) + 1))
        z.writestr("xl/_rels/workbook.xml.rels", f'{HEAD}<Relationships xmlns="{PACKAGE}/relationships">{links}</Relationships>')

    def _next_sheet(self) -> None:
        if self.open:
            self.open.write(b"</sheetData></worksheet>")
            self.open.close()
        self.at, self.row = self.at + 1, 0
        if self.at < len(self.sheets):
            self.open = self.zip.open(f"xl/worksheets/sheet{self.at + 1}.xml", "w")
            self.open.write(f'{HEAD}<worksheet xmlns="{MAIN}"><sheetData>'.encode())
            self._write(self.sheets[self.at][1])

    def _write(self, cells: list) -> None:
        self.row += 1
        self.open.write(f'<row r="{self.row}">{"".join(_cell(v, f"{_column(c)}{self.row}") for c, v in enumerate(cells))}</row>'.encode())

    def add(self, sheet: int, cells: list) -> None:
        """Rows come in order of their sheets."""
        while self.at < sheet:
            self._next_sheet()
        if self.row > MAX_ROWS:
            raise ValueError(f"sheet {self.sheets[sheet][0]} has more than {MAX_ROWS} rows; write Parquet instead")
        self._write(cells)

    def content(self) -> bytes:
        while self.at < len(self.sheets):
            self._next_sheet()
        self.zip.close()
        return self.buffer.getvalue()


#: Fixed values of the format: numbers of built-in date and time formats; letters that make a custom format one.
DATE_FORMATS = frozenset([*range(14, 23), 45, 46, 47])
DATE_LETTERS = re.compile(r"[ymdhs]", re.IGNORECASE)
_NO_CODE = re.compile(r'"[^"]*"|\[[^\]]*\]|\\.')


def rows_of(content: bytes, sheet: str | None = None) -> list[dict]:
    return list(stream_rows(content, sheet))


def stream_rows(content: bytes, sheet: str | None = None) -> Iterator[dict]:
    """Rows of a sheet (the first by default) as dicts by its header, one after the other: of the sheet's XML a row is held.
    Cells are numbers, texts, booleans, or datetimes where a number has a date's format; errors are texts."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        links = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(z.read("xl/_rels/workbook.xml.rels"))}
        book = ElementTree.fromstring(z.read("xl/workbook.xml"))
        sheets = {s.get("name"): links[s.get(f"{{{REL}}}id")] for s in book.iter(_tag("sheet"))}
        shared = ["".join(t.text or "" for t in s.iter(_tag("t"))) for s in _elements(z, "xl/sharedStrings.xml", "si")]
        dates = _date_styles(z)
        begin = datetime(1904, 1, 1) if any(p.get("date1904") in ("1", "true") for p in book.iter(_tag("workbookPr"))) else datetime(1899, 12, 30)
        target = sheets[sheet] if sheet else next(iter(sheets.values()))
        header: dict[int, str] | None = None
        for row in _elements(z, "xl/" + target.removeprefix("/xl/"), "row"):
            cells = {}
            for nth, c in enumerate(row.iter(_tag("c"))):
                v, at = c.find(_tag("v")), _place(c.get("r"), nth)
                if c.get("t") == "inlineStr":
                    cells[at] = "".join(t.text or "" for t in c.iter(_tag("t")))
                elif v is not None and v.text is not None:
                    cells[at] = _value(v.text, c.get("t"), shared, begin if int(c.get("s") or 0) in dates else None)
            if header is None:
                header = cells
            else:
                yield {name: cells.get(at) for at, name in header.items()}


def _tag(name: str) -> str:
    return f"{{{MAIN}}}{name}"


def _elements(z: zipfile.ZipFile, part: str, name: str) -> Iterator[ElementTree.Element]:
    """The elements of a name in a part, if it is there, each dropped when the next is read."""
    if part not in z.namelist():
        return
    with z.open(part) as f:
        above: list[ElementTree.Element] = []
        for event, e in ElementTree.iterparse(f, ("start", "end")):
            if event == "start":
                above.append(e)
                continue
            above.pop()
            if e.tag == _tag(name):
                yield e
                above[-1].clear()


def _place(name: str | None, nth: int) -> int:
    """The column of a cell's name, or else its number in the row."""
    at = 0
    for letter in re.match("[A-Z]*", name or "")[0]:
        at = at * 26 + ord(letter) - 64
    return at - 1 if at else nth


def _value(text: str, kind: str | None, shared: list[str], begin: datetime | None) -> object:
    if kind == "s":
        return shared[int(text)]
    if kind == "b":
        return text.strip() in ("1", "true")
    if kind == "d":
        return datetime.fromisoformat(text)
    if kind in ("str", "e"):
        return text
    return begin + timedelta(days=float(text)) if begin is not None else float(text)


def _date_styles(z: zipfile.ZipFile) -> set[int]:
    """Numbers of the cell styles whose format is one of dates or times."""
    if "xl/styles.xml" not in z.namelist():
        return set()
    styles = ElementTree.fromstring(z.read("xl/styles.xml"))
    custom = {int(f.get("numFmtId")) for f in styles.iter(_tag("numFmt")) if DATE_LETTERS.search(_NO_CODE.sub("", f.get("formatCode") or ""))}
    known = DATE_FORMATS | custom
    return {i for of in styles.iter(_tag("cellXfs")) for i, x in enumerate(of.iter(_tag("xf"))) if int(x.get("numFmtId") or 0) in known}


class Workbooks(DataSource):
    """df.write.format("workbook") of rows (file, sheet, nth, cells: a JSON object), sorted so, all rows of a file in one
    partition. Option sheets: names and headers as JSON."""

    @classmethod
    def name(cls) -> str:
        return "workbook"

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        return _WorkbookWriter(self.options["path"], json.loads(self.options["sheets"]))


class _WorkbookWriter(FolderWriter):
    def __init__(self, folder: str, sheets: list):
        super().__init__(folder)
        self.sheets = sheets

    def write(self, iterator) -> WriterCommitMessage:
        done, file, book = [], None, None
        for row in iterator:
            if row["file"] != file:
                done += [self.save(file, book.content())] if book else []
                file, book = row["file"], Workbook(self.sheets)
            book.add(row["sheet"], list(json.loads(row["cells"]).values()))
        return self.message(done + ([self.save(file, book.content())] if book else []))


def write_workbooks(folder: str, sheets: dict[str, DataFrame], order: dict[str, list[str]]) -> None:
    """An .xlsx file for each value of the column `file` (a path below the folder, or a whole one), with the rows that
    each sheet's table has under it, sorted by the columns in `order`; `row` may order a sheet and is no column of it. A
    file's rows go to one task, which builds it row by row. The folder must be one that all executors share."""
    parts, heads = [], []
    for i, (name, df) in enumerate(sheets.items()):
        columns = [(c, kind) for c, kind in df.dtypes if c not in ("file", "row")]
        value = lambda c, kind: F.nullif(F.col(f"`{c}`"), F.lit(float("nan")).cast(kind)) if kind in ("double", "float") else F.col(f"`{c}`")
        cells = F.to_json(F.struct(*[value(c, kind).alias(f"c{j}") for j, (c, kind) in enumerate(columns)]), {"ignoreNullFields": "false"})
        nth = F.row_number().over(Window.partitionBy("file").orderBy(*[F.col(f"`{c}`") for c in order.get(name, ["file"])]))
        parts.append(df.select("file", F.lit(i).alias("sheet"), nth.alias("nth"), cells.alias("cells")))
        heads.append((name, [c for c, _ in columns]))
    rows = reduce(DataFrame.union, parts)
    rows.sparkSession.dataSource.register(Workbooks)
    rows.repartition("file").sortWithinPartitions("file", "sheet", "nth").write.format("workbook").mode("append").option("sheets", json.dumps(heads)).save(folder)


#: Rows that leave a task together.
ROWS_AT_ONCE = 4096


def read_workbooks(spark: SparkSession, path: str | list[str], schema: str, pattern: str = "*_summary.xlsx", sheet: str | None = None) -> DataFrame:
    """Rows of every matching workbook below `path`, with folder and file; columns of `schema` that a sheet lacks are null.
    Texts, booleans and times come as they are and other columns as numbers; what a cell holds instead is null."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path)
    parts = F.split("path", "/")
    files = files.select(F.element_at(parts, -2).alias("folder"), F.element_at(parts, -1).alias("file"), "content")
    wanted = spark.createDataFrame([], schema).dtypes
    kinds = {n: t if t in _CELLS else "double" for n, t in wanted}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for folder, file, content in zip(*(b.column(c) for c in ("folder", "file", "content"))):
                rows = stream_rows(content.as_py(), sheet)
                while some := list(islice(rows, ROWS_AT_ONCE)):
                    columns = [pa.array([_CELLS[t][1](r.get(n)) for r in some], _CELLS[t][0]) for n, t in kinds.items()]
                    yield pa.RecordBatch.from_arrays([pa.repeat(folder, len(some)), pa.repeat(file, len(some)), *columns], names=["folder", "file", *kinds])

    loose = ", ".join(["folder string", "file string", *(f"`{n}` {t}" for n, t in kinds.items())])
    return files.mapInArrow(run, loose).select("folder", "file", *[F.col(f"`{n}`").cast(t).alias(n) for n, t in wanted])


def _number(v: object) -> float | None:
    if isinstance(v, str):
        try:
            return float(v)
        except ValueError:
            return None
    return float(v) if isinstance(v, (int, float)) else None


def _text(v: object) -> str | None:
    if isinstance(v, float) and v.is_integer() and abs(v) < 1e15:
        return str(int(v))
    return None if v is None else str(v)


#: By Spark's type: Arrow's, and what a cell gives.
_CELLS = {
    "double": (pa.float64(), _number), "string": (pa.string(), _text), "boolean": (pa.bool_(), lambda v: v if isinstance(v, bool) else None),
    "timestamp_ntz": (pa.timestamp("us"), lambda v: v if isinstance(v, datetime) else None), "date": (pa.date32(), lambda v: v.date() if isinstance(v, datetime) else None),
}
