"""Spreadsheet workbooks (.xlsx) as a Spark data source, written and read with the standard library's zip and XML.

    spark.dataSource.register(workbooks.Workbooks)
    cells.write.format("workbook").mode("append").save(folder)     # workbook, sheet, r, c, text, value and, if there, style columns
    spark.read.format("workbook").load(folder)                     # the values of all cells

A workbook is one file and one task writes all of it, so cells are to be dealt by workbook first: by_workbook() does that.  The
folder has to be one that all executors reach.  A task writes under a name of its own; the files get their names when the whole
job is committed, so that a task that runs twice, or a job that fails, leaves no half workbook.  A sheet's rows are written as they
come, one row in memory at a time.
"""

from __future__ import annotations

import os
import re
import uuid
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal
from xml.etree import ElementTree
from xml.sax.saxutils import escape, quoteattr

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage

CELLS = "workbook string, sheet string, r int, c int, text string, value decimal(28,8)"
#: What a cell may also say about itself; all of them may be missing or null.
STYLE = {"bold": "boolean", "fill": "string", "font_color": "string", "number_format": "string", "rowspan": "int", "colspan": "int"}
_MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
_REL = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
_PACKAGE = "http://schemas.openxmlformats.org/package/2006"
_HEAD = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>\n'
#: Column widths come from so many rows, and lie between these.
WIDTH_ROWS, NARROW, WIDE = 200, 10, 60
_NOT_XML = re.compile("[\x00-\x08\x0b\x0c\x0e-\x1f￾￿]")


def by_workbook(cells: DataFrame) -> DataFrame:
    """Cells in the order in which workbooks are written, each workbook's in one task; cells at row or column 0 or below are dropped."""
    return cells.where("r > 0 AND c > 0").repartition("workbook").sortWithinPartitions("workbook", "sheet", "r", "c")


def column_name(c: int) -> str:
    name = ""
    while c:
        c, rest = divmod(c - 1, 26)
        name = chr(65 + rest) + name
    return name


def column_number(reference: str) -> int:
    n = 0
    for ch in reference:
        if not ch.isalpha():
            break
        n = n * 26 + ord(ch.upper()) - 64
    return n


def _text(value: str) -> str:
    return escape(_NOT_XML.sub("", value))


class _Styles:
    """The formats that a workbook's cells use, numbered as they come."""

    def __init__(self):
        self.known: dict[tuple, int] = {(False, None, None, None): 0}

    def number(self, row) -> int:
        key = (bool(row.get("bold")), row.get("fill"), row.get("font_color"), row.get("number_format"))
        return self.known.setdefault(key, len(self.known))

    def xml(self) -> str:
        fonts, fills, formats, cells = ["<font/>"], ['<fill><patternFill patternType="none"/></fill>', '<fill><patternFill patternType="gray125"/></fill>'], [], []
        for bold, fill, color, shown in self.known:
            font = f"<font>{'<b/>' * bold}{f'<color rgb={quoteattr(color)}/>' if color else ''}</font>" if bold or color else "<font/>"
            pattern = f'<fill><patternFill patternType="solid"><fgColor rgb={quoteattr(fill)}/></patternFill></fill>' if fill else fills[0]
            for one, many in ((font, fonts), (pattern, fills), (shown, formats)):
                if one and one not in many:
                    many.append(one)
            number = 164 + formats.index(shown) if shown else 0
            cells.append(f'<xf numFmtId="{number}" fontId="{fonts.index(font)}" fillId="{fills.index(pattern)}" borderId="0" xfId="0" applyNumberFormat="1" applyFont="1" applyFill="1"/>')
        listed = "".join(f'<numFmt numFmtId="{164 + i}" formatCode={quoteattr(f)}/>' for i, f in enumerate(formats))
        group = lambda tag, many: f'<{tag} count="{len(many)}">{"".join(many)}</{tag}>'
        shown = f'<numFmts count="{len(formats)}">{listed}</numFmts>' if formats else ""
        return (
            f'{_HEAD}<styleSheet xmlns="{_MAIN}">{shown}{group("fonts", fonts)}{group("fills", fills)}<borders count="1"><border/></borders>'
            f'<cellStyleXfs count="1"><xf/></cellStyleXfs>{group("cellXfs", cells)}</styleSheet>'
        )


class _Book:
    """One workbook being written, sheet after sheet, row after row."""

    def __init__(self, path: str):
        self.zip, self.styles, self.sheets = zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED), _Styles(), []
        self.entry = self.row = None
        self.merged: list[str] = []

    def add(self, row: dict) -> None:
        if not self.sheets or self.sheets[-1] != row["sheet"]:
            self._end_sheet()
            self.sheets.append(row["sheet"])
            self.entry = self.zip.open(f"xl/worksheets/sheet{len(self.sheets)}.xml", "w")
            self._put(f'{_HEAD}<worksheet xmlns="{_MAIN}"><sheetData>')
        if self.row != row["r"]:
            self._put(("</row>" if self.row else "") + f'<row r="{row["r"]}">')
            self.row = row["r"]
        at, style = f"{column_name(row['c'])}{row['r']}", self.styles.number(row)
        if row["value"] is not None:
            self._put(f'<c r="{at}" s="{style}"><v>{format(Decimal(row["value"]).normalize(), "f")}</v></c>')
        else:
            self._put(f'<c r="{at}" s="{style}" t="inlineStr"><is><t xml:space="preserve">{_text(row["text"] or "")}</t></is></c>')
        down, across = max(row.get("rowspan") or 1, 1), max(row.get("colspan") or 1, 1)
        if down > 1 or across > 1:
            self.merged.append(f'<mergeCell ref="{at}:{column_name(row["c"] + across - 1)}{row["r"] + down - 1}"/>')

    def _put(self, text: str) -> None:
        self.entry.write(text.encode())

    def _end_sheet(self) -> None:
        if self.entry is not None:
            merged = f'<mergeCells count="{len(self.merged)}">{"".join(self.merged)}</mergeCells>' if self.merged else ""
            self._put(("</row>" if self.row else "") + f"</sheetData>{merged}</worksheet>")
            self.entry.close()
        self.entry, self.row, self.merged = None, None, []

    def close(self) -> None:
        self._end_sheet()
        ids = range(1, len(self.sheets) + 1)
        put = lambda name, body: self.zip.writestr(name, _HEAD + body)
        named = "".join(f'<sheet name={quoteattr(_NOT_XML.sub("", s))} sheetId="{i}" r:id="rId{i}"/>' for i, s in zip(ids, self.sheets))
        put("xl/workbook.xml", f'<workbook xmlns="{_MAIN}" xmlns:r="{_REL}"><sheets>{named}</sheets></workbook>')
        parts = "".join(f'<Relationship Id="rId{i}" Type="{_REL}/worksheet" Target="worksheets/sheet{i}.xml"/>' for i in ids)
        parts += f'<Relationship Id="rId{len(self.sheets) + 1}" Type="{_REL}/styles" Target="styles.xml"/>'
        put("xl/_rels/workbook.xml.rels", f'<Relationships xmlns="{_PACKAGE}/relationships">{parts}</Relationships>')
        put("_rels/.rels", f'<Relationships xmlns="{_PACKAGE}/relationships"><Relationship Id="rId1" Type="{_REL}/officeDocument" Target="xl/workbook.xml"/></Relationships>')
        kind = "application/vnd.openxmlformats-officedocument.spreadsheetml"
        over = "".join(f'<Override PartName="/xl/worksheets/sheet{i}.xml" ContentType="{kind}.worksheet+xml"/>' for i in ids)
        over += f'<Override PartName="/xl/workbook.xml" ContentType="{kind}.sheet.main+xml"/><Override PartName="/xl/styles.xml" ContentType="{kind}.styles+xml"/>'
        usual = '<Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/>'
        put("[Content_Types].xml", f'<Types xmlns="{_PACKAGE}/content-types">{usual}{over}</Types>')
        self.zip.writestr("xl/styles.xml", self.styles.xml())
        self.zip.close()


def _local(path: str) -> str:
    return re.sub("^file:(//)?(?=/)", "", path)


@dataclass
class _Written(WriterCommitMessage):
    files: list


class _Writer(DataSourceWriter):
    def __init__(self, folder: str, names: list[str], overwrite: bool):
        self.folder, self.names, self.overwrite, self.job = folder, names, overwrite, uuid.uuid4().hex

    def write(self, iterator: Iterator[Row]) -> WriterCommitMessage:
        os.makedirs(self.folder, exist_ok=True)
        files: list[tuple[str, str]] = []
        book = current = None
        try:
            for row in iterator:
                cell = row.asDict()
                if cell["workbook"] != current:
                    if book is not None:
                        book.close()
                    current = cell["workbook"]
                    part = os.path.join(self.folder, f".{self.job}-{uuid.uuid4().hex}.part")
                    files.append((part, current))
                    book = _Book(part)
                book.add(cell)
        finally:
            if book is not None:
                book.close()
        return _Written(files)

    def commit(self, messages: list) -> None:
        """The files under their names: where one of the name is there, it is replaced if the job overwrites, else the new one is
        numbered _run2, _run3 and so on."""
        for part, name in (f for m in messages if m for f in m.files):
            stem = os.path.join(self.folder, re.sub(r"[/\\]", "_", name).removesuffix(".xlsx"))
            at, n = f"{stem}.xlsx", 1
            while not self.overwrite and os.path.exists(at):
                n += 1
                at = f"{stem}_run{n}.xlsx"
            os.replace(part, at)
        self._sweep()

    def abort(self, messages: list) -> None:
        self._sweep()

    def _sweep(self) -> None:
        for left in os.listdir(self.folder) if os.path.isdir(self.folder) else ():
            if left.startswith(f".{self.job}-"):
                os.remove(os.path.join(self.folder, left))


class _File(InputPartition):
    def __init__(self, path: str):
        super().__init__(path)


class _Reader(DataSourceReader):
    def __init__(self, folder: str, sheets: list[str] | None):
        self.folder, self.sheets = folder, sheets

    def partitions(self) -> list[InputPartition]:
        names = [self.folder] if os.path.isfile(self.folder) else [os.path.join(self.folder, f) for f in sorted(os.listdir(self.folder)) if f.endswith(".xlsx") and not f.startswith(".")]
        return [_File(n) for n in names] or [_File("")]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        if partition.value:
            yield from read_book(partition.value, self.sheets)


def read_book(path: str, sheets: list[str] | None = None) -> Iterator[tuple]:
    """CELLS of a workbook, without its formats; with sheets, a workbook that does not hold just these in this order is an error."""
    tag = lambda name: f"{{{_MAIN}}}{name}"
    name = os.path.basename(path)
    with zipfile.ZipFile(path) as z:
        targets = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(z.read("xl/_rels/workbook.xml.rels"))}
        found = [(s.get("name"), targets[s.get(f"{{{_REL}}}id")]) for s in ElementTree.fromstring(z.read("xl/workbook.xml")).iter(tag("sheet"))]
        if sheets is not None and [s for s, _ in found] != sheets:
            raise ValueError(f"{name} has to hold the sheets {sheets}, in this order; it holds {[s for s, _ in found]}")
        shared = []
        if "xl/sharedStrings.xml" in z.namelist():
            shared = ["".join(t.text or "" for t in si.iter(tag("t"))) for si in ElementTree.fromstring(z.read("xl/sharedStrings.xml")).iter(tag("si"))]
        for sheet, target in found:
            with z.open(target.lstrip("/") if target.startswith("/") else f"xl/{target}") as entry:
                for _, row in ElementTree.iterparse(entry):
                    if row.tag != tag("row"):
                        continue
                    for cell in row.iter(tag("c")):
                        at, kind, v = cell.get("r"), cell.get("t"), cell.find(tag("v"))
                        text = value = None
                        if kind == "inlineStr":
                            text = "".join(t.text or "" for t in cell.iter(tag("t")))
                        elif v is not None and kind == "s":
                            text = shared[int(v.text)]
                        elif v is not None and kind in ("str", "b", "e"):
                            text = v.text
                        elif v is not None:
                            value = Decimal(v.text).quantize(Decimal("1e-8"))
                        if text is not None or value is not None:
                            yield name, sheet, int(re.sub("[A-Za-z]", "", at)), column_number(at), text, value
                    row.clear()


class Workbooks(DataSource):
    """Workbooks in a folder; options: sheets, a list of names with | between them, which all read workbooks have to hold."""

    @classmethod
    def name(cls) -> str:
        return "workbook"

    def schema(self) -> str:
        return CELLS

    def reader(self, schema) -> DataSourceReader:
        sheets = self.options.get("sheets")
        return _Reader(_local(self.options["path"]), sheets.split("|") if sheets else None)

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        return _Writer(_local(self.options["path"]), schema.names, overwrite)


def statement_books(cells: DataFrame) -> DataFrame:
    """workbook, sheet, r, c, text and value of reports' sheets; a report without any gets one empty sheet that says so.

    cells: workbook, sheet, r, c, text, value, where a report without statements has one row with sheet null.
    """
    sheet = F.coalesce("sheet", F.lit("NoStatements"))
    return cells.select("workbook", sheet.alias("sheet"), F.coalesce("r", F.lit(1)).alias("r"), F.coalesce("c", F.lit(1)).alias("c"), F.coalesce("text", F.lit("")).alias("text"), "value")
