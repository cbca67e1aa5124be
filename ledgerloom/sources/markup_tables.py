"""Tables in HTML, markdown and JSON texts as long cells."""

from __future__ import annotations

from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import numbers


class _Tables(HTMLParser):
    """Rows of (text, rowspan, colspan) of each table; a cell that is not closed is lost."""

    def __init__(self):
        super().__init__()
        self.tables: list = []
        self._row = self._cell = None

    def handle_starttag(self, tag, attrs):
        if tag == "table":
            self.tables.append([])
        elif tag == "tr" and self.tables:
            self._row = []
        elif tag in ("td", "th") and self._row is not None:
            named = dict(attrs)
            span = lambda k: int(named[k]) if (named.get(k) or "").isdigit() and int(named[k]) > 0 else 1
            self._cell = ([], span("rowspan"), span("colspan"))
        elif tag == "br" and self._cell:
            self._cell[0].append(" ")

    def handle_endtag(self, tag):
        if tag in ("td", "th") and self._cell is not None and self._row is not None:
            self._row.append((" ".join("".join(self._cell[0]).split()), *self._cell[1:]))
            self._cell = None
        elif tag == "tr" and self._row is not None and self.tables:
            self.tables[-1].append(self._row)
            self._row = None

    def handle_data(self, data):
        if self._cell is not None:
            self._cell[0].append(data)


def grid(rows: list) -> list[list[str]]:
    """Spans laid out: text in a cell's top left, blanks elsewhere, rows padded to one width."""
    placed: dict = {}
    for r, row in enumerate(rows):
        c = 0
        for text, down, across in row:
            while (r, c) in placed:
                c += 1
            for y in range(r, min(r + down, len(rows))):
                for x in range(c, c + across):
                    placed[y, x] = text if (y, x) == (r, c) else ""
            c += across
    width = max((x + 1 for _, x in placed), default=0)
    return [[placed.get((r, c), "") for c in range(width)] for r in range(len(rows))]


def _html_cells(text: str) -> list[tuple]:
    parser = _Tables()
    parser.feed(text)
    return [(t, r, c, x) for t, rows in enumerate(parser.tables) for r, row in enumerate(grid(rows)) for c, x in enumerate(row)]


def html_tables(pages: DataFrame) -> DataFrame:
    """doc_id and the cells of every table; only texts that hold a table reach Python, in Arrow batches."""

    def work(batches):
        for pdf in batches:
            rows = [(d, *cell) for d, t in zip(pdf["doc_id"], pdf["text"]) for cell in _html_cells(t)]
            yield pd.DataFrame(rows, columns=["doc_id", "table_idx", "row_idx", "col_idx", "text"])

    some = pages.where(F.lower("text").contains("<table")).select("doc_id", "text")
    kind = some.schema["doc_id"].dataType.simpleString()
    return some.mapInPandas(work, f"doc_id {kind}, table_idx int, row_idx int, col_idx int, text string")


def table_blocks(text: Column) -> Column:
    """The source of each table, shortest stretches first."""
    return F.regexp_extract_all(text, F.lit(r"(?is)(<table\b.*?</table>)"), F.lit(1))


def _markdown_rows(text: Column) -> Column:
    """The first block of pipe lines as rows of cells; null where there is none of two lines or more.

    All that is used more than once is an argument, so that a text is cut into lines once, whatever the optimizer pushes down.
    """
    once, piped = numbers._once, lambda x: x.startswith("|") & x.endswith("|")
    cells = lambda x: F.transform(F.split(F.regexp_replace(x, r"^\|+|\|+$", ""), r"\|"), numbers.strip)
    first = lambda lines: F.nullif(F.array_position(F.transform(lines, piped), True), F.lit(0)).cast("int")
    length = lambda rest: F.coalesce(F.nullif(F.array_position(F.transform(rest, lambda x: ~piped(x)), True), F.lit(0)) - 1, F.size(rest)).cast("int")

    def kept(rows: Column) -> Column:
        dashes = F.forall(F.get(rows, 1), lambda y: y.rlike("^:?-{3,}:?$"))
        return F.when(dashes, F.concat(F.slice(rows, 1, 1), F.slice(rows, 3, 1 << 30))).otherwise(rows)

    def whole(block: Column) -> Column:
        return F.when(F.size(block) >= 2, once(F.transform(block, cells), kept))

    lines = F.filter(F.transform(F.split(text, LINE_END), numbers.strip), lambda x: x != "")
    return once(once(once(lines, lambda x: F.slice(x, first(x), F.size(x))), lambda rest: F.slice(rest, F.lit(1), length(rest))), whole)


def markdown_tables(texts: DataFrame) -> DataFrame:
    """doc_id, row_idx, col_idx, text of the first block of pipe lines; a second line of dashes only is no row."""
    return texts.select("doc_id", F.posexplode(_markdown_rows(F.col("text"))).alias("row_idx", "row")).select("doc_id", "row_idx", F.posexplode("row").alias("col_idx", "text"))


#: Where a line ends, as Python knows it.
LINE_END = "\r\n|[\n\r\x0b\f\x1c\x1d\x1e\x85\u2028\u2029]"
DOCUMENT = "struct<sheets:array<struct<name:string,cells:array<struct<r:int,c:int,v:string>>>>,meta:struct<notes:string>>"
#: What the one cell of a document without sheets says, where its notes say nothing; fixed values.
SHEET, NO_SHEETS = "Sheet1", "(empty sheets)"


def _is_json(c: Column) -> Column:
    """Whether all of c is one JSON value: the parser stops behind the first one, but what is an array's only item and an
    object's only value holds nothing after it."""
    return F.try_parse_json(F.concat(F.lit("["), c, F.lit("]"))).isNotNull() & F.try_parse_json(F.concat(F.lit('{"x":'), c, F.lit("}"))).isNotNull()


def first_object(text: Column) -> Column:
    """The JSON that a model's answer holds: its first fenced part or all of it, or of that the first {...} whose braces
    balance; null where there is none."""
    once, fence = numbers._once, r"(?is)```(?:json)?\s*(.*?)\s*```"
    bare = F.when(F.contains(text, F.lit("```")) & text.rlike(fence), numbers.strip(F.regexp_extract(text, fence, 1))).otherwise(numbers.strip(text))
    start = F.struct(F.lit(0).alias("opened"), F.lit(0).alias("k"), F.lit(0).alias("end"))

    def step(a: Column, piece: Column) -> Column:
        opened, k = a["opened"] + F.length(piece) - F.length(F.replace(piece, F.lit("{"), F.lit(""))), a["k"] + 1
        return F.struct(opened.alias("opened"), k.alias("k"), F.when((a["end"] == 0) & (opened == k), k).otherwise(a["end"]).alias("end"))

    def balanced(pieces: Column) -> Column:
        # the k-th closing brace balances where the pieces before it hold k opening ones
        end = F.aggregate(F.slice(pieces, F.lit(1), F.greatest(F.size(pieces) - 1, F.lit(0))), start, step)["end"]
        return once(end, lambda k: F.when(k > 0, F.concat(F.array_join(F.slice(pieces, F.lit(1), k), "}"), F.lit("}"))))

    def whole_or_cut(bare: Column) -> Column:
        cut = once(F.split(F.substr(bare, F.instr(bare, F.lit("{"))), "[}]", -1), balanced)
        return F.when(_is_json(bare), bare).when(F.contains(bare, F.lit("{")), once(cut, lambda c: F.when(_is_json(c), c)))

    return once(bare, whole_or_cut)


_CELLS = "array<struct<sheet:string,r:int,c:int,v:string>>"


def _cell(sheet: Column, r: Column, c: Column, v: Column) -> Column:
    return F.struct(sheet.alias("sheet"), r.cast("int").alias("r"), c.cast("int").alias("c"), v.alias("v"))


def _document_cells(json: Column) -> Column:
    """The cells of a table document, those below row or column 1 dropped; one with its notes if it has no sheets."""
    none = F.array().cast(_CELLS)

    def sheet(s: Column) -> Column:
        name = F.coalesce(F.nullif(s["name"], F.lit("")), F.lit(SHEET))
        return F.coalesce(F.transform(F.filter(s["cells"], lambda x: (x["r"] > 0) & (x["c"] > 0)), lambda x: _cell(name, x["r"], x["c"], x["v"])), none)

    def cells(d: Column) -> Column:
        notes = F.coalesce(F.nullif(numbers.strip(F.coalesce(d["meta"]["notes"], F.lit(""))), F.lit("")), F.lit(NO_SHEETS))
        found = F.when(F.coalesce(F.size(d["sheets"]), F.lit(0)) > 0, F.flatten(F.transform(d["sheets"], sheet))).otherwise(F.array(_cell(F.lit(SHEET), F.lit(1), F.lit(1), notes)))
        return F.when(d.isNotNull(), found)

    return numbers._once(F.from_json(json, DOCUMENT), cells)


def json_tables(texts: DataFrame) -> DataFrame:
    """doc_id, sheet, r, c, v of table documents in models' answers; cells below row or column 1 are dropped.

    A document without sheets is one cell with its notes.
    """
    return texts.select("doc_id", F.inline(_document_cells(first_object(F.col("text")))))


#: So much of a text that is no table goes into its one cell.
RAW_CHARS = 32_000


def answer_tables(texts: DataFrame) -> DataFrame:
    """doc_id, sheet, r, c, v of models' answers: JSON if there is any, else a markdown table, else the text in one cell.

    Each text is told on its own, in one pass.
    """
    text = F.col("text")
    raw = F.array(_cell(F.lit(SHEET), F.lit(1), F.lit(1), F.substr(numbers.strip(text), F.lit(1), F.lit(RAW_CHARS))))

    def laid(rows: Column) -> Column:
        cells = F.flatten(F.transform(rows, lambda row, r: F.transform(row, lambda v, c: _cell(F.lit(SHEET), r + 1, c + 1, v))))
        return F.when(rows.isNotNull(), cells).otherwise(raw)

    def told(json: Column) -> Column:
        return F.when(json.isNotNull(), _document_cells(json)).otherwise(numbers._once(_markdown_rows(text), laid))

    return texts.select("doc_id", F.inline(numbers._once(first_object(text), told)))
