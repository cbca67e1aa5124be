"""Named queries over the reports' pages and merged statements as wholes, and their DuckDB counterparts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import numbers
from ledgerloom.operators import headers, locate, merge, reports, sheets, tracking, words
from ledgerloom.plans import fixtures
from ledgerloom.sources import markup_tables
from ledgerloom.sources.star import PAGE_ROWS_SQL, PAGE_TITLES, PERIOD_LINE, STATEMENTS_SQL, UNIT_LINE, given, page_rows, page_words, statements, table

QUERIES: dict = {}
SQL: dict[str, str] = {}
_TITLE_SQL = "case page_number " + " ".join(f"when {i} then '{t}'" for i, t in enumerate(PAGE_TITLES.values(), 1)) + " end"


def _query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return add


def _line(rows: DataFrame) -> DataFrame:
    return rows.select("doc_id", "page_number", "row_idx", F.array_join("cells", "|").alias("line"))


@_query(f"""with {PAGE_ROWS_SQL} select doc_id, page_number, 0 as row_idx, {_TITLE_SQL} as line from page_rows where n = 1 union all select doc_id, page_number, 1, '{UNIT_LINE}' from page_rows where n = 1
 union all select doc_id, page_number, 2, 'Notes|' || array_to_string(years, '|') from page_rows where n = 1 union all select doc_id, page_number, n + 2, label || '|' || array_to_string(amounts, '|') from page_rows""")
def statement_pages_to_rows(spark, sf_dir) -> DataFrame:
    """The words of every report's printed pages, back to table rows."""
    return _line(words.statement_rows(*page_words(spark, sf_dir)))


@_query(f"""with {PAGE_ROWS_SQL} select doc_id, page_number, 0 as row_idx, {_TITLE_SQL} as line from page_rows where n = 1
 union all select doc_id, page_number, 1, '|Notes|' || array_to_string(list_transform(years, lambda y: '{PERIOD_LINE}' || chr(10) || y), '|') from page_rows where n = 1
 union all select doc_id, page_number, 2, 'Revenue' from page_rows where n = 1 union all select doc_id, page_number, n + 2, label || '|' || n || '|' || array_to_string(amounts, '|') from page_rows""")
def header_bands(spark, sf_dir) -> DataFrame:
    """Every report's pages with three rows above the first amounts, the period above the notes: one row of column headers."""
    rows = page_rows(spark, sf_dir)
    title = F.element_at(F.array(*map(F.lit, PAGE_TITLES.values())), F.col("page_number"))
    years = F.transform("years", lambda y: F.lit(""))
    top = F.array(F.array(title), F.concat(F.array(F.lit(""), F.lit(PERIOD_LINE)), years), F.concat(F.array(F.lit(""), F.lit("Notes")), F.col("years")), F.array(F.lit("Revenue")))
    heads = rows.where("n = 1").select("doc_id", "page_number", F.posexplode(top).alias("row_idx", "cells"))
    body = rows.select("doc_id", "page_number", (F.col("n") + 3).alias("row_idx"), F.concat(F.array(F.col("label"), F.col("n").cast("string")), F.col("amounts")).alias("cells"))
    return _line(headers.bands(heads.unionByName(body)))


# --- tables within texts, over whole tables


def _tabular(spark, sf_dir) -> DataFrame:
    """documents, every second one with its first words as a pipe table after them."""
    d = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    # six words are among the first seven pieces, as only the first can be empty; the eighth is the rest of the text
    w = F.slice(F.filter(F.split("text", r"[^A-Za-z0-9]+", 8), lambda x: x != ""), 1, 6)
    rows = F.transform(w, lambda x: F.concat(F.lit("| "), x, F.lit(" | "), F.length(x).cast("string"), F.lit(" |")))
    block = F.concat(F.lit("\n| word | length |\n|---|:---:|\n"), F.array_join(rows, "\n"), F.lit("\nend"))
    return d.withColumn("text", F.when(F.col("doc_id") % 2 == 0, F.concat("text", block)).otherwise(F.col("text")))


_END = "\r\n|[\n\r\x0b\f\x1c\x1d\x1e\u0085\u2028\u2029]"


def _strip(c: str) -> str:
    return f"regexp_replace({c}, '^{numbers.SPACE}+|{numbers.SPACE}+$', '', 'g')"


_TABULAR_SQL = f"""d as (select doc_id, coalesce(text, '') as text, list_filter(regexp_split_to_array(coalesce(text, ''), '[^A-Za-z0-9]+'), lambda x: x <> '')[1:6] as w from documents),
t as (select doc_id, case when doc_id % 2 = 0 then text || chr(10) || '| word | length |' || chr(10) || '|---|:---:|' || chr(10) || coalesce(array_to_string(list_transform(w, lambda x: '| ' || x || ' | ' || len(x) || ' |'), chr(10)), '') || chr(10) || 'end' else text end as text from d),
l as (select doc_id, list_filter(list_transform(regexp_split_to_array(text, '{_END}'), lambda x: {_strip('x')}), lambda x: x <> '') as l from t),
p as (select doc_id, unnest(l) as line, generate_subscripts(l, 1) as i from l),
f as (select *, line like '|%' and line like '%|' as piped from p),
s as (select doc_id, min(i) filter (piped) as first from f group by 1),
e as (select f.doc_id, min(i) filter (not piped and i > first) as stop from f join s using (doc_id) group by 1),
b as (select doc_id, line, i - first as k from f join s using (doc_id) join e using (doc_id) where i >= first and i < coalesce(stop, 1000000000)),
c as (select doc_id, k, list_transform(string_split(regexp_replace(line, '^\\|+|\\|+$', '', 'g'), '|'), lambda y: {_strip('y')}) as row, count(*) over (partition by doc_id) as n from b),
r as (select doc_id, row, row_number() over (partition by doc_id order by k) - 1 as row_idx from c where n >= 2 and not (k = 1 and len(list_filter(row, lambda y: not regexp_matches(y, '^:?-{{3,}}:?$'))) = 0))"""


@_query(f"with {_TABULAR_SQL} select doc_id, row_idx, generate_subscripts(row, 1) - 1 as col_idx, unnest(row) as text from r")
def document_markdown_tables(spark, sf_dir) -> DataFrame:
    """Pipe tables in the documents."""
    return markup_tables.markdown_tables(_tabular(spark, sf_dir))


@_query(f"""with {_TABULAR_SQL} select doc_id, 'Sheet1' as sheet, row_idx + 1 as r, generate_subscripts(row, 1) as c, unnest(row) as v from r
 union all select doc_id, 'Sheet1', 1, 1, left({_strip('text')}, {markup_tables.RAW_CHARS}) from t where doc_id not in (select doc_id from r)""")
def document_answer_tables(spark, sf_dir) -> DataFrame:
    """Documents read as models' answers: their tables, or the whole text in one cell."""
    return markup_tables.answer_tables(_tabular(spark, sf_dir))


# --- merged statements

#: Reports that spell their labels a little differently every other year.
_SPELT = "case when workbook % 2 = 1 then ' receivable from customers' else ' receivables from customers' end"


def _spelt(spark, sf_dir) -> DataFrame:
    ending = F.when(F.col("workbook") % 2 == 1, F.lit(" receivable from customers")).otherwise(F.lit(" receivables from customers"))
    return statements(spark, sf_dir).withColumn("label", F.concat("label", ending))


def _spelt_sql() -> str:
    from ledgerloom.plans import catalogue

    key = catalogue._key_sql("label")
    return f"""with {STATEMENTS_SQL},
spelt as (select * replace (label || {_SPELT} as label), regexp_replace(label, '( & other \\(net\\)| and other)$', '') as item from statements),
latest as (select company, workbook, max(period::int) as latest from spelt group by all),
f as (select *, {key} || '#1' as own, dense_rank() over (partition by company order by latest, workbook::varchar) as seq from spelt join latest using (company, workbook)),
m as (select company, sheet, item, arg_min(own, seq) as key, min(seq) as s, arg_min(row_idx, seq) as r, arg_max(label, seq) as label from f group by all),
p as (select *, row_number() over (partition by company, sheet order by s, r) - 1 as position from m)"""


@_query()
def merged_fuzzy_rows(spark, sf_dir) -> DataFrame:
    """Reports whose labels differ by a letter from year to year, merged: rows meet by likeness."""
    merged = merge.merged(merge.facts(_spelt(spark, sf_dir)))
    return merged.select("company", "sheet", "key", "position", "label", "period", F.col("value").cast("decimal(28,8)").alias("value"), "workbook")


def _merged_fuzzy_sql() -> str:
    from ledgerloom.plans import catalogue

    value = catalogue.amount_sql("arg_max(raw_text, seq)")
    return f"""{_spelt_sql()} select f.company, f.sheet, p.key, p.position, p.label, f.period, ({value})::decimal(28,8) as value, arg_max(workbook, seq)::varchar as workbook
 from f join p using (company, sheet, item) group by f.company, f.sheet, p.key, p.position, p.label, f.period"""


_VERSIONS_SQL = f"""with {STATEMENTS_SQL}, v as (select *, case when raw_text like '(%' then -1 else 1 end * try_cast(translate(raw_text, '(),', '') as decimal(28,8)) as value from statements)"""


@_query(_VERSIONS_SQL + """ select company, sheet, count(*) as n_cells, sum(workbook)::bigint as workbooks, sum(row_idx)::bigint as row_idxs, sum(n)::bigint as n_versions, sum(value) as total
 from (select company, sheet, label_item, period, arg_max(value, workbook) filter (true) as value, max(workbook) as workbook, arg_max(row_idx, workbook) as row_idx, count(*) as n
   from (select *, regexp_replace(label, '( & other \\(net\\)| and other)$', '') as label_item from (select * replace (coalesce(value, 0) as value) from v)) group by all) group by all""")
def amount_sources(spark, sf_dir) -> DataFrame:
    """Which report and row each merged amount is from, summed by statement."""
    found = tracking.sources(tracking.versions(merge.facts(statements(spark, sf_dir))))
    return found.groupBy("company", "sheet").agg(
        F.count("*").alias("n_cells"), F.sum(F.col("workbook").cast("long")).alias("workbooks"), F.sum("row_idx").alias("row_idxs"), F.sum("n_versions").alias("n_versions"),
        F.sum(F.coalesce("value", F.lit(0))).alias("total"),
    )


@_query(_VERSIONS_SQL + """, c as (select *, regexp_replace(label, '( & other \\(net\\)| and other)$', '') as item from v),
 h as (select *, first_value(value ignore nulls) over (partition by company, sheet, item, period order by workbook rows between unbounded preceding and 1 preceding) as existing from c)
 select company, sheet, lower(item) || ' and other#1' as key, period || ' Conflict - ' || workbook as column, existing, value from h where existing is not null and value is not null and value <> existing""")
def conflict_columns(spark, sf_dir) -> DataFrame:
    """Restated amounts, each in a column of its own."""
    found = tracking.conflicts(tracking.versions(merge.facts(statements(spark, sf_dir))))
    return found.select("company", "sheet", "key", "column", F.col("existing").cast("decimal(28,8)").alias("existing"), F.col("value").cast("decimal(28,8)").alias("value"))



# --- the reports' pages in other forms, read back


@_query(f"""with {PAGE_ROWS_SQL}, e as (select doc_id || '/' || page_number as doc_id, n + 4 as row_idx, label, years[1] as y, amounts[1] as a, n from page_rows),
 k as (select *, {{KEY}} || '#1' as key from e)
 select doc_id, row_idx, label, key, 'Group ' || y as period, a as raw_text from k union all select doc_id, row_idx, label, key, 'Parent ' || y, n::varchar from k""")
def statement_sheets_to_facts(spark, sf_dir) -> DataFrame:
    """Every report's sheets with two columns of one year, told apart by the names above them: labels, keys, periods and amounts."""
    rows = page_rows(spark, sf_dir)
    title = F.element_at(F.array(*map(F.lit, PAGE_TITLES.values())), F.col("page_number"))
    year = F.get("years", 0)
    top = [(1, 1, title), (2, 2, F.lit("Group")), (2, 3, F.lit("Parent")), (3, 2, year), (3, 3, F.concat(year, F.lit("\t"))), (4, 2, F.lit("$m")), (4, 3, F.lit("$m"))]
    cell = lambda r, c, t: F.struct(F.lit(r).alias("row_idx"), F.lit(c).alias("col_idx"), t.alias("raw_text"))
    page = F.concat_ws("/", "doc_id", "page_number").alias("doc_id")
    heads = rows.where("n = 1").select(page, F.inline(F.array(*[cell(*x) for x in top])))
    body = rows.select(page, (F.col("n") + 4).alias("row_idx"), F.posexplode(F.array(F.col("label"), F.get("amounts", 0), F.col("n").cast("string"))).alias("c", "raw_text"))
    cells = heads.unionByName(body.select("doc_id", "row_idx", (F.col("c") + 1).alias("col_idx"), "raw_text"))
    return sheets.facts(cells).select("doc_id", "row_idx", "label", "key", "period", "raw_text")


@_query(f"""with {PAGE_ROWS_SQL}, d as (select doc_id, page_number from page_rows where n = 1 and page_number in (1, 2, 3)), many as (select doc_id from page_rows where page_number = 3 group by 1)
 select doc_id, ['balance_sheet', 'income_statement', 'cash_flow'][page_number] as statement_type, page_number as page_start, case page_number when 3 then 4 else page_number end as page_end,
  {_TITLE_SQL} as title, 0.85 as score, 'title_match_in_page_head' as reason from d""")
def statement_pages_located(spark, sf_dir) -> DataFrame:
    """The texts of every report's pages, the cash flow statement on two of them: which pages hold which statement."""
    rows = page_rows(spark, sf_dir)
    title = F.element_at(F.array(*map(F.lit, PAGE_TITLES.values())), F.col("page_number"))
    line = F.concat_ws(" ", "label", F.array_join("amounts", " "))
    texts = rows.groupBy("doc_id", "page_number").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("n", line.alias("line")))), lambda x: x["line"]), "\n").alias("lines"))
    pages = texts.select("doc_id", "page_number", F.concat_ws("\n", title, F.lit(UNIT_LINE), "lines").alias("text"))
    more = texts.where("page_number = 3").select("doc_id", F.lit(4).alias("page_number"), F.lit("Net cash used in investing activities " + " ".join(map(str, range(101, 120)))).alias("text"))
    found = locate.candidates(pages.unionByName(more))
    return found.select("doc_id", "statement_type", "page_start", "page_end", "title", F.col("score").cast("double").alias("score"), "reason")


_CELLS_SQL = f"""{PAGE_ROWS_SQL}, cells as (
  select doc_id || '/' || page_number as doc_id, 0 as r, 0 as c, label as text from page_rows where false
  union all select doc_id || '/' || page_number, 0, 0, 'Item' from page_rows where n = 1
  union all select doc_id || '/' || page_number, 0, 1, 'Years' from page_rows where n = 1
  union all select doc_id || '/' || page_number, 1, 0, '' from page_rows where n = 1
  union all select doc_id || '/' || page_number, n + 1, 0, label from page_rows
  union all select doc_id || '/' || page_number, n + 1, unnest(range(1, len(amounts) + 1))::int, unnest(amounts) from page_rows
  union all select doc_id || '/' || page_number, 1, unnest(range(1, len(years) + 1))::int, unnest(years) from page_rows where n = 1
  union all select doc_id || '/' || page_number, 0, unnest(range(2, len(years) + 1))::int, '' from page_rows where n = 1)"""


def _whole_pages(rows: DataFrame) -> DataFrame:
    """doc_id, years and rows (label and amounts, in order) of each page."""
    page = F.concat_ws("/", "doc_id", "page_number").alias("doc_id")
    return rows.groupBy(page).agg(F.first("years").alias("years"), F.sort_array(F.collect_list(F.struct("n", "label", "amounts"))).alias("rows"))


@_query(f"with {_CELLS_SQL} select doc_id, 0 as table_idx, r as row_idx, c as col_idx, text from cells")
def statement_html_cells(spark, sf_dir) -> DataFrame:
    """Every report's pages as HTML tables with a header of spans, back to cells."""
    esc = lambda c: F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit(" "), F.lit(" &#32; "))
    td = lambda many: F.array_join(F.transform(many, lambda t: F.concat(F.lit("<td>"), esc(t), F.lit("</td>"))), "")
    head = F.concat(F.lit('<table border=1><tr><th rowspan="2">Item</th><th colspan='), F.size("years").cast("string"), F.lit(">Years</th></tr><tr>"), td(F.col("years")), F.lit("</tr>"))
    body = F.array_join(F.transform("rows", lambda r: F.concat(F.lit("<TR>"), td(F.concat(F.array(r["label"]), r["amounts"])), F.lit("</TR>"))), "\n")
    texts = _whole_pages(page_rows(spark, sf_dir)).select("doc_id", F.concat(F.lit("<p>Page</p>"), head, body, F.lit("</table> end")).alias("text"))
    return markup_tables.html_tables(texts)


@_query(f"with {_CELLS_SQL} select doc_id, 'Page' as sheet, r + 1 as r, c + 1 as c, text as v from cells where r >= 1")
def statement_json_cells(spark, sf_dir) -> DataFrame:
    """Every report's pages as table documents within a model's words, back to cells."""
    cell = lambda r, c, v: F.struct(r.cast("int").alias("r"), c.cast("int").alias("c"), v.alias("v"))
    row = lambda r, many: F.transform(many, lambda v, i: cell(r, i + 1, v))
    whole = F.concat(F.array(F.concat(F.array(F.lit("")), F.col("years"))), F.transform("rows", lambda r: F.concat(F.array(r["label"]), r["amounts"])))
    pages = _whole_pages(page_rows(spark, sf_dir)).withColumn("cells", F.flatten(F.transform(whole, lambda many, i: row(i + 2, many))))
    odd = F.array(cell(F.lit(0), F.lit(1), F.lit("dropped")))
    document = F.to_json(F.struct(F.array(F.struct(F.lit("Page").alias("name"), F.concat("cells", odd).alias("cells"))).alias("sheets")))
    return markup_tables.json_tables(pages.select("doc_id", F.concat(F.lit("Here is {the} table: ```json\n"), document, F.lit("\n``` as asked")).alias("text")))


# --- small outputs


@_query("select o_orderkey, case when o_totalprice::decimal(18,2) = floor(o_totalprice::decimal(18,2)) then '#,##0;(#,##0);\"-\"' else '#,##0.0;(#,##0.0);\"-\"' end as shown from orders")
def number_formats(spark, sf_dir) -> DataFrame:
    """How the cell of each order's total is shown."""
    return table(spark, sf_dir, "orders").select("o_orderkey", reports.number_format(F.col("o_totalprice").cast("decimal(18,2)")).alias("shown"))


@_query(r"select c_custkey, try_cast(regexp_replace(c_name || ' ' || n, '[^0-9.\-]', '', 'g') as double) as value from (select c_custkey, c_name, case c_custkey % 4 when 0 then '1.5 m' when 1 then 'none' when 2 then '-' else '' end as n from customer)")
def lenient_numbers(spark, sf_dir) -> DataFrame:
    """Whatever number is left of a text."""
    k = F.col("c_custkey") % 4
    more = F.when(k == 0, "1.5 m").when(k == 1, "none").when(k == 2, "-").otherwise("")
    return table(spark, sf_dir, "customer").select("c_custkey", numbers.lenient_number(F.concat_ws(" ", "c_name", more)).alias("value"))


_SOURCE = "concat('see <TABLE id=a>', coalesce(source, ''), '\n<tr></table> and <table>', cast(doc_id as string), '</Table> <table> lost')"


@_query(f"select doc_id, len(b) as n, array_to_string(b, '|') as blocks from (select doc_id, regexp_extract_all({_SOURCE}, '(?is)(<table\\b.*?</table>)', 1) as b from documents)")
def table_sources(spark, sf_dir) -> DataFrame:
    """The source of each table within texts."""
    found = table(spark, sf_dir, "documents").select("doc_id", markup_tables.table_blocks(F.expr(_SOURCE.replace("\n", "\\n"))).alias("b"))
    return found.select("doc_id", F.size("b").alias("n"), F.array_join("b", "|").alias("blocks"))


@_query(f"with {STATEMENTS_SQL} select company, workbook::varchar as source, 'Annual' as report_type, max(period::int) over (partition by company, workbook) as year, sheet as statement, min(row_idx) || '-' || max(row_idx) as pages from statements group by company, workbook, sheet, period qualify row_number() over (partition by company, workbook, sheet order by period) = 1")
def report_tracking(spark, sf_dir) -> DataFrame:
    """One row for every statement of every report, with the report's type and year."""
    cells = statements(spark, sf_dir)
    results = cells.groupBy("company", "workbook", "sheet", F.col("period").alias("p")).agg(F.min("row_idx").alias("page_start"), F.max("row_idx").alias("page_end"))
    first = results.groupBy("company", "workbook", "sheet").agg(F.min_by(F.struct("page_start", "page_end"), "p").alias("x")).select("company", "workbook", "sheet", "x.*")
    told = first.withColumn("method", F.lit("embedded")).withColumn("warnings", F.array().cast("array<string>"))
    return tracking.tracked(merge.reports_in_order(cells), told).select("company", "source", "report_type", "year", "statement", "pages")


_FOLDED_SQL = f"""r as (select * from {fixtures.OVER.RESULTS}), m as (select *, contains(lower(title), 'comprehensive income') and statement_type = 'income_statement' and lag(statement_type) over w = 'income_statement'
  and page_start <= max(page_end) over (partition by doc_id order by position rows between unbounded preceding and 1 preceding) + 2 as fold from r window w as (partition by doc_id order by position)),
 g as (select *, sum(case when coalesce(fold, false) then 0 else 1 end) over (partition by doc_id order by position) as kept from m)"""


@_query(f"""with {_FOLDED_SQL}, e as (select doc_id, kept, position, unnest([0, 1]) as row_idx, unnest(['Item|' || (2000 + page_start), title || '|' || page_end]) as line from g
  union all select doc_id, kept, position, -1, '' from g where coalesce(fold, false))
 select doc_id, kept, row_number() over (partition by doc_id, kept order by position, row_idx) - 1 as row_idx, line from e""")
def comprehensive_income_rows(spark, sf_dir) -> DataFrame:
    """The rows of folded statements, one run after another."""
    results = given(spark, sf_dir, fixtures.OVER.RESULTS)
    lines = F.array(F.array(F.lit("Item"), (2000 + F.col("page_start")).cast("string")), F.array(F.col("title"), F.col("page_end").cast("string")))
    rows = results.select("doc_id", "position", F.posexplode(lines).alias("row_idx", "cells"))
    return reports.folded_rows(results, rows).select("doc_id", "kept", "row_idx", F.array_join("cells", "|").alias("line"))


@_query(f"""select r.doc_id, r.position, 'out/' || r.doc_id || '.xlsx' as output_workbook, r.doc_id || '.pdf' as source_pdf, page_start || ', ' || page_end as source_pages, page_start::varchar as page_start, page_end::varchar as page_end,
  'embedded' as extraction_method, title, '0.85' as score, coalesce(string_agg(message, '; ' order by seq), '') as warnings
 from {fixtures.OVER.RESULTS.sql("r")} left join {fixtures.OVER.WARNINGS.sql("w")} on r.doc_id = w.doc_id and r.position = w.seq group by all""")
def extraction_records(spark, sf_dir) -> DataFrame:
    """The eleven columns of every report's extraction record, but for names that other queries check."""
    results = given(spark, sf_dir, fixtures.OVER.RESULTS).select(
        "doc_id", "position", F.concat(F.lit("out/"), "doc_id", F.lit(".xlsx")).alias("output_workbook"), F.concat("doc_id", F.lit(".pdf")).alias("source_pdf"), "statement_type", "title",
        F.array("page_start", "page_end").alias("pages"), F.lit("embedded").alias("method"), F.lit(0.85).alias("score"),
    )
    notes = given(spark, sf_dir, fixtures.OVER.WARNINGS).select("doc_id", F.col("seq").alias("position"), "seq", "message")
    return reports.extraction_record(results, notes).drop("sheet_name", "statement_type")


@_query()
def statement_grid(spark, sf_dir) -> DataFrame:
    """Merged statements as their sheets show them, cell by cell."""
    cells = merge.laid_out(merge.merged(merge.facts(statements(spark, sf_dir))))
    return cells.select("company", "sheet", "r", "c", "text", F.col("value").cast("decimal(28,8)").alias("value"))


def _grid_sql() -> str:
    from ledgerloom.plans import catalogue

    return f"""{catalogue._FACTS_SQL}, spans as (select company, sheet, period, row_number() over (partition by company, sheet order by period::int) + 1 as c from (select distinct company, sheet, period from merged)),
 lines as (select company, sheet, key, label, row_number() over (partition by company, sheet order by position) + 1 as r from named)
 select company, sheet, 1 as r, 1 as c, 'Item' as text, null::decimal(28,8) as value from (select distinct company, sheet from spans) union all select company, sheet, 1, c, period, null from spans
 union all select company, sheet, r, 1, label, null from lines
 union all select company, sheet, r, c, case when value is null then '' end, value from lines join spans using (company, sheet) left join merged using (company, sheet, key, period)"""
