"""Named queries of table reconstruction and of the registry's life cycle, and their DuckDB counterparts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import labels, numbers
from ledgerloom.functions import rows as R
from ledgerloom.operators import rebuild, registry
from ledgerloom.plans import fixtures
from ledgerloom.sources import markup_tables
from ledgerloom.sources.star import given, table

QUERIES: dict = {}
SQL: dict[str, str] = {}


def _query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return add


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _strip(c: str) -> str:
    return f"regexp_replace({c}, '^{numbers.SPACE}+|{numbers.SPACE}+$', '', 'g')"


def _any(c: str, words: tuple) -> str:
    return "(" + " or ".join(f"contains({c}, {_quoted(w)})" for w in words) + ")"


def _in(c: str, words: tuple) -> str:
    return f"{c} in ({', '.join(map(_quoted, words))})"


def _token(c: str) -> str:
    """numbers.number_text in DuckDB."""
    bare = _strip(f"regexp_replace({_strip(c)}, '^{numbers.MARKS}{numbers.SPACE}*', '', 'i')")
    bare = _strip(f"regexp_replace({bare}, '{numbers.SPACE}*{numbers.MARKS}$', '', 'i')")
    return _strip(f"regexp_replace(regexp_replace({bare}, '^W ', ''), ' W$', '')")


def _is_amount(c: str) -> str:
    t = _token(c)
    return f"({t} in ('-', '–') or (regexp_matches({t}, {_quoted(numbers.TOKEN)}) and {t} <> '-'))"


def _like(c: str, *kinds: str) -> str:
    """Whether a text is like a pattern of the kinds, white space as one blank."""
    flat = f"regexp_replace(lower({_strip(c)}), '{numbers.SPACE}+', ' ', 'g')"
    return f"regexp_matches({flat}, {_quoted('|'.join(v for k in kinds for v in R.values(k, 'like')))})"


def _structural(c: str) -> str:
    return f"({_in(f'lower({_strip(c)})', R.values('header cell'))} or {_like(c, 'date', 'period', 'year', 'year with unit')})"


def _rows(spark, sf_dir, relation: fixtures.Given) -> DataFrame:
    found = given(spark, sf_dir, relation)
    return found.withColumn("cells", F.split("line", "[|]")).drop("line")


def _rows_sql(relation: fixtures.Given, name: str = "r") -> str:
    return f"{name} as (select * exclude (line), string_split(line, '|') as cells from {relation})"


#: text, cells that are not empty, and the cells after the first
_TEXT = f"lower({_strip("array_to_string(list_filter(cells, lambda x: x <> ''), ' ')")})"
_NOTICE = f"({_TEXT} <> '' and ({_like(_TEXT, 'page number')} or {_any(_TEXT, R.values('notice'))}))"
_AMOUNTS = f"(len(list_filter(cells[2:], lambda c: c <> '' and {_is_amount('c')})) > 0)"
_LABEL = f"lower({_strip('cells[1]')})"
_ALONE = (
    f"(len(list_filter(cells, lambda x: x <> '')) = 1 and cells[1] <> '' and not {_like('cells[1]', 'unit')} and not {_any(_LABEL, R.values('header words'))} and {_LABEL} not like '%:'"
    rf" and not {_in(_LABEL, R.values('section'))} and len(regexp_split_to_array({_LABEL}, '\s+')) >= 3)"
)


@_query(f"""with {_rows_sql(fixtures.OVER.ROWS)} select id, {_TEXT} as row_text, {_NOTICE} as not_of_table, {_AMOUNTS} as has_amount, coalesce({_ALONE}, false) as is_label_only, {_like(_TEXT, 'unit')} as is_unit,
 {_like(_TEXT, 'title')} as is_title, {_like(_TEXT, 'period')} as is_period, {_in(_TEXT, R.values('section'))} as is_section, {_structural('cells[1]')} as is_structural,
 len(list_filter(cells, lambda c: c <> '' and regexp_matches(replace(c, ',', ''), {_quoted(numbers.TABLE_NUMBER)}))) as n_numbers from r""")
def row_predicates(spark, sf_dir) -> DataFrame:
    """What rows say by their cells."""
    told, text = _rows(spark, sf_dir, fixtures.OVER.ROWS).withColumn("told", R.tell(F.col("cells"))), F.col("told.text")
    return told.select(
        "id", text.alias("row_text"), F.col("told.notice").alias("not_of_table"), (F.col("told.amounts") > 0).alias("has_amount"), F.col("told.label_only").alias("is_label_only"), F.col("told.unit").alias("is_unit"),
        F.col("told.title").alias("is_title"), F.col("told.period").alias("is_period"), R.says(text, "section").alias("is_section"), R.says(R.low(F.get("cells", 0)), *R.STRUCTURAL).alias("is_structural"), numbers.numeric_cells(F.col("cells")).alias("n_numbers"),
    )


_LINE_CELLS = "l as (select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line from documents), r as (select doc_id, line, string_split(line, ' ') as cells from l)"


@_query(f"""with {_LINE_CELLS} select doc_id, count(*) as n_lines, count(*) filter ({_NOTICE}) as n_notices, count(*) filter ({_AMOUNTS}) as n_amounts, count(*) filter ({_like('line', 'unit')}) as n_units,
 count(*) filter ({_in(f"lower({_strip('line')})", R.values('section'))}) as n_sections, sum(len(list_filter(cells, lambda c: c <> '' and regexp_matches(replace(c, ',', ''), {_quoted(numbers.TABLE_NUMBER)}))))::bigint as n_numbers
 from r group by doc_id""")
def document_line_kinds(spark, sf_dir) -> DataFrame:
    """The same over the lines of all documents, counted by document."""
    lines = table(spark, sf_dir, "documents").select("doc_id", F.explode(F.split(F.coalesce("text", F.lit("")), "\n", -1)).alias("line"))
    # the cells are only looked at for numbers, and most lines hold no digit
    cells = F.when(numbers.holds_digits(F.col("line")), F.split("line", " ", -1)).otherwise(F.array().cast("array<string>"))
    low = lines.select("doc_id", cells.alias("cells"), R.low(F.col("line")).alias("line"))
    # the cells that are not empty, joined again
    text = F.when(F.contains("line", F.lit("  ")), F.regexp_replace("line", " {2,}", " ")).otherwise(F.col("line"))
    told = low.withColumn("text", text)
    notice = (F.col("text") != "") & R.says(F.col("text"), "notice", "page number")
    return told.groupBy("doc_id").agg(
        F.count("*").alias("n_lines"), F.count_if(notice).alias("n_notices"), F.count_if(R.amount_cells(F.col("cells")) > 0).alias("n_amounts"), F.count_if(R.says(F.col("line"), "unit")).alias("n_units"),
        F.count_if(R.says(F.col("line"), "section")).alias("n_sections"), F.sum(numbers.numeric_cells(F.col("cells"))).alias("n_numbers"),
    )


_PAGES = "partition by doc_id, page_number order by row_idx"
_JOINED = f"""m as (select *, coalesce({_ALONE}, false) as alone, {_AMOUNTS} as amounts from r),
n as (select *, case when lag(alone) over (w) then lag(cells[1]) over (w) end as before, coalesce(lead(amounts) over (w), false) as after from m window w as ({_PAGES})),
joined as (select doc_id, page_number, row_idx, case when before is not null and amounts then list_prepend({_strip("before || ' ' || cells[1]")}, cells[2:]) else cells end as cells from n where not (alone and after))"""


@_query(f"with {_rows_sql(fixtures.OVER.PAGE_ROWS)}, {_JOINED} select doc_id, page_number, row_idx, array_to_string(cells, '|') as line from joined")
def label_continuations(spark, sf_dir) -> DataFrame:
    """Labels that go on in the next row, joined."""
    return rebuild.join_labels(_rows(spark, sf_dir, fixtures.OVER.PAGE_ROWS)).select("doc_id", "page_number", "row_idx", F.array_join("cells", "|").alias("line"))


@_query()
def continuation_pages(spark, sf_dir) -> DataFrame:
    """Continuation pages without repeated headers, aligned to the pages before, without notices."""
    rows = rebuild.align(rebuild.drop_repeated_headers(_rows(spark, sf_dir, fixtures.OVER.PAGE_ROWS)))
    return rebuild.without_notices(rows).select("doc_id", "page_number", "row_idx", F.array_join("cells", "|").alias("line"))


@_query(f"""with {_rows_sql(fixtures.OVER.PAGE_ROWS)}, p as (select distinct doc_id, page_number, min(page_number) over (partition by doc_id) as least from r),
 e as (select doc_id, page_number, row_idx, array_to_string(cells, '|') as line from r union all select doc_id, page_number, -2, '' from p where page_number > least union all select doc_id, page_number, -1, 'continue' from p where page_number > least)
 select doc_id, row_number() over (partition by doc_id order by page_number, row_idx) - 1 as place, line from e""")
def continued_pages(spark, sf_dir) -> DataFrame:
    """A document's pages as one table, with separators."""
    return rebuild.continued(_rows(spark, sf_dir, fixtures.OVER.PAGE_ROWS)).select("doc_id", "place", F.array_join("cells", "|").alias("line"))


_STACKED = f"""{_rows_sql(fixtures.OVER.RECOGNISED_ROWS, "o")}, seams as (select distinct doc_id, page_number, table_idx, min(table_idx) over (partition by doc_id, page_number) as least from o),
stacked as (select doc_id, page_number, row_number() over (partition by doc_id, page_number order by table_idx, row_idx) - 1 as row_idx, array_to_string(cells, '|') as line
  from (select doc_id, page_number, table_idx, row_idx, cells from o union all select doc_id, page_number, table_idx, -1, []::varchar[] from seams where table_idx > least))"""


@_query(f"""with {_rows_sql(fixtures.OVER.PAGE_ROWS)}, {_STACKED} select doc_id, page_number, row_idx, array_to_string(cells, '|') as line, 'embedded' as method from r where (doc_id, page_number) not in (select doc_id, page_number from stacked)
 union all select doc_id, page_number, row_idx, line, '{rebuild.RECOGNISED}' from stacked""")
def recognised_pages(spark, sf_dir) -> DataFrame:
    """Pages whose rows were recognised in their image take those, tables one below the other."""
    return rebuild.with_recognised(_rows(spark, sf_dir, fixtures.OVER.PAGE_ROWS), rebuild.stacked(_rows(spark, sf_dir, fixtures.OVER.RECOGNISED_ROWS))).select("doc_id", "page_number", "row_idx", F.array_join("cells", "|").alias("line"), "method")


@_query(f"""with {_rows_sql(fixtures.OVER.PAGE_ROWS)}, d as (select 'zz' as doc_id union select doc_id from r),
 c as (select doc_id, count(*) as n_rows, sum(len(list_filter(cells, lambda c: c <> '' and regexp_matches(replace(c, ',', ''), {_quoted(numbers.TABLE_NUMBER)}))))::bigint as n_numbers from r where not {_NOTICE} group by 1),
 a as (select doc_id, coalesce(n_rows, 0) as n_rows, coalesce(n_numbers, 0) as n_numbers from d left join c using (doc_id))
 select *, case when n_rows = 0 then '{rebuild.NO_ROWS}' when n_numbers < {rebuild.LEAST_NUMBERS} then '{rebuild.FEW_NUMBERS}' end as warning from a""")
def table_density(spark, sf_dir) -> DataFrame:
    """Documents whose tables hold hardly a number."""
    rows = _rows(spark, sf_dir, fixtures.OVER.PAGE_ROWS)
    documents = rows.select("doc_id").union(spark.sql("SELECT 'zz' AS doc_id")).distinct()
    return rebuild.density(documents, rebuild.without_notices(rows))


def _sheet(spark, sf_dir) -> DataFrame:
    return _rows(spark, sf_dir, fixtures.OVER.PAGE_ROWS).where("page_number <> 4").drop("page_number")


def _coerced_sql() -> str:
    from ledgerloom.plans import catalogue

    glyph = numbers.GLYPH_NUMBER.replace("SPACE", numbers.SPACE)
    text = f"case when regexp_matches({_strip('cell')}, '{glyph}') then {_strip('cell')} else {_strip("translate(cell, '¥￦₩', '')")} end"
    million = catalogue.in_millions_sql("shown")
    return f"""with {_rows_sql(fixtures.OVER.PAGE_ROWS, "a")}, r as (select * exclude (page_number) from a where page_number <> 4),
e as (select doc_id, row_idx, unnest(cells) as cell, generate_subscripts(cells, 1) - 1 as col_idx, cells[1] as label from r),
h as (select doc_id, regexp_replace(lower(string_agg(cell, ' ' order by row_idx, col_idx)), '\\s+', ' ', 'g') as h from e where row_idx < 12 and {_strip('cell')} <> '' group by 1),
s as (select doc_id, ({catalogue.SCALE_SQL})::decimal(11,6) as scale from h),
n as (select distinct doc_id, col_idx from e where row_idx < 8 and lower({_strip('cell')}) in ('note', 'notes')),
j as (select e.*, {text} as shown, case when regexp_matches(lower(trim(label)), '{numbers.PER_SHARE}') then 1 else coalesce(scale, 1) end::decimal(11,6) as scale, n.doc_id is not null as is_note
  from e left join s using (doc_id) left join n on n.doc_id = e.doc_id and n.col_idx = e.col_idx),
v as (select *, case when not is_note then (({catalogue.amount_sql('cell')})::decimal(28,8) * scale)::decimal(28,8) end as value from j)
select doc_id, row_idx, col_idx, case when value is null then {million} end as text, value from v"""


@_query()
def coerced_cells(spark, sf_dir) -> DataFrame:
    """Every cell of a sheet as text or as an amount in millions."""
    return rebuild.coerced(_sheet(spark, sf_dir))


@_query(f"""with {_rows_sql(fixtures.OVER.PAGE_ROWS, "a")}, e as (select doc_id, unnest(cells) as cell, generate_subscripts(cells, 1) - 1 as col_idx from a where page_number <> 4 and row_idx < 8)
 select distinct doc_id, col_idx::int as col_idx from e where lower({_strip('cell')}) in ('note', 'notes')""")
def note_columns(spark, sf_dir) -> DataFrame:
    """Columns of note numbers."""
    return rebuild.note_columns(_sheet(spark, sf_dir))


# --- texts of models


@_query()
def answer_tables(spark, sf_dir) -> DataFrame:
    """Tables in models' answers, whatever their form."""
    texts = given(spark, sf_dir, fixtures.OVER.JSON).unionByName(given(spark, sf_dir, fixtures.OVER.MARKDOWN))
    return markup_tables.answer_tables(texts)


@_query(f"select color, case length(c) when 6 then 'FF' || c when 8 then c end as argb from (select color, upper(regexp_replace(trim(color), '^#', '')) as c from {fixtures.OVER.COLORS})")
def colors(spark, sf_dir) -> DataFrame:
    """Colours as spreadsheets write them."""
    return given(spark, sf_dir, fixtures.OVER.COLORS).select("color", labels.argb(F.col("color")).alias("argb"))


@_query("select p_partkey, (p_partkey % 11) / 10.0 between 0.6 and 0.9 as grey, p_name || ' Conflict - ' || p_type as conflict from part")
def text_and_number_helpers(spark, sf_dir) -> DataFrame:
    """Similarities between a match and a miss, and names of conflict columns."""
    return table(spark, sf_dir, "part").select("p_partkey", labels.in_grey_band((F.col("p_partkey") % 11).cast("decimal(3,1)") / 10).alias("grey"), labels.conflict_column(F.col("p_name"), F.col("p_type")).alias("conflict"))


# --- the registry's life cycle; documents stand for files


def _files(spark, sf_dir) -> DataFrame:
    """binaryFile rows: a document is a file of its source's folder, by kinds of names."""
    d = table(spark, sf_dir, "documents")
    name = F.concat(F.when(F.col("doc_id") % 3 == 0, "Report ").otherwise("report-"), "doc_id", F.when(F.col("doc_id") % 4 == 0, ".PDF").when(F.col("doc_id") % 4 == 1, ".txt").otherwise(".pdf"))
    return d.select(F.concat(F.lit("root/companies/"), "source", F.lit("/Financial_Statements/"), name).alias("path"), F.col("text").cast("binary").alias("content"), F.timestamp_seconds(F.col("doc_id")).alias("modificationTime"))


_FILES_SQL = """f as (select source as company, case when doc_id % 3 = 0 then 'Report ' else 'report-' end || doc_id || case when doc_id % 4 = 0 then '.PDF' when doc_id % 4 = 1 then '.txt' else '.pdf' end as file_name, sha256(text) as sha256, doc_id from documents),
r as (select company, file_name, 'root/companies/' || company || '/Financial_Statements/' || file_name as source_path, sha256, doc_id from f where lower(file_name) like '%.pdf')"""


@_query(f"with {_FILES_SQL} select company, file_name, source_path, sha256, row_number() over (partition by company order by lower(file_name), source_path) as place from r")
def file_registry(spark, sf_dir) -> DataFrame:
    """Report files with their hashes, in order."""
    return registry.discovered(_files(spark, sf_dir)).drop("mtime")


@_query(rf"""select company, case when json_valid(text) and json_type(text) = 'OBJECT' and json_type(text, '$.seen_hashes') = 'ARRAY' then array_to_string(from_json(json_extract(text, '$.seen_hashes'), '["VARCHAR"]'), ',') else '' end as seen from {fixtures.OVER.MANIFESTS}""")
def manifest_hashes(spark, sf_dir) -> DataFrame:
    """Hashes of legacy manifests, whatever their shape."""
    return registry.manifests(given(spark, sf_dir, fixtures.OVER.MANIFESTS)).select("company", F.array_join("seen", ",").alias("seen"))


@_query(f"with {_FILES_SQL} select file_name, sha256, false as explicit from r where sha256 not in (select sha256(text) from documents where doc_id % 5 = 0) union all select file_name, sha256, true from r where doc_id % 7 = 0")
def manifest_select(spark, sf_dir) -> DataFrame:
    """Files to process, by unseen hashes or by listed paths."""
    files = registry.discovered(_files(spark, sf_dir))
    seen = table(spark, sf_dir, "documents").where("doc_id % 5 = 0").select(F.array(F.sha2(F.col("text").cast("binary"), 256)).alias("seen"))
    listed = files.where(F.regexp_extract("file_name", "([0-9]+)", 1).cast("long") % 7 == 0).select(F.col("source_path").alias("path"))
    columns = lambda df, explicit: df.select("file_name", "sha256", F.lit(explicit).alias("explicit"))
    return columns(registry.selected(files, seen), False).unionByName(columns(registry.selected(files, seen, listed), True))


_BOOKS_SQL = """b as (select source as company, 'out/' || source || '_Report_' || doc_id || '_statements' || case when doc_id % 2 = 0 then '' else '_2' end || case when doc_id % 10 = 9 then '_extraction_record' else '' end || '.xlsx' as path from documents where doc_id % 3 = 0
  union all select source, 'out/' || source || '_Report_' || doc_id || '_statements_A.xlsx' from documents where doc_id % 6 = 0)"""


def _books(spark, sf_dir) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    start = F.concat(F.lit("out/"), "source", F.lit("_Report_"), "doc_id", F.lit("_statements"))
    first = d.where("doc_id % 3 = 0").select(F.col("source").alias("company"), F.concat(start, F.when(F.col("doc_id") % 2 == 0, "").otherwise("_2"), F.when(F.col("doc_id") % 10 == 9, "_extraction_record").otherwise(""), F.lit(".xlsx")).alias("path"))
    return first.unionByName(d.where("doc_id % 6 = 0").select(F.col("source").alias("company"), F.concat(start, F.lit("_A.xlsx")).alias("path")))


@_query(f"with {_BOOKS_SQL} select company, path, row_number() over (partition by company order by lower(regexp_extract(path, '([^/]*)$', 1)), path) as place from (select distinct company, path from b where path not like '%\\_extraction\\_record.xlsx' escape '\\')")
def existing_workbooks(spark, sf_dir) -> DataFrame:
    """Statement workbooks that are there, in order."""
    return registry.workbooks(_books(spark, sf_dir))


@_query(f"""with {_FILES_SQL}, {_BOOKS_SQL}, w as (select * from r where sha256 not in (select sha256(text) from documents where doc_id % 5 = 0)),
 m as (select w.company, file_name, source_path, sha256, path from w join b on b.company = w.company and regexp_extract(path, '([^/]*)$', 1) like replace(w.company || '_' || trim(regexp_replace(regexp_replace(file_name, '(.)\\.[^.]*$', '\\1'), '[^\\p{{L}}\\p{{N}}_-]', '_', 'g'), '_'), '_', '\\_') || '\\_statements%.xlsx' escape '\\' and path not like '%\\_extraction\\_record.xlsx' escape '\\')
 select company, file_name, source_path, sha256, arg_min(path, lower(regexp_extract(path, '([^/]*)$', 1))) as output_workbook from m group by all""")
def registry_backfill(spark, sf_dir) -> DataFrame:
    """Workbooks of earlier runs found for reports that have no record."""
    reports = registry.discovered(_files(spark, sf_dir))
    done = table(spark, sf_dir, "documents").where("doc_id % 5 = 0").select(F.sha2(F.col("text").cast("binary"), 256).alias("sha256"))
    return registry.backfilled(reports, done, _books(spark, sf_dir))


def _outcomes(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    outcomes = given(spark, sf_dir, fixtures.OVER.OUTCOMES)
    name = F.element_at(F.split("source_path", "/"), -1)
    return outcomes, outcomes.select("company", name.alias("file_name"), "source_path", F.sha2(name.cast("binary"), 256).alias("sha256"), F.lit(1.5).alias("mtime"))


@_query(f"""select company, regexp_extract(source_path, '([^/]*)$', 1) as file_name, regexp_replace(source_path, '^base/', '') as source_path, sha256(regexp_extract(source_path, '([^/]*)$', 1)) as sha256, regexp_replace(output_path, '^base/', '') as output_workbook
 from {fixtures.OVER.OUTCOMES} where company not in (select company from {fixtures.OVER.OUTCOMES} where error is not null)""")
def processed_records(spark, sf_dir) -> DataFrame:
    """Records of a run, of companies of which every report succeeded."""
    outcomes, reports = _outcomes(spark, sf_dir)
    return registry.records(reports, outcomes, "base", "2024-01-01 00:00:00").drop("mtime", "processed_at")


@_query(f"select company, count(*) filter (error is null) as succeeded, count(*) filter (error is not null) as failed from {fixtures.OVER.OUTCOMES} group by 1")
def run_summary(spark, sf_dir) -> DataFrame:
    """What became of a run."""
    return registry.summary(_outcomes(spark, sf_dir)[0])
