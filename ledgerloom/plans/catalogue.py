"""Named queries of the statement engine and their DuckDB counterparts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerloom.functions import labels, numbers, periods
from ledgerloom.operators import locate, merge, reconcile, registry, reports, sheets, words
from ledgerloom.plans import fixtures, pages, reconstruction
from ledgerloom.sources import markup_tables
from ledgerloom.sources.star import STATEMENTS_SQL, given, statements, table

YEARS = [str(y) for y in range(2005, 2013)]
_QUERIES: dict = {}
_SQL: dict[str, str] = {}


def _query(sql: str | None = None):
    def add(f):
        _QUERIES[f.__name__] = f
        if sql is not None:
            _SQL[f.__name__] = sql
        return f

    return add


def queries() -> dict:
    return _QUERIES | reconstruction.QUERIES | pages.QUERIES


def oracle_sql() -> dict[str, str]:
    late = {
        "coerced_cells": reconstruction._coerced_sql(), "merged_fuzzy_rows": pages._merged_fuzzy_sql(), "statement_grid": pages._grid_sql(),
        "statement_sheets_to_facts": pages.SQL["statement_sheets_to_facts"].replace("{KEY}", _key_sql("label")),
    }
    return _SQL | reconstruction.SQL | pages.SQL | late


# --- DuckDB pieces that several queries use; a macro for each scalar rule


def _strip_sql(c: str) -> str:
    return f"regexp_replace({c}, '^{numbers.SPACE}+|{numbers.SPACE}+$', '', 'g')"


def amount_sql(c: str) -> str:
    """numbers.amount in DuckDB."""
    text, mark, glyph = _strip_sql(f"translate({c}, '¥￦₩', '')"), numbers.MARKS, numbers.GLYPH_NUMBER.replace("SPACE", numbers.SPACE)
    bare = _strip_sql(f"regexp_replace({_strip_sql(f"regexp_replace({text}, '^{mark}{numbers.SPACE}*', '', 'i')")}, '{numbers.SPACE}*{mark}$', '', 'i')")
    token = _strip_sql(f"regexp_replace(regexp_replace({bare}, '^W ', ''), ' W$', '')")
    value = f"try_cast(replace(regexp_replace({token}, '[()]', '', 'g'), ',', '') as decimal(28,8))"
    return rf"""case when not regexp_matches({_strip_sql(c)}, '{glyph}') and not regexp_matches({text}, '^[0-9]{{4}}$') and {text} not in ('-', '–', '')
      and regexp_matches({token}, '^(\(?-?([0-9]+|[0-9]{{1,3}}(,[0-9]{{3}})+)(\.[0-9]+)?\)?|-)$')
      then case when {token} like '(%' and {token} like '%)' then -{value} else {value} end end"""


def _key_sql(c: str) -> str:
    return rf"trim(regexp_replace(regexp_replace(replace(lower({c}), '&', 'and'), '\([^)]*\)', '', 'g'), '[^a-z0-9]+', ' ', 'g'))"


_FACTS_SQL = f"""with {STATEMENTS_SQL},
keyed as (select *, {_key_sql("label")} as base from statements),
latest as (select company, workbook, max(period::int) as latest from statements group by all),
facts as (
  select *, base || '#' || dense_rank() over (partition by company, workbook, sheet, base order by row_idx) as key, dense_rank() over (partition by company order by latest, workbook::varchar) as seq
  from keyed join latest using (company, workbook) where base <> ''),
placed as (select *, row_number() over (partition by company, sheet order by seq, row_idx) - 1 as position
  from (select company, sheet, key, min(seq) as seq, arg_min(row_idx, seq) as row_idx from facts group by all)),
merged as (select company, sheet, key, period, ({amount_sql("arg_max(raw_text, seq)")})::decimal(28,8) as value, max(workbook)::varchar as workbook from facts group by all),
named as (select company, sheet, key, arg_max(label, seq) as label, any_value(position) as position from facts join (select company, sheet, key, position from placed) using (company, sheet, key) group by all)"""

# --- statements from the star schema


@_query(_FACTS_SQL + " select company, sheet, position, label, key, " + ", ".join(f"max(value) filter (period = '{y}')::decimal(28,8) as y{y}" for y in YEARS) + " from merged join named using (company, sheet, key) group by company, sheet, position, label, key")
def merged_statement_annual(spark, sf_dir) -> DataFrame:
    """One wide multi-year statement per company and sheet, merged from annual reports: the flagship."""
    return merge.wide(merge.merged(merge.facts(statements(spark, sf_dir))), YEARS)


@_query(_FACTS_SQL + " select company, sheet, key, position, period, value::decimal(28,8) as value, workbook, label from merged join named using (company, sheet, key)")
def last_writer_wins_nulls(spark, sf_dir) -> DataFrame:
    """The same in long form: a later report's blank erases an earlier amount."""
    return merge.merged(merge.facts(statements(spark, sf_dir))).select("company", "sheet", "key", "position", "period", F.col("value").cast("decimal(28,8)").alias("value"), "workbook", "label")


@_query(f"""with {STATEMENTS_SQL}, q as (select company, sheet, item, year, quarter, case when l_returnflag = 'R' then -sum(v) else sum(v) end::decimal(28,4) as v
  from (select *, case l_returnflag when 'A' then 'Balance Sheet' when 'N' then 'Income Statement' else 'Cash Flow Statement' end as sheet from sales) group by company, sheet, l_returnflag, item, year, quarter),
 c as (select company, sheet, year, 'Q' || quarter || ' ' || year as period, item, v, quarter from q union all select company, sheet, year, year::varchar, item, sum(v), null from q group by all),
 p as (select company, sheet, period, row_number() over (partition by company, sheet order by quarter is not null, year, quarter) as place from (select distinct company, sheet, period, year, quarter from c)),
 shown as (select company, sheet, {_key_sql("item")} || '#1' as key, period, ({amount_sql("case when v < 0 then '(' || format('{:,}', cast(abs(round(v, 0)) as bigint)) || ')' else format('{:,}', cast(abs(round(v, 0)) as bigint)) end")})::decimal(28,8) as value from c)
 select company, sheet, key, period, place, value from shown join p using (company, sheet, period)""")
def merged_statement_quarterly(spark, sf_dir) -> DataFrame:
    """Reports with four quarters and their year, merged: annual columns in order, then quarters."""
    from ledgerloom.sources.star import sales, shown

    quarters = sales(spark, sf_dir, quarterly=True)
    columns = F.array(F.concat(F.lit("Q"), "quarter", F.lit(" "), "year"), F.col("year").cast("string"))
    summed = quarters.withColumn("period", F.explode(columns)).groupBy("company", "sheet", "item", "year", "period").agg(F.sum("v").cast("decimal(28,4)").alias("v"))
    cells = summed.select("company", F.col("year").alias("workbook"), "sheet", F.xxhash64("item").alias("row_idx"), F.col("item").alias("label"), "period", shown(F.col("v")).alias("raw_text"))
    merged = merge.merged(merge.facts(cells))
    return merge.with_places(merged).select("company", "sheet", "key", "period", "place", F.col("value").cast("decimal(28,8)").alias("value"))


@_query(f"with {STATEMENTS_SQL} select company, workbook, max(period::int) as latest, row_number() over (partition by company order by max(period::int), workbook) as position from statements group by company, workbook")
def latest_period_order(spark, sf_dir) -> DataFrame:
    """Reports in the order in which they are merged: by their latest period."""
    seen = merge.in_order(statements(spark, sf_dir)).select("company", "workbook", "seq", "period")
    return seen.groupBy("company", "workbook", F.col("seq").alias("position")).agg(F.max(periods.sort_key(periods.parse(F.col("period")))).getField("year").alias("latest"))


@_query(f"with {STATEMENTS_SQL} select company, sheet, period, count(distinct workbook) as n_workbooks, min(workbook) as first_seen from statements group by all")
def union_periods(spark, sf_dir) -> DataFrame:
    """The union of period columns over reports."""
    return statements(spark, sf_dir).groupBy("company", "sheet", "period").agg(F.count_distinct("workbook").alias("n_workbooks"), F.min("workbook").alias("first_seen"))


@_query(_FACTS_SQL + """, items as (select distinct company, sheet, key from merged), spans as (select distinct company, sheet, period from merged)
 select i.company, i.sheet, i.key, s.period, m.value::decimal(28,8) as value from items i join spans s using (company, sheet) left join merged m using (company, sheet, key, period)""")
def densify_rows(spark, sf_dir) -> DataFrame:
    """Every item of a statement with every period of it, null where no report has an amount."""
    dense = merge.densified(merge.merged(merge.facts(statements(spark, sf_dir))))
    return dense.select("company", "sheet", "key", "period", F.col("value").cast("decimal(28,8)").alias("value"))


@_query(f"""with n as (select distinct {_key_sql("p_type || ' ' || p_name || ' receivable from related parties'")} as key from part)
 select key, key || 's' as other, round(2.0 * len(key) / (2 * len(key) + 1), 6)::double as score from n""")
def fuzzy_label_match(spark, sf_dir) -> DataFrame:
    """Part names against edited ones: nearest label, similarity 0.96 or more."""
    names = table(spark, sf_dir, "part").select(F.lit(1).alias("g"), labels.item_key(F.concat("p_type", F.lit(" "), "p_name", F.lit(" receivable from related parties"))).alias("key")).distinct()
    return merge.fuzzy_matches(names, names.select("g", F.concat("key", F.lit("s")).alias("key")), ["g"]).drop("g")


# --- amounts, units, labels


@_query(f"select raw_text, ({amount_sql('raw_text')})::decimal(28,8) as value from {fixtures.OVER.AMOUNTS}")
def parse_amounts(spark, sf_dir) -> DataFrame:
    """Cell texts to amounts."""
    return given(spark, sf_dir, fixtures.OVER.AMOUNTS).withColumn("value", numbers.amount(F.col("raw_text")))


@_query(f"select l_orderkey, l_linenumber, ({amount_sql('raw')})::decimal(28,8) as value from (select l_orderkey, l_linenumber, 'US$ (' || format('{{:,}}', cast(round(l_extendedprice::decimal(18,4), 0) as bigint)) || ')' as raw from lineitem)")
def parse_line_amounts(spark, sf_dir) -> DataFrame:
    """The same over all order lines, printed as negative dollar amounts."""
    whole = F.format_number(F.round(F.col("l_extendedprice").cast("decimal(18,4)"), 0), 0)
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", numbers.amount(F.concat(F.lit("US$ ("), whole, F.lit(")"))).alias("value"))


SCALE_SQL = "case " + " ".join(rf"when regexp_matches(h, '{p.replace(chr(39), chr(39) * 2)}') then {s}" for p, s in numbers.SCALES) + " else 1 end"


@_query(rf"select id, ({SCALE_SQL})::decimal(11,6) as scale from (select id, regexp_replace(lower(header), '\s+', ' ', 'g') as h from {fixtures.OVER.HEADERS})")
def unit_scale_detect(spark, sf_dir) -> DataFrame:
    """The scale to millions that header texts ask for."""
    return given(spark, sf_dir, fixtures.OVER.HEADERS).select("id", numbers.scale_of(F.col("header")).alias("scale"))


def in_millions_sql(c: str) -> str:
    return rf"""regexp_replace(regexp_replace(regexp_replace({c}, '\bin\s+(thousands?|billions?)\b', 'in millions', 'gi'),
 '\b(expressed|amounts?)\s+in\s+((?:korean\s+)?won|krw|(?:u\.s\.\s+)?dollars?|usd)\b', '\1 in millions of \2', 'gi'), '\$000\b', '$m', 'gi')"""


@_query(f"select id, {in_millions_sql('header')} as header from {fixtures.OVER.HEADERS}")
def unit_text_rewrite(spark, sf_dir) -> DataFrame:
    """Header texts with their units rewritten to millions."""
    return given(spark, sf_dir, fixtures.OVER.HEADERS).select("id", numbers.in_millions(F.col("header")).alias("header"))


@_query(rf"""select label, regexp_matches(lower(trim(label)), '{numbers.PER_SHARE}') as not_monetary, regexp_matches(trim(label), '{labels.NOTE_CELL}') as is_note,
 {_key_sql("label")} as item_key, regexp_replace(regexp_replace(trim(lower(label)), '\s+', ' ', 'g'), '[–—]', '-', 'g') as checked from {fixtures.OVER.LABELS}""")
def label_predicates(spark, sf_dir) -> DataFrame:
    """Labels with the predicates and normal forms that other operators use."""
    c = F.col("label")
    return given(spark, sf_dir, fixtures.OVER.LABELS).select(c, numbers.not_monetary(c).alias("not_monetary"), labels.is_note(c).alias("is_note"), labels.item_key(c).alias("item_key"), labels.checked_label(c).alias("checked"))


@_query(f"select p_partkey, {_key_sql('p_name || ' + chr(39) + ' & ' + chr(39) + ' || p_type || ' + chr(39) + ' (net)' + chr(39))} as item_key from part")
def normalize_labels(spark, sf_dir) -> DataFrame:
    """Decorated part names as merge keys."""
    return table(spark, sf_dir, "part").select("p_partkey", labels.item_key(F.concat("p_name", F.lit(" & "), "p_type", F.lit(" (net)"))).alias("item_key"))


@_query(r"""select p_partkey, substr(regexp_replace(regexp_replace(p_name || '/' || p_type, '[^\p{L}\p{N}_-]', '_', 'g'), '^_+|_+$', '', 'g'), 1, 80) as safe_name,
 case when p_partkey % 900 + 1 > 702 then chr((65 + ((p_partkey % 900 + 1 - 27) // 676 - 1) % 26)::int) else '' end || case when p_partkey % 900 + 1 > 26 then chr((65 + ((p_partkey % 900) // 26 - 1) % 26)::int) else '' end
 || chr((65 + (p_partkey % 900) % 26)::int) as letters from part""")
def safe_names(spark, sf_dir) -> DataFrame:
    """File names, and spreadsheet column letters."""
    n = (F.col("p_partkey") % 900 + 1).cast("int")
    return table(spark, sf_dir, "part").select("p_partkey", labels.safe_name(F.concat("p_name", F.lit("/"), "p_type")).alias("safe_name"), labels.column_letters(n).alias("letters"))


# --- periods


def _period_sql() -> str:
    from ledgerloom.functions.periods import DATE, FISCAL, QUARTER, YEAR, YEAR_QUARTER

    # RE2 takes its flag at the start of a pattern as Java does
    part = lambda c, p, k: f"nullif(regexp_extract({c}, '{p}', {k}), '')::int"
    lengths = {"three": 3, "six": 6, "nine": 9, "twelve": 12}
    named = ", ".join(rf"case when regexp_matches(low, '\b{w}[-\s]months?\b') then {n} end" for w, n in lengths.items())
    return rf"""with t as (select raw_text, regexp_replace({_strip_sql('raw_text')}, '{numbers.SPACE}+', ' ', 'g') as t from {fixtures.OVER.PERIODS}),
s as (select *, regexp_replace(replace(t, '(', ' ('), '\s+', ' ', 'g') as s, lower(regexp_replace({_strip_sql("regexp_replace(replace(t, '(', ' ('), ' +', ' ', 'g')")}, '\s+', ' ', 'g')) as low from t),
m as (select *, list_distinct(list_concat(list_filter([{named}], lambda x: x is not null), list_transform(regexp_extract_all(low, '\b(3|6|9|12)[-\s]months?\b', 1), lambda x: x::int))) as found,
  lower(regexp_extract(s, '{DATE}', 1)) as month, {part('s', DATE, 2)} as day from s),
d as (select *, case when len(found) = 1 then found[1] else 0 end as length, case when month like 'mar%' and day = 31 then 1 when month like 'jun%' and day = 30 then 2 when month like 'sep%' and day = 30 then 3 end as dated from m),
p as (select raw_text, case when regexp_matches(t, '{QUARTER}') then 1 when regexp_matches(t, '{YEAR_QUARTER}') then 2 when regexp_matches(t, '{FISCAL}') then 3 when dated is not null then 4 when regexp_matches(t, '{YEAR}') then 5 end as form, * exclude (raw_text) from d),
y as (select raw_text, form,
  case form when 1 then {part('t', QUARTER, 3)} when 2 then {part('t', YEAR_QUARTER, 1)} when 3 then {part('t', FISCAL, 1)} + 2000 when 4 then {part('s', DATE, 3)} when 5 then {part('t', YEAR, 1)} end as year,
  case form when 1 then {part('t', QUARTER, 2)} when 2 then {part('t', YEAR_QUARTER, 2)} when 3 then {part('t', FISCAL, 2)} when 4 then dated when 5 then 0 end as quarter,
  case form when 1 then coalesce({part('t', QUARTER, 1)}, 0) when 4 then length when 2 then 0 when 3 then 0 when 5 then 0 end as months from p)
select raw_text, case when form = 5 then year::varchar else case when months > 0 then months || '-Month ' else '' end || 'Q' || quarter || ' ' || year end as label, case form when 5 then 'annual' else case when form is not null then 'quarter' end end as kind, year, quarter, months from y"""


@_query(_period_sql())
def parse_periods(spark, sf_dir) -> DataFrame:
    """Header texts to periods."""
    return given(spark, sf_dir, fixtures.OVER.PERIODS).select("raw_text", periods.parse(F.col("raw_text")).alias("p")).select("raw_text", "p.*")


@_query("""select o_orderkey, case o_orderkey % 4 when 0 then 'Q' || quarter(o_orderdate) || ' ' || y when 1 then 'Q' || quarter(o_orderdate) || ' ' || y when 2 then y::varchar
 else '9-Month Q' || quarter(o_orderdate) || ' ' || y end as label, y as year, case when o_orderkey % 4 = 2 then 0 else quarter(o_orderdate) end::int as quarter
 from (select *, (year(o_orderdate) + 10)::int as y from orders)""")
def parse_order_periods(spark, sf_dir) -> DataFrame:
    """Order dates printed in four header styles and parsed back."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", (F.year("o_orderdate") + 10).cast("string").alias("y"), F.quarter("o_orderdate").cast("string").alias("q"))
    style = F.col("o_orderkey") % 4
    text = (
        F.when(style == 0, F.concat(F.lit("Q"), "q", F.lit(" "), "y"))
        .when(style == 1, F.concat(F.lit("FY"), F.substring("y", 3, 2), F.lit(" "), "q", F.lit("Q")))
        .when(style == 2, F.concat(F.lit("31 December "), "y"))
        .otherwise(F.concat(F.lit("9-month Q"), "q", F.lit(" "), "y"))
    )
    return o.select("o_orderkey", periods.parse(text).alias("p")).select("o_orderkey", "p.label", "p.year", "p.quarter")


# --- sheets


@_query()
def sheet_to_facts(spark, sf_dir) -> DataFrame:
    """Statement sheets to facts."""
    return sheets.facts(given(spark, sf_dir, fixtures.OVER.SHEETS))


@_query()
def entity_period_labels(spark, sf_dir) -> DataFrame:
    """Header periods, with entity names where labels would be equal."""
    cells = given(spark, sf_dir, fixtures.OVER.SHEETS)
    return sheets.with_entities(cells, sheets.header_cells(cells)).select("doc_id", "row_idx", "col_idx", "label")


@_query("""select l_orderkey, l_linenumber, l_returnflag || '#' || row_number() over (partition by l_orderkey, l_returnflag order by l_linenumber, l_partkey, l_suppkey, l_extendedprice) as key from lineitem""")
def occurrence_keys(spark, sf_dir) -> DataFrame:
    """Repeated labels of an order, numbered in order."""
    nth = F.row_number().over(W.partitionBy("l_orderkey", "l_returnflag").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"))
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.concat("l_returnflag", F.lit("#"), nth).alias("key"))


# --- reconciliation


def _recon_sql() -> str:
    """The identities of statements, from cells to issues, in DuckDB."""
    r = reconcile
    checked = lambda c: f"regexp_replace(regexp_replace(trim(lower(coalesce({c}, ''))), '\\s+', ' ', 'g'), '[–—]', '-', 'g')"
    roles = " union all ".join(f"select '{s}' as statement_type, '{role}' as role, '{p}' as pattern" for s, many in r.ROLES.items() for role, p in many.items())
    sums = " union all ".join(
        f"select '{rule}' as rule, '{s}' as statement_type, '{role}' as role, {sign} as sign, {optional} as optional"
        for rule, (s, target, addends, extra) in r.SUMS.items() for role, sign, optional in ((target, 0, False), *((a, 1, False) for a in addends), *((a, 1, True) for a in extra))
    )
    name = "(operating|investing|financing)"
    return rf"""with cells as (select * from {fixtures.OVER.STATEMENTS}),
labels as (select doc_id, statement_type, row_idx, {checked('raw_text')} as label from cells where col_idx = 0),
bare as (select c.*, label, {_strip_sql('raw_text')} as t, {_strip_sql(f"translate(regexp_replace({_strip_sql('raw_text')}, '^[()]+|[()]+$', '', 'g'), ',$₩W', '')")} as bare from cells c join labels using (doc_id, statement_type, row_idx) where col_idx > 0),
vals as (select doc_id, statement_type, row_idx, col_idx, label, case when regexp_matches(bare, '{numbers.STRICT}') then case when t like '(%' and t like '%)' then -1 else 1 end * bare::decimal(28,8) end as value from bare),
roles as ({roles}),
found as (select *, dense_rank() over (partition by doc_id, statement_type, role order by row_idx) as k from vals join roles using (statement_type) where regexp_matches(label, pattern)),
taken as (select doc_id, statement_type, role, row_idx, col_idx, value from found where k = 1 and value is not null),
sums as ({sums}),
has as (select distinct doc_id, statement_type, role from taken),
cols as (select distinct doc_id, statement_type, col_idx from taken),
needed as (select c.*, rule, role, sign, value from cols c join sums s using (statement_type) left join has h using (doc_id, statement_type, role) left join taken t using (doc_id, statement_type, role, col_idx) where not optional or h.role is not null),
added as (select rule, doc_id, statement_type, col_idx, max(value) filter (sign = 0) as reported, sum(value * sign) as calculated from needed group by all having count(*) = count(value)),
margins as (select 'RC5' as rule, doc_id, statement_type, col_idx, max(value) filter (role = 'gross') as reported, max(value) filter (role = 'revenue') + case when max(value) filter (role = 'cost') < 0 then 1 else -1 end * max(value) filter (role = 'cost') as calculated
  from taken where statement_type = 'income_statement' group by all),
starts as (select doc_id, regexp_extract(label, '^cash flows from {name} activities$', 1) as name, min(row_idx) as start from labels where statement_type = 'cash_flow' group by all),
ends as (select l.doc_id, s.name, start, min(row_idx) as stop from labels l join starts s on l.doc_id = s.doc_id and s.name <> '' and row_idx > start and regexp_matches(label, replace('{r._ACTIVITY}', '{{}}', s.name)) where statement_type = 'cash_flow' group by all),
parts as (select v.*, case name when 'operating' then 'RC6' when 'investing' then 'RC7' else 'RC8' end as rule, row_idx = stop as is_total from vals v join ends e on v.doc_id = e.doc_id and v.statement_type = 'cash_flow' and row_idx > start and row_idx <= stop
  where value is not null and (row_idx = stop or (label <> '' and not regexp_matches(label, '{r._NOT_ITEMS}')))),
sections as (select rule, doc_id, statement_type, col_idx, max(value) filter (is_total) as reported, sum(value) filter (not is_total) as calculated from parts group by all),
issues as (select rule, doc_id, statement_type, col_idx, reported::decimal(28,8) as reported, calculated::decimal(28,8) as calculated, (reported - calculated)::decimal(28,8) as difference
  from (select * from added union all select * from margins union all select * from sections) where abs(reported - calculated) > {r.TOLERANCE})"""


@_query(_recon_sql() + " select * from issues")
def recon_issues(spark, sf_dir) -> DataFrame:
    """Identities that fail on fixture statements."""
    return reconcile.issues(given(spark, sf_dir, fixtures.OVER.STATEMENTS))


@_query(_recon_sql() + """, rules as (select rule, role from sums union select 'RC5', unnest(['gross', 'revenue', 'cost'])),
 taking as (select doc_id, statement_type, col_idx, rule, row_idx from taken join rules using (role) union all select doc_id, statement_type, col_idx, rule, row_idx from parts)
 select distinct doc_id, statement_type, row_idx, col_idx from taking semi join issues using (doc_id, statement_type, col_idx, rule)""")
def failed_cells(spark, sf_dir) -> DataFrame:
    """The cells that take part in failures."""
    return reconcile.failed_cells(given(spark, sf_dir, fixtures.OVER.STATEMENTS))


@_query("""select o_orderkey, o_totalprice::decimal(18,2) as reported, t.calculated, (o_totalprice::decimal(18,2) - t.calculated)::decimal(20,2) as difference
 from orders join (select l_orderkey, sum(l_extendedprice::decimal(18,2))::decimal(18,2) as calculated from lineitem group by 1) t on o_orderkey = l_orderkey
 where abs(o_totalprice::decimal(18,2) - t.calculated) > 1""")
def recon_order_totals(spark, sf_dir) -> DataFrame:
    """Orders whose total is not the sum of their lines, within a tolerance of 1."""
    lines = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("decimal(18,2)").alias("calculated"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_totalprice").cast("decimal(18,2)").alias("reported"))
    both = orders.join(lines, "o_orderkey").withColumn("difference", (F.col("reported") - F.col("calculated")).cast("decimal(20,2)"))
    return both.where(F.abs("difference") > 1)


# --- pages


@_query()
def locate_candidates(spark, sf_dir) -> DataFrame:
    """Statement candidates of fixture documents."""
    return locate.candidates(given(spark, sf_dir, fixtures.OVER.PAGES))


@_query(r"""select doc_id, array_to_string(list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(regexp_replace(x, '[ \t]+', ' ', 'g'))), lambda x: x <> '')[1:8], ' ') as head from documents""")
def page_head_lines(spark, sf_dir) -> DataFrame:
    """The first eight lines of each document that are not blank."""
    return table(spark, sf_dir, "documents").select("doc_id", F.array_join(labels.head(F.col("text"), 8), " ").alias("head"))


@_query("""with e as (select *, case when ts - lag(ts) over w <= interval 1 hour and lag(event_type) over w = event_type then 0 else 1 end as fresh from events window w as (partition by user_id order by ts, event_id)),
 i as (select *, sum(fresh) over (partition by user_id order by ts, event_id) as island from e)
 select user_id, island::bigint as island, any_value(event_type) as event_type, count(*) as n, min(event_id) as first_id, sum(value::decimal(18,6))::decimal(28,6) as total from i group by user_id, island""")
def event_islands(spark, sf_dir) -> DataFrame:
    """Adjacent merges over events: runs of one type with gaps of at most an hour."""
    order = W.partitionBy("user_id").orderBy("ts", "event_id")
    near = (F.col("ts") - F.lag("ts").over(order) <= F.expr("interval '1' hour")) & (F.lag("event_type").over(order) == F.col("event_type"))
    marked = table(spark, sf_dir, "events").withColumn("fresh", F.when(near, 0).otherwise(1)).withColumn("island", F.sum("fresh").over(order))
    return marked.groupBy("user_id", "island").agg(F.min("event_type").alias("event_type"), F.count("*").alias("n"), F.min("event_id").alias("first_id"), F.sum(F.col("value").cast("decimal(18,6)")).cast("decimal(28,6)").alias("total"))


_WORDS_SQL = f"""with recursive w as (select doc_id, page_number, x0::double as x0, y0::double as y0, x1::double as x1, text from {fixtures.OVER.WORDS}),
o as (select *, row_number() over (partition by doc_id, page_number order by round_even(y0 / {words.TOLERANCE}, 0), x0) as k from w),
lines as (select *, 0 as line_no, y0 as total, 1 as n from o where k = 1
  union all select o.*, l.line_no + (abs(o.y0 - total / n) > {words.TOLERANCE})::int, case when abs(o.y0 - total / n) > {words.TOLERANCE} then o.y0 else total + o.y0 end, case when abs(o.y0 - total / n) > {words.TOLERANCE} then 1 else n + 1 end
  from lines l join o on o.doc_id = l.doc_id and o.page_number = l.page_number and o.k = l.k + 1),
m as (select doc_id, page_number, (x0 + x1) / 2 as x, row_number() over (partition by doc_id, page_number order by (x0 + x1) / 2) as k from w),
clusters as (select *, 0 as c, x as total, 1 as n from m where k = 1
  union all select m.*, c + (abs(m.x - total / n) > {words.SPREAD})::int, case when abs(m.x - total / n) > {words.SPREAD} then m.x else total + m.x end, case when abs(m.x - total / n) > {words.SPREAD} then 1 else n + 1 end
  from clusters l join m on m.doc_id = l.doc_id and m.page_number = l.page_number and m.k = l.k + 1),
whole as (select doc_id, page_number, c, arg_max(total / n, n) as mean, max(n) as n from clusters group by all having max(n) >= {words.LEAST}),
best as (select *, row_number() over (partition by doc_id, page_number order by n desc, mean) as k from whole),
anchors as (select p.doc_id, p.page_number, coalesce(list(mean order by mean) filter (mean is not null), []) as anchors from (select distinct doc_id, page_number from w) p left join best b on b.doc_id = p.doc_id and b.page_number = p.page_number and b.k <= {words.MOST} group by all)"""


@_query(_WORDS_SQL + f""", placed as (select doc_id, page_number, line_no, x0, text, (x0 + x1) / 2 as x, anchors as a from lines join anchors using (doc_id, page_number))
 select doc_id, page_number, line_no, case when len(a) = 0 or x < a[1] - {words.BOUNDARY} then 0 else 1 + len(list_filter(range(1, len(a)), lambda i: x > (a[i] + a[i + 1]) / 2)) end as col_idx, string_agg(text, ' ' order by x0, text) as text from placed group by all""")
def words_to_cells(spark, sf_dir) -> DataFrame:
    """Page words to lines, anchors and cells."""
    found = given(spark, sf_dir, fixtures.OVER.WORDS).select("doc_id", "page_number", *[F.col(c).cast("double").alias(c) for c in ("x0", "y0", "x1")], "text")
    return words.to_cells(words.to_lines(found), words.anchors(found))


@_query(_WORDS_SQL + " select doc_id, page_number, array_to_string(list_transform(anchors, lambda x: printf('%.3f', x)), ' ') as anchors from anchors")
def cluster_anchors(spark, sf_dir) -> DataFrame:
    """Column anchors of pages."""
    found = words.anchors(given(spark, sf_dir, fixtures.OVER.WORDS).select("doc_id", "page_number", *[F.col(c).cast("double").alias(c) for c in ("x0", "x1")]))
    return found.select("doc_id", "page_number", F.array_join(F.transform("anchors", lambda x: F.format_string("%.3f", x)), " ").alias("anchors"))


# --- tables in texts


@_query()
def html_tables(spark, sf_dir) -> DataFrame:
    """Cells of HTML tables, spans laid out."""
    return markup_tables.html_tables(given(spark, sf_dir, fixtures.OVER.HTML))


_MARKDOWN_SQL = rf"""with l as (select doc_id, list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(x)), lambda x: x <> '') as lines from {fixtures.OVER.MARKDOWN}),
 e as (select doc_id, unnest(lines) as line, generate_subscripts(lines, 1) as i from l),
 p as (select *, line like '|%' and line like '%|' as piped from e),
 f as (select doc_id, min(i) filter (piped) as first from p group by 1), g as (select p.*, first, min(case when not piped and i > first then i end) over (partition by doc_id) as stop from p join f using (doc_id)),
 b as (select doc_id, i - first as k, list_transform(string_split(regexp_replace(line, '^\|+|\|+$', '', 'g'), '|'), lambda y: trim(y)) as cells, count(*) over (partition by doc_id) as n from g where i >= first and (stop is null or i < stop)),
 c as (select *, k = 1 and len(list_filter(cells, lambda y: not regexp_matches(y, '^:?-{{3,}}:?$'))) = 0 as dashes from b where n >= 2),
 r as (select doc_id, row_number() over (partition by doc_id order by k) - 1 as row_idx, cells from c where not dashes)
 select doc_id, row_idx, unnest(cells) as text, generate_subscripts(cells, 1) - 1 as col_idx from r"""


@_query(_MARKDOWN_SQL)
def markdown_tables(spark, sf_dir) -> DataFrame:
    """Cells of markdown tables."""
    return markup_tables.markdown_tables(given(spark, sf_dir, fixtures.OVER.MARKDOWN))


@_query()
def json_tables(spark, sf_dir) -> DataFrame:
    """Cells of JSON table documents."""
    return markup_tables.json_tables(given(spark, sf_dir, fixtures.OVER.JSON))


# --- the registry


def _reports(spark, sf_dir) -> DataFrame:
    name = F.concat(F.lit("report-"), "doc_id", F.lit(".pdf"))
    return table(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("company"), name.alias("file_name"), F.concat("source", F.lit("/"), name).alias("source_path"), F.sha2(F.col("text").cast("binary"), 256).alias("sha256"))


_REPORTS_SQL = "reports as (select doc_id, source as company, 'report-' || doc_id || '.pdf' as file_name, source || '/report-' || doc_id || '.pdf' as source_path, sha256(text) as sha256 from documents)"


@_query(f"with {_REPORTS_SQL} select * from reports where sha256 not in (select sha256 from reports where doc_id % 3 = 0)")
def unprocessed_reports(spark, sf_dir) -> DataFrame:
    """Reports whose content no processed report has (a third of them has been processed)."""
    r = _reports(spark, sf_dir)
    return registry.unprocessed(r, r.where("doc_id % 3 = 0")).select(*r.columns)


@_query(f"with {_REPORTS_SQL}, names as (select 'report-' || (c_custkey * 5) || '.pdf' as name from customer union all select 'src1/report-' || c_custkey || '.pdf' from customer) select * from reports where file_name in (select name from names) or source_path in (select name from names)")
def explicit_reports(spark, sf_dir) -> DataFrame:
    """Reports that are named by path or file, processed or not."""
    c = table(spark, sf_dir, "customer")
    names = c.select(F.concat(F.lit("report-"), (F.col("c_custkey") * 5).cast("string"), F.lit(".pdf")).alias("name")).unionByName(c.select(F.concat(F.lit("src1/report-"), F.col("c_custkey").cast("string"), F.lit(".pdf")).alias("name")))
    return registry.chosen(_reports(spark, sf_dir), names)


_NEW_SQL = "fresh as (select doc_id, company, file_name, source_path, case when doc_id % 2 = 0 then sha256 else sha256(sha256) end as sha256 from reports where doc_id % 5 = 0)"


@_query(f"""with {_REPORTS_SQL}, {_NEW_SQL} select * from reports r where source_path not in (select source_path from fresh) and sha256 not in (select sha256 from fresh) union all select * from fresh""")
def registry_upsert(spark, sf_dir) -> DataFrame:
    """New records replace those of the same path or content."""
    r = _reports(spark, sf_dir)
    new = r.where("doc_id % 5 = 0").withColumn("sha256", F.when(F.col("doc_id") % 2 == 0, F.col("sha256")).otherwise(F.sha2(F.col("sha256").cast("binary"), 256)))
    return registry.upsert(r, new)


@_query(f"with {_REPORTS_SQL}, done as (select company, count(*) as n from reports where doc_id % 3 = 0 group by 1), r as (select company, count(*) as n from reports group by 1) select company, r.n as n_reports, coalesce(done.n, 0) as n_processed, greatest(r.n - coalesce(done.n, 0), 0) as n_pending from r left join done using (company)")
def company_dashboard(spark, sf_dir) -> DataFrame:
    """Reports, records and pending reports by company."""
    r = _reports(spark, sf_dir)
    return registry.dashboard(r, r.where("doc_id % 3 = 0"))


# --- per-report outputs

_NAMES = "case statement_type when 'balance_sheet' then 'Balance Sheet' when 'income_statement' then 'Income Statement' when 'cash_flow' then 'Cash Flow Statement' else statement_type end"


@_query(rf"""select doc_id, position, statement_type, substr(regexp_replace({_NAMES} || case when count(*) over w > 1 then ' ' || lpad(row_number() over (w order by position)::varchar, 2, '0') else '' end, '[\[\]:*?/\\]', '_', 'g'), 1, 31) as sheet
 from {fixtures.OVER.RESULTS} window w as (partition by doc_id, statement_type)""")
def sheet_names(spark, sf_dir) -> DataFrame:
    """Sheet names of a report's results."""
    return reports.sheet_names(given(spark, sf_dir, fixtures.OVER.RESULTS)).select("doc_id", "position", "statement_type", "sheet")


@_query(f"""select c.doc_id, c.statement_type, page_start || '-' || page_end as pages, title, coalesce(string_agg(message, '; ' order by seq), '') as warnings
 from {fixtures.OVER.RESULTS.sql("c")} left join {fixtures.OVER.WARNINGS.sql("w")} on c.doc_id = w.doc_id and c.statement_type = w.statement_type group by all""")
def lineage_record(spark, sf_dir) -> DataFrame:
    """The extraction record of each result."""
    return reports.lineage(given(spark, sf_dir, fixtures.OVER.RESULTS), given(spark, sf_dir, fixtures.OVER.WARNINGS))


@_query(f"""with p as (select * from {fixtures.OVER.REPORT_PAGES}), t as (select doc_id, string_agg(text, chr(10) order by page_number) filter (page_number <= 40) as t, string_agg(text, chr(10) order by page_number) filter (page_number <= 12) as c,
  count(*) as page_count, count(*) filter (has_embedded_text) as embedded_text_pages from p group by 1)
 select doc_id, case when regexp_matches(c, '(?i)annual report') then 'annual' else 'quarterly/interim_or_unknown' end as report_type, regexp_extract(t, '{reports.PERIOD_END}', 1) as period_end, regexp_extract(t, '{reports.AS_AT}', 1) as as_at_date,
 regexp_extract(t, '{reports.CURRENCY}', 1) as currency, regexp_extract(t, '{reports.UNIT}', 0) as unit, page_count, embedded_text_pages from t""")
def report_metadata(spark, sf_dir) -> DataFrame:
    """Report type, dates, currency and unit from a report's first pages."""
    return reports.metadata(given(spark, sf_dir, fixtures.OVER.REPORT_PAGES))


@_query(r"""select path, case when regexp_matches(path, '(^|/)companies/[^/]+') then regexp_extract(path, '(?:^|/)companies/([^/]+)', 1) else regexp_replace(regexp_extract(path, '([^/]*)$', 1), '(.)\.[^.]*$', '\1') end as company from """ + str(fixtures.OVER.PATHS))
def company_from_path(spark, sf_dir) -> DataFrame:
    """Companies from paths."""
    return given(spark, sf_dir, fixtures.OVER.PATHS).select("path", reports.company_of(F.col("path")).alias("company"))


@_query(f"""with c as (select company, case when current is not null and not json_valid(current) then '{{}}' when trim(current) like '{{%' then current when trim(legacy) like '{{%' then legacy else '{{}}' end as j from {fixtures.OVER.CONFIGS}),
 k as (select company, unnest(json_keys(j, '$.statement_keywords')) as statement_type, j from c),
 w as (select company, statement_type, unnest(from_json(json_extract(j, '$.statement_keywords.' || statement_type), '["VARCHAR"]')) as keyword from k)
 select * from w where trim(keyword) <> ''""")
def keyword_config(spark, sf_dir) -> DataFrame:
    """Locator keywords from configuration files, current or legacy."""
    return reports.keywords(reports.configurations(given(spark, sf_dir, fixtures.OVER.CONFIGS)))


@_query(f"""with r as (select * from {fixtures.OVER.RESULTS}), m as (select *, contains(lower(title), 'comprehensive income') and statement_type = 'income_statement' and lag(statement_type) over w = 'income_statement'
  and page_start <= max(page_end) over (partition by doc_id order by position rows between unbounded preceding and 1 preceding) + 2 as fold from r window w as (partition by doc_id order by position)),
 g as (select *, sum(case when coalesce(fold, false) then 0 else 1 end) over (partition by doc_id order by position) as kept from m)
 select doc_id, kept, arg_min(title, position) as title, min(page_start) as page_start, max(page_end) as page_end, count(*) as n from g group by doc_id, kept""")
def comprehensive_income_fold(spark, sf_dir) -> DataFrame:
    """Comprehensive income folded into income statements."""
    return reports.fold_comprehensive(given(spark, sf_dir, fixtures.OVER.RESULTS))


@_query(rf"""with l as (select id, line, regexp_replace(lower(trim(line)), '\s+', ' ', 'g') as low, 'consolidated income statements' as want from {fixtures.OVER.LINES}),
 r as (select *, regexp_replace(case when starts_with(low, want) then substr(low, length(want) + 1) else low end, '^[ :\-–—]+|[ :\-–—]+$', '', 'g') as rest,
   regexp_replace(regexp_replace(low, '\s*,?\s*continued$', ''), '^(interim\s+)?(condensed\s+)?', '') as before from l)
 select id, line, low = want or before = want or rest = '' or regexp_matches(rest, '^(as at|as of|for the years? ended|for the periods? ended).+$') as heading from r""")
def heading_tests(spark, sf_dir) -> DataFrame:
    """Which lines are headings of their own."""
    return given(spark, sf_dir, fixtures.OVER.LINES).withColumn("heading", labels.stands_alone(F.col("line"), F.lit("Consolidated income statements")))


@_query(_FACTS_SQL + """, shown as (select company, sheet, label, key, max(value) filter (period = '2008') as a, max(value) filter (period = '2009') as b from merged join named using (company, sheet, key) group by all)
 select company, sheet, label, key, a is null and b is null as is_section, regexp_matches(lower(trim(label)), '^(total |net |gross profit|operating profit|profit for|profit before|cash and cash equivalents at end)') as is_total from shown""")
def master_sheet_layout(spark, sf_dir) -> DataFrame:
    """Row classes of merged sheets as they are laid out."""
    laid = merge.wide(merge.merged(merge.facts(statements(spark, sf_dir))), ["2008", "2009"], strict=False)
    rows = laid.select("company", "sheet", "label", "key", F.array(*[F.coalesce(F.col(f"y{y}").cast("string"), F.lit("")) for y in (2008, 2009)]).alias("cells"))
    return reports.row_classes(rows).drop("cells")


@_query("""with s as (select doc_id, source, n_chars from documents), m as (select *, max(n_chars) over (partition by source order by doc_id rows between unbounded preceding and 1 preceding) as before from s)
 select source, count(*) as n_runs from m where before is null or n_chars > before group by source""")
def running_records(spark, sf_dir) -> DataFrame:
    """Gaps and islands over documents: how often each source has a new longest document."""
    order = W.partitionBy("source").orderBy("doc_id").rowsBetween(W.unboundedPreceding, -1)
    marked = table(spark, sf_dir, "documents").withColumn("before", F.max("n_chars").over(order))
    return marked.where("before IS NULL OR n_chars > before").groupBy("source").agg(F.count("*").alias("n_runs"))
