"""Statement-shaped tables from the order star schema, and fixture tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

SHEETS = {"A": "Balance Sheet", "N": "Income Statement", "R": "Cash Flow Statement"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def values(spark: SparkSession, rows: str) -> DataFrame:
    """A fixture: the text of a VALUES relation that both engines read."""
    return spark.sql(f"SELECT * FROM {rows}")


def given(spark: SparkSession, sf_dir: str, relation) -> DataFrame:
    """A relation of cases over the documents of sf_dir (fixtures.Given)."""
    return spark.sql("SELECT * FROM " + str(relation).replace("from documents)", f"from parquet.`{sf_dir}/documents.parquet`)"))


def shown(v):
    """An amount as a report prints it: thousands separators, parentheses for negative."""
    whole = F.format_number(F.abs(F.round(v, 0)), 0)
    return F.when(v < 0, F.concat(F.lit("("), whole, F.lit(")"))).otherwise(whole)


def sales(spark: SparkSession, sf_dir: str, quarterly: bool = False) -> DataFrame:
    """company, sheet, item, year (and quarter) and the sum of sales, one row each; only this much leaves the big join."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_returnflag", (F.col("l_extendedprice") * (1 - F.col("l_discount"))).cast("decimal(18,4)").alias("v"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", (F.year("o_orderdate") + 10).alias("year"), F.quarter("o_orderdate").alias("quarter"))
    customers = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_mktsegment").alias("company"))
    parts = table(spark, sf_dir, "part").select("p_partkey", F.col("p_type").alias("item"))
    joined = lines.join(orders, lines.l_orderkey == orders.o_orderkey).join(customers, F.col("o_custkey") == F.col("c_custkey")).join(parts, F.col("l_partkey") == F.col("p_partkey"))
    keys = ["company", "l_returnflag", "item", "year", *(["quarter"] if quarterly else [])]
    summed = joined.groupBy(*keys).agg(F.sum("v").cast("decimal(28,4)").alias("v"))
    sheet = F.element_at(F.create_map(*[F.lit(x) for p in SHEETS.items() for x in p]), F.col("l_returnflag"))
    return summed.withColumn("sheet", sheet).withColumn("v", F.when(F.col("l_returnflag") == "R", -F.col("v")).otherwise(F.col("v"))).drop("l_returnflag")


def statements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Annual reports: the one of a year shows that year, and the year before restated by one percent.

    Odd years write the labels in another way; the comparative of item STANDARD is blank, as an erased amount.
    Rows are in the order of their items, read backwards.
    """
    # each amount is shown twice, in its own year's report and in the next one
    both = sales(spark, sf_dir).withColumn("later", F.explode(F.array(F.lit(0), F.lit(1)))).withColumn("workbook", F.col("year") + F.col("later"))
    both = both.withColumn("v", F.when(F.col("later") == 1, (F.col("v") * F.lit("1.01").cast("decimal(3,2)")).cast("decimal(28,4)")).otherwise(F.col("v")))
    both = both.withColumn("row_idx", F.dense_rank().over(W.partitionBy("company", "workbook", "sheet").orderBy(F.reverse("item"))))
    label = F.when(F.col("workbook") % 2 == 1, F.concat("item", F.lit(" & other (net)"))).otherwise(F.concat("item", F.lit(" and other")))
    blank = (F.col("year") < F.col("workbook")) & F.col("item").startswith("STANDARD")
    return both.select(
        "company", "workbook", "sheet", "row_idx", label.alias("label"), F.col("year").cast("string").alias("period"), F.when(blank, F.lit("")).otherwise(shown(F.col("v"))).alias("raw_text")
    )


#: The same reports in DuckDB.
STATEMENTS_SQL = """
sales as (
  select c_mktsegment as company, l_returnflag, p_type as item, year(o_orderdate) + 10 as year, quarter(o_orderdate) as quarter,
    cast(l_extendedprice * (1 - l_discount) as decimal(18,4)) as v
  from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey join part on l_partkey = p_partkey),
base as (
  select company, case l_returnflag when 'A' then 'Balance Sheet' when 'N' then 'Income Statement' else 'Cash Flow Statement' end as sheet,
    item, year, case when l_returnflag = 'R' then -sum(v) else sum(v) end::decimal(28,4) as v
  from sales group by company, l_returnflag, item, year),
both_years as (
  select *, year as workbook from base
  union all select company, sheet, item, year, cast(v * 1.01::decimal(3,2) as decimal(28,4)), year + 1 from base),
statements as (
  select company, workbook, sheet, dense_rank() over (partition by company, workbook, sheet order by reverse(item)) as row_idx, item || case when workbook % 2 = 1 then ' & other (net)' else ' and other' end as label, year::varchar as period,
    case when year < workbook and item like 'STANDARD%' then ''
      when v < 0 then '(' || format('{:,}', cast(abs(round(v, 0)) as bigint)) || ')' else format('{:,}', cast(abs(round(v, 0)) as bigint)) end as raw_text
  from both_years)"""

# --- the reports' pages

#: The titles of the sheets' pages and the words under them.
PAGE_TITLES = {"Balance Sheet": "Consolidated statements of financial position", "Income Statement": "Consolidated statements of comprehensive income", "Cash Flow Statement": "Consolidated statements of cash flows"}
UNIT_LINE, PERIOD_LINE = "(US dollars in thousands)", "Years ended December 31"


def page_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, page_number, n, label, amounts (latest year first) and years: each report's sheets as printed pages, rows by label,
    a dash for what is not there."""
    cells = statements(spark, sf_dir)
    by = ["company", "workbook", "sheet"]
    shown = cells.groupBy(*by).agg(F.sort_array(F.collect_set("period"), False).alias("years"))
    rows = cells.groupBy(*by, "label").agg(F.map_from_entries(F.collect_list(F.struct("period", "raw_text"))).alias("found")).join(shown, by)
    amounts = F.transform("years", lambda y: F.coalesce(F.nullif(F.try_element_at("found", y), F.lit("")), F.lit("-")))
    n = F.row_number().over(W.partitionBy(*by).orderBy("label"))
    page = F.array_position(F.array(*map(F.lit, PAGE_TITLES)), F.col("sheet")).cast("int")
    return rows.select(F.concat_ws("/", "company", "workbook").alias("doc_id"), page.alias("page_number"), n.alias("n"), "label", amounts.alias("amounts"), "years")


def _lines(rows: DataFrame) -> DataFrame:
    """The lines of page_rows' pages as arrays of (text, middle of its place, or null for words that follow each other from the left)."""
    place = lambda texts: F.transform(texts, lambda t, i: F.struct(t.alias("text"), (430 + 100 * i).cast("double").alias("middle")))
    free = lambda text: F.transform(F.split(text, " "), lambda t: F.struct(t.alias("text"), F.lit(None).cast("double").alias("middle")))
    titles = F.element_at(F.array(*map(F.lit, PAGE_TITLES.values())), F.col("page_number"))
    heads = rows.where("n = 1").select("doc_id", "page_number", F.posexplode(F.array(free(titles), free(F.lit(UNIT_LINE)), F.concat(F.array(F.struct(F.lit("Notes").alias("text"), F.lit(330.0).alias("middle"))), place(F.col("years"))))).alias("line", "words"))
    body = rows.select("doc_id", "page_number", (F.col("n") + 2).alias("line"), F.concat(free(F.col("label")), place(F.col("amounts"))).alias("words"))
    return heads.unionByName(body)


def page_words(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The words of the reports' pages (doc_id, page_number, x0, y0, x1, text) and the pages' sizes (doc_id, page_number, height)."""
    lines = _lines(page_rows(spark, sf_dir))
    before = F.aggregate(F.slice("words", F.lit(1), F.col("at")), F.lit(50.0), lambda x, w: x + 6 * (F.length(w["text"]) + 1))
    each = lines.select("doc_id", "page_number", "line", "words", F.posexplode("words").alias("at", "w")).withColumn("x0", F.coalesce(F.col("w.middle") - 3 * F.length("w.text"), before))
    y = (60 + 20 * F.col("line")).cast("double")
    words = each.select("doc_id", "page_number", "x0", y.alias("y0"), (F.col("x0") + 6 * F.length("w.text")).alias("x1"), F.col("w.text").alias("text"))
    sizes = lines.groupBy("doc_id", "page_number").agg((F.max("line") * 20 + 200).cast("double").alias("height"))
    return words, sizes


#: page_rows in DuckDB, as lists of cells.
PAGE_ROWS_SQL = f"""{STATEMENTS_SQL},
years as (select company, workbook, sheet, list_sort(list(distinct period), 'desc') as years from statements group by all),
items as (select company, workbook, sheet, label, map_from_entries(list((period, raw_text))) as found from statements group by all),
page_rows as (select company || '/' || workbook as doc_id, case sheet when 'Balance Sheet' then 1 when 'Income Statement' then 2 else 3 end as page_number,
  row_number() over (partition by company, workbook, sheet order by label) as n, label, years, list_transform(years, lambda y: coalesce(nullif(found[y], ''), '-')) as amounts from items join years using (company, workbook, sheet))"""
