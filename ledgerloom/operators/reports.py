"""Per-report outputs: sheet names, lineage, metadata, row classes and company configuration."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerloom.functions import numbers

# Sheet titles, label prefixes of total rows, metadata patterns.
TITLES = {"balance_sheet": "Balance Sheet", "income_statement": "Income Statement", "cash_flow": "Cash Flow Statement"}
TOTALS = r"^(total |net |gross profit|operating profit|profit for|profit before|cash and cash equivalents at end)"
_DAY = r"([0-9]{1,2}\s+[A-Za-z]+\s+[0-9]{4})"
PERIOD_END = rf"(?i)(?:year|period|quarter|three months|six months|nine months)\s+ended\s+{_DAY}"
AS_AT = rf"(?i)as\s+at\s+{_DAY}"
CURRENCY = r"(?i)expressed\s+in\s+([A-Za-z ]+ dollars)"
UNIT = r"(?i)\$ ?(M|000|million|thousand)"
CONFIG = "struct<config_version:int,statement_keywords:map<string,array<string>>,processed_reports:array<struct<file_name:string,source_path:string,sha256:string>>>"


def sheet_names(results: DataFrame) -> DataFrame:
    """results (doc_id, position, statement_type) with sheet: the type's title, numbered where a document repeats it."""
    by = W.partitionBy("doc_id", "statement_type")
    titles = F.create_map(*[F.lit(x) for p in TITLES.items() for x in p])
    base = F.coalesce(F.try_element_at(titles, F.col("statement_type")), F.col("statement_type"))
    nth, many = F.row_number().over(by.orderBy("position")), F.count("*").over(by) > 1
    name = F.when(many, F.concat(base, F.lit(" "), F.lpad(nth.cast("string"), 2, "0"))).otherwise(base)
    return results.withColumn("sheet", F.substr(F.regexp_replace(name, r"[\[\]:*?/\\]", "_"), F.lit(1), F.lit(31)))


def lineage(candidates: DataFrame, warnings: DataFrame) -> DataFrame:
    """One text row per candidate with its pages and its warnings, joined in order by "; "."""
    told = warnings.groupBy("doc_id", "statement_type").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("seq", "message"))), lambda x: x["message"]), "; ").alias("warnings"))
    pages = F.concat_ws("-", "page_start", "page_end")
    return candidates.join(told, ["doc_id", "statement_type"], "left").select("doc_id", "statement_type", pages.alias("pages"), "title", F.coalesce("warnings", F.lit("")).alias("warnings"))


def metadata(pages: DataFrame, sample: int = 40, cover: int = 12) -> DataFrame:
    """What a report says about itself in its first pages; pages: doc_id, page_number, text, has_embedded_text."""
    ordered = lambda n: F.array_join(F.transform(F.filter(F.sort_array(F.collect_list(F.struct("page_number", "text"))), lambda x: x["page_number"] <= n), lambda x: x["text"]), "\n")
    first = pages.where(F.col("page_number") <= sample).groupBy("doc_id").agg(ordered(sample).alias("t"), ordered(cover).alias("c"))
    counts = pages.groupBy("doc_id").agg(F.count("*").alias("page_count"), F.count_if("has_embedded_text").alias("embedded_text_pages"))
    read = first.select(
        "doc_id",
        F.when(F.col("c").rlike("(?i)annual report"), "annual").otherwise("quarterly/interim_or_unknown").alias("report_type"),
        F.regexp_extract("t", PERIOD_END, 1).alias("period_end"), F.regexp_extract("t", AS_AT, 1).alias("as_at_date"), F.regexp_extract("t", CURRENCY, 1).alias("currency"), F.regexp_extract("t", UNIT, 0).alias("unit"),
    )
    return read.join(counts, "doc_id")


def company_of(path: Column) -> Column:
    """The folder after companies/ in a path, else the file's name without its ending."""
    folder = F.regexp_extract(path, "(?:^|/)companies/([^/]+)(?:/|$)", 1)
    return F.when(folder != "", folder).otherwise(F.regexp_replace(F.substring_index(path, "/", -1), r"(.)\.[^.]*$", "$1"))


def row_classes(rows: DataFrame) -> DataFrame:
    """rows (label, cells) with is_section (a label alone) and is_total."""
    empty = F.forall("cells", lambda x: F.coalesce(x, F.lit("")) == "")
    return rows.withColumn("is_section", (F.coalesce("label", F.lit("")) != "") & empty).withColumn("is_total", F.lower(numbers.strip(F.coalesce("label", F.lit("")))).rlike(TOTALS))


def configurations(files: DataFrame) -> DataFrame:
    """company, statement_keywords and processed_reports; files: company, current, legacy (texts, null where there is none).

    A current file that is no JSON counts as an empty one and hides the legacy file; JSON that is no object does not.
    """
    shape = F.expr("try_parse_json(current)")
    broken = F.col("current").isNotNull() & shape.isNull()
    chosen = F.when(broken, "{}").when(F.trim("current").startswith("{"), F.col("current")).when(F.trim("legacy").startswith("{"), F.col("legacy")).otherwise("{}")
    read = files.select("company", F.from_json(chosen, CONFIG).alias("c"))
    return read.select("company", F.coalesce("c.config_version", F.lit(1)).alias("config_version"), F.coalesce("c.statement_keywords", F.expr("cast(map() as map<string,array<string>>)")).alias("statement_keywords"), F.coalesce("c.processed_reports", F.expr("cast(array() as array<struct<file_name:string,source_path:string,sha256:string>>)")).alias("processed_reports"))


def keywords(configured: DataFrame) -> DataFrame:
    """company, statement_type and keyword, one row each."""
    return configured.select("company", F.explode("statement_keywords").alias("statement_type", "words")).select("company", "statement_type", F.explode("words").alias("keyword")).where(numbers.strip(F.col("keyword")) != "")


def _folded(results: DataFrame) -> DataFrame:
    """results with kept, the number of the result that each counts to."""
    order = W.partitionBy("doc_id").orderBy("position")
    may = F.lower("title").contains("comprehensive income") & (F.col("statement_type") == "income_statement") & (F.lag("statement_type").over(order) == "income_statement")
    reach = F.max("page_end").over(order.rowsBetween(W.unboundedPreceding, -1))
    fold = F.coalesce(may & (F.col("page_start") <= reach + 2), F.lit(False))
    return results.withColumn("kept", F.sum(F.when(fold, 0).otherwise(1)).over(order))


def fold_comprehensive(results: DataFrame) -> DataFrame:
    """Comprehensive-income results fold into the income statement kept before them, if they start within two pages of its
    growing end.  results: doc_id, position, statement_type, title, page_start, page_end."""
    grouped = _folded(results)
    return grouped.groupBy("doc_id", "kept").agg(F.min_by("title", "position").alias("title"), F.min("page_start").alias("page_start"), F.max("page_end").alias("page_end"), F.count("*").alias("n"))


def folded_rows(results: DataFrame, rows: DataFrame) -> DataFrame:
    """doc_id, kept, row_idx (from 0) and cells: the rows of every kept result, those of what folds into it after an empty row.

    rows: doc_id, position, row_idx, cells.  A statement's rows are one run after another, in the order of results.
    """
    place = _folded(results).select("doc_id", "position", "kept", (F.col("position") != F.min("position").over(W.partitionBy("doc_id", "kept"))).alias("later"))
    own = rows.join(place, ["doc_id", "position"]).select("doc_id", "kept", "position", "row_idx", "cells")
    blank = place.where("later").select("doc_id", "kept", "position", F.lit(-1).alias("row_idx"), F.array().cast("array<string>").alias("cells"))
    nth = F.row_number().over(W.partitionBy("doc_id", "kept").orderBy("position", "row_idx")) - 1
    return own.unionByName(blank).select("doc_id", "kept", nth.alias("row_idx"), "cells")


def folded_amounts(results: DataFrame, rows: DataFrame) -> DataFrame:
    """The cells of folded_rows() as text or amounts in millions (rebuild.coerced), under the one scale that the first twelve rows of
    the whole ask for, whatever the header of what was folded in says."""
    from ledgerloom.operators import rebuild

    whole = folded_rows(results, rows).withColumn("doc_id", F.struct("doc_id", "kept"))
    return rebuild.coerced(whole).select("doc_id.doc_id", "doc_id.kept", "row_idx", "col_idx", "text", "value")


#: The columns of an extraction record, in order; fixed values.
RECORD = ("output_workbook", "sheet_name", "statement_type", "source_pdf", "source_pages", "page_start", "page_end", "extraction_method", "title", "score", "warnings")


def extraction_record(results: DataFrame, warnings: DataFrame) -> DataFrame:
    """doc_id, position and RECORD, all as text, null as the empty one: one row for each sheet of a report's workbook.

    results: doc_id, position, output_workbook, source_pdf, statement_type, title, pages (array), method, score; warnings: doc_id, position,
    seq, message.
    """
    told = warnings.groupBy("doc_id", "position").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("seq", "message"))), lambda x: x["message"]), "; ").alias("warnings"))
    named = sheet_names(results).join(told, ["doc_id", "position"], "left")
    made = {
        "sheet_name": F.col("sheet"), "source_pages": F.array_join(F.transform("pages", lambda p: p.cast("string")), ", "), "page_start": F.array_min("pages"), "page_end": F.array_max("pages"),
        "extraction_method": F.col("method"),
    }
    return named.select("doc_id", "position", *[F.coalesce(made.get(c, F.col(c)).cast("string"), F.lit("")).alias(c) for c in RECORD])


#: How a cell's number is shown; fixed values.
WHOLE, FRACTION = '#,##0;(#,##0);"-"', '#,##0.0;(#,##0.0);"-"'


def number_format(value: Column) -> Column:
    """The format of an amount's cell: without places where it is whole; null where there is no amount."""
    return F.when(value.isNull(), None).when(numbers.is_integral(value), WHOLE).otherwise(FRACTION)
