"""Where merged amounts come from, where reports contradict each other, and what a person should look at.

A version is one report's reading of one cell of a merged statement; merging keeps the latest, these tables keep them all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerloom.functions import labels, numbers, periods
from ledgerloom.operators import merge

CELL = ["company", "sheet", "key", "position", "period"]
WARNING = ["company", "source", "severity", "statement", "period", "page_number", "issue_type", "description", "suggested_action"]


def versions(cells: DataFrame, threshold: float = merge.THRESHOLD, order: str = "first") -> DataFrame:
    """CELL, seq, workbook, label, raw_text, value, row_idx and page_number of every reading; cells: merge.facts(), with the
    page_number and row_idx of each cell if they are known.

    A report that shows a cell twice (two of its rows in one master row) has one version of it, that of the lower row.
    """
    page = F.col("page_number") if "page_number" in cells.columns else F.lit(None)
    rows = merge.with_rows(merge.in_order(cells.withColumn("page_number", page.cast("int"))), threshold, order)
    read = F.struct("row_idx", "page_number", "label", "raw_text")
    one = rows.groupBy(*CELL, "seq", F.col("workbook").cast("string").alias("workbook")).agg(F.max(read).alias("read"))
    return one.select(*CELL, "seq", "workbook", "read.label", "read.raw_text", numbers.amount(F.col("read.raw_text")).alias("value"), "read.row_idx", "read.page_number")


def sources(found: DataFrame) -> DataFrame:
    """CELL, value, workbook, page_number, row_idx and n_versions: the report, page and row that each merged amount is from."""
    last = F.max_by(F.struct("value", "workbook", "page_number", "row_idx"), "seq")
    return found.groupBy(*CELL).agg(last.alias("last"), F.count("*").alias("n_versions")).select(*CELL, "last.*", "n_versions")


def conflicts(found: DataFrame) -> DataFrame:
    """The amounts that contradict the one that the merged statement had: CELL, seq, workbook, existing, value, page_number and
    column, the name of the column that shows it.

    What a cell had is the amount of the first report that has one; equal amounts and blanks contradict nothing.
    """
    held = F.first("value", ignorenulls=True).over(W.partitionBy(*CELL).orderBy("seq").rowsBetween(W.unboundedPreceding, -1))
    against = found.withColumn("existing", held).where("existing IS NOT NULL AND value IS NOT NULL AND value <> existing")
    return against.select(*CELL, "seq", "workbook", "existing", "value", "page_number", labels.conflict_column(F.col("period"), F.col("workbook")).alias("column"))


def with_conflict_columns(found: DataFrame) -> DataFrame:
    """company, sheet, key, position, column, place and value: each statement with what its cells had first, and right of
    each period one column for every report that contradicts it, in the order of reports."""
    first = found.groupBy(*CELL).agg(F.min_by("value", F.when(F.col("value").isNotNull(), F.col("seq"))).alias("value"))
    kept = first.select(*CELL, F.col("period").alias("column"), F.lit(0).alias("seq"), "value")
    added = conflicts(found).select(*CELL, "column", "seq", "value")
    every = kept.unionByName(added)
    shown = merge.ordered_periods(found.select("company", "sheet", "period")).withColumnRenamed("place", "period_place")
    columns = every.select("company", "sheet", "period", "column", "seq").distinct().join(shown, ["company", "sheet", "period"])
    place = F.row_number().over(W.partitionBy("company", "sheet").orderBy("period_place", "seq", "column"))
    placed = columns.select("company", "sheet", "period", "column", "seq", place.alias("place"))
    return every.join(placed, ["company", "sheet", "period", "column", "seq"]).select("company", "sheet", "key", "position", "column", "place", "value")


def tracked(reports: DataFrame, results: DataFrame) -> DataFrame:
    """One row per statement of a report: company, source, report_type, year, quarter, statement, pages, ocr_used, warnings.

    reports: company, workbook (its file), latest (merge.reports_in_order); results: company, workbook, sheet, page_start,
    page_end, method, warnings (array).  A report whose latest period is a quarter is quarterly.
    """
    quarter = F.col("latest")["quarter"]
    kind = F.when(F.coalesce(quarter, F.lit(0)) > 0, "Quarterly").when(F.col("latest")["year"].isNotNull(), "Annual")
    joined = results.join(reports, ["company", "workbook"], "left")
    return joined.select(
        "company", F.col("workbook").cast("string").alias("source"), kind.alias("report_type"), F.col("latest")["year"].alias("year"), F.nullif(quarter, F.lit(0)).alias("quarter"),
        F.col("sheet").alias("statement"), F.concat_ws("-", "page_start", "page_end").alias("pages"), F.col("method").contains("ocr").alias("ocr_used"), F.array_join("warnings", "; ").alias("warnings"),
    )


def _warning(df: DataFrame, severity: str, issue: str, description: Column, action: str, **more: Column) -> DataFrame:
    """df's rows as warnings; more: the columns that the kind of warning knows."""
    told = {"severity": F.lit(severity), "issue_type": F.lit(issue), "description": description, "suggested_action": F.lit(action), "company": F.col("company"), **more}
    kinds = {"page_number": "int"}
    return df.select(*[told.get(c, F.lit(None)).cast(kinds.get(c, "string")).alias(c) for c in WARNING])


def warnings(found: DataFrame, statements: DataFrame | None = None, issues: DataFrame | None = None, wanted: tuple[str, ...] = ()) -> DataFrame:
    """WARNING rows: conflicts between versions, periods that a statement of a report shows twice, recognised pages and warnings of
    extraction (statements: tracked()), wanted statements that a report lacks, and failed checks (issues: company, workbook, sheet, rule).
    """
    shown = F.concat_ws(" ", F.lit("has"), F.col("value").cast("string"), F.lit("where"), F.col("existing").cast("string"), F.lit("was:"), F.col("key"))
    out = _warning(conflicts(found), "Warning", "conflict", shown, "compare the reports", source=F.col("workbook"), statement=F.col("sheet"), period=F.col("period"), page_number=F.col("page_number"))
    twice = found.select("company", "sheet", "workbook", "seq", "period").distinct().withColumn("at", periods.sort_key(periods.parse(F.col("period"))))
    twice = twice.where("at.year IS NOT NULL").groupBy("company", "sheet", "workbook", "at").agg(F.count("*").alias("n"), F.array_join(F.array_sort(F.collect_list("period")), ", ").alias("period")).where("n > 1")
    out = out.unionByName(_warning(twice, "Info", "duplicate period", F.col("period"), "check the columns", source=F.col("workbook"), statement=F.col("sheet"), period=F.col("period")))
    if statements is not None:
        kept = {"source": F.col("source"), "statement": F.col("statement")}
        out = out.unionByName(_warning(statements.where("ocr_used"), "Info", "recognised", F.lit("read by recognition"), "compare with the page", **kept))
        out = out.unionByName(_warning(statements.where("warnings <> ''"), "Warning", "extraction", F.col("warnings"), "compare with the page", **kept))
        have = statements.groupBy("company", "source").agg(F.collect_set("statement").alias("have"))
        lacking = have.select("company", "source", F.explode(F.array_except(F.array(*map(F.lit, wanted)).cast("array<string>"), "have")).alias("statement"))
        out = out.unionByName(_warning(lacking, "Critical", "statement not found", F.col("statement"), "look for it in the report", **kept))
    if issues is not None:
        failed = _warning(issues, "Critical", "validation failure", F.col("rule"), "check the amounts", source=F.col("workbook").cast("string"), statement=F.col("sheet"))
        out = out.unionByName(failed)
    return out
