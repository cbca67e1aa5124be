"""Accounting identities over statement tables (long cells), as a table of rules."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerloom.functions import labels, numbers

AMOUNT = "decimal(28,8)"
TOLERANCE = 1

# Which label plays which role, by statement type.
_ACTIVITY = "^net cash (provided by|used in) {} activities$"
ROLES = {
    "balance_sheet": {
        "assets": "^total assets$",
        "liabilities": "^total liabilities$",
        "equity": "^total equity$",
        "both": "^total liabilities and equity$",
        "current assets": "^total current assets$",
        "fixed assets": "^total non-current assets$",
        "current liabilities": "^total current liabilities$",
        "fixed liabilities": "^total non-current liabilities$",
    },
    "income_statement": {"revenue": "^(revenue|sales)$", "cost": "^cost of sales$", "gross": "^gross profit$"},
    "cash_flow": {
        "operating": _ACTIVITY.format("operating"),
        "investing": _ACTIVITY.format("investing"),
        "financing": _ACTIVITY.format("financing"),
        "exchange": "^effect of exchange rate",
        "change": "^net (increase|decrease) in cash",
        "opening": "^cash and cash equivalents at beginning",
        "held": "^changes in cash classified as assets held for sale$",
        "closing": "^cash and cash equivalents at end",
    },
}
#: rule: (statement, reported role, addend roles, roles that count where the statement has them)
SUMS = {
    "RC1": ("balance_sheet", "assets", ("both",), ()),
    "RC2": ("balance_sheet", "assets", ("liabilities", "equity"), ()),
    "RC3": ("balance_sheet", "assets", ("current assets", "fixed assets"), ()),
    "RC4": ("balance_sheet", "liabilities", ("current liabilities", "fixed liabilities"), ()),
    "RC9": ("cash_flow", "change", ("operating", "investing", "financing"), ("exchange",)),
    "RC10": ("cash_flow", "closing", ("opening", "change"), ("held",)),
}
SECTIONS = {"RC6": "operating", "RC7": "investing", "RC8": "financing"}
_NOT_ITEMS = r"^(continue$|cash flows from |net cash |cash and cash equivalents |net increase|net decrease)"


def labelled(cells: DataFrame) -> DataFrame:
    """Value cells with their row's label; cells: doc_id, statement_type, row_idx, col_idx (from 0), raw_text."""
    first = cells.where("col_idx = 0").select("doc_id", "statement_type", "row_idx", labels.checked_label(F.coalesce("raw_text", F.lit(""))).alias("label"))
    return cells.where("col_idx > 0").join(first, ["doc_id", "statement_type", "row_idx"]).withColumn("value", numbers.checked_amount(F.col("raw_text")))


def role_values(cells: DataFrame) -> DataFrame:
    """doc_id, statement_type, role, row_idx, col_idx, value: of each role, the first row whose label matches."""
    role = F.array_compact(F.array(*[F.when((F.col("statement_type") == s) & F.col("label").rlike(p), F.lit(r)) for s, roles in ROLES.items() for r, p in roles.items()]))
    found = labelled(cells).withColumn("role", F.explode(role))
    ranked = found.withColumn("k", F.dense_rank().over(W.partitionBy("doc_id", "statement_type", "role").orderBy("row_idx")))
    return ranked.where("k = 1 AND value IS NOT NULL").select("doc_id", "statement_type", "role", "row_idx", "col_idx", "value")


def issues(cells: DataFrame, tolerance: float = TOLERANCE) -> DataFrame:
    """rule, doc_id, statement_type, col_idx, reported, calculated and difference of every identity that fails."""
    values = role_values(cells)
    each = values.groupBy("doc_id", "statement_type", "col_idx").agg(F.map_from_entries(F.collect_list(F.struct("role", "value"))).alias("v"))
    has = values.groupBy("doc_id", "statement_type").agg(F.collect_set("role").alias("has"))
    each = each.join(has, ["doc_id", "statement_type"])
    v = lambda r: F.try_element_at("v", F.lit(r))
    checks = []
    for rule, (statement, target, addends, optional) in SUMS.items():
        total = v(addends[0])
        for a in addends[1:]:
            total = total + v(a)
        for a in optional:
            total = total + F.when(F.array_contains("has", a), v(a)).otherwise(F.lit(0).cast(AMOUNT))
        checks.append((statement, rule, v(target), total))
    cost = F.when(v("cost") < 0, v("revenue") + v("cost")).otherwise(v("revenue") - v("cost"))
    checks.append(("income_statement", "RC5", v("gross"), cost))
    rows = F.array(*[F.when(F.col("statement_type") == s, F.struct(F.lit(rule).alias("rule"), reported.cast(AMOUNT).alias("reported"), total.cast(AMOUNT).alias("calculated"))) for s, rule, reported, total in checks])
    judged = each.select("doc_id", "statement_type", "col_idx", F.explode(F.array_compact(rows)).alias("c")).select("doc_id", "statement_type", "col_idx", "c.*")
    return _failed(judged.unionByName(sections(cells)), tolerance)


def _failed(judged: DataFrame, tolerance: float) -> DataFrame:
    difference = (F.col("reported") - F.col("calculated")).cast(AMOUNT)
    return judged.withColumn("difference", difference).where(F.abs(F.col("difference")) > F.lit(tolerance))


def _sections(cells: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(items, subtotals) of cash-flow sections, value cells with their rule: the line items between a section's header and
    its subtotal, and the subtotal's cells."""
    names = F.create_map(*[F.lit(x) for rule, name in SECTIONS.items() for x in (name, rule)])
    flows = cells.where("statement_type = 'cash_flow'")
    heads = flows.where("col_idx = 0").select("doc_id", "statement_type", "row_idx", labels.checked_label(F.coalesce("raw_text", F.lit(""))).alias("label"))
    opening = F.regexp_extract("label", "^cash flows from (operating|investing|financing) activities$", 1)
    closing = F.regexp_extract("label", _ACTIVITY.format("(operating|investing|financing)"), 2)
    marked = heads.select("doc_id", "row_idx", opening.alias("opens"), closing.alias("closes"))
    start = marked.where("opens <> ''").groupBy("doc_id", F.col("opens").alias("name")).agg(F.min("row_idx").alias("start"))
    ends = marked.where("closes <> ''").select("doc_id", F.col("closes").alias("name"), F.col("row_idx").alias("end")).join(start, ["doc_id", "name"]).where("end > start")
    bounds = ends.groupBy("doc_id", "name", "start").agg(F.min("end").alias("end"))
    inside = labelled(flows).join(bounds, "doc_id").where("value IS NOT NULL").withColumn("rule", F.element_at(names, F.col("name")))
    items = inside.where((F.col("row_idx") > F.col("start")) & (F.col("row_idx") < F.col("end")) & (F.col("label") != "") & ~F.col("label").rlike(_NOT_ITEMS))
    return items, inside.where("row_idx = end")


def sections(cells: DataFrame) -> DataFrame:
    """Cash-flow sections: the sum of the line items between a section's header and its subtotal, by column."""
    items, subtotals = _sections(cells)
    by = ["doc_id", "statement_type", "col_idx", "rule"]
    totals = items.groupBy(*by).agg(F.sum("value").cast(AMOUNT).alias("calculated"))
    return subtotals.select(*by, F.col("value").cast(AMOUNT).alias("reported")).join(totals, by).select(*by, "reported", "calculated")


def failed_cells(cells: DataFrame, tolerance: float = TOLERANCE) -> DataFrame:
    """The distinct cells (doc_id, statement_type, row_idx, col_idx) that take part in a failed check: those of the roles
    that are summed, and the line items and subtotals of sections."""
    rules = [(r, role) for r, (_, target, addends, optional) in SUMS.items() for role in (target, *addends, *optional)] + [("RC5", r) for r in ("gross", "revenue", "cost")]
    rule_of = F.create_map(*[F.lit(x) if isinstance(x, str) else x for role in {r for _, r in rules} for x in (role, F.array(*[F.lit(q) for q, r in rules if r == role]))])
    by = ["doc_id", "statement_type", "col_idx", "rule"]
    taking = role_values(cells).withColumn("rule", F.explode(F.element_at(rule_of, F.col("role")))).select(*by, "row_idx")
    items, subtotals = _sections(cells)
    every = taking.unionByName(items.select(*by, "row_idx")).unionByName(subtotals.select(*by, "row_idx"))
    return every.join(issues(cells, tolerance).select(*by), by).select("doc_id", "statement_type", "row_idx", "col_idx").distinct()
