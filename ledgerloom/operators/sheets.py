"""Statement sheets (long cells) to facts: header row, period columns, labels and values."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerloom.functions import labels, numbers, periods

HEADER_ROWS, VALUE_ROWS = 12, 25
UNIT_WORDS = ("note", "notes", "$m", "$000", "$", "m")
_TITLE = r"\bconsolidated\s+(statements?\s+of\s+|(income|cash\s+flow|balance\s+sheet)s?\b)|\binterim\s+condensed\s+consolidated\b"


def header_cells(cells: DataFrame) -> DataFrame:
    """Period cells of each sheet's header: the row of the first twelve with most period columns, the earliest of equals.

    cells: doc_id, row_idx, col_idx (from 1), raw_text.
    """
    text = numbers.strip(F.coalesce("raw_text", F.lit("")))
    some = cells.withColumn("text", text).where("text <> ''")
    rows = some.where(F.col("row_idx") <= HEADER_ROWS).groupBy("doc_id", "row_idx").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("col_idx", "text"))), lambda x: x["text"]), " ").alias("line"))
    above = W.partitionBy("doc_id").orderBy("row_idx").rangeBetween(-2, 0)
    context = rows.select("doc_id", "row_idx", F.array_join(F.collect_list("line").over(above), " ").alias("context"))
    heads = some.where(F.col("row_idx") <= HEADER_ROWS).join(context, ["doc_id", "row_idx"]).withColumn("p", periods.in_context(F.col("text"), F.col("context"))).where("p IS NOT NULL")
    below = some.select("doc_id", F.col("col_idx"), F.col("row_idx").alias("r"), numbers.sheet_numeric(F.col("text")).alias("numeric"))
    judged = heads.join(below, ["doc_id", "col_idx"]).where((F.col("r") > F.col("row_idx")) & (F.col("r") <= F.col("row_idx") + VALUE_ROWS))
    good = judged.groupBy("doc_id", "row_idx", "col_idx", "text", "p").agg(F.count_if("numeric").alias("n"), F.count_if(~F.col("numeric")).alias("t")).where("n > 0 AND n >= t")
    counted = good.withColumn("wide", F.count("*").over(W.partitionBy("doc_id", "row_idx")))
    best = counted.withColumn("k", F.dense_rank().over(W.partitionBy("doc_id").orderBy(F.desc("wide"), "row_idx")))
    return best.where("k = 1").select("doc_id", "row_idx", "col_idx", "p")


def with_entities(cells: DataFrame, heads: DataFrame) -> DataFrame:
    """heads with the nearest entity name above put before labels that occur twice: same column first, then leftwards."""
    text = numbers.strip(F.coalesce("raw_text", F.lit("")))
    low = F.regexp_replace(F.lower(text), f"{numbers.SPACE}+", " ")
    period_words = low.rlike(r"\bfor\s+(each\s+of\s+)?the\b") & low.rlike(r"\b(three|six|nine|twelve)[-\s]months?\b") & low.rlike(r"\bperiods?\b")
    entity = text.rlike("[A-Za-z]") & periods.parse(text).isNull() & ~low.rlike(_TITLE) & ~period_words & ~low.isin(*UNIT_WORDS) & ~numbers.sheet_numeric(text)
    names = cells.where(entity).select("doc_id", F.col("row_idx").alias("r"), F.col("col_idx").alias("c"), text.alias("entity"))
    twice = heads.withColumn("copies", F.count("*").over(W.partitionBy("doc_id", "p.label"))).withColumn("twice", F.max(F.col("copies") > 1).over(W.partitionBy("doc_id")))
    above = twice.join(names, "doc_id", "left").where(F.col("r").isNull() | ((F.col("r") < F.col("row_idx")) & (F.col("c") <= F.col("col_idx"))))
    nearest = above.groupBy("doc_id", "col_idx").agg(F.max_by("entity", F.struct("r", "c")).alias("entity"))
    named = twice.join(nearest, ["doc_id", "col_idx"], "left")
    label = F.when(F.col("twice") & F.col("entity").isNotNull(), F.concat("entity", F.lit(" "), F.col("p.label"))).otherwise(F.col("p.label"))
    return named.select("doc_id", "row_idx", "col_idx", "p", label.alias("label"))


def facts(cells: DataFrame) -> DataFrame:
    """doc_id, row_idx, label, key, period and raw_text: the first value of a period in each labelled row below the header."""
    heads = with_entities(cells, header_cells(cells))
    bounds = heads.groupBy("doc_id").agg(F.min("row_idx").alias("header"), F.min("col_idx").alias("first"))
    text = numbers.strip(F.coalesce("raw_text", F.lit("")))
    body = cells.withColumn("text", text).join(bounds, "doc_id").where("row_idx > header")
    period_cols = heads.select("doc_id", "col_idx", F.col("label").alias("period"))
    marked = body.join(period_cols, ["doc_id", "col_idx"], "left")
    unit = F.lower("text").isin("$m", "$000", "$", "m")
    rows = marked.groupBy("doc_id", "row_idx").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.when((F.col("col_idx") < F.col("first")) & (F.col("text") != "") & ~labels.is_note(F.col("text")), F.struct("col_idx", "text")))), lambda x: x["text"]), " ").alias("label"),
        (F.bool_and((F.col("text") == "") | F.lower("text").isin(*UNIT_WORDS)) & F.bool_or(unit & F.col("period").isNotNull())).alias("is_unit"),
    )
    kept = rows.where("NOT is_unit AND label <> ''").withColumn("base", labels.item_key(F.col("label"))).where("base <> ''")
    nth = F.row_number().over(W.partitionBy("doc_id", "base").orderBy("row_idx"))
    keyed = kept.select("doc_id", "row_idx", "label", F.concat("base", F.lit("#"), nth).alias("key"))
    one = marked.where("period IS NOT NULL").groupBy("doc_id", "row_idx", "period").agg(F.min_by("raw_text", "col_idx").alias("raw_text"))
    return keyed.join(one, ["doc_id", "row_idx"])
