"""Tables put together from page rows: line filters, split labels, continuation pages, recognised pages, coerced cells.

rows: doc_id, page_number, row_idx, cells (array<string>).  A page is the natural bound of every window here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerloom.functions import numbers
from ledgerloom.functions import rows as R
from ledgerloom.operators import headers

# Margins of a page's body, rows that may be a header, numbers that make a page a table.
TOP, BOTTOM, HEADER_TOP, HEADER_SHARE, HEADER_ROWS, LEAST_NUMBERS, LEAST_WIDTH = 45, 30, 180.0, 0.25, 12, 4, 4
NO_ROWS = "No rows extracted from embedded text; OCR fallback likely required."
FEW_NUMBERS = "Low numeric/table density from embedded text; OCR fallback likely required."
RECOGNISED = "mineru_ocr_fallback"


def table_lines(lines: DataFrame) -> DataFrame:
    """lines (doc_id, page_number, line_no, y0, height, words) of each page's body that look like a table's, else all of it.

    A section's name does, a short line of names near the top, and a line of several words with a number or a word of tables.
    """
    text = R.low(F.array_join("words", " "))
    number = F.exists("words", numbers.table_numeric)
    near_top = F.col("y0") <= F.least(F.lit(HEADER_TOP), F.col("height") * HEADER_SHARE)
    names = text.rlike("[a-z]") & R.n_words(text).between(1, 6) & ~number & ~R.says(text, "no head line", "notice", "page number")
    worded = (F.size("words") > 1) & (number | R.says(text, "unit", "period", "table words"))
    body = lines.where((F.col("y0") >= TOP) & (F.col("y0") <= F.col("height") - BOTTOM))
    marked = body.withColumn("fits", R.says(text, "section") | (near_top & names) | worded)
    some = F.max("fits").over(W.partitionBy("doc_id", "page_number"))
    return marked.withColumn("some", some).where("fits OR NOT some").drop("fits", "some")


def without_notices(rows: DataFrame) -> DataFrame:
    """rows without page numbers and the notices under statements."""
    return rows.where(~R.is_notice(F.col("cells")))


def join_labels(rows: DataFrame) -> DataFrame:
    """A row that is a label only is put before the label of the next row, where that has amounts.

    A row with amounts is never a label only, so no row takes part twice.
    """
    order = W.partitionBy("doc_id", "page_number").orderBy("row_idx")
    told = rows.withColumn("told", R.tell(F.col("cells")))
    marked = told.withColumn("alone", F.col("told.label_only")).withColumn("amounts", F.col("told.amounts") > 0)
    near = marked.withColumn("before", F.when(F.lag("alone").over(order), F.get(F.lag("cells").over(order), 0))).withColumn("after", F.lead("amounts").over(order))
    label = numbers.strip(F.concat_ws(" ", "before", F.coalesce(F.get("cells", 0), F.lit(""))))
    whole = F.when(F.col("before").isNotNull() & F.col("amounts"), F.concat(F.array(label), F.slice("cells", F.lit(2), F.greatest(F.size("cells") - 1, F.lit(0))))).otherwise(F.col("cells"))
    return near.where(~(F.col("alone") & F.coalesce("after", F.lit(False)))).select(*[whole.alias(c) if c == "cells" else c for c in rows.columns])


def drop_repeated_headers(rows: DataFrame) -> DataFrame:
    """Continuation pages (all but the first of a document) from where the body goes on in their first twelve rows, else
    without the header rows that they begin with."""
    page = W.partitionBy("doc_id", "page_number")
    first = F.min("page_number").over(W.partitionBy("doc_id"))
    nth = F.row_number().over(page.orderBy("row_idx"))
    marked = rows.withColumn("first_page", first).withColumn("nth", nth).withColumn("told", R.tell(F.col("cells")))
    body = F.min(F.when((F.col("nth") <= HEADER_ROWS) & F.col("told.opens_body"), F.col("nth"))).over(page)
    other = F.min(F.when(~F.col("told.repeats"), F.col("nth"))).over(page)
    cut = marked.withColumn("body", body).withColumn("other", other)
    start = F.when(F.col("body") > 1, F.col("body")).otherwise(F.coalesce("other", F.lit(1 << 30)))
    return cut.where((F.col("page_number") == F.col("first_page")) | (F.col("nth") >= start)).select(*rows.columns)


def align(rows: DataFrame) -> DataFrame:
    """Rows of continuation pages brought to the width of the pages before: a column that is empty or holds currency marks
    only is dropped where rows are one too wide, and an empty notes cell is put into rows of a label and amounts that are
    one short.  Widths below four are left alone."""
    size = F.size("cells")
    mark = lambda c: (numbers.strip(F.coalesce(c, F.lit(""))) == "") | numbers.strip(c).isin(*R.CURRENCY)
    each = rows.select("doc_id", "page_number", F.posexplode("cells").alias("col", "cell"))
    columns = each.groupBy("doc_id", "page_number", "col").agg(F.bool_and(mark(F.col("cell"))).alias("idle"))
    pages = columns.groupBy("doc_id", "page_number").agg((F.max("col") + 1).alias("width"), F.sort_array(F.collect_list(F.when(F.col("idle") & (F.col("col") > 0), F.col("col")))).alias("idle"))
    # a page is aligned to the widest row of the pages before it, as they were aligned
    plan = "array<struct<page_number:int,target:int,helper:int>>"
    start = F.struct(F.lit(0).alias("widest"), F.array().cast(plan).alias("plan"))

    def page(a: Column, p: Column) -> Column:
        first = F.get(p["idle"], 0)
        helper = F.when((a["widest"] >= LEAST_WIDTH) & (p["width"] == a["widest"] + 1) & (first < a["widest"]), first)
        one = F.struct(p["page_number"].cast("int").alias("page_number"), a["widest"].alias("target"), helper.cast("int").alias("helper"))
        return F.struct(F.greatest(a["widest"], F.when(helper.isNotNull(), a["widest"]).otherwise(p["width"])).alias("widest"), F.concat(a["plan"], F.array(one)).alias("plan"))

    ordered = pages.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("page_number", "width", "idle"))).alias("pages"))
    planned = ordered.select("doc_id", F.inline(F.aggregate("pages", start, page)["plan"])).where(f"target >= {LEAST_WIDTH}")
    joined = rows.join(planned, ["doc_id", "page_number"], "left")
    narrow = F.when(F.col("helper").isNotNull() & (size == F.col("target") + 1), F.concat(F.slice("cells", F.lit(1), F.col("helper")), F.slice("cells", F.col("helper") + 2, size))).otherwise(F.col("cells"))
    out = joined.withColumn("cells", narrow)
    short = F.coalesce(F.size("cells") == F.col("target") - 1, F.lit(False)) & R.lacks_notes(F.col("cells"))
    filled = F.when(short, F.concat(F.slice("cells", 1, 1), F.array(F.lit("")), F.slice("cells", F.lit(2), F.size("cells")))).otherwise(F.col("cells"))
    return out.withColumn("cells", filled).select(*rows.columns)


def with_recognised(rows: DataFrame, recognised: DataFrame) -> DataFrame:
    """Page rows, those of a page replaced by its recognised ones where there are any, their header bands merged; method tells
    which they are."""
    pages = recognised.select("doc_id", "page_number").distinct()
    read = rows.join(pages, ["doc_id", "page_number"], "left_anti").withColumn("method", F.lit("embedded"))
    banded = headers.bands(recognised.select(*rows.columns))
    return read.unionByName(banded.withColumn("method", F.lit(RECOGNISED)))


def warned(densities: DataFrame, notes: DataFrame) -> DataFrame:
    """doc_id and warnings (array): what was noted when pages were recognised (notes: doc_id, page_number, seq, message), in
    order, then what the table's density gives rise to (densities: density())."""
    noted = notes.groupBy("doc_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("page_number", "seq", "message"))), lambda n: n["message"]).alias("noted"))
    own = F.when(F.col("warning").isNull(), F.array().cast("array<string>")).otherwise(F.array("warning"))
    return densities.join(noted, "doc_id", "left").select("doc_id", F.concat(F.coalesce("noted", F.array().cast("array<string>")), own).alias("warnings"))


def stacked(tables: DataFrame) -> DataFrame:
    """Recognised tables of a page (doc_id, page_number, table_idx, row_idx, cells) as its rows, an empty row between two."""
    least = F.min("table_idx").over(W.partitionBy("doc_id", "page_number"))
    seams = tables.select("doc_id", "page_number", "table_idx", least.alias("least")).distinct().where("table_idx > least")
    empty = seams.select("doc_id", "page_number", "table_idx", F.lit(-1).alias("row_idx"), F.array().cast("array<string>").alias("cells"))
    every = tables.select("doc_id", "page_number", "table_idx", "row_idx", "cells").unionByName(empty)
    place = F.row_number().over(W.partitionBy("doc_id", "page_number").orderBy("table_idx", "row_idx")) - 1
    return every.select("doc_id", "page_number", place.alias("row_idx"), "cells")


def continued(rows: DataFrame) -> DataFrame:
    """doc_id, place and cells of each document: its pages' rows in order, an empty row and "continue" between two pages."""
    pages = rows.select("doc_id", "page_number").distinct()
    later = pages.withColumn("least", F.min("page_number").over(W.partitionBy("doc_id"))).where("page_number > least")
    marks = F.array(F.struct(F.lit(-2).alias("row_idx"), F.array().cast("array<string>").alias("cells")), F.struct(F.lit(-1).alias("row_idx"), F.array(F.lit("continue")).alias("cells")))
    seams = later.select("doc_id", "page_number", F.inline(marks))
    every = rows.select("doc_id", "page_number", "row_idx", "cells").unionByName(seams)
    return every.select("doc_id", (F.row_number().over(W.partitionBy("doc_id").orderBy("page_number", "row_idx")) - 1).alias("place"), "cells")


def density(documents: DataFrame, rows: DataFrame) -> DataFrame:
    """doc_id, n_rows, n_numbers and the warning that so few give, if any; documents: doc_id."""
    counted = rows.groupBy("doc_id").agg(F.count("*").alias("n_rows"), F.sum(numbers.numeric_cells(F.col("cells"))).alias("n_numbers"))
    every = documents.select("doc_id").join(counted, "doc_id", "left").fillna(0, ["n_rows", "n_numbers"])
    return every.withColumn("warning", F.when(F.col("n_rows") == 0, NO_ROWS).when(F.col("n_numbers") < LEAST_NUMBERS, FEW_NUMBERS))


def scales(rows: DataFrame) -> DataFrame:
    """doc_id and the scale to millions that the first twelve rows ask for."""
    cells = F.filter("cells", lambda c: numbers.strip(F.coalesce(c, F.lit(""))) != "")
    first = rows.where("row_idx < 12").groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("row_idx", cells.alias("cells")))).alias("rows"))
    return first.select("doc_id", numbers.scale_of(F.array_join(F.flatten(F.col("rows.cells")), " ")).alias("scale"))


def note_columns(rows: DataFrame) -> DataFrame:
    """doc_id and col_idx (from 0) of the columns that a cell of the first eight rows calls notes."""
    each = rows.where("row_idx < 8").select("doc_id", F.posexplode("cells").alias("col_idx", "cell"))
    return each.where(F.lower(numbers.strip(F.col("cell"))).isin("note", "notes")).select("doc_id", "col_idx").distinct()


def coerced(rows: DataFrame) -> DataFrame:
    """doc_id, row_idx, col_idx, text and value of every cell as a sheet holds it: text of notes columns and of what is no
    amount (units rewritten to millions), amounts in millions, but as they are in rows that are not money."""
    joined = rows.join(scales(rows), "doc_id", "left").withColumn("scale", F.when(numbers.not_monetary(F.coalesce(F.get("cells", 0), F.lit(""))), F.lit("1").cast(numbers.SCALE)).otherwise(F.coalesce("scale", F.lit("1").cast(numbers.SCALE))))
    each = joined.select("doc_id", "row_idx", "scale", F.posexplode("cells").alias("col_idx", "cell"))
    notes = note_columns(rows).withColumn("is_note", F.lit(True))
    marked = each.join(notes, ["doc_id", "col_idx"], "left").withColumn("value", F.when(F.col("is_note").isNull(), numbers.amount(F.col("cell"), F.col("scale"))))
    return marked.select("doc_id", "row_idx", "col_idx", F.when(F.col("value").isNull(), numbers.in_millions(numbers.cell_text(F.coalesce("cell", F.lit(""))))).alias("text"), "value")
