"""Page words to lines, column anchors, cells and rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import numbers
from ledgerloom.functions import rows as R
from ledgerloom.operators import headers, rebuild

TOLERANCE, SPREAD, LEAST, MOST, BOUNDARY = 3.0, 24.0, 2, 8, 30.0


def _pages(words: DataFrame) -> DataFrame:
    """doc_id, page_number and lines: a page's words in order of height, cut into lines; a word opens a line if it is far from the
    line's mean height.

    The mean of a line moves with each word, so a page is one sequential fold; pages are bounded and independent.  Only where lines
    begin is kept along it.  Words without a height go to the last line.
    """
    number = lambda name: F.when(~F.isnan(name), F.col(name))
    y, x = number("y0"), number("x0")
    word = F.struct(y.isNull().alias("low"), F.rint(y / TOLERANCE).alias("band"), x.isNull().alias("right"), x.alias("x0"), y.alias("y0"), number("x1").alias("x1"), "text")
    start = F.struct(F.lit(0.0).alias("total"), F.lit(0).alias("n"), F.lit(0).alias("at"), F.array().cast("array<int>").alias("starts"))

    def step(a: Column, w: Column) -> Column:
        far = F.when(a["n"] == 0, F.lit(True)).otherwise(F.coalesce(F.abs(w["y0"] - a["total"] / a["n"]) > TOLERANCE, F.lit(False)))

        def grown(opens: Column) -> Column:
            total, n = F.when(opens, w["y0"]).otherwise(a["total"] + w["y0"]), F.when(opens, F.lit(1)).otherwise(a["n"] + 1)
            return F.struct(total.alias("total"), n.alias("n"), (a["at"] + 1).alias("at"), F.when(opens, F.concat(a["starts"], F.array(a["at"]))).otherwise(a["starts"]).alias("starts"))

        return numbers._once(far, grown)

    def cut(starts: Column) -> Column:
        return F.transform(starts, lambda at, i: F.slice("words", at + 1, F.coalesce(F.get(starts, i + 1), F.size("words")) - at))

    pages = words.groupBy(F.col("doc_id").cast("string").alias("doc_id"), F.col("page_number").cast("int").alias("page_number")).agg(F.sort_array(F.collect_list(word)).alias("words"))
    return pages.select("doc_id", "page_number", numbers._once(F.aggregate("words", start, step)["starts"], cut).alias("lines"))


def to_lines(words: DataFrame) -> DataFrame:
    """words with line_no."""
    lines = _pages(words).select("doc_id", "page_number", F.posexplode("lines").alias("line_no", "line"))
    return lines.select("doc_id", "page_number", "line_no", F.inline("line")).select("doc_id", "page_number", "line_no", "x0", "y0", "x1", "text")


def page_lines(words: DataFrame) -> DataFrame:
    """doc_id, page_number, line_no, y0 (the least of the line), x0, x1 and words: to_lines() with the words of a line from left to
    right in arrays, so that a line's words need not meet again."""
    lines = _pages(words).select("doc_id", "page_number", F.posexplode("lines").alias("line_no", "line"))
    across = F.sort_array(F.transform("line", lambda w, i: F.struct(w["right"].alias("right"), w["x0"].alias("x0"), i.alias("at"), w["y0"].alias("y0"), w["x1"].alias("x1"), w["text"].alias("text"))))
    return lines.withColumn("line", across).select("doc_id", "page_number", "line_no", F.array_min("line.y0").alias("y0"), F.col("line.x0").alias("x0"), F.col("line.x1").alias("x1"), F.col("line.text").alias("words"))


def _anchors(xs: Column, spread: float = SPREAD, least: int = LEAST, most: int = MOST) -> Column:
    """Sorted positions to column anchors: means of clusters; a position opens one if it is further than spread from the last mean."""
    cluster = "struct<total:double,n:int>"
    start = F.array().cast(f"array<{cluster}>")

    def step(acc, x):
        last = F.element_at(acc, -1)
        grown = F.concat(F.slice(acc, F.lit(1), F.size(acc) - 1), F.array(F.struct((last["total"] + x).alias("total"), (last["n"] + 1).alias("n"))))
        fresh = F.concat(acc, F.array(F.struct(x.alias("total"), F.lit(1).alias("n"))))
        return F.when(F.size(acc) == 0, fresh).when(F.abs(x - last["total"] / last["n"]) > spread, fresh).otherwise(grown)

    found = F.filter(F.aggregate(xs, start, step), lambda c: c["n"] >= least)
    ranked = F.slice(F.array_sort(F.transform(found, lambda c: F.struct((-c["n"]).alias("n"), (c["total"] / c["n"]).alias("mean")))), 1, most)
    return F.array_sort(F.transform(ranked, lambda c: c["mean"]))


def anchors(words: DataFrame, spread: float = SPREAD, least: int = LEAST, most: int = MOST) -> DataFrame:
    """doc_id, page_number and the sorted column anchors of a page's words."""
    pages = words.groupBy("doc_id", "page_number").agg(F.sort_array(F.collect_list((F.col("x0") + F.col("x1")) / 2)).alias("xs"))
    return pages.select("doc_id", "page_number", _anchors(F.col("xs"), spread, least, most).alias("anchors"))


def _anchor_places(lines: Column) -> Column:
    """The middles of the amounts and note words in lines (x0, x1, words) with an amount that are no title or date."""

    def line(one: Column) -> Column:
        amount = F.transform(one["words"], numbers.is_amount_token)
        kept = F.transform(one["words"], lambda w, i: F.when(F.get(amount, i) | R.says(R.low(w), "anchor word"), (F.get(one["x0"], i) + F.get(one["x1"], i)) / 2))
        dated = R.says(R.low(F.array_join(one["words"], " ")), "dated line")
        return F.when(F.exists(amount, lambda x: x) & ~dated, F.filter(kept, lambda x: x.isNotNull())).otherwise(F.array().cast("array<double>"))

    return F.sort_array(F.flatten(F.transform(lines, line)))


def _column(a: Column, middle: Column) -> Column:
    """The column of a place among anchors a: 0 left of the first one (less a margin), else 1 + the number of midpoints passed."""
    passed = F.size(F.filter(a, lambda x, i: (i > 0) & (middle > (F.get(a, F.greatest(i - 1, F.lit(0))) + x) / 2)))
    return F.when(middle < F.get(a, 0) - BOUNDARY, 0).otherwise(1 + passed)


def to_rows(lines: DataFrame) -> DataFrame:
    """doc_id, page_number, row_idx (the line's number) and cells of the lines that have a word; lines: page_lines().

    Columns are told from the places of a page's amounts.  A title and a unit line (one that is no row of column headers) are
    one cell, as is every line of a page without columns; other words go to the columns of their places, currency marks that stand
    alone to none.  A page's lines meet once, as one array.
    """
    pages = lines.groupBy("doc_id", "page_number").agg(F.sort_array(F.collect_list(F.struct("line_no", "x0", "x1", "words"))).alias("lines"))
    each = pages.withColumn("anchors", _anchors(_anchor_places(F.col("lines")))).select("doc_id", "page_number", "anchors", F.inline("lines"))
    line = R.low(F.array_join("words", " "))
    whole = R.says(line, "title") | (R.says(line, "unit") & ~F.exists("words", lambda w: R.says(R.low(w), *R.STRUCTURAL)))
    place = lambda w, i: F.when(~w.isin(*R.LONE_CURRENCY), _column(F.col("anchors"), (F.get("x0", i) + F.get("x1", i)) / 2))

    def cell(i: Column) -> Column:
        return numbers.strip(F.array_join(F.filter("words", lambda w, k: F.coalesce(F.get("place", k) == i, F.lit(False))), " "))

    cells = F.when(whole | (F.size("anchors") == 0), F.array(F.array_join("words", " "))).otherwise(F.transform(F.sequence(F.lit(0), F.size("anchors")), cell))
    rows = each.withColumn("place", F.transform("words", place)).select("doc_id", "page_number", F.col("line_no").alias("row_idx"), cells.alias("cells"))
    return rows.where(F.exists("cells", lambda c: numbers.strip(c) != ""))


def statement_rows(words: DataFrame, sizes: DataFrame) -> DataFrame:
    """Page words to table rows: lines, those of a table's body, columns by the places of amounts, cells, labels put together,
    header bands merged, labels that go on in the next row joined.

    words: doc_id, page_number, x0, y0, x1, text; sizes: doc_id, page_number, height.  Pages meet only with themselves: once to be cut into
    lines, and once for all that follows.
    """
    lines = page_lines(words).join(sizes, ["doc_id", "page_number"])
    rows = headers.join_fragments(to_rows(rebuild.table_lines(lines)))
    return rebuild.join_labels(headers.bands(rows))


def to_cells(lines: DataFrame, page_anchors: DataFrame) -> DataFrame:
    """Line cells: column 0 left of the first anchor (less a margin), else 1 + the number of midpoints passed."""
    a = F.col("anchors")
    middle = (F.col("x0") + F.col("x1")) / 2
    passed = F.size(F.filter(F.sequence(F.lit(1), F.size(a) - 1), lambda i: middle > (F.element_at(a, i) + F.element_at(a, i + 1)) / 2))
    column = F.when(F.size(a) == 0, 0).when(middle < F.element_at(a, 1) - BOUNDARY, 0).when(F.size(a) == 1, 1).otherwise(1 + passed)
    placed = lines.join(page_anchors, ["doc_id", "page_number"]).withColumn("col_idx", column)
    text = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("x0", "text"))), lambda x: x["text"]), " ")
    return placed.groupBy("doc_id", "page_number", "line_no", "col_idx").agg(text.alias("text"))
