"""Header bands of page tables: the rows above the first amounts, put together into one header row.

rows: doc_id, page_number, row_idx, cells (array<string>).  A page's rows come together once, as one array, on which everything else
is done in the JVM; a page is what a reader sees at once, so its array is small.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import numbers
from ledgerloom.functions import rows as R

# A page of fewer rows has no band, nor one whose first amounts stand above the third row; without amounts so many
# rows are the band.
LEAST_ROWS, LEAST_BAND, BAND_WITHOUT_AMOUNTS, LEAST_AMOUNTS = 4, 2, 3, 2
PAGE = ["doc_id", "page_number"]


def _at(cells: Column, i: Column) -> Column:
    return F.coalesce(F.get(cells, i), F.lit(""))


def join_fragments(rows: DataFrame) -> DataFrame:
    """rows whose second cell is part of the label, being neither note numbers nor an amount, with it put there."""
    part = numbers.strip(_at(F.col("cells"), F.lit(1)))
    numbered = F.translate(part, "￦¥$", "").rlike(f"^{numbers.SPACE}*[0-9]+({numbers.SPACE}*,{numbers.SPACE}*[0-9]+)*{numbers.SPACE}*$")
    column = R.says(R.low(part), "note") | numbered | numbers.is_amount_token(part)
    joins = (F.size("cells") >= 3) & (_at(F.col("cells"), F.lit(0)) != "") & (part != "") & ~column
    whole = F.concat(F.array(numbers.strip(F.concat_ws(" ", F.get("cells", 0), part)), F.lit("")), F.slice("cells", F.lit(3), F.greatest(F.size("cells") - 2, F.lit(0))))
    return rows.withColumn("cells", F.when(joins, whole).otherwise(F.col("cells")))


def _out_of_notes(cells: Column, below: Column) -> Column:
    """A row of column headers whose period headers do not stand above notes, but above the years or dates to their right.

    Only cells as they are in the row and in the one below it decide, so all columns are told at once.
    """
    text = F.transform(cells, numbers.strip)
    under = F.transform(below, R.low)
    dated = F.transform(under, lambda c: R.says(c, "year", "date"))
    last = F.coalesce(F.array_max(F.transform(dated, lambda d, i: F.when(d, i))), F.lit(-1))
    leaves = F.transform(text, lambda c, i: (i > 0) & (i < last) & R.says(R.low(c), "period") & R.says(_at(under, i), "note"))
    first = F.array_min(F.transform(leaves, lambda gone, i: F.when(gone, i)))

    def moved(c: Column, i: Column) -> Column:
        here = (_at(text, i) == "") & F.coalesce(F.get(dated, i), F.lit(False)) & (first < i)
        return F.when(F.get(leaves, i), F.lit("")).when(here, F.get(text, first)).otherwise(c)

    return F.transform(cells, moved)


def _spread(cells: Column) -> Column:
    """A row of column headers in which a period header also stands in the empty cell to its right, and one that is split over
    two cells stands whole in both."""

    def pair(i: Column) -> Column:
        left, right = numbers.strip(_at(cells, i)), numbers.strip(_at(cells, i + 1))
        both = numbers.squeeze(F.concat_ws(" ", left, right))
        split = (left != "") & (right != "") & R.says(F.lower(both), "split group", "split date")
        goes_on = (right == "") & R.says(F.lower(left), "period", "unaudited")
        return F.when(split, F.struct(both.alias("own"), both.alias("next"))).when(goes_on, F.struct(_at(cells, i).alias("own"), left.alias("next")))

    pairs = F.transform(cells, lambda _, i: F.when(i < F.size(cells) - 1, pair(i)))
    return numbers._once(pairs, lambda p: F.transform(cells, lambda c, i: F.coalesce(F.get(p, i)["own"], F.when(i > 0, F.get(p, F.greatest(i - 1, F.lit(0)))["next"]), c)))


def _padded(rows: Column) -> Column:
    """Rows of column headers, each as wide as the widest one up to the next below it."""
    sizes = F.transform(rows, F.size)

    def pad(cells: Column, i: Column) -> Column:
        width = F.array_max(F.slice(sizes, F.lit(1), i + 2))
        return F.transform(F.sequence(F.lit(0), width - 1), lambda c: _at(cells, c))

    return F.transform(rows, pad)


def _period_rows(rows: Column) -> Column:
    """Rows of column headers (those of a page, in order) with each period header above the columns that it is about."""

    def settle(padded: Column) -> Column:
        moved = F.transform(padded, lambda cells, i: F.when(i + 1 < F.size(padded), _out_of_notes(cells, F.get(padded, i + 1))).otherwise(cells))
        return F.transform(moved, _spread)

    return numbers._once(_padded(rows), settle)


def period_headers(rows: DataFrame) -> DataFrame:
    """rows, being column headers, with each period header above the columns that it is about."""
    pages = rows.groupBy(*PAGE).agg(F.sort_array(F.collect_list(F.struct("row_idx", "cells"))).alias("rows"))
    return pages.select(*PAGE, F.inline(F.arrays_zip(F.col("rows.row_idx").alias("row_idx"), _period_rows(F.col("rows.cells")).alias("cells"))))


def _clean(c: Column) -> Column:
    """A header cell with the blanks that words have lost; fixed values."""
    c = F.regexp_replace(c, r"\bperiodended\b", "period ended")
    c = F.regexp_replace(c, r"\bperiodsended\b", "periods ended")
    return F.regexp_replace(c, r"\)(?=[0-9]{4}\b)", ") ")


def _stack(rows: Column) -> Column:
    """Rows as one: the cells of a column from top to bottom, line by line, but the parts of a date in one line."""

    def add(so_far: Column, cell: Column) -> Column:
        line = numbers.squeeze(F.concat_ws(" ", so_far, cell))
        return F.when(so_far == "", _clean(cell)).when(R.says(F.lower(line), "date"), line).otherwise(F.concat(so_far, F.lit("\n"), _clean(cell)))

    def column(i: Column) -> Column:
        return F.aggregate(F.filter(F.transform(rows, lambda r: _at(r, i)), lambda c: c != ""), F.lit(""), add)

    return F.transform(F.sequence(F.lit(0), F.array_max(F.transform(rows, F.size)) - 1), column)


def _judged(rows: DataFrame) -> DataFrame:
    """One row per page: rows, its rows in order, each with what a band needs to know of it.

    amounts: two or more in a row that is no header, by its label or by all its cells; kind: empty, context, section, label or column.
    """
    told = rows.withColumn("told", R.tell(F.col("cells")))
    context = R.says(F.col("told.text"), "context")
    label = (F.col("told.full") == 1) & (_at(F.col("cells"), F.lit(0)) != "")
    kind = F.when(F.col("told.full") == 0, "empty").when(context, "context").when(F.col("told.section"), "section").when(label, "label").otherwise("column")
    amounts = ~F.col("told.columns") & (F.col("told.amounts") >= LEAST_AMOUNTS) & ~R.says(F.col("told.first"), "header words")
    row = F.struct("row_idx", "cells", kind.alias("kind"), amounts.alias("amounts"))
    return told.groupBy(*PAGE).agg(F.sort_array(F.collect_list(row)).alias("rows"))


def bands(rows: DataFrame) -> DataFrame:
    """rows, the band of each page (its rows above the first amounts) as its leading rows, one row of stacked column headers, and its
    section rows.

    Where a column is headed by a name, the rows of column headers are left one below the other.  Rows are numbered anew from 0.
    """
    pages = _judged(rows)
    first = F.array_position(F.transform("rows", lambda r: r["amounts"]), True).cast("int") - 1
    size = F.size("rows")
    height = F.when(first >= 0, first).otherwise(F.least(size, F.lit(BAND_WITHOUT_AMOUNTS)))
    above = F.slice("rows", F.lit(1), F.col("height"))
    some = F.exists(above, lambda r: r["kind"] != "empty")
    pages = pages.withColumn("height", height).withColumn("height", F.when((size >= LEAST_ROWS) & (F.col("height") >= LEAST_BAND) & some, F.col("height")).otherwise(0))
    pages = pages.withColumn("band", above)
    cells = lambda keep: F.transform(F.filter("band", keep), lambda r: r["cells"])
    whole = lambda r: F.array(F.array_join(F.filter(r["cells"], lambda c: c != ""), " "))
    leading = F.transform(F.filter("band", lambda r: r["kind"].isin("context", "label")), lambda r: F.when(r["kind"] == "context", whole(r)).otherwise(r["cells"]))
    columns = numbers._once(cells(lambda r: r["kind"] == "column"), lambda c: F.when(F.size(c) > 0, _period_rows(c)).otherwise(c))
    pages = pages.select(*PAGE, "rows", "height", leading.alias("leading"), columns.alias("columns"), cells(lambda r: r["kind"] == "section").alias("sections"))
    name = lambda c, i: (i > 0) & c.rlike("[A-Za-z]") & ~R.says(R.low(c), *R.STRUCTURAL)
    named = F.exists("columns", lambda r: F.exists(F.transform(r, name), lambda x: x))
    stacked = F.when((F.size("columns") == 0) | named, F.col("columns")).otherwise(F.array(_stack(F.col("columns"))))
    below = F.transform(F.slice("rows", F.col("height") + 1, F.size("rows")), lambda r: r["cells"])
    return pages.select(*PAGE, F.posexplode(F.concat("leading", stacked, "sections", below)).alias("row_idx", "cells"))
