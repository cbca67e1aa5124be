"""Merging reports in the order of their latest periods: one row per item, the latest report wins, blanks included."""

from __future__ import annotations

from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions import labels, numbers, periods

THRESHOLD = 0.96


def facts(statements: DataFrame) -> DataFrame:
    """Report cells with their merge key (item#n, n counting the rows of a sheet that repeat an item, in sheet order).

    statements: company, workbook, sheet, row_idx, label, period, raw_text.
    """
    keyed = statements.withColumn("base", labels.item_key(F.col("label"))).where("base <> ''")
    nth = F.dense_rank().over(W.partitionBy("company", "workbook", "sheet", "base").orderBy("row_idx"))
    return keyed.withColumn("key", F.concat("base", F.lit("#"), nth)).drop("base")


def reports_in_order(cells: DataFrame, strict: bool = False) -> DataFrame:
    """company, workbook, latest (its latest period) and seq, its place: reports go by their latest period, then by lower-case
    name.  With strict, a report without any period is an error.

    Periods are read once for each that a report has, and only reports are put in order.
    """
    seen = cells.select("company", "workbook", "period").distinct()
    latest = F.max(periods.sort_key(periods.parse(F.col("period"))))
    reports = seen.groupBy("company", "workbook").agg(latest.alias("latest"))
    if strict:
        wrong = F.concat(F.col("workbook").cast("string"), F.lit(" has no annual or quarterly period"))
        reports = reports.withColumn("latest", F.when(F.col("latest")["year"].isNull(), F.raise_error(wrong)).otherwise(F.col("latest")))
    name = F.lower(F.col("workbook").cast("string"))
    return reports.withColumn("seq", F.dense_rank().over(W.partitionBy("company").orderBy("latest", name, "workbook")))


def in_order(cells: DataFrame, strict: bool = False) -> DataFrame:
    """cells with seq, the place of their report."""
    return cells.join(reports_in_order(cells, strict).drop("latest"), ["company", "workbook"])


def similarity(left: str, right: str, least: float) -> float:
    """The matching-blocks ratio of two texts, left first; 0 where its upper bounds are below least."""
    matcher = SequenceMatcher(None, left, right)
    return matcher.ratio() if matcher.real_quick_ratio() >= least and matcher.quick_ratio() >= least else 0.0


def _base(key: str) -> str:
    return key.rsplit("#", 1)[0]


class _Left:
    """The keys of a report that no master row has taken, by the length of what is compared."""

    def __init__(self, keys: list[str]):
        self.by_length: dict[int, dict[int, str]] = {}
        for i, key in enumerate(keys):
            base = _base(key)
            self.by_length.setdefault(len(base), {})[i] = base

    def drop(self, i: int, key: str) -> None:
        self.by_length[len(_base(key))].pop(i, None)

    def most_like(self, base: str, threshold: float) -> int | None:
        """The most similar key, the first of equals; only lengths at which the ratio can reach the threshold are looked at."""
        best, n = (0.0, 0), len(base)
        for m, keys in self.by_length.items():
            if 2 * min(n, m) >= threshold * (n + m) - 1e-9:
                best = max([best, *((similarity(base, other, threshold), -i) for i, other in keys.items())])
        return -best[1] if best[0] >= threshold else None


def resolve(sheets: list[list[str]], threshold: float = THRESHOLD) -> list[tuple[int, str, str, int]]:
    """(report, key, master key, master row) of a statement's keys, report by report, each in sheet order.

    A master row takes the row of an equal key, else the most similar one (ties: the first) that no master row before it
    has taken; what is left goes to the end.  A row may be taken by likeness first and by its equal key after that.
    """
    master, out = [], []
    for report, keys in enumerate(sheets):
        place, left = {k: i for i, k in enumerate(keys)}, _Left(keys)
        taken = set()
        for row, key in enumerate(list(master)):
            i = place.get(key)
            if i is None:
                i = left.most_like(_base(key), threshold)
            if i is not None:
                taken.add(i)
                left.drop(i, keys[i])
                out.append((report, keys[i], key, row))
        for i, key in enumerate(keys):
            if i not in taken:
                out.append((report, key, key, len(master)))
                master.append(key)
    return out


def closest_order(reports: list[list[str]]) -> list[str]:
    """The keys of all reports (oldest first, each in its own order) in the order of the latest one.

    Keys that only earlier reports have are put in report by report, the later ones first: a key goes next to the nearest key of its
    report that is placed already, behind one before it or before one behind it (ties: behind); with no such key, to the end.
    """
    order: list[str] = []
    for keys in reversed(reports):
        placed = set(order)
        known = [i for i, k in enumerate(keys) if k in placed]
        if not known:
            order += [k for k in dict.fromkeys(keys) if k not in placed]
            continue
        behind: dict[str, list[str]] = {}
        before: dict[str, list[str]] = {}
        at = 0
        for i, key in enumerate(keys):
            if key in placed:
                continue
            while at + 1 < len(known) and known[at + 1] < i:
                at += 1
            last = known[at] if known[at] < i else None
            after = known[at + 1 if last is not None else at] if (last is None or at + 1 < len(known)) else None
            if last is not None and (after is None or i - last <= after - i):
                behind.setdefault(keys[last], []).append(key)
            else:
                before.setdefault(keys[after], []).append(key)
            placed.add(key)
        order = [x for k in order for x in (*before.get(k, ()), k, *behind.get(k, ()))]
    return order


def master_rows(cells: DataFrame, threshold: float = THRESHOLD, order: str = "first") -> DataFrame:
    """company, sheet, seq and key of ordered cells, the key of the master row that each belongs to (master) and its position.

    Only keys reach Python: those of one statement of one company over all reports are one group, as the order in which reports
    are folded matters.  order: "first", rows as reports bring them in, or "latest", as in the latest report (closest_order).
    """

    def statement(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = pdf.sort_values(["seq", "row_idx"], kind="stable")
        numbers_, sheets = zip(*((s, g["key"].tolist()) for s, g in rows.groupby("seq", sort=True)))
        found = pd.DataFrame(resolve(list(sheets), threshold), columns=["report", "key", "master", "position"])
        if order == "latest":
            place = {k: [] for k in range(len(sheets))}
            by_key = {(r, k): m for r, k, m in zip(found["report"], found["key"], found["master"])}
            for r, keys in enumerate(sheets):
                place[r] = [by_key[r, k] for k in keys if (r, k) in by_key]
            position = {k: i for i, k in enumerate(closest_order(list(place.values())))}
            found["position"] = found["master"].map(position)
        out = found.assign(seq=[numbers_[r] for r in found["report"]], company=pdf["company"].iloc[0], sheet=pdf["sheet"].iloc[0])
        return out[["company", "sheet", "seq", "key", "master", "position"]]

    keys = cells.groupBy("company", "sheet", "seq", "key").agg(F.min("row_idx").alias("row_idx"))
    return keys.groupBy("company", "sheet").applyInPandas(statement, "company string, sheet string, seq int, key string, master string, position int")


def with_rows(cells: DataFrame, threshold: float = THRESHOLD, order: str = "first") -> DataFrame:
    """Ordered cells with the key and position of the master row that each belongs to."""
    placed = master_rows(cells, threshold, order)
    joined = cells.join(placed, ["company", "sheet", "seq", "key"])
    return joined.drop("key").withColumnRenamed("master", "key")


def _since(cells: DataFrame) -> Column:
    """Where a report first shows a period: its seq, then the column, where cells have one."""
    return F.min(F.struct("seq", (F.col("col_idx") if "col_idx" in cells.columns else F.lit(0)).alias("col_idx")))


def merged(cells: DataFrame, threshold: float = THRESHOLD, order: str = "first", strict: bool = False) -> DataFrame:
    """company, sheet, key, position, label, period, since, value and workbook: of each master row and period, the value of the
    latest report that has it, null values too; the label is the latest one of the row, since where its statement first shows the period.

    cells: facts(); order as in master_rows, strict as in reports_in_order.
    """
    by = ["company", "sheet", "key", "position"]
    rows = with_rows(in_order(cells, strict), threshold, order)
    last = F.max_by(F.struct("raw_text", F.col("workbook").cast("string").alias("workbook")), "seq")
    latest = rows.groupBy(*by, "period").agg(last.alias("last"), F.max(F.struct("seq", "label")).alias("named"), _since(rows).alias("since"))
    label = F.max("named").over(W.partitionBy(*by))["label"]
    since = F.min("since").over(W.partitionBy("company", "sheet", "period"))
    return latest.select(*by, label.alias("label"), "period", since.alias("since"), numbers.amount(F.col("last.raw_text")).alias("value"), F.col("last.workbook").alias("workbook"))


def _rank(since: Column) -> Column:
    """What periods are put in order by: annual ones first, then quarters, then others, each by time, then as they were first seen."""
    kind = lambda p: F.coalesce((p["kind"] == "quarter").cast("int"), F.lit(2)).alias("kind")
    told = numbers._once(periods.parse(F.col("period")), lambda p: F.struct(kind(p), periods.sort_key(p).alias("at")))
    return numbers._once(told, lambda t: F.struct(t["kind"].alias("kind"), t["at"].alias("at"), since.alias("since"), F.col("period").alias("period")))


def ordered_periods(cells: DataFrame) -> DataFrame:
    """company, sheet, period and place: annual periods first, then quarters, each in order; equal ones as they were first
    seen (since, where cells have it), then by their labels."""
    since = F.min("since") if "since" in cells.columns else F.min(F.lit(0))
    seen = cells.groupBy("company", "sheet", "period").agg(since.alias("since")).select("company", "sheet", "period", _rank(F.col("since")).alias("rank"))
    return seen.select("company", "sheet", "period", F.row_number().over(W.partitionBy("company", "sheet").orderBy("rank")).alias("place"))


def _with_all_periods(merged_cells: DataFrame) -> DataFrame:
    """One row for each master row: company, sheet, key, position, label, found (period to value) and periods, those of its statement in
    order (_rank).  merged_cells are read once; a statement's rows meet in one window."""
    since = F.col("since") if "since" in merged_cells.columns else F.lit(0)
    row = ["company", "sheet", "key", "position", "label"]
    told = merged_cells.withColumn("rank", _rank(since))
    rows = told.groupBy(*row).agg(F.map_from_entries(F.collect_list(F.struct("period", "value"))).alias("found"), F.collect_set("rank").alias("own"))
    every = F.array_sort(F.array_distinct(F.flatten(F.collect_set("own").over(W.partitionBy("company", "sheet")))))
    return rows.withColumn("periods", every).drop("own")


def laid_out(merged_cells: DataFrame) -> DataFrame:
    """company, sheet, r, c (both from 1), text and value: merged statements as their sheets show them.

    Row 1 is headed Item; annual periods come first, then, if there are quarters, an empty column and the quarters.  A cell without an
    amount is an empty text.
    """
    by = W.partitionBy("company", "sheet")
    rows = _with_all_periods(merged_cells).withColumn("r", F.row_number().over(by.orderBy("position", "key")) + 1)
    annual = F.size(F.filter("periods", lambda p: p["kind"] != 1))
    # quarters stand right of the periods that are none, and of an empty column
    shown = F.filter("periods", lambda p: p["kind"] == 0), F.filter("periods", lambda p: p["kind"] == 1), F.filter("periods", lambda p: p["kind"] == 2)
    cell = lambda r, c, text, value: F.struct(r.alias("r"), c.cast("int").alias("c"), text.alias("text"), value.cast("decimal(28,8)").alias("value"))
    none, blank = F.lit(None), F.lit("")
    place = lambda i: i + 2 + F.when(i >= annual, 1).otherwise(0)
    ordered = rows.withColumn("periods", F.concat(shown[0], shown[2], shown[1]))
    amount = lambda p, i: F.try_element_at("found", p["period"])
    body = F.transform("periods", lambda p, i: cell(F.col("r"), place(i), F.when(amount(p, i).isNull(), blank), amount(p, i)))
    heads = F.transform("periods", lambda p, i: cell(F.lit(1), place(i), p["period"], none))
    gap = lambda r: F.when(annual < F.size("periods"), F.array(cell(r, annual + 2, blank, none))).otherwise(F.array())
    line = F.concat(F.array(cell(F.col("r"), F.lit(1), F.col("label"), none)), body, gap(F.col("r")))
    top = F.concat(F.array(cell(F.lit(1), F.lit(1), F.lit("Item"), none)), heads, gap(F.lit(1)))
    return ordered.select("company", "sheet", F.inline(F.when(F.col("r") == 2, F.concat(top, line)).otherwise(line)))


def with_places(merged_cells: DataFrame) -> DataFrame:
    """merged cells with the place of their period among their statement's columns."""
    order = W.partitionBy("company", "sheet").orderBy(_rank(F.col("since") if "since" in merged_cells.columns else F.lit(0)))
    return merged_cells.withColumn("place", F.dense_rank().over(order))


def densified(merged_cells: DataFrame) -> DataFrame:
    """Every master row of a statement with every period of it; null where no report has an amount."""
    every = _with_all_periods(merged_cells).select("company", "sheet", "key", "position", "label", "found", F.explode("periods.period").alias("period"))
    return every.withColumn("value", F.try_element_at("found", F.col("period"))).drop("found")


def wide(merged_cells: DataFrame, shown: list[str] | None = None, prefix: str = "y", strict: bool = True) -> DataFrame:
    """One row per item and a column per period, in the order given, or annual ones and then quarters; a column name is
    prefix and period.  Without a list, the distinct periods come to the driver, as column names must; with one, any other period is an
    error, unless strict is off: then only what is listed is shown."""
    if shown is None:
        names = ordered_periods(merged_cells.select(F.lit("").alias("company"), F.lit("").alias("sheet"), "period"))
        shown = [r["period"] for r in names.orderBy("place").collect()]
    elif strict:
        # a period without a column would be lost without a word
        lost = F.concat(F.lit("no column for period "), "period")
        merged_cells = merged_cells.withColumn("period", F.when(F.col("period").isin(*shown), F.col("period")).otherwise(F.raise_error(lost).cast("string")))
    out = merged_cells.groupBy("company", "sheet", "position", "label", "key").pivot("period", shown).agg(F.first("value"))
    return out.select("company", "sheet", "position", "label", "key", *[F.col(f"`{p}`").cast("decimal(28,8)").alias(f"{prefix}{p}") for p in shown])


@F.pandas_udf(T.DoubleType())
def ratio(left: pd.Series, right: pd.Series, least: pd.Series) -> pd.Series:
    """similarity() of columns."""
    return pd.Series([similarity(a, b, t) for a, b, t in zip(left, right, least)])


def _grams(c):
    """The bigrams of a text, repeats numbered, so that equal ones count as often as they occur."""
    every = F.transform(F.sequence(F.lit(1), F.length(c) - 1), lambda i: F.substr(c, i, F.lit(2)))
    once = F.array_distinct(every)
    return F.flatten(F.transform(once, lambda g: F.transform(F.sequence(F.lit(1), F.size(F.filter(every, lambda x: x == g))), lambda n: F.struct(g.alias("gram"), n.alias("n")))))


def fuzzy_matches(left: DataFrame, right: DataFrame, by: list[str], threshold: float = THRESHOLD) -> DataFrame:
    """For each left key without an equal right one, the most similar right key, at least threshold (ties: first key).

    Keys are the distinct keys of a statement, of any number.  A ratio of t or more leaves at most e = (a + b) * (1 - t)
    characters of both unmatched, so that each key keeps all but 2 e of its bigrams; pairs have to share one of the 2 e + 1
    rarest bigrams of either, which is a join on bigrams in the JVM.  Nor can their edit distance be above e, which the JVM
    tells as well; only such pairs of fitting length get a ratio.
    """
    alone = left.select(*by, "key").distinct().join(right.select(*by, "key").distinct(), [*by, "key"], "left_anti")
    others = right.select(*by, F.col("key").alias("other")).distinct()

    def prefixes(keys: DataFrame, name: str, seen: DataFrame) -> DataFrame:
        n = F.length(name)
        # the longest partner has n * (2 - t) / t characters
        lost = F.floor((n + n * (2 - threshold) / threshold) * (1 - threshold) + 1e-9)
        cut = keys.where(n > 1).withColumn("bigram", F.explode(_grams(F.col(name)))).join(seen, [*by, "bigram"], "left").withColumn("often", F.coalesce("often", F.lit(0)))
        ranked = cut.withColumn("k", F.row_number().over(W.partitionBy(*by, name).orderBy("often", "bigram")))
        return ranked.where(F.col("k") <= 2 * lost + 1).select(*by, name, "bigram", n.alias(f"n_{name}"))

    seen = others.where(F.length("other") > 1).select(*by, F.explode(_grams(F.col("other"))).alias("bigram")).groupBy(*by, "bigram").agg(F.count("*").alias("often"))
    pairs = prefixes(alone, "key", seen).join(prefixes(others, "other", seen), [*by, "bigram"])
    fitting = 2 * F.least("n_key", "n_other") >= threshold * (F.col("n_key") + F.col("n_other")) - 1e-9
    lost = F.floor((F.col("n_key") + F.col("n_other")) * (1 - threshold) + 1e-9).cast("int")
    near = pairs.where(fitting).select(*by, "key", "other", lost.alias("lost")).distinct().where(F.levenshtein("key", "other") <= F.col("lost"))
    scored = near.withColumn("score", ratio("key", "other", F.lit(threshold))).where(F.col("score") >= threshold)
    best = scored.groupBy(*by, "key").agg(F.min(F.struct((-F.col("score")).alias("less"), "other")).alias("m"))
    return best.select(*by, "key", F.col("m.other").alias("other"), F.round(-F.col("m.less"), 6).alias("score"))
