"""Row order, ties of periods, provenance, conflicts and warnings of merged statements."""

import random
from decimal import Decimal

import pytest

from ledgerloom.operators import merge, tracking

STATEMENT = "company string, workbook string, sheet string, row_idx int, label string, period string, raw_text string"


def brute_order(reports):
    order = []
    for keys in reversed(reports):
        known = [i for i, k in enumerate(keys) if k in order]
        sides = {}
        for i, k in enumerate(dict.fromkeys(keys)):
            i = keys.index(k)
            if k in order:
                continue
            near = min(known, key=lambda j: (abs(i - j), j > i), default=None)
            sides.setdefault(None if near is None else (keys[near], near < i), []).append(k)
        order = [x for k in order for x in sides.get((k, False), []) + [k] + sides.get((k, True), [])] + sides.get(None, [])
    return order


def test_closest_order():
    assert merge.closest_order([["a", "x", "b", "c"], ["a", "b", "c"]]) == ["a", "x", "b", "c"]
    assert merge.closest_order([["x", "y", "c", "z"], ["a", "b", "c"]]) == ["a", "b", "x", "y", "c", "z"]
    assert merge.closest_order([["x"], ["a"], []]) == ["a", "x"] and merge.closest_order([]) == []
    rng = random.Random(2)
    for _ in range(400):
        reports = [rng.sample("abcdefghij", rng.randint(0, 7)) for _ in range(rng.randint(1, 4))]
        got = merge.closest_order(reports)
        assert got == brute_order(reports) and sorted(got) == sorted({k for r in reports for k in r})
        assert [k for k in got if k in reports[-1]] == reports[-1]


ROWS = [
    ("c", "r22.pdf", "s", 1, "Cash", "2022", "10"), ("c", "r22.pdf", "s", 2, "Old only", "2022", "7"), ("c", "r22.pdf", "s", 3, "Debt", "2022", "5"),
    ("c", "r23.pdf", "s", 1, "Cash", "2022", "11"), ("c", "r23.pdf", "s", 1, "Cash", "2023", "20"), ("c", "r23.pdf", "s", 2, "Debt", "2022", "5"), ("c", "r23.pdf", "s", 2, "Debt", "2023", "-"),
    ("c", "r24.pdf", "s", 1, "Debt", "2023", "6"), ("c", "r24.pdf", "s", 2, "Cash", "2022", "12"), ("c", "r24.pdf", "s", 2, "Cash", "2023", "20"), ("c", "r24.pdf", "s", 2, "Cash", "2024", "30"),
]


@pytest.fixture(scope="module")
def found(spark):
    return tracking.versions(merge.facts(spark.createDataFrame(ROWS, STATEMENT))).cache()


def test_order_of_the_latest_report(spark):
    rows = merge.merged(merge.facts(spark.createDataFrame(ROWS, STATEMENT)), order="latest")
    assert [r["key"] for r in rows.select("key", "position").distinct().orderBy("position").collect()] == ["debt#1", "cash#1", "old only#1"]


def test_sources(found):
    got = {(r["key"], r["period"]): (r["value"], r["workbook"], r["row_idx"], r["n_versions"]) for r in tracking.sources(found).collect()}
    assert got["cash#1", "2022"] == (12, "r24.pdf", 2, 3) and got["old only#1", "2022"] == (7, "r22.pdf", 2, 1) and got["debt#1", "2023"] == (6, "r24.pdf", 1, 2)


def test_conflicts(found):
    got = {(r["key"], r["column"]): (int(r["existing"]), int(r["value"])) for r in tracking.conflicts(found).collect()}
    assert got == {("cash#1", "2022 Conflict - r23.pdf"): (10, 11), ("cash#1", "2022 Conflict - r24.pdf"): (10, 12)}
    rows = tracking.with_conflict_columns(found)
    columns = [r["column"] for r in rows.select("column", "place").distinct().orderBy("place").collect()]
    assert columns == ["2022", "2022 Conflict - r23.pdf", "2022 Conflict - r24.pdf", "2023", "2024"]
    assert {r["column"]: r["value"] for r in rows.where("key = 'cash#1'").collect()} == dict(zip(columns, map(Decimal, (10, 11, 12, 20, 30))))
    assert {r["column"]: r["value"] for r in rows.where("key = 'debt#1'").collect()} == {"2022": 5, "2023": 6}


def test_ties_keep_the_order_first_seen(spark):
    rows = [("c", "a", "s", 1, "Cash", "Group 2024", "1"), ("c", "b", "s", 1, "Cash", "Alpha 2024", "2"), ("c", "b", "s", 1, "Cash", "2024", "2"), ("c", "b", "s", 1, "Cash", "Q1 2023", "3"), ("c", "b", "s", 1, "Cash", "2022", "4")]
    cells = merge.facts(spark.createDataFrame(rows, STATEMENT))
    placed = merge.ordered_periods(merge.merged(cells)).orderBy("place").collect()
    assert [r["period"] for r in placed] == ["2022", "Group 2024", "2024", "Alpha 2024", "Q1 2023"]
    # with the columns of the report, equal periods of one report go by column
    with_columns = cells.withColumn("col_idx", merge.F.when(merge.F.col("period") == "Alpha 2024", 2).otherwise(3))
    placed = merge.ordered_periods(merge.merged(with_columns)).orderBy("place").collect()
    assert [r["period"] for r in placed] == ["2022", "Group 2024", "Alpha 2024", "2024", "Q1 2023"]


def test_report_without_periods(spark):
    rows = [("c", "a", "s", 1, "Cash", "2024", "1"), ("c", "b", "s", 1, "Cash", "Notes", "2")]
    cells = merge.facts(spark.createDataFrame(rows, STATEMENT))
    assert merge.reports_in_order(cells).count() == 2
    with pytest.raises(Exception, match="b has no annual or quarterly period"):
        merge.reports_in_order(cells, strict=True).collect()


def test_laid_out(spark):
    rows = [("c", "a", "s", 1, "Cash", "2023", "1.5"), ("c", "a", "s", 1, "Cash", "Q1 2024", "2"), ("c", "a", "s", 2, "Debt", "Q1 2024", "-"), ("c", "a", "t", 1, "Sales", "2023", "4")]
    cells = merge.laid_out(merge.merged(merge.facts(spark.createDataFrame(rows, STATEMENT))))
    assert {(r["sheet"], r["r"], r["c"]): r["text"] if r["value"] is None else float(r["value"]) for r in cells.collect()} == {
        ("s", 1, 1): "Item", ("s", 1, 2): "2023", ("s", 1, 3): "", ("s", 1, 4): "Q1 2024", ("s", 2, 1): "Cash", ("s", 2, 2): 1.5, ("s", 2, 3): "", ("s", 2, 4): 2.0, ("s", 3, 1): "Debt", ("s", 3, 2): "", ("s", 3, 3): "", ("s", 3, 4): "",
        ("t", 1, 1): "Item", ("t", 1, 2): "2023", ("t", 2, 1): "Sales", ("t", 2, 2): 4.0,
    }


def test_tracking_and_warnings(spark, found):
    reports = merge.reports_in_order(merge.facts(spark.createDataFrame(ROWS + [("c", "q.pdf", "s", 1, "Cash", "Q3 2024", "1"), ("c", "q.pdf", "s", 1, "Cash", "3-Month Q3 2024", "1")], STATEMENT)))
    results = spark.createDataFrame([("c", "r24.pdf", "s", 3, 4, "embedded", ["odd"]), ("c", "q.pdf", "s", 7, 7, "mineru_ocr_fallback", [])], "company string, workbook string, sheet string, page_start int, page_end int, method string, warnings array<string>")
    statements = tracking.tracked(reports, results)
    got = {r["source"]: (r["report_type"], r["year"], r["quarter"], r["pages"], r["ocr_used"], r["warnings"]) for r in statements.collect()}
    assert got == {"r24.pdf": ("Annual", 2024, None, "3-4", False, "odd"), "q.pdf": ("Quarterly", 2024, 3, "7-7", True, "")}
    issues = spark.createDataFrame([("c", "r24.pdf", "s", "RC2")], "company string, workbook string, sheet string, rule string")
    told = tracking.warnings(found, statements, issues, wanted=("s", "t")).collect()
    assert sorted((r["severity"], r["issue_type"], r["source"], r["statement"], r["period"]) for r in told if r["period"] is None) == [
        ("Critical", "statement not found", "q.pdf", "t", None), ("Critical", "statement not found", "r24.pdf", "t", None), ("Critical", "validation failure", "r24.pdf", "s", None),
        ("Info", "recognised", "q.pdf", "s", None), ("Warning", "extraction", "r24.pdf", "s", None),
    ]
    assert sorted((r["issue_type"], r["source"], r["period"]) for r in told if r["period"] is not None) == [("conflict", "r23.pdf", "2022"), ("conflict", "r24.pdf", "2022")]
