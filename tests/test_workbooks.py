"""Workbooks written and read back, and the small outputs of a run."""

import json
import os
import zipfile
from decimal import Decimal
from xml.etree import ElementTree

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import reports
from ledgerloom.sources import artefacts, workbooks

SCHEMA = workbooks.CELLS + ", bold boolean, fill string, number_format string, colspan int"
ROWS = [
    ("a", "Balance Sheet", 1, 1, "Item", None, True, "FFD9EAF7", None, 2), ("a", "Balance Sheet", 2, 1, "Cash & <co> \x01é", None, None, None, None, None), ("a", "Balance Sheet", 2, 28, None, Decimal("-1234.5"), None, None, reports.FRACTION, None),
    ("a", "Cash Flow", 3, 2, "", None, None, None, None, None), ("b/c", "Balance Sheet", 1, 1, None, Decimal(7), None, None, reports.WHOLE, None), ("a", "Balance Sheet", 0, 1, "gone", None, None, None, None, None),
]


@pytest.fixture
def cells(spark):
    spark.dataSource.register(workbooks.Workbooks)
    return workbooks.by_workbook(spark.createDataFrame(ROWS, SCHEMA))


def test_round_trip(spark, cells, tmp_path):
    at = f"{tmp_path}/books"
    cells.write.format("workbook").mode("append").save(at)
    assert sorted(os.listdir(at)) == ["a.xlsx", "b_c.xlsx"]
    got = {(r["workbook"], r["sheet"], r["r"], r["c"]): (r["text"], r["value"]) for r in spark.read.format("workbook").load(at).collect()}
    assert got == {
        ("a.xlsx", "Balance Sheet", 1, 1): ("Item", None), ("a.xlsx", "Balance Sheet", 2, 1): ("Cash & <co> é", None), ("a.xlsx", "Balance Sheet", 2, 28): (None, Decimal("-1234.5")), ("a.xlsx", "Cash Flow", 3, 2): ("", None),
        ("b_c.xlsx", "Balance Sheet", 1, 1): (None, Decimal(7)),
    }
    with zipfile.ZipFile(f"{at}/a.xlsx") as z:
        for name in z.namelist():
            ElementTree.fromstring(z.read(name))
        styles, sheet = z.read("xl/styles.xml").decode(), z.read("xl/worksheets/sheet1.xml").decode()
    assert "FFD9EAF7" in styles and "#,##0.0;(#,##0.0)" in styles
    assert '<mergeCell ref="A1:B1"/>' in sheet and 'r="AB2"' in sheet


def test_names_that_are_taken(spark, cells, tmp_path):
    at = f"file://{tmp_path}/books"
    for mode in ("append", "append", "overwrite"):
        cells.where("workbook = 'a'").write.format("workbook").mode(mode).save(at)
    assert sorted(os.listdir(tmp_path / "books")) == ["a.xlsx", "a_run2.xlsx"]


def test_failed_job_leaves_nothing(spark, cells, tmp_path):
    at = f"{tmp_path}/books"
    bad = cells.withColumn("text", F.when(F.col("workbook") == "b/c", F.raise_error(F.lit("lost")).cast("string")).otherwise(F.col("text")))
    with pytest.raises(Exception, match="lost"):
        bad.write.format("workbook").mode("append").save(at)
    assert not os.path.isdir(at) or os.listdir(at) == []


def test_strict_sheets(spark, cells, tmp_path):
    at = f"{tmp_path}/books"
    cells.write.format("workbook").mode("append").save(at)
    read = spark.read.format("workbook")
    assert read.option("sheets", "Balance Sheet|Cash Flow").load(f"{at}/a.xlsx").count() == 4
    with pytest.raises(Exception, match="has to hold the sheets"):
        read.option("sheets", "Balance Sheet|Cash Flow").load(f"{at}/b_c.xlsx").count()


def test_column_names():
    for c in (1, 26, 27, 52, 702, 703, 16384):
        assert workbooks.column_number(workbooks.column_name(c) + "12") == c
    assert workbooks.column_name(28) == "AB"


def test_statement_books(spark):
    rows = workbooks.statement_books(spark.createDataFrame([("a", None, None, None, None, None)], workbooks.CELLS)).collect()
    assert [tuple(r) for r in rows] == [("a", "NoStatements", 1, 1, "", None)]


def test_folded_rows(spark):
    results = spark.createDataFrame([("d", 1, "income_statement", "Consolidated income statements", 3, 3), ("d", 2, "income_statement", "Comprehensive income", 5, 5), ("d", 3, "cash_flow", "Cash flows", 6, 6)], "doc_id string, position int, statement_type string, title string, page_start int, page_end int")
    cells = [(1, 0, ["(in thousands)", "2024"]), (1, 1, ["Sales", "5,000"]), (2, 0, ["(in millions)", "2024"]), (2, 1, ["Gain", "7,000"]), (3, 0, ["Paid", "1,000"])]
    rows = spark.createDataFrame([("d", *c) for c in cells], "doc_id string, position int, row_idx int, cells array<string>")
    got = [(r["kept"], r["row_idx"], r["cells"]) for r in reports.folded_rows(results, rows).orderBy("kept", "row_idx").collect()]
    assert got == [(1, 0, cells[0][2]), (1, 1, cells[1][2]), (1, 2, []), (1, 3, cells[2][2]), (1, 4, cells[3][2]), (2, 0, cells[4][2])]
    amounts = {(r["kept"], r["row_idx"]): r["value"] for r in reports.folded_amounts(results, rows).where("col_idx = 1 AND value IS NOT NULL").collect()}
    # one scale for all of the kept statement: its own, of thousands
    assert amounts == {(1, 1): Decimal("5"), (1, 4): Decimal("7"), (2, 0): Decimal("1000")}


def test_extraction_record(spark):
    results = spark.createDataFrame([("d", 1, "out.xlsx", "d.pdf", "cash_flow", "Cash", [4, 5], "embedded", 0.85)], "doc_id string, position int, output_workbook string, source_pdf string, statement_type string, title string, pages array<int>, method string, score double")
    warnings = spark.createDataFrame([("d", 1, 2, "b"), ("d", 1, 1, "a")], "doc_id string, position int, seq int, message string")
    (row,) = reports.extraction_record(results, warnings).collect()
    assert tuple(row)[2:] == ("out.xlsx", "Cash Flow Statement", "cash_flow", "d.pdf", "4, 5", "4", "5", "embedded", "Cash", "0.85", "a; b")


def test_number_formats(spark):
    df = spark.createDataFrame([(Decimal("5"),), (Decimal("5.5"),), (None,)], "v decimal(28,8)")
    assert [r[0] for r in df.select(reports.number_format(F.col("v"))).collect()] == [reports.WHOLE, reports.FRACTION, None]


def test_artefacts(spark, tmp_path):
    meta = spark.createDataFrame([("d", "annual", 12, None)], "doc_id string, report_type string, page_count int, unit string")
    at = f"file://{tmp_path}/meta"
    artefacts.write_json(meta, at, ["doc_id"])
    (back,) = artefacts.read_json(spark, at, "doc_id string, page_count int, report_type string, unit string").collect()
    assert (back["doc_id"], back["page_count"], back["report_type"], back["unit"]) == ("d", 12, "annual", None)
    (name,) = [f for _, _, files in os.walk(tmp_path / "meta") for f in files if f.endswith(".txt")]
    text = open(next(p for p in (tmp_path / "meta").rglob(name))).read()
    assert list(json.loads(text)) == sorted(json.loads(text)), "keys in order"
    assert artefacts.read_json(spark, f"file://{tmp_path}/none", "doc_id string, x int").count() == 0
    pages = spark.createDataFrame([("d", 2, "two\nlines"), ("d", 1, "one")], "doc_id string, page_number int, text string")
    artefacts.write_pages(pages, f"file://{tmp_path}/pages")
    assert sorted((r["doc_id"], r["page_number"], r["text"]) for r in artefacts.read_pages(spark, f"file://{tmp_path}/pages").collect()) == [("d", 1, "one"), ("d", 2, "two\nlines")]
    seen = spark.createDataFrame([("c", "h2"), ("c", "h1"), ("e", "h3")], "company string, sha256 string")
    artefacts.write_manifests(seen, f"file://{tmp_path}/manifests")
    assert {r["company"]: r["seen"] for r in artefacts.read_manifests(spark, f"file://{tmp_path}/manifests").collect()} == {"c": ["h1", "h2"], "e": ["h3"]}
    done = spark.createDataFrame([("c", "f", "p", "h")], "company string, file_name string, source_path string, sha256 string")
    words = spark.createDataFrame([("c", "cash_flow", "b"), ("c", "cash_flow", "a")], "company string, statement_type string, keyword string")
    artefacts.write_configurations(words, done, f"file://{tmp_path}/config")
    (config,) = reports.configurations(artefacts.read_texts(spark, f"file://{tmp_path}/config").select("company", F.col("text").alias("current"), F.lit(None).cast("string").alias("legacy"))).collect()
    assert config["config_version"] == 1 and config["statement_keywords"] == {"cash_flow": ["a", "b"]} and [tuple(r) for r in config["processed_reports"]] == [("f", "p", "h")]
