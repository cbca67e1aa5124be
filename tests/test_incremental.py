"""Incremental runs: what a second run does, what a changed report changes, and what a failing one does not."""

import datetime
import json
import os

import pandas as pd
import pytest

from ledgerloom.operators import outcomes, registry
from ledgerloom.streaming import incremental


def parser():
    def parse(text):
        if text == "broken":
            raise ValueError("no table in it")
        return [tuple(r) for r in json.loads(text)]

    return parse


def report(company, path, sha, *rows):
    at = datetime.datetime(2024, 1, 1)
    return (company, path, sha, at, rows[0] if rows and isinstance(rows[0], str) else json.dumps([("s", i, label, period, v) for i, (label, period, v) in enumerate(rows)]))


@pytest.fixture
def run(spark, tmp_path):
    source, target, check = (f"file://{tmp_path}/{x}" for x in ("in", "out", "check"))
    schema = incremental.REPORT

    def go(*arrived):
        if arrived:
            spark.createDataFrame(list(arrived), schema).coalesce(1).write.mode("append").parquet(source)
        query = incremental.ingest(incremental.reports(spark, source), target, check, parser())
        query.awaitTermination()
        return query.lastProgress

    go.target, go.files = target, lambda table, company: sorted(os.listdir(f"{tmp_path}/out/{table}/company={company}"))
    go.merged = lambda: {(r["company"], r["label"], r["period"]): int(r["value"]) for r in incremental.read(spark, target, "merged").collect()}
    return go


def test_runs(spark, run):
    run(report("a", "a/1", "h1", ("Cash", "2022", "5")), report("b", "b/1", "h2", ("Cash", "2022", "7")))
    assert run.merged() == {("a", "Cash", "2022"): 5, ("b", "Cash", "2022"): 7}
    b_files = run.files("merged", "b")
    # nothing new: no batch, so nothing is read
    progress = run()
    assert progress is None or progress["numInputRows"] == 0
    # a new report of a, a copy of one that is recorded, and b stays as it is
    run(report("a", "a/2", "h3", ("Cash", "2022", "6"), ("Cash", "2023", "8")), report("a", "a/copy", "h1", ("Cash", "2022", "999")))
    assert run.merged() == {("a", "Cash", "2022"): 6, ("a", "Cash", "2023"): 8, ("b", "Cash", "2022"): 7}
    assert run.files("merged", "b") == b_files
    # the same path with another hash takes the place of what it was
    run(report("a", "a/2", "h4", ("Cash", "2022", "4")))
    assert run.merged() == {("a", "Cash", "2022"): 4, ("b", "Cash", "2022"): 7}
    records = incremental.alive(incremental.read(spark, run.target, "records"))
    assert sorted((r["source_path"], r["sha256"]) for r in records.collect()) == [("a/1", "h1"), ("a/2", "h4"), ("b/1", "h2")]


def test_failing_report_holds_its_company_only(spark, run):
    run(report("a", "a/1", "h1", ("Cash", "2022", "5")), report("a", "a/2", "h2", "broken"), report("b", "b/1", "h3", ("Cash", "2022", "7")))
    assert run.merged() == {("b", "Cash", "2022"): 7}
    told = incremental.read(spark, run.target, "outcomes")
    assert {r["source_path"]: r["error"] for r in told.collect()} == {"a/1": None, "a/2": "ValueError: no table in it", "b/1": None}
    summed = {r["company"]: (r["succeeded"], r["failed"]) for r in registry.summary(told).collect()}
    assert summed == {"a": (1, 1), "b": (1, 0)}
    # the report is replaced by a good one: what waited is done as well
    run(report("a", "a/2", "h4", ("Debt", "2022", "3")))
    assert run.merged() == {("a", "Cash", "2022"): 5, ("a", "Debt", "2022"): 3, ("b", "Cash", "2022"): 7}


def test_alive_like_upserts(spark):
    rows = [("p", "h1", 1), ("q", "h1", 2), ("q", "h2", 3), ("r", "h5", 3), ("s", "h5", 4)]
    frame = spark.createDataFrame([("c", p, h, None, b) for p, h, b in rows], "company string, source_path string, sha256 string, mtime timestamp, batch long")
    want = []
    for p, h, _ in rows:
        want = [x for x in want if x[0] != p and x[1] != h] + [(p, h)]
    assert sorted((r["source_path"], r["sha256"]) for r in incremental.alive(frame).collect()) == sorted(want)


def test_repeated_batch_changes_nothing(spark, tmp_path, run):
    run(report("a", "a/1", "h1", ("Cash", "2022", "5")))
    before = run.merged()
    # the commit of the batch is lost: Spark runs it again
    check = tmp_path / "check" / "commits"
    for f in check.iterdir():
        f.unlink()
    run()
    assert run.merged() == before and incremental.read(spark, run.target, "records").count() == 1 and incremental.read(spark, run.target, "facts").count() == 1


def test_captured_groups(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 0), ("c", 5)], "k string, v int")

    def work(pdf):
        if pdf["k"].iloc[0] == "c":
            return pd.DataFrame({"x": []})
        return pd.DataFrame({"x": [sum(10 // v for v in pdf["v"])]})

    done = outcomes.grouped(df, ["k"], work, "x long")
    assert sorted((r["k"], r["x"], (r["error"] or "").split(":")[0]) for r in done.collect()) == [("a", 15, ""), ("b", None, "ZeroDivisionError"), ("c", None, "")]
    assert outcomes.results(done, "x").count() == 1 and outcomes.statuses(done, ["k"]).where("error IS NOT NULL").count() == 1
