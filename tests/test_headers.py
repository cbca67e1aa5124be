"""Header bands and the way from page words to rows, against plain loops over one page at a time."""

import random
import re

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import rows as R
from ledgerloom.operators import headers, rebuild, words

MONTHS = "january|february|march|april|may|june|july|august|september|october|november|december"
AMOUNT = re.compile(r"\(?-?(\d+|\d{1,3}(,\d{3})+)(\.\d+)?\)?|[-–]")


def is_(kind, text):
    text = text.strip().lower()
    flat = re.sub(r"\s+", " ", text)
    for k, test, vals in R.RULES:
        if k == kind and any({"is": text == v, "has": v in text, "starts": text.startswith(v), "like": test == "like" and bool(re.search(v, flat))}[test] for v in vals):
            return True
    return False


def structural(c):
    return any(is_(k, c) for k in R.STRUCTURAL)


def amount(c):
    return bool(AMOUNT.fullmatch(c.strip()))


def header_row(row):
    full = [c.strip() for c in row if c.strip()]
    text = " ".join(full)
    dates = re.search(rf"\b({MONTHS})\b", text.lower()) and re.search(r"\b(19|20)\d\d\b", text) and all(is_("part of a date", c) for c in full)
    names = len(full) <= 6 and all(re.search("[A-Za-z]", c) and len(c.split()) <= 3 and not structural(c) and not amount(c) for c in full)
    return not full or is_("unit", text) or is_("period", text) or bool(dates) or all(map(structural, full)) or names


def brute_periods(rows):
    rows, source = [list(r) for r in rows], [list(r) for r in rows]
    for i, row in enumerate(rows):
        width = max(len(r) for r in source[: i + 2])
        row += [""] * (width - len(row))
        below = source[i + 1] + [""] * width if i + 1 < len(rows) else [""] * width
        was = list(row)
        for c in range(1, width):
            right = [j for j in range(c + 1, width) if is_("year", below[j]) or is_("date", below[j])]
            if is_("period", was[c]) and is_("note", below[c]) and right:
                row[c] = ""
                for j in right:
                    row[j] = row[j] if row[j].strip() else was[c].strip()
        c = 0
        while c + 1 < width:
            a, b = row[c].strip(), row[c + 1].strip()
            both = re.sub(r"\s+", " ", f"{a} {b}")
            step = 2
            if not b and (is_("period", a) or is_("unaudited", a)):
                row[c + 1] = a
            elif a and b and (is_("split group", both) or is_("split date", both)):
                row[c] = row[c + 1] = both
            else:
                step = 1
            c += step
    return rows


def brute_bands(rows):
    data = [i for i, r in enumerate(rows) if not header_row(r) and sum(amount(c) for c in r[1:] if c) >= 2 and not is_("header words", r[0])]
    first = data[0] if data else min(len(rows), 3)
    if len(rows) < 4 or first <= 1 or not any(c for r in rows[:first] for c in r):
        return rows
    top, columns, sections = [], [], []
    for r in rows[:first]:
        full = [c for c in r if c]
        if not full:
            continue
        if is_("context", " ".join(full)):
            top.append([" ".join(full)])
        elif len(full) == 1 and is_("section", full[0]):
            sections.append(r)
        elif full == [r[0]]:
            top.append(r)
        else:
            columns.append(r)
    columns = brute_periods(columns)
    if not any(c.strip() and re.search("[A-Za-z]", c) and not structural(c) for r in columns for c in r[1:]) and columns:
        merged = [""] * max(map(len, columns))
        clean = lambda c: re.sub(r"\)(?=\d{4}\b)", ") ", c.replace("periodended", "period ended"))
        for r in columns:
            for i, c in enumerate(r):
                line = re.sub(r"\s+", " ", f"{merged[i]} {c}".strip())
                if c:
                    merged[i] = clean(c) if not merged[i] else line if is_("date", line) else merged[i] + "\n" + clean(c)
        columns = [merged]
    return top + columns + sections + rows[first:]


HEADS = ["", "", "", "Notes", "note", "2024", "2023", "March 31,", "December 31", "For the three-month", "period", "For the three-month period", "ended June", "ended", "June 30,", "(Unaudited)", "$m", "2024 $m",
         "For the years ended", "For each of the", "for the six-month periodended June 30", "June 30, 2024"]
LABELS = ["", "", "Assets", "Current assets", "As of March 31", "(in millions of won)", "Item", "Consolidated statements of cash flows", "For the year ended 2024", "Alpha Group", "Cash and cash equivalents"]
NAMES = ["Parent", "Share capital", "Owners of the parent company"]


def page(rng, names):
    width = rng.randint(2, 5)
    row = lambda pool: [rng.choice(LABELS)] + [rng.choice(pool) for _ in range(rng.randint(1, width))]
    lone = lambda: [rng.choice(LABELS)] + [""] * rng.randint(0, width)
    band = [row(HEADS + (NAMES if names else [])) if rng.random() < 0.7 else lone() for _ in range(rng.randint(0, 5))]
    return band + [[rng.choice(LABELS)] + [rng.choice(["1,234", "(5)", "-", "", "7"]) for _ in range(width)] for _ in range(rng.randint(0, 4))]


def frame(spark, pages):
    rows = [("d", p, i, r) for p, page in enumerate(pages) for i, r in enumerate(page)]
    return spark.createDataFrame(rows, "doc_id string, page_number int, row_idx int, cells array<string>")


def by_page(df, n):
    out = [[] for _ in range(n)]
    for r in df.orderBy("page_number", "row_idx").collect():
        out[r["page_number"]].append(r["cells"])
    return out


def test_bands_of_many_pages(spark):
    rng = random.Random(11)
    pages = [page(rng, i % 3 == 0) for i in range(600)]
    got = by_page(headers.bands(frame(spark, pages)), len(pages))
    wrong = [(p, g, brute_bands(p)) for p, g in zip(pages, got) if g != brute_bands(p)]
    assert not wrong, wrong[:2]
    assert sum(brute_bands(p) != p for p in pages) > 200


def test_period_headers_of_many_bands(spark):
    rng = random.Random(12)
    pages = [[[rng.choice(HEADS + ["Notes"] * 4) for _ in range(rng.randint(1, 6))] for _ in range(rng.randint(1, 4))] for _ in range(600)]
    got = by_page(headers.period_headers(frame(spark, pages)), len(pages))
    wrong = [(p, g, brute_periods(p)) for p, g in zip(pages, got) if g != brute_periods(p)]
    assert not wrong, wrong[:2]


BAND = [
    ["Consolidated statements of income", "", "", "", ""], ["As of", "June 30,", "2024", "", ""], ["", "For the six-month periodended June 30", "", "", ""], ["", "Notes", "2024", "2023", ""], ["Revenue", "", "", "", ""],
    ["Sales", "4", "1,200", "900", ""],
]


def test_band_by_hand(spark):
    got = by_page(headers.bands(frame(spark, [BAND])), 1)[0]
    assert got == [
        ["Consolidated statements of income", "", "", "", ""], ["As of June 30, 2024"], ["", "Notes", "For the six-month period ended June 30\n2024", "For the six-month period ended June 30\n2023", "For the six-month period ended June 30"],
        ["Revenue", "", "", "", ""], ["Sales", "4", "1,200", "900", ""],
    ]


@pytest.mark.parametrize(
    "cells, want",
    [
        (["Cash and", "equivalents", "5"], ["Cash and equivalents", "", "5"]), (["Cash", "12", "5"], ["Cash", "12", "5"]), (["Cash", "3, 4", "5"], ["Cash", "3, 4", "5"]), (["Cash", "note", "5"], ["Cash", "note", "5"]),
        (["Cash", "$ 5", "5"], ["Cash", "$ 5", "5"]), (["Cash", "and"], ["Cash", "and"]), (["", "and", "5"], ["", "and", "5"]), (["Cash", "4 (a)", "5"], ["Cash 4 (a)", "", "5"]), ([], []),
    ],
)
def test_label_fragments(spark, cells, want):
    assert headers.join_fragments(frame(spark, [[cells]])).first()["cells"] == want


LAID_OUT = [
    (20, [(50, "Annual"), (100, "report")]), (60, [(50, "Consolidated"), (130, "statements"), (210, "of"), (230, "comprehensive"), (320, "income")]), (80, [(50, "(in"), (70, "millions"), (130, "of"), (150, "won)")]),
    (100, [(300, "Notes"), (400, "2024"), (500, "2023")]), (120, [(50, "Sales"), (300, "4"), (380, "$"), (400, "1,200"), (500, "900")]), (140, [(50, "Cost"), (90, "of"), (110, "the"), (140, "goods")]), (160, [(50, "sold"), (300, "5"), (400, "(700)"), (500, "(650)")]),
    (180, [(50, "Profit"), (300, "-"), (400, "500"), (500, "250")]), (200, [(50, "Plain"), (90, "prose"), (140, "here")]), (790, [(300, "12")]),
]


def test_words_to_rows(spark):
    laid = [("d", 1, float(x), float(y), float(x + 6 * len(t)), t) for y, line in LAID_OUT for x, t in line]
    random.Random(1).shuffle(laid)
    found = words.statement_rows(spark.createDataFrame(laid, "doc_id string, page_number int, x0 double, y0 double, x1 double, text string"), spark.createDataFrame([("d", 1, 800.0)], "doc_id string, page_number int, height double"))
    assert [r["cells"] for r in found.orderBy("row_idx").collect()] == [
        ["Consolidated statements of comprehensive income"], ["(in millions of won)"], ["", "Notes", "2024", "2023"], ["Sales", "4", "1,200", "900"], ["Cost of the goods sold", "5", "(700)", "(650)"], ["Profit", "-", "500", "250"],
    ]


def test_recognised_rows_get_their_band(spark):
    rows = rebuild.with_recognised(frame(spark, [[["old", "1", "2"]]]), frame(spark, [BAND]))
    assert rows.count() == 5 and {r["method"] for r in rows.collect()} == {rebuild.RECOGNISED}


def test_warnings_in_order(spark):
    notes = spark.createDataFrame([("d", 2, 1, "late"), ("d", 1, 1, "first"), ("d", 1, 2, "second")], "doc_id string, page_number int, seq int, message string")
    documents = spark.createDataFrame([("d",), ("e",)], "doc_id string")
    made = rebuild.warned(rebuild.density(documents, frame(spark, [[["Cash", "1", "2", "3", "4"]]])), notes)
    assert {r["doc_id"]: r["warnings"] for r in made.collect()} == {"d": ["first", "second", "late"], "e": [rebuild.NO_ROWS]}
