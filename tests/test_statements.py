"""The statement rules on small inputs, against results worked out by hand."""

from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerloom.functions import labels, numbers, periods
from ledgerloom.operators import locate, merge, reconcile, registry, sheets
from ledgerloom.plans import fixtures
from ledgerloom.sources.markup_tables import grid
from ledgerloom.sources.star import values


def one(spark, column, *texts):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, c string").select("i", column(F.col("c")).alias("x")).orderBy("i").collect()
    return [r["x"] for r in rows]


def test_amounts(spark):
    texts = ["1,234", "(1,234.50)", "1234", "-", "(-5)", "(5", "US$2.5", "1,23", "¥ 12", None, ""]
    expected = ["1234", "-1234.50", None, None, "5", "5", "2.5", None, None, None, None]
    got = one(spark, numbers.amount, *texts)
    assert [None if g is None else Decimal(g) for g in got] == [None if e is None else Decimal(e) for e in expected]


@pytest.mark.parametrize(
    "header, scale",
    [("(won in millions) note 2021", 1), ("(expressed in singapore dollars) 2019 $m", 1), ("amounts in thousands of u.s. dollars", "0.001"), ("expressed in korean won", "0.000001"), ("amounts in billions of won", 1000), ("", 1)],
)
def test_scale(spark, header, scale):
    assert one(spark, numbers.scale_of, header)[0] == Decimal(scale)


def test_unit_text(spark):
    assert one(spark, numbers.in_millions, "Amounts in thousands of U.S. dollars", "Expressed in Korean won", "$000") == ["Amounts in millions of U.S. dollars", "Expressed in millions of Korean won", "$m"]


def test_periods(spark):
    texts = ["2024", "FY24 3Q", "9-Month Q3 2024", "2023Q1", "June 30, 2025", "30 June 2025", "1999", None, "For the six-month period ended June 30 (unaudited) 2021"]
    assert [p and p["label"] for p in one(spark, periods.parse, *texts)] == ["2024", "Q3 2024", "9-Month Q3 2024", "Q1 2023", "Q2 2025", "2025", None, None, "6-Month Q2 2021"]


def test_item_key(spark):
    assert one(spark, labels.item_key, "Cash & Equivalents (net)", "  A--B ") == ["cash and equivalents", "a b"]


def test_sheets(spark):
    facts = {(r["doc_id"], r["key"], r["period"]): r["raw_text"] for r in sheets.facts(values(spark, fixtures.SHEETS)).collect()}
    assert {k[2] for k in facts if k[0] == "two"} == {"Alpha 2022", "Alpha 2021", "Beta 2022", "Beta 2021"}
    assert facts["twin", "sales#1", "Q2 2019"] == "58\t" and facts["twin", "sales#2", "Q2 2019"] == "-"


def test_reconciliation(spark):
    cells = values(spark, fixtures.STATEMENTS)
    failed = {(r["doc_id"], r["rule"]) for r in reconcile.issues(cells).collect()}
    assert failed == {("F9", "RC2"), ("F10b", "RC5"), ("F13", "RC7"), *((f"Q{k}", f"RC{k}") for k in (1, 3, 4, 6, 8, 9, 10))}
    assert {(r["row_idx"], r["col_idx"]) for r in reconcile.failed_cells(cells).where("doc_id = 'F9'").collect()} == {(0, 1), (1, 1), (2, 1)}


def test_locator(spark):
    got = {(r["doc_id"], r["statement_type"]): (r["page_start"], r["page_end"]) for r in locate.candidates(values(spark, fixtures.PAGES)).collect()}
    assert {k[1]: v[0] for k, v in got.items() if k[0] == "F16"} == {"balance_sheet": 10, "income_statement": 11, "cash_flow": 13}
    assert {k[1]: v[0] for k, v in got.items() if k[0] == "F17"} == {"balance_sheet": 1, "income_statement": 2, "cash_flow": 6}
    assert got["F22", "income_statement"] == (1, 1) and got["F24", "income_statement"] == (1, 2)
    assert not [k for k in got if k[0] == "F18"]


def test_configured_keyword_wins(spark):
    pages = spark.createDataFrame([("d", 1, "Consolidated statements of comprehensive income or loss")], "doc_id string, page_number int, text string")
    words = spark.createDataFrame([("income_statement", "consolidated statements of comprehensive income or loss")], "statement_type string, keyword string")
    (hit,) = locate.candidates(pages, words).collect()
    assert hit["reason"] == "company_locator_config" and hit["statement_type"] == "income_statement"


STATEMENT = "company string, workbook string, sheet string, row_idx int, label string, period string, raw_text string"


def test_latest_period_wins_not_the_name(spark):
    rows = [("c", "Zenith 2023", "s", 1, "Cash", "2022", "1"), ("c", "Zenith 2023", "s", 1, "Cash", "2023", "2"), ("c", "Alpha 2024", "s", 1, "Cash", "2023", "3"), ("c", "Alpha 2024", "s", 1, "Cash", "2024", "4")]
    rows += [("c", "Zenith 2023", "s", 2, "Trade receivable from customers", "2023", "5"), ("c", "Alpha 2024", "s", 2, "Trade receivables from customers", "2024", "6"), ("c", "Alpha 2024", "s", 3, "New item", "2024", "7")]
    rows += [("c", "Zenith 2023", "s", 4, "Cash", "2023", "8"), ("c", "Quarter", "s", 1, "Cash", "Q1 2024", "9")]
    merged = merge.merged(merge.facts(spark.createDataFrame(rows, STATEMENT)))
    got = {(r["position"], r["key"], r["label"], r["period"]): (int(r["value"]), r["workbook"]) for r in merged.collect()}
    receivable = "Trade receivables from customers"
    assert got == {
        (0, "cash#1", "Cash", "2022"): (1, "Zenith 2023"), (0, "cash#1", "Cash", "2023"): (3, "Alpha 2024"), (0, "cash#1", "Cash", "2024"): (4, "Alpha 2024"), (0, "cash#1", "Cash", "Q1 2024"): (9, "Quarter"),
        (1, "trade receivable from customers#1", receivable, "2023"): (5, "Zenith 2023"), (1, "trade receivable from customers#1", receivable, "2024"): (6, "Alpha 2024"),
        (2, "cash#2", "Cash", "2023"): (8, "Zenith 2023"), (3, "new item#1", "New item", "2024"): (7, "Alpha 2024"),
    }
    assert merge.wide(merged).columns[5:] == ["y2022", "y2023", "y2024", "yQ1 2024"]


def test_rows_are_taken_once():
    # two alike: the first one in order is taken; the second master row gets what is left
    assert merge.resolve([["aaaaaaaaaaaaaaaaaaaaaaaaab#1", "aaaaaaaaaaaaaaaaaaaaaaaaac#1"], ["aaaaaaaaaaaaaaaaaaaaaaaaad#1", "aaaaaaaaaaaaaaaaaaaaaaaaae#1"]], 0.96)[2:] == [
        (1, "aaaaaaaaaaaaaaaaaaaaaaaaad#1", "aaaaaaaaaaaaaaaaaaaaaaaaab#1", 0), (1, "aaaaaaaaaaaaaaaaaaaaaaaaae#1", "aaaaaaaaaaaaaaaaaaaaaaaaac#1", 1)]
    assert merge.resolve([["x y#1"], ["z#1", "x y#1"], ["z#1"]]) == [(0, "x y#1", "x y#1", 0), (1, "x y#1", "x y#1", 0), (1, "z#1", "z#1", 1), (2, "z#1", "z#1", 1)]


def test_fuzzy_finds_what_all_pairs_find(spark):
    import random
    from difflib import SequenceMatcher

    rng = random.Random(3)
    names = [" ".join(rng.choices(["trade", "other", "receivables", "net", "of", "tax", "provision", "assets", "related", "parties"], k=rng.randint(2, 7))) for _ in range(150)]

    def edited(t):
        for _ in range(rng.randint(0, 2)):
            i = rng.randrange(len(t))
            t = t[:i] + rng.choice(["", "s", t[i] * 2]) + t[i + 1 :]
        return t

    left, right = sorted(set(names)), sorted({edited(n) for n in names} | {"x", "aa"})
    frame = lambda keys: spark.createDataFrame([(1, k) for k in keys], "g int, key string")
    for least in (0.96, 0.9):
        want = {}
        for a in set(left) - set(right):
            score, _, b = max((SequenceMatcher(None, a, b).ratio(), -i, b) for i, b in enumerate(right))
            if score >= least:
                want[a] = (b, round(score, 6))
        assert {r["key"]: (r["other"], r["score"]) for r in merge.fuzzy_matches(frame(left), frame(right), ["g"], least).collect()} == want and len(want) > 20


def test_continuation_pages_are_aligned(spark):
    from ledgerloom.operators import rebuild

    pages = [
        (1, ["Consolidated balance sheets", "", "", ""]), (1, ["Item", "Notes", "2024", "2023"]), (1, ["Cash", "1", "5", "6"]),
        (2, ["Consolidated balance sheets", "", "", "", ""]), (2, ["", "", "Notes", "2024", "2023"]), (2, ["Loans", "$", "2", "7", "8"]), (2, ["Tax", "", "3", "9", "1"]),
        (3, ["Acme Holdings Ltd."]), (3, ["notes"]), (4, ["Deferred income of later years", "₩", "4", "1", "2"]), (5, ["Total of it all", "7", "8"]),
    ]
    rows = spark.createDataFrame([("d", p, k, c) for k, (p, c) in enumerate(pages)], "doc_id string, page_number int, row_idx int, cells array<string>")
    kept = rebuild.align(rebuild.drop_repeated_headers(rows))
    assert [r["cells"] for r in kept.orderBy("page_number", "row_idx").collect()] == [
        *[c for p, c in pages if p == 1], ["Loans", "2", "7", "8"], ["Tax", "3", "9", "1"], ["Deferred income of later years", "4", "1", "2"], ["Total of it all", "", "7", "8"],
    ]


def test_table_lines(spark):
    from ledgerloom.operators import rebuild

    lines = [(1, 20.0, "Annual report 2024"), (1, 60.0, "Acme Group"), (1, 300.0, "Total assets 5"), (1, 310.0, "Some prose about it"), (1, 320.0, "Equity"), (1, 790.0, "12"), (2, 300.0, "only prose here"), (2, 310.0, "more of it")]
    df = spark.createDataFrame([("d", p, k, y, 800.0, t.split()) for k, (p, y, t) in enumerate(lines)], "doc_id string, page_number int, line_no int, y0 double, height double, words array<string>")
    assert sorted(r["line_no"] for r in rebuild.table_lines(df).collect()) == [1, 2, 4, 6, 7]


def test_files_are_discovered(spark, tmp_path):
    folder = tmp_path / "companies" / "Acme" / "Financial_Statements"
    folder.mkdir(parents=True)
    for name in ("b.PDF", "A.pdf", "notes.txt"):
        (folder / name).write_bytes(name.encode())
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"file://{tmp_path}/companies")
    found = registry.discovered(files).orderBy("place").collect()
    assert [(r["company"], r["file_name"], r["place"]) for r in found] == [("Acme", "A.pdf", 1), ("Acme", "b.PDF", 2)]
    assert found[0]["sha256"] == __import__("hashlib").sha256(b"A.pdf").hexdigest()


def test_keywords_are_of_their_company(spark):
    pages = spark.createDataFrame([(c, c, 1, "Our own statement of money") for c in "ab"], "doc_id string, company string, page_number int, text string")
    words = spark.createDataFrame([("a", "cash_flow", "our own statement of money")], "company string, statement_type string, keyword string")
    assert [r["doc_id"] for r in locate.candidates(pages, words).collect()] == ["a"]


def test_first_json_object(spark):
    from ledgerloom.sources import markup_tables

    cases = {'{"a": 1}': '{"a": 1}', 'see {"a": {"b": 2}} and {"c": 3}': '{"a": {"b": 2}}', "```JSON\n{\"a\": 1}\n``` rest": '{"a": 1}', "{ broken": None, "x {no json} {}": None, "none": None, "} {\"k\":[{}]} }": '{"k":[{}]}'}
    assert one(spark, markup_tables.first_object, *cases) == list(cases.values())


def test_later_blank_erases(spark):
    rows = [("c", 1, "s", 1, "Cash", "2023", "5,000"), ("c", 2, "s", 1, "Cash", "2023", ""), ("c", 2, "s", 2, "Debt", "2023", "7.5")]
    m = merge.merged(merge.facts(spark.createDataFrame(rows, STATEMENT)))
    assert {r["key"]: r["value"] for r in m.collect()} == {"cash#1": None, "debt#1": Decimal("7.5")}


def test_fuzzy(spark):
    keys = lambda *k: spark.createDataFrame([("g", x) for x in k], "g string, key string")
    found = merge.fuzzy_matches(keys("trade receivable", "other"), keys("trade receivables", "trade and other receivables"), ["g"]).collect()
    assert [(r["key"], r["other"], r["score"]) for r in found] == [("trade receivable", "trade receivables", 0.969697)]


def test_registry(spark):
    reports = spark.createDataFrame([("a", "p/a", "ha"), ("b", "p/b", "hb")], "file_name string, source_path string, sha256 string")
    done = spark.createDataFrame([("x", "p/x", "hb"), ("y", "p/a", "hy"), ("z", "p/z", ""), ("w", "p/w", None)], reports.schema)
    assert [r["file_name"] for r in registry.unprocessed(reports, done).collect()] == ["a"]
    assert sorted(r["file_name"] for r in registry.upsert(done, reports).where("sha256 is not null").collect()) == ["a", "b", "z"]


@settings(max_examples=60, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.tuples(st.text(max_size=2), st.integers(1, 3), st.integers(1, 3)), max_size=4), max_size=4))
def test_grid_is_rectangular(rows):
    laid = grid(rows)
    assert len({len(r) for r in laid}) <= 1 and len(laid) == len(rows)
