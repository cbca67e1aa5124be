"""Work that has to grow with the input only: what a plan repeats, and pages that meet in the JVM."""

from random import Random

import duckdb
import pandas as pd
from oracle import SF, rows
from pyspark.sql import functions as F

import __spark_entry__ as entry
from ledgerloom.functions import numbers
from ledgerloom.functions import rows as R
from ledgerloom.operators import words
from ledgerloom.sources import markup_tables


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_texts_are_cut_into_lines_once(spark):
    # one split each for the words of the made table, for lines and for cells
    assert plan(entry.queries()["document_markdown_tables"](spark, SF)).count("split(") == 3


def test_markdown_tables_of_odd_texts(spark):
    texts = {1: "| a | b |", 2: "x\n|a|\nno\n|b|\n|c|", 3: "|--|\n|---|\n| |\n", 4: "|h|\r\n|:---:|\x0b| 1 |\x85|2|  end", 5: "", 6: None, 7: "| a |\n| b | c |"}
    df = spark.createDataFrame(list(texts.items()), "doc_id int, text string")
    found = sorted(tuple(r) for r in markup_tables.markdown_tables(df).collect())
    assert found == [(3, 0, 0, "--"), (3, 1, 0, ""), (4, 0, 0, "h"), (4, 1, 0, "1"), (4, 2, 0, "2"), (7, 0, 0, "a"), (7, 1, 0, "b"), (7, 1, 1, "c")]


def test_answers_are_told_in_one_pass(spark):
    text = plan(entry.queries()["document_answer_tables"](spark, SF))
    assert "Join" not in text and text.count("Relation [") == 1 and text.count("split(") == 4


def test_answers_of_odd_texts(spark):
    texts = {
        1: "4397110767823743 +1 (654) 555 and words", 2: "12 apples\n| a | b |\n|---|---|\n| 1 | 2 |", 3: '{"sheets":[{"name":"","cells":[{"r":1,"c":2,"v":"x"},{"r":1,"c":0,"v":"gone"},null]},null,{"name":"n"}]}',
        4: 'so {"sheets":[],"meta":{"notes":" why "}} it is', 5: None, 6: '{"a":"{"} x }', 7: "[1], [2]", 8: '1, "y": 2',
    }
    df = spark.createDataFrame(list(texts.items()), "doc_id int, text string")
    raw = [(k, "Sheet1", 1, 1, texts[k]) for k in (1, 5, 6, 7, 8)]
    tables = [(2, "Sheet1", r, c, v) for r, c, v in ((1, 1, "a"), (1, 2, "b"), (2, 1, "1"), (2, 2, "2"))]
    assert sorted(map(tuple, markup_tables.answer_tables(df).collect()), key=str) == sorted([*raw, *tables, (3, "Sheet1", 1, 2, "x"), (4, "Sheet1", 1, 1, "why")], key=str)


def test_lines_are_cut_in_the_jvm(spark):
    assert "Pandas" not in plan(entry.queries()["words_to_cells"](spark, SF)) and "Pandas" not in plan(entry.queries()["statement_pages_to_rows"](spark, SF))


def test_lines_by_their_moving_means(spark):
    r = Random(3)
    places = [(p, r.uniform(0, 90), round(r.uniform(0, 40 * p), 1), str(k)) for k, p in enumerate(r.choices(range(1, 6), k=400))] + [(9, 1.0, None, "a"), (9, 2.0, 5.0, "b"), (9, None, 5.5, "c"), (9, float("nan"), float("nan"), "d")]
    want = {}
    for page in {p for p, *_ in places}:
        found, line, heights = [w[1:] for w in places if w[0] == page], -1, []
        known = lambda v: v is not None and v == v
        for x, y, t in sorted(found, key=lambda w: (not known(w[1]), round(w[1] / 3) if known(w[1]) else 0, not known(w[0]), w[0] if known(w[0]) else 0)):
            if not heights or known(y) and abs(y - sum(heights) / len(heights)) > 3:
                line, heights = line + 1, []
            heights += [y] if known(y) else []
            want[t] = line
    df = spark.createDataFrame([("d", p, x, y, x, t) for p, x, y, t in places], "doc_id string, page_number int, x0 double, y0 double, x1 double, text string")
    assert {w["text"]: w["line_no"] for w in words.to_lines(df).collect()} == want
    lines = {(l["page_number"], l["line_no"]): l for l in words.page_lines(df).collect()}
    assert {t: n for (_, n), l in lines.items() for t in l["words"]} == want and lines[9, 0]["words"] == ["a", "b", "c", "d"]
    assert all(l["x0"] == sorted(l["x0"]) and l["y0"] == min(y for p, x, y, t in places if t in l["words"]) for (p, _), l in lines.items() if p < 9)


def test_rows_are_judged_once(spark):
    assert plan(entry.queries()["continuation_pages"](spark, SF)).count("integral part of the consolidated") <= 3


def test_period_patterns_are_not_repeated(spark):
    # characters of the plans; 2,097,472 and 709,160 when every use of a period worked it out anew
    assert len(plan(entry.queries()["sheet_to_facts"](spark, SF))) < 400_000 and len(plan(entry.queries()["entity_period_labels"](spark, SF))) < 150_000


def test_lines_are_cut_into_cells_for_their_digits_only(spark):
    # every line was cut, twice over, and every pattern tried on all of it
    text = plan(entry.queries()["document_line_kinds"](spark, SF))
    assert "CASE WHEN RLIKE(line" in text and text.count("split(line") == 1 and text.count("[millions,thousands]") == 1


def test_needed_words_leave_no_pattern_out(spark):
    r = Random(7)
    pieces = [
        "- 5 -", "–12–", "—3 —", "-", "(korean won in millions)", "won\xa0in\tthousands)", "(us dollars in  thousands)", "in", "millions", "thousands", "consolidated", "statements", "of", "cash flows", "income statement",
        "financial\nposition", "for each of the", "for the six-month period", "for the", "nine months period", "three-month period", "years ended", "year", "period ended", "periods", "ended march", "ended june 30,", "december 31", "july 1, 2024",
        "2024", "2019 (unaudited)", "1999\n$m", "2001  m", "inc.", "ltd", "corporation", "holdings", "a group", "subsidiary", "limited", "company", "x", "7", "é",
    ]
    texts = pieces + ["".join(r.choice(pieces) + r.choice([" ", " ", "  ", "\t", "", "\xa0"]) for _ in range(r.randrange(1, 5))) for _ in range(3000)]
    kinds = {rule.kind: "|".join(rule.values) for rule in R.RULES if rule.kind in R.NEEDS}
    assert set(kinds) == set(R.NEEDS)
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(R.low(F.col("t")).alias("t"))
    flat = F.regexp_replace("t", f"{numbers.SPACE}+", " ")
    found = df.select([F.struct(F.count_if(R.says(F.col("t"), k)).alias("said"), F.count_if(flat.rlike(p)).alias("like"), F.count_if(R.says(F.col("t"), k) != flat.rlike(p)).alias("other")).alias(k) for k, p in kinds.items()]).head()
    assert all(found[k]["said"] == found[k]["like"] > 0 == found[k]["other"] for k in kinds), found


def test_line_kinds_of_odd_documents(spark, tmp_path):
    r = Random(5)
    pieces = ["12", "1,234", "(5)", "-", "–", "- 5 -", "— 7 —", "$1.50", "US$ 3", "W 12", "in", "millions", "(won in  millions)", "Assets", "current assets", "the accompanying notes are", "statements.", "form part of  these consolidated financial statements", "x1", "2-3", "1,", "\x1c", "\x85", "\xa0", "\u3000", "中文", "é"]
    seps = [" ", " ", "  ", "\t", "\n", "\n\n", " \n", "\n "]
    texts = [None, "", "\n", " ", *("".join(r.choice(pieces) + r.choice(seps) for _ in range(r.randrange(1, 30))) for _ in range(500))]
    pd.DataFrame({"doc_id": [k // 2 for k in range(len(texts))], "text": texts}).to_parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.sql(f"create view documents as select * from read_parquet('{tmp_path}/documents.parquet')")
    assert rows(entry.queries()["document_line_kinds"](spark, str(tmp_path)).toPandas()) == rows(con.sql(entry.oracle_sql()["document_line_kinds"]).df())


def test_numbers_before_carriage_returns(spark, tmp_path):
    # a cell is all of what stands between blanks, as in the SQL
    pd.DataFrame({"doc_id": [1, 2], "text": ["Cash 12\r\n-\r\nx 5 7\x85", "Cash 12\n- 3 "]}).to_parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.sql(f"create view documents as select * from read_parquet('{tmp_path}/documents.parquet')")
    found = entry.queries()["document_line_kinds"](spark, str(tmp_path)).toPandas()
    assert dict(zip(found["doc_id"], found["n_numbers"])) == {1: 1, 2: 2}
    assert rows(found) == rows(con.sql(entry.oracle_sql()["document_line_kinds"]).df())
