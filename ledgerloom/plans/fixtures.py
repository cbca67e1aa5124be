"""Small input tables, as VALUES relations that Spark and DuckDB both read."""

AMOUNTS = """(VALUES ('1,234'), ('(1,234.50)'), ('(-5)'), ('(5'), ('1234'), ('-'), ('–'), ('US$2.5'), ('HK$ 3'), ('₩1,000'), ('W 1,000'), ('12.50 USD'),
 ('1,23'), ('Revenue'), (''), (NULL), ('777.9'), ('-42'), ('$1,000,000'), ('krw 7'), ('2,000 W'), ('0'), ('(0.5)'),
 ('¥ 12'), ('¥123'), ('￦7'), ('₩ 7'), ('1,234	'), ('  5,000　'), ('鈧? 3'), ('2.5 锟?'), ('� 40'), ('$ (1,000)'), ('8 usd'), ('US$ 9')) AS t(raw_text)"""

HEADERS = """(VALUES (1, '(won in millions) Note 2021'), (2, '(expressed in Singapore dollars) 2019 $M 2018 $M'), (3, 'Amounts in thousands of U.S. dollars'),
 (4, 'Expressed in Korean won'), (5, 'Amounts in billions of won'), (6, 'Note 2024 $000'), (7, 'Revenue 2024 2023'), (8, 'in thousand shares; amounts in won'), (9, 'US$ 000 2023')) AS t(id, header)"""

LABELS = """(VALUES ('Basic earnings per share'), ('Revenue'), ('Weighted average number of shares'), ('Number of shares'), ('Total assets'), ('Diluted earning per unit'), ('12, 13'),
 ('12 (a)'), ('note 3'), ('Cash & cash equivalents (net)'), ('Trade – receivables'), ('  Non-current   Assets ')) AS t(label)"""

PERIODS = """(VALUES ('2024'), ('FY24 3Q'), ('Q3 2024'), ('9-Month Q3 2024'), ('2023Q1'), ('September 30, 2024'), ('30 June 2025'), ('June 30, 2025'), ('December 31, 2024'), ('Mar 31 2024'),
 ('March 31, 2022'), ('For the six-month period ended June 30 (unaudited) 2021'), ('1999'), ('Note'), (''), (NULL), ('three and nine months ended September 30, 2023'), ('as at 31 March 2021'), ('9-Month Q3 2024'), ('Six months ended June 30, 2022'), ('(12-months) Sept 30 2020')) AS t(raw_text)"""

#: doc_id, row_idx, col_idx (from 1), raw_text
SHEETS = """(VALUES ('two', 1, 1, 'Consolidated statements of financial position'), ('two', 2, 2, 'Alpha'), ('two', 2, 4, 'Beta'), ('two', 3, 2, '2022'), ('two', 3, 3, '2021'), ('two', 3, 4, '2022'),
 ('two', 3, 5, '2021'), ('two', 4, 2, '$000'), ('two', 4, 3, '$000'), ('two', 4, 4, '$000'), ('two', 4, 5, '$000'), ('two', 5, 1, 'Inventories'), ('two', 5, 2, '812'), ('two', 5, 3, '640'),
 ('two', 5, 4, '95'), ('two', 5, 5, '71'), ('two', 6, 1, 'Goodwill'), ('two', 6, 2, '30'), ('two', 6, 3, '30'), ('two', 6, 4, '-'), ('two', 6, 5, '4'), ('twin', 1, 1, 'Consolidated income statements'), ('twin', 2, 1, 'For the three-month and six-month periods ended June 30'), ('twin', 3, 2, '2019	'), ('twin', 3, 3, ' 2019'),
 ('twin', 4, 1, 'Sales '), ('twin', 4, 2, '58	'), ('twin', 4, 3, '131'), ('twin', 5, 1, 'Sales'), ('twin', 5, 2, '-'), ('twin', 5, 3, '4 '), ('one', 1, 1, 'Item'), ('one', 1, 2, '2024'), ('one', 1, 3, '2023'), ('one', 2, 1, 'Assets & rights (net)'),
 ('one', 2, 2, '5'), ('one', 2, 3, '(6)'), ('one', 3, 1, '(none)'), ('one', 3, 2, '1')) AS t(doc_id, row_idx, col_idx, raw_text)"""


def statement(doc_id: str, kind: str, rows: list) -> list[str]:
    return [f"('{doc_id}', '{kind}', {r}, {c}, '{v}')" for r, row in enumerate(rows) for c, v in enumerate(row)]


_INVESTING = ["58.4", "-", "7.1", "(912.0)", "(33.3)", "(405.7)", "(0.5)"]
_STATEMENTS = (
    statement("F8", "balance_sheet", [["Total assets", "100"], ["Total liabilities", "40"], ["Total equity", "60"], ["Total liabilities and equity", "100"]])
    + statement("F9", "balance_sheet", [["Total assets", "102"], ["Total liabilities", "40"], ["Total equity", "60"]])
    + statement("F10", "income_statement", [["Revenue", "100"], ["Cost of sales", "(70)"], ["Gross profit", "30"]])
    + statement("F10b", "income_statement", [["Sales", "100", "50"], ["Cost of sales", "70", "20"], ["Gross profit", "30", "33"]])
    + statement("F11", "cash_flow", [["Net cash provided by operating activities", "10"], ["Net cash used in investing activities", "(3)"], ["Net cash provided by financing activities", "2"], ["Effect of exchange rate changes", "1"], ["Net increase in cash", "10"], ["Cash and cash equivalents at beginning", "90"], ["Cash and cash equivalents at end", "100"]])
    + statement("F12", "cash_flow", [["Cash flows from investing activities", ""], *[[f"Item {k}", v] for k, v in enumerate(_INVESTING)], ["Net cash used in investing activities", "(1,286.0)"]])
    + statement("F13", "cash_flow", [["Cash flows from investing activities", ""], *[[f"Item {k}", v] for k, v in enumerate(_INVESTING) if v != "-"], ["Net cash used in investing activities", "(1,200.0)"]])
    + statement("F14", "cash_flow", [["Cash flows from investing activities", ""], ["Land bought", "(64)"], ["Net cash used in investing activities", "(64)"], ["Net increase in cash", "31"]])
    + statement("Q1", "balance_sheet", [["Total assets", "210\t"], ["Total liabilities and equity", "\u00a0205"]])
    + statement("Q1b", "balance_sheet", [["Total assets", "1,210\t", "\u00a0(7)\u00a0"], ["Total liabilities and equity", "\u00a01,210", "(7)"]])
    + statement("Q3", "balance_sheet", [["Total current assets", "50"], ["Total non-current assets", "70"], ["Total assets", "131"]])
    + statement("Q4", "balance_sheet", [["Total current liabilities", "20"], ["Total non-current liabilities", "30"], ["Total liabilities", "44"]])
    + statement("Q6", "cash_flow", [["Cash flows from operating activities", ""], ["Received from buyers", "90\u2003"], ["Paid out", "(20)"], ["Net cash provided by operating activities", "75"]])
    + statement("Q8", "cash_flow", [["Cash flows from financing activities", ""], ["New loans", "40"], ["Repaid", "(15)"], ["Net cash provided by financing activities", "20"]])
    + statement("Q9", "cash_flow", [["Net cash provided by operating activities", "10"], ["Net cash used in investing activities", "(3)"], ["Net cash provided by financing activities", "2"], ["Net increase in cash", "12"]])
    + statement("Q10", "cash_flow", [["Net increase in cash", "5"], ["Cash and cash equivalents at beginning", "50"], ["Changes in cash classified as assets held for sale", "(2)"], ["Cash and cash equivalents at end", "60"]])
)
#: doc_id, statement_type, row_idx, col_idx (from 0), raw_text
STATEMENTS = "(VALUES " + ", ".join(_STATEMENTS) + ") AS t(doc_id, statement_type, row_idx, col_idx, raw_text)"


def _pages(doc_id: str, texts: dict[int, str], n: int) -> list[str]:
    return [f"('{doc_id}', {p}, '{texts.get(p, 'Filler page ' + str(p))}')" for p in range(1, n + 1)]


_TITLES = ("Consolidated statements of financial position", "Consolidated income statements", "Consolidated cash flow statements")
_NUMBERS = " ".join(str(100 + k) for k in range(14))
_PAGES = (
    _pages("F16", {10: _TITLES[0], 11: _TITLES[1], 13: _TITLES[2], 25: "Appendix\nAdditional financial information", 30: _TITLES[0], 31: _TITLES[1], 33: _TITLES[2]}, 40)
    + _pages("F17", {1: "Current assets 1\nTotal assets 2\nCurrent liabilities 3\nTotal liabilities 4\nTotal equity 5", 2: "Revenue 1\nExpenses 2\nProfit for the year 3", 6: "Cash flows from operating activities 1\nNet cash 2"}, 7)
    + _pages("F18", {1: "The consolidated income statements are described in the report of the directors"}, 2)
    + _pages("F22", {1: "Consolidated Statements of Comprehensive Income (Loss)"}, 2)
    + _pages("F24", {1: "Consolidated income statements", 2: "Income tax " + _NUMBERS, 3: "Consolidated statements of changes in equity\n" + _NUMBERS}, 4)
)
#: doc_id, page_number, text
PAGES = "(VALUES " + ", ".join(_PAGES) + ") AS t(doc_id, page_number, text)"

WORDS = """(VALUES ('a', 1, 50.0, 100.0, 120.0, 'Revenue'), ('a', 1, 300.0, 100.5, 320.0, '100'), ('a', 1, 400.0, 101.0, 420.0, '90'), ('a', 1, 50.0, 120.0, 110.0, 'Cost'), ('a', 1, 112.0, 120.0, 130.0, 'of'),
 ('a', 1, 302.0, 120.0, 322.0, '70'), ('a', 1, 402.0, 121.0, 422.0, '60'), ('a', 2, 10.0, 50.0, 30.0, 'only')) AS t(doc_id, page_number, x0, y0, x1, text)"""

HTML = """(VALUES ('span', '<p>x</p><table><tr><th rowspan=2>A</th><th colspan="2">B</th></tr><tr><td>1</td><td>2</td></tr></table>'), ('two', '<TABLE><tr><td> a&amp;b <br>c</td></tr></TABLE> text <table><tr><td>lost<td>kept</td></tr></table>'),
 ('none', 'no table')) AS t(doc_id, text)"""

MARKDOWN = """(VALUES ('a', 'Intro
| Item | 2024 |
|---|:---:|
| Revenue | 1 |
| Cost | 2 |
End'), ('b', '| x |
| :-: |'), ('c', 'none'), ('d', '| one line |')) AS t(doc_id, text)"""

JSON = """(VALUES ('fenced', '```json
{"sheets":[{"name":"S","cells":[{"r":1,"c":1,"v":"a"},{"r":0,"c":1,"v":"gone"}]}]}
```'), ('prose', 'Here it is: {"sheets":[{"name":"T","cells":[{"r":2,"c":3,"v":"b"}]}]} Bye'), ('none', 'nothing')) AS t(doc_id, text)"""

RESULTS = """(VALUES ('a', 1, 'balance_sheet', 'Consolidated balance sheets', 5, 6), ('a', 2, 'income_statement', 'Consolidated income statements', 7, 7), ('a', 3, 'income_statement', 'Statements of comprehensive income', 8, 9),
 ('a', 4, 'income_statement', 'Other comprehensive income', 11, 11), ('a', 5, 'cash_flow', 'Consolidated cash flow statements', 12, 12), ('b', 1, 'income_statement', 'Comprehensive income', 3, 3), ('b', 2, 'notes', 'a/b [x]', 9, 9),
 ('b', 3, 'income_statement', 'Comprehensive income', 20, 20)) AS t(doc_id, position, statement_type, title, page_start, page_end)"""

WARNINGS = """(VALUES ('a', 'balance_sheet', 1, 'first'), ('a', 'balance_sheet', 2, 'second'), ('b', 'notes', 1, 'only')) AS t(doc_id, statement_type, seq, message)"""

REPORT_PAGES = """(VALUES ('r', 1, 'Annual Report', true), ('r', 2, 'for the year ended 30 June 2024, expressed in Australian dollars', true), ('r', 3, 'As at 30 June 2024 $M', false), ('q', 1, 'Interim', false)) AS t(doc_id, page_number, text, has_embedded_text)"""

CONFIGS = """(VALUES ('a', '{"statement_keywords":{"cash_flow":["flows"," "]}}', NULL), ('b', 'not json', '{"statement_keywords":{"cash_flow":["hidden"]}}'), ('c', '[1]', '{"statement_keywords":{"balance_sheet":["legacy"]}}'), ('d', NULL, NULL)) AS t(company, current, legacy)"""

PATHS = """(VALUES ('x/companies/ACME/f.pdf'), ('reports/q3.report.pdf'), ('plain'), ('companies/B')) AS t(path)"""

LINES = """(VALUES (1, 'Consolidated income statements'), (2, 'Interim condensed consolidated income statements, continued'), (3, 'Consolidated income statements for the year ended 2024'), (4, 'The consolidated income statements are audited'),
 (5, 'CONSOLIDATED INCOME STATEMENTS -')) AS t(id, line)"""

#: id, cells with | between them
ROWS = """(VALUES (1, 'Current assets||'), (2, 'Cash and cash equivalents|5|1,200|(7)'), (3, 'March 31, 2024|December 31, 2023'), (4, '(in millions of Korean won)'), (5, 'The accompanying notes are an integral part of it|'),
 (6, '- 12 -'), (7, '– 7 –'), (8, 'Share of the profit of associates|'), (9, 'Attributable to: owners|'), (10, 'Notes|2024|2023'), (11, '|2024|2023'), (12, 'Acme Holdings Ltd.|'), (13, 'For the three-month periodended June 30|'),
 (14, 'For the years ended|2020'), (15, 'Group|Parent entity'), (16, ''), (17, 'Total|-|–'), (18, 'Consolidated statements of cash flows'), (19, 'Retained earnings net of tax effects|'), (20, 'Deposits|USD 5|x'),
 (21, 'Profit for the period||12'), (22, 'January|1,|2024|(unaudited)'), (23, 'Approved and authorised for issue by the Board of Directors'), (24, 'a|b|c|d|e|f|g')) AS t(id, line)"""

#: doc_id, page_number, row_idx, cells with | between them
PAGE_ROWS = """(VALUES ('a', 3, 0, 'Consolidated statements of cash flows|||'), ('a', 3, 1, 'Amounts in thousands of U.S. dollars|Notes|2024|2023'), ('a', 3, 2, 'Proceeds from the sale of|||'), ('a', 3, 3, 'long-lived assets|4|1,500|2,000'), ('a', 3, 4, 'Interest|5|(250)|-'),
 ('a', 3, 5, 'Earnings per share|6|1.5|1.25'), ('a', 4, 0, 'Consolidated statements of cash flows|||'), ('a', 4, 1, '|Notes|2024|2023'), ('a', 4, 2, 'Dividends paid to all owners|$|7|750|800'), ('a', 4, 3, 'Net change|1|2'), ('a', 4, 4, 'Tax|￦||3|4'),
 ('a', 4, 5, 'The accompanying notes are an integral part'), ('a', 4, 6, '- 4 -'), ('b', 1, 0, 'Notes|note'), ('b', 1, 1, 'Only words here'), ('c', 9, 0, 'Item|NOTE|2022'), ('c', 9, 1, 'Cash on hand|2|¥ 12'), ('c', 9, 2, 'Loans|3|7,000'),
 ('c', 10, 0, 'For the year ended|2022'), ('c', 10, 1, 'notes'), ('c', 11, 0, 'Further loans granted|8'), ('d', 1, 0, 'Tax and other|1|2'), ('d', 1, 1, 'Other items of the year|'), ('d', 1, 2, 'Other items of this year:|'), ('d', 1, 3, 'x|9')) AS t(doc_id, page_number, row_idx, line)"""

RECOGNISED_ROWS = """(VALUES ('a', 4, 0, 0, 'Dividends|7|6'), ('a', 4, 0, 1, 'Fees|8|-'), ('a', 4, 2, 0, 'Other|9'), ('b', 2, 1, 0, 'New page|1')) AS t(doc_id, page_number, table_idx, row_idx, line)"""

MANIFESTS = """(VALUES ('a', '{"seen_hashes":["x","y"]}'), ('b', '{"seen_hashes":"x"}'), ('c', 'broken'), ('d', '[1]'), ('e', NULL), ('f', '{"other":1}')) AS t(company, text)"""

COLORS = """(VALUES ('#1f4e78'), ('D9EAF7'), ('#80ffFFff'), ('#fff'), (''), (NULL)) AS t(color)"""

OUTCOMES = """(VALUES ('A', 'base/in/1.pdf', 'base/out/1.xlsx', NULL), ('A', 'base/in/2.pdf', 'other/2.xlsx', NULL), ('B', 'base/in/3.pdf', 'base/out/3.xlsx', NULL), ('B', 'base/in/4.pdf', NULL, 'no table')) AS t(company, source_path, output_path, error)"""


# --- the same cases, dealt over a given table


class Given:
    """A relation of cases over the rows of documents, in SQL that both engines read: each document has the cases of one key.

    Keys are told apart by the document's id; what else a document says goes into the texts where more says so (column: expression of the
    case's column and the document d).
    """

    def __init__(self, relation: str, key: str | None = None, **more: str):
        rows, columns = relation.rsplit(" AS t(", 1)
        self.columns = columns.rstrip(")").split(", ")
        self.rows, self.key, self.more = relation, key, more

    def sql(self, name: str = "t") -> str:
        order = ", ".join(f"{c} nulls first" for c in ([self.key] if self.key else self.columns))
        number = f"dense_rank() over (order by {order}) - 1"
        many = f"(select count(*) from (select distinct {self.key or ', '.join(self.columns)} from {self.rows}))"
        ids = {"id": "d.doc_id"} | ({self.key: f"concat(f.{self.key}, '/', cast(d.doc_id as string))"} if self.key not in (None, "id") else {})
        shown = ", ".join(f"{(ids | self.more).get(c, f'f.{c}')} as {c}" for c in self.columns)
        return f"(select {shown} from (select *, doc_id % {many} as at from documents) d join (select *, {number} as nth from {self.rows}) f on d.at = f.nth) AS {name}"

    def __str__(self) -> str:
        return self.sql()


_DIGIT = "cast(coalesce(d.n_chars, 0) % 10 as string)"
_HALF = "case when d.doc_id % 2 = 0 then f.{0} else concat(f.{0}, ' ', d.source) end"


class OVER:
    """The cases above over documents."""

    AMOUNTS = Given(AMOUNTS, raw_text=f"translate(f.raw_text, '2', {_DIGIT})")
    HEADERS = Given(HEADERS, "id", header=_HALF.format("header"))
    LABELS = Given(LABELS, label=_HALF.format("label"))
    PERIODS = Given(PERIODS, raw_text=f"case when d.doc_id % 2 = 0 then f.raw_text else translate(f.raw_text, '2', {_DIGIT}) end")
    SHEETS = Given(SHEETS, "doc_id")
    STATEMENTS = Given(STATEMENTS, "doc_id")
    PAGES = Given(PAGES, "doc_id")
    WORDS = Given(WORDS, "doc_id", text="case when d.doc_id % 2 = 0 then f.text else concat(f.text, d.source) end")
    HTML = Given(HTML, "doc_id", text="replace(f.text, 'x</p>', concat(d.source, '</p>'))")
    MARKDOWN = Given(MARKDOWN, "doc_id", text="replace(f.text, 'Cost', d.source)")
    JSON = Given(JSON, "doc_id", text="replace(f.text, 'Here', d.source)")
    RESULTS = Given(RESULTS, "doc_id")
    WARNINGS = Given(WARNINGS, "doc_id", message="concat(f.message, ' of ', d.source)")
    REPORT_PAGES = Given(REPORT_PAGES, "doc_id")
    CONFIGS = Given(CONFIGS, "company", current="replace(f.current, 'flows', concat(d.source, ' flows'))")
    PATHS = Given(PATHS, path="replace(replace(f.path, 'ACME', concat('ACME', d.source)), 'q3', concat('q', cast(d.doc_id as string)))")
    LINES = Given(LINES, "id", line=_HALF.format("line"))
    ROWS = Given(ROWS, "id", line=_HALF.format("line"))
    PAGE_ROWS = Given(PAGE_ROWS, "doc_id")
    RECOGNISED_ROWS = Given(RECOGNISED_ROWS, "doc_id", line="replace(f.line, 'Fees', d.source)")
    MANIFESTS = Given(MANIFESTS, "company", text="replace(f.text, 'x', d.source)")
    COLORS = Given(COLORS, color=f"replace(f.color, '7', {_DIGIT})")
    OUTCOMES = Given(OUTCOMES, "company", source_path="replace(f.source_path, 'in/', concat('in/', cast(d.doc_id as string), '_'))")
