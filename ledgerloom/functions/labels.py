"""Line-item labels, headings and page text as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerloom.functions import numbers

# Predicates on labels and page heads.
NOTE_CELL = r"^[0-9]+(\s*,\s*[0-9]+)*(\s*\([A-Za-z]\))?$"
NOTES_HEAD = r"^notes to the (interim condensed )?consolidated financial statements"
REFERENCE_HEAD = (
    r"(contents|index to consolidated financial statements|independent auditor|basis for opinions|report on review"
    r"|responsibilities of management|internal control over financial reporting)"
)
EQUITY_TITLE = r"\bconsolidated\s+statements?\s+of\s+changes\s+in\s+equity\b"
SUPPLEMENT = (
    r"\b(appendix|appendices|supplementary|additional financial information|parent entity|company financial statements"
    r"|statutory financial statements|trust financial statements)\b|附件|附录"
)
TITLES = {
    "balance_sheet": (r"\bconsolidated\s+statements?\s+of\s+financial\s+position\b", r"\bconsolidated\s+balance\s+sheets?\b"),
    "income_statement": (
        r"\bconsolidated\s+income\s+statements?\b",
        r"\bconsolidated\s+statements?\s+of\s+(?:profit\s+or\s+loss|operations|earnings)\b",
        r"\bconsolidated\s+statements?\s+of\s+comprehensive\s+income(?:\s+(?:or\s+loss|\(?loss\)?))?(?=$|\s|[,:;-])",
    ),
    "cash_flow": (r"\bconsolidated\s+cash\s+flow\s+statements?\b", r"\bconsolidated\s+statements?\s+of\s+cash\s+flows?\b"),
}
#: By what is looked for, groups of terms, of each of which a page has to have one.
TERMS = {
    "balance_sheet": (("current assets",), ("total assets",), ("current liabilities",), ("total liabilities",), ("equity", "net assets")),
    "income_statement": (("revenue",), ("profit for the year", "profit for the period", "loss for the year", "loss for the period"), ("expenses", "income tax")),
    "cash_flow": (("cash flows from operating activities",), ("cash flows from investing activities", "cash flows from financing activities", "net cash")),
    "equity table": (
        ("balance at 1 july", "balance at the beginning"), ("issued capital", "retained earnings", "total reserves"),
        ("attributable to securityholders", "attributable to unitholders", "attributable to owners")),
    "more balance_sheet": (("total assets", "total liabilities", "current assets", "non-current assets", "current liabilities", "non-current liabilities", "total equity"),),
    "more income_statement": (("profit for the", "loss for the", "income tax", "total comprehensive income", "earnings per"),),
    "more cash_flow": (("cash flows from", "net cash", "cash and cash equivalents"),),
}
#: The numbers of a page, and how many a page has that goes on with a statement.
PAGE_NUMBERS, LEAST_PAGE_NUMBERS = r"(\(?-?[0-9][0-9,]*\.?[0-9]*\)?)", 12
TYPES = list(TITLES)


def item_key(label: Column) -> Column:
    """A label as the key it merges on: lower case, & as and, no parenthesised parts, words of letters and digits."""
    c = F.replace(F.lower(label), F.lit("&"), F.lit("and"))
    c = F.regexp_replace(c, r"\([^)]*\)", "")
    return F.trim(F.regexp_replace(c, "[^a-z0-9]+", " "))


def checked_label(label: Column) -> Column:
    """The form in which reconciliation compares labels."""
    return F.regexp_replace(numbers.squeeze(F.lower(label)), "[–—]", "-")


def is_note(c: Column) -> Column:
    return numbers.strip(c).rlike(NOTE_CELL)


def lines(text: Column) -> Column:
    """A page's lines that are not blank, with single blanks inside."""
    flat = F.replace(F.translate(text, "\xa0", " "), F.lit("’"), F.lit("'"))
    each = F.transform(F.split(flat, "\r\n|[\n\r\x0b\f]"), lambda x: F.trim(F.regexp_replace(x, "[ \t]+", " ")))
    return F.filter(each, lambda x: x != "")


def head(text: Column, n: int) -> Column:
    return F.slice(lines(text), 1, n)


def flat(text: Column) -> Column:
    """A page as one lower-case line."""
    return F.lower(F.array_join(lines(text), " "))


def is_notes_page(text: Column) -> Column:
    return F.exists(head(text, 8), lambda x: F.lower(x).rlike(NOTES_HEAD))


def is_reference_page(text: Column) -> Column:
    return F.lower(F.array_join(head(text, 10), " ")).rlike(REFERENCE_HEAD)


def fits(one_line: Column, what: str) -> Column:
    """Whether a page's line has a term of every group of TERMS[what]."""
    return F.forall(F.array(*[F.array(*map(F.lit, group)) for group in TERMS[what]]), lambda group: F.exists(group, lambda term: F.contains(one_line, term)))


def not_a_target(text: Column) -> Column:
    return F.lower(F.array_join(head(text, 8), " ")).rlike(EQUITY_TITLE) | fits(flat(text), "equity table")


def inferred_type(text: Column) -> Column:
    """The statement that a page without a title holds by its words, or null; the first of TYPES if it fits several."""
    line = flat(text)
    return F.coalesce(*[F.when(fits(line, kind), kind) for kind in TYPES])


def continues(text: Column, kind: Column) -> Column:
    """Whether a page goes on with a statement of that kind: enough numbers, and a term of it."""
    count = F.size(F.regexp_extract_all(text, F.lit(PAGE_NUMBERS), F.lit(1)))
    term = F.coalesce(*[F.when(kind == k, fits(F.lower(text), f"more {k}")) for k in TYPES], F.lit(False))
    return (count >= LEAST_PAGE_NUMBERS) & ~fits(flat(text), "equity table") & term


def stands_alone(line: Column, title: Column) -> Column:
    """Whether a line is a heading with that title: alone, after interim or condensed, continued, or before a date."""
    low, want = numbers.squeeze(F.lower(line)), numbers.squeeze(F.lower(title))
    rest = F.when(low.startswith(want), F.substr(low, F.length(want) + 1)).otherwise(low)
    rest = F.regexp_replace(rest, "^[ :\\-–—]+|[ :\\-–—]+$", "")
    before = F.regexp_replace(F.regexp_replace(low, r"\s*,?\s*continued$", ""), r"^(interim\s+)?(condensed\s+)?", "")
    return (low == want) | (before == want) | (rest == "") | rest.rlike(r"^(as at|as of|for the years? ended|for the periods? ended).+$")


def safe_name(c: Column) -> Column:
    return F.substr(F.regexp_replace(F.regexp_replace(c, r"[^\p{L}\p{N}_-]", "_"), "^_+|_+$", ""), F.lit(1), F.lit(80))


def column_letters(n: Column) -> Column:
    """1 is A, 26 Z, 27 AA, up to three letters."""
    letter = lambda k: F.chr(k + 65)
    m = n - 1
    two, three = F.floor(m / 26), F.floor((m - 26) / 676)
    return F.concat(
        F.when(n > 702, letter((three - 1) % 26 + 0 * m)).otherwise(""),
        F.when(n > 26, letter((two - 1) % 26)).otherwise(""),
        letter(m % 26),
    )


def in_grey_band(score: Column) -> Column:
    """Whether a similarity is neither a match nor a miss."""
    return score.between(0.6, 0.9)


def conflict_column(period: Column, report: Column) -> Column:
    """The column for an amount of a report that contradicts an earlier one."""
    return F.concat(period, F.lit(" Conflict - "), report)


def argb(color: Column) -> Column:
    """#RRGGBB (or RRGGBB) as an opaque ARGB colour, eight digits as they are, null for other lengths."""
    bare = F.upper(F.regexp_replace(F.trim(color), "^#", ""))
    return F.when(F.length(bare) == 6, F.concat(F.lit("FF"), bare)).when(F.length(bare) == 8, bare)
