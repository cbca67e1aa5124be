"""Amounts, units and currencies as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

AMOUNT = "decimal(28,8)"
SCALE = "decimal(11,6)"

# Number forms and currency marks.  The forms differ on purpose, each operator has its own.
TOKEN = r"^(\(?-?([0-9]+|[0-9]{1,3}(,[0-9]{3})+)(\.[0-9]+)?\)?|-)$"
TABLE_NUMBER = r"^(\(?-?\$?[0-9][0-9,]*(\.[0-9]+)?\)?|-)$"
SHEET_NUMBER = r"^(\(?-?[0-9]+(\.[0-9]+)?\)?|-)$"
#: Every text of one of these forms, or a dash, has one of these.
DIGITS = "[0-9–-]"
STRICT = r"^-?[0-9]+(\.[0-9]+)?$"
MARKS = r"(US\$|HK\$|KRW|USD|\$|￦|₩|¥|鈧\?|锟\?|�)"
GLYPHS = "¥￦₩"
GLYPH_NUMBER = "^[¥￦]SPACE*[0-9]{1,2}$"
#: White space as Python knows it, as a class of the characters themselves, which both regular expression engines read.
SPACES = "\t\n\x0b\f\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
SPACE = f"[{SPACES}]"
PER_SHARE = r"(\bper share\b|\bearnings? per\b|\bnumber of shares?\b|\bweighted average\b)"
_IN = r"\b(in|expressed in|amounts? in)[^.;:()]{0,80}\b"
#: Unit rules in order of precedence; the first that a header matches gives its scale to millions.
SCALES = (
    (r"(^|[^a-z0-9])(\$|us\$|hk\$|krw|won|w|₩)\s*m\b", "1"),
    (r"((^|[^a-z0-9])(\$|us\$|hk\$|krw|won|w|₩)\s*000\b|\$000\b)", "0.001"),
    (_IN + r"thousands?\b", "0.001"),
    (_IN + r"billions?\b", "1000"),
    (_IN + r"millions?\b", "1"),
    (_IN + r"(won|dollars?|usd|krw)\b", "0.000001"),
)


def strip(c: Column) -> Column:
    """c without white space of any kind at either end."""
    return F.trim(c, F.lit(SPACES))


def squeeze(c: Column) -> Column:
    """c stripped, with single blanks inside."""
    return F.regexp_replace(strip(c), f"{SPACE}+", " ")


def cell_text(c: Column) -> Column:
    """A cell without currency glyphs and outer white space; a glyph before one or two digits alone is kept."""
    return F.when(strip(c).rlike(GLYPH_NUMBER.replace("SPACE", SPACE)), strip(c)).otherwise(strip(F.translate(c, GLYPHS, "")))


def number_text(c: Column) -> Column:
    """A cell without a currency mark, and then a W, at either end."""
    return strip(F.regexp_extract(strip(c), rf"(?is)^(?:{MARKS}{SPACE}*)?(?-i:W )?(.*?)(?-i: W)?(?:{SPACE}*{MARKS})?$", 2))


def _signed(text: Column, bare: Column) -> Column:
    value = bare.try_cast(AMOUNT)
    return F.when(text.startswith("(") & text.endswith(")"), -value).otherwise(value)


def _once(value: Column, body) -> Column:
    """body(value) with value computed once per row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def amount(c: Column, scale: Column | None = None) -> Column:
    """The amount that a cell stands for, or null where it stays text (four bare digits, dashes, words, a yen or won sign
    before one or two digits).

    Parentheses on both sides negate, even an amount that is negative already.
    """

    def read(token: Column) -> Column:
        value = _signed(token, F.translate(token, "(),", ""))
        return F.when(token.rlike(TOKEN), value)

    def cell(text: Column) -> Column:
        keeps_text = text.rlike("^[0-9]{4}$|" + GLYPH_NUMBER.replace("SPACE", SPACE))
        return F.when(text.rlike("[0-9]") & ~keeps_text, _once(number_text(text), read))

    value = _once(cell_text(c), cell)
    return value if scale is None else (value * scale.cast(SCALE)).cast(AMOUNT)


def checked_amount(c: Column) -> Column:
    """The reading that reconciliation uses: a dash is missing, four digits are a number."""
    text = strip(c)
    bare = strip(F.translate(F.regexp_replace(text, r"^[()]+|[()]+$", ""), ",$₩W", ""))
    return F.when(bare.rlike(STRICT), _signed(text, bare))


def lenient_number(c: Column) -> Column:
    """All but digits, points and minus signs dropped; null where no number is left."""
    return F.regexp_replace(c, r"[^0-9.\-]", "").try_cast("double")


def scale_of(header: Column) -> Column:
    """The factor to millions that a header's text asks for."""
    text = F.regexp_replace(F.lower(header), f"{SPACE}+", " ")
    out = F.lit(None).cast(SCALE)
    for pattern, scale in reversed(SCALES):
        out = F.when(text.rlike(pattern), F.lit(scale).cast(SCALE)).otherwise(out)
    return F.coalesce(out, F.lit("1").cast(SCALE))


def in_millions(c: Column) -> Column:
    """A header's unit words, rewritten to millions."""
    money = r"((?:korean\s+)?won|krw|(?:u\.s\.\s+)?dollars?|usd)\b"
    c = F.regexp_replace(c, r"(?i)\bin\s+(thousands?|billions?)\b", "in millions")
    c = F.regexp_replace(c, rf"(?i)\b(expressed|amounts?)\s+in\s+{money}", "$1 in millions of $2")
    return F.regexp_replace(c, r"(?i)\$000\b", r"\$m")


def not_monetary(label: Column) -> Column:
    return F.lower(strip(label)).rlike(PER_SHARE)


def holds_digits(c: Column) -> Column:
    """Whether a text has a digit or a dash, without which nothing in it is an amount or a number."""
    return c.rlike(DIGITS)


def is_amount_token(c: Column) -> Column:
    # most cells are words, which need no more than one look
    amount = lambda token: token.isin("-", "–") | (token.rlike(TOKEN) & (token != "-"))
    return F.when(holds_digits(c), _once(number_text(c), amount)).otherwise(F.lit(False))


def sheet_numeric(c: Column) -> Column:
    return F.translate(strip(c), ", ", "").rlike(SHEET_NUMBER)


def table_numeric(c: Column) -> Column:
    # the JVM's $ also matches before a last line end, as in cells at the end of lines that end in \r\n
    return F.replace(c, F.lit(","), F.lit("")).rlike(TABLE_NUMBER.removesuffix("$") + r"\z")


def is_integral(v: Column) -> Column:
    return v == F.floor(v)


def numeric_cells(cells: Column) -> Column:
    """How many cells of an array are numbers as tables print them."""
    return F.size(F.filter(cells, lambda c: (c != "") & table_numeric(c)))


def within(a: Column, b: Column, tolerance: Column) -> Column:
    return F.abs(a - b) <= tolerance
