"""Reporting periods from header text as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerloom.functions import numbers

# Period forms, in order of precedence.
QUARTER = r"(?i)\b(?:(\d{1,2})\s*-\s*months?\s+)?Q([1-4])\s*(20\d{2})\b"
YEAR_QUARTER = r"(?i)\b(20\d{2})\s*Q([1-4])\b"
FISCAL = r"(?i)\bFY(\d{2})\s*([1-4])Q\b"
DATE = r"(?i)\b(march|june?|sept(?:ember)?)\s+([0-3]?\d)\b[^0-9]{0,80}\b(20\d{2})\b"
DATE_HINT = r"(?i)march|june?|sept"
YEAR = r"\b(20\d{2})\b"
MONTH = (
    r"(?i)\b(jan(uary)?|feb(ruary)?|mar(ch)?|apr(il)?|may|june?|july?|aug(ust)?|sep(t(ember)?)?|oct(ober)?|nov(ember)?|dec(ember)?)\b"
)
DURATIONS = {"three": 3, "six": 6, "nine": 9, "twelve": 12}
CONTEXT_QUARTERS = ((r"\bsept?(ember)?\s+30\b", 3), (r"\bjune?\s+30\b", 2), (r"\bmar(ch)?\s+31\b", 1))


def _part(c: Column, pattern: str, group: int) -> Column:
    return F.nullif(F.regexp_extract(c, pattern, group), F.lit("")).cast("int")


def duration_months(text: Column) -> Column:
    """The one length in months that a text names; 0 where it names none or several."""

    def told(low: Column) -> Column:
        named = [F.when(low.rlike(rf"\b{w}[-\s]months?\b"), F.lit(n)) for w, n in DURATIONS.items()]
        counted = F.transform(F.regexp_extract_all(low, F.lit(r"\b(3|6|9|12)[-\s]months?\b"), F.lit(1)), lambda x: x.cast("int"))
        found = F.array_distinct(F.concat(F.array_compact(F.array(*named)), counted))
        return numbers._once(found, lambda x: F.when(F.size(x) == 1, F.get(x, 0)).otherwise(0))

    return numbers._once(F.lower(numbers.squeeze(text)), told)


def quarter_label(year: Column, quarter: Column, months: Column) -> Column:
    base = F.concat(F.lit("Q"), quarter, F.lit(" "), year)
    return F.when(months > 0, F.concat(months, F.lit("-Month "), base)).otherwise(base)


def _quarter(year: Column, quarter: Column, months: Column) -> Column:
    return F.struct(
        quarter_label(year, quarter, months).alias("label"), F.lit("quarter").alias("kind"), year.alias("year"), quarter.alias("quarter"), months.alias("months")
    )


def _annual(year: Column) -> Column:
    return F.struct(year.cast("string").alias("label"), F.lit("annual").alias("kind"), year.alias("year"), F.lit(0).alias("quarter"), F.lit(0).alias("months"))


def parse(c: Column) -> Column:
    """struct(label, kind, year, quarter, months) of a header cell, or null."""
    return numbers._once(numbers.squeeze(c), _parse)


def _parse(t: Column) -> Column:
    """parse() of a squeezed text; each form's parts are arguments, so that a plan holds a pattern once."""
    once, none = numbers._once, F.lit(0)
    spaced = F.regexp_replace(F.replace(t, F.lit("("), F.lit(" (")), r"\s+", " ")

    def dated(s: Column) -> Column:
        month, day = F.lower(F.regexp_extract(s, DATE, 1)), _part(s, DATE, 2)
        quarter = once(
            F.struct(month.alias("month"), day.alias("day")),
            lambda d: F.when(d["month"].startswith("mar") & (d["day"] == 31), 1).when(d["month"].startswith("jun") & (d["day"] == 30), 2).when(d["month"].startswith("sep") & (d["day"] == 30), 3),
        )
        return once(quarter, lambda q: F.when(q.isNotNull(), once(F.struct(_part(s, DATE, 3).alias("year"), duration_months(s).alias("months")), lambda d: _quarter(d["year"], q, d["months"]))))

    def quarters(pattern: str, year: int, quarter: int, months: int | None = None, century: int = 0) -> Column:
        parts = F.struct((_part(t, pattern, year) + century).alias("year"), _part(t, pattern, quarter).alias("quarter"), (F.coalesce(_part(t, pattern, months), none) if months else none).alias("months"))
        return F.when(t.rlike(pattern), once(parts, lambda p: _quarter(p["year"], p["quarter"], p["months"])))

    return F.coalesce(
        quarters(QUARTER, 3, 2, 1), quarters(YEAR_QUARTER, 1, 2), quarters(FISCAL, 1, 2, century=2000), F.when(t.rlike(DATE_HINT), once(spaced, dated)),
        F.when(t.rlike(YEAR), once(_part(t, YEAR, 1), _annual)),
    )


def in_context(c: Column, context: Column) -> Column:
    """parse(c), where a bare year becomes the quarter that the header context names."""

    def quarter(low: Column) -> Column:
        q = F.lit(None).cast("int")
        for pattern, n in reversed(CONTEXT_QUARTERS):
            q = F.when(low.rlike(pattern), F.lit(n)).otherwise(q)
        return q

    def promote(p: Column) -> Column:
        named = lambda q: F.when(q.isNotNull(), numbers._once(duration_months(context), lambda m: _quarter(p["year"], q, m))).otherwise(p)
        return F.when((p["kind"] == "annual") & ~c.rlike(MONTH), numbers._once(numbers._once(F.lower(numbers.squeeze(context)), quarter), named)).otherwise(p)

    return numbers._once(parse(c), promote)


def sort_key(p: Column) -> Column:
    """What a period is put in order by; p is worked out once, which also keeps plans short."""
    return numbers._once(p, lambda x: F.struct(x["year"].alias("year"), x["quarter"].alias("quarter"), x["months"].alias("months")))
