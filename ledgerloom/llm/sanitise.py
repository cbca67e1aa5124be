"""Information-theoretic sanitisation of personal data, with DataFrame functions only.

Base spans are e-mail addresses, IP addresses, card numbers and phone numbers.  Beyond these, the corpus tells which
terms give a protected entity away: around each base span, the nearest words are its context; over all documents,
c(t, e) counts term t in contexts of entity e, n(t) counts t anywhere, n(e) counts e.  With N words in all,

    PMI(t; e) = log2(c(t, e) * N / (n(t) * n(e)))   and   IC(e) = log2(N / n(e)),

t discloses e where PMI(t; e) >= disclosure * IC(e), given that chance does not explain c(t, e): were t's n(t)
occurrences dealt at random, each would fall in a context of e with probability q = (words in contexts of e) / N, and
the Chernoff bound exp(-n(t) * KL(c / n(t) || q)) has to be below ``chance`` over the number of pairs that are judged.
One co-occurrence is no evidence, so there are ``support`` = 2 at least.  Disclosing terms are generalised to a class label, or removed where t practically implies e (c / n(t) >= ``certain``), wherever they
occur, next to the entity or not.

A null text counts as empty; very long texts are taken whole (span positions come from two-level prefix sums, and
stretches are cut from chunks, so work grows with length, not its square, for all practical lengths); equal rows get
equal results, row by row; an empty table gives no rows; other columns, of any name, are carried along untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, stored

#: kind -> pattern.  Possessive forms match what the plain ones do, without backtracking; the look-behind or \G at
#: the start only keeps a scan from trying every suffix of a run whose first position has failed.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
KINDS = list(PATTERNS)
TERM = len(KINDS)
#: What a text must hold for a pattern to be worth trying.
_HINTS = {"email": "@", "ip": ".", "card": None, "phone": "+"}
_PART = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9]?)"
_IP = rf"^{_PART}(?:\.{_PART}){{3}}$"

WORDS, REACH, SUPPORT, CHANCE, DISCLOSURE, CERTAIN = 5, 120, 2, 0.01, 0.96, 0.95
BROADCAST_ROWS = 100_000
_NOT_WORD = r"[^\p{L}\p{N}]+"
SPANS = "array<struct<start:int,kind:int,end:int,value:string>>"


def _digits(v: Column) -> Column:
    return F.regexp_replace(v, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn test."""
    backwards = F.transform(F.split(F.reverse(digits), ""), lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(F.element_at(F.array(*[F.lit(x) for x in (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)]), d.cast("int") + 1)))
    return F.aggregate(backwards, F.lit(0), lambda a, b: a + b) % 10 == 0


def _valid(kind: str, v: Column) -> Column:
    if kind == "ip":
        return v.rlike(_IP)
    if kind == "card":
        return let(_digits(v), lambda d: F.when(F.length(d).between(12, 19), luhn(d)).otherwise(F.lit(False)))
    if kind == "phone":
        return F.length(_digits(v)).between(9, 15)
    return F.lit(True)


def _checks(kind: str):
    return lambda s: _valid(kind, s["value"])


def running(values: Column, step, zero: Column, block: int = 64) -> Column:
    """Inclusive running totals of an array by an associative step, from totals of blocks and within blocks."""
    total = lambda a: F.aggregate(a, zero, step)
    blocks = F.sequence(F.lit(0), F.floor((F.size(values) - 1) / block).cast("int"))
    piece = lambda b: F.slice(values, b * block + 1, F.lit(block))

    def within(sums: Column) -> Column:
        def of(b: Column) -> Column:
            return let(
                F.struct(piece(b).alias("v"), total(F.slice(sums, F.lit(1), b)).alias("before")),
                lambda x: F.transform(x["v"], lambda _, i: step(x["before"], total(F.slice(x["v"], F.lit(1), i + 1)))),
            )

        return F.flatten(F.transform(blocks, of))

    return F.when(F.size(values) == 0, F.array().cast("array<int>")).otherwise(let(F.transform(blocks, lambda b: total(piece(b))), within))


def running_sums(values: Column) -> Column:
    return running(values, lambda a, b: a + b, F.lit(0))


CHUNK = 4096


def chunks(text: Column) -> Column:
    """A text in chunks of CHUNK code points, from which stretches are cut without walking the whole text for each."""
    return F.regexp_extract_all(text, F.lit("(?s).{1,%d}" % CHUNK), F.lit(0))


def stretch(parts: Column, start: Column, end: Column) -> Column:
    """The code points from start to end (at most the text's) of a text in chunks."""
    first = F.floor(start / CHUNK).cast("int")
    last = F.floor(F.greatest(end - 1, start) / CHUNK).cast("int")
    return F.substr(F.array_join(F.slice(parts, first + 1, last - first + 1), ""), start - first * CHUNK + 1, F.greatest(end - start, F.lit(0)))


def _find(text: Column, pattern: Column, kind: int) -> Column:
    """All matches of pattern as SPANS, leftmost and not overlapping."""

    def placed(x: Column) -> Column:
        lengths = F.transform(x["m"], lambda m, i: F.length(m) + F.length(F.get(x["gaps"], i)))
        return let(
            running_sums(lengths),
            lambda ends: F.transform(x["m"], lambda m, i: F.struct((F.get(ends, i) - F.length(m)).alias("start"), F.lit(kind).alias("kind"), F.get(ends, i).alias("end"), m.alias("value"))),
        )

    none = F.array().cast(SPANS)
    return let(
        F.regexp_extract_all(text, pattern, F.lit(0)),
        lambda m: F.when(F.size(m) == 0, none).otherwise(let(F.struct(m.alias("m"), F.split(text, pattern, -1).alias("gaps")), placed)),
    )


def base_spans(text: Column) -> Column:
    """The base spans of a text that is not null, ordered by start, then kind."""
    found = []
    for k, kind in enumerate(KINDS):
        spans, hint = F.filter(_find(text, F.lit(PATTERNS[kind]), k), _checks(kind)), _HINTS[kind]
        found.append(F.when(F.contains(text, F.lit(hint)), spans).otherwise(F.array().cast(SPANS)) if hint else spans)
    return F.array_sort(F.concat(*found))


def _entity(s: Column) -> Column:
    value = F.when(s["kind"] == 0, F.lower(s["value"])).when(s["kind"] == 1, s["value"]).otherwise(_digits(s["value"]))
    return F.xxhash64(s["kind"], value)


def _context(parts: Column, length: Column, s: Column, words: int, reach: int) -> Column:
    """The nearest words on both sides of a span of a text in chunks; words that the reach cuts are left out."""
    # one character beyond the reach tells whether the outermost piece is a whole word; only then is there one to leave out
    at = F.greatest(s["start"] - reach - 1, F.lit(0))
    some = lambda a: F.filter(a, lambda w: w != "")
    before = F.split(F.lower(stretch(parts, at, s["start"])), _NOT_WORD, -1)
    after = F.split(F.lower(stretch(parts, s["end"], F.least(length, s["end"] + reach + 1))), _NOT_WORD, -1)
    before = let(before, lambda b: some(F.when(s["start"] > reach, F.slice(b, F.lit(2), F.size(b))).otherwise(b)))
    after = let(after, lambda a: some(F.when(length > s["end"] + reach, F.slice(a, F.lit(1), F.size(a) - 1)).otherwise(a)))
    before = let(before, lambda b: F.slice(b, F.greatest(F.size(b) - words + 1, F.lit(1)), F.lit(words)))
    after = F.slice(after, F.lit(1), F.lit(words))
    return F.filter(F.array_distinct(F.concat(before, after)), lambda w: (F.length(w) >= 3) & ~w.rlike("^[0-9]+$"))


def with_spans(documents: DataFrame, *others) -> DataFrame:
    """row (all columns, under one name, so that none can clash), others, body (the text, null as empty) and base (SPANS)."""
    return documents.select(F.struct("*").alias("row"), F.coalesce("text", F.lit("")).alias("body"), *others).withColumn("base", base_spans(F.col("body")))


def disclosing_terms(
    documents: DataFrame, words: int = WORDS, reach: int = REACH, support: int = SUPPORT, chance: float = CHANCE, disclosure: float = DISCLOSURE, certain: float = CERTAIN
) -> DataFrame:
    """term, kind (of the entity it gives away most surely) and certain, from counts over all documents."""
    marked = with_spans(documents.select("text")).where(F.size("base") > 0)
    near = F.transform("base", lambda s: F.struct(_entity(s).alias("entity"), s["kind"].alias("kind"), _context(F.col("parts"), F.col("length"), s, words, reach).alias("terms")))
    spans = marked.select("base", chunks(F.col("body")).alias("parts"), F.length("body").alias("length")).select(F.explode(near).alias("s")).select("s.*")
    spans = stored(spans, "contexts")
    entities = spans.groupBy("entity").agg(F.count("*").alias("n_e"), F.sum(F.size("terms")).alias("slots"))
    every = stored(spans.select("entity", "kind", F.explode("terms").alias("term")).groupBy("entity", "kind", "term").agg(F.count("*").alias("c")), "pairs")
    tests = max(every.count(), 1)
    pairs = stored(every.where(F.col("c") >= support).join(entities, "entity"), "cooccurrence")
    candidates = pairs.select("term").distinct()
    tokens = documents.select(F.explode(F.split(F.lower("text"), _NOT_WORD)).alias("term")).where(F.col("term") != "")
    seen = tokens.join(small(candidates), "term", "left_semi").groupBy("term").agg(F.count("*").alias("n_t"))
    total = documents.agg(F.sum(F.size(F.split("text", _NOT_WORD)))).first()[0] or 1
    scored = pairs.join(seen, "term").withColumn("n", F.lit(total).cast("double"))
    sure = F.least(F.col("c") / F.col("n_t"), F.lit(1.0))
    ic = F.log2(F.col("n") / F.col("n_e"))
    q = F.least(F.col("slots") / F.col("n"), F.lit(1.0))
    part = lambda x, y: F.when(x <= 0, 0.0).when(y <= 0, float("inf")).otherwise(x * F.log(x / y))
    unlikely = F.when(sure > q, F.col("n_t") * (part(sure, q) + part(1 - sure, 1 - q))).otherwise(0.0)
    shown = scored.where((ic + F.log2(sure) >= disclosure * ic) & (unlikely >= F.log(F.lit(tests / chance))))
    best = shown.groupBy("term").agg(F.max(F.struct(sure.alias("p"), -F.col("kind"))).alias("b"))
    return best.select("term", (-F.col("b").getField("col2")).alias("kind"), (F.col("b.p") >= certain).alias("certain"))


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """df, stored, with a broadcast hint where it has few enough rows; beyond that, joins shuffle."""
    kept = stored(df, "small")
    return F.broadcast(kept) if kept.count() <= rows else kept


def find(documents: DataFrame, **options) -> DataFrame:
    """row (the document), body (its text, null as empty), base, spans (base and term spans in order) and removed (terms to
    remove, others generalise).

    The terms of a document come by a join of its distinct words with the disclosing terms.
    """
    terms = small(disclosing_terms(documents, **options))
    copy = F.xxhash64("doc_id", "text").alias("copy")
    words = documents.select(copy, F.explode(F.array_distinct(F.split(F.lower("text"), _NOT_WORD))).alias("term"))
    found = words.join(terms, "term").groupBy("copy").agg(F.collect_set(F.struct("term", "certain")).alias("terms"))
    joined = with_spans(documents, copy).join(small(found), "copy", "left")
    names = F.transform(F.sort_array("terms"), lambda t: t["term"])
    pattern = F.concat(F.lit(r"(?iu)(?<![\p{L}\p{N}])(?:"), F.array_join(names, "|"), F.lit(r")(?![\p{L}\p{N}])"))
    by_term = F.when(F.col("terms").isNull(), F.array().cast(SPANS)).otherwise(_find(F.col("body"), pattern, TERM))
    removed = F.transform(F.filter(F.coalesce("terms", F.array().cast("array<struct<term:string,certain:boolean>>")), lambda t: t["certain"]), lambda t: t["term"])
    return joined.select("row", "body", "base", F.array_sort(F.concat("base", by_term)).alias("spans"), removed.alias("removed"))


def _listed(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in [*KINDS, "term"]])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])), ",")


def report(documents: DataFrame, **options) -> DataFrame:
    """doc_id, counts by kind, base_sha256, spans, n_term and has_private (whether there is any span) per document."""
    found = find(documents.select("doc_id", "text"), **options)
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")
    return found.select(
        F.col("row.doc_id").alias("doc_id"),
        *[count(k).alias(f"n_{kind}") for k, kind in enumerate(KINDS)],
        F.sha2(_listed(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        _listed(F.col("spans")).alias("spans"),
        count(TERM).alias("n_term"),
        (F.size("spans") > 0).alias("has_private"),
    )


def _label(s: Column, removed: Column) -> Column:
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in [*KINDS, "term"]])
    return F.when((s["kind"] == TERM) & F.array_contains(removed, F.lower(s["value"])), "").otherwise(F.element_at(names, s["kind"] + 1))


def sanitise(documents: DataFrame, **options) -> DataFrame:
    """documents with every span replaced by its class label, or removed; n_chars follows, where there is one.

    Overlapping spans become one stretch, labelled as its first span.
    """
    found = find(documents, **options)
    # where the stretches before each span end; a span that starts inside one is part of it
    upto = lambda x, i: F.when(i == 0, 0).otherwise(F.get(x["reach"], i - 1))

    def written(x: Column) -> Column:
        piece = lambda s, i: F.when(s["start"] >= upto(x, i), F.concat(stretch(x["parts"], upto(x, i), s["start"]), _label(s, F.col("removed")))).otherwise("")
        tail = stretch(x["parts"], F.element_at(x["reach"], -1), F.length("body"))
        return F.concat(F.array_join(F.transform("spans", piece), ""), tail)

    ends = F.transform("spans", lambda s: s["end"])
    reach = running(ends, lambda a, b: F.greatest(a, b), F.lit(0))
    none = F.size("spans") == 0
    text = F.when(none, F.col("row.text")).otherwise(let(F.struct(reach.alias("reach"), chunks(F.col("body")).alias("parts")), written))
    out = found.withColumn("text", text)
    n_chars = F.when(none, F.col("row").getField("n_chars")).otherwise(F.length("text").cast("long")) if "n_chars" in documents.columns else None
    named = {"text": F.col("text"), "n_chars": n_chars}
    return out.select(*[named.get(c, F.col("row").getField(c)).alias(c) for c in documents.columns])
