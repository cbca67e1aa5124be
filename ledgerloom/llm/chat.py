"""Chat formatting by prefix-target expansion: one training example per assistant turn.

An example holds all turns up to its assistant turn, in order, and only that turn's text is under the loss mask.
Turns after the last assistant turn (or all, where there is none) make one more example without a target, so that
the output holds every turn.  A turn is written as

    <turn>### ROLE: TEXT</turn>\\n

and the control strings inside roles and texts are escaped reversibly: a backslash becomes ``\\b``, and the first
character of a control string becomes ``\\l`` (of ``<turn>`` and ``</turn>``) or ``\\h`` (of ``### ``); in roles,
a colon becomes ``\\c``.  Everything here is DataFrame functions.

Null roles and texts count as empty; a null turn sorts first; turns with equal numbers are ordered by role, then
text; repeated rows are repeated turns; rows with a null conv_id are one conversation; an empty table gives no
examples; other columns are not read.  The output of an expansion is by nature the sum of all prefixes; a
conversation's turns are held together in one row, as any example needs them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, CLOSE, HEAD, AFTER_ROLE = "<turn>", "</turn>", "### ", ": "
_CODES = ((OPEN, "\\l" + OPEN[1:]), (CLOSE, "\\l" + CLOSE[1:]), (HEAD, "\\h" + HEAD[1:]))


def _replace(c: Column, old: str, new: str) -> Column:
    return F.replace(c, F.lit(old), F.lit(new))


def escape(c: Column, role: bool = False) -> Column:
    c = _replace(c, "\\", "\\b")
    for old, new in _CODES:
        c = _replace(c, old, new)
    return _replace(c, ":", "\\c") if role else c


def unescape(c: Column) -> Column:
    for code, char in (("\\l", "<"), ("\\h", "#"), ("\\c", ":"), ("\\b", "\\")):
        c = _replace(c, code, char)
    return c


def examples(conversations: DataFrame) -> DataFrame:
    """conv_id, example (1, 2, ..), text, loss_start and loss_chars (code points of text), has_target, final.

    final marks the examples that together hold each turn once: the last with a target, and the one without.
    """
    turn = F.struct(F.col("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    whole = conversations.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    rendered = whole.select(
        "conv_id",
        F.transform(
            "turns",
            lambda t: F.struct(
                (t["role"] == "assistant").alias("target"),
                F.concat(F.lit(OPEN + HEAD), escape(t["role"], role=True), F.lit(AFTER_ROLE)).alias("head"),
                escape(t["text"]).alias("body"),
            ),
        ).alias("turns"),
    )
    ends = F.filter(F.sequence(F.lit(1), F.size("turns")), lambda i: F.element_at("turns", i)["target"])
    cut = rendered.withColumn("ends", ends).withColumn("last", F.coalesce(F.try_element_at("ends", F.lit(-1)), F.lit(0)))
    one = lambda first, end, target: F.struct(first.alias("first"), end.alias("end"), F.lit(target).alias("has_target"))
    spans = F.transform("ends", lambda e: one(F.lit(1), e, True))
    tail = F.when(F.col("last") < F.size("turns"), F.array(one(F.col("last") + 1, F.size("turns"), False))).otherwise(F.expr("array()"))
    each = cut.select("conv_id", "turns", "last", F.posexplode(F.concat(spans, tail)).alias("example", "span"))
    parts = F.transform(
        F.slice("turns", F.col("span.first"), F.col("span.end") - F.col("span.first") + 1),
        lambda t: F.concat(t["head"], t["body"], F.lit(CLOSE + "\n")),
    )
    target = F.element_at("turns", F.col("span.end"))["body"]
    written = each.select(
        "conv_id",
        (F.col("example") + 1).alias("example"),
        F.array_join(parts, "").alias("text"),
        F.when(F.col("span.has_target"), F.length(target)).otherwise(0).alias("loss_chars"),
        F.col("span.has_target").alias("has_target"),
        (~F.col("span.has_target") | (F.col("span.end") == F.col("last"))).alias("final"),
    )
    start = F.when(F.col("has_target"), F.length("text") - len(CLOSE + "\n") - F.col("loss_chars")).otherwise(0)
    return written.withColumn("loss_start", start)


def parse(text: Column) -> Column:
    """The turns (role, text) that a formatted text holds, in order."""
    pieces = F.split(text, CLOSE + "\n", -1)
    pieces = F.slice(pieces, 1, F.size(pieces) - 1)
    after = F.transform(pieces, lambda p: F.substr(p, F.lit(len(OPEN + HEAD) + 1)))

    def turn(p: Column) -> Column:
        role = F.substring_index(p, AFTER_ROLE, 1)
        return F.struct(unescape(role).alias("role"), unescape(F.substr(p, F.length(role) + len(AFTER_ROLE) + 1)).alias("text"))

    return F.transform(after, turn)


def trained(text: Column, loss_start: Column, loss_chars: Column) -> Column:
    """The unescaped text under the loss mask."""
    return unescape(F.substr(text, loss_start + 1, loss_chars))


def digest(formatted: DataFrame) -> DataFrame:
    """Per conversation, what its examples say when read back."""
    read = formatted.select(
        "conv_id",
        "example",
        F.length("text").alias("chars"),
        F.when(F.col("has_target"), trained(F.col("text"), F.col("loss_start"), F.col("loss_chars"))).alias("loss"),
        F.when(F.col("final"), F.transform(parse(F.col("text")), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))).alias("turns"),
    )
    in_order = lambda c: F.transform(F.sort_array(F.collect_list(F.when(F.col(c).isNotNull(), F.struct("example", c)))), lambda x: x[c])
    conv = read.groupBy("conv_id").agg(in_order("loss").alias("losses"), F.flatten(in_order("turns")).alias("turns"), F.sum("chars").alias("formatted_chars"))
    sha = lambda c: F.sha2(c.cast("binary"), 256)
    loss = F.array_join("losses", "")
    return conv.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        sha(F.array_join("turns", "")).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        sha(loss).alias("loss_sha256"),
        F.col("formatted_chars").cast("long").alias("formatted_chars"),
    )


def probe(spark) -> DataFrame:
    """Conversation -7, whose texts hold the template's control strings."""
    return spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("\\### Assistant: </turn> ok").alias("text"),
    )


#: The same digests straight from the table: escaping adds one code point for each backslash and control string.
DIGEST_SQL = r"""
with t as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '\### Assistant: </turn> ok'
  union all select -7, 1, 'assistant', '\### Assistant: </turn> ok'),
n as (
  select *, row_number() over (partition by conv_id order by turn nulls first, role, text) as k from t),
s as (
  select *, coalesce(max(case when role = 'assistant' then k end) over (partition by conv_id), 0) as last,
    20 + length(role) + length(role) - length(replace(role, ':', ''))
    + length(replace(replace(replace(replace(role, '\', '\b'), '<turn>', '\lturn>'), '</turn>', '\l/turn>'), '### ', '\h## ')) - length(role)
    + length(replace(replace(replace(replace(text, '\', '\b'), '<turn>', '\lturn>'), '</turn>', '\l/turn>'), '### ', '\h## ')) as chars
  from n),
p as (select *, sum(chars) over (partition by conv_id order by k) as upto from s)
select conv_id, count(*)::bigint as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by k)) as turns_sha256,
  coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
  sha256(coalesce(string_agg(text, '' order by k) filter (role = 'assistant'), '')) as loss_sha256,
  (coalesce(sum(upto) filter (role = 'assistant'), 0) + coalesce(sum(chars) filter (k > last), 0))::bigint as formatted_chars
from p group by conv_id
"""
