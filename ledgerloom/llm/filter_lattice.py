"""How filters take from each other: what every order of some filters would remove, from one pass over the documents.

The filters' order only matters through the set of filters that have been applied already.  Each document adds to the edges
(set applied already, next filter) of the lattice of sets, 80 edges for five filters; an order is a path of edges from the
empty set to the full one, so its steps are looked up among the summed edges.  Documents are summed by the set of filters
that they fail before they are dealt to edges, so that what is exploded has at most 32 classes per part and label.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import digest_runs

FILTERS = "ABCDE"
COUNTS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost"]
SPACE = r"[\x20\x09-\x0D]+"


def failures(text: Column) -> Column:
    """The set of filters A to D that a text fails, one bit each."""
    words = F.filter(F.split(text, SPACE), lambda w: w != "")
    few = F.size(words) < 200
    repeats = 100 * F.size(F.array_distinct(words)) < 50 * F.size(words)
    capitals = 100 * F.regexp_count(text, F.lit("[A-Z]")) > 3 * F.length(text)
    signs = text.rlike("[#$%&*|]")
    return sum((F.when(test, 1 << i).otherwise(0) for i, test in enumerate([few, repeats, capitals, signs])), F.lit(0)).cast("int")


def classes(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """part, mask (the filters that documents fail), good, toxic and the number n of such documents."""
    text = F.coalesce(documents["text"], F.lit(""))
    carried = [documents["doc_id"], F.coalesce(documents["lang"], F.lit("")).alias("part"), failures(text).alias("fails")]
    copies = digest_runs.marked(digest_runs.runs(documents, text, carried))
    again = F.coalesce(F.col("doc_id") > F.col("keep_id"), F.lit(False))
    mask = F.col("fails") + F.when(again, 1 << FILTERS.index("E")).otherwise(0)
    told = labels.groupBy("doc_id").agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
    marks = [F.coalesce(c, F.lit(False)).alias(c) for c in ("good", "toxic")]
    rows = copies.select("doc_id", "part", mask.alias("mask")).join(told, "doc_id", "left").select("part", "mask", *marks)
    return rows.groupBy("part", "mask", "good", "toxic").agg(F.count("*").alias("n"))


def edges(found: DataFrame) -> DataFrame:
    """part, applied (a set of filters), filter (the next one) and its COUNTS, summed over the classes found."""
    bits = range(len(FILTERS))
    pairs = F.array(*[F.struct(F.lit(s).alias("applied"), F.lit(i).alias("filter")) for s in range(1 << len(FILTERS)) for i in bits if not s >> i & 1])
    every = found.withColumn("edge", F.explode(pairs)).select("*", "edge.applied", "edge.filter")
    bit = F.expr("shiftleft(1, filter)")
    gone = F.col("mask").bitwiseAND(F.col("applied")) != 0
    fails = F.col("mask").bitwiseAND(bit) != 0
    tests = {
        "kept": ~gone & ~fails, "removed": ~gone & fails, "redundant": gone & fails, "unique_fails": F.col("mask") == bit,
        "good_lost": ~gone & fails & F.col("good"), "toxic_lost": ~gone & fails & F.col("toxic"),
    }
    return every.groupBy("part", "applied", "filter").agg(*[F.sum(F.when(tests[c], F.col("n")).otherwise(0)).cast("long").alias(c) for c in COUNTS])


def paths(spark: SparkSession) -> DataFrame:
    """filter_order, step (from 1), applied and filter: the edges of every order, 600 rows for five filters."""
    steps = [("".join(p), i + 1, sum(1 << FILTERS.index(c) for c in p[:i]), FILTERS.index(c)) for p in permutations(FILTERS) for i, c in enumerate(p)]
    return spark.createDataFrame(steps, "filter_order string, step int, applied int, filter int")


def audit(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """part, filter_order, step and what that step keeps, removes and loses, for every part, order and step.

    part is lang, null as the empty string.  A null text is the empty text: it has no words and fails A only, and E if a smaller doc_id has
    an empty text too.  A null doc_id is no copy of anything, nor labelled.  Rows that repeat a doc_id are documents of their own;
    none of them is the other's copy, as no doc_id is smaller.  A doc_id labelled several times is good or toxic if any of its labels says so.
    Texts count whole, whatever their length; empty documents give no part and so no rows; other columns are not looked at.
    """
    summed = edges(classes(documents, labels))
    ways = F.lit(0)
    for size in range(len(FILTERS)):
        ways = F.when(F.bit_count("applied") == size, factorial(size) * factorial(len(FILTERS) - 1 - size)).otherwise(ways)
    credit = summed.groupBy("part", "filter").agg(F.sum(F.col("removed") * ways).cast("long").alias("shapley"))
    steps = paths(documents.sparkSession).join(summed, ["applied", "filter"]).join(credit, ["part", "filter"])
    return steps.select("part", "filter_order", "step", *COUNTS, "shapley")


_ORDERS = "f as (select unnest(['A', 'B', 'C', 'D', 'E']) as x), o as (select a.x || b.x || c.x || d.x || e.x as filter_order from f a, f b, f c, f d, f e where len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5)"
SQL = rf"""
with w as (select doc_id, coalesce(lang, '') as part, coalesce(text, '') as t, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') as w from documents),
m as (select doc_id, part, (case when len(w) < 200 then 'A' else '' end) || (case when 100 * len(list_distinct(w)) < 50 * len(w) then 'B' else '' end)
  || (case when 100 * len(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * len(t) then 'C' else '' end) || (case when regexp_matches(t, '[#$%&*|]') then 'D' else '' end)
  || (case when doc_id > min(doc_id) over (partition by t) then 'E' else '' end) as fails from w),
l as (select doc_id, coalesce(bool_or(quality = 1), false) as good, coalesce(bool_or(toxic = 1), false) as toxic from labels group by 1),
c as (select part, fails, coalesce(good, false) as good, coalesce(toxic, false) as toxic, count(*) as n from m left join l using (doc_id) group by all),
{_ORDERS},
s as (select filter_order, step, filter_order[step] as filter, filter_order[1:step - 1] as before from o, (select unnest(range(1, 6))::int as step)),
j as (select part, filter_order, step, filter, n, good, toxic, contains(fails, filter) as fail, fails = filter as only_one, len(translate(fails, before, '')) < len(fails) as gone from c, s),
r as (select part, filter_order, step, filter, coalesce(sum(n) filter (not gone and not fail), 0)::bigint as kept, coalesce(sum(n) filter (not gone and fail), 0)::bigint as removed,
  coalesce(sum(n) filter (gone and fail), 0)::bigint as redundant, coalesce(sum(n) filter (only_one), 0)::bigint as unique_fails,
  coalesce(sum(n) filter (not gone and fail and good), 0)::bigint as good_lost, coalesce(sum(n) filter (not gone and fail and toxic), 0)::bigint as toxic_lost from j group by all)
select part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, sum(removed) over (partition by part, filter)::bigint as shapley from r
"""
