"""Exact copies by a tree-merge of sorted digest runs; DataFrame functions only.

Every partition of the input writes one run: its rows' digests in order.  Runs then meet in binomial rounds: a round merges
the runs whose numbers agree but for their lowest bits, FAN_IN = 2 ** BITS of them at once, and keeps of every digest the
smallest identifier and the number of rows.  A merged run is itself dealt by digest, so that no task ever holds a whole run, and
a text that fills a third of the table reaches a round as one entry per run, however many rows it has.  The verdicts go
back down the same tree, to the rows of a few runs at a time, so no text's rows have to meet in one task on that way either.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

#: Runs merge 2 ** BITS at a time, in ROUNDS rounds; runs beyond 2 ** (BITS * ROUNDS) share numbers, which only makes them longer.
BITS, ROUNDS = 4, 3
#: An entry is verified where it merges: what agrees in the digest but not in length or second hash stays apart.
KEY = ["digest", "size", "second"]


def normalised(text: Column) -> Column:
    """text with each stretch of white space as one blank; null as the empty text."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def runs(rows: DataFrame, text: Column, carried: list[Column]) -> DataFrame:
    """carried columns, run and KEY of every row, stored as one sorted run per partition."""
    run = F.pmod(F.spark_partition_id(), F.lit(1 << BITS * ROUNDS)).alias("run")
    keys = [F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"), F.octet_length(text).alias("size"), F.xxhash64(text).alias("second")]
    return stored(rows.select(*carried, run, *keys).sortWithinPartitions(*KEY), "runs")


def merged(entries: DataFrame) -> DataFrame:
    """entries (run, KEY, keep_id, members) after one round: of every digest in FAN_IN neighbouring runs, the smallest identifier."""
    round_ = entries.groupBy(F.shiftright("run", BITS).alias("run"), *KEY)
    return round_.agg(F.min("keep_id").alias("keep_id"), F.sum("members").alias("members"))


def marked(found: DataFrame) -> DataFrame:
    """The rows of runs() with keep_id, the smallest doc_id of their text, and group_size, its number of rows.

    A round's entries are written, so that a lost executor costs one round.  Only texts of several rows travel back down.
    """
    entries = found.select("run", *KEY, F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("members"))
    rounds = []
    for _ in range(ROUNDS):
        entries = stored(merged(entries), "round")
        rounds.append(entries)
    verdicts = rounds.pop().where("members > 1").select(*KEY, "keep_id", "members")
    verdicts = verdicts.withColumn("run", F.lit(0))
    for entries in reversed(rounds):
        parents = verdicts.withColumnRenamed("run", "parent")
        below = entries.select("run", F.shiftright("run", BITS).alias("parent"), *KEY)
        verdicts = below.join(parents, ["parent", *KEY]).select("run", *KEY, "keep_id", "members")
    verdicts = stored(verdicts.withColumnRenamed("run", "parent"), "verdicts")
    told = found.withColumn("parent", F.shiftright("run", BITS)).join(verdicts, ["parent", *KEY], "left")
    own = F.col("members").isNull()
    return told.select(
        *found.columns, F.when(own, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"), F.coalesce("members", F.lit(1)).cast("long").alias("group_size")
    )


def exact_copies(documents: DataFrame) -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256 per document; texts are equal if they are so after normalised().

    A null text is the empty text, and empty texts are copies of each other.  Every row counts as a document: rows that repeat
    a doc_id and text add to group_size, and each of them is kept if its doc_id is the smallest.  A null doc_id is never the
    smallest, unless no other row has the text: then keep_id is null and the rows are kept.  Texts of any length are digested
    whole; an empty table gives no rows; other columns, whatever their names, are not looked at.
    """
    found = marked(runs(documents, normalised(documents["text"]), [documents["doc_id"]]))
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    return found.select("doc_id", "keep_id", "group_size", kept.alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))


def keep_first(documents: DataFrame) -> DataFrame:
    """One document of every text, the one of the smallest doc_id, with the columns of documents.

    Of rows that repeat doc_id and text one stays, whichever Spark comes to first.  Rows travel with their texts only where they
    are to be told from such repetitions; all others are met with the keys to drop.
    """
    verdicts = stored(exact_copies(documents), "copies")
    text = F.sha2(normalised(documents["text"]).cast("binary"), 256)

    def same(keys: DataFrame) -> Column:
        return documents["doc_id"].eqNullSafe(keys["gone_id"]) & (text == keys["gone_text"])

    names = [F.col("doc_id").alias("gone_id"), F.col("text_sha256").alias("gone_text")]
    gone = verdicts.where("NOT kept").select(*names).distinct()
    again = verdicts.where("kept AND group_size > 1").groupBy(*names).agg(F.count("*").alias("n")).where("n > 1").drop("n")
    left = documents.join(gone, same(gone), "left_anti")
    single = left.join(again, same(again), "left_anti")
    twice = left.join(again, same(again), "left_semi").withColumn("_normalised", normalised(F.col("text")))
    return single.unionByName(twice.dropDuplicates(["doc_id", "_normalised"]).drop("_normalised"))


SQL = r"""
with d as (select doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') as t from documents),
m as (select *, min(doc_id) over (partition by t) as keep_id, count(*) over (partition by t) as group_size from d)
select doc_id, keep_id, group_size, doc_id is not distinct from keep_id as kept, sha256(t) as text_sha256 from m
"""
