"""Finding statement pages: hits, continuations, adjacent merges, and the main set."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerloom.functions import labels, numbers

# Scores and distances.
CONFIGURED, TITLED, INFERRED, NOTES_PENALTY, GATE = 0.92, 0.85, 0.72, 0.35, 0.55
SET_GAP, LOOK_BACK, SUPPLEMENT_PENALTY, MAX_PAGES = 12, 5, 200.0, 3
_INFERRED_TITLES = {"balance_sheet": "Consolidated statements of financial position", "income_statement": "Consolidated income statements", "cash_flow": "Consolidated cash flow statements"}


def _heads(pages: DataFrame) -> DataFrame:
    targets = pages.where(~labels.not_a_target(F.col("text")) & ~labels.is_reference_page(F.col("text")))
    return targets.withColumn("notes", labels.is_notes_page(F.col("text"))).select("*", F.posexplode_outer(labels.head(F.col("text"), 18)).alias("line_no", "line"))


def hits(pages: DataFrame, keywords: DataFrame | None = None) -> DataFrame:
    """The best statement of each page (doc_id, page_number, statement_type, title, score, reason), from a score of GATE up.

    pages: doc_id, page_number, text; keywords: statement_type, keyword (a configuration table of a few rows a company).
    Where both have a company, a keyword counts for its company's pages only.
    A configured keyword beats titles, a title beats inference; ties go to the earlier type, pattern and line.
    """
    heads = _heads(pages)
    penalty = F.when(F.col("notes"), NOTES_PENALTY).otherwise(0.0)
    each = []
    for t, (kind, patterns) in enumerate(labels.TITLES.items()):
        for p, pattern in enumerate(patterns):
            title = F.regexp_extract("line", "(?i)" + pattern, 0)
            good = (title != "") & labels.stands_alone(F.col("line"), title)
            each.append(F.when(good, F.struct(F.lit(kind).alias("statement_type"), title.alias("title"), F.lit(t * 10 + p).alias("rank"))))
    titled = heads.withColumn("hit", F.explode(F.array_compact(F.array(*each))))
    found = titled.select("doc_id", "page_number", "hit.*", "line_no", (TITLED - penalty).alias("score"), F.concat(F.lit("title_match_in_page_head"), F.when(F.col("notes"), ";notes_page_penalty").otherwise("")).alias("reason"))
    found = found.withColumn("configured", F.lit(False))
    if keywords is not None:
        low = lambda c: F.regexp_replace(F.lower(numbers.strip(c)), f"{numbers.SPACE}+", " ")
        own = [c for c in ("company",) if c in keywords.columns and c in pages.columns]
        words = keywords.select("statement_type", F.col("keyword").alias("title"), *[F.col(c).alias(f"of_{c}") for c in own])
        rank = F.array_position(F.array(*[F.lit(k) for k in labels.TYPES]), F.col("statement_type")).cast("int") * 10
        with_words = heads.join(words, reduce(lambda a, c: a & (heads[c] == words[f"of_{c}"]), own, F.contains(low(F.col("line")), low(F.col("title"))))).where(labels.stands_alone(F.col("line"), F.col("title")))
        configured = with_words.select("doc_id", "page_number", "statement_type", "title", rank.alias("rank"), "line_no", (CONFIGURED - penalty).alias("score"), F.concat(F.lit("company_locator_config"), F.when(F.col("notes"), ";notes_page_penalty").otherwise("")).alias("reason"), F.lit(True).alias("configured"))
        found = found.unionByName(configured)
    kind = labels.inferred_type(F.col("text"))
    names = F.create_map(*[F.lit(x) for p in _INFERRED_TITLES.items() for x in p])
    plain = pages.where(~labels.not_a_target(F.col("text")) & ~labels.is_reference_page(F.col("text")) & ~labels.is_notes_page(F.col("text")))
    guessed = plain.select("doc_id", "page_number", kind.alias("statement_type"), F.element_at(names, kind).alias("title"), F.lit(99).alias("rank"), F.lit(99).alias("line_no"), F.lit(INFERRED).alias("score"), F.lit("table_structure_inference").alias("reason"), F.lit(False).alias("configured"))
    every = found.unionByName(guessed.where("statement_type IS NOT NULL"))
    order = W.partitionBy("doc_id", "page_number").orderBy(F.desc("configured"), F.desc("score"), "rank", "line_no")
    best = every.withColumn("k", F.row_number().over(order)).where(f"k = 1 AND score >= {GATE}")
    return best.select("doc_id", "page_number", "statement_type", "title", F.col("score").cast("decimal(5,3)").alias("score"), "reason")


def with_continuations(found: DataFrame, pages: DataFrame, most: int = MAX_PAGES) -> DataFrame:
    """hits as page ranges: up to most further pages, until a start, a notes or other page, or one that doesn't continue."""
    starts = found.withColumnRenamed("page_number", "page_start")
    started = found.select("doc_id", F.col("page_number").alias("q"), F.lit(True).alias("is_start"))
    later = pages.select("doc_id", F.col("page_number").alias("q"), "text", F.count("*").over(W.partitionBy("doc_id")).alias("n_pages")).join(started, ["doc_id", "q"], "left")
    ahead = starts.withColumn("q", F.explode(F.sequence(F.col("page_start") + 1, F.col("page_start") + most)))
    seen = ahead.join(later, ["doc_id", "q"], "left")
    goes_on = F.col("is_start").isNull() & F.col("text").isNotNull() & ~labels.is_notes_page(F.col("text")) & ~labels.not_a_target(F.col("text")) & labels.continues(F.col("text"), F.col("statement_type"))
    stop = seen.groupBy("doc_id", "page_start").agg(F.min(F.when(~F.coalesce(goes_on, F.lit(False)), F.col("q"))).alias("stop"))
    return starts.join(stop, ["doc_id", "page_start"]).withColumn("page_end", F.coalesce(F.col("stop") - 1, F.col("page_start") + most)).drop("stop")


def merge_adjacent(ranges: DataFrame) -> DataFrame:
    """Neighbours of one type that touch or overlap become one range with the higher score; each merge is told in reason."""
    order = W.partitionBy("doc_id").orderBy("page_start", "statement_type")
    run = order.rowsBetween(W.unboundedPreceding, -1)
    marked = ranges.withColumn("other", F.lag("statement_type").over(order)).withColumn("reach", F.max("page_end").over(run))
    fresh = F.col("other").isNull() | (F.col("other") != F.col("statement_type")) | (F.col("page_start") > F.col("reach") + 1)
    island = marked.withColumn("island", F.sum(F.when(fresh, 1).otherwise(0)).over(order))
    out = island.groupBy("doc_id", "island", "statement_type").agg(
        F.min("page_start").alias("page_start"), F.max("page_end").alias("page_end"), F.min_by("title", "page_start").alias("title"), F.max("score").alias("score"),
        F.min_by("reason", "page_start").alias("reason"), F.count("*").alias("n"),
    )
    return out.select("doc_id", "statement_type", "page_start", "page_end", "title", "score", F.concat("reason", F.repeat(F.lit(";merged_adjacent_continuation"), (F.col("n") - 1).cast("int"))).alias("reason"))


def with_sets(ranges: DataFrame, gap: int = SET_GAP) -> DataFrame:
    """ranges with set_no: a new set begins where more than gap pages lie between a range and the one before."""
    order = W.partitionBy("doc_id").orderBy("page_start", "statement_type")
    fresh = F.coalesce(F.col("page_start") - F.lag("page_end").over(order) > gap, F.lit(True))
    return ranges.withColumn("fresh", F.when(fresh, 1).otherwise(0)).withColumn("set_no", F.sum("fresh").over(order)).drop("fresh")


def main_set(ranges: DataFrame, pages: DataFrame) -> DataFrame:
    """The ranges of the best complete set and of incomplete sets before it; all where no set is complete."""
    sets = with_sets(ranges)
    grouped = sets.groupBy("doc_id", "set_no").agg(F.count_distinct("statement_type").alias("types"), F.sum("score").cast("double").alias("total"), F.min("page_start").alias("start"), F.max("page_end").alias("end"))
    extra = pages.where(F.lower("text").rlike(labels.SUPPLEMENT)).select("doc_id", "page_number")
    near = grouped.join(extra, "doc_id").where((F.col("page_number") >= F.col("start") - LOOK_BACK) & (F.col("page_number") <= F.col("end"))).select("doc_id", "set_no").distinct().withColumn("extra", F.lit(True))
    rated = grouped.join(near, ["doc_id", "set_no"], "left").withColumn("rating", F.col("types") * 100 + F.col("total") - F.col("start") * 0.01 - F.when(F.col("extra"), SUPPLEMENT_PENALTY).otherwise(0.0))
    best = rated.where("types = 3").groupBy("doc_id").agg(F.max_by("set_no", F.struct("rating", -F.col("set_no"))).alias("main"), F.max_by("start", F.struct("rating", -F.col("set_no"))).alias("main_start"))
    kept = sets.join(rated.select("doc_id", "set_no", "types", "end"), ["doc_id", "set_no"]).join(best, "doc_id", "left")
    keep = F.col("main").isNull() | (F.col("set_no") == F.col("main")) | ((F.col("types") < 3) & (F.col("end") < F.col("main_start")))
    return kept.where(keep).select(*ranges.columns)


def candidates(pages: DataFrame, keywords: DataFrame | None = None, most: int = MAX_PAGES) -> DataFrame:
    """Statement candidates of each document, with their source pages."""
    ranges = merge_adjacent(with_continuations(hits(pages, keywords), pages, most))
    return main_set(ranges, pages).withColumn("source_pages", F.sequence("page_start", "page_end"))
