"""Main text of pages by site style trees.

The pages of a host are merged into one tree.  Its inner nodes are element paths; its leaves are places: a path and the number of the
block among those of its path on the page (up to SLOTS), so that the entries of a menu are told apart.  A leaf's content importance is
high where its texts differ from page to page: a text that k of the node's m distinct pages share counts 1 - log(k) / log(m), and a node
takes the mean, weighted by length, over all leaves below it.  A node's presentation importance is the entropy, to base m, of the
sequences of paths that it shows below itself.  Branches in which both are low are removed from each page of the host.  Pages with the
same blocks of text proper count once, so that copies of an article do not make it look like a template.

All blocks of all pages of a host go into its tree: menus, footers and adverts as well as articles.  What is low depends on where a branch
is: inside an article or main element both importances have to be below ``threshold``; a place outside it, or on a page
without either, is removed if its content is below ``sure`` and its page has an article, else as inside.  Names decide where the tree
cannot: elements that are noise by name or attribute (menus, forms, adverts, ..., see markup) are removed whatever the tree finds, as
adverts and comments differ from page to page too; ``names=False`` leaves all to the tree.  A host of fewer than ``least_pages`` distinct pages has
no importances: there a block outside the article or main element stays if the page has more text outside it than inside.  A page that
would lose all its blocks keeps those of its article or main element.

Null html counts as empty and gives an empty text; elements nested deeper than markup.DEPTH share a path; texts of any length count whole,
a page's blocks and distinct paths being what is held of it; a null url makes pages of the host ''; repeated rows are answered row by
row; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections import Counter

import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small, stored
from .markup import Block, blocks

LEAST_PAGES, THRESHOLD, SURE, SLOTS = 8, 0.15, 0.9, 16
BROADCAST_ROWS, BROADCAST_CHARS = 20_000, 16_000_000


def host(url):
    return F.coalesce(F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


def _hash(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text) - (1 << 63)


def places(found: list[Block]) -> list[str]:
    """The place of each block: its path and its number among the blocks of that path."""
    seen: Counter = Counter()
    out = []
    for b in found:
        out.append(f"{b.path}#{min(seen[b.path], SLOTS - 1)}")
        seen[b.path] += 1
    return out


#: Sequences of paths are hashed as polynomials over this prime field.
PRIME, BASE = (1 << 61) - 1, 1_000_003
_INVERSE = pow(BASE - 1, -1, PRIME)


def shown(found: list[Block]) -> dict[str, int]:
    """A hash, for every path of a page, of the sequence of the blocks' paths below it.

    A path's code is affine in that of the path without its first name, so the hash of a sequence follows from that of the sequence one
    level below and its length.  Paths are opened and closed as blocks follow each other, and each hands its hash to the one above
    when it closes: the work is that of the elements, not of the elements times their depth.
    """
    out: dict[str, tuple[int, int]] = {}
    names: list[str] = []
    paths, sums = [""], [(0, 0)]

    def joined(first: tuple[int, int], then: tuple[int, int]) -> tuple[int, int]:
        return (first[0] * pow(BASE, then[1], PRIME) + then[0]) % PRIME, first[1] + then[1]

    def close(depth: int) -> None:
        while len(names) > depth:
            path, run, name = paths.pop(), sums.pop(), names.pop()
            # a path may be opened again later on the page
            out[path] = joined(out[path], run) if path in out else run
            code = xxhash.xxh3_64_intdigest(name) % PRIME
            all_ones = (pow(BASE, run[1], PRIME) - 1) * _INVERSE
            sums[-1] = joined(sums[-1], ((code * run[0] + (code ^ 0x5BD1E995) * all_ones) % PRIME, run[1]))

    for b in found:
        steps = b.path.split("/")[1:]
        same = 0
        while same < min(len(steps), len(names)) and steps[same] == names[same]:
            same += 1
        close(same)
        for name in steps[same:]:
            names.append(name)
            paths.append(f"{paths[-1]}/{name}")
            sums.append((0, 0))
        sums[-1] = joined(sums[-1], (1, 1))
    close(0)
    return {path: run[0] for path, run in out.items()}


def nodes(pages: DataFrame) -> DataFrame:
    """host, page (hash of its blocks), path, value (hash of a text at a place, or of the blocks below a path), chars, outside (of the
    article or main element) and style."""

    def work(batches):
        for pdf in batches:
            rows = []
            for h, page in zip(pdf["host"], pdf["html"]):
                found = list(blocks(page))
                proper = [b for b in found if not b.noise] or found
                sign = _hash("\n".join(f"{b.path}\t{b.text}" for b in proper))
                named = any(b.content and not b.noise for b in found)
                rows += [(h, sign, at, _hash(b.text), len(b.text), named and not b.content, False) for b, at in zip(found, places(found))]
                rows += [(h, sign, p, s, 0, False, True) for p, s in shown(found).items()]
            yield pd.DataFrame(rows, columns=["host", "page", "path", "value", "chars", "outside", "style"])

    return pages.select(host(F.col("url")).alias("host"), "html").mapInPandas(work, "host string, page long, path string, value long, chars long, outside boolean, style boolean")


def importance(pages: DataFrame, least_pages: int = LEAST_PAGES, threshold: float = THRESHOLD, sure: float = SURE) -> DataFrame:
    """host, path (of a branch, or a place), content and style (both 0 to 1), low (to be removed) and outside, of hosts with enough
    pages."""
    # one row for each page and value of a path, so that rows count pages
    seen = stored(nodes(pages).distinct(), "nodes")
    counted = stored(seen.groupBy("host", "path", "style", "value").agg(F.count("*").alias("k"), F.max("chars").alias("chars"), F.max("outside").alias("outside")), "counted")
    # a page shows a place or a path once, in its distinct values; m is how many pages do
    sizes = seen.groupBy("host", "path").agg(F.count_distinct("page").alias("m"))
    sizes = small(sizes.where(F.col("m") >= least_pages), BROADCAST_ROWS)
    share = F.col("k") / F.col("m")
    style = counted.where("style").join(sizes, ["host", "path"]).groupBy("host", "path").agg(F.sum(-share * F.log(share) / F.log("m")).alias("style"))
    # a leaf counts for itself and for each branch that it is in; m is the branch's
    steps = F.split(F.regexp_replace("path", "#[0-9]+$", ""), "/")
    up = F.transform(F.sequence(F.lit(2), F.size(steps)), lambda i: F.array_join(F.slice(steps, 1, i), "/"))
    above = F.when(F.size(steps) >= 2, up).otherwise(F.array().cast("array<string>"))
    leaves = counted.where("NOT style").select("host", F.col("path").alias("leaf"), F.explode(F.concat(above, F.array("path"))).alias("path"), "k", "chars", "outside").join(sizes, ["host", "path"])
    one = F.greatest(1 - F.log("k") / F.log("m"), F.lit(0.0))
    outside = F.max(F.col("outside") & (F.col("leaf") == F.col("path"))).alias("outside")
    content = leaves.groupBy("host", "path").agg((F.sum(one * F.col("k") * F.col("chars")) / F.sum(F.col("k") * F.col("chars"))).alias("content"), outside)
    both = content.join(style, ["host", "path"], "left").withColumn("style", F.coalesce("style", F.lit(0.0)))
    low = (F.col("content") < threshold) & (F.col("style") < threshold)
    return both.select("host", "path", "content", "style", (low | (F.col("outside") & (F.col("content") < sure))).alias("low"), "outside")


def _kept(found: list[Block], low: tuple[str, ...], known: set[str], names: bool) -> list[Block]:
    """The blocks of a page that stay; low: branches and places to remove, known: places outside that the tree has judged."""
    at = places(found)
    proper = [not (names and b.noise) for b in found]
    named = any(b.content and p for b, p in zip(found, proper))
    inside = sum(len(b.text) for b, p in zip(found, proper) if p and b.content)
    around = sum(len(b.text) for b, p in zip(found, proper) if p and not b.content)
    # without the tree's word, what is around an article is not the text, unless it is most of it
    stays = not named or around > inside or not names
    out = []
    for b, place, p in zip(found, at, proper):
        gone = (b.path + "/").startswith(low) or place + "/" in low
        if p and not gone and (b.content or stays or place in known):
            out.append(b)
    return out or [b for b in found if b.content and not b.noise]


def main_text(pages: DataFrame, names: bool = True, **options) -> DataFrame:
    """page_id, url, text and n_chars per page; options: those of importance()."""
    judged = importance(pages, **options)
    lists = [F.collect_list(F.when(F.col("low"), F.col("path"))).alias("low"), F.collect_list(F.when(~F.col("low") & F.col("outside"), F.col("path"))).alias("known")]
    low = stored(judged.where("low OR outside").groupBy("host").agg(*lists), "branches")
    # a host's list is as long as its templates have branches; only lists of a known size in all are broadcast
    size = low.select(F.aggregate(F.concat("low", "known"), F.lit(0).cast("long"), lambda n, p: n + F.length(p)).alias("chars")).agg(F.count("*"), F.coalesce(F.sum("chars"), F.lit(0))).first()
    few = size[0] <= BROADCAST_ROWS and size[1] <= BROADCAST_CHARS
    joined = pages.select("page_id", "url", "html", host(F.col("url")).alias("host")).join(F.broadcast(low) if few else low, "host", "left")

    def work(batches):
        for pdf in batches:
            texts = []
            for page, low, known in zip(pdf["html"], pdf["low"], pdf["known"]):
                gone = tuple(p + "/" for p in low) if low is not None else ()
                texts.append("\n".join(b.text for b in _kept(list(blocks(page)), gone, set(known) if known is not None else set(), names)))
            yield pd.DataFrame({"page_id": pdf["page_id"].astype("Int64"), "url": pdf["url"], "text": texts, "n_chars": [len(t) for t in texts]})

    return joined.select("page_id", "url", "html", "low", "known").mapInPandas(work, "page_id long, url string, text string, n_chars long")
