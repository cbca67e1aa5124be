"""Benchmark decontamination by a prefix-filtered join of item-sized word windows.

A benchmark item becomes windows of ``size`` consecutive words (a shorter item is one window).  The words of
each window are ordered by rarity, counted over all documents; since a contained window needs every one of its
words, its rarest word is a sufficient prefix.  Documents are joined with the windows on that word; position
and length bounds fix where the window would have to start and end, and the words there are compared exactly.

The benchmark side is broadcast in blocks of at most ``block_words`` window words (a bound of a few MB each),
however large it is; documents are never shuffled while one block is enough.  With more blocks, one is held at a time;
what it hits is written out by the text's digest, and verdicts come back to the rows by that, so that a row is judged
by its own text either way.

Null or empty texts have no words and no hits; a document shorter than a window has none either; items without
words are ignored; equal items are all named; repeated rows are answered row by row; columns other than those
named are not read, so extra ones cannot clash.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

SIZE = 13
BLOCK_WORDS = 4_000_000

#: Word characters are digits, a-z and everything beyond ASCII; A-Z is lowered, all else separates.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def words(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_FOLD).split() if text else []


def windows(item: list[bytes], size: int = SIZE) -> list[tuple[bytes, ...]]:
    return [tuple(item[i : i + size]) for i in range(max(1, len(item) - size + 1))] if item else []


def _blocks(benchmark: DataFrame, size: int, block_words: int) -> Iterator[dict[tuple[bytes, ...], set[str]]]:
    """The distinct windows with their items, a bounded number at a time."""
    block: dict[tuple[bytes, ...], set[str]] = {}
    room = block_words
    for row in benchmark.select(F.col("item_id").cast("string").alias("i"), "text").toLocalIterator():
        for w in windows(words(row["text"]), size):
            if w not in block:
                block[w] = set()
                room -= len(w)
            block[w].add(row["i"] or "")
            if room <= 0:
                yield block
                block, room = {}, block_words
    if block:
        yield block


def _frequencies(documents: DataFrame, vocabulary: frozenset[bytes]) -> dict[bytes, int]:
    """How often each benchmark word occurs in all documents; at most one row per benchmark word comes back."""
    shared = documents.sparkSession.sparkContext.broadcast(vocabulary)

    def count(batches):
        known, seen = shared.value, Counter()
        for pdf in batches:
            for text in pdf["text"]:
                seen.update(w for w in words(text) if w in known)
        yield pd.DataFrame({"word": list(seen.keys()), "n": list(seen.values())})

    counted = documents.select("text").mapInPandas(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return {bytes(r["word"]): r["n"] for r in counted.toLocalIterator()}


def _index(block: dict, frequency: dict[bytes, int]) -> dict:
    """prefix word -> {(offset of that word, window length): {window: items}}"""
    index: dict = {}
    for w, items in block.items():
        at = min(range(len(w)), key=lambda i: (frequency.get(w[i], 0), w[i], i))
        if w[at] in frequency:  # else no document has that word
            index.setdefault(w[at], {}).setdefault((at, len(w)), {})[b" ".join(w)] = tuple(sorted(items))
    return index


def _hits(doc: list[bytes], index: dict) -> tuple[bytearray, set[str]]:
    """A mark per word that lies in an occurrence of a window, and the items of those windows."""
    marks, found, n = bytearray(len(doc)), set(), len(doc)
    for i, w in enumerate(doc):
        if w in index:
            for (at, length), known in index[w].items():
                start = i - at
                if 0 <= start <= n - length and (items := known.get(b" ".join(doc[start : start + length]))):
                    marks[start : start + length] = b"\x01" * length
                    found.update(items)
    return marks, found


def _digest(items) -> str:
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()


RESULT = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"


def _result(doc_id, n_words: int, n_hit: int, items) -> tuple:
    return doc_id, n_words, n_hit, len(items), _digest(items), n_hit > 0 and 20 * n_hit >= n_words


def contamination(documents: DataFrame, benchmark: DataFrame, size: int = SIZE, block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per document: its words, the words inside benchmark windows, the items found, and the verdict.

    A document is contaminated if at least a twentieth of its words are hit (and at least one).
    """
    blocks = _blocks(benchmark, size, block_words)
    block, more = next(blocks, {}), next(blocks, None)
    if more is None:
        index = _shared(documents, block)

        def scan(batches):
            for pdf in batches:
                rows = []
                for doc_id, text in zip(pdf["doc_id"], pdf["text"]):
                    doc = words(text)
                    marks, found = _hits(doc, index.value)
                    rows.append(_result(doc_id, len(doc), sum(marks), found))
                yield _frame(rows)

        return documents.select("doc_id", "text").mapInPandas(scan, RESULT)

    def clean(batches):
        for pdf in batches:
            yield pd.DataFrame({"doc_id": pdf["doc_id"].astype("Int64"), "_digest": pdf["_digest"], "n_words": [len(words(t)) for t in pdf["text"]]})

    rows = documents.select("doc_id", "text", _text_digest().alias("_digest")).mapInPandas(clean, "doc_id long, _digest string, n_words long")
    hits = _verdicts(documents, chain([block, more], blocks)).select("_digest", "n_hit", "n_items", "items_sha256", "contaminated")
    none = {"n_hit": F.lit(0).cast("long"), "n_items": F.lit(0).cast("long"), "items_sha256": F.lit(_digest([])), "contaminated": F.lit(False)}
    return rows.join(hits, "_digest", "left").select("doc_id", "n_words", *[F.coalesce(c, d).alias(c) for c, d in none.items()])


def _text_digest():
    """A key of the text alone; rows with equal texts have equal verdicts."""
    return F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)


def _shared(documents: DataFrame, block: dict):
    """The index of a block, broadcast."""
    frequency = _frequencies(documents, frozenset(w for k in block for w in k))
    return documents.sparkSession.sparkContext.broadcast(_index(block, frequency))


def _verdicts(documents: DataFrame, blocks) -> DataFrame:
    """_digest and the columns of a verdict for each distinct text that some block hits; one block is held at a time."""
    numbered = documents.select("text", _text_digest().alias("_digest"))

    def hits(index) -> DataFrame:
        def scan(batches):
            for pdf in batches:
                rows = []
                for digest, text in zip(pdf["_digest"], pdf["text"]):
                    doc = words(text)
                    marks, found = _hits(doc, index.value)
                    if found:
                        rows.append((digest, len(doc), np.packbits(np.frombuffer(marks, np.uint8)).tobytes(), sorted(found)))
                yield pd.DataFrame(rows, columns=["_digest", "n_words", "marks", "items"])

        found = numbered.mapInPandas(scan, "_digest string, n_words long, marks binary, items array<string>")
        # copies of a text have the same hits
        return found.dropDuplicates(["_digest"])

    parts = []
    for block in blocks:
        index = _shared(documents, block)
        parts.append(stored(hits(index), "hits"))
        index.destroy()
    union = parts[0]
    for p in parts[1:]:
        union = union.unionByName(p)
    merged = union.groupBy("_digest").agg(F.first("n_words").alias("n_words"), F.collect_list("marks").alias("marks"), F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"))

    def finish(batches):
        for pdf in batches:
            rows = []
            for n, marks, items in zip(pdf["n_words"], pdf["marks"], pdf["items"]):
                total = np.zeros(-(-n // 8), np.uint8)
                for m in marks:
                    total |= np.frombuffer(m, np.uint8)
                rows.append(_result(None, n, int(np.unpackbits(total).sum()), list(items)))
            yield _frame(rows).drop(columns="doc_id").assign(_digest=pdf["_digest"].to_numpy())

    return merged.mapInPandas(finish, RESULT.removeprefix("doc_id long, ") + ", _digest string")


def _frame(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]).astype({"doc_id": "Int64"})


def keep_clean(documents: DataFrame, benchmark: DataFrame, size: int = SIZE, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The documents without those that are contaminated; columns and repeated rows as before."""
    blocks = _blocks(benchmark, size, block_words)
    block, more = next(blocks, {}), next(blocks, None)
    if more is None:
        index = _shared(documents, block)

        def scan(batches):
            for batch in batches:
                keep = []
                for text in batch.column("text").to_pylist():
                    doc = words(text)
                    keep.append(not _result(None, len(doc), sum(_hits(doc, index.value)[0]), ())[-1])
                yield batch.filter(pa.array(keep, pa.bool_()))

        return documents.mapInArrow(scan, documents.schema)
    bad = _verdicts(documents, chain([block, more], blocks)).where("contaminated").select("_digest")
    return documents.join(bad, F.sha2(F.coalesce(documents["text"], F.lit("")).cast("binary"), 256) == bad["_digest"], "left_anti")


#: contamination(documents, benchmark) by looking up every window of every document.
SQL = r"""
with d as (
  select doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') as w from documents),
b as (
  select coalesce(item_id::varchar, '') as item, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') as w from benchmark),
bw as (
  select item, least(len(w), 13) as l, unnest(list_transform(range(1, greatest(len(w) - 11, 2)), lambda k: array_to_string(w[k:k + 12], ' '))) as t from b where len(w) > 0),
dw as (
  select doc_id, l, unnest(range(1, len(w) - l + 2)) as k, unnest(list_transform(range(1, len(w) - l + 2), lambda k: array_to_string(w[k:k + l - 1], ' '))) as t
  from d, (select distinct l from bw) where len(w) >= l),
h as (select distinct doc_id, k, l, item from dw join bw using (l, t)),
p as (select doc_id, count(distinct p) as n_hit from (select doc_id, unnest(range(k, k + l)) as p from h) group by 1),
f as (select doc_id, count(distinct item) as n_items, string_agg(distinct item, ',' order by item) as items from h group by 1)
select d.doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items, sha256(coalesce(items, '')) as items_sha256,
  coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated
from d left join p using (doc_id) left join f using (doc_id)
"""
