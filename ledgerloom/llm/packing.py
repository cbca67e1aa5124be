"""Lexical retrieval packing: sequences filled with a seed document and its BM25 neighbours.

Documents are encoded once and stored; with the ids' counts over all documents, each gets a lexical signature: the
``MINIMA`` smallest of its ids under a weighted min-hash, in which rare ids are likelier to be smallest, so that two
documents share a place of it about as often as they share weight.  Documents are range-partitioned by the signature,
then by a hash of their ids and by doc_id, so that documents alike tend to meet, a hot first minimum is split by the
next ones, and any number of copies spreads over partitions.  A partition is cut into shards of about ``shard_tokens``
ids.  Each shard gets an inverted BM25 index over token ids; a seed (the rest of a cut document, else the next unused
one) retrieves its unused neighbours by all its terms, best first, which fill the window; the one that no longer fits is
cut and its rest seeds the next window.  What is left of a shard is laid out in sequences whose lengths are powers of
two, which need no padding.

A null text counts as empty; every document ends in the end id, so an empty one has one id; long documents span
windows; repeated rows are packed row by row; an empty table gives no pieces; other columns are not read.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored
from .tokens import cuts, default_path, encoder, gather
from .tokens import documents as encoded

WINDOW = 4096
SHARD_TOKENS = 750_000
MINIMA = 4
K1, B = 1.2, 0.75
SUMS = 32


class Index:
    """An inverted BM25 index over the token ids of one shard's documents, whose ids lie end to end."""

    def __init__(self, ids: np.ndarray, counts: np.ndarray):
        n = self.n = len(counts)
        pairs, tf = np.unique(ids.astype(np.int64) * n + np.repeat(np.arange(n), counts), return_counts=True)
        term, doc = np.divmod(pairs, n)
        slot = np.cumsum(np.diff(term, prepend=term[:1]) > 0)
        self.df = np.bincount(slot)
        self.doc, self.starts = doc.astype(np.int32), cuts(self.df)[:-1]
        idf = np.log1p((n - self.df + 0.5) / (self.df + 0.5))
        self.weight = idf[slot] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * counts[doc] / counts.mean()))
        # a document's terms that others have as well
        order = np.argsort(doc, kind="stable")
        order = order[self.df[slot[order]] > 1]
        self.terms, self.first = slot[order], np.searchsorted(doc[order], np.arange(n + 1))

    def scores(self, seed: int) -> np.ndarray:
        """BM25 of every document for the seed's terms."""
        terms = self.terms[self.first[seed] : self.first[seed + 1]]
        starts, sizes = self.starts[terms], self.df[terms]
        return np.bincount(gather(self.doc, starts, sizes), gather(self.weight, starts, sizes), self.n)

    def neighbours(self, seed: int, used: np.ndarray) -> np.ndarray:
        """Unused documents that share a term with the seed, best first (ties: in order)."""
        scores = self.scores(seed)
        scores[used] = 0
        found = np.flatnonzero(scores)
        return found[np.argsort(-scores[found], kind="stable")]


def pack(ids: np.ndarray, counts: np.ndarray, window: int = WINDOW) -> list[tuple[int, int, int, int, int]]:
    """Pieces (document, start, length, sequence, offset) of one shard; every id is in exactly one piece."""
    index, used, lengths = Index(ids, counts), np.zeros(len(counts), bool), counts.tolist()
    order, unused = [], 0
    fill, rest = 0, None  # ids in the open window, the document that was cut
    while True:
        if rest is None:
            while unused < len(lengths) and used[unused]:
                unused += 1
            if unused == len(lengths):
                break
            seed = unused
            used[seed] = True
            order.append(seed)
            fill += lengths[seed]
        else:
            seed, rest = rest, None
        if fill >= window:
            fill %= window
            rest = seed if fill else None
            continue
        for k in index.neighbours(seed, used).tolist():
            used[k] = True
            order.append(k)
            fill += lengths[k]
            if fill >= window:
                fill %= window
                rest = k if fill else None
                break
    # the documents, in the order in which they fill windows, lie end to end; windows and the tail cut that line
    total = sum(lengths)
    ends = list(range(window, total + 1, window))
    left, at = total % window, total - total % window
    while left:
        step = 1 << (left.bit_length() - 1)
        at, left = at + step, left - step
        ends.append(at)
    pieces, sequence, opened, at = [], 0, 0, 0
    for k in order:
        start = 0
        while start < lengths[k]:
            n = min(lengths[k] - start, ends[sequence] - at)
            pieces.append((k, start, n, sequence, at - opened))
            start, at = start + n, at + n
            if at == ends[sequence]:
                sequence, opened = sequence + 1, at
    return pieces


def tokenised(documents: DataFrame, path: str) -> DataFrame:
    """doc_id and ids of each document (little-endian, of the encoder's ``kind``), end id included, and one row with counts
    (u64 by id) of each task."""

    def work(batches):
        seen = np.zeros(0, np.int64)
        for doc_ids, ids, counts in encoded(batches, encoder(path)):
            size = int(ids.max()) + 1
            if size > len(seen):
                seen = np.append(seen, np.zeros(size - len(seen), np.int64))
            seen += np.bincount(ids, minlength=len(seen))
            yield _rows(doc_ids, ids, counts, encoder(path).kind)
        yield pa.RecordBatch.from_pydict({"doc_id": [None], "ids": [None], "counts": [seen.astype("<u8").tobytes()]}, _TOKENISED)

    return stored(documents.select("doc_id", "text").mapInArrow(work, "doc_id long, ids binary, counts binary"), "tokenised")


_TOKENISED = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary()), ("counts", pa.binary())])


def _rows(doc_ids: list, ids: np.ndarray, counts: np.ndarray, kind: str) -> pa.RecordBatch:
    data = np.ascontiguousarray(ids, kind)
    ends = pa.array((data.itemsize * cuts(counts)).astype(np.int32))
    binary = pa.Array.from_buffers(pa.binary(), len(counts), [None, ends.buffers()[1], pa.py_buffer(data)])
    return pa.RecordBatch.from_arrays([pa.array(doc_ids, pa.int64()), binary, pa.nulls(len(counts), pa.binary())], schema=_TOKENISED)


def _read(column: pa.Array, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """The ids of a binary column, end to end, and their numbers."""
    column, width = column.cast(pa.large_binary()), np.dtype(kind).itemsize
    at = np.frombuffer(column.buffers()[1], "<i8", len(column) + 1, 8 * column.offset)
    return np.frombuffer(column.buffers()[2], kind, (at[-1] - at[0]) // width, int(at[0])).astype(np.uint32), np.diff(at) // width


def _totals(rows: DataFrame) -> np.ndarray:
    """How often each id occurs in all documents: sums of tasks' counts in SUMS groups, whose sums come here."""

    def add(batches):
        total = np.zeros(0, np.int64)
        for batch in batches:
            for data in batch.column("counts"):
                one = np.frombuffer(data.as_buffer(), "<u8").astype(np.int64)
                total = np.pad(total, (0, max(0, len(one) - len(total))))
                total[: len(one)] += one
        yield pa.RecordBatch.from_pydict({"counts": [total.astype("<u8").tobytes()]})

    out = np.zeros(1, np.int64)
    for row in rows.where("counts IS NOT NULL").select("counts").repartition(SUMS).mapInArrow(add, "counts binary").collect():
        one = np.frombuffer(row["counts"], "<u8").astype(np.int64)
        out = np.pad(out, (0, max(0, len(one) - len(out))))
        out[: len(one)] += one
    return out


def order(totals: np.ndarray) -> np.ndarray:
    """The key of each id in the weighted min-hash: an exponential variate over the squared log rarity, smallest first."""
    x = (np.arange(len(totals), dtype=np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    uniform = ((x ^ (x >> np.uint64(32))) >> np.uint64(11)).astype(float) / 2**53
    rarity = np.log((totals.sum() + 1) / np.maximum(totals, 1))
    return (-np.log(np.maximum(uniform, 2.0**-53)) / np.maximum(rarity, 1e-6) ** 2).astype(np.float32)


def signatures(ids: np.ndarray, counts: np.ndarray, keys: np.ndarray, n: int = MINIMA) -> list[np.ndarray]:
    """The n smallest distinct keys of each document, one array for each place; every document has an id at least."""
    out, here, starts = [], keys[ids], cuts(counts)[:-1]
    for _ in range(n):
        out.append(np.minimum.reduceat(here, starts))
        here = np.where(here > np.repeat(out[-1], counts), here, np.float32(np.inf))
    return out


RESULT = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary"
_RESULT = pa.schema([(c.split()[0], pa.binary() if c.endswith("binary") else pa.int64()) for c in RESULT.split(", ")])


def sequences(documents: DataFrame, path: str | None = None, window: int = WINDOW, shard_tokens: int = SHARD_TOKENS, ids: bool = True) -> DataFrame:
    """The pieces of all documents with their place; ids holds a piece's ids (little-endian u32) unless switched off."""
    path = path or default_path()
    rows = tokenised(documents, path)
    keys = documents.sparkSession.sparkContext.broadcast(order(_totals(rows)))
    key = [f"key{k}" for k in range(MINIMA)]

    def sign(batches):
        for batch in batches:
            found = signatures(*_read(batch.column("ids"), encoder(path).kind), keys.value) if batch.num_rows else [np.zeros(0, np.float32)] * MINIMA
            yield pa.RecordBatch.from_arrays([*batch.columns, *map(pa.array, found)], names=["doc_id", "ids", *key])

    def work(batches):
        held, size, sequence = [], 0, TaskContext.get().partitionId() << 32

        def out():
            nonlocal held, size, sequence
            doc_ids, flat, counts = [i for h in held for i in h[0]], np.concatenate([h[1] for h in held]), np.concatenate([h[2] for h in held])
            pieces, at = pack(flat, counts, window), cuts(counts).tolist()
            data = [flat[at[k] + start : at[k] + start + n].astype("<u4").tobytes() for k, start, n, _, _ in pieces]
            placed = [(doc_ids[k], start, n, zlib.crc32(d), int(counts[k]), sequence + s, offset, d if ids else None) for (k, start, n, s, offset), d in zip(pieces, data)]
            sequence += pieces[-1][3] + 1
            held, size = [], 0
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*placed), _RESULT)], schema=_RESULT)

        for batch in batches:
            doc_ids, (flat, counts) = batch.column("doc_id").to_pylist(), _read(batch.column("ids"), encoder(path).kind)
            ends, at = cuts(counts), 0
            while at < len(counts):
                # whole documents until the shard is full
                to = min(len(counts), int(np.searchsorted(ends, ends[at] + shard_tokens - size, "left")))
                held.append((doc_ids[at:to], flat[ends[at] : ends[to]].copy(), counts[at:to]))
                size, at = size + int(ends[to] - ends[at]), to
                if size >= shard_tokens:
                    yield out()
        if held:
            yield out()

    signed = rows.where("counts IS NULL").select("doc_id", "ids").mapInArrow(sign, "doc_id long, ids binary, " + ", ".join(f"{k} float" for k in key))
    by = [*key, F.xxhash64("ids"), F.col("doc_id").asc_nulls_first()]
    return signed.repartitionByRange(*by).sortWithinPartitions(*by).select("doc_id", "ids").mapInArrow(work, RESULT)
