"""Token ids in Re-Pair compressed shards, in ascending doc_id order.

Documents are range-partitioned by doc_id (ties by text), and each partition is cut into shards of about
``shard_tokens`` ids, whole documents each.  In a shard, frequent adjacent pairs are replaced by new nonterminals, round
after round, until no pair is left that occurs ``least`` times; no pair spans two documents.  A round replaces all pairs
that occur so often, instead of one pair at a time, so that it is a few numpy passes.  A shard is one binary value:

    magic "RPB2", then seven little-endian u32: documents, symbols, rules, the first nonterminal (the largest id + 1),
    and the bits of a symbol, of an expansion length and of an id, then u64 bytes of what follows the doc table
    i64 doc_id and u8 "is null" per document; u32 first symbol and u32 first token per document (and the ends)
    the rules' left symbols, their right symbols, their expansion lengths, and all symbols, each packed to its bits

so one document is decoded by expanding its own symbols (``document``), and any stretch of its ids by skipping symbols
by their expansion lengths (``ids``).

A null text counts as empty; every document gets the end id, so an empty text has one id; equal rows are stored
row by row; null ids come first; a text longer than a shard is a shard of its own; an empty table gives no shards; other
columns are not read.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored
from .tokens import cuts, default_path, encoder, gather
from .tokens import documents as encoded

SHARD_TOKENS = 1 << 19
LEAST = 12
_MAGIC = b"RPB2"
_END = np.uint32(1 << 31)


def _frequent(seq: np.ndarray, heavy: np.ndarray, place: np.ndarray, places: int, least: int):
    """Positions of pairs that occur least times or more, the number of each one's pair, and the pairs (left << 32 | right).

    While many positions are left, pairs are told apart by their place in a hash table; of pairs that share a place, the
    others wait for a later round.  Few positions are sorted, which leaves out none.
    """
    pairs = (seq[heavy].astype(np.uint64) << np.uint64(32)) | seq[heavy + 1]
    for exact in (False, True) if len(heavy) * 8 > len(seq) else (True,):
        if exact:
            met, group = np.unique(pairs, return_inverse=True)
            at = heavy
        else:
            met, group = np.zeros(places, np.uint64), place[heavy]
            met[group] = pairs
            same = met[group] == pairs
            at, group = heavy[same], group[same]
        often = np.flatnonzero(np.bincount(group, minlength=len(met)) >= least)
        if len(often):
            break
    number = np.full(len(met), -1, np.int64)
    number[often] = np.arange(len(often))
    number = number[group]
    kept = number >= 0
    return at[kept], number[kept], met[often]


def compress(ids: np.ndarray, ends: np.ndarray, least: int = LEAST):
    """(first, rules, symbols, starts): rules[k] is the pair that nonterminal first + k stands for; starts has the first
    symbol of each document, and the end.  ends has the position of each document's last id, where no pair starts."""
    first, seq, rules, following = int(ids.max(initial=0)) + 1, ids.astype(np.uint32), [np.zeros((0, 2), np.uint32)], 0
    seq[ends] |= _END
    bits = min(max(len(seq).bit_length() - 2, 10), 22)
    hashed, place = np.empty(len(seq), np.uint32), np.empty(len(seq), np.int64)
    while len(seq) > 1:
        # a hash of each pair, in place; the multiplier differs from round to round
        h, p = hashed[: len(seq) - 1], place[: len(seq) - 1]
        np.multiply(seq[:-1], np.uint32(0x9E3779B1), out=h)
        np.add(h, seq[1:], out=h)
        np.multiply(h, np.uint32((0x85EBCA6B + (len(rules) << 9)) & 0xFFFFFFFF), out=h)
        np.right_shift(h, np.uint32(32 - bits), out=h)
        p[:] = h
        heavy = np.flatnonzero((np.bincount(p, minlength=1 << bits) >= least)[p])
        heavy = heavy[seq[heavy] < _END]
        at, number, pairs = _frequent(seq, heavy, p, 1 << bits, least)
        if not len(at):
            break
        # of matches that overlap (neighbours in the sequence), every second one from the left is replaced
        k = np.arange(len(at))
        even = (k - np.maximum.accumulate(np.where(np.diff(at, prepend=-2) > 1, k, 0))) % 2 == 0
        at, number = at[even], number[even]
        rules.append(np.stack((pairs >> np.uint64(32), pairs & np.uint64(_END - 1)), 1).astype(np.uint32))
        seq[at] = (first + following + number).astype(np.uint32) | (seq[at + 1] & _END)
        following += len(pairs)
        if first + following >= _END:
            raise ValueError("ids and nonterminals have to stay below 2 ** 31")
        keep = np.ones(len(seq), bool)
        keep[at + 1] = False
        seq = seq[keep]
    return first, np.concatenate(rules), seq & ~_END, np.append(0, np.flatnonzero(seq >= _END) + 1)


def pack(values: np.ndarray, bits: int) -> bytes:
    """Values in so many bits each, lowest bit first."""
    return np.packbits(np.unpackbits(values.astype("<u4").view(np.uint8).reshape(-1, 4), axis=1, count=bits, bitorder="little"), bitorder="little").tobytes()


def unpack(data: bytes, bits: int, n: int) -> np.ndarray:
    out = np.zeros((n, 32), np.uint8)
    out[:, :bits] = np.unpackbits(np.frombuffer(data, np.uint8), count=n * bits, bitorder="little").reshape(n, bits)
    return np.packbits(out, axis=1, bitorder="little").view("<u4").ravel()


def _expand(first: int, rules: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All symbols' expansions end to end, where each begins, and their lengths; level by level, as rules refer to earlier ones."""
    symbols, owner = rules.astype(np.int64).ravel(), np.repeat(np.arange(len(rules)), 2)
    while (rule := symbols >= first).any():
        size = 1 + rule
        at = cuts(size)[:-1]
        out, owner = np.repeat(symbols, size), np.repeat(owner, size)
        out[at[rule]], out[at[rule] + 1] = rules[symbols[rule] - first, 0], rules[symbols[rule] - first, 1]
        symbols = out
    lengths = np.concatenate((np.ones(first, np.int64), np.bincount(owner, minlength=len(rules))))
    return np.concatenate((np.arange(first), symbols)).astype("<u4"), cuts(lengths)[:-1], lengths


def write_shard(doc_ids: list, ids: np.ndarray, counts: np.ndarray, **options) -> bytes:
    """One shard of documents, their ids end to end, end ids included."""
    ends = cuts(counts)
    first, rules, symbols, starts = compress(ids, ends[1:] - 1, **options)
    lengths = _expand(first, rules)[2][first:]
    bits, length_bits = max(1, (first + len(rules) - 1).bit_length()), max(1, int(lengths.max(initial=0)).bit_length())
    null = np.array([i is None for i in doc_ids], np.uint8)
    packed = pack(rules[:, 0], bits), pack(rules[:, 1], bits), pack(lengths, length_bits), pack(symbols, bits)
    head = struct.pack("<7IQ", len(doc_ids), len(symbols), len(rules), first, bits, length_bits, max(1, (first - 1).bit_length()), sum(map(len, packed)))
    table = np.array([i or 0 for i in doc_ids], "<i8"), null, starts.astype("<u4"), ends.astype("<u4")
    return b"".join((_MAGIC, head, *[t.tobytes() for t in table], *packed))


class Shard:
    """A shard read back."""

    def __init__(self, data: bytes):
        if data[:4] != _MAGIC:
            raise ValueError("not a shard of this format")
        docs, symbols, rules, self.first, bits, length_bits, _, self.packed_bytes = struct.unpack_from("<7IQ", data, 4)
        at = 40

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(data, kind, n, at)
            at += out.nbytes
            return out

        def bits_of(n: int, width: int) -> np.ndarray:
            return unpack(take("u1", -(-n * width // 8)).tobytes(), width, n)

        ids, null = take("<i8", docs), take("u1", docs)
        self.doc_ids = [None if z else i for i, z in zip(ids.tolist(), null.tolist())]
        self.first_symbol, self.first_token = take("<u4", docs + 1).astype(np.int64), take("<u4", docs + 1).astype(np.int64)
        self.rules = np.stack((bits_of(rules, bits), bits_of(rules, bits)), 1)
        self.expanded = bits_of(rules, length_bits).astype(np.int64)
        self.symbols = bits_of(symbols, bits).astype(np.int64)

    def all_ids(self) -> np.ndarray:
        """The ids of all documents, end to end."""
        pool, starts, lengths = _expand(self.first, self.rules)
        return gather(pool, starts[self.symbols], lengths[self.symbols])

    def document(self, k: int) -> np.ndarray:
        """The ids of the k-th document alone."""
        return self.ids(k, 0, int(self.first_token[k + 1] - self.first_token[k]))

    def ids(self, k: int, start: int, stop: int) -> np.ndarray:
        """The ids from start to stop of the k-th document; symbols and rules outside are skipped by their lengths."""
        symbols = self.symbols[self.first_symbol[k] : self.first_symbol[k + 1]]
        rule = symbols >= self.first
        lengths = np.ones(len(symbols), np.int64)
        lengths[rule] = self.expanded[symbols[rule] - self.first]
        ends = np.cumsum(lengths)
        low, high = int(np.searchsorted(ends, start, "right")), int(np.searchsorted(ends, stop, "left")) + 1
        at, out = int(ends[low - 1]) if low else 0, []
        stack = symbols[low:high].tolist()[::-1]
        while stack and at < stop:
            x = stack.pop()
            size = int(self.expanded[x - self.first]) if x >= self.first else 1
            if at + size <= start:
                at += size
            elif x >= self.first:
                stack += self.rules[x - self.first].tolist()[::-1]
            else:
                out.append(x)
                at += 1
        return np.array(out, "<u4")


SHARDS = "range int, shard int, range_start long, n_docs long, n_tokens long, data binary"


def write(documents: DataFrame, path: str | None = None, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """The shards of all documents, one row each, stored in the shared folder; ranges ascend in doc_id."""
    path = path or default_path()
    key = F.xxhash64("text")

    def work(batches):
        number, shard, before = TaskContext.get().partitionId(), 0, 0
        held, size = [], 0

        def out():
            nonlocal held, size, shard, before
            ids, counts = np.concatenate([h[1] for h in held]), np.concatenate([h[2] for h in held])
            data = write_shard([i for h in held for i in h[0]], ids, counts)
            row = pa.RecordBatch.from_pydict({k.split()[0]: [v] for k, v in zip(SHARDS.split(", "), (number, shard, before, len(counts), size, data))}, pa.schema(_FIELDS))
            held, size, shard, before = [], 0, shard + 1, before + size
            return row

        for doc_ids, ids, counts in encoded(batches, encoder(path)):
            ends = cuts(counts)
            at = 0
            while at < len(counts):
                # whole documents until the shard is full
                to = min(len(counts), int(np.searchsorted(ends, ends[at] + shard_tokens - size, "left")))
                held.append((doc_ids[at:to], ids[ends[at] : ends[to]], counts[at:to]))
                size, at = size + int(ends[to] - ends[at]), to
                if size >= shard_tokens:
                    yield out()
        if held:
            yield out()

    # the sampling job that finds the ranges runs on the scan alone, as encoding comes after the exchange
    ranged = documents.select("doc_id", "text").repartitionByRange(F.col("doc_id").asc_nulls_first(), key)
    return stored(ranged.sortWithinPartitions(F.col("doc_id").asc_nulls_first(), key).mapInArrow(work, SHARDS), "grammar")


_FIELDS = [("range", pa.int32()), ("shard", pa.int32()), ("range_start", pa.int64()), ("n_docs", pa.int64()), ("n_tokens", pa.int64()), ("data", pa.binary())]


def read(shards: DataFrame) -> DataFrame:
    """Per document: doc_id, start (ids of all documents before it), n_tokens and ids_crc32, from the stored shards."""
    from pyspark.sql import Window as W

    # one row per range, of which there are as many as shuffle partitions
    totals = shards.groupBy("range").agg(F.sum("n_tokens").alias("n"))
    before = W.orderBy("range").rowsBetween(W.unboundedPreceding, -1)
    starts = totals.select("range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    placed = shards.join(F.broadcast(starts), "range").select((F.col("before") + F.col("range_start")).alias("at"), "data")

    def decode(batches):
        for batch in batches:
            for at, data in zip(batch.column("at").to_pylist(), batch.column("data")):
                shard = Shard(data.as_buffer().to_pybytes())
                ids, bounds = shard.all_ids().data.cast("B"), shard.first_token
                crc = [zlib.crc32(ids[4 * a : 4 * b]) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
                columns = [pa.array(shard.doc_ids, pa.int64()), pa.array(at + bounds[:-1]), pa.array(np.diff(bounds)), pa.array(crc, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return placed.mapInArrow(decode, "doc_id long, start long, n_tokens long, ids_crc32 long")
