"""MinHash near-duplicates with b-bit signatures.

1. Each text becomes a set of shingles (64-bit hashes), ``BANDS * ROWS`` minima, and from these a key per band and a
   signature of the minima's low ``BITS`` bits.  Texts with equal sets are one class with a number of its own; steps 2
   to 4 know classes by that number only, so null and repeated ids are as good as any.
2. Classes that share a band key are candidates.  Each is first compared with its bucket's smallest member, by the
   collision-corrected estimate from counting equal bits of the packed signatures; buckets in which some comparison
   fails are compared in full, in blocks, and give a spanning forest of the pairs with a sufficient estimate.
3. The connected candidates are clusters.  Their members meet in blocks; pairs whose estimate is within ``MARGIN`` of
   the threshold or above are verified on the full shingle sets, unless verified links connect them already.
4. Components of verified links are the groups of near-duplicates.

A pair at the threshold is missed by the bands with probability (1 - t**ROWS)**BANDS (5e-7 at 0.8, 1e-10 at 0.85), and by the
margin with about 3e-7; neither depends on the size of groups: no bucket, cluster or group is capped or sampled.

Texts without words have empty sets and are linked with nothing; null and empty texts count as such; texts with fewer
words than a shingle are one shingle; repeated rows are one class; rows with a null doc_id take part by their class
and get its component, which is the smallest doc_id of a group, or null where no row of the group has one; texts that
repeat a doc_id are told apart by their hash; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import held, small, stored
from .components import Forest, components

BANDS, ROWS, BITS, MARGIN, SEED = 48, 6, 2, 0.14, 20240131
BLOCK = 512
BROADCAST_ROWS = 200_000
LANES = 64 // BITS
LONGS = BANDS * ROWS // LANES


def words(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


class _Words(dict):
    """Hashes of words, up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 150_000:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def shingles(text: str | None, size: int) -> np.ndarray:
    """The distinct shingles of a text as sorted 64-bit hashes."""
    w = words(text)
    if not w:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(held("words", _Words).__getitem__, w), np.uint64, len(w))
    n = max(1, len(w) - size + 1)
    out = np.full(n, min(size, len(w)), np.uint64)
    for k in range(min(size, len(w))):
        out = _mix(out + h[k : k + n] * np.uint64(2 * k + 1))
    return np.unique(out)


@lru_cache(1)
def _functions() -> tuple[np.ndarray, np.ndarray]:
    random = np.random.default_rng(SEED)
    return random.integers(0, 1 << 32, BANDS * ROWS, np.uint32) | np.uint32(1), random.integers(0, 1 << 32, BANDS * ROWS, np.uint32)


def minima(hashes: np.ndarray, at_once: int = 2048) -> np.ndarray:
    """The minimum of each hash function over a set that is not empty."""
    a, b = _functions()
    low = (hashes >> np.uint64(32)).astype(np.uint32)
    out = np.full(len(a), 0xFFFFFFFF, np.uint32)
    for k in range(0, len(low), at_once):
        out = np.minimum(out, (low[k : k + at_once] * a[:, None] + b[:, None]).min(1))
    return out


def band_keys(mins: np.ndarray) -> np.ndarray:
    """A 64-bit key for each band of each row of minima."""
    parts = mins.reshape(-1, BANDS, ROWS).astype(np.uint64)
    out = np.tile(np.arange(BANDS, dtype=np.uint64), (len(parts), 1))
    for k in range(ROWS):
        out = _mix(out * np.uint64(31) + parts[:, :, k])
    return out.view(np.int64)


def signatures(mins: np.ndarray) -> np.ndarray:
    """The minima's low bits, packed into longs."""
    lanes = (mins & np.uint32((1 << BITS) - 1)).reshape(-1, LONGS, LANES).astype(np.uint64)
    return np.bitwise_or.reduce(lanes << (np.arange(LANES, dtype=np.uint64) * np.uint64(BITS)), axis=2).view(np.int64)


_LOW = sum(1 << (BITS * k) for k in range(LANES))


def similarity(equal):
    """The estimate for a count of equal lanes, corrected for chance collisions of the low bits."""
    chance = 2.0**-BITS
    return (equal / (BANDS * ROWS) - chance) / (1 - chance)


def _equal_lanes(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Equal lanes of every signature in a with every one in b."""
    out = np.full((len(a), len(b)), BANDS * ROWS, np.int64)
    for k in range(LONGS):
        x = a[:, None, k].view(np.uint64) ^ b[None, :, k].view(np.uint64)
        out -= np.bitwise_count((x | (x >> np.uint64(1))) & np.uint64(_LOW))
    return out


def _equal_column(a: Column, b: Column) -> Column:
    """The same for two array<long> columns, in the JVM."""
    low = _LOW - (1 << 64) if _LOW >= 1 << 63 else _LOW
    lanes = F.zip_with(a, b, lambda x, y: F.bit_count((x.bitwiseXOR(y)).bitwiseOR(F.shiftrightunsigned(x.bitwiseXOR(y), 1)).bitwiseAND(F.lit(low))))
    return BANDS * ROWS - F.aggregate(lanes, F.lit(0), lambda s, v: s + v)


SIGNED = "doc_id long, copy long, n_shingles long, set_a long, set_b long, bands array<long>, signature array<long>"


def signed(documents: DataFrame, size: int) -> DataFrame:
    """Set size, set digest, band keys and signature per document; copy tells texts of one doc_id apart."""

    def work(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                sets = [shingles(t, size) for t in part.column("text").to_pylist()]
                full = np.array([len(s) > 0 for s in sets])
                mins = np.array([minima(s) if len(s) else np.zeros(BANDS * ROWS, np.uint32) for s in sets], np.uint32)
                first = [int(s.sum(dtype=np.uint64)) for s in sets]
                second = [int(_mix(s ^ np.uint64(SEED)).sum(dtype=np.uint64)) for s in sets]
                longs = lambda x: pa.array(np.array(x, np.uint64).view(np.int64))
                lists = lambda m: pa.array([r if f else [] for r, f in zip(m.tolist(), full)], pa.list_(pa.int64()))
                columns = [part.column("doc_id"), part.column("copy"), pa.array([len(s) for s in sets], pa.int64()), longs(first), longs(second), lists(band_keys(mins)), lists(signatures(mins))]
                yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in SIGNED.split(", ")])

    return documents.select("doc_id", "text", F.xxhash64("text").alias("copy")).select("doc_id", "copy", "text").mapInArrow(work, SIGNED)


def _bucket_forests(threshold: float):
    """From rows sorted by unit (a bucket, or two blocks of one), a spanning forest of each unit's sufficient pairs."""

    def links(ids, sides, sigs):
        sig, ids = np.array(sigs, np.int64), np.array(ids)
        one = np.flatnonzero(np.array(sides) == 0)
        two = np.flatnonzero(np.array(sides) == 1)
        if not len(two):
            two = one
        near = np.zeros((len(ids), len(ids)), bool)
        near[np.ix_(one, two)] = similarity(_equal_lanes(sig[one], sig[two])) >= threshold
        return [(int(ids[i]), int(ids[j])) for i, j in spanning(near | near.T)]

    return links


def spanning(near: np.ndarray) -> list[tuple[int, int]]:
    """The edges of a spanning forest of a symmetric adjacency matrix."""
    left, out = np.ones(len(near), bool), []
    for start in range(len(near)):
        if left[start]:
            left[start], stack = False, [start]
            while stack:
                x = stack.pop()
                new = np.flatnonzero(near[x] & left).tolist()
                left[new] = False
                out += [(x, y) for y in new]
                stack += new
    return out


def shared(a: np.ndarray, b: np.ndarray) -> int:
    """How many values two sorted sets have in common; the first may not be empty, nor the second."""
    return int(np.count_nonzero(b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a))


def _cluster_links(size: int, percent: int):
    """From rows sorted by unit (a cluster, or two blocks of one), verified links that connect what can be connected."""
    least = percent / 100 - MARGIN

    def links(ids, sides, sigs, texts):
        sig, ids = np.array(sigs, np.int64), np.array(ids)
        one = np.flatnonzero(np.array(sides) == 0)
        two = np.flatnonzero(np.array(sides) == 1)
        inside = not len(two)
        two = one if inside else two
        estimate = similarity(_equal_lanes(sig[one], sig[two]))
        if inside:
            estimate[np.tril_indices(len(one))] = -1
        i, j = np.nonzero(estimate >= least)
        order = np.argsort(-estimate[i, j], kind="stable")
        forest, out, sets = Forest(), [], {}
        for x, y in zip(one[i[order]].tolist(), two[j[order]].tolist()):
            if forest.find(x) == forest.find(y):
                continue
            for k in (x, y):
                if k not in sets:
                    sets[k] = shingles(texts[k], size)
            a, b = sets[x], sets[y]
            if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
                continue
            common = shared(a, b)
            if 100 * common >= percent * (len(a) + len(b) - common):
                forest.join(x, y)
                out.append((int(ids[x]), int(ids[y])))
        return out

    return links


def _by_unit(links, columns: list[str]):
    """links applied to each run of rows with the same unit, for mapInArrow over sorted partitions."""

    def work(batches):
        unit, held = None, {c: [] for c in columns}

        def done():
            pairs = links(*(held[c] for c in columns)) if held[columns[0]] else []
            return pa.RecordBatch.from_arrays([pa.array([p[0] for p in pairs], pa.int64()), pa.array([p[1] for p in pairs], pa.int64())], names=["a", "b"])

        for batch in batches:
            key = batch.column("unit").to_pylist()
            values = [batch.column(c).to_pylist() for c in columns]
            for k, row in zip(key, zip(*values)):
                if k != unit:
                    if len(held[columns[0]]) > 1:
                        yield done()
                    unit, held = k, {c: [] for c in columns}
                for c, v in zip(columns, row):
                    held[c].append(v)
        if len(held[columns[0]]) > 1:
            yield done()

    return work


def _units(rows: DataFrame, group: str, members: DataFrame) -> DataFrame:
    """rows (id, group, ..) dealt to units: groups of at most BLOCK members are one unit, larger ones one for each two blocks.

    members: group and n, its number of members.  side tells the two blocks of a unit apart.
    """
    sized = rows.join(members, group)
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("id", F.lit(7)), blocks).cast("int")
    spread = sized.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    pair = (F.least("own", "other"), F.greatest("own", "other"))
    side = F.when(F.col("own") > F.col("other"), 1).otherwise(0)
    return spread.select(*rows.columns, side.alias("side"), F.xxhash64(group, *pair).alias("unit"))


def candidates(classes: DataFrame, threshold: float) -> DataFrame:
    """Pairs (a, b) whose components hold every pair of classes that shares a band key with a sufficient estimate."""
    keys = classes.select("id", F.explode("bands").alias("key"))
    buckets = stored(keys.groupBy("key").agg(F.min("id").alias("leader"), F.count("*").alias("n")).where("n > 1"), "buckets")
    inside = stored(keys.join(buckets, "key"), "bucketed")
    pairs = inside.where("id <> leader").select("id", "leader").distinct()
    signs = classes.select("id", "signature")
    signs_of_leader = classes.select(F.col("id").alias("leader"), F.col("signature").alias("other"))
    judged = pairs.join(signs, "id").join(signs_of_leader, "leader")
    judged = judged.select("id", "leader", (similarity(_equal_column(F.col("signature"), F.col("other"))) >= threshold).alias("near"))
    judged = stored(judged, "judged")
    stars = judged.where("near").select(F.col("id").alias("a"), F.col("leader").alias("b"))
    far = judged.where("NOT near").select("id", "leader")
    mixed = inside.join(far, ["id", "leader"], "left_semi").select("key").distinct()
    rest = inside.join(mixed, "key", "left_semi").select("id", "key")
    units = _units(rest.join(signs, "id"), "key", buckets.select("key", "n"))
    more = units.repartition("unit").sortWithinPartitions("unit", "id").select("unit", "id", "side", "signature")
    return stars.union(more.mapInArrow(_by_unit(_bucket_forests(threshold), ["id", "side", "signature"]), "a long, b long"))


def links(documents: DataFrame, classes: DataFrame, size: int, percent: int) -> DataFrame:
    """Verified links between classes; their components are those of all links."""
    clusters = stored(components(candidates(classes, percent / 100 - MARGIN)).withColumnRenamed("root", "cluster"), "clusters")
    members = clusters.groupBy("cluster").agg(F.count("*").alias("n"))
    wanted = small(clusters.join(classes.select(F.col("id").alias("node"), "first", "signature"), "node"), BROADCAST_ROWS)
    texts = documents.select("doc_id", "text", F.xxhash64("text").alias("copy"))
    same = texts["doc_id"].eqNullSafe(wanted["first.doc_id"]) & (texts["copy"] == wanted["first.copy"])
    rows = texts.join(wanted, same).select(F.col("node").alias("id"), "cluster", "signature", "text").dropDuplicates(["id"])
    units = _units(rows, "cluster", members)
    work = _by_unit(_cluster_links(size, percent), ["id", "side", "signature", "text"])
    return units.repartition("unit").sortWithinPartitions("unit", "id").select("unit", "id", "side", "signature", "text").mapInArrow(work, "a long, b long")


def _first() -> Column:
    """The smallest doc_id with its text's hash; null ids come last."""
    return F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "copy"))


def judged(documents: DataFrame, size: int, percent: int) -> DataFrame:
    """doc_id, copy, n_shingles, component_id and kept per document; kept holds for one doc_id and copy of each group."""
    every = stored(signed(documents, size), "signed")
    full = every.where("n_shingles > 0")
    # equal sets have equal bands and signatures, so any member's will do
    classes = full.groupBy("set_a", "set_b", "n_shingles").agg(_first().alias("first"), F.count("*").alias("members"), F.first("bands").alias("bands"), F.first("signature").alias("signature"))
    # the numbers hold from here on, as classes are read from what is stored
    classes = stored(classes.withColumn("id", F.monotonically_increasing_id()), "classes")
    roots = stored(components(links(documents, classes, size, percent)), "roots")
    rooted = classes.select("set_a", "set_b", "n_shingles", "id", "members", "first").join(roots, F.col("id") == F.col("node"), "left")
    # what is alone in its class and group needs no row here
    grouped = stored(rooted.where("members > 1 OR root IS NOT NULL").withColumn("root", F.coalesce("root", "id")), "grouped")
    groups = grouped.groupBy("root").agg(F.min("first").alias("first"))
    grouped = grouped.select("set_a", "set_b", "n_shingles", "root").join(groups, "root").drop("root")
    out = every.select("doc_id", "copy", "n_shingles", "set_a", "set_b").join(stored(grouped, "groups"), ["set_a", "set_b", "n_shingles"], "left")
    alone = F.col("first").isNull()
    component = F.when(alone, F.col("doc_id")).otherwise(F.col("first.doc_id"))
    kept = alone | (F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("copy") == F.col("first.copy")))
    return out.select("doc_id", "copy", "n_shingles", component.alias("component_id"), kept.alias("kept"))


def near_copies(documents: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id and kept per document, for shingles of size words and a similarity of percent / 100.

    Each row whose doc_id is its component_id is kept, so rows that repeat that doc_id are as well; keep_first() takes one of them.
    """
    return judged(documents, size, percent).drop("copy").withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def keep_first(documents: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """One document of each group of near-duplicates, the one with the smallest id; columns as before.

    Of rows that repeat a doc_id and its text, one stays; only such rows, and those of groups, are looked for, so that texts
    are shuffled by key only where the keys to be found exceed the broadcast's bound.
    """
    verdicts = stored(judged(documents, size, percent).select("doc_id", "copy", "kept"), "verdicts")
    gone = small(verdicts.where("NOT kept").select("doc_id", "copy").distinct(), BROADCAST_ROWS)
    repeated = verdicts.where("kept").groupBy("doc_id", "copy").agg(F.count("*").alias("n")).where("n > 1").select("doc_id", "copy")
    repeated = small(repeated, BROADCAST_ROWS)

    def same(keys: DataFrame) -> Column:
        return documents["doc_id"].eqNullSafe(keys["doc_id"]) & (F.xxhash64(documents["text"]) == keys["copy"])

    left = documents.join(gone, same(gone), "left_anti")
    single = left.join(repeated, same(repeated), "left_anti")
    return single.unionByName(left.join(repeated, same(repeated), "left_semi").dropDuplicates(["doc_id", "text"]))


#: near_copies(documents, 3, 85) by brute force: every pair that shares a shingle, then all that each document reaches.
SQL = r"""
with recursive w as (
  select doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') as w from documents),
s as (
  select doc_id, list_distinct(case when len(w) = 0 then [] when len(w) < 3 then [array_to_string(w, ' ')]
    else list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) end) as s from w),
n as (select doc_id, len(s)::bigint as n from s),
x as (select doc_id, unnest(s) as k from s),
c as (select a.doc_id as a, b.doc_id as b, count(*) as i from x a join x b on a.k = b.k and a.doc_id < b.doc_id group by all),
l as (select a, b from c join n p on p.doc_id = a join n q on q.doc_id = b where 100 * i >= 85 * (p.n + q.n - i)),
e as (select a, b from l union select b, a from l),
r as (select doc_id, doc_id as reached from n union select r.doc_id, e.b from r join e on r.reached = e.a)
select n.doc_id, n.n as n_shingles, m.component_id, n.doc_id = m.component_id as kept
from n join (select doc_id, min(reached) as component_id from r group by 1) m on n.doc_id = m.doc_id
"""
