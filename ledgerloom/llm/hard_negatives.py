"""Hard negatives of anchor vectors by inner product: an exact kNN join over a Voronoi partition.

Inner products become distances once candidates carry one more component, sqrt(M^2 - |x|^2) with M the largest norm, and
anchors carry 0 there: |q - x|^2 = |q|^2 + M^2 - 2 qx.  Some anchors serve as pivots; every vector belongs to the cell of
its nearest one.  The anchors of a cell are a group, at most PART of them in a part.  A group first meets the candidates of its
own cell, which gives each of its anchors a bound on what it still needs.  Then every other candidate is copied only to the
groups that it might serve, told by its distance to the group's pivot and the group's radius, and each copy is joined exactly
in the group's part.  Candidates of a (group, part) are dealt to slices of about SLICE rows, as are the copies of its anchors, so
no task holds more than a part and a slice, even where all vectors fall into one cell.

Scores are integers and exact: products run in doubles where no sum can leave their exact range, else in Python's integers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import stored

#: Anchors for each pivot, and the most pivots: what is broadcast about them has so many rows at most.
GROUP, PIVOTS = 2048, 1024
#: Anchors in a part and, about, candidates in a slice.
PART, SLICE = 2048, 4096
#: Labels share so many entries of a group's bounds.
LABELS = 64
EXACT = float(1 << 53)
SLACK = 1e-9

#: key tells apart rows of the same vec_id
VECTOR = "vec_id long, label long, v binary, norm2 double"
KEYED = f"{VECTOR}, key long"


def usable(rows: DataFrame, label: Column, scale: float = 256.0) -> DataFrame:
    """vec_id, label, v (the components floor(scale * x) as doubles), norm2 and key of the rows that take part.

    Rows with a null vec_id, label or vector, or with a null or non-finite component, do not.  Rows that repeat vec_id, label and
    vector count once; other rows of the same vec_id are vectors of their own.
    """

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            values = [np.asarray(v, "<f8") for v in pdf["vector"]]
            yield pdf[["vec_id", "label"]].assign(v=[v.tobytes() for v in values], norm2=[float(v @ v) for v in values])

    x = F.transform(rows["embedding"], lambda c: c.cast("double"))
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf"))))
    floored = F.transform(x, lambda c: c * F.lit(scale))
    some = rows["vec_id"].isNotNull() & label.isNotNull() & rows["embedding"].isNotNull() & finite
    kept = rows.where(some).select(rows["vec_id"].cast("long").alias("vec_id"), label.cast("long").alias("label"), floored.alias("vector"))

    def floor(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        return pack(pdf.assign(vector=[np.floor(v) for v in pdf["vector"]]) for pdf in batches)

    return kept.mapInPandas(floor, VECTOR).withColumn("key", F.xxhash64("label", "v")).dropDuplicates(["vec_id", "key"])


def matrix(blobs, width: int = 0) -> np.ndarray:
    """Vectors as rows of one matrix; shorter ones end in zeros."""
    rows = [np.frombuffer(b, "<f8") for b in blobs]
    width = max([width, *map(len, rows)])
    if all(len(r) == width for r in rows):
        return np.vstack(rows) if rows else np.zeros((0, width))
    return np.vstack([np.pad(r, (0, width - len(r))) for r in rows])


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The exact inner products of the rows of a and b; integers of any size where doubles could round."""
    width = max(a.shape[1], b.shape[1])
    a, b = (np.pad(m, ((0, 0), (0, width - m.shape[1]))) if m.shape[1] < width else m for m in (a, b))
    if not a.size or not b.size or np.abs(a).max() * np.abs(b).max() * width < EXACT:
        return (a @ b.T).astype("i8")
    whole = [np.array([[int(x) for x in row] for row in m], dtype=object) for m in (a, b)]
    return whole[0] @ whole[1].T


def distances(v: np.ndarray, rise2: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Distances of rows of v, whose further component is the root of rise2, from pivots, whose further one is 0."""
    width = max(v.shape[1], pivots.shape[1])
    v, pivots = (np.pad(m, ((0, 0), (0, width - m.shape[1]))) for m in (v, pivots))
    square = (v * v).sum(1)[:, None] + (pivots * pivots).sum(1)[None] - 2 * (v @ pivots.T) + rise2[:, None]
    return np.sqrt(np.maximum(square, 0))


def _pivots(anchors: DataFrame, count: int) -> np.ndarray:
    """The vectors of at most PIVOTS anchors, taken by a hash of their ids."""
    pivots = min(PIVOTS, max(1, -(-count // GROUP)))
    taken = anchors.select("v", "key", F.xxhash64("vec_id").alias("h"), "vec_id").orderBy("h", "vec_id", "key").limit(pivots).collect()
    return matrix([r["v"] for r in taken])


def _bucket(label: pd.Series) -> np.ndarray:
    return label.to_numpy() % LABELS


class Groups:
    """What is known of the groups of anchors, by pivot: a bounded table that travels with the tasks."""

    def __init__(self, pivots: np.ndarray, most2: float, sizes: list, members: list):
        n = len(pivots)
        self.pivots, self.most2 = pivots, most2
        self.slices = np.ones(n, "i8")
        self.parts, self.radius, self.least2, self.largest2 = np.zeros(n, "i8"), np.zeros(n), np.full(n, np.inf), np.zeros(n)
        for cell, count in sizes:
            self.slices[cell] = max(1, -(-count // SLICE))
        for cell, count, radius, least2, largest2 in members:
            self.parts[cell] = -(-count // PART)
            self.radius[cell], self.least2[cell], self.largest2[cell] = radius, least2, largest2

    def highest(self, d: np.ndarray) -> np.ndarray:
        """No anchor of a group scores higher with a candidate at distance d from its pivot."""
        near = np.maximum(d - self.radius, 0)
        return (self.largest2 + self.most2 - near * near) / 2 + SLACK * (1 + self.largest2 + self.most2 + d * d)

    def lowest(self, d: np.ndarray) -> np.ndarray:
        """No anchor of a group scores lower with a candidate at distance d from its pivot."""
        far = d + self.radius
        least2 = np.where(np.isinf(self.least2), 0, self.least2)
        return (least2 + self.most2 - far * far) / 2 - SLACK * (1 + least2 + self.most2 + far * far)


def assigned(vectors: DataFrame, pivots: np.ndarray, most2: float) -> DataFrame:
    """vectors with their cell and their distance from its pivot; most2 is the square of the largest norm, 0 for anchors."""

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            norm2 = pdf["norm2"].to_numpy()
            d = distances(matrix(pdf["v"]), np.maximum(most2 - norm2, 0) if most2 else np.zeros(len(pdf)), pivots) if len(pdf) else np.zeros((0, 1))
            cell = d.argmin(1)
            yield pdf.assign(cell=cell, away=d[np.arange(len(pdf)), cell])

    return vectors.mapInPandas(assign, f"{KEYED}, cell long, away double")


def _copies(groups: Groups, serves) -> callable:
    """Copies of candidates to the groups and parts that serves (distances, labels, cells) allows, each in its slice."""

    def copy(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if not len(pdf):
                continue
            d = distances(matrix(pdf["v"]), np.maximum(groups.most2 - pdf["norm2"].to_numpy(), 0), groups.pivots)
            fits = serves(d, pdf["label"], pdf["cell"].to_numpy()) & (groups.parts > 0)
            row, group = np.nonzero(fits)
            times = groups.parts[group]
            row, group = np.repeat(row, times), np.repeat(group, times)
            part = np.concatenate([np.arange(t) for t in times]) if len(times) else np.zeros(0, "i8")
            # a cell's candidates are dealt to its slices by their ids
            home = pdf["cell"].to_numpy()[row]
            piece = (pd.util.hash_array(pdf["vec_id"].to_numpy()) % groups.slices[pdf["cell"].to_numpy()].astype("u8")).astype("i8")[row]
            for at in range(0, len(row), 10_000):
                s = slice(at, at + 10_000)
                yield pdf.iloc[row[s]][["vec_id", "key", "label", "v"]].assign(grp=group[s], part=part[s], home=home[s], piece=piece[s])

    return copy


UNIT = ["grp", "part", "home", "piece"]


def _meet(anchors: DataFrame, candidates: DataFrame, groups: Groups, serves, join, schema: str) -> DataFrame:
    """join(a part of anchors, a slice of candidates) wherever serves lets a candidate go to the part's group."""
    copies = candidates.mapInPandas(_copies(groups, serves), "vec_id long, key long, label long, v binary, grp long, part long, home long, piece long")
    copies = stored(copies, "copies")
    # a part of anchors goes to the slices that hold anything for it
    slices = copies.groupBy(*[F.col(c).alias(f"to_{c}") for c in UNIT]).agg(F.count("*").alias("n")).drop("n")
    there = anchors.join(slices, (F.col("grp") == F.col("to_grp")) & (F.col("part") == F.col("to_part")))

    def unit(a: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        return join(a, c) if len(a) and len(c) else pd.DataFrame({k.split()[0]: [] for k in schema.split(", ")})

    return there.groupBy(*[f"to_{c}" for c in UNIT]).cogroup(copies.groupBy(*UNIT)).applyInPandas(unit, schema)


POSITIVE = "anchor_id long, anchor_key long, other_id long, other_key long, score long"
NEGATIVE = "anchor_id long, anchor_key long, positive_id long, positive_key long, positive_score long, negative_id long, negative_key long, negative_score long"


def _nearest(count: int):
    """The count best others of an anchor's label among a slice; ties by id."""

    def join(a: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        out = []
        c = c.sort_values(["vec_id", "key"], kind="stable")
        for label, mine in a.groupby("label"):
            others = c[c["label"] == label]
            if not len(others):
                continue
            scores = products(matrix(mine["v"]), matrix(others["v"]))
            order = np.argsort(-scores, axis=1, kind="stable")[:, : count + 1]
            ids, keys = others["vec_id"].to_numpy(), others["key"].to_numpy()
            for i, (vec_id, key) in enumerate(zip(mine["vec_id"], mine["key"])):
                best = [j for j in order[i] if ids[j] != vec_id or keys[j] != key][:count]
                out += [(vec_id, key, ids[j], keys[j], scores[i, j]) for j in best]
        return pd.DataFrame(out, columns=[k.split()[0] for k in POSITIVE.split(", ")])

    return join


def _window(score, low: int, high: int) -> tuple[int, int]:
    """The least and the largest score of a negative for a positive's score."""
    return -(-low * int(score) // 100), high * int(score) // 100


def _in_window(count: int, low: int, high: int):
    """The count best candidates of another label, for each of an anchor's positives, within its window; ties by id."""

    def join(a: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        out = []
        c = c.sort_values(["vec_id", "key"], kind="stable")
        ids, keys, labels, theirs = c["vec_id"].to_numpy(), c["key"].to_numpy(), c["label"].to_numpy(), matrix(c["v"])
        for at in range(0, len(a), 256):
            some = a.iloc[at : at + 256]
            scores = products(matrix(some["v"]), theirs)
            order = np.argsort(-scores, axis=1, kind="stable")
            for i, r in enumerate(some.itertuples()):
                ranked = order[i][labels[order[i]] != r.label]
                falling = -scores[i, ranked]
                for positive, its_key, score in zip(r.positives, r.positive_keys, r.positive_scores):
                    least, largest = _window(score, low, high)
                    first = np.searchsorted(falling, -largest, "left")
                    best = [j for j in ranked[first : first + count] if scores[i, j] >= least]
                    out += [(r.vec_id, r.key, positive, its_key, score, ids[j], keys[j], scores[i, j]) for j in best]
        return pd.DataFrame(out, columns=[k.split()[0] for k in NEGATIVE.split(", ")])

    return join


def _top(found: DataFrame, by: list[str], score: str, ties: list[str], count: int) -> DataFrame:
    """best: the count rows of each group by falling score, then by ties; each task limits its groups before rows are shuffled."""
    order = W.partitionBy(*by).orderBy(F.desc(score), *ties)
    few = found.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= count)
    best = F.array_sort(F.collect_list(F.struct((-F.col(score)).alias("low"), *ties)))
    return few.groupBy(*by).agg(best.alias("best"))


def _last(found: DataFrame, by: list[str], score: str, ties: list[str], count: int, name: str) -> DataFrame:
    """by and the score of the count-th best row of each group, null if it has fewer."""
    return _top(found, by, score, ties, count).select(*by, (-F.get("best.low", count - 1)).alias(name))


def mine(vectors: DataFrame, anchor: Column, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score of usable vectors.

    The rows for which anchor holds are anchors.  An anchor's positives are its best other vectors of its label; for each, the best
    vectors of other labels with low * positive_score <= 100 * negative_score <= high * positive_score are its negatives, ranked from 1.
    Scores fall, ties go by smaller vec_id, then by key.  No anchor, no other row of its label or no vector in the window:
    no rows.  Vectors of unequal length are compared as if the shorter one ended in zeros, so an empty one scores 0 with all.
    """
    spark = vectors.sparkSession
    vectors = stored(vectors, "vectors")
    chosen = vectors.where(anchor)
    known = vectors.agg(F.max("norm2").alias("most2"), F.count_if(anchor).alias("anchors")).first()
    out = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if not known["anchors"]:
        return spark.createDataFrame([], out)
    most2 = float(known["most2"])
    pivots = _pivots(chosen, known["anchors"])
    cells = stored(assigned(vectors, pivots, most2), "cells")
    group = stored(assigned(chosen, pivots, 0.0), "groups")
    sizes = [(r["cell"], r["count"]) for r in cells.groupBy("cell").count().collect()]
    extent = group.groupBy("cell").agg(F.count("*"), F.max("away"), F.min("norm2"), F.max("norm2")).collect()
    groups = Groups(pivots, most2, sizes, [tuple(r) for r in extent])
    parts = F.element_at(F.lit([int(p) for p in groups.parts]), (F.col("cell") + 1).cast("int"))
    # equal parts by a hash of the ids: at most about PART anchors each
    part = F.pmod(F.xxhash64("vec_id", "key"), F.greatest(parts, F.lit(1)))
    group = group.select("vec_id", "key", "label", "v", F.col("cell").alias("grp"), part.alias("part"))
    count, own = len(pivots), {"anchor_id": "vec_id", "anchor_key": "key"}

    def home(d, label, cell):
        return cell[:, None] == np.arange(count)[None]

    # positives: of the own cell, then of whatever cell might hold better ones
    first = stored(_meet(group, cells, groups, home, _nearest(positives), POSITIVE), "positives")
    bucket = F.pmod(F.col("label"), F.lit(LABELS))
    worst = _last(first.withColumnsRenamed(own), ["vec_id", "key"], "score", ["other_id", "other_key"], positives, "worst")
    need = group.join(worst, ["vec_id", "key"], "left")
    need = need.groupBy("grp", bucket.alias("bucket")).agg(F.min(F.coalesce(F.col("worst").cast("double"), F.lit(float("-inf")))).alias("worst"))
    bound = np.full((count, LABELS), np.inf)
    for r in need.collect():
        bound[r["grp"], r["bucket"]] = r["worst"]

    def better(d, label, cell):
        return ~home(d, label, cell) & (groups.highest(d) >= bound[:, _bucket(label)].T)

    rest = first if count == 1 else first.unionByName(_meet(group, cells, groups, better, _nearest(positives), POSITIVE))
    ranked = _top(rest, ["anchor_id", "anchor_key"], "score", ["other_id", "other_key"], positives)
    with_positives = ranked.select(
        F.col("anchor_id").alias("vec_id"), F.col("anchor_key").alias("key"), F.col("best.other_id").alias("positives"),
        F.col("best.other_key").alias("positive_keys"), F.transform("best.low", lambda s: -s).alias("positive_scores"),
    )
    seekers = stored(group.join(with_positives, ["vec_id", "key"]), "seekers")

    # negatives: the same way, with the windows of the group's anchors as bounds
    near = stored(_meet(seekers, cells, groups, home, _in_window(negatives, low, high), NEGATIVE), "negatives")
    windows = seekers.select("vec_id", "key", "grp", F.explode(F.arrays_zip("positives", "positive_keys", "positive_scores")).alias("p"))
    windows = windows.select("vec_id", "key", "grp", F.col("p.positives").alias("positive_id"), F.col("p.positive_keys").alias("positive_key"), F.col("p.positive_scores").alias("score"))
    third = _last(near.withColumnsRenamed(own), ["vec_id", "key", "positive_id", "positive_key"], "negative_score", ["negative_id", "negative_key"], negatives, "third")
    least = F.greatest(F.col("score") * low / 100, F.coalesce(F.col("third"), F.col("score") * low / 100))
    need = windows.join(third, ["vec_id", "key", "positive_id", "positive_key"], "left").groupBy("grp").agg(F.min(least.cast("double")).alias("least"), F.max(F.col("score") * high / 100).alias("largest"))
    lo, hi = np.full(count, np.inf), np.full(count, -np.inf)
    for r in need.collect():
        lo[r["grp"]], hi[r["grp"]] = r["least"] - 1, r["largest"] + 1

    def inside(d, label, cell):
        return ~home(d, label, cell) & (groups.highest(d) >= lo) & (groups.lowest(d) <= hi)

    rest = near if count == 1 else near.unionByName(_meet(seekers, cells, groups, inside, _in_window(negatives, low, high), NEGATIVE))
    best = _top(rest, ["anchor_id", "anchor_key", "positive_id", "positive_key", "positive_score"], "negative_score", ["negative_id", "negative_key"], negatives)
    told = best.select("anchor_id", "positive_id", "positive_score", F.posexplode("best").alias("at", "n"))
    return told.select("anchor_id", "positive_id", (F.col("at") + 1).cast("int").alias("rank"), "n.negative_id", "positive_score", (-F.col("n.low")).alias("negative_score"))


SQL = """
with f as (select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label, list_transform(embedding, lambda x: floor(256 * x::double)) as v from embeddings
  where label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (select a.vec_id as a, b.vec_id as b, a.label as la, b.label as lb, list_inner_product(a.v, b.v)::bigint as s from f a join f b on a.vec_id <> b.vec_id where a.vec_id % 50 = 0),
p as (select a, b, s from s where la = lb qualify row_number() over (partition by a order by s desc, b) <= 5),
n as (select p.a, p.b as positive_id, p.s as positive_score, s.b as negative_id, s.s as negative_score, row_number() over (partition by p.a, p.b order by s.s desc, s.b) as rank
  from p join s on p.a = s.a and la <> lb and 50 * p.s <= 100 * s.s and 100 * s.s <= 95 * p.s)
select a as anchor_id, positive_id, rank::int as rank, negative_id, positive_score, negative_score from n where rank <= 3
"""
