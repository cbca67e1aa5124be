"""op11, op12 and op13 on edge cases, against brute force; tests of their SQL are with the other operators'."""

import hashlib
import itertools
import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import digest_runs, filter_lattice, hard_negatives

TEXTS = [
    (5, "a  b"), (3, "a\t\nb"), (9, "a b"), (7, "a b "), (1, ""), (2, None), (4, " "), (6, "\x0b\x0c"), (8, "a b"), (5, "a b"), (None, "a b"), (None, "only"), (None, "only"), (10, "x" * 300_000), (11, "x" * 300_000),
    (12, "same"), (12, "same"), (13, "A b"),
]


def norm(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


@pytest.mark.parametrize("rows", [TEXTS, [], [(i, "hot" if i % 3 else f"text {i // 2}") for i in range(3000)]], ids=["edges", "empty", "hot"])
def test_exact_copies(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("run", F.lit("clash")).withColumn("keep_id", F.lit(1)).repartition(13)
    got = sorted((tuple(r) for r in digest_runs.exact_copies(df).collect()), key=repr)
    groups = {}
    for i, t in rows:
        groups.setdefault(norm(t), []).append(i)
    least = {t: min((i for i in ids if i is not None), default=None) for t, ids in groups.items()}
    want = [(i, least[norm(t)], len(groups[norm(t)]), i == least[norm(t)], hashlib.sha256(norm(t).encode()).hexdigest()) for i, t in rows]
    assert got == sorted(want, key=repr)
    kept = digest_runs.keep_first(df)
    assert kept.columns == df.columns
    assert sorted((r["doc_id"], norm(r["text"])) for r in kept.where("doc_id IS NOT NULL").collect()) == sorted({(i, norm(t)) for i, t, *_ in rows if i is not None and i == least[norm(t)]})
    assert kept.where("doc_id IS NULL").count() == len({norm(t) for i, t in rows if least[norm(t)] is None})


def test_rounds_merge_runs(spark):
    """A round leaves a digest once in each run that it makes, and the smallest identifier at every level."""
    schema = "run int, digest binary, size int, second long, keep_id long, members long"
    entries = [(r, bytes([d]), 1, 0, 100 * r + d, 1) for r in range(64) for d in range(3)] + [(0, b"\0", 2, 0, 5, 1)]
    once = digest_runs.merged(spark.createDataFrame(entries, schema)).collect()
    assert len(once) == 4 * 3 + 1  # another size is another text
    assert all(r["keep_id"] == 100 * 16 * r["run"] + r["digest"][0] and r["members"] == 16 for r in once if r["size"] == 1)


def fails(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    tests = [len(words) < 200, 100 * len(set(words)) < 50 * len(words), 100 * len(re.findall("[A-Z]", text)) > 3 * len(text), bool(re.search(r"[#$%&*|]", text))]
    return {"ABCD"[i] for i, t in enumerate(tests) if t}


def brute_audit(docs, labels):
    good, toxic = ({i for i, *marks in labels if marks[k] == 1} for k in (0, 1))
    rows = []
    for i, t, lang in docs:
        mask = fails(t or "")
        if i is not None and any(j is not None and j < i and (u or "") == (t or "") for j, u, _ in docs):
            mask.add("E")
        rows.append((lang or "", mask, i in good and i is not None, i in toxic and i is not None))
    out, shapley = [], Counter()
    for part in {r[0] for r in rows}:
        for order in itertools.permutations("ABCDE"):
            left, gone = [r for r in rows if r[0] == part], []
            for step, f in enumerate(order, 1):
                here = [r for r in left if f in r[1]]
                unique = sum(r[1] == {f} for r in rows if r[0] == part)
                redundant = sum(f in r[1] for r in gone)
                left, gone = [r for r in left if f not in r[1]], gone + here
                out.append((part, "".join(order), step, len(left), len(here), redundant, unique, sum(r[2] for r in here), sum(r[3] for r in here)))
                shapley[part, f] += len(here)
    return sorted((*r, shapley[r[0], r[1][r[2] - 1]]) for r in out)


def test_filter_audit(spark):
    rng = random.Random(3)
    long = " ".join(f"w{i}" for i in range(250))
    texts = ["", None, "short", "LOUD", "a $ b", long, long + " #", "A B C " * 100, "x " * 60_000, long.upper(), long + " é"]
    docs = [(i, rng.choice(texts), rng.choice(["en", "de", None, ""])) for i in range(120)] + [(7, long, "en"), (7, long, "en"), (None, long, "de")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1])) for i in range(0, 120, 2)] + [(4, 1, 1), (None, 1, 1)]
    schema = "doc_id long, text string, lang string"
    df = spark.createDataFrame(docs, schema).withColumn("part", F.lit(0)).withColumn("mask", F.lit("clash"))
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("lang", F.lit("clash"))
    got = filter_lattice.audit(df, marks)
    assert sorted(map(tuple, got.collect())) == brute_audit(docs, labels)
    edges = filter_lattice.edges(filter_lattice.classes(df, marks))
    assert edges.groupBy("part").count().select("count").distinct().collect() == [(80,)]
    assert filter_lattice.audit(spark.createDataFrame([], schema), marks.limit(0)).count() == 0


def brute_mine(rows):
    rows = sorted({(i, l, tuple(math.floor(256 * x) for x in v)) for i, l, v in rows if i is not None and l is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)})
    out = []
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    for q in (r for r in rows if r[0] % 50 == 0):
        scored = sorted(((-dot(q[2], r[2]), r[0], r) for r in rows if r != q), key=lambda x: x[:2])
        for s, p, _ in [x for x in scored if x[2][1] == q[1]][:5]:
            fits = [(n, m) for m, n, r in scored if r[1] != q[1] and -50 * s <= -100 * m <= -95 * s][:3]
            out += [(q[0], p, k, n, -s, -m) for k, (n, m) in enumerate(fits, 1)]
    return sorted(out)


def vectors(seed, n, clusters, spread):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(6)] for _ in range(clusters)]
    return [(i, rng.randrange(3), [c + rng.gauss(0, spread) for c in rng.choice(centres)]) for i in range(n)]


EDGES = [
    (0, 1, [1.0, 0.5]), (0, 1, [1.0, 0.5]), (1, 1, [1.0, 0.5]), (2, 1, [0.9, 0.5]), (3, 2, [0.6, 0.5]), (4, 2, [0.6, 0.5]), (5, None, [0.6, 0.5]), (6, 2, None), (7, 2, [None, 0.5]), (8, 2, [float("nan"), 1.0]),
    (9, 2, [float("inf"), 1.0]), (10, 2, []), (11, 2, [0.7]), (None, 2, [0.6, 0.5]), (50, 3, [1.0, 1.0]), (100, 2, []), (12, 2, [0.8, 0.1, 7.0]), (13, 1, [-1.0, -1.0]), (150, 1, [0.0, 0.0]),
]
HOT = [(i, i % 4, [0.5, 0.25] if i % 3 else [0.4, 0.01 * (i % 50)]) for i in range(400)]


@pytest.mark.parametrize("rows", [EDGES, [], vectors(1, 500, 5, 0.2), vectors(2, 400, 400, 1.0), HOT, [(0, 1, [3e38]), (1, 1, [1e-30]), (50, 2, [1.0])]], ids=["edges", "empty", "clusters", "even", "hot", "huge"])
@pytest.mark.parametrize("small", [False, True], ids=["one group", "many groups"])
def test_hard_negatives(spark, monkeypatch, rows, small):
    if small:
        for name, value in {"GROUP": 2, "PART": 2, "SLICE": 50}.items():
            monkeypatch.setattr(hard_negatives, name, value)
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>").withColumn("v", F.lit("clash")).withColumn("key", F.lit(1))
    found = hard_negatives.mine(hard_negatives.usable(df, df["label"]), F.col("vec_id") % 50 == 0)
    assert sorted(map(tuple, found.collect())) == brute_mine([tuple(r)[:3] for r in df.collect()])


def test_products_of_any_size():
    np = hard_negatives.np
    a, b = np.array([[2.0**40, 1.0]]), np.array([[2.0**22, 1.0]])
    assert int(hard_negatives.products(a, b)[0, 0]) == 2**62 + 1


def test_bounds_spare_groups(spark, monkeypatch):
    """On clustered vectors most candidates are copied to fewer groups than there are."""
    monkeypatch.setattr(hard_negatives, "GROUP", 2)
    made = []
    keep = hard_negatives.stored
    monkeypatch.setattr(hard_negatives, "stored", lambda df, name: made.append((name, r := keep(df, name))) or r)
    rows = vectors(5, 1500, 8, 0.05)
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>")
    hard_negatives.mine(hard_negatives.usable(df, df["label"]), F.col("vec_id") % 50 == 0).count()
    counts = [df.count() for name, df in made if name == "copies"]
    assert counts[1] < 0.5 * 14 * len(rows)
