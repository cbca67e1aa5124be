"""Toxicity by a subsequence string-kernel SVM on Nystrom landmarks.

A text is a bag of units: its lowered tokens, and runs of single characters joined ("i d i o t", "i-d-i-o-t").  The
gap-weighted subsequence kernel of order ``ORDER`` compares a unit with the landmarks; every skipped character costs a
factor ``DECAY``, so insults stay close to their landmark when characters are inserted.  With landmark kernel matrix K
and kernel vector k(u), features are K^-1/2 k(u), and a linear SVM (squared hinge) decides.  Labels are per text, so
training is multiple-instance: of a toxic text count the units that toxic texts have far more often than chance
explains (by G squared), with variants that have characters inserted, and in texts without such a unit the one that
decides highest; of a clean text all.  A text's score is a logistic function of its ``TOP`` highest decisions.

A landmark whose longest common subsequence with the unit covers less than ``COVER`` of it counts as kernel 0, in
training as in scoring; the test is bit-parallel, and spares most words the kernel.

The model is fitted on the driver from at most ``SAMPLE`` labelled texts of training rows, the ones whose hashed id is
smallest, an equal bound for either label; scoring covers every whole text.  Null and empty texts, and texts of blanks,
have no units and get the lowest score; where no training labels, or labels of one kind only, exist, every score is 0;
equal texts get equal scores; several labels for a doc_id count separately; other columns are not read.
"""

from __future__ import annotations

import heapq
import re
from collections import Counter
from collections.abc import Iterable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held

ORDER, DECAY, COVER, TOP, RIDGE, MOST = 4, 0.5, 0.75, 1, 0.05, 1.2
LANDMARKS, SAMPLE, LONGEST = 96, 3000, 40
EVIDENCE, C, WEIGHT, CLEAN = 16.0, 30.0, 1000.0, 60.0
FOLDS = 5
_SPACED = re.compile(r"(?:(?<=\s)|^)\S(?:\s\S){2,}(?=\s|$)")
#: Every unit is written between these, so that its ends count as characters.
START, STOP = "\x02", "\x03"
_SIGNS = re.compile(r"\w(?:[^\w\s]+\w){2,}")
_EDGE = ".,;:!?\"'()[]"


def units(text: str | None) -> set[str]:
    """The distinct units of a text; of a very long token, its stretches of LONGEST characters, overlapping by half."""
    if not text:
        return set()
    low = text.lower()
    out = {w if w.isalpha() else w.strip(_EDGE) for w in set(low.split())}
    for m in _SPACED.finditer(low):
        out.add("".join(m[0].split()))
    for w in [w for w in out if len(w) > LONGEST or not w.isalnum()]:
        if _SIGNS.fullmatch(w):
            out.add("".join(c for c in w if c.isalnum()))
        if len(w) <= LONGEST:
            continue
        out.discard(w)
        out.update(w[i : i + LONGEST] for i in range(0, len(w) - LONGEST // 2, LONGEST // 2))
    out.discard("")
    return {START + w + STOP for w in out}


def _padded(texts: list[str], fill: int) -> tuple[np.ndarray, np.ndarray]:
    """Code points, one row each, and lengths."""
    lengths = np.array([len(t) for t in texts], np.int64)
    out = np.full((len(texts), int(lengths.max(initial=1))), fill, np.int32)
    out[np.arange(out.shape[1]) < lengths[:, None]] = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.int32)
    return out, lengths


def raw_kernel(a: list[str], b: list[str], order: int = ORDER, decay: float = DECAY) -> np.ndarray:
    """Gap-weighted subsequence kernel of a[i] with b[i], by the usual recursion over prefixes, all pairs at once."""
    if not a:
        return np.zeros(0)
    x, _ = _padded(a, -1)
    y, _ = _padded(b, -2)
    width = y.shape[1]
    x, y = x.T.copy(), y.T.copy()
    # inner[p][k]: weight of common subsequences of length p of a's characters so far and b's first k
    inner = [np.ones((width + 1, len(a)))] + [np.zeros((width + 1, len(a))) for _ in range(order - 1)]
    total = np.zeros(len(a))
    for row in x:
        same = (row == y) * decay**2
        total += (same * inner[order - 1][:-1]).sum(0)
        for p in range(order - 1, 0, -1):
            add = same * inner[p - 1][:-1]
            for k in range(1, width):
                add[k] += decay * add[k - 1]
            inner[p] *= decay
            inner[p][1:] += add
    return total


def subsequence_kernel(a: list[str], b: list[str], pairs: tuple[np.ndarray, np.ndarray] | None = None, at_once: int = 2048) -> np.ndarray:
    """The normalised kernel of every a with every b; with pairs (positions in a and b), of those only, others 0."""
    i, j = pairs if pairs is not None else (np.repeat(np.arange(len(a)), len(b)), np.tile(np.arange(len(b)), len(a)))
    raw = np.zeros(len(i))
    for k in range(0, len(i), at_once):
        raw[k : k + at_once] = raw_kernel([a[n] for n in i[k : k + at_once].tolist()], [b[n] for n in j[k : k + at_once].tolist()])
    used = np.unique(i)
    own, norm = np.zeros(len(a)), raw_kernel(b, b)
    for k in range(0, len(used), at_once):
        some = [a[n] for n in used[k : k + at_once].tolist()]
        own[used[k : k + at_once]] = raw_kernel(some, some)
    out = np.zeros((len(a), len(b)))
    both = np.sqrt(own[i] * norm[j])
    out[i, j] = np.divide(raw, both, out=np.zeros_like(raw), where=both > 0)
    return out


def common_subsequence(a: list[str], b: list[str], at_once: int = 512) -> np.ndarray:
    """Length of the longest common subsequence of every a with every b (of at most 63 characters), bit-parallel."""
    kind = np.uint32 if max(map(len, b), default=0) < 32 else np.uint64
    alphabet = {c: k + 1 for k, c in enumerate(sorted({ord(c) for t in b for c in t[:63]}))}
    masks = np.zeros((len(alphabet) + 1, len(b)), kind)
    for j, t in enumerate(b):
        for k, c in enumerate(t[:63]):
            masks[alphabet[ord(c)], j] |= kind(1 << k)
    known, place = np.array([0, *alphabet]), np.array([0, *alphabet.values()])
    full = np.array([(1 << min(63, len(t))) - 1 for t in b], kind)
    out = np.zeros((len(a), len(b)), np.int64)
    for i in range(0, len(a), at_once):
        x, _ = _padded(a[i : i + at_once], -1)
        slot = np.minimum(np.searchsorted(known, x), len(known) - 1)
        codes = np.where(known[slot] == x, place[slot], 0)
        v = np.tile(full, (len(x), 1))
        m, t = np.empty_like(v), np.empty_like(v)
        for s in range(x.shape[1]):
            np.take(masks, codes[:, s], axis=0, out=m)
            np.bitwise_and(v, m, out=m)
            np.add(v, m, out=t)
            np.subtract(v, m, out=v)
            np.bitwise_or(v, t, out=v)
        out[i : i + at_once] = np.bitwise_count(full & ~v)
    return out


def _near(texts: list[str], landmarks: list[str]) -> np.ndarray:
    """Which landmarks each unit has in large part as a subsequence."""
    need = np.array([int(np.ceil(COVER * len(t))) for t in landmarks])
    return common_subsequence(texts, landmarks) >= need


def _features(texts: list[str], landmarks: list[str], at_once: int = 4096) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the units that have a near landmark, and their kernel with the landmarks near to them."""
    order = np.array(sorted(range(len(texts)), key=lambda k: len(texts[k])), np.int64)
    where, rows = [np.zeros(0, np.int64)], [np.zeros((0, len(landmarks)))]
    for i in range(0, len(order), at_once):
        near = _near([texts[k] for k in order[i : i + at_once].tolist()], landmarks)
        some = np.flatnonzero(near.any(1))
        if len(some):
            where.append(order[i + some])
            rows.append(subsequence_kernel([texts[k] for k in where[-1].tolist()], landmarks, np.nonzero(near[some])))
    return np.concatenate(where), np.concatenate(rows)


class Model:
    """Landmarks, the SVM in kernel space (decision = k(u) . alpha + bias) and the logistic weights of a text's TOP decisions."""

    def __init__(self, landmarks: list[str], alpha: np.ndarray, bias: float, scale: np.ndarray):
        self.landmarks, self.alpha, self.bias, self.scale = landmarks, alpha, bias, scale

    def decisions(self, texts: list[str]) -> np.ndarray:
        """The SVM's decision for each unit."""
        out = np.full(len(texts), self.bias)
        where, rows = _features(texts, self.landmarks)
        out[where] += rows @ self.alpha
        return out

    def top(self, decisions: list[float]) -> list[float]:
        return _top(decisions, self.bias)

    def probability(self, top: np.ndarray) -> np.ndarray:
        """Of texts, by their TOP decisions in falling order."""
        return 1 / (1 + np.exp(-np.clip(top @ self.scale[:-1] + self.scale[-1], -30, 30)))


def _top(decisions: list[float], floor: float) -> list[float]:
    best = [min(max(x, floor), MOST) for x in heapq.nlargest(TOP, decisions)]
    return best + [floor] * (TOP - len(best))


def variants(unit: str) -> list[str]:
    """The unit with characters inserted, doubled and spaced out, as further examples of it."""
    word = unit[1:-1]
    out = ["-".join(word), ".".join(word)]
    for k in (1, len(word) // 2, len(word) - 1):
        out += [word[:k] + c + word[k:] for c in ("x", "*", word[k])]
    return [START + w + STOP for w in out]


def _svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray, c: float, rounds: int = 30, at_once: int = 4096) -> np.ndarray:
    """Primal squared-hinge SVM by Newton steps; the last coefficient is the bias, which is hardly penalised."""
    x = np.hstack((x, np.ones((len(x), 1))))
    w, ridge = np.zeros(x.shape[1]), np.full(x.shape[1], 1.0)
    ridge[-1] = 1e-3
    active = np.ones(len(x), bool)
    for _ in range(rounds):
        gram, target = np.diag(ridge), np.zeros(x.shape[1])
        rows = np.flatnonzero(active)
        for k in range(0, len(rows), at_once):
            some = rows[k : k + at_once]
            xa, wa = x[some], c * weight[some]
            gram += (xa * wa[:, None]).T @ xa
            target += (wa * y[some]) @ xa
        w = np.linalg.solve(gram, target)
        now = y * (x @ w) < 1
        if (now == active).all():
            break
        active = now
    return w


def _logistic(d: np.ndarray, y: np.ndarray, rounds: int = 50) -> np.ndarray:
    """Platt scaling of a text's TOP decisions, with his smoothed targets; no weight is negative; the last is the offset."""
    t = np.where(y > 0, (y.sum() + 1) / (y.sum() + 2), 1 / (len(y) - y.sum() + 2))
    use = np.ones(d.shape[1], bool)
    while True:
        x = np.hstack((d[:, use], np.ones((len(d), 1))))
        w = np.zeros(x.shape[1])
        for _ in range(rounds):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            w = w + np.linalg.solve((x * (p * (1 - p) + 1e-6)[:, None]).T @ x + 1e-2 * np.eye(len(w)), x.T @ (t - p) - 1e-2 * w)
        if (w[:-1] >= 0).all() or not use.any():
            break
        use[np.flatnonzero(use)[np.argmin(w[:-1])]] = False
    out = np.zeros(d.shape[1] + 1)
    out[:-1][use], out[-1] = w[:-1], w[-1]
    return out


def _evidence(k: np.ndarray, n: np.ndarray, n_pos: int, n_neg: int) -> np.ndarray:
    """Log-likelihood ratio (G squared) of a unit being in k toxic and n clean texts, against one rate for both."""
    share = (k + n) / (n_pos + n_neg)
    part = lambda x, size: np.where(x > 0, x * np.log(np.maximum(x, 1e-9) / (size * share)), 0.0)
    return 2 * (part(k, n_pos) + part(n, n_neg) + part(n_pos - k, n_pos * (1 - share) / share) + part(n_neg - n, n_neg * (1 - share) / share))


def _choose(positive: Counter, negative: Counter, n_pos: int, n_neg: int, most: int) -> tuple[list[str], list[str]]:
    """Units that toxic texts have far more often than chance explains, and the clean units most like those."""
    seen = sorted(u for u, k in positive.items() if k >= 3 and len(u) >= ORDER + 2)
    k, n = (np.array([c[u] for u in seen], float) for c in (positive, negative))
    evidence = _evidence(k, n, n_pos, n_neg)
    good = np.flatnonzero((evidence >= EVIDENCE) & ((k + 0.5) / n_pos > 4 * (n + 0.5) / n_neg))
    telling = [seen[i] for i in good[np.argsort(-evidence[good], kind="stable")][: most * 3 // 4].tolist()]
    if not telling:
        return [], []
    clean = sorted((u for u, c in negative.items() if c >= 2 and ORDER + 2 <= len(u) <= 63 and positive[u] * n_neg <= 2 * c * n_pos), key=lambda u: (-negative[u], u))[:5000]
    if clean:
        close = common_subsequence(clean, telling) / np.array([len(t) for t in telling])
        clean = [clean[k] for k in np.argsort(-close.max(1), kind="stable")[: most - len(telling)].tolist()]
    return telling, clean


def fit(labelled: Iterable[tuple[str, int]], landmarks: int = LANDMARKS, c: float = C, rounds: int = 2) -> Model | None:
    """The model of (text, label) rows, or None where they don't tell toxic from clean.  Copies of a text count once."""
    one: dict[str, str] = {}  # a unit is held once, however many texts have it
    bags = [(tuple(one.setdefault(u, u) for u in units(t)), int(y)) for t, y in sorted({(t or "", y) for t, y in labelled})]
    n_pos, n_neg = sum(y for _, y in bags), sum(1 - y for _, y in bags)
    if not n_pos or not n_neg:
        return None
    one.clear()
    positive, negative = Counter(), Counter()
    for bag, y in bags:
        (positive if y else negative).update(bag)
    telling, close = _choose(positive, negative, n_pos, n_neg, landmarks)
    if not telling:
        return None
    chosen = telling + close
    values, vectors = np.linalg.eigh(subsequence_kernel(chosen, chosen))
    root = vectors @ np.diag(1 / np.sqrt(np.maximum(values, RIDGE))) @ vectors.T
    every = sorted(set(positive) | set(negative))
    where, rows = _features(every, chosen)
    near, x = [every[k] for k in where.tolist()], rows @ root
    del rows
    number = {u: k for k, u in enumerate(near)}
    inside = [[number[u] for u in bag if u in number] for bag, _ in bags]
    clean = np.array([negative[u] for u in near], float)
    sure = {number[u] for u in telling}
    held, decision, w = np.flatnonzero(clean), None, None
    for _ in range(rounds):
        witness = Counter()
        for found, (_, y) in zip(inside, bags):
            if y:
                own = [r for r in found if r in sure]
                if not own and found and decision is not None:  # the unit that decides highest, if it does
                    own = [r for r in [max(found, key=lambda r: (decision[r], -r))] if decision[r] > 0]
                witness.update(own)
        seen = sorted(witness)
        altered = [v for r in seen if len(near[r]) >= 6 and r in sure for v in variants(near[r])]
        got, more = _features(altered, chosen)
        own = np.array([witness[r] for r in seen], float)
        weights = (own / own.sum(), np.full(len(got), 0.5 / max(1, len(got))), CLEAN * np.log1p(clean[held]) / np.log1p(clean[held]).sum())
        y = np.concatenate((np.ones(len(seen) + len(got)), -np.ones(len(held))))
        w = _svm(np.concatenate((x[seen], more @ root, x[held])), y, np.concatenate(weights) * WEIGHT, c)
        decision = x @ w[:-1] + w[-1]
    floor = float(w[-1])
    top = np.array([_top([decision[r] for r in found], floor) for found in inside])
    return Model(chosen, root @ w[:-1], floor, _logistic(top, np.array([y for _, y in bags], float)))


def held_out(doc_id):
    """Whether a row is outside the training folds."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")), F.lit(0)) % FOLDS == 0


def train(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model | None:
    """The model of a bounded sample of labelled training rows, up to half of it of either label."""
    known = labels.select("doc_id", "toxic").where("toxic in (0, 1)").where(~held_out(F.col("doc_id"))).join(documents.select("doc_id").distinct(), "doc_id", "left_semi")
    rows = []
    for label in (1, 0):
        # the ids are chosen first: only the texts of at most sample / 2 of them leave the scan, and as many come here
        order = [F.xxhash64("doc_id"), "doc_id"]
        ids = F.broadcast(known.where(F.col("toxic") == label).select("doc_id").distinct().orderBy(*order).limit(sample // 2))
        texts = documents.select("doc_id", "text").join(ids, "doc_id", "left_semi").orderBy(*order, F.xxhash64("text")).limit(sample // 2)
        rows += [(r["text"], label) for r in texts.select("text").toLocalIterator()]
    return fit(rows)


class Scorer:
    """Scores texts with one model, remembering the decisions of units."""

    def __init__(self, model: Model | None, most: int = 250_000):
        self.model, self.known, self.most = model, {}, most

    def scores(self, texts: list[str | None], at_once: int = 256) -> np.ndarray:
        """A score for each text; the units of at_once texts are held at a time."""
        if self.model is None:
            return np.zeros(len(texts))
        return np.concatenate([self._some(texts[k : k + at_once]) for k in range(0, len(texts), at_once)] or [np.zeros(0)])

    def _some(self, texts: list[str | None]) -> np.ndarray:
        bags = [units(t) for t in texts]
        if len(self.known) > self.most:
            self.known.clear()
        new = sorted({u for bag in bags for u in bag if u not in self.known})
        self.known.update(zip(new, self.model.decisions(new).tolist()))
        return self.model.probability(np.array([self.model.top(list(map(self.known.__getitem__, bag))) for bag in bags]).reshape(-1, TOP))


def _scorer(shared) -> Scorer:
    """One per worker process and broadcast model."""
    return held(("scorer", shared.id), lambda: Scorer(shared.value))


class _Shared:
    def __init__(self, broadcast, number: str):
        self.broadcast, self.id = broadcast, number

    @property
    def value(self):
        return self.broadcast.value


def _broadcast(df: DataFrame, model: Model | None) -> _Shared:
    import uuid

    return _Shared(df.sparkSession.sparkContext.broadcast(model), uuid.uuid4().hex)


def score(documents: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, held_out, score and predicted per document."""
    shared = _broadcast(documents, model)

    def work(batches):
        for pdf in batches:
            p = _scorer(shared).scores(pdf["text"].tolist())
            yield pd.DataFrame({"doc_id": pdf["doc_id"].astype("Int64"), "held_out": pdf["held_out"], "score": p, "predicted": (p >= 0.5).astype(np.int32)})

    rows = documents.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    return rows.mapInPandas(work, "doc_id long, held_out boolean, score double, predicted int")


def keep_clean(documents: DataFrame, model: Model | None) -> DataFrame:
    """The documents that the model does not call toxic; columns and repeated rows as before."""
    shared = _broadcast(documents, model)

    def work(batches):
        for batch in batches:
            p = _scorer(shared).scores(batch.column("text").to_pylist())
            yield batch.filter(pa.array(p < 0.5))

    return documents.mapInArrow(work, documents.schema)
