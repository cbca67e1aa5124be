"""Operators on documents: edge cases, round trips and brute force."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerloom.llm import components, decontaminate, grammar_store, near_copies, packing, progressive_jpeg, tokens, toxicity

SCHEMA = "doc_id long, text string"
EDGES = [(0, None), (1, ""), (2, "one"), (3, "two words"), (4, "Same text here now"), (5, "same TEXT here now"), (5, "same TEXT here now"), (None, "no id at all here"), (7, "é 漢字 <|endoftext|> \x1c x" * 3), (8, "long " * 30_000), (9, " \n\t ")]


def frame(spark, rows=EDGES):
    return spark.createDataFrame(rows, SCHEMA).withColumn("row", F.lit(1)).withColumn("unit", F.lit("clash")).withColumn("bands", F.lit(2))


LIBRARY = tokens.encoder(tokens.default_path())._library


def ids_of(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids + [tokens.END_ID]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_token_store(spark):
    got = grammar_store.read(grammar_store.write(frame(spark))).orderBy("start").collect()
    ordered = sorted(EDGES, key=lambda r: (r[0] is not None, r[0] or 0))
    at = 0
    for r, (doc_id, text) in zip(got, ordered, strict=True):
        ids = ids_of(text)
        assert (r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) == (doc_id, at, len(ids), crc(ids))
        at += len(ids)
    assert grammar_store.read(grammar_store.write(frame(spark, []))).count() == 0


def laid(docs):
    return np.array([x for d in docs for x in d], "<u4"), np.array([len(d) for d in docs])


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 5), max_size=60), min_size=1, max_size=12), st.integers(2, 5), st.data())
def test_grammar_round_trip(docs, least, data):
    docs = [d + [2] for d in docs]
    shard = grammar_store.Shard(grammar_store.write_shard(list(range(len(docs))), *laid(docs), least=least))
    assert shard.all_ids().tolist() == [x for d in docs for x in d]
    for k, d in enumerate(docs):
        start, stop = sorted((data.draw(st.integers(0, len(d))), data.draw(st.integers(0, len(d)))))
        assert shard.document(k).tolist() == d
        assert shard.ids(k, start, stop).tolist() == d[start:stop]
    # no pair is left that occurs often, copies of one symbol in a row aside, and none spans two documents
    pairs = Counter()
    for a, b in zip(shard.first_symbol, shard.first_symbol[1:]):
        pairs.update((x, y) for x, y in zip(shard.symbols[a : b - 2].tolist(), shard.symbols[a + 1 : b - 1].tolist()) if x != y)
    assert all(n < least for n in pairs.values())


def test_grammar_saves_space():
    rng = np.random.default_rng(5)
    words = [rng.integers(0, 49_408, rng.integers(1, 6)).tolist() for _ in range(4000)]
    docs = [[x for w in rng.zipf(1.3, 800) % 4000 for x in words[w]] + [2] for _ in range(60)]
    data = grammar_store.write_shard(list(range(60)), *laid(docs))
    assert len(data) < 0.8 * 2 * sum(map(len, docs))  # of plain 16-bit ids
    copies = grammar_store.write_shard(list(range(60)), *laid([docs[0]] * 60))
    assert len(copies) < 0.12 * 2 * 60 * len(docs[0])


def test_grammar_takes_large_ids():
    docs = [[70_000, 1 << 30, 70_000, 1 << 30, 2]] * 30
    assert grammar_store.Shard(grammar_store.write_shard(list(range(30)), *laid(docs))).document(7).tolist() == docs[0]
    with pytest.raises(ValueError):
        grammar_store.write_shard([0], *laid([[(1 << 31) - 1, 5] * 40]), least=2)


def test_encoder_is_the_tokenizer():
    rng = np.random.default_rng(2)
    letters = list("abzABZ09 '.,-sStTmM\t\n\x85\xa0\u3000\x1cßÄÖÜäöüéÉñ×÷İıſŒœΣς漢字e\u0301<|>_$²½🙂\u200d\u180e\xad")
    texts = ["".join(rng.choice(letters, rng.integers(0, 30))) for _ in range(3000)] + ["<|endoftext|>a", "", None, "a" * 5000]
    for most in (50, 400_000):
        ids, counts = tokens.Encoder(tokens.default_path(), most).encode(pa.array(texts))
        at = tokens.cuts(counts)
        assert all(LIBRARY.encode(t or "", add_special_tokens=False).ids == ids[a:b].tolist() for t, a, b in zip(texts, at, at[1:]))


def test_encoder_asks_the_model_once_a_piece():
    encoder = tokens.Encoder(tokens.default_path())
    tokenize, asked = encoder._tokenize, []
    encoder._tokenize = lambda piece: asked.append(piece) or tokenize(piece)
    texts = ["Word word. WORD, word### (word) it's It we've, 7word7", "word 've \u0130 word\u0130"]
    for _ in range(2):
        ids, counts = encoder.encode(pa.array(texts))
        assert ids.tolist() == [i for t in texts for i in ids_of(t)[:-1]] and counts.tolist() == [len(ids_of(t)) - 1 for t in texts]
    assert sorted(asked) == sorted(["word", ".", ",", "###", "(", ")", "it", "'s", "we", "'ve", "7"])


def test_pieces_are_cut_by_the_files_pattern():
    rng = np.random.default_rng(4)
    pattern = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ]+")
    words = ["".join(rng.choice(list("abstmdrevlSTMDREVLÀÖØÞßöøÿé09.-_!~") + ["'"] * 4, rng.integers(0, 9))) for _ in range(20_000)] + ["a×", "÷", "漢", "'S", "x'LL"]
    pieces, counts, other = tokens.pieces(pa.array(words))
    pieces, at = pieces.to_pylist(), tokens.cuts(counts)
    assert other.tolist() == [20_000, 20_001, 20_002]
    assert all(pieces[a:b] == pattern.findall(w.lower()) for k, (w, a, b) in enumerate(zip(words, at, at[1:])) if k not in other)


def test_encoder_takes_other_files():
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    texts = ["Two  words, Here", "", "a\n\n b <|endoftext|>"]
    encoder = tokens.Encoder(path)
    ids, counts = encoder.encode(pa.array(texts))
    assert not encoder._by_word
    assert ids.tolist() == [i for t in texts for i in encoder._library.encode(t, add_special_tokens=False).ids] and len(counts) == 3


def test_packing(spark):
    rows = EDGES + [(100 + k, f"word{k % 7} topic{k % 5} " * (k * 3)) for k in range(60)]
    got = packing.sequences(frame(spark, rows)).collect()
    seen = Counter()
    by_doc, by_sequence = {}, {}
    for r in got:
        by_doc.setdefault((r["doc_id"], r["doc_tokens"]), []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        assert zlib.crc32(bytes(r["ids"])) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"]
    for pieces in by_sequence.values():
        at = 0
        for offset, n in sorted(pieces):
            assert offset == at
            at += n
        assert at == packing.WINDOW or at & (at - 1) == 0
    for doc_id, text in rows:
        seen[doc_id, len(ids_of(text))] += 1
    assert {k: sum(r["length"] for r in v) for k, v in by_doc.items()} == {k: k[1] * n for k, n in seen.items()}
    (whole,) = [v for k, v in by_doc.items() if k[0] == 8]
    assert b"".join(bytes(r["ids"]) for r in sorted(whole, key=lambda r: r["start"])) == np.array(ids_of(EDGES[9][1]), "<u4").tobytes()
    assert packing.sequences(frame(spark, [])).count() == 0


def test_packing_brings_neighbours_together():
    rng = np.random.default_rng(1)
    topics = [rng.integers(0, 40_000, 30) for _ in range(20)]
    docs = [rng.choice(topics[k % 20], 100).tolist() for k in range(400)]
    together = Counter()
    for k, _, _, sequence, _ in packing.pack(*laid(docs), 1000):
        together[sequence, k % 20] += 1
    assert max(together.values()) >= 8 and np.mean(list(together.values())) > 4


def test_bm25_is_that_of_all_terms():
    rng = np.random.default_rng(3)
    docs = [(rng.zipf(1.2, rng.integers(1, 300)) % 500).tolist() for _ in range(120)]
    index, mean = packing.Index(*laid(docs)), np.mean([len(d) for d in docs])
    df = Counter(t for d in docs for t in set(d))
    for seed in range(0, 120, 7):
        want = np.zeros(len(docs))
        for k, d in enumerate(docs):
            tf = Counter(d)
            for t in set(docs[seed]) & set(d):
                if df[t] > 1:
                    want[k] += np.log1p((120 - df[t] + 0.5) / (df[t] + 0.5)) * tf[t] * 2.2 / (tf[t] + 1.2 * (0.25 + 0.75 * len(d) / mean))
        assert np.allclose(index.scores(seed), want)
        used = np.zeros(120, bool)
        used[[seed, 5]] = True
        assert index.neighbours(seed, used).tolist()[:20] == [k for k in np.argsort(-want, kind="stable").tolist() if not used[k] and want[k]][:20]


def test_signatures_bring_copies_together():
    rng = np.random.default_rng(4)
    docs = [rng.integers(3, 20_000, 200).tolist() for _ in range(300)]
    near = [d[:190] + rng.integers(3, 20_000, 10).tolist() for d in docs]
    ids, counts = laid(docs + near + [[2]])
    found = packing.signatures(ids, counts, packing.order(np.bincount(ids)))
    assert np.mean(found[0][:300] == found[0][300:600]) > 0.8
    assert all(len(f) == 601 for f in found) and np.isinf(found[1][600])


ITEMS = [("1", " ".join(f"w{k}" for k in range(20))), ("2", "short item Text"), ("3", None), ("4", ""), (None, "short item text"), ("6", "the the the the the the the the the the the the the the")]


def windows_brute(docs, items):
    known = {}
    for i, t in items:
        for w in decontaminate.windows(decontaminate.words(t)):
            known.setdefault(w, set()).add(i or "")
    out = []
    for doc_id, text in docs:
        w, hit, found = decontaminate.words(text), set(), set()
        for n in {len(k) for k in known}:
            for s in range(len(w) - n + 1):
                if tuple(w[s : s + n]) in known:
                    hit.update(range(s, s + n))
                    found |= known[tuple(w[s : s + n])]
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc_id, len(w), len(hit), len(found), digest, bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


@pytest.mark.parametrize("block_words", [decontaminate.BLOCK_WORDS, 20])
def test_decontamination(spark, block_words):
    docs = EDGES + [(20, "x " * 200 + "SHORT, item-text!"), (21, "x " * 1000 + "short item text"), (22, " ".join(f"w{k}" for k in range(3, 18))), (23, " ".join(f"w{k}" for k in range(3, 14))), (24, "the " * 15 + "short item text " * 2)]
    items = spark.createDataFrame(ITEMS, "item_id string, text string")
    got = [tuple(r) for r in decontaminate.contamination(frame(spark, docs), items, block_words=block_words).collect()]
    assert sorted(got, key=str) == windows_brute(docs, ITEMS)
    kept = decontaminate.keep_clean(frame(spark, docs), items, block_words=block_words)
    assert kept.columns == frame(spark).columns
    assert sorted(map(str, (r["doc_id"] for r in kept.collect()))) == sorted(str(r[0]) for r in got if not r[-1])
    assert decontaminate.contamination(frame(spark, []), items).count() == 0
    assert decontaminate.contamination(frame(spark), items.limit(0)).where("contaminated").count() == 0


@pytest.mark.parametrize("block_words", [decontaminate.BLOCK_WORDS, 20])
def test_decontamination_judges_each_row_by_its_text(spark, block_words):
    bad = " ".join(f"w{k}" for k in range(3, 18))
    docs = [(1, bad), (1, "clean words of the same id"), (None, bad), (None, "clean words without an id"), (2, bad), (2, bad), (3, None)]
    items = spark.createDataFrame(ITEMS, "item_id string, text string")
    kept = decontaminate.keep_clean(frame(spark, docs), items, block_words=block_words)
    assert sorted((str(r["doc_id"]), str(r["text"])) for r in kept.collect()) == [("1", "clean words of the same id"), ("3", "None"), ("None", "clean words without an id")]
    got = [tuple(r) for r in decontaminate.contamination(frame(spark, docs), items, block_words=block_words).collect()]
    assert sorted(got, key=str) == windows_brute(docs, ITEMS)


def near_brute(rows, size, percent):
    sets = []
    for _, t in rows:
        w = near_copies.words(t)
        sets.append(frozenset([tuple(w[i : i + size]) for i in range(len(w) - size + 1)] or ([tuple(w)] if w else [])))
    forest = components.Forest()
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                forest.join(i, j)
    group = {}
    for i in range(len(rows)):
        group.setdefault(forest.find(i), []).append(rows[i][0])
    smallest = {r: min((x for x in g if x is not None), default=None) for r, g in group.items()}
    return [(rows[i][0], len(sets[i]), smallest[forest.find(i)]) for i in range(len(rows))]


def test_near_copies(spark):
    rng = np.random.default_rng(5)
    rows = list(EDGES)
    for g in range(6):
        base = [f"v{x}" for x in rng.integers(0, 5000, 120)]
        for c in range(12):
            copy = list(base)
            for p in rng.integers(0, 120, c % 7):
                copy[p] = f"n{rng.integers(0, 9999)}"
            rows.append((1000 + 50 * g + c, " ".join(copy)))
    rows = [r for r in rows if r[0] is not None or r[1] == "no id at all here"]
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in near_copies.near_copies(frame(spark, rows), 3, 85).collect()), key=str)
    assert got == sorted(near_brute(rows, 3, 85), key=str)
    kept = near_copies.keep_first(frame(spark, rows), 3, 85)
    want = {d for d, _, c in near_brute(rows, 3, 85) if d == c}
    assert sorted(map(str, (r["doc_id"] for r in kept.collect()))) == sorted(map(str, want))
    assert near_copies.near_copies(frame(spark, [])).count() == 0


def test_near_copies_of_null_and_repeated_ids(spark):
    base = [f"v{x}" for x in range(100)]
    near = lambda k: " ".join([*base[:-1], f"u{k}"])
    other = " ".join(f"w{x}" for x in range(100))
    # without ids, two near copies; one without an id of 3; 7 repeats with two texts, one of them near 3
    rows = [(None, other), (None, other + " end"), (None, near(1)), (3, near(2)), (7, near(3)), (7, "a text of its own here"), (8, "A text of its own here"), (None, None)]
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in near_copies.near_copies(frame(spark, rows), 3, 85).collect()), key=str)
    assert got == sorted(near_brute(rows, 3, 85), key=str)
    repeated = near_copies.near_copies(frame(spark, [(5, near(1)), (5, near(2)), (7, near(3))]), 3, 85)
    assert sorted((r["doc_id"], r["component_id"], r["kept"]) for r in repeated.collect()) == [(5, 5, True), (5, 5, True), (7, 5, False)]
    kept = [(r["doc_id"], r["text"]) for r in near_copies.keep_first(frame(spark, rows), 3, 85).collect()]
    assert len(kept) == 4 and {(3, near(2)), (7, "a text of its own here"), (None, None)} < set(kept)
    assert sum(t in (other, other + " end") for _, t in kept) == 1


def test_large_buckets_are_dealt_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(near_copies, "BLOCK", 4)
    base = [f"v{x}" for x in range(60)]
    rows = [(k, " ".join([*base[: 60 - k], *(f"u{k}{x}" for x in range(k))])) for k in range(14)]
    got = sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in near_copies.near_copies(frame(spark, rows), 3, 85).collect())
    assert got == sorted(near_brute(rows, 3, 85))


def test_similarity_estimate():
    rng = np.random.default_rng(3)
    a = np.unique(rng.integers(0, 1 << 63, 400, dtype=np.uint64))
    b = np.unique(np.concatenate((a[:300], rng.integers(0, 1 << 63, 100, dtype=np.uint64))))
    true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    sig = near_copies.signatures(np.stack([near_copies.minima(a), near_copies.minima(b)]))
    assert abs(near_copies.similarity(near_copies._equal_lanes(sig[:1], sig[1:])[0, 0]) - true) < 0.13


def test_components(spark):
    chain = [(k, k + 1) for k in range(40)] + [(100 + k, 100) for k in range(1, 30)] + [(7, 7), (200, 201)]
    got = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(chain, "a long, b long").repartition(4)).collect()}
    assert got == {**{k: 0 for k in range(41)}, **{k: 100 for k in range(100, 130)}, 200: 200, 201: 200}


def test_media_round_trip(spark):
    texts = [(0, None), (1, ""), (2, "a" * 64), (3, "b" * 65), (4, "é漢😀" * 500), (5, "a" * 64), (6, "x" * 600_000)]
    got = {r["doc_id"]: r for r in progressive_jpeg.digest(progressive_jpeg.text_media(frame(spark, texts))).collect()}
    for doc_id, text in texts:
        raw = (text or "").encode()
        padded = raw.ljust(max(64, -(-len(raw) // 64) * 64), b"\0")
        r = got[doc_id]
        assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) == (len(raw), len(padded), hashlib.sha256(padded).hexdigest(), zlib.crc32(padded[-64:]))
    assert got[2]["media_sha256"] == got[5]["media_sha256"] and got[2]["feature"] == got[5]["feature"]
    rgb = {r["doc_id"]: r for r in progressive_jpeg.tensors(progressive_jpeg.text_media(frame(spark, texts[:4]))).collect()}
    assert all(len(r["rgb"]) == 3 * r["height"] * r["width"] for r in rgb.values())


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 30), st.integers(0, 2**32 - 1), st.sampled_from(["any", "sparse", "small"])), min_size=1, max_size=4))
def test_coefficients_survive(images):
    payloads = []
    for n, seed, kind in images:
        rng = np.random.default_rng(seed)
        values = {"any": rng.integers(0, 256, 64 * n), "sparse": rng.choice([128, 129, 127, 200], 64 * n, p=[0.94, 0.03, 0.02, 0.01]), "small": rng.choice([126, 127, 128, 129, 130], 64 * n)}[kind]
        payloads.append(values.astype(np.uint8).tobytes())
    files = progressive_jpeg.encode_many(payloads)
    for p, f, (coefficients, _, comment) in zip(payloads, files, progressive_jpeg.decode_many(files)):
        assert progressive_jpeg.read_payload(coefficients, comment) == p and progressive_jpeg.encode_many([p]) == [f]


def brute_kernel(s, t, p, decay):
    import itertools

    def weights(x):
        out = Counter()
        for c in itertools.combinations(range(len(x)), p):
            out[tuple(x[i] for i in c)] += decay ** (c[-1] - c[0] + 1)
        return out

    a, b = weights(s), weights(t)
    return sum(v * b[k] for k, v in a.items())


@settings(max_examples=40, deadline=None)
@given(st.text("abc", max_size=7), st.text("abc", max_size=7))
def test_kernel(a, b):
    assert toxicity.raw_kernel([a, "zz"], [b, "z"])[0] == pytest.approx(brute_kernel(a, b, toxicity.ORDER, toxicity.DECAY), abs=1e-12)


def test_common_subsequence():
    assert toxicity.common_subsequence(["i-d-i-o-t", "toad", ""], ["idiot", "to"]).tolist() == [[5, 1], [1, 2], [0, 0]]


def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.1"
    documents, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.train(documents, labels)
    out = toxicity.score(documents, model).join(labels.select("doc_id", "toxic"), "doc_id").where("held_out").toPandas()
    assert (out["predicted"] == out["toxic"]).mean() > 0.93
    toxic = out[out["toxic"] == 1]
    assert toxic["predicted"].mean() > 0.75 and out[out["toxic"] == 0]["predicted"].mean() < 0.05
    edge = {r["doc_id"]: r for r in toxicity.score(frame(spark), model).collect()}
    assert len(edge) == len(set(d for d, _ in EDGES)) and edge[0]["score"] == edge[1]["score"] < 0.5
    assert toxicity.keep_clean(frame(spark), model).count() == len(EDGES)
    insult = spark.createDataFrame([(1, "you stupid i-d-i-o-t and st.upid mor.on idxiot idiot"), (2, "a pleasant day")], SCHEMA)
    assert [r["predicted"] for r in toxicity.score(insult, model).orderBy("doc_id").collect()] == [1, 0]


def test_toxicity_without_labels(spark):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    model = toxicity.train(frame(spark), none)
    assert model is None and {r["score"] for r in toxicity.score(frame(spark), model).collect()} == {0.0}
