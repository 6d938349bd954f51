from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import as_documents
from variantry.llm import lm
from variantry.llm.words import id_remainder


def plain_words(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", lower), None]


@pytest.fixture(scope="module")
def rows(awkward_texts):
    rng = random.Random(8)
    words = [f"w{int(rng.paretovariate(0.6))}" for _ in range(3000)]
    phrases = [" ".join(rng.choice(words) for _ in range(6)) for _ in range(30)]
    rows = list(enumerate(awkward_texts)) + [(20 + i, " ".join(rng.choice(phrases + words) for _ in range(rng.randrange(60)))) for i in range(200)]
    return rows + [(None, "w1 w2"), (None, "w1 w2"), (25, "W1 unseen-word")]


@pytest.mark.parametrize("hot", [0, 5, 1 << 19])
def test_base_scores_and_probabilities(spark, rows, hot):
    docs = as_documents(spark, rows)
    held = id_remainder(docs.doc_id, 10) == 0
    model, rare = lm.fit(docs.where(~held), filter_bits=1 << 22, shards=16, hot=hot)
    result = lm.score(docs, model, rare).collect()
    assert len(model.hot_words) <= hot
    taught = [plain_words(t) for i, t in rows if zlib.crc32(str(i if i is not None else "").encode()) % 10 != 0]
    counts = Counter(w for ws in taught for w in ws)
    pairs = Counter((a, b) for ws in taught for a, b in zip([None, *ws], ws, strict=False))
    n, v = sum(counts.values()), len(counts)
    chance = lambda w: (counts[w] + 0.1) / (n + 0.1 * (v + 1))
    expected = []
    for doc, text in rows:
        ws = plain_words(text)
        base = sum(math.log10(chance(w)) for w in ws)
        score = sum(math.log10((pairs[a, b] + model.mass * chance(b)) / (counts[a] + model.mass)) for a, b in zip([None, *ws], ws, strict=False))
        expected.append((doc, len(ws), sum(counts[w] > 0 for w in ws), n, base, score))
    key = lambda r: (str(r[0]), r[1], round(r[4], 6))
    got = sorted((tuple(r) for r in result), key=key)
    for mine, plain in zip(got, sorted(expected, key=key), strict=True):
        assert mine[:4] == plain[:4]
        assert mine[4] == pytest.approx(plain[4], rel=1e-9)
        assert mine[5] == pytest.approx(plain[5], rel=0.06, abs=0.5)


def test_levels_never_fall_short(spark):
    rng = np.random.default_rng(1)
    hashes, counts = rng.integers(0, 2**63, 5000).astype(np.uint64), rng.integers(1, 2000, 5000)
    for base in lm.BASES:
        levels = lm.level_of(counts, base)
        assert (np.abs(lm.counts_of(levels, base) / counts - 1) <= base - 1 + 1e-9).all()
        assert lm.level_of(np.array([1]), base)[0] == 1
    words = spark.createDataFrame([(f"t{i}", int(c)) for i, c in enumerate(counts)], "token string, c long")
    texts = spark.createDataFrame([("a b a b",)], "text string")
    slices = {r["shard"]: np.frombuffer(bytes(r["bits"]), np.uint8) for r in lm._filter_slices(texts, words, 1 << 20, 8).collect()}
    bits = np.concatenate([slices.get(i, np.zeros(1 << 14, np.uint8)) for i in range(8)])
    found = lm.read_levels(bits, lm._word_hashes(pa.array([f"t{i}" for i in range(5000)])), 1, 8, 2000)
    exact = lm.level_of(counts, lm.BASES[0])
    assert (found >= exact).all() and (found == exact).mean() > 0.9
    assert (lm.read_levels(bits, hashes, 1, 8, 2000) > 0).mean() < 0.1


def test_nothing_to_learn_from(spark, rows):
    docs = as_documents(spark, rows[:14])
    model, rare = lm.fit(docs.limit(0), filter_bits=1 << 16, shards=4)
    result = lm.score(docs, model, rare).collect()
    assert {(r["n_known"], r["train_tokens"]) for r in result} == {(0, 0)}
    assert all(abs(r["base_score"]) < 1e-9 and abs(r["score"]) < 1e-9 for r in result)
    assert lm.score(docs.limit(0), model, rare).collect() == []


def test_a_full_slice_has_an_end():
    full = np.full(1 << 10, 255, np.uint8)
    levels = lm.read_levels(full, np.arange(50, dtype=np.uint64) << np.uint64(40), 2, 1, 1000)
    assert (levels == lm.level_of(np.array([1000]), lm.BASES[1])[0]).all()
    assert (lm.read_levels(full, np.arange(5, dtype=np.uint64), 1, 1, 0) == 0).all()


def test_mass_is_chosen_on_training_texts(spark):
    """Texts of few fixed phrases trust pairs; texts of words in any order do not."""
    rng = random.Random(3)
    words = [f"w{i}" for i in range(60)]
    phrases = [(i, " ".join(words[j % 60] for j in range(i, i + 40))) for i in range(200)]
    mixed = [(i, " ".join(rng.choice(words) for _ in range(40))) for i in range(200)]
    masses = [lm.fit(as_documents(spark, rows), filter_bits=1 << 20, shards=8)[0].mass for rows in (phrases, mixed)]
    assert masses[0] == lm.MASSES[0] and masses[1] >= 50


def test_the_filter_grows_with_the_corpus(spark):
    rng = random.Random(4)
    rows = [(i, " ".join(f"v{rng.randrange(4000)}" for _ in range(100))) for i in range(800)]
    small, large = (lm.fit(as_documents(spark, some), shards=16)[0] for some in (rows[:100], rows))
    assert 4 <= len(large.bits) / len(small.bits) <= 16
    asked = np.random.default_rng(2).integers(0, 2**63, 20_000).astype(np.uint64)
    for model in (small, large):
        assert (model.ask(asked, 2) > 0).mean() < 0.035


@pytest.mark.parametrize("ids", ["doc_id long", "doc_id string"])
def test_a_filter_too_large_to_broadcast_gives_the_same_scores(spark, rows, ids, monkeypatch):
    monkeypatch.setattr(lm, "SLICE_BYTES", 1 << 12)
    docs = as_documents(spark, rows).withColumn("doc_id", F.col("doc_id").cast(ids.split()[1]))
    near, far = (lm.fit(docs, shards=16, hot=5, broadcast_bytes=most) for most in (1 << 30, 0))
    assert near[0].slices is None and far[0].bits is None and near[0].mass == far[0].mass
    key = lambda r: (str(r["doc_id"]), r["n_tokens"], round(r["score"], 6))
    one, two = (sorted(lm.score(docs, *model).collect(), key=key) for model in (near, far))
    assert len(one) == len(two) == len(rows)
    for a, b in zip(one, two, strict=True):
        assert tuple(a)[:4] == tuple(b)[:4]
        assert (a["base_score"], a["score"]) == (pytest.approx(b["base_score"]), pytest.approx(b["score"]))
    assert lm.score(docs.limit(0), *far).collect() == []


def test_no_texts_and_no_broadcast(spark, rows):
    docs = as_documents(spark, rows[:14])
    model, rare = lm.fit(docs.limit(0), shards=4, broadcast_bytes=0)
    result = lm.score(docs, model, rare).collect()
    assert len(result) == 14 and all(r["n_known"] == 0 and abs(r["score"]) < 1e-9 for r in result)


def test_hashes_of_words_depend_on_every_byte():
    rng = random.Random(6)
    words = {"", "a", "aa", "a\0", "\0", "é", "日本"} | {"x" * n for n in range(1, 80)} | {"x" * n + "y" for n in range(80)}
    words |= {"".join(rng.choice("ab日") for _ in range(rng.randrange(1, 90))) for _ in range(20_000)}
    words = sorted(words)
    hashes = lm._word_hashes(pa.array(words))
    assert len(set(hashes.tolist())) == len(words)
    tail = pa.array(["padding", *words[5:]]).slice(1)
    assert (lm._word_hashes(tail) == hashes[5:]).all()
    assert abs(np.unpackbits(hashes.view(np.uint8)).mean() - 0.5) < 0.01
    assert len(lm._word_hashes(pa.array([], pa.string()))) == 0


@pytest.mark.parametrize("most", [1 << 30, 0])
def test_the_mass_is_chosen_on_all_training_texts(spark, monkeypatch, most):
    """One long text of a fixed phrase and many short ones of words in any order: most parts of the texts would choose otherwise."""
    monkeypatch.setattr(lm, "SLICE_BYTES", 1 << 14)
    rng = random.Random(5)
    words = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(rng.choice(words) for _ in range(2))) for i in range(9000)]
    rows.append((9001, " ".join(words[j % 60] for j in range(60_000))))
    docs = as_documents(spark, rows)
    held = id_remainder(docs.doc_id, 10) == 0
    model, rare = lm.fit(docs.where(~held), shards=8, broadcast_bytes=most)
    taught = [plain_words(t) for i, t in rows if zlib.crc32(str(i).encode()) % 10 != 0]
    pairs = [(a, b) for ws in taught for a, b in zip([None, *ws], ws, strict=False)]
    both, first = Counter(pairs), Counter(a for a, _ in pairs)
    after = Counter(b for _, b in pairs)
    chance = {b: (n + 0.1) / (len(pairs) + 0.1 * (len(after) + 1)) for b, n in after.items()}
    likelihood = {m: sum(n * math.log10((n - 1 + m * chance[b]) / (first[a] - 1 + m)) for (a, b), n in both.items()) for m in lm.MASSES}
    assert model.mass == max(likelihood, key=likelihood.get)
    open_model, same_rare = lm.fit(docs.where(~held), shards=8, broadcast_bytes=most, mass=False)
    assert open_model.mass is None
    one = sorted(map(tuple, lm.score(docs, model, rare).collect()))
    two = sorted(map(tuple, lm.score(docs, open_model, same_rare, training=~held).collect()))
    assert len(one) == len(rows)
    for a, b in zip(one, two, strict=True):
        assert a == pytest.approx(b)


def test_a_model_without_a_mass_needs_its_training_texts(spark):
    docs = as_documents(spark, [(1, "a b"), (2, "b a")])
    model, rare = lm.fit(docs, shards=4, mass=False)
    with pytest.raises(ValueError):
        lm.score(docs, model, rare)


def test_pairs_of_equal_levels_are_one_kind():
    """Each token has the values that its own pair has; logarithms are taken of a few kinds only."""
    rng = random.Random(8)
    texts = [" ".join(rng.choice("abcdefghij") * rng.choice((1, 2)) for _ in range(rng.randrange(60))) for _ in range(30)]
    tokens = lm.Tokens(pa.array(texts, pa.large_string()))
    hashes = lm._word_hashes(tokens.words)
    before, after = tokens.pairs()
    levels = {1: dict(zip(hashes.tolist(), (rng.randrange(4) for _ in hashes), strict=True))}
    pairs = lm._pair_hashes(hashes[before], hashes[after])
    levels[2] = {value: rng.randrange(3) for value in pairs.tolist()}
    model = lm.LanguageModel(None, 100, 10, pa.array([], pa.large_string()), np.zeros(0, np.uint64), np.zeros(0, np.int64))
    ask = lambda asked, order: np.array([levels[order][value] for value in asked.tolist()], np.int64)
    both, first, chance, place = model.pair_counts(tokens, hashes, ask)
    estimate = lm.counts_of(ask(hashes, 1), lm.BASES[0])
    expected = np.minimum(lm.counts_of(ask(pairs, 2), lm.BASES[1]), np.minimum(estimate[before], estimate[after]))
    assert (both[place] == expected).all() and (first[place] == estimate[before]).all()
    assert (chance[place] == (estimate[after] + lm.SMOOTHING) / model.total).all()
    assert len(both) <= 4 * 4 * 3 < len(np.unique(pairs))
