from __future__ import annotations

import random
import re

import pyarrow as pa
import pytest

from tests.llm.conftest import as_documents
from variantry.llm import jaccard
from variantry.llm.jaccard import jaccard_components, prefix_length, shingle_sets


def plain_set(text, width=5):
    text = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    return {tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()


def plain_components(rows):
    sets = [plain_set(text) for _, text, *_ in rows]
    label = list(range(len(rows)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                label[max(root(i), root(j))] = min(root(i), root(j))
    groups = {}
    for i, row in enumerate(rows):
        groups.setdefault(root(i), []).append(row[0])
    smallest = {k: min((d for d in v if d is not None), default=None) for k, v in groups.items()}
    return sorted(((row[0], len(sets[i]), smallest[root(i)]) for i, row in enumerate(rows)), key=repr)


def found(df):
    return sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in df.collect()), key=repr)


def near_copies(seed):
    """Groups of texts with few to many changed words, chains of links, and a passage that many texts share."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(500)]
    texts = []
    for size in (6, 9, 30, 60, 150):
        base = [rng.choice(words) for _ in range(size)]
        for _ in range(25):
            copy = list(base)
            for _ in range(rng.randrange(0, 1 + size // 12)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            texts.append(" ".join(copy[: len(copy) - rng.randrange(1 + size // 8)]))
    chain = [rng.choice(words) for _ in range(120)]
    for i in range(40):
        texts.append(" ".join(chain[i * 2 : i * 2 + 40]))
    passage = " ".join(rng.choice(words) for _ in range(30))
    for _ in range(100):
        texts.append(" ".join(rng.choice(words) for _ in range(rng.randrange(1, 40))) + " " + passage)
    texts += [" ".join(rng.choice(words) for _ in range(rng.randrange(1, 30))) for _ in range(50)]
    return texts


@pytest.mark.parametrize("frequent", [64, 1])
def test_against_all_pairs(spark, awkward_texts, monkeypatch, frequent):
    monkeypatch.setattr(jaccard, "FREQUENT", frequent)
    monkeypatch.setattr(jaccard, "PART", 4)
    texts = [*awkward_texts, *near_copies(frequent), "A b C d e", "a b c d E", "one two", "One  two"]
    rows = [(i, text) for i, text in enumerate(texts)] + [(None, "one two"), (3, "one two"), (3, "one two"), (None, "alone here"), (900, "")]
    assert found(jaccard_components(as_documents(spark, rows))) == plain_components(rows)


def test_sets_and_prefixes():
    texts = ["a b c d e f", "a b", "b a", "", None, "A B", "a b c d e a b c d e", "x"]
    sets = [set(s.tolist()) for s in shingle_sets(pa.array(texts))]
    assert [len(s) for s in sets] == [len(plain_set(t)) for t in texts]
    assert sets[1] == sets[5] != sets[2]
    for n in range(1, 400):
        for m in range(n, n * 5 // 4 + 1):
            overlap = (4 * (n + m) + 8) // 9
            if overlap <= n:  # sets that share this many have one of the first in common
                assert overlap > n - prefix_length(n) and overlap > m - prefix_length(m)


def test_empty_and_other_columns(spark):
    assert jaccard_components(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    odd = spark.createDataFrame([("p", "a b c d", 5, 1), ("o", "A b c d", 6, 2)], "doc_id string, text string, n int, key int")
    assert [r["component_id"] for r in jaccard_components(odd).collect()] == ["o", "o"]


def test_candidates_are_numbers_only(spark, monkeypatch):
    """What moves per pair does not grow with what is known of its sets."""
    seen = []
    monkeypatch.setattr(jaccard, "_candidates", lambda *given, plain=jaccard._candidates: seen.append(plain(*given)) or seen[-1])
    rows = [(i, text) for i, text in enumerate(near_copies(5))]
    assert found(jaccard_components(as_documents(spark, rows))) == plain_components(rows)
    assert {field.dataType.typeName() for field in seen[0].schema} == {"long"}


def test_large_groups_hardly_meet(spark, monkeypatch):
    """Sets of a large group that differ too much are not paired in each list of the group."""
    met = []

    def counted(blocks, plain=jaccard._meetings):
        met.append(plain(blocks).count())
        return plain(blocks)

    monkeypatch.setattr(jaccard, "_meetings", counted)
    passage = [f"p{i}" for i in range(40)]
    # Of 43 shingles, 36 are the passage's: 36 of 50 in common. Two words of their own leave 36 of 40.
    texts = [" ".join([*passage, *(f"own{i}x{k}" for k in range(7))]) for i in range(120)]
    texts += [" ".join([*passage, f"near{i}", f"close{i}"]) for i in range(20)]
    rows = list(enumerate(texts))
    assert found(jaccard_components(as_documents(spark, rows))) == plain_components(rows)
    assert len(met) == 1 and met[0] <= 2 * len(rows)
