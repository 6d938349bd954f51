from __future__ import annotations

import random
import re

import pytest
import xxhash

from tests.llm.conftest import as_documents
from variantry.llm.components import components
from variantry.llm.simhash import close_links, near_duplicates, piece_masks


def plain_print(text, width=3):
    text = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def plain_components(prints, distance):
    """ids and fingerprints → component of each row, by comparing all pairs."""
    label = list(range(len(prints)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i][1] ^ prints[j][1]).bit_count() <= distance:
                label[max(root(i), root(j))] = min(root(i), root(j))
    groups = {}
    for i, (doc, _) in enumerate(prints):
        groups.setdefault(root(i), []).append(doc)
    smallest = {k: min((d for d in v if d is not None), default=None) for k, v in groups.items()}
    return [(doc, f"{p:016x}", smallest[root(i)]) for i, (doc, p) in enumerate(prints)]


def found(df):
    return sorted(((r["doc_id"], r["fingerprint"], r["component_id"]) for r in df.collect()), key=repr)


def test_against_all_pairs(spark, awkward_texts):
    rng = random.Random(1)
    words = [f"w{i}" for i in range(300)]
    base = [rng.choice(words) for _ in range(120)]
    texts = list(awkward_texts)
    for _ in range(150):  # a large group of near copies
        copy = list(base)
        for _ in range(rng.randrange(3)):
            copy[rng.randrange(len(copy))] = rng.choice(words)
        texts.append(" ".join(copy))
    texts += [" ".join(rng.choice(words) for _ in range(rng.randrange(1, 40))) for _ in range(60)]
    rows = [(i, text) for i, text in enumerate(texts)] + [(None, "word"), (3, "word"), (3, "word")]
    expected = plain_components([(i, plain_print(t)) for i, t in rows], 3)
    assert found(near_duplicates(as_documents(spark, rows))) == sorted(expected, key=repr)


def test_all_distances_share_a_block():
    rng = random.Random(2)
    for distance in (1, 3, 5):
        masks = piece_masks(distance)
        for _ in range(200):
            apart = sum(1 << bit for bit in rng.sample(range(64), distance))
            assert any(apart & mask == 0 for mask in masks)


def test_dense_group_links_stay_few(spark):
    """All values of ten bits: nearly every block is full, but links connect parts, not all pairs."""
    prints = [(sum((i >> k & 1) << (6 * k) for k in range(10)),) for i in range(1024)]
    links = close_links(spark.createDataFrame(prints, "print long")).collect()
    assert len(links) < 5 * 1024
    roots = components(spark.createDataFrame([(r["a"], r["b"]) for r in links], "a long, b long")).collect()
    assert len(roots) == 1023 and {r["root"] for r in roots} == {0}


@pytest.mark.parametrize("most", [1 << 18, 5])
def test_few_links_need_no_rounds(spark, monkeypatch, most):
    from variantry.llm import components as module

    names = []
    monkeypatch.setattr(module, "FOREST_ROWS", most)
    monkeypatch.setattr(module, "stored", lambda df, name, keep=module.stored: names.append(name) or keep(df, name))
    links = [(i, i + 1) for i in range(30)] + [(100, 90), (90, 80), (7, 7), (100, 80)]
    random.Random(4).shuffle(links)
    rows = components(spark.createDataFrame(links, "a long, b long").repartition(4)).collect()
    assert sorted((r["node"], r["root"]) for r in rows) == [*((i, 0) for i in range(1, 31)), (90, 80), (100, 80)]
    assert (len(names) == 2) == (most > len(links))


@pytest.mark.parametrize("length", [1, 2, 40])
def test_components_of_a_path(spark, length):
    links = [(i, i + 1) for i in range(length)]
    random.Random(3).shuffle(links)
    rows = components(spark.createDataFrame(links, "a long, b long").repartition(5)).collect()
    assert sorted((r["node"], r["root"]) for r in rows) == [(i, 0) for i in range(1, length + 1)]


def test_empty_and_other_columns(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert near_duplicates(empty).collect() == []
    odd = spark.createDataFrame([(1, "a b c d", "z", 5), (2, "a b c d", "y", 6)], "doc_id long, text string, print string, root long")
    assert [r["component_id"] for r in near_duplicates(odd).collect()] == [1, 1]
