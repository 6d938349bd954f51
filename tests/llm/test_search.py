from __future__ import annotations

import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.conftest import as_documents
from variantry.llm.search import LEVELS, TERM, _row_numbers, _signatures, build_index, search, terms_in

ITEM = "item_id long, text string"


def plain_terms(text):
    return re.findall(TERM, (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))


def plain_search(rows, items, count=10):
    found = [(doc, plain_terms(text)) for doc, text, *_ in rows]
    found = [(doc, terms) for doc, terms in found if terms]
    n_docs, total = len(found), sum(len(terms) for _, terms in found)
    df = {}
    for _, terms in found:
        for term in set(terms):
            df[term] = df.get(term, 0) + 1
    own = {}
    for item, text in items:
        own.setdefault(item, set()).update(plain_terms(text))
    out = []
    for item, wanted in own.items():
        scores = []
        for doc, terms in found:
            m = 10 + 90 * len(terms) * n_docs // total
            score = 0
            for term in wanted & set(terms):
                tf = terms.count(term)
                weight = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[term] + 1)))
                score += weight * (1_000_000_000 * tf // (1000 * tf + 8 * m))
            if score:
                scores.append((-score, doc is None, doc or 0))
        out += [(item, i, None if null else doc, -s) for i, (s, null, doc) in enumerate(sorted(scores)[:count], 1)]
    return sorted(out, key=repr)


def found(df):
    return sorted(((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(4)
    common, rare = [f"c{i}" for i in range(40)], [f"Rare{i}é" for i in range(2_000)]
    texts = []
    for _ in range(500):
        size = rng.choice([1, 3, 20, 20, 80, 400])
        texts.append(" ".join(rng.choice(common if rng.random() < 0.8 else rare) + rng.choice([" ", ", ", "\n"]) for _ in range(size)))
    passage = " ".join(rng.sample(rare, 12))
    texts += [f"{rng.choice(texts)} {passage}" for _ in range(25)] + ["c1 c2 c3"] * 40
    items = [(i, " ".join(rng.sample(common, 3) + rng.sample(rare, 6))) for i in range(30)]
    items += [(50, passage), (51, ""), (52, None), (53, "nowhere atall"), (54, "c1"), (54, "c2"), (54, "c2"), (None, "C1 c3"), (55, "日本 ß")]
    return texts, items


def test_against_scores_of_all(spark, corpus, awkward_texts):
    texts, items = corpus
    rows = [(i, text) for i, text in enumerate([*texts, *awkward_texts])] + [(None, "c1 c2 c3"), (3, "c1 c2 c3"), (3, "c1 c2 c3")]
    docs, asked = as_documents(spark, rows), spark.createDataFrame(items, ITEM)
    expected = plain_search(rows, items)
    assert found(search(docs, asked)) == expected
    assert found(search(docs, asked, batch_terms=40)) == expected
    assert found(search(docs, asked, count=3)) == plain_search(rows, items, 3)


def test_signatures_hold_every_term():
    rng = np.random.default_rng(1)
    hashes = rng.integers(0, 1 << 63, 3_000).astype(np.uint64)
    owner, level = rng.integers(0, 70, 3_000), rng.integers(1, 6, 3_000)
    rows, raw = _signatures(hashes, owner, level, 70)
    marks = np.unpackbits(np.frombuffer(raw, np.uint8).reshape(rows, 9), axis=1, count=70)
    for depth in range(1, 6):
        deep = level >= depth
        for row in _row_numbers(hashes[deep], depth, rows):
            assert marks[row, owner[deep]].all()
    assert 0.05 < marks.mean() < 0.15


def test_terms_and_levels():
    texts = ["It's A-b_c 12é\x00Ω", "", None, "aa aa AA"]
    result = terms_in(pa.array(texts))
    names = result.names.to_pylist()
    assert result.n.tolist() == [len(plain_terms(text)) for text in texts]
    assert {(o, names[c]): t for o, c, t in zip(result.owner, result.code, result.tf, strict=True)} == {
        (i, term): plain_terms(text).count(term) for i, text in enumerate(texts) for term in plain_terms(text)
    }
    assert LEVELS[:5].tolist() == [1, 2, 3, 4, 5] and (np.diff(LEVELS) > 0).all()


def test_empty_tables_ids_and_other_columns(spark):
    none, item = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([(1, "a b")], ITEM)
    assert search(none, item).collect() == []
    docs = spark.createDataFrame(
        [("x", "a b", 1, "q"), ("y", "b", 2, "r"), ("z", "zz", 3, None)], "doc_id string, text string, item int, ids string"
    )
    assert search(docs, spark.createDataFrame([], ITEM)).collect() == []
    assert [r["doc_id"] for r in search(docs, item).orderBy("rank").collect()] == ["x", "y"]
    assert build_index(docs).count() >= 1
