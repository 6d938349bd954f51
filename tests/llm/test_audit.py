from __future__ import annotations

import random
import re
from itertools import permutations

import numpy as np

from tests.llm.conftest import as_documents
from variantry.llm.audit import COUNTS, filter_interactions, position_matrix, removal_steps

LABEL = "doc_id long, quality int, toxic int"


def plain_failures(rows):
    out = []
    for doc, text, *_ in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        failed = ""
        failed += "A" * (len(words) < 200) + "B" * (100 * len(set(words)) < 50 * len(words))
        failed += "C" * (100 * len(re.findall("[A-Z]", text)) > 3 * len(text)) + "D" * bool(re.search(r"[#$%&*|]", text))
        smaller = [d for d, t, *_ in rows if (t or "") == text and d is not None and doc is not None and d < doc]
        out.append(failed + "E" * bool(smaller))
    return out


def plain_audit(rows, labels):
    failed = plain_failures(rows)
    good = {d for d, q, _ in labels if q == 1} - {None}
    toxic = {d for d, _, t in labels if t == 1} - {None}
    result = []
    for part in {row[2] or "" for row in rows}:
        members = [(f, row[0]) for f, row in zip(failed, rows, strict=True) if (row[2] or "") == part]
        removed_by = {letter: 0 for letter in "ABCDE"}
        table = []
        for order in permutations("ABCDE"):
            left = list(members)
            for step, letter in enumerate(order, 1):
                gone = [m for m in left if letter in m[0]]
                left = [m for m in left if letter not in m[0]]
                removed_by[letter] += len(gone)
                table.append([
                    part, "".join(order), step, len(left), len(gone), sum(letter in m[0] for m in members) - len(gone),
                    sum(m[0] == letter for m in members), sum(m[1] in good for m in gone), sum(m[1] in toxic for m in gone),
                ])
        result += [tuple([*row, removed_by[row[1][row[2] - 1]]]) for row in table]
    return sorted(result)


def found(df):
    return sorted(tuple(row[name] for name in ("part", "filter_order", "step", *COUNTS)) for row in df.collect())


def test_against_filters_applied_one_by_one(spark, awkward_texts):
    rng = random.Random(5)
    texts = list(awkward_texts)
    for _ in range(60):
        vocabulary = ["abc", "Épée", "WORD", "x#", "naïve", "日本", "and", "or"][: rng.randrange(2, 9)]
        many = [f"w{i}" for i in range(rng.choice([3, 400]))]
        texts.append(" ".join(rng.choice(vocabulary if rng.random() < 0.1 else many) for _ in range(rng.choice([5, 199, 200, 260]))))
    texts += rng.sample(texts, 20) + ["a" * 300_000, " ".join(["Ab"] * 100_000)]
    rows = [(i % 70, text, rng.choice(["en", "fr", "", None])) for i, text in enumerate(texts)]
    rows += [(None, "tie", "en"), (3, "tie", "en"), (3, "tie", "en")]
    labels = [(i, rng.randrange(2), rng.choice([0, 1, None])) for i in range(50)] + [(3, 1, 1), (None, 1, 1), (4, None, None)]
    got = filter_interactions(as_documents(spark, rows), spark.createDataFrame(labels, LABEL))
    assert found(got) == plain_audit(rows, labels)


def test_min_plus_product():
    orders = list(permutations(range(4)))
    positions = position_matrix(orders)
    steps = removal_steps(np.arange(16), positions)
    for mask in range(1, 16):
        for order, step in zip(orders, steps[mask], strict=True):
            assert step == next(i for i, f in enumerate(order, 1) if mask >> f & 1)
    assert (steps[0] > 4).all()


def test_empty_tables_and_other_columns(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([], LABEL)
    assert filter_interactions(docs, labels).collect() == []
    odd = spark.createDataFrame([(1, "a", "en", 7, "z")], "doc_id long, text string, lang string, mask int, id string")
    rows = filter_interactions(odd, labels).collect()
    assert len(rows) == 600 and {r["removed"] for r in rows if r["filter_order"].startswith("A") and r["step"] == 1} == {1}
