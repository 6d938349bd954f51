from __future__ import annotations

import hashlib
import random
import re
import struct
from collections import Counter

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm.conftest import as_documents
from tests.llm.test_mix_urls import plain_targets
from tests.llm.test_simhash import plain_components, plain_print
from variantry.llm.mix import mixed_sizes

LETTERS = {"en": "the of and to in", "de": "der die und ß ö", "fr": "le la é è ç"}


@pytest.fixture(scope="module")
def rows(awkward_texts):
    rng = random.Random(5)
    rows = [(i, text, None, "odd") for i, text in enumerate(awkward_texts)]
    for i in range(240):
        lang = rng.choice(sorted(LETTERS))
        text = " ".join(rng.choice(LETTERS[lang].split()) + rng.choice("abcdefgh") * rng.randrange(4) for _ in range(rng.randrange(20, 90)))
        rows.append((100 + i, text, lang, f"s{i % 4}"))
    for i in range(40):
        base = rows[20 + i % 5]
        rows.append((500 + i, base[1] + ("  " if i % 2 else " more"), base[2], base[3]))
    return rows + [(None, "the of and", "en", None), (None, "the of and", "en", None), (700, "123 456", "en", "s1")]


def content(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_stages_against_plain_versions(spark, rows):
    docs = as_documents(spark, rows)
    stages = dict(corpus_pipeline.STAGES)
    known = stages["language_id"](spark, docs, "")
    assert known.columns == docs.columns
    lettered = [r for r in content(docs) if any(c.isalpha() for c in r[1] or "")]
    assert content(known) == lettered

    once = stages["exact_dedup"](spark, known, "")
    best = {}
    for row in lettered:
        key = re.sub(r"[\x20\x09-\x0D]", "", row[1])
        rank = (-len(row[1]), row[0] is None, row[0] or 0)
        if key not in best or rank < best[key][0]:
            best[key] = (rank, row)
    kept = sorted((row for _, row in best.values()), key=repr)
    assert content(once) == kept

    apart = stages["near_dedup"](spark, once, "")
    prints = [(row[0], plain_print(row[1])) for row in kept]
    chosen = {}
    for row, (_, _, component) in zip(kept, plain_components([(i, p) for i, (_, p) in enumerate(prints)], 3), strict=True):
        if component not in chosen or (row[0] is None, row[0] or 0) < (chosen[component][0] is None, chosen[component][0] or 0):
            chosen[component] = row
    left = sorted(chosen.values(), key=repr)
    assert content(apart) == left

    mixed = stages["mix_sources"](spark, apart, "")
    copies = Counter(content(mixed))
    assert set(copies) <= set(left) and max(copies.values()) <= 3
    sizes, taken = Counter(), Counter()
    for row in left:
        sizes[row[3]] += len(row[1].split())
        taken[row[3]] += copies[row] * len(row[1].split())
    assert sum(r["taken"] for r in mixed_sizes(apart).collect()) == sum(taken.values())
    targets = plain_targets(sizes)
    assert set(targets) == set(sizes)

    encoded = stages["encode_bpe"](spark, mixed, "")
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    expected = []
    for row, times in copies.items():
        ids = tokenizer.encode(row[1], add_special_tokens=False).ids
        expected += [(row[0], len(ids), hashlib.sha256(row[1].encode()).hexdigest(), bytearray(struct.pack(f"<{len(ids)}I", *ids)))] * times
    assert content(encoded) == sorted(expected, key=repr)


def test_run_writes_and_rereads(spark, rows, tmp_path):
    as_documents(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    result = corpus_pipeline.run(spark, str(tmp_path))
    assert result.columns == ["doc_id", "n_tokens", "decoded_sha256", "ids"]
    assert 0 < result.count() <= 3 * len(rows)


def test_no_documents(spark):
    docs = as_documents(spark, [])
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "")
        assert docs.collect() == []
