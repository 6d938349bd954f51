from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import as_documents
from variantry.llm import language, quality, toxicity

ALPHABETS = {"en": "the of and thing ion er", "de": "der und schaft keit zu ö", "fr": "le la tion é eau ou"}
RUDE = ["idiot", "moron", "scum"]


def prose(rng, lang, words):
    parts = ALPHABETS[lang].split()
    return " ".join("".join(rng.choice(parts) for _ in range(rng.randrange(1, 4))) for _ in range(words))


def test_language_on_held_out_texts(spark, awkward_texts):
    rng = random.Random(1)
    rows = [(i, prose(rng, lang := rng.choice(sorted(ALPHABETS)), rng.randrange(4, 60)), lang) for i in range(300)]
    model = language.fit(as_documents(spark, rows[:200]), sample=50)
    assert model.languages == ["de", "en", "fr"]
    odd = [(1000 + i, text, None) for i, text in enumerate([*awkward_texts, "123 !?", "日本語"])]
    truth = {i: lang for i, _, lang in rows[200:]}
    result = {r["doc_id"]: r for r in language.identify(as_documents(spark, rows[200:] + odd), model).collect()}
    assert sum(result[i]["lang_pred"] == lang for i, lang in truth.items()) >= 97
    for i, text, _ in odd:
        lettered = any(c.isalpha() for c in text or "")
        assert (result[i]["lang_pred"] == "und") != lettered
        assert 0 <= result[i]["score"] <= 1 and (lettered or result[i]["score"] == 0)


def test_language_without_labels_or_texts(spark):
    docs = as_documents(spark, [(1, "text", None), (None, None, "en")])
    model = language.fit(docs)
    assert {r["lang_pred"] for r in language.identify(docs, model).collect()} == {"und"}
    assert language.identify(docs.limit(0), model).collect() == []
    with pytest.raises(ValueError):
        many = spark.range(600).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"), F.col("id").cast("string").alias("lang"))
        language.fit(many)


def test_toxicity_on_held_out_texts(spark, awkward_texts):
    rng = random.Random(2)
    rows, marks = [], []
    for i in range(400):
        words = prose(rng, "en", rng.randrange(20, 400)).split()
        toxic = int(i % 5 == 0)
        for _ in range(3 * toxic):
            words.insert(rng.randrange(len(words)), rng.choice(RUDE))
        rows.append((i, " ".join(words)))
        marks.append((i, toxic))
    labels = spark.createDataFrame(marks[:300] + [(None, 1), (5, None), (6, 7)], "doc_id long, toxic int")
    docs = as_documents(spark, rows + [(1000 + i, text) for i, text in enumerate(awkward_texts)] + [(1, rows[1][1]), (None, "idiot")])
    model = toxicity.fit(docs, labels)
    result = {r["doc_id"]: r for r in toxicity.classify(docs, model).collect()}
    assert sum(result[i]["predicted"] == toxic for i, toxic in marks[300:]) >= 98
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in result.values())
    assert result[1000]["predicted"] == result[1001]["predicted"] == 0


def test_toxicity_with_one_class_or_nothing(spark):
    docs = as_documents(spark, [(1, "a b c d e"), (2, None)])
    for labels in ([], [(1, 0), (2, 0)]):
        model = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
        assert {r["predicted"] for r in toxicity.classify(docs, model).collect()} == {0}


def plain_quality(text):
    """Base measures, covered words and the longest repeat, by comparing all pairs of places."""
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    n, seen, again = len(words), set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            again += line in seen
            seen.add(line)
    windows = {}
    for i in range(n - 2):
        windows.setdefault(tuple(words[i : i + 3]), []).append(i)
    repeated = {i + k for places in windows.values() if len(places) > 1 for i in places for k in range(3)}
    longest, covered = 0, set()
    for i in range(n):
        best = 0
        for j in windows.get(tuple(words[i : i + 3]), []) if i + 3 <= n else []:
            if i != j:
                k = 0
                while i + k < n and j + k < n and words[i + k] == words[j + k]:
                    k += 1
                best = max(best, k)
        longest = max(longest, best)
        if best >= quality.LEAST:
            covered |= set(range(i, i + best))
    symbols = sum(c in "#*$%&|<>" for c in text)
    return n, sum(map(len, words)), symbols, again, len(repeated), len(covered), longest


def test_quality_against_all_pairs(spark, awkward_texts):
    rng = random.Random(3)
    texts = [t for t in awkward_texts if t is None or len(t) < 1000]
    for _ in range(60):
        words = [f"w{rng.randrange(rng.choice([3, 40, 4000]))}" for _ in range(rng.randrange(160))]
        if rng.random() < 0.4 and len(words) > 10:
            words += words[3 : rng.randrange(4, len(words))]
        texts.append("".join(w + rng.choice([" ", "\n", " # ", "\t"]) for w in words))
    rows = list(enumerate(texts)) + [(None, "a b c"), (1, "line\nline\n \nline"), (1, "line\nline\n \nline")]
    result = quality.judge(as_documents(spark, rows)).collect()
    expected = []
    for i, text in rows:
        m = plain_quality(text)
        failed = m[0] < 50 or 100 * m[4] > 50 * m[0]
        expected.append((i, *m, failed, not failed and m[5] <= quality.MAX_COVERED * m[0] and m[6] <= quality.MAX_LONGEST))
    assert sorted((tuple(r) for r in result), key=repr) == sorted(expected, key=repr)
    long = quality.judge(as_documents(spark, [(1, awkward_texts[6])])).first()
    assert long["n_words"] == len(re.findall(r"[^\x20\x09-\x0D]+", awkward_texts[6])) and long["base_failed"]
    assert quality.judge(spark.createDataFrame([], "doc_id long, text string, m int")).collect() == []


def test_limits_on_repeats_decide(spark):
    """Texts that pass the base rules: a long passage given twice, many short ones, and what plain texts repeat."""
    fresh = iter(f"n{i}" for i in range(100_000))

    def some(n):
        return [next(fresh) for _ in range(n)]

    passage, line = some(60), some(13)
    short = [some(6) for _ in range(12)]
    texts = {
        "pasted": some(300) + passage + some(200) + passage,
        "at the limit": some(300) + passage[:50] + some(200) + passage[:50],
        "many short": [w for part in short for w in part + some(9)] + [w for part in short for w in some(9) + part],
        "a line twice": some(80) + line + some(80) + line,
        "plain": some(120),
    }
    rows = [(i, " ".join(words)) for i, words in enumerate(texts.values())]
    found = {r["doc_id"]: r for r in quality.judge(as_documents(spark, rows)).collect()}
    assert not any(r["base_failed"] for r in found.values())
    assert [found[i]["kept"] for i in range(5)] == [False, True, False, True, True]
    assert [found[i]["longest_repeat"] for i in range(5)] == [60, 50, 6, 13, 0]
