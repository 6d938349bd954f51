from __future__ import annotations

import random
import re
from collections import Counter
from fractions import Fraction

from tests.llm.conftest import as_documents
from variantry.llm.licenses import TEMPLATES, scan


def bigrams(text):
    words = "".join(c if c.isalnum() else " " for c in text.lower()).split()
    return Counter(zip(words, words[1:], strict=False))


def plain(text, templates, threshold):
    """Every unit against every template."""
    text = text or ""
    lines = text.split("\n")
    blank = [not re.search(r"\w", line) for line in lines]
    heads = [i for i in range(len(lines)) if i == 0 or blank[i - 1]]
    parts = ["\n".join(lines[a:b]) for a, b in zip(heads, [*heads[1:], len(lines)], strict=True)]
    out = []
    for kind, units in (("line", lines), ("paragraph", parts), ("text", [text])):
        for number, unit in enumerate(units):
            for name, template in templates.items():
                a, b = bigrams(unit), bigrams(template)
                size = sum(a.values()) + sum(b.values())
                dice = Fraction(2 * sum((a & b).values()), size) if size else 0
                if dice >= Fraction(str(threshold)):
                    out.append((name, float(dice), kind, number))
    return sorted(out)


def test_against_all_templates(spark, awkward_texts):
    mit = TEMPLATES["MIT"]
    texts = [
        *awkward_texts, mit, f"a b c\n{mit.upper()}\n\nRELEASED under\nthe MIT licence\n\n{TEMPLATES['Apache-2.0']} x", "under the the the MIT License",
        "\n".join(TEMPLATES["MPL-2.0"].split(" ")), f"{mit}\n{mit}\n\n{mit}", TEMPLATES["GPL-2.0"].replace("2", "3"), "Licensed under CC BY-NC 4.0, CC BY 4.0",
    ]
    rows = [(i, text) for i, text in enumerate(texts)] + [(None, mit), (None, mit)]
    result = scan(as_documents(spark, rows)).collect()
    got = sorted(((r["doc_id"], sorted((m["license"], m["dice"], m["unit"], m["number"]) for m in r["matches"] if m["unit"] != "span")) for r in result), key=repr)
    assert got == sorted(((i, plain(text, TEMPLATES, 0.8)) for i, text in rows), key=repr)
    for row in result:
        best = min(((-m["dice"], m["license"]) for m in row["matches"]), default=(None, None))
        assert (row["license"], row["dice"]) == (best[1], None if best[0] is None else -best[0])


def test_other_thresholds_and_nothing(spark):
    docs = as_documents(spark, [(1, "one two three four\none two"), (2, "two one")])
    templates = {"t": "one two three", "empty": "", "word": "one"}
    got = {r["doc_id"]: sum(m["unit"] != "span" for m in r["matches"]) for r in scan(docs, templates=templates, threshold=0.5).collect()}
    assert got == {i: len(plain(text, templates, 0.5)) for i, text in ((1, "one two three four\none two"), (2, "two one"))}
    assert scan(spark.createDataFrame([], "doc_id long, text string, matches int")).collect() == []
    assert [r["license"] for r in scan(docs, templates={}).collect()] == [None, None]


def best_windows(text, templates, threshold):
    """The best coefficient of any window of words, for each template that a window matches."""
    words = "".join(c if c.isalnum() else " " for c in (text or "").lower()).split()
    out = {}
    for name, template in templates.items():
        b = bigrams(template)
        m = sum(b.values())
        for i in range(len(words)):
            a = Counter()
            for j in range(i + 1, min(len(words), i + 2 * m + 2)):
                a[words[j - 1], words[j]] += 1
                dice = Fraction(2 * sum((a & b).values()), j - i + m)
                if dice >= threshold:
                    out[name] = max(out.get(name, 0), dice)
    return {name: float(dice) for name, dice in out.items()}


def spans_of(row):
    return [m for m in row["matches"] if m["unit"] == "span"]


def test_windows_against_all_windows(spark):
    rng = random.Random(3)
    notices = list(TEMPLATES.values())
    texts = [
        "Copyright 2020 A. Author. Released under the MIT License. All other parts stay closed.", "x Released under the MIT License. y",
        "a\nb Licensed under the Apache\nLicense, Version 2.0 c", "the MIT License", "under the MIT License", "released", "",
    ]
    for _ in range(60):
        words = " ".join(rng.choice(notices) for _ in range(rng.randrange(1, 4))).split()
        for _ in range(rng.randrange(8)):
            words.insert(rng.randrange(len(words) + 1), rng.choice(["the", "x", "under", "2.0,", "work\n"]))
        texts.append(" ".join(words[rng.randrange(4):]))
    found = {r["doc_id"]: r for r in scan(as_documents(spark, list(enumerate(texts)))).collect()}
    for i, text in enumerate(texts):
        best = {}
        for match in spans_of(found[i]):
            best[match["license"]] = max(best.get(match["license"], 0.0), match["dice"])
        assert best == best_windows(text, TEMPLATES, Fraction("0.8")), text
    assert found[0]["license"] == "MIT" and [m["number"] for m in spans_of(found[0])] == [4]
    # Exactly the threshold is enough, as a line too.
    assert [(m["unit"], m["dice"]) for m in found[1]["matches"] if m["unit"] == "line"] == [("line", 0.8)]


def test_windows_of_repeats_and_of_neighbours(spark):
    mit = TEMPLATES["MIT"]
    docs = as_documents(spark, [(1, " x ".join([mit] * 300)), (2, "released under the"), (3, "MIT License"), (4, None)])
    found = {r["doc_id"]: spans_of(r) for r in scan(docs).collect()}
    assert [m["dice"] for m in found[1]] == [1.0] * 300 and len({m["number"] for m in found[1]}) == 300
    # No window runs from one text into the next.
    assert found[2] == found[3] == found[4] == []
