from __future__ import annotations

import random
import re

import pytest

from tests.llm.conftest import as_documents
from variantry.llm import urls
from variantry.llm.mix import mix, mixed_sizes
from variantry.llm.queries import URL_RULES


def plain_targets(sizes, weights=(1, 2, 3), repeat=3):
    """Reshare what exceeds a cap until nothing does."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {name: weights[i % len(weights)] for i, name in enumerate(names)}
    capped, total = set(), sum(sizes.values())
    while True:
        free = [n for n in names if n not in capped]
        left = total - sum(repeat * sizes[n] for n in capped)
        share = {n: left * weight[n] / sum(weight[m] for m in free) for n in free}
        over = {n for n in free if share[n] > repeat * sizes[n]}
        if not over:
            return share | {n: repeat * sizes[n] for n in capped}
        capped |= over


def test_targets_and_taken_words(spark, awkward_texts):
    rng = random.Random(4)
    rows = [(i, text, None, None) for i, text in enumerate(awkward_texts[:7])]
    for source, count in (("hot", 600), ("b", 300), ("c", 40), ("d", 5), ("é", 80), (None, 90)):
        rows += [(len(rows) + i, "w " * rng.randrange(1, 120), "en", source) for i in range(count)]
    rows += [(None, "", "en", "empty"), (None, "same words", "en", "b"), (None, "same words", "en", "b")]
    docs = as_documents(spark, rows)
    result = mixed_sizes(docs).collect()
    sizes = {}
    for _, text, _, source in rows:
        sizes[source] = sizes.get(source, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    expected = plain_targets(sizes)
    assert len(result) == len(rows)
    by_size = {}
    for row in result:
        assert 0 <= row["taken"] <= 3 * row["size"]
        group = by_size.setdefault((row["source_size"], row["target"]), [0, 0])
        group[0] += row["taken"]
        group[1] = max(group[1], row["size"])
    targets = dict(by_size.keys())
    assert targets == pytest.approx({sizes[s]: expected[s] for s in sizes})
    for (_, target), (taken, largest) in by_size.items():
        assert abs(taken - target) <= 2 * largest + 0.02 * target
    assert sorted(map(tuple, result), key=repr) == sorted(map(tuple, mixed_sizes(docs.repartition(7)).collect()), key=repr)
    copies = mix(docs)
    assert copies.columns == docs.columns
    taken = sum(len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or "")) for r in copies.collect())
    assert taken == sum(r["taken"] for r in result)


def test_mix_of_nothing(spark):
    assert mixed_sizes(spark.createDataFrame([], "doc_id long, text string, source string, size int")).collect() == []
    blank = as_documents(spark, [(1, None), (2, " ")])
    assert {(r["taken"], r["target"]) for r in mixed_sizes(blank).collect()} == {(0, 0.0)}


URLS = [
    None, "", "no scheme", "http://", "HTTP://Example.COM", "https://example.com/en/1", "https://www.example.com/en/1", "https://sub.www.example.com/en/",
    "https://a.example.com/de/x?y#z", "https://x.net/es", "https://x.net/es/1", "https://net/fr/", "https://notexample.com/en/", "https://x.org/a/",
    "http://www.x.org/a.html?utm_source=f#t", "http://x.org/a?b=2&a=1", "http://x.org/a?a=1&b=2", "ftp://x.org:80/a", "a://b://c", "https://com/", "https://com.org/",
    "https://deep.net" + "/es" * 3000, "https://" + "a." * 3000 + "net/es/", "https://x.org/a\nb", "https://x.org/é",
]


def plain_verdict(url, rules, listed):
    match = re.search(r"://([^/?#]*)([^?#]*)", url or "")
    host = re.sub("[A-Z]", lambda m: m[0].lower(), match[1]) if match else ""
    path = match[2] if match else ""
    fits = [(len(h) + len(p), len(h), h + p, v) for h, p, v in rules if host and (host == h or host.endswith("." + h)) and path.startswith(p)]
    if fits:
        return host, path, *max(fits)[2:]
    return host, path, None, "block" if url in listed else "allow"


@pytest.mark.parametrize("blocks", [1, 1 << 14])
def test_verdicts(spark, blocks):
    """A filter of one block passes nearly everything: the exact join still decides."""
    rules = [*URL_RULES, ("x.org", "/a.h", "allow"), ("x.net", "", "allow")]
    listed = ["https://x.org/a/", "http://x.org/a?b=2&a=1", None, "nothing"]
    same = {"https://x.org/a/", "ftp://x.org:80/a", "http://x.org/a?b=2&a=1", "http://x.org/a?a=1&b=2"}
    pages = spark.createDataFrame([(i if i else None, url, "h", "r") for i, url in enumerate(URLS + URLS[3:9])], "page_id long, url string, html string, rule string")
    result = urls.judge(
        pages.repartition(3), spark.createDataFrame(rules, urls.RULE), spark.createDataFrame([(u,) for u in listed], "url string"), blocks=blocks,
    ).collect()
    expected = [(i if i else None, *plain_verdict(url, rules, same)) for i, url in enumerate(URLS + URLS[3:9])]
    assert sorted(map(tuple, result), key=repr) == sorted(expected, key=repr)


def test_no_rules_no_pages(spark):
    none, no_list = spark.createDataFrame([], urls.RULE), spark.createDataFrame([], "url string")
    pages = spark.createDataFrame([(1, "https://a.b/c")], "page_id long, url string")
    assert [tuple(r) for r in urls.judge(pages, none, no_list).collect()] == [(1, "a.b", "/c", None, "allow")]
    assert urls.judge(pages.limit(0), none, no_list).collect() == []
