from __future__ import annotations

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import as_documents
from variantry.llm.exact import drop_duplicates, duplicate_groups
from variantry.llm.simhash import keep_one


def plain(rows):
    """(doc_id, keep_id, group_size, sha) of every row, and the kept rows."""
    groups = {}
    for doc, text in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", text or ""), []).append((doc, text or ""))
    out, kept = [], []
    for norm, members in groups.items():
        best = min(members, key=lambda m: (-len(m[1]), m[0] is None, m[0] or 0))
        kept.append(best)
        out += [(doc, best[0], len(members), hashlib.sha256(norm.encode()).hexdigest()) for doc, _ in members]
    return sorted(out, key=repr), sorted(kept, key=repr)


@pytest.fixture(scope="module")
def rows(awkward_texts):
    rows = list(enumerate(awkward_texts)) + [(None, "tie"), (None, "t i e"), (50, "ti\te"), (49, "t ie"), (3, "word"), (3, "word")]
    return rows + [(100 + i, f"copy of one text {' ' * (i % 3)}") for i in range(60)]


@pytest.mark.parametrize("hashed", [F.md5, lambda c: F.lit("same"), lambda c: F.substring(F.md5(c), 1, 1)])
def test_groups_and_kept_rows(spark, rows, hashed):
    expected, kept = plain(rows)
    docs = as_documents(spark, rows)
    result = duplicate_groups(docs, hashed=hashed).collect()
    assert sorted(((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in result), key=repr) == expected
    assert sum(r["kept"] for r in result) == len(kept)
    assert all(r["doc_id"] == r["keep_id"] for r in result if r["kept"])
    left = drop_duplicates(docs, hashed=hashed)
    assert left.columns == docs.columns
    assert sorted(((r["doc_id"], r["text"] or "") for r in left.collect()), key=repr) == kept


def test_empty_and_other_columns(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, hash string, kept int")
    assert duplicate_groups(empty).collect() == [] and drop_duplicates(empty).columns == empty.columns
    odd = spark.createDataFrame([(1, "a", "h", 0), (2, "a ", "g", 1)], "doc_id long, text string, hash string, kept int")
    assert [tuple(r) for r in drop_duplicates(odd).collect()] == [(2, "a ", "g", 1)]


def test_text_ids(spark):
    rows = [("b", "x y"), ("a", "x  y"), ("c", "xy"), (None, "x   y"), ("d", "z")]
    docs = spark.createDataFrame(rows, "doc_id string, text string")
    found = {(r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in duplicate_groups(docs).collect()}
    assert found == {("a", None, 4, False), ("b", None, 4, False), ("c", None, 4, False), (None, None, 4, True), ("d", "d", 1, True)}
    assert sorted((r["doc_id"] or "") for r in drop_duplicates(docs).collect()) == ["", "d"]
    assert [r["doc_id"] for r in drop_duplicates(docs.where("doc_id in ('a', 'b')").unionAll(docs.where("doc_id = 'b'"))).collect()] == ["a"]
    assert sorted(r["doc_id"] for r in keep_one(docs.dropna()).collect()) == ["a", "c", "d"]
