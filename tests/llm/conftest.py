"""Small tables with the awkward rows that every operator must take."""

from __future__ import annotations

import random

import pytest

DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"


def as_documents(spark, rows, schema=DOCUMENT):
    """Rows (doc_id, text[, lang[, source]]) as a table of documents over a few partitions."""
    full = [tuple(row) + (None,) * (4 - len(row)) + (len(row[1]) if row[1] is not None else None,) for row in rows]
    return spark.createDataFrame(full, schema).repartition(3)


@pytest.fixture(scope="session")
def awkward_texts():
    """Null, empty, blank, very long, one-word and repeated texts, and characters beyond ASCII."""
    rng = random.Random(7)
    words = ["alpha", "beta", "gamma", "delta", "Épée", "naïve", "日本", "🙂", "x y", "don't", "a.b"]
    long = " ".join(rng.choice(words) for _ in range(60_000))
    return [None, "", " \t\n\x0b\f\r", "word", "two words", "ABC abc", long, long, "İstanbul ß\x1c  end", "tie", "tie"]
