from __future__ import annotations

import hashlib
import struct

import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm.conftest import as_documents
from variantry.llm.bpe import Splitter, decode, encode, round_trip

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def fast_words(text):
    return Splitter([]).words(pa.array([text], pa.large_string()))[0].to_pylist()


def test_words_of_every_character():
    splitter = Splitter([])
    for start in range(0, 0x110000, 64):
        text = "".join(f"a{chr(c)}a  {chr(c)}1!'{chr(c)} " for c in range(start, start + 64) if not 0xD800 <= c < 0xE000)
        assert fast_words(text) == splitter.slow(text), hex(start)


@given(st.text(st.sampled_from("ab1'!\n\t \u00a0é²srevltmd"), max_size=40))
@settings(max_examples=1500, deadline=None)
def test_words_of_mixed_characters(text):
    assert fast_words(text) == Splitter([]).slow(text)


@pytest.mark.parametrize("block_bytes,shards", [(1 << 22, 256), (64, 3)])
def test_against_the_library(spark, awkward_texts, tokenizer, block_bytes, shards):
    texts = [*awkward_texts, "a  <|endoftext|> b<|endoftext|>", "it's  we'll\n\n\tx\x00y", "\u0558 \U00016ea0x", "é" * 5000, "<|endoftext|>"]
    rows = [(i, text) for i, text in enumerate(texts)] + [(None, "same"), (None, "same"), (0, "other")]
    expected = []
    for doc, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids
        digest = hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        decoded = tokenizer.decode(ids, skip_special_tokens=False)
        expected.append((doc, len(ids), digest, hashlib.sha256(decoded.encode()).hexdigest()))
    result = round_trip(as_documents(spark, rows), PATH, block_bytes=block_bytes, shards=shards)
    assert sorted((tuple(r) for r in result.collect()), key=repr) == sorted(expected, key=repr)


def test_ids_are_numbers_in_order_and_broken_bytes_are_marked(spark, tokenizer):
    row = encode(spark.createDataFrame([("k", "hello world", 1)], "doc_id string, text string, ids int"), PATH).first()
    assert row["doc_id"] == "k" and list(struct.unpack("<2I", row["ids"])) == tokenizer.encode("hello world").ids
    half = tokenizer.encode("日").ids[:1]
    broken = spark.createDataFrame([(bytearray(struct.pack("<2I", half[0], 0)),), (None,)], "ids binary")
    assert [r[0] for r in broken.select(decode(F.col("ids"), PATH)).collect()] == [tokenizer.decode([half[0], 0]), ""]


def test_empty(spark):
    assert round_trip(spark.createDataFrame([], "doc_id long, text string"), PATH).collect() == []
