"""Byte-level BPE with a table of distinct words.

Splitting into words is cheap and the merges inside a word are not, and BPE never looks beyond a word. So:

1. Documents are cut into blocks of about BLOCK_BYTES of text, named by a hash of their content.
2. The distinct words of each block, in order of first appearance, are dealt out by a hash of the word.
3. Each word meets all its equals in one shard of the word table, which encodes it once and answers every block.
4. Blocks and answers are joined on the block, and ids go to the positions of their words.

Words of a block and shard travel as one compressed row, which keeps the shuffles well below the size of the
input. Memory is bounded by a block and by the distinct words of one shard; SHARDS is a parameter for larger corpora.
A block is found by its content, so tasks may run again anywhere; a block without answers is an error.

Decoding looks each id up in the id-to-piece table, whose size is that of the vocabulary, and joins the pieces' bytes.

Null texts count as empty and give no ids. Special tokens written out in a text get their own id.
"""

from __future__ import annotations

import json
import os
import unicodedata
from collections.abc import Iterator
from functools import cache, lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from variantry.llm.arrow_text import bound_batches, slices

BLOCK_BYTES = 4 << 20
SHARDS = 128
ENCODED_AT_ONCE = 1_000
#: Fixed value: the pattern by which byte-level BPE parts a text into words.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


LETTER, NUMBER, SPACE, OTHER, UNKNOWN = range(5)


@cache
def _classes() -> np.ndarray:
    """The class of every character. UNKNOWN ones are not in Python's tables of Unicode, but may be in newer ones."""
    kinds = {"L": LETTER, "N": NUMBER}
    table = np.full(0x110000, OTHER, np.uint8)
    for c in range(0x110000):
        category = unicodedata.category(chr(c))
        table[c] = UNKNOWN if category == "Cn" else kinds.get(category[0], OTHER)
    space = regex.compile(r"\s")
    table[[c for c in range(0x3001) if space.match(chr(c))]] = SPACE
    return table


def _points(data: bytes) -> np.ndarray:
    return np.frombuffer(data.decode("utf-8").encode("utf-32-le"), np.uint32)


class Splitter:
    """Parts texts into words; special tokens are words of their own.

    The boundaries that PATTERN sets are found from the classes of neighbouring characters, for a block of texts at once.
    Texts with a special token or an unknown character are parted by the tokenizer's own splitter, which is slower.
    """

    def __init__(self, special: list[str]):
        from tokenizers.pre_tokenizers import ByteLevel

        self.special = special
        self.exact = ByteLevel(add_prefix_space=False, use_regex=True).pre_tokenize_str
        self.around = regex.compile("(" + "|".join(map(regex.escape, sorted(special, key=len, reverse=True))) + ")") if special else None

    def slow(self, text: str) -> list[str]:
        """The words of one text."""
        found = []
        for i, part in enumerate(self.around.split(text) if self.around else [text]):
            found += [part] if i % 2 else [part[a:b] for _, (a, b) in self.exact(part)]
        return [word for word in found if word]

    def boundaries(self, points: np.ndarray, kind: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Whether a word starts at each character; texts start at `starts`."""
        n = len(points)
        first = np.zeros(n + 1, bool)
        first[starts] = True
        run = first[:n].copy()
        run[1:] |= kind[1:] != kind[:-1]
        word = run.copy()
        space, blank = kind == SPACE, points == 32
        # White space before something else keeps its last character apart, and a blank there joins what follows.
        before = np.flatnonzero(space[:-1] & ~space[1:] & ~first[1:n])
        word[before] = True
        word[before[blank[before]] + 1] = False
        # An apostrophe that starts a word takes a known ending with it.
        quote = np.flatnonzero((points == 39) & word)
        quote = quote[(quote + 1 < n) & ~first[np.minimum(quote + 1, n)]]
        after = points[quote + 1]
        third = np.where((quote + 2 < n) & ~first[np.minimum(quote + 2, n)], points[np.minimum(quote + 2, n - 1)], 0)
        one = np.isin(after, [ord(c) for c in "stmd"])
        two = ((after == ord("r")) | (after == ord("v"))) & (third == ord("e")) | (after == ord("l")) & (third == ord("l"))
        word[quote[one | two] + 1] = False
        ends = quote[one | two] + np.where(one[one | two], 2, 3)
        word[ends[ends < n]] |= kind[ends[ends < n]] == LETTER
        return word

    def words(self, text: pa.LargeStringArray) -> tuple[pa.LargeStringArray, np.ndarray]:
        """All words of all texts in a row, and where each text's words start."""
        lengths, data = _bytes_of(text)
        points = _points(data)
        n = len(points)
        at = np.concatenate(([0], np.cumsum(1 + (points >= 0x80).astype(np.int64) + (points >= 0x800) + (points >= 0x10000))))
        starts = np.searchsorted(at, np.concatenate(([0], np.cumsum(lengths.astype(np.int64)))))
        if not n:
            return pa.array([], pa.large_string()), np.zeros(len(lengths) + 1, np.int64)
        kind = _classes()[points]
        word = self.boundaries(points, kind, starts)
        slow = np.zeros(len(text), bool)
        for token in self.special:
            slow |= pc.match_substring(text, token).to_numpy(zero_copy_only=False)
        if (kind == UNKNOWN).any():
            unknown = np.concatenate(([0], np.cumsum(kind == UNKNOWN)))
            slow |= unknown[starts[1:]] > unknown[starts[:-1]]
        for i in np.flatnonzero(slow):
            word[starts[i] : starts[i + 1]] = False
            word[starts[i] + np.cumsum([0, *map(len, self.slow(text[i].as_py()))])[:-1]] = True
        cuts = np.flatnonzero(word)
        offsets = np.append(at[cuts], at[-1])
        words = pa.LargeStringArray.from_buffers(len(cuts), pa.py_buffer(offsets.tobytes()), pa.py_buffer(data))
        return words, np.searchsorted(cuts, starts)

    def block(self, text: pa.LargeStringArray) -> tuple[pa.LargeStringArray, np.ndarray, np.ndarray]:
        """The distinct words of a block, the index of each word among them, and where each text's words start."""
        words, starts = self.words(text)
        coded = words.dictionary_encode()
        return coded.dictionary, coded.indices.to_numpy(), starts


def read_vocabulary(path: str) -> tuple[str, list[str], list[bytes]]:
    """The tokenizer file as text, its special tokens, and the bytes of each id's piece."""
    with open(path, encoding="utf-8") as file:
        text = file.read()
    content = json.loads(text)
    split = content.get("pre_tokenizer") or {}
    plain = split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space")
    added = content.get("added_tokens", [])
    if content.get("normalizer") or not plain or any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in added):
        raise ValueError(f"{path} is not a plain byte-level BPE")
    # Printable bytes stand for themselves, the others for the characters from 256 on.
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    byte_of = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in shown)}
    pieces = {i: bytes(byte_of[c] for c in piece) for piece, i in content["model"]["vocab"].items()}
    pieces |= {t["id"]: t["content"].encode() for t in added}
    return text, [t["content"] for t in added], [pieces.get(i, b"") for i in range(max(pieces) + 1)]


def _pack(*arrays: np.ndarray | bytes) -> bytes:
    parts = [a if isinstance(a, bytes) else a.tobytes() for a in arrays]
    sizes = np.array([len(parts), *map(len, parts)], np.int64).tobytes()
    return zstandard.ZstdCompressor(level=3).compress(sizes + b"".join(parts))


def _unpack(packed: bytes) -> list[bytes]:
    whole = zstandard.ZstdDecompressor().decompress(packed)
    count = int(np.frombuffer(whole, np.int64, 1)[0])
    ends = 8 * (count + 1) + np.cumsum(np.frombuffer(whole, np.int64, count, 8))
    return [whole[a:b] for a, b in zip([8 * (count + 1), *ends[:-1]], ends, strict=True)]


def _bytes_of(text: pa.LargeStringArray) -> tuple[np.ndarray, bytes]:
    """Lengths and joined bytes of an array without nulls."""
    offsets = np.frombuffer(text.buffers()[1], np.int64)[text.offset : text.offset + len(text) + 1]
    data = text.buffers()[2]
    return np.diff(offsets).astype(np.uint32), bytes(memoryview(data)[offsets[0] : offsets[-1]]) if data else b""


def _strings(lengths: bytes, data: bytes) -> pa.LargeStringArray:
    ends = np.concatenate(([0], np.cumsum(np.frombuffer(lengths, np.uint32).astype(np.int64))))
    return pa.LargeStringArray.from_buffers(len(ends) - 1, pa.py_buffer(ends.tobytes()), pa.py_buffer(data))


def _name(lengths: np.ndarray, data: bytes) -> bytes:
    return xxhash.xxh3_128_digest(lengths.tobytes() + data)


def _shards(words: pa.LargeStringArray, shards: int) -> np.ndarray:
    digest = xxhash.xxh3_64_intdigest
    return np.fromiter((digest(word) % shards for word in words.to_pylist()), np.int64, len(words))


def _spread(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The numbers start, start + 1, ... of each pair of start and count, in a row."""
    before = np.cumsum(counts) - counts
    return np.repeat(starts - before, counts) + np.arange(counts.sum())


@lru_cache(maxsize=1)
def _tokenizer(content: str):
    """The tokenizer, once per Python worker; Spark has one task per core, so it needs no threads of its own."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(content)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def _runs(values: np.ndarray) -> list[tuple[int, int]]:
    """Where runs of equal values start and end."""
    cuts = np.flatnonzero(values[1:] != values[:-1]) + 1
    return list(zip([0, *cuts.tolist()], [*cuts.tolist(), len(values)], strict=True)) if len(values) else []


def encode(
    docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES,
    shards: int = SHARDS,
) -> DataFrame:
    """One row per row of `docs`: its id, and ids: little-endian unsigned 32-bit numbers, as binary."""
    bound_batches()
    spark = docs.sparkSession
    content, special, pieces = read_vocabulary(vocabulary)
    width = np.uint16 if len(pieces) <= 1 << 16 else np.uint32
    model = spark.sparkContext.broadcast(content)
    named = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    id_type = named.schema["id"].dataType
    id_arrow = pa.list_(to_arrow_type(id_type))

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for part in slices(batch.column("text"), block_bytes):
                lengths, data = _bytes_of(part)
                ids = batch.column("id").slice(at, len(part))
                at += len(part)
                if len(part):
                    yield pa.record_batch(
                        [pa.array([_name(lengths, data)], pa.binary()), pa.array([ids.to_pylist()], id_arrow), pa.array([_pack(lengths, data)], pa.binary())],
                        names=["block", "doc_ids", "texts"],
                    )

    def questions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitter = Splitter(special)
        for batch in batches:
            for part in slices(batch.column("text"), block_bytes):
                if not len(part):
                    continue
                words = splitter.block(part)[0]
                owner = _shards(words, shards)
                order = np.argsort(owner, kind="stable")
                present, firsts = np.unique(owner[order], return_index=True)
                bounds = np.append(firsts, len(words))
                words = words.take(pa.array(order))
                packed = [_pack(*_bytes_of(words.slice(a, b - a))) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
                name = _name(*_bytes_of(part))
                yield pa.record_batch(
                    [pa.array([name] * len(present), pa.binary()), pa.array(present, pa.int32()), pa.array(packed, pa.binary())],
                    names=["block", "shard", "words"],
                )

    def answers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(model.value)
        table: dict[str, list[int]] = {}
        current = None
        for batch in batches:
            shard = batch.column("shard").to_numpy()
            packed = []
            for at, to in _runs(shard):
                if shard[at] != current:
                    table, current = {}, shard[at]
                asked = [_strings(*_unpack(words)) for words in batch.column("words").slice(at, to - at).to_pylist()]
                coded = pa.concat_arrays(asked).dictionary_encode()
                distinct, codes = coded.dictionary.to_pylist(), coded.indices.to_numpy()
                new = [word for word in distinct if word not in table]
                for first in range(0, len(new), ENCODED_AT_ONCE):
                    part = new[first : first + ENCODED_AT_ONCE]
                    table |= zip(part, (e.ids for e in tokenizer.encode_batch_fast(part, add_special_tokens=False)), strict=True)
                found = [table[word] for word in distinct]
                counts = np.fromiter(map(len, found), np.int64, len(found))
                pool = np.fromiter(chain.from_iterable(found), np.uint32, counts.sum())
                heads, bounds = np.cumsum(counts) - counts, np.cumsum([0, *map(len, asked)])
                for a, b in zip(bounds[:-1], bounds[1:], strict=True):
                    here = codes[a:b]
                    ids = pool[_spread(heads[here], counts[here])]
                    packed.append(_pack(counts[here].astype(np.uint32), ids.astype(width)))
            yield pa.record_batch([batch.column("block"), batch.column("shard"), pa.array(packed, pa.binary())], names=["block", "shard", "ids"])

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitter = Splitter(special)
        for batch in batches:
            for row in range(batch.num_rows):
                one = batch.slice(row, 1)
                lengths, data = _unpack(one.column("texts")[0].as_py())
                words, codes, starts = splitter.block(_strings(lengths, data))
                owner = _shards(words, shards)
                given = {a["shard"]: a["ids"] for a in one.column("answers")[0].as_py() or []}
                counts, at, ids, base = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64), [], 0
                order = np.argsort(owner, kind="stable")
                present, firsts = np.unique(owner[order], return_index=True)
                bounds = np.append(firsts, len(words))
                for shard, a, b in zip(present.tolist(), bounds[:-1], bounds[1:], strict=True):
                    if shard not in given:
                        raise RuntimeError("a block has no answer from the word table; are the rows of the input stable?")
                    sizes, values = _unpack(given[shard])
                    here = np.frombuffer(sizes, np.uint32).astype(np.int64)
                    counts[order[a:b]], at[order[a:b]] = here, base + np.cumsum(here) - here
                    ids.append(np.frombuffer(values, width).astype(np.uint32))
                    base += len(ids[-1])
                pool = np.concatenate(ids) if ids else np.zeros(0, np.uint32)
                stream = pool[_spread(at[codes], counts[codes])]
                ends = np.concatenate(([0], np.cumsum(counts[codes])))[starts] * 4
                binary = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends) - 1, [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(stream.tobytes())])
                yield pa.record_batch([one.column("doc_ids").flatten(), binary.cast(pa.binary())], names=["id", "ids"])

    id_name = id_type.simpleString()
    texts = named.mapInArrow(blocks, f"block binary, doc_ids array<{id_name}>, texts binary")
    asked = named.mapInArrow(questions, "block binary, shard int, words binary")
    table = asked.repartition("shard").sortWithinPartitions("shard").mapInArrow(answers, "block binary, shard int, ids binary")
    # A set, as equal blocks ask the same and get the same.
    answered = table.groupBy("block").agg(F.collect_set(F.struct("shard", "ids")).alias("answers"))
    joined = texts.join(answered, "block", "left").select("doc_ids", "texts", "answers")
    return joined.mapInArrow(placed, f"id {id_name}, ids binary").select(F.col("id").alias(id_col), "ids")


def decode(ids: Column, vocabulary: str) -> Column:
    """The text of ids as `encode` returns them; bytes that are no UTF-8 become U+FFFD."""
    pieces = read_vocabulary(vocabulary)[2]

    def compute(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        table = pa.array(pieces, pa.large_binary())
        for batch in batches:
            out = []
            for part in slices(pc.fill_null(batch.cast(pa.large_binary()), b""), BLOCK_BYTES):
                lengths, data = _bytes_of(part)
                joined = table.take(pa.array(np.frombuffer(data, np.uint32)))
                ends = np.frombuffer(joined.buffers()[1], np.int64)[joined.offset :] if len(joined) else np.zeros(1, np.int64)
                cuts = ends[np.concatenate(([0], np.cumsum(lengths.astype(np.int64) // 4)))]
                raw = bytes(joined.buffers()[2] or b"") if len(joined) else b""
                out += [raw[a:b].decode("utf-8", "replace") for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]
            yield pa.array(out, pa.string())

    bound_batches()
    return F.arrow_udf(compute, "string")(ids)


def round_trip(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row per row of `docs`: its id, n_tokens, and SHA-256 of the ids and of the text decoded from them."""
    encoded = encode(docs, vocabulary, id_col, text_col, **options)
    return encoded.select(
        id_col, (F.length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(decode(F.col("ids"), vocabulary), 256).alias("decoded_sha256"),
    )
