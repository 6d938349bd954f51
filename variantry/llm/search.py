"""Ranked search of documents for many items at once, by bit-sliced Bloom signatures and exact rescoring.

The index holds documents in blocks of similar size. A document's signature has bits set for each of its terms and, so
that bounds are tight, for each level of a term's frequency up to its own (LEVELS). A block's
signatures are stored the other way round: one bitmap over the block's documents per signature bit. The AND of a term's
bitmaps marks all documents that hold it at that level, and by chance a few more, never fewer. Lengths and largest
frequencies are stored beside the bitmaps, so adding up a term's weight over the documents marked, with what its level
can contribute at most in each, gives an upper bound of every document's score for every item.

A first pass over the index takes the documents with the highest bounds. Their exact scores give each item a score that
its results cannot be below. A second pass leaves out the documents whose bounds prove that they rank after it; all
others are scored exactly from their texts. What is returned is therefore exact, whatever the bitmaps overestimate.

Items are the queries that all documents are searched for. They are taken in batches of about BATCH_TERMS terms and BATCH_ITEMS
items, which is what reaches the driver and every task. An index is built once, whatever the number of batches; its
blocks have a bounded number of bytes of text, or one text. Nothing else about documents reaches the driver.

Null texts and texts without terms match nothing and do not count. Rows of documents may repeat, and ids may be null (which
rank last among equal scores) or repeat: every row is a document. Rows that repeat an item's id add their terms to
it. An item without terms, or one whose terms no document holds, has no results. Of empty tables there are none. Other
columns are not read. A very long text makes a signature of its own size; texts are never cut.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from variantry.llm.arrow_text import bound_batches, filled, slices, word_lists
from variantry.llm.bitmap import bitmap, marked
from variantry.llm.store import stored
from variantry.llm.words import text_of

# What a term is, and the constants of its score.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SCALE, TF_FACTOR, LENGTH_FACTOR, LENGTH_SHARE = 1_000_000_000, 1_000, 8, 90

BATCH_TERMS = 1 << 15
BATCH_ITEMS = 1 << 11
SLICE_BYTES = 4 << 20
BLOCK_DOCS = 512
#: A block of at least LEAST_DOCS ends before a document this many times as large as its first.
LEAST_DOCS, SPREAD = 64, 3
#: Bitmaps per term and level, and the share of bits set in a block's signatures.
HASHES, DENSITY = 3, 0.1
#: Numbers held at once while bounds and scores are added up.
CELLS = 1 << 21
INDEX = "n array<int>, top array<int>, rows int, bits binary"


def _byte_table() -> np.ndarray:
    """Lower-cases A-Z and turns all ASCII that is no letter or digit into spaces; other bytes are parts of terms."""
    table = np.full(256, 32, np.uint8)
    for first, last, to in ((0x30, 0x39, 0x30), (0x41, 0x5A, 0x61), (0x61, 0x7A, 0x61), (0x80, 0xFF, 0x80)):
        table[first : last + 1] = np.arange(to, to + last - first + 1)
    return table


BYTES = _byte_table()


def _levels() -> np.ndarray:
    """Frequencies at which a level starts: 1, 2, 3, 4, 5, 6, 8, 10, ..., a third more each."""
    starts = [1]
    while starts[-1] < 1 << 40:
        starts.append(max(starts[-1] + 1, starts[-1] * 4 // 3))
    return np.array(starts, np.int64)


LEVELS = _levels()


def terms_of(text: Column) -> Column:
    """The distinct terms of a text."""
    return F.array_distinct(F.regexp_extract_all(F.translate(text_of(text), UPPER, LOWER), F.lit(TERM), 0))


@dataclass(frozen=True)
class Terms:
    """The terms of a slice of texts: each text's number of terms, and its distinct ones with their frequencies."""

    n: np.ndarray
    owner: np.ndarray
    code: np.ndarray
    tf: np.ndarray
    names: pa.LargeStringArray


def terms_in(text: pa.Array) -> Terms:
    text = filled(text)
    offsets = np.frombuffer(text.buffers()[1], np.int64)[text.offset : text.offset + len(text) + 1]
    raw = text.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[offsets[0] : offsets[-1]] if raw is not None else np.zeros(0, np.uint8)
    # Characters beyond ASCII keep their bytes, so this is still UTF-8.
    plain = pa.LargeStringArray.from_buffers(len(text), pa.py_buffer(offsets - offsets[0]), pa.py_buffer(BYTES[data]))
    words, starts = word_lists(plain)
    n = np.diff(starts)
    codes = words.dictionary_encode()
    width = max(len(codes.dictionary), 1)
    keys, tf = np.unique(np.repeat(np.arange(len(text)), n) * width + codes.indices.to_numpy(), return_counts=True)
    return Terms(n, keys // width, keys % width, tf, codes.dictionary)


def _hashes(names: pa.Array) -> np.ndarray:
    return np.fromiter((xxhash.xxh3_64_intdigest(name) for name in names.cast(pa.large_binary()).to_pylist()), np.uint64, len(names))


def _row_numbers(hashes: np.ndarray, level: int, rows: int) -> Iterator[np.ndarray]:
    """HASHES signature bits of terms at a level, out of `rows`."""
    mixed = (hashes ^ (hashes >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(level << 48)
    mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    mixed ^= mixed >> np.uint64(32)
    low, step = mixed & np.uint64(0xFFFFFFFF), (mixed >> np.uint64(32)) | np.uint64(1)
    for i in range(HASHES):
        yield (((low + np.uint64(i) * step) & np.uint64(0xFFFFFFFF)) * np.uint64(rows) >> np.uint64(32)).astype(np.int64)


def _signatures(hashes: np.ndarray, owner: np.ndarray, level: np.ndarray, size: int) -> tuple[int, bytes]:
    """The bitmaps of a block of `size` documents, from its pairs of document and term with their highest levels."""
    rows = max(8, math.ceil(HASHES * level.sum() / size / -math.log1p(-DENSITY)))
    marks = np.zeros((rows, size), np.uint8)
    for depth in range(1, int(level.max(initial=0)) + 1):
        deep = level >= depth
        for row in _row_numbers(hashes[deep], depth, rows):
            marks[row, owner[deep]] = 1
    return rows, np.packbits(marks, axis=1).tobytes()


def _blocks(order: np.ndarray, size: np.ndarray) -> Iterator[np.ndarray]:
    """Runs of documents of similar size, from documents in order of size."""
    at = 0
    while at < len(order):
        to = min(at + BLOCK_DOCS, len(order))
        close = at + int(np.searchsorted(size[order[at:to]], SPREAD * size[order[at]], "right"))
        to = max(min(at + LEAST_DOCS, to), close)
        yield order[at:to]
        at = to


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per block: its documents' ids, lengths, largest frequencies and signatures."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for part in slices(batch.column(1), SLICE_BYTES):
                ids = batch.column(0).slice(at, len(part))
                at += len(part)
                found = terms_in(part)
                level = np.searchsorted(LEVELS, found.tf, "right")
                size = np.bincount(found.owner, level, len(part)).astype(np.int64)
                top = np.zeros(len(part), np.int64)
                np.maximum.at(top, found.owner, found.tf)
                hashes = _hashes(found.names)
                first = np.searchsorted(found.owner, np.arange(len(part) + 1))
                order = np.argsort(size, kind="stable")
                for members in _blocks(order[size[order] > 0], size):
                    count = first[members + 1] - first[members]
                    pairs = np.repeat(first[members] - np.concatenate(([0], np.cumsum(count)[:-1])), count) + np.arange(count.sum())
                    owner = np.repeat(np.arange(len(members)), count)
                    rows, bits = _signatures(hashes[found.code[pairs]], owner, level[pairs], len(members))
                    yield pa.record_batch({
                        "ids": pa.ListArray.from_arrays(pa.array([0, len(members)], pa.int32()), ids.take(pa.array(members))),
                        "n": pa.array([found.n[members]], pa.list_(pa.int32())),
                        "top": pa.array([top[members]], pa.list_(pa.int32())),
                        "rows": pa.array([rows], pa.int32()), "bits": pa.array([bits], pa.binary()),
                    })

    bound_batches()
    kind = docs.schema[id_col].dataType.simpleString()
    table = docs.select(F.col(id_col).alias("id"), text_of(F.col(text_col)).alias("text")).mapInArrow(build, f"ids array<{kind}>, {INDEX}")
    return stored(table, "signatures")


@dataclass(frozen=True)
class Batch:
    """Items with their terms: item i has the terms at starts[i] to starts[i + 1]; documents and terms are all that count."""

    items: list
    names: pa.LargeStringArray
    starts: np.ndarray
    terms: np.ndarray
    weight: np.ndarray
    documents: int
    length: int

    def lengths(self, n: np.ndarray) -> np.ndarray:
        """What a document's length adds to the divisor of its scores."""
        return 100 - LENGTH_SHARE + LENGTH_SHARE * n.astype(np.int64) * self.documents // self.length


def contribution(tf: np.ndarray, length: np.ndarray) -> np.ndarray:
    """What a term of weight one adds to a score."""
    return SCALE * tf // (TF_FACTOR * tf + LENGTH_FACTOR * length)


def _added(out: np.ndarray, owner: np.ndarray, values: np.ndarray) -> None:
    """Adds rows of `values` to the rows of `out` that own them, which are in order."""
    if len(owner):
        heads = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
        out[owner[heads]] += np.add.reduceat(values, heads, axis=0, dtype=np.int64)


def upper_bounds(block: dict, batch: Batch, hashes: np.ndarray) -> np.ndarray:
    """No document of the block has a score above this (items by documents)."""
    n, top = np.array(block["n"]), np.array(block["top"], np.int64)
    width = (len(n) + 7) // 8
    bits = np.frombuffer(block["bits"], np.uint8).reshape(block["rows"], width)
    length = batch.lengths(n)
    bounds = np.zeros((len(batch.items), len(n)), np.int64)
    owner = np.repeat(np.arange(len(batch.items)), np.diff(batch.starts))
    alive, marks = np.arange(len(hashes)), np.full((len(hashes), width), 255, np.uint8)
    entries, below = np.arange(len(batch.terms)), np.zeros(len(n), np.int64)
    for depth in range(1, len(LEVELS)):
        for row in _row_numbers(hashes[alive], depth, block["rows"]):
            marks &= bits[row]
        held = marks.any(axis=1)
        alive, marks = alive[held], marks[held]
        if not len(alive):
            break
        reach = contribution(np.minimum(LEVELS[depth] - 1, top), length)
        gain, below = reach - below, reach
        place = np.full(len(hashes), -1)
        place[alive] = np.arange(len(alive))
        entries = entries[place[batch.terms[entries]] >= 0]
        sums = np.zeros_like(bounds)
        for at in range(0, len(entries), step := max(1, CELLS // len(n))):
            some = entries[at : at + step]
            flags = np.unpackbits(marks[place[batch.terms[some]]], axis=1, count=len(n))
            _added(sums, owner[some], flags * batch.weight[batch.terms[some], None])
        bounds += sums * gain
    return bounds


def _block_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for table in batches:
        for i in range(table.num_rows):
            yield {name: table.column(name)[i].as_py() for name in table.schema.names}


def _ids(values: list) -> np.ndarray:
    out = np.empty(len(values), object)
    out[:] = values
    return out


def _best_bounds(index: DataFrame, batch: Batch, count: int, kind: str) -> DataFrame:
    """Pairs (item, id) of the documents with the highest bounds: `count` per item."""

    def seek(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _hashes(batch.names)
        best = np.zeros((len(batch.items), 0), np.int64)
        ids = np.empty(best.shape, object)
        for block in _block_rows(batches):
            best = np.concatenate((best, upper_bounds(block, batch, hashes)), axis=1)
            ids = np.concatenate((ids, np.broadcast_to(_ids(block["ids"]), (len(batch.items), len(block["ids"])))), axis=1)
            if best.shape[1] > count:
                chosen = np.argpartition(-best, count - 1, axis=1)[:, :count]
                best, ids = np.take_along_axis(best, chosen, 1), np.take_along_axis(ids, chosen, 1)
        item, place = np.nonzero(best)
        yield pa.record_batch({
            "item": pa.array(item.astype(np.int32)), "id": pa.array(ids[item, place].tolist(), id_type),
            "bound": pa.array(best[item, place]),
        })

    id_type = _arrow_type(index)
    found = index.mapInArrow(seek, f"item int, id {kind}, bound long")
    order = Window.partitionBy("item").orderBy(F.desc("bound"))
    return found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= count).select("item", "id")


def _arrow_type(index: DataFrame) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(index.schema["ids"].dataType.elementType)


def _not_excluded(index: DataFrame, batch: Batch, least: list[tuple], kind: str) -> DataFrame:
    """Pairs (item, id) of all documents that may rank before an item's `least` (score, id)."""
    scores = np.array([score for score, _ in least], np.int64)

    def seek(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _hashes(batch.names)
        for block in _block_rows(batches):
            bounds = upper_bounds(block, batch, hashes)
            item, doc = np.nonzero(bounds >= scores[:, None])
            equal = bounds[item, doc] == scores[item]
            ids = block["ids"]
            kept = [
                not same or (last := least[i][1]) is None or (ids[d] is not None and ids[d] <= last)
                for i, d, same in zip(item.tolist(), doc.tolist(), equal.tolist(), strict=True)
            ]
            item, doc = item[kept], doc[kept]
            yield pa.record_batch({
                "item": pa.array(item.astype(np.int32)), "id": pa.array([ids[d] for d in doc.tolist()], id_type),
            })

    id_type = _arrow_type(index)
    return index.mapInArrow(seek, f"item int, id {kind}")


def exact_scores(text: pa.Array, items: list[np.ndarray], batch: Batch) -> np.ndarray:
    """The scores of each text of a slice for its own items, one after the other."""
    found = terms_in(text)
    wanted = pc.index_in(found.names, value_set=batch.names).fill_null(-1).to_numpy()[found.code]
    keys = (found.owner * len(batch.names) + wanted)[wanted >= 0]
    order = np.argsort(keys)
    keys, tf = keys[order], found.tf[wanted >= 0][order]
    doc = np.repeat(np.arange(len(items)), [len(some) for some in items])
    item = np.concatenate([*items, np.zeros(0, np.int64)]).astype(np.int64)
    count = np.diff(batch.starts)[item]
    length = batch.lengths(found.n)
    scores = np.zeros(len(item), np.int64)
    ends = np.cumsum(count)
    at = 0
    while at < len(item):
        base = ends[at] - count[at]
        to = max(at + 1, int(np.searchsorted(ends, base + CELLS, "right")))
        some = count[at:to]
        pair = np.repeat(np.arange(at, to), some)
        term = batch.terms[np.repeat(batch.starts[item[at:to]] - (ends[at:to] - some - base), some) + np.arange(some.sum())]
        asked = doc[pair] * len(batch.names) + term
        place = np.minimum(np.searchsorted(keys, asked), max(len(keys) - 1, 0))
        held = keys[place] == asked if len(keys) else np.zeros(len(asked), bool)
        part = np.zeros(len(asked), np.int64)
        part[held] = batch.weight[term[held]] * contribution(tf[place[held]], length[doc[pair[held]]])
        _added(scores, pair, part)
        at = to
    return scores


def _rescored(docs: DataFrame, pairs: DataFrame, batch: Batch, kind: str) -> DataFrame:
    """(item, id, score) for every row of `docs` (id, text) and each of the items its id is paired with."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in batches:
            at = 0
            for part in slices(table.column("text"), SLICE_BYTES):
                own = [np.array(some, np.int64) for some in table.column("items").slice(at, len(part)).to_pylist()]
                doc = np.repeat(np.arange(len(part)), [len(some) for some in own])
                yield pa.record_batch({
                    "item": pa.array(np.concatenate([*own, np.zeros(0, np.int64)]).astype(np.int32)),
                    "id": table.column("id").slice(at, len(part)).take(pa.array(doc)),
                    "score": pa.array(exact_scores(part, own, batch)),
                })
                at += len(part)

    by_doc = stored(pairs.groupBy("id").agg(F.collect_set("item").alias("items")), "candidates")
    seen = bitmap(by_doc.select(F.xxhash64("id").alias("key")))
    texts = marked(docs.withColumn("key", F.xxhash64("id")), "key", seen, "asked").where("asked").select("id", "text")
    by_doc = by_doc.withColumnRenamed("id", "asked_id")
    joined = texts.join(by_doc, F.col("id").eqNullSafe(F.col("asked_id"))).select("id", "text", "items")
    return joined.mapInArrow(score, f"item int, id {kind}, score long").where("score > 0")


def _ranked(scores: DataFrame, count: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return scores.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= count)


def document_frequencies(docs: DataFrame, names: pa.LargeStringArray) -> np.ndarray:
    """For each term how many rows of `docs` (id, text) hold it; rows come in batches, each sends its sums."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(names), np.int64)
        for table in batches:
            for part in slices(table.column(0), SLICE_BYTES):
                found = terms_in(part)
                place = pc.index_in(found.names, value_set=names).fill_null(-1).to_numpy()
                held = np.bincount(found.code, minlength=len(place))
                total[place[place >= 0]] += held[place >= 0]
        some = np.flatnonzero(total)
        yield pa.record_batch({"term": pa.array(some.astype(np.int32)), "df": pa.array(total[some])})

    out = np.zeros(len(names), np.int64)
    for row in docs.select("text").mapInArrow(count, "term int, df long").groupBy("term").agg(F.sum("df").alias("df")).collect():
        out[row["term"]] = row["df"]
    return out


def _batch(items: list, docs: DataFrame, documents: int, length: int) -> Batch | None:
    """The items (id, terms) with the weights of their terms; terms that no document holds are left out."""
    names = sorted({term for _, own in items for term in own})
    frequency = document_frequencies(docs, pa.array(names, pa.large_string()))
    place = {name: i for i, name in enumerate(name for name, df in zip(names, frequency.tolist(), strict=True) if df)}
    held = [(item, sorted(place[term] for term in own if term in place)) for item, own in items]
    held = [(item, own) for item, own in held if own]
    if not held:
        return None
    weight = [math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1))) for df in frequency.tolist() if df]
    return Batch(
        [item for item, _ in held], pa.array(list(place), pa.large_string()),
        np.concatenate(([0], np.cumsum([len(own) for _, own in held]))), np.concatenate([np.array(own, np.int64) for _, own in held]),
        np.array(weight, np.int64), documents, length,
    )


def search(
    docs: DataFrame, items: DataFrame, count: int = 10, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
    item_text: str = "text", batch_terms: int = BATCH_TERMS, batch_items: int = BATCH_ITEMS,
) -> DataFrame:
    """The `count` documents with the highest scores above 0 for each item: item, rank, id, score."""
    spark = docs.sparkSession
    kind, item_kind = (frame.schema[name].dataType.simpleString() for frame, name in ((docs, id_col), (items, item_col)))
    bound_batches()
    index = build_index(docs, id_col, text_col)
    plain = docs.select(F.col(id_col).alias("id"), text_of(F.col(text_col)).alias("text"))
    totals = index.agg(
        F.sum(F.size("n")).alias("documents"),
        F.sum(F.aggregate("n", F.lit(0).cast("long"), lambda total, n: total + n)).alias("length"),
    ).first()
    asked = items.select(F.col(item_col).alias("item"), F.explode(terms_of(F.col(item_text))).alias("term")).distinct()
    asked = stored(asked.groupBy("item").agg(F.collect_list("term").alias("terms")), "items")
    size = asked.agg(F.count(F.lit(1)).alias("items"), F.coalesce(F.sum(F.size("terms")), F.lit(0)).alias("terms")).first()
    parts = max(math.ceil(size["terms"] / batch_terms), math.ceil(size["items"] / batch_items))
    result = None
    for part in range(parts if totals["documents"] else 0):
        rows = asked.where(F.pmod(F.xxhash64("item"), F.lit(parts)) == part).collect()
        batch = _batch([(row["item"], row["terms"]) for row in rows], plain, totals["documents"], totals["length"])
        if batch is None:
            continue
        seeds = _ranked(_rescored(plain, _best_bounds(index, batch, 2 * count, kind), batch, kind), count)
        least: list[tuple] = [(1, None)] * len(batch.items)
        for row in seeds.where(F.col("rank") == count).collect():
            least[row["item"]] = (row["score"], row["id"])
        ranked = _ranked(_rescored(plain, _not_excluded(index, batch, least, kind), batch, kind), count)
        names = spark.createDataFrame(list(enumerate(batch.items)), f"item int, item_id {item_kind}")
        named = ranked.join(names, "item").select(F.col("item_id").alias(item_col), "rank", F.col("id").alias(id_col), "score")
        named = stored(named, "ranked")
        result = named if result is None else result.union(named)
    if result is None:
        return spark.createDataFrame([], f"`{item_col}` {item_kind}, rank int, `{id_col}` {kind}, score long")
    return result
