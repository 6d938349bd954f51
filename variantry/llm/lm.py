"""Language-model scoring with a log-frequency Bloom filter.

Counts of words and word pairs over all training texts are quantised on a log scale: a count of c has level
1 + floor(log c / log base), and the item is put into one Bloom filter once per level up to its own. A count is read
back by asking for level 1, 2, ... until the answer is no, at most up to the level of the most frequent word; it stands for
the middle of that level's counts. Answers err to one side only, and a pair is asked for only if both its words are known,
once for each slice of texts.

The filter is cut into SHARDS slices by a hash of the item. The task that a shard is shuffled to adds its counts up and
fills its slice, whose size is the number of its entries (items and levels) times ENTRY_BITS, rounded up to a power of
two: the filter grows with the corpus and at most 3 % of its answers are false, whatever its size. `filter_bits` fixes the size
instead. Up to BROADCAST_BYTES the slices are broadcast as one filter. Beyond that they stay a table: each part of the texts
sends what it asks to the shards, the slices are probed there, and the levels are brought back to the texts. Both ways ask the same bits.

The probability of a word after another is the pair's count and a mass times the word's own smoothed probability, over
the first word's count and the mass. The mass is the one of MASSES under which all training texts together are likeliest when
each pair's own occurrence is taken off its counts. `fit` chooses it in a pass of its own; with `mass=False` it leaves the choice
to `score`, which is told which of its texts are training texts and adds their likelihoods up in the pass that scores them all.
A text starts after an end and ends with an end, which is a word of its own.

The base score takes exact counts. The HOT most frequent words (of at most HOT_BYTES bytes) and their counts are
broadcast; the rest are joined on the word, where no word is frequent any more.

Null texts count as empty: one end. Rows may repeat and ids may be null or repeat. With no training texts N and V are 0,
and all words have the probability that smoothing alone gives. Rows of `docs` must be stable: a task that runs again
must see the rows it saw before, as when reading files.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from variantry.llm.arrow_text import bound_batches, filled, slices, word_lists
from variantry.llm.ngrams import LAST, MIX, SPREAD, sums
from variantry.llm.store import stored

#: Bits for each item and level: with PROBES probes 0.6 to 3 % of answers are false.
ENTRY_BITS = 8
#: The largest filter that is broadcast.
BROADCAST_BYTES = 256 << 20
SHARDS = 1 << 10
PROBES = 3
#: Bases of the levels of words and of pairs.
BASES = (1.2, 1.5)
MASSES = (1.0, 2.0, 5.0, 10.0, 20.0, 50.0, 100.0, 200.0, 500.0, 1000.0, 2000.0)
HOT = 1 << 19
HOT_BYTES = 64
SMOOTHING = 0.1
SLICE_BYTES = 2 << 20
#: Pairs that a task gathers before it adds their counts up.
GATHERED = 1 << 20
#: Words of more bytes are hashed one by one.
LONG_WORD = 64
#: Masks of the first bytes of eight, by their number.
FIRST_BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
#: No word has a space in it.
END = " "

#: The levels of words (order 1) or pairs (order 2) by their hashes.
Ask = Callable[[np.ndarray, int], np.ndarray]


@dataclass(frozen=True)
class LanguageModel:
    #: The filter, or None if it is too large to be broadcast.
    bits: np.ndarray | None
    n: int
    v: int
    #: The most frequent words in order of their hashes.
    hot_words: pa.LargeStringArray
    hot_hashes: np.ndarray
    hot_counts: np.ndarray
    #: The largest count of a word, which no count exceeds.
    most: int = 0
    #: None if `score` is to choose it.
    mass: float | None = MASSES[-1]
    shards: int = SHARDS
    #: The model as tasks have it, but for its mass: it is sent to the executors once.
    shared: Broadcast | None = None
    #: The slices (shard, bits) of a filter that is not broadcast.
    slices: DataFrame | None = None

    def exact_counts(self, words: pa.LargeStringArray, hashes: np.ndarray) -> np.ndarray:
        """The counts of those words that are among the frequent ones, else 0."""
        if not len(self.hot_words):
            return np.zeros(len(words), np.int64)
        slot = np.minimum(np.searchsorted(self.hot_hashes, hashes), len(self.hot_words) - 1)
        same = pc.equal(self.hot_words.take(pa.array(slot)), words).to_numpy(zero_copy_only=False)
        return np.where(same, self.hot_counts[slot], 0)

    @property
    def total(self) -> float:
        return self.n + SMOOTHING * (self.v + 1)

    def ask(self, hashes: np.ndarray, order: int) -> np.ndarray:
        return read_levels(self.bits, hashes, order, self.shards, self.most)

    def pair_counts(self, tokens: Tokens, hashes: np.ndarray, ask: Ask) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """For each kind of pair its count, that of the word before, and the smoothed probability of the word; and each token's kind.

        Pairs whose levels and whose words' levels are the same are of one kind, so that few values need a logarithm.
        """
        levels = ask(hashes, 1)
        before, after = tokens.pairs()
        # Pairs repeat within a slice, and each answer takes several probes.
        unique, place = np.unique(before * len(hashes) + after, return_inverse=True)
        before, after = unique // max(len(hashes), 1), unique % max(len(hashes), 1)
        before_level, after_level = levels[before], levels[after]
        known = np.flatnonzero((before_level > 0) & (after_level > 0))
        both_level = np.zeros(len(unique), np.int64)
        both_level[known] = ask(_pair_hashes(hashes[before[known]], hashes[after[known]]), 2)
        words, pairs = (int(found.max(initial=0)) + 1 for found in (levels, both_level))
        code = (both_level * words + before_level) * words + after_level
        held = np.zeros(pairs * words * words, bool)
        held[code] = True
        kinds = np.flatnonzero(held)
        number = np.zeros(len(held), np.int64)
        number[kinds] = np.arange(len(kinds))
        first, second = (counts_of(found, BASES[0]) for found in (kinds // words % words, kinds % words))
        both = np.minimum(counts_of(kinds // (words * words), BASES[1]), np.minimum(first, second))
        return both, first, (second + SMOOTHING) / self.total, number[code][place]


def _mixed(value: np.ndarray) -> np.ndarray:
    value = (value ^ (value >> np.uint64(30))) * MIX
    value = (value ^ (value >> np.uint64(27))) * LAST
    return value ^ (value >> np.uint64(31))


def _word_hashes(words: pa.Array) -> np.ndarray:
    """Eight bytes of all words at a time; words of more than LONG_WORD bytes, which are rare, one by one."""
    words = words.cast(pa.large_string())
    offsets = np.frombuffer(words.buffers()[1], np.int64)[words.offset : words.offset + len(words) + 1]
    starts, sizes = offsets[:-1] - offsets[0], np.diff(offsets)
    data = np.zeros(offsets[-1] - offsets[0] + 8, np.uint8)
    if len(data) > 8:
        data[:-8] = np.frombuffer(words.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    eights = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))
    state = _mixed(sizes.astype(np.uint64) + SPREAD)
    asked = np.flatnonzero(sizes <= LONG_WORD)
    for at in range(0, LONG_WORD, 8):
        asked = asked[sizes[asked] > at]
        if not len(asked):
            break
        state[asked] = _mixed((state[asked] + SPREAD) ^ (eights[starts[asked] + at] & FIRST_BYTES[np.minimum(sizes[asked] - at, 8)]))
    for i in np.flatnonzero(sizes > LONG_WORD).tolist():
        state[i] = xxhash.xxh3_64_intdigest(data[starts[i] : starts[i] + sizes[i]])
    return state


def _pair_hashes(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return _mixed(first * SPREAD + second + np.uint64(1))


def _items(hashes: np.ndarray, order: int) -> np.ndarray:
    """The lowest bit of an item tells words (0) from pairs (1)."""
    return (hashes & ~np.uint64(1)) | np.uint64(order - 1)


def _shard(hashes: np.ndarray, shards: int) -> np.ndarray:
    return (hashes >> np.uint64(40)) % np.uint64(shards)


def _states(hashes: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
    """Where the bits of an item and level start in its shard's slice, and how far they are apart."""
    with np.errstate(over="ignore"):
        state = _mixed(hashes + np.uint64(level) * SPREAD)
        return state, _mixed(state + SPREAD) | np.uint64(1)


def _position(state: np.ndarray, step: np.ndarray, i: int, slice_bits: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (state + np.uint64(i) * step) & np.uint64(slice_bits - 1)


def level_of(counts: np.ndarray, base: float) -> np.ndarray:
    return 1 + np.floor(np.log(np.maximum(counts, 1)) / np.log(base) + 1e-9).astype(np.int64)


def counts_of(levels: np.ndarray, base: float) -> np.ndarray:
    """The middle of the counts at each level; 0 at level 0."""
    low = np.ceil(base ** np.maximum(levels - 1, 0) - 1e-9)
    high = np.maximum(np.ceil(base**levels - 1e-9) - 1, low)
    return np.where(levels > 0, (low + high) / 2, 0.0)


def read_levels(bits: np.ndarray, hashes: np.ndarray, order: int, shards: int, most: int) -> np.ndarray:
    """The level of each word (order 1) or pair (2), by asking the filter for one level after the other, up to that of `most`."""
    hashes = _items(hashes, order)
    slice_bits = len(bits) * 8 // shards
    levels, asked = np.zeros(len(hashes), np.int64), np.arange(len(hashes))
    base = _shard(hashes, shards) * np.uint64(slice_bits)
    highest = int(level_of(np.array([most]), BASES[order - 1])[0]) if most else 0
    for level in range(1, highest + 1):
        state, step = _states(hashes[asked], level)
        for i in range(PROBES):
            place = base[asked] + _position(state, step, i, slice_bits)
            held = (bits[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1
            asked, state, step = asked[held], state[held], step[held]
        levels[asked] = level
        if not len(asked):
            break
    return levels


class Tokens:
    """The words of a slice in lower case with an end after each text."""

    def __init__(self, text: pa.LargeStringArray):
        words, starts = word_lists(pc.ascii_lower(text))
        coded = words.dictionary_encode()
        self.words = pa.concat_arrays([coded.dictionary.cast(pa.large_string()), pa.array([END], pa.large_string())])
        self.starts = starts + np.arange(len(starts))
        self.codes = np.full(self.starts[-1], len(self.words) - 1, np.int64)
        owner = np.repeat(np.arange(len(text)), np.diff(starts))
        self.codes[np.arange(len(words)) + owner] = coded.indices.to_numpy()
        self.owner = np.repeat(np.arange(len(text)), np.diff(self.starts))

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """The words before and the words themselves; an end comes before the first."""
        before = np.roll(self.codes, 1)
        before[self.starts[:-1]] = len(self.words) - 1
        return before, self.codes


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch.column("text"), SLICE_BYTES):
            if len(part):
                tokens = Tokens(part)
                counts = np.bincount(tokens.codes, minlength=len(tokens.words))
                yield pa.record_batch({"token": tokens.words.cast(pa.string()), "c": pa.array(counts, pa.int64())})


def word_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """How often each word (token) occurs (c) in lower case, ends included."""
    texts = docs.select(F.col(text_col).alias("text"))
    return texts.mapInArrow(_words, "token string, c long").groupBy("token").agg(F.sum("c").alias("c"))


def _item_rows(hashes: np.ndarray, counts: np.ndarray, order: int, shards: int) -> pa.RecordBatch:
    """Items with their shard."""
    item = _items(hashes, order)
    return pa.record_batch({"shard": pa.array(_shard(item, shards).astype(np.int16)), "item": pa.array(item.view(np.int64)), "n": pa.array(counts, pa.int64())})


def _added(hashes: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The distinct hashes, and the sum of the counts of each."""
    joined, n = np.concatenate(hashes), np.concatenate(counts)
    order = np.argsort(joined)
    joined, n = joined[order], n[order]
    heads = np.flatnonzero(np.concatenate(([True], joined[1:] != joined[:-1]))[: len(joined)])
    return joined[heads], np.add.reduceat(n, heads) if len(n) else n


def _slice_bits(entries: int) -> int:
    """A power of two that holds so many entries."""
    return max(64, 1 << (entries * ENTRY_BITS - 1).bit_length())


def _filter_slices(texts: DataFrame, counts: DataFrame, filter_bits: int | None, shards: int) -> DataFrame:
    """Rows (shard, bits): the filled slices of the filter, each as large as its entries need or a share of `filter_bits`."""
    if shards > 1 << 15:
        raise ValueError("at most 32,768 shards")
    fixed = None if filter_bits is None else filter_bits // shards
    if fixed is not None and (fixed < 8 or fixed & (fixed - 1)):
        raise ValueError("the bits of a shard must be a power of two")
    kind = "shard short, item long, n long"

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gathered: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in batches:
            for part in slices(batch.column("text"), SLICE_BYTES):
                if len(part):
                    tokens = Tokens(part)
                    hashes = _word_hashes(tokens.words)
                    before, after = tokens.pairs()
                    unique, n = np.unique(before * len(hashes) + after, return_counts=True)
                    gathered.append((_pair_hashes(hashes[unique // len(hashes)], hashes[unique % len(hashes)]), n))
                    if sum(len(n) for _, n in gathered) >= GATHERED:
                        yield _item_rows(*_added(*map(list, zip(*gathered, strict=True))), 2, shards)
                        gathered.clear()
        if gathered:
            yield _item_rows(*_added(*map(list, zip(*gathered, strict=True))), 2, shards)

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _item_rows(_word_hashes(batch.column("token")), batch.column("c").to_numpy(), 1, shards)

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, counts, fresh = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], 0
        for batch in batches:
            items.append(batch.column("item").to_numpy().view(np.uint64))
            counts.append(batch.column("n").to_numpy())
            fresh += batch.num_rows
            if fresh >= GATHERED:
                items, counts = ([values] for values in _added(items, counts))
                fresh = 0
        items, counts = _added(items, counts)
        levels = np.where(items & np.uint64(1), level_of(counts, BASES[1]), level_of(counts, BASES[0])).astype(np.uint8)
        shard = _shard(items, shards).astype(np.int32)
        order = np.argsort(shard, kind="stable")
        items, levels, shard = items[order], levels[order], shard[order]
        for start, end in pairwise([*np.flatnonzero(np.diff(shard, prepend=-1)).tolist(), len(shard)]):
            own, height = items[start:end], levels[start:end]
            size = fixed or _slice_bits(int(height.sum(dtype=np.int64)))
            bits = np.zeros(size // 8, np.uint8)
            for level in range(1, int(height.max()) + 1):
                own, height = own[height >= level], height[height >= level]
                state, step = _states(own, level)
                for i in range(PROBES):
                    place = _position(state, step, i, size)
                    np.bitwise_or.at(bits, place >> np.uint64(3), np.uint8(1) << (place & np.uint64(7)).astype(np.uint8))
            yield pa.record_batch({"shard": pa.array(shard[start : start + 1]), "bits": pa.array([bits.tobytes()], pa.binary())})

    items = texts.mapInArrow(pairs, kind).union(counts.mapInArrow(words, kind)).repartition("shard")
    return items.mapInArrow(fill, "shard int, bits binary")


def _hot_level(counts: DataFrame, hot: int) -> int:
    """The lowest of the log-scaled counts (at most a few hundred) from which on there are at most `hot` words."""
    sizes = counts.groupBy("level").agg(F.count(F.lit(1)).alias("n")).collect()
    level, seen = 1 << 30, 0
    for row in sorted(sizes, key=lambda r: -r["level"]):
        seen += row["n"]
        if seen > hot:
            break
        level = row["level"]
    return level


def fit(
    docs: DataFrame, text_col: str = "text", filter_bits: int | None = None, shards: int = SHARDS, hot: int = HOT,
    broadcast_bytes: int = BROADCAST_BYTES, mass: bool = True,
) -> tuple[LanguageModel, DataFrame]:
    """The model of the texts of `docs`, and the table (token, c) of the words it does not hold.

    Without `mass` the model has none, and `score` chooses it.
    """
    bound_batches()
    texts = docs.select(F.col(text_col).alias("text"))
    counts = stored(word_counts(texts), "words")
    levelled = counts.withColumn("level", F.floor(F.log("c") * 16).cast("int"))
    short = F.octet_length("token") <= HOT_BYTES
    least = _hot_level(levelled.where(short), hot)
    frequent = short & (F.col("level") >= least)
    held = levelled.where(frequent).select("token", "c").toArrow()
    size = counts.agg(
        F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v"), F.coalesce(F.max("c"), F.lit(0)).alias("most"),
    ).first()
    made = stored(_filter_slices(texts, counts, filter_bits, shards), "filter")
    largest = made.agg(F.coalesce(F.max(F.octet_length("bits")), F.lit(8)).alias("largest")).first()["largest"]
    bits = _one_filter(made, shards, largest) if shards * largest <= broadcast_bytes else None
    words = held["token"].combine_chunks().cast(pa.large_string())
    hashes = _word_hashes(words)
    by_hash = np.argsort(hashes)
    if (np.diff(hashes[by_hash]) == 0).any():
        raise RuntimeError("two frequent words have one hash")
    words, exact = words.take(pa.array(by_hash)), held["c"].to_numpy()[by_hash]
    model = LanguageModel(bits, size["n"], size["v"], words, hashes[by_hash], exact, size["most"], shards=shards)
    model = replace(model, shared=docs.sparkSession.sparkContext.broadcast(model), slices=made if bits is None else None)
    model = replace(model, mass=_likeliest_mass(texts, model) if mass else None)
    return model, levelled.where(~frequent).select("token", "c")


def _one_filter(made: DataFrame, shards: int, size: int) -> np.ndarray:
    """All slices with `size` bytes each. A smaller one is repeated: places in it are the lower bits of places in a larger one."""
    bits = np.zeros((shards, size), np.uint8)
    for batch in made.toArrow().to_batches():
        for number, part in zip(batch.column("shard").to_pylist(), batch.column("bits"), strict=True):
            part = np.frombuffer(part.as_buffer(), np.uint8)
            bits[number] = np.tile(part, size // len(part))
    return bits.reshape(-1)


#: What is made of a slice: from the model, its answers, the number of the first text, the ids, the tokens and the words' hashes.
Body = Callable[[LanguageModel, Ask, int, pa.Array, Tokens, np.ndarray], Iterator[pa.RecordBatch]]


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.Array, pa.Array]]:
    """The slices of a task's texts with their ids and the number of the first, unique in the table."""
    row = TaskContext.get().partitionId() << 40
    for batch in batches:
        at = 0
        for part in slices(batch.column("text"), SLICE_BYTES):
            if len(part):
                yield row, batch.column("id").slice(at, len(part)), part
                at += len(part)
                row += len(part)


def _by_slice(texts: DataFrame, model: LanguageModel, body: Body, kind: str) -> DataFrame:
    """What `body` makes of each slice of `texts` (id, text)."""
    if model.slices is not None:
        return _with_answers(texts, model, body, kind)
    shared = model.shared

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lm = shared.value
        for row, ids, part in _numbered(batches):
            tokens = Tokens(part)
            yield from body(lm, lm.ask, row, ids, tokens, _word_hashes(tokens.words))

    return texts.mapInArrow(compute, kind)


def _split(values: np.ndarray, starts: np.ndarray) -> pa.Array:
    """Runs of `values`, which begin at `starts`, as bytes."""
    return pa.array([run.tobytes() for run in np.split(values, starts[1:])], pa.binary())


def _joined(values: pa.Array | pa.ChunkedArray, kind: type) -> np.ndarray:
    return np.frombuffer(b"".join(values.to_pylist()), kind)


def _runs(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.Table]:
    """The rows that share a value, one table after the other; equal values are next to each other."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        value = batch.column(column).to_numpy()
        for start, end in pairwise([0, *(np.flatnonzero(np.diff(value)) + 1).tolist(), len(value)] if len(value) else []):
            if held and held[0].column(column)[0].as_py() != value[start]:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(start, end - start))
    if held:
        yield pa.Table.from_batches(held)


def _with_answers(texts: DataFrame, model: LanguageModel, body: Body, kind: str) -> DataFrame:
    """As `_by_slice`, with a filter of any size: questions go to the shards and answers back to the slices of texts.

    A slice asks for each of its words and pairs, once if no file splits it. A task holds one slice of the filter, or one of the texts, at a time.
    """
    shared, shards, most = model.shared, model.shards, model.most
    id_arrow = to_arrow_type(texts.schema["id"].dataType)

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _runs(batches, "slice"):
            tokens = Tokens(filled(rows["text"]))
            hashes = _word_hashes(tokens.words)
            before, after = tokens.pairs()
            pairs = np.unique(before * len(hashes) + after)
            pairs = _pair_hashes(hashes[pairs // len(hashes)], hashes[pairs % len(hashes)])
            items = np.unique(np.concatenate((_items(hashes, 1), _items(pairs, 2))))
            shard = _shard(items, shards).astype(np.int32)
            order = np.argsort(shard, kind="stable")
            present, starts = np.unique(shard[order], return_index=True)
            yield pa.record_batch({"shard": pa.array(present), "slice": pa.array(np.full(len(present), rows["slice"][0].as_py())), "items": _split(items[order], starts)})

    def answered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, bits = -1, np.zeros(8, np.uint8)
        for batch in batches:
            owner, held = batch.column("shard").to_numpy(), batch.column("bits").is_valid().to_numpy(zero_copy_only=False)
            heads = np.flatnonzero((np.diff(owner, prepend=-1) != 0) | held | np.roll(held, 1))
            for start, end in pairwise([*heads.tolist(), len(owner)]):
                if held[start]:
                    shard, bits = owner[start], np.frombuffer(batch.column("bits")[start].as_py(), np.uint8)
                    continue
                part = batch.slice(start, end - start)
                items = _joined(part.column("items"), np.uint64)
                levels = np.zeros(len(items), np.uint8)
                # A shard without a slice holds nothing.
                for order in (1, 2) if shard == owner[start] else ():
                    those = np.flatnonzero((items & np.uint64(1)) == order - 1)
                    levels[those] = read_levels(bits, items[those], order, 1, most)
                starts = np.concatenate(([0], np.cumsum(pc.binary_length(part.column("items")).to_numpy() // 8)[:-1]))
                yield pa.record_batch({"slice": part.column("slice"), "items": part.column("items"), "levels": _split(levels, starts)})

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, ids, part in _numbered(batches):
            first = pa.array(np.full(len(part), row))
            yield pa.record_batch({"slice": first, "at": pa.array(np.arange(len(part), dtype=np.int32)), "id": ids.cast(id_arrow), "text": part.cast(pa.string())})

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lm = shared.value
        for rows in _runs(batches, "slice"):
            given = rows.filter(pc.less(rows["at"], 0))
            items, levels = _joined(given["items"], np.uint64), _joined(given["levels"], np.uint8)
            order = np.argsort(items)
            items, levels = items[order], levels[order].astype(np.int64)
            own = rows.filter(pc.greater_equal(rows["at"], 0)).combine_chunks()
            tokens = Tokens(filled(own["text"]))
            yield from body(
                lm, lambda hashes, of, items=items, levels=levels: levels[np.searchsorted(items, _items(hashes, of))],
                rows["slice"][0].as_py(), own["id"].combine_chunks(), tokens, _word_hashes(tokens.words),
            )

    id_type = texts.schema["id"].dataType.simpleString()
    # Stored, since numbers given by tasks hold for one run of one plan.
    own = stored(texts.mapInArrow(numbered, f"slice long, at int, id {id_type}, text string"), "slices")
    questions = own.select("slice", "text").mapInArrow(asked, "shard int, slice long, items binary").withColumn("bits", F.lit(None).cast("binary"))
    held = model.slices.select("shard", F.lit(None).cast("long").alias("slice"), F.lit(None).cast("binary").alias("items"), "bits")
    by_shard = held.union(questions).repartition("shard").sortWithinPartitions("shard", F.col("slice").isNotNull())
    answers = by_shard.mapInArrow(answered, "slice long, items binary, levels binary").withColumn("at", F.lit(-1))
    rows = own.unionByName(answers, allowMissingColumns=True).repartition("slice").sortWithinPartitions("slice", "at")
    return rows.mapInArrow(compute, kind)


def _log_chances(both: np.ndarray, first: np.ndarray, chance: np.ndarray) -> Iterator[np.ndarray]:
    """The logarithms of the probabilities of pairs under each of MASSES."""
    for mass in MASSES:
        yield np.log10((both + mass * chance) / (first + mass))


def _likelihoods(both: np.ndarray, first: np.ndarray, chance: np.ndarray, times: np.ndarray) -> list[float]:
    """The likelihood under each of MASSES of pairs that occur so many `times`, each without its own occurrence."""
    given = np.flatnonzero(times)
    both, first, times = np.maximum(both[given] - 1, 0), np.maximum(first[given] - 1, 0), times[given]
    return [float(logs @ times) for logs in _log_chances(both, np.maximum(first, both), chance[given])]


def _best_mass(likelihoods: DataFrame) -> float:
    """The mass with the largest sum of its column (m0, m1, ...), the smaller one of two; the largest mass without rows."""
    sums_of = likelihoods.agg(*[F.sum(name).alias(name) for name in MASS_COLUMNS]).first()
    if sums_of[0] is None:
        return MASSES[-1]
    return MASSES[max(range(len(MASSES)), key=lambda i: (sums_of[i], -i))]


MASS_COLUMNS = [f"m{i}" for i in range(len(MASSES))]
MASS_KINDS = ", ".join(f"{name} double" for name in MASS_COLUMNS)


def _likeliest_mass(texts: DataFrame, model: LanguageModel) -> float:
    """The mass that suits all training texts best."""

    def body(lm: LanguageModel, ask: Ask, row: int, ids: pa.Array, tokens: Tokens, hashes: np.ndarray) -> Iterator[pa.RecordBatch]:
        both, first, chance, place = lm.pair_counts(tokens, hashes, ask)
        totals = _likelihoods(both, first, chance, np.bincount(place, minlength=len(both)))
        yield pa.record_batch({name: pa.array([total]) for name, total in zip(MASS_COLUMNS, totals, strict=True)})

    return _best_mass(_by_slice(texts.select(F.lit(0).alias("id"), "text"), model, body, MASS_KINDS))


def score(
    docs: DataFrame, model: LanguageModel, rare: DataFrame, id_col: str = "doc_id", text_col: str = "text", training: Column | None = None,
) -> DataFrame:
    """One row per row of `docs`: its id, n_tokens, n_known, train_tokens, base_score and score.

    If the model has no mass, `training` tells the rows of its training texts: every text is scored under each of MASSES,
    and the scores of the one that suits the training texts best are returned.
    """
    if (model.mass is None) != (training is not None):
        raise ValueError("a model without a mass needs to know its training texts, one with a mass does not")
    masses = MASSES if model.mass is None else (model.mass,)
    shown = [f"m{i}" for i in range(len(masses))]
    key = F.struct(F.col(id_col).alias("id"), (F.lit(False) if training is None else F.coalesce(training, F.lit(False))).alias("training"))
    named = docs.select(key.alias("id"), F.col(text_col).alias("text"))
    id_type = docs.schema[id_col].dataType
    id_arrow = to_arrow_type(id_type)

    def body(lm: LanguageModel, ask: Ask, row: int, ids: pa.Array, tokens: Tokens, hashes: np.ndarray) -> Iterator[pa.RecordBatch]:
        texts = len(ids)
        both, first, chance, place = lm.pair_counts(tokens, hashes, ask)
        taught = pc.struct_field(ids, "training").to_numpy(zero_copy_only=False)
        if taught.any():
            # The likelihoods of a slice are a row of their own, with a number below zero.
            times = np.bincount(place, weights=taught[tokens.owner], minlength=len(both))
            totals = _likelihoods(both, first, chance, times)
            yield pa.record_batch(
                {
                    "row": pa.array([-row - 1]), "id": pa.nulls(1, id_arrow), "token": pa.array([f"{END}{-row - 1}"], pa.string()),
                    "n": pa.array([0], pa.int64()), "n_tokens": pa.array([0], pa.int64()), "n_known": pa.array([0], pa.int64()),
                    "base": pa.array([0.0]), **{name: pa.array([total]) for name, total in zip(shown, totals, strict=True)},
                }
            )
        chances = [np.log10((both + mass * chance) / (first + mass)) for mass in masses]
        exact = lm.exact_counts(tokens.words, hashes)
        is_hot = exact > 0
        base = np.where(is_hot, np.log10((exact + SMOOTHING) / lm.total), 0.0)
        numbers = row + np.arange(texts)
        yield pa.record_batch(
            {
                "row": pa.array(numbers), "id": pc.struct_field(ids, "id").cast(id_arrow),
                "token": pa.array([f"{END}{i}" for i in numbers.tolist()], pa.string()), "n": pa.array(np.zeros(texts, np.int64)),
                "n_tokens": pa.array(np.diff(tokens.starts)), "n_known": pa.array(sums(is_hot[tokens.codes].astype(np.int64), tokens.owner, texts).astype(np.int64)),
                "base": pa.array(sums(base[tokens.codes], tokens.owner, texts)),
                **{name: pa.array(sums(logs[place], tokens.owner, texts)) for name, logs in zip(shown, chances, strict=True)},
            }
        )
        cold = np.flatnonzero(~is_hot[tokens.codes])
        keys, n = np.unique(tokens.owner[cold] * len(hashes) + tokens.codes[cold], return_counts=True)
        yield pa.record_batch(
            {
                "row": pa.array(numbers[keys // len(hashes)]), "id": pa.nulls(len(keys), id_arrow),
                "token": tokens.words.take(pa.array(keys % len(hashes))).cast(pa.string()), "n": pa.array(n, pa.int64()),
                "n_tokens": pa.nulls(len(keys), pa.int64()), "n_known": pa.nulls(len(keys), pa.int64()),
                "base": pa.nulls(len(keys), pa.float64()), **{name: pa.nulls(len(keys), pa.float64()) for name in shown},
            }
        )

    kind = f"row long, id {id_type.simpleString()}, token string, n long, n_tokens long, n_known long, base double, "
    parts = _by_slice(named, model, body, kind + ", ".join(f"{name} double" for name in shown)).join(rare, "token", "left")
    count = F.coalesce("c", F.lit(0))
    logs = F.col("n") * F.log10((count + F.lit(SMOOTHING)) / F.lit(model.total))
    scored = parts.groupBy("row").agg(
        F.max("id").alias(id_col), F.max("n_tokens").alias("n_tokens"),
        (F.max("n_known") + F.sum(F.when(count > 0, F.col("n")).otherwise(0))).alias("n_known"),
        F.lit(model.n).cast("long").alias("train_tokens"), (F.max("base") + F.sum(logs)).alias("base_score"),
        *[F.max(name).alias(name) for name in shown],
    )
    chosen = 0
    if model.mass is None:
        # Stored, so that the texts are asked about once for the choice and the result.
        scored = stored(scored, "scored")
        chosen = MASSES.index(_best_mass(scored.where("row < 0")))
    return scored.where("row >= 0").select(id_col, "n_tokens", "n_known", "train_tokens", "base_score", F.col(shown[chosen]).alias("score"))
