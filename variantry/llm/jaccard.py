"""Exact Jaccard join of documents as sets of word n-grams, returned as connected components.

Two sets of a and b shingles are linked if they share at least 4/9 (a + b) of them, which is a similarity of 0.8. All
linked pairs share a shingle among the first n - ceil(0.8 n) + 1 of each set in one order of all shingles, so only these
prefixes are listed. Shingles that many documents share come last in that order (`frequent_shingles`), so that a passage
in a large part of the documents brings them together only if they consist of it.

Relations between sets keep the work near the number of sets:

* Equal sets are one set. Everything below is about different sets, which are numbered.
* Each list of a shingle has a pivot, its smallest set. Every set is compared with the pivot that it shares most lists with;
  what this links are stars, whose sets have a known overlap with their pivot.
* Lists are cut into blocks by component, size and hash. Blocks of one component are not compared, nor those whose sizes
  or positions cannot give the overlap needed: whole blocks are skipped, then pairs.
* Linked sets share not one but `shared_least` listed shingles of their prefixes. The one in their shortest list has that many
  at its place or after it in either set, by length of list, so two sets meet in a list only if both have as many left there. In
  the long lists of a large group, which come last, hardly any pair is left.
* Answers of similar sets are derived: for a pair of sets, the overlap of their pivots is computed once, and what each set
  lacks of its pivot or has besides bounds the overlap of the pair from both sides. Only pairs that the bounds leave open are compared.

Shingles are 64-bit hashes, so a count may be wrong by a chance collision within two sets only. Sets of pairs to be compared
are derived again from the texts, which are found by their MD5; no other set leaves its task. The sets compared with a
pivot are cut into parts of about PART sets, and a list into blocks of about as many.

Null texts and texts without words have no shingles and are linked with nothing; a text with fewer words than a
shingle is one shingle. Rows may repeat and ids may be null or repeat: every row is returned; a component's id is its
smallest that is not null. Other columns are not read. A very long text needs about 100 bytes per word in its task.
Rows must be stable: a task that runs again must see the rows it saw before, as when reading files.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from variantry.llm.arrow_text import bound_batches, filled, slices, word_lists
from variantry.llm.bitmap import bitmap, marked
from variantry.llm.components import components
from variantry.llm.store import stored
from variantry.llm.words import text_of

WIDTH = 5
SLICE_BYTES = 1 << 20
#: Shingles of different sets that are counted together when frequent ones are sought.
UNIT = 1 << 21
#: A shingle is frequent if units that hold it more than once hold it more often than this; at most MOST shingles are.
FREQUENT, MOST = 16, 1 << 20
#: Sets per block of a list, and compared with one copy of a pivot.
PART = 256
MIX, LAST = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mixed(state: np.ndarray) -> np.ndarray:
    state = (state ^ (state >> np.uint64(30))) * MIX
    state = (state ^ (state >> np.uint64(27))) * LAST
    return state ^ (state >> np.uint64(31))


def shingle_sets(text: pa.Array, width: int = WIDTH) -> Iterator[np.ndarray]:
    """For each text of a slice its distinct shingles in order, as signed 64-bit hashes."""
    words, starts = word_lists(pc.ascii_lower(filled(text)))
    codes = words.dictionary_encode()
    names = codes.dictionary.cast(pa.large_binary()).to_pylist()
    hashes = np.fromiter((xxhash.xxh3_64_intdigest(name) for name in names), np.uint64, len(names))
    word = hashes[codes.indices.to_numpy()] if len(names) else np.zeros(0, np.uint64)
    whole = max(len(word) - width + 1, 0)
    state = np.full(whole, width, np.uint64)
    for i in range(width):
        state = _mixed(state ^ word[i : i + whole])
    for first, end in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
        n = end - first
        if n >= width:
            yield np.unique(state[first : end - width + 1].view(np.int64))
        else:
            short = np.full(min(n, 1), n, np.uint64)
            for i in range(n):
                short = _mixed(short ^ word[first + i : first + i + 1])
            yield short.view(np.int64)


def needed(a: str, b: str) -> str:
    """The overlap that links sets of sizes a and b: the least whole number of 4/9 of their sum."""
    return f"((4 * ({a} + {b}) + 8) div 9)"


def prefix_length(n: int) -> int:
    return n - -(-4 * n // 5) + 1


def _beyond(n: str) -> str:
    """How much of a set lies beyond its prefix."""
    return f"((4 * {n} + 4) div 5 - 1)"


def shared_least(na: str, nb: str, large_a: str | None = None, large_b: str | None = None) -> str:
    """How many shingles of their prefixes linked sets of sizes na and nb share at least; of sizes up to `large_`, if given."""
    return f"({needed(na, nb)} - greatest({_beyond(large_a or na)}, {_beyond(large_b or nb)}))"


def frequent_shingles(docs: DataFrame, text_col: str, width: int = WIDTH) -> np.ndarray:
    """Shingles that many different sets hold, in order; at most MOST.

    Each task counts UNIT shingles at a time, and sends those that it has more than once. All documents are counted. The
    result only decides which shingles come last in the order, so one more or less changes the cost and no result.
    """

    def repeated(parts: list[np.ndarray]) -> pa.RecordBatch:
        values, counts = np.unique(np.concatenate([*parts, np.zeros(0, np.int64)]), return_counts=True)
        often = counts > 1
        return pa.record_batch({"token": pa.array(values[often]), "n": pa.array(counts[often].astype(np.int64))})

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        seen: set[int] = set()
        size = 0
        for batch in batches:
            for part in slices(batch.column(0), SLICE_BYTES):
                for own in shingle_sets(part, width):
                    digest = xxhash.xxh3_64_intdigest(own.tobytes())
                    if digest not in seen:
                        seen.add(digest)
                        held.append(own)
                        size += len(own)
                if size >= UNIT:
                    yield repeated(held)
                    held, seen, size = [], set(), 0
        yield repeated(held)

    bound_batches()
    found = docs.select(text_col).mapInArrow(count, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
    found = stored(found.where(F.col("n") > FREQUENT), "frequent")
    total = found.agg(F.sum("n")).first()[0] or 0
    rows = found.where(F.col("n") > total // MOST).select("token").toPandas()
    return np.sort(rows["token"].to_numpy(np.int64))


def described(text: Column, frequent: np.ndarray, width: int = WIDTH) -> Column:
    """The size of a text's set, two digests of it, and its prefix."""

    def describe(own: np.ndarray) -> tuple[int, int, int, np.ndarray]:
        raw = own.tobytes()
        place = np.minimum(np.searchsorted(frequent, own), max(len(frequent) - 1, 0))
        late = frequent[place] == own if len(frequent) else np.zeros(len(own), bool)
        ordered = np.concatenate((own[~late], own[late]))
        digest = np.array([xxhash.xxh3_64_intdigest(raw), xxhash.xxh64_intdigest(raw)], np.uint64).view(np.int64)
        return len(own), int(digest[0]), int(digest[1]), ordered[: prefix_length(len(own))] if len(own) else own

    def compute(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            rows = [describe(own) for part in slices(batch, SLICE_BYTES) for own in shingle_sets(part, width)]
            n, one, two, prefix = zip(*rows, strict=True) if rows else ((), (), (), ())
            ends = np.cumsum([0, *map(len, prefix)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([*prefix, np.zeros(0, np.int64)])))
            columns = [pa.array(n, pa.int64()), pa.array(one, pa.int64()), pa.array(two, pa.int64()), lists]
            yield pa.StructArray.from_arrays(columns, names=["n", "one", "two", "prefix"])

    bound_batches()
    return F.arrow_udf(compute, "n long, one long, two long, prefix array<long>")(text)


def packed(text: Column, width: int = WIDTH) -> Column:
    """The shingles of a text as bytes."""

    def compute(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([own.tobytes() for part in slices(batch, SLICE_BYTES) for own in shingle_sets(part, width)], pa.binary())

    bound_batches()
    return F.arrow_udf(compute, "binary")(text)


def _key(text: Column) -> Column:
    return F.unhex(F.md5(text_of(text)))


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Overlaps of each set with the pivot before it."""
    pivot, holder = np.zeros(0, np.int64), None
    for batch in batches:
        a, b, shared = batch.column("a").to_pylist(), batch.column("b").to_pylist(), []
        for i, member in enumerate(b):
            own = np.frombuffer(batch.column("shingles")[i].as_buffer(), np.int64)
            if member is None:
                pivot, holder = own.copy(), a[i]
                continue
            if holder != a[i]:
                raise ValueError(f"set {a[i]} was not found")
            place = np.minimum(np.searchsorted(pivot, own), len(pivot) - 1)
            shared.append((a[i], member, int((pivot[place] == own).sum())))
        columns = zip(*shared, strict=True) if shared else ([], [], [])
        yield pa.record_batch([pa.array(c, pa.int64()) for c in columns], ["a", "b", "overlap"])


def overlaps(docs: DataFrame, classes: DataFrame, pairs: DataFrame, text_col: str, width: int = WIDTH) -> DataFrame:
    """Pairs (a, b) of sets of `classes` with the number of shingles they share."""
    pairs = stored(pairs.select("a", "b").distinct(), "pairs")
    load = pairs.groupBy("a").agg((F.count(F.lit(1)) / PART).cast("int").alias("parts"))
    pivots = load.select(
        F.col("a").alias("set"), "a", F.explode(F.sequence(F.lit(0), "parts")).alias("part"), F.lit(None).cast("long").alias("b")
    )
    part = F.pmod(F.xxhash64("b"), F.col("parts") + 1).cast("int").alias("part")
    others = pairs.join(load, "a").select(F.col("b").alias("set"), "a", part, "b")
    # Where a set is needed travels to its text, so that its shingles move once, to the comparison.
    places = pivots.union(others).groupBy("set").agg(F.collect_list(F.struct("a", "part", "b")).alias("places"))
    asked = stored(classes.select("set", "key").join(places, "set").select("key", "places"), "asked")
    texts = docs.select(_key(F.col(text_col)).alias("text_key"), text_of(F.col(text_col)).alias("text"))
    near = marked(texts.withColumn("hash", F.xxhash64("text_key")), "hash", bitmap(asked.select(F.xxhash64("key").alias("key"))), "found")
    once = near.where("found").groupBy("text_key").agg(F.min("text").alias("text"))
    members = once.join(asked, F.col("text_key") == F.col("key")).select("places", packed(F.col("text"), width).alias("shingles"))
    together = members.select(F.inline("places"), "shingles")
    together = together.repartition("a", "part").sortWithinPartitions("a", "part", F.asc_nulls_first("b"))
    return stored(together.select("a", "b", "shingles").mapInArrow(_compared, "a long, b long, overlap long"), "overlaps")


def _lists(classes: DataFrame) -> DataFrame:
    """Places (token, set, n, pos) in lists of two or more sets, with the list's length and its pivot.

    The pivot is the set that holds the shingle earliest: of near copies, the one with the fewest shingles of its own.
    """
    entries = classes.select("set", "n", F.posexplode("prefix").alias("pos", "token"))
    whole = Window.partitionBy("token")
    listed = entries.select(
        "token", "set", "n", "pos", F.count(F.lit(1)).over(whole).alias("length"),
        F.min(F.struct("pos", "set", "n")).over(whole).alias("pivot"),
    )
    listed = listed.where("length > 1").select(
        "token", "set", "n", "pos", "length", F.col("pivot.set").alias("pivot"), F.col("pivot.n").alias("pivot_n")
    )
    return stored(listed, "lists")


def _stars(docs: DataFrame, classes: DataFrame, lists: DataFrame, text_col: str, width: int) -> DataFrame:
    """Sets (b) linked with the pivot (a) that they share most lists with, and their overlap.

    A set may meet its pivot in some of the lists they share only, so half of what a linked pair shares is enough here.
    """
    met = lists.where("`set` <> pivot and 5 * pivot_n >= 4 * n and 5 * n >= 4 * pivot_n")
    met = met.groupBy(F.col("set").alias("b"), F.col("pivot").alias("a")).agg(
        F.count(F.lit(1)).alias("shared"), F.first("n").alias("nb"), F.first("pivot_n").alias("na")
    )
    enough = met.where(f"2 * shared >= {shared_least('na', 'nb')}")
    best = enough.groupBy("b").agg(F.max(F.struct("shared", "a", "na", "nb")).alias("best")).select("b", "best.*")
    best = stored(best, "best")
    compared = overlaps(docs, classes, best, text_col, width)
    linked = compared.join(best.select("a", "b", "na", "nb"), ["a", "b"]).where(f"overlap >= {needed('na', 'nb')}")
    return stored(linked, "stars")


def _meetings(blocks: DataFrame) -> DataFrame:
    """Pairs (a, b, na, nb), once per list in which they meet with all that a linked pair has there."""
    left, right = (blocks.select(*[F.col(name).alias(f"{side}_{name}") for name in blocks.columns]) for side in "lr")
    reachable = "least(l_before, r_before) + 1 + least(l_after, r_after) >= " + needed("l_least", "r_least")
    met = left.join(right, F.expr(
        f"l_token = r_token and l_root < r_root and 5 * l_most >= 4 * r_least "
        f"and 5 * r_most >= 4 * l_least and {reachable} "
        f"and least(l_rest, r_rest) >= {shared_least('l_least', 'r_least', 'l_most', 'r_most')}"
    ))
    pair = (
        "5 * x.n >= 4 * y.n and 5 * y.n >= 4 * x.n and "
        f"least(x.pos, y.pos) + least(x.n - x.pos, y.n - y.pos) >= {needed('x.n', 'y.n')} and "
        f"least(x.rest, y.rest) >= {shared_least('x.n', 'y.n')}"
    )
    # Numbers only: what else is known of the sets is looked up for the pairs that are left.
    both = "struct(x.set as a, y.set as b, x.n as na, y.n as nb)"
    return met.select(F.expr(
        f"inline(flatten(transform(l_places, x -> transform(filter(r_places, y -> {pair}), y -> {both}))))"
    ))


def _candidates(lists: DataFrame, roots: DataFrame) -> DataFrame:
    """Pairs (a, b) of sets of different components, with their sizes (na, nb), that may share enough of their prefixes."""
    labelled = roots.select(F.col("node").alias("set"), "root")
    own = Window.partitionBy("set").orderBy(F.desc("length"), F.desc("token"))
    ranked = lists.select("token", "set", "n", "pos", "length", F.row_number().over(own).alias("rest"))
    places = ranked.join(labelled, "set", "left").select(
        "token", F.coalesce("root", "set").alias("root"), "length", F.struct("set", "n", "pos", "rest").alias("place")
    )
    # All that follows is by shingle, so its places move once.
    whole = Window.partitionBy("token")
    places = places.withColumns({"low": F.min("root").over(whole), "high": F.max("root").over(whole)}).where("low <> high")
    band = F.floor(F.log2(F.col("place.n").cast("double")) * 16)
    part = F.pmod(F.xxhash64("place.set"), F.floor(F.col("length") / PART) + 1)
    blocks = places.groupBy("token", "root", band.alias("band"), part.alias("part")).agg(
        F.collect_list("place").alias("places"), F.min("place.n").alias("least"), F.max("place.n").alias("most"),
        F.max("place.pos").alias("before"), F.max(F.col("place.n") - F.col("place.pos") - 1).alias("after"),
        F.max("place.rest").alias("rest"),
    )
    blocks = stored(blocks, "blocks")
    return stored(_meetings(blocks).distinct(), "candidates")


def _links(docs: DataFrame, classes: DataFrame, candidates: DataFrame, stars: DataFrame, text_col: str, width: int) -> DataFrame:
    """The candidates that are linked, from the overlaps of their pivots where these decide it."""
    for side in "ab":
        star = stars.selectExpr(f"b as {side}", f"a as ref_{side}", f"na as ref_n{side}", f"overlap as own_{side}")
        candidates = candidates.join(star, side, "left").withColumns(
            {f"ref_{side}": F.coalesce(f"ref_{side}", side), f"ref_n{side}": F.coalesce(f"ref_n{side}", f"n{side}"),
             f"own_{side}": F.coalesce(f"own_{side}", f"n{side}")}
        )
    pivots = stored(candidates.withColumns({"low": F.least("ref_a", "ref_b"), "high": F.greatest("ref_a", "ref_b")}), "pivots")
    known = overlaps(docs, classes, pivots.selectExpr("low as a", "high as b"), text_col, width)
    known = known.select(F.col("a").alias("low"), F.col("b").alias("high"), "overlap")
    derived = pivots.join(known, ["low", "high"]).selectExpr(
        "a", "b", f"{needed('na', 'nb')} as need",
        "overlap + (na - own_a) + (nb - own_b) as most", "overlap - (ref_na - own_a) - (ref_nb - own_b) as least",
    )
    derived = stored(derived.where("most >= need"), "derived")
    open_pairs = derived.where("least < need")
    compared = overlaps(docs, classes, open_pairs, text_col, width)
    found = compared.join(open_pairs, ["a", "b"]).where("overlap >= need")
    return derived.where("least >= need").select("a", "b").union(found.select("a", "b"))


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH) -> DataFrame:
    """One row per row of `docs`: its id, n_shingles, and the smallest id that links reach as component_id."""
    frequent = frequent_shingles(docs, text_col, width)
    text = F.col(text_col)
    rows = docs.select(F.col(id_col).alias("id"), _key(text).alias("key"), described(text, frequent, width).alias("set"))
    rows = stored(rows.select("id", "key", "set.*"), "rows")
    same = ["n", "one", "two"]
    classes = rows.where("n > 0").groupBy(*same).agg(
        F.min("id").alias("id"), F.min(F.struct("key", "prefix")).alias("first")
    )
    classes = stored(classes.select(F.monotonically_increasing_id().alias("set"), *same, "id", "first.*"), "classes")
    lists = _lists(classes)
    stars = _stars(docs, classes, lists, text_col, width)
    roots = components(stars.select("a", "b"))
    candidates = _candidates(lists, roots)
    links = stars.select("a", "b").union(_links(docs, classes, candidates, stars, text_col, width))
    roots = components(links)
    named = classes.select("set", *same, "id").join(roots, F.col("set") == F.col("node"), "left")
    named = stored(named.select(*same, "id", F.coalesce("root", "set").alias("root")), "named")
    smallest = named.groupBy("root").agg(F.min("id").alias("component_id"))
    named = named.join(smallest, "root").select(*same, "component_id")
    joined = rows.select("id", *same).join(named, same, "left")
    return joined.select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id")
    )
