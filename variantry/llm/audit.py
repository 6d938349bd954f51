"""How filters interact: what each removes, repeats or alone catches, under every order of application.

A document is a row of a mask matrix: 0 where it fails a filter, infinity where it passes. An order is a row of a
position matrix, the inverse of its permutation: the step at which each filter stands. The min-plus product of the two,
the minimum over filters of mask plus position, is the step at which a document goes under an order. Documents of one
part with the same mask go at the same steps, so each part multiplies its distinct masks only (2^filters at most) and
carries documents as weights; the weights are scattered to (order, step) and give all counts. Spark counts the weights,
combined in each task before the shuffle, so neither parts nor masks of any size meet in one place.

Duplicates are found by SHA-256 of the text: a row is none if its id is the smallest of its digest. That is asked by
joining on digest and id together, so a large group of copies is spread over its ids.

A null text counts as empty. A null part is the empty string, like an empty one. A row with a null id is no duplicate and
has no label. Rows may repeat: each counts, and rows with the same id and text are no duplicates of each other. A document
has a label if any row of the labels says so. An empty table has no parts and gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from variantry.llm.arrow_text import bound_batches, filled, slices, word_lists
from variantry.llm.store import stored
from variantry.llm.words import text_of

MIN_WORDS = 200
MIN_DISTINCT_PERCENT = 50
MAX_CAPITAL_PERCENT = 3
SYMBOLS = b"#$%&*|"
FILTERS = "ABCDE"
#: More filters have too many orders to list them all.
MAX_FILTERS = 7
SLICE_BYTES = 1 << 20
KEPT = 99


def _flags(chosen: bytes | range) -> np.ndarray:
    """Which byte values are among the given ones."""
    table = np.zeros(256, np.int64)
    table[list(chosen)] = 1
    return table


CAPITALS, SYMBOL_BYTES = _flags(range(65, 91)), _flags(SYMBOLS)
#: In UTF-8, all bytes but these start a character.
STARTS = 1 - _flags(range(0x80, 0xC0))


def _byte_counts(text: pa.LargeStringArray, tables: list[np.ndarray]) -> list[np.ndarray]:
    """For each table, how many bytes of each text it marks."""
    offsets = np.frombuffer(text.buffers()[1], np.int64)[text.offset : text.offset + len(text) + 1]
    raw = text.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[offsets[0] : offsets[-1]] if raw is not None else np.zeros(0, np.uint8)
    ends = offsets - offsets[0]
    totals = [np.concatenate(([0], np.cumsum(table[data]))) for table in tables]
    return [total[ends[1:]] - total[ends[:-1]] for total in totals]


def text_failures(text: pa.LargeStringArray) -> np.ndarray:
    """Bits of the filters A to D that each text of a slice fails."""
    capitals, symbols, points = _byte_counts(text, [CAPITALS, SYMBOL_BYTES, STARTS])
    words, starts = word_lists(text)
    n_words = np.diff(starts)
    codes = words.dictionary_encode()
    owner = np.repeat(np.arange(len(text)), n_words)
    keys = owner * max(len(codes.dictionary), 1) + codes.indices.to_numpy()
    distinct = np.bincount(np.unique(keys) // max(len(codes.dictionary), 1), minlength=len(text))
    failed = [
        n_words < MIN_WORDS, 100 * distinct < MIN_DISTINCT_PERCENT * n_words, 100 * capitals > MAX_CAPITAL_PERCENT * points,
        symbols > 0,
    ]
    return sum(bits.astype(np.int32) << i for i, bits in enumerate(failed)).astype(np.int32)


def failure_mask(text: Column) -> Column:
    """The filters A to D that a text fails, as bits of an integer."""

    def compute(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array(np.concatenate([text_failures(filled(part)) for part in slices(batch, SLICE_BYTES)]))

    bound_batches()
    return F.arrow_udf(compute, "int")(text)


def position_matrix(orders: list[tuple[int, ...]]) -> np.ndarray:
    """For each order (filters by step) the step, from 1, of each filter."""
    positions = np.empty((len(orders), len(orders[0])), np.int64)
    for row, order in zip(positions, orders, strict=True):
        row[list(order)] = np.arange(1, len(order) + 1)
    return positions


def removal_steps(masks: np.ndarray, positions: np.ndarray) -> np.ndarray:
    """The min-plus product: for each mask and order the step of removal, KEPT if there is none."""
    cost = np.where(masks[:, None] >> np.arange(positions.shape[1]) & 1, 0, KEPT)
    steps = np.full((len(masks), len(positions)), KEPT)
    for i in range(positions.shape[1]):
        np.minimum(steps, cost[:, i : i + 1] + positions[:, i], out=steps)
    return steps


COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def interactions(masks: np.ndarray, weights: dict[str, np.ndarray], filters: str = FILTERS) -> pd.DataFrame:
    """COUNTS for every order and step from the distinct masks and their weights (documents, good, toxic)."""
    n = len(filters)
    orders = list(permutations(range(n)))
    positions, by_step = position_matrix(orders), np.array(orders)
    steps = removal_steps(masks, positions)
    place = np.arange(len(orders)) * (n + 2) + np.minimum(steps, n + 1)

    def scattered(weight: np.ndarray) -> np.ndarray:
        """Weight removed at each step (columns 1 to n) of each order."""
        spread = np.repeat(weight, len(orders))
        return np.bincount(place.ravel(), spread, len(orders) * (n + 2)).reshape(len(orders), n + 2)[:, 1 : n + 1].astype(np.int64)

    documents = weights["documents"]
    removed = scattered(documents)
    failing = np.array([documents[masks >> i & 1 == 1].sum() for i in range(n)])
    alone = np.array([documents[masks == 1 << i].sum() for i in range(n)])
    shapley = np.bincount(by_step.ravel(), removed.ravel(), n).astype(np.int64)
    # Whatever fails a step's filter and does not go there went earlier.
    columns = {
        "kept": documents.sum() - removed.cumsum(axis=1), "removed": removed, "redundant": failing[by_step] - removed,
        "unique_fails": alone[by_step], "good_lost": scattered(weights["good"]), "toxic_lost": scattered(weights["toxic"]),
        "shapley": shapley[by_step],
    }
    names = np.repeat(["".join(filters[i] for i in order) for order in orders], n)
    return pd.DataFrame(
        {"filter_order": names, "step": np.tile(np.arange(1, n + 1, dtype=np.int32), len(orders))}
        | {name: values.ravel().astype(np.int64) for name, values in columns.items()}
    )


def audit(masks: DataFrame, filters: str = FILTERS) -> DataFrame:
    """COUNTS per part, order and step of `masks` (part, mask: bits of failed filters, good, toxic: booleans)."""
    if not 1 <= len(filters) <= MAX_FILTERS:
        raise ValueError(f"between 1 and {MAX_FILTERS} filters, not {len(filters)}")
    weighed = masks.groupBy("part", "mask").agg(
        F.count(F.lit(1)).alias("documents"), F.count_if("good").alias("good"), F.count_if("toxic").alias("toxic")
    )

    def of_part(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        weights = {name: frame[name].to_numpy(np.int64) for name in ("documents", "good", "toxic")}
        table = interactions(frame["mask"].to_numpy(np.int64), weights, filters)
        table.insert(0, "part", key[0])
        return table

    schema = "part string, filter_order string, step int, " + ", ".join(f"{name} long" for name in COUNTS)
    return weighed.groupBy("part").applyInPandas(of_part, schema)


def failures(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang",
) -> DataFrame:
    """One row per row of `docs`: its part, the mask of the filters A to E that it fails, and its labels."""
    text = F.col(text_col)
    rows = stored(
        docs.select(
            F.col(id_col).alias("id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
            failure_mask(text).alias("mask"), F.unhex(F.sha2(text_of(text), 256)).alias("digest"),
        ),
        "failures",
    )
    firsts = rows.where("id is not null").groupBy("digest").agg(F.min("id").alias("id")).withColumn("first", F.lit(True))
    known = labels.select(F.col(id_col).alias("id"), (F.col("quality") == 1).alias("good"), (F.col("toxic") == 1).alias("toxic"))
    known = known.where("id is not null and (good or toxic)").groupBy("id").agg(
        F.bool_or(F.coalesce("good", F.lit(False))).alias("good"), F.bool_or(F.coalesce("toxic", F.lit(False))).alias("toxic")
    )
    joined = rows.join(firsts, ["digest", "id"], "left").join(known, "id", "left")
    copy = F.col("id").isNotNull() & F.col("first").isNull()
    mask = F.col("mask").bitwiseOR(F.when(copy, 1 << FILTERS.index("E")).otherwise(0))
    return joined.select(
        "part", mask.alias("mask"), F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic")
    )


def filter_interactions(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang",
) -> DataFrame:
    """COUNTS per part, order of the filters A to E, and step."""
    return audit(failures(docs, labels, id_col, text_col, part_col))
