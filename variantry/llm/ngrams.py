"""Hashed character n-grams of Arrow text batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from variantry.llm.arrow_text import code_points, filled, slices

#: Bytes of text whose n-grams are held at once.
SLICE_BYTES = 1 << 19
#: Odd multipliers that mix bits.
SPREAD, MIX, LAST = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def hashed(points: np.ndarray, width: int, bits: int) -> np.ndarray:
    """A bucket of `bits` bits for each run of `width` code points."""
    count = max(len(points) - width + 1, 0)
    wide = points.astype(np.uint64) * SPREAD
    state = wide[:count].copy()
    for k in range(1, width):
        state ^= state >> np.uint64(29)
        state *= MIX
        state += wide[k : k + count]
    state ^= state >> np.uint64(32)
    state *= LAST
    return (state >> np.uint64(64 - bits)).astype(np.int32)


def grams(text: pa.Array, widths: tuple[int, ...], bits: int) -> Iterator[tuple[int, int, list[tuple[np.ndarray, np.ndarray]]]]:
    """For each slice of the batch: its first text, its number of texts, and per width buckets with their texts in order.

    Texts are lower-cased; n-grams do not cross texts.
    """
    at = 0
    for part in slices(pc.utf8_lower(filled(text)), SLICE_BYTES):
        points, starts = code_points(part)
        owner = np.repeat(np.arange(len(part)), np.diff(starts))
        found = []
        for width in widths:
            buckets = hashed(points, width, bits)
            same = owner[: len(buckets)] == owner[width - 1 :][: len(buckets)]
            found.append((buckets[same], owner[: len(buckets)][same]))
        yield at, len(part), found
        at += len(part)


def sums(values: np.ndarray, owner: np.ndarray, texts: int) -> np.ndarray:
    """The sum of each text's rows of `values`, which are in order of their texts."""
    out = np.zeros((texts, *values.shape[1:]), np.float64)
    if len(owner):
        heads = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
        out[owner[heads]] = np.add.reduceat(values, heads, axis=0, dtype=np.float64)
    return out
