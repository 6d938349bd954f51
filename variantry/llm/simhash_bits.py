"""SimHash fingerprints of Arrow text batches."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

from variantry.llm.arrow_text import word_lists

SEED = 42
CHUNK = 1 << 16


def fingerprints(text: pa.Array, width: int) -> np.ndarray:
    """One unsigned 64-bit fingerprint per text; shingles count as often as they occur."""
    words, starts = word_lists(pc.ascii_lower(text))
    counts = np.diff(starts)
    result = np.zeros(len(counts), np.uint64)
    # A text with fewer words than a shingle is one shingle of all its words.
    shingles = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    bounds = np.concatenate(([0], np.cumsum(shingles)))
    offsets = np.frombuffer(words.buffers()[1], np.int64)[words.offset : words.offset + len(words) + 1]
    data = np.frombuffer(words.buffers()[2], np.uint8)[offsets[0] : offsets[-1]] if len(words) else np.zeros(0, np.uint8)
    begin, end = offsets[:-1] - offsets[0], offsets[1:] - offsets[0]
    place = np.arange(len(begin))
    spaced = np.full(len(data) + len(begin), 32, np.uint8)
    spaced[np.arange(len(data)) + np.repeat(place, end - begin)] = data
    joined = spaced.tobytes()
    first = np.repeat(starts[:-1] - bounds[:-1], shingles) + np.arange(bounds[-1])
    last = first + np.repeat(np.minimum(counts, width), shingles) - 1
    left, right = (begin + place)[first], (end + place)[last]
    document = np.repeat(np.arange(len(counts)), shingles)
    votes = np.zeros((len(counts), 64), np.int64)
    for at in range(0, len(left), CHUNK):
        to = min(at + CHUNK, len(left))
        digest = xxhash.xxh64_intdigest
        hashes = np.fromiter(
            (digest(joined[a:b], SEED) for a, b in zip(left[at:to].tolist(), right[at:to].tolist(), strict=True)),
            np.uint64, to - at,
        )
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        owner = document[at:to]
        heads = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
        votes[owner[heads]] += np.add.reduceat(bits, heads, axis=0, dtype=np.int64)
    majority = 2 * votes > shingles[:, None]
    result[:] = np.packbits(majority, axis=1, bitorder="little").view(np.uint64)[:, 0]
    return result
