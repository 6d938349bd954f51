"""Words and characters of Arrow text batches, as flat arrays with one boundary per text."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession

BATCH_BYTES = 4 << 20
BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def bound_batches() -> None:
    """Lets Arrow batches of long texts hold BATCH_BYTES at most, in this session, unless it has a lower bound."""
    spark = SparkSession.active()
    if int(re.sub(r"\D", "", spark.conf.get(BATCH_SETTING))) > BATCH_BYTES:
        spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))


def filled(text: pa.Array) -> pa.LargeStringArray:
    """The texts with null as empty."""
    if isinstance(text, pa.ChunkedArray):
        text = text.combine_chunks()
    return pc.fill_null(text.cast(pa.large_string()), "")


def word_lists(text: pa.Array) -> tuple[pa.LargeStringArray, np.ndarray]:
    """All words (runs without ASCII white space) of all texts, and where each text's words start."""
    lists = pc.ascii_split_whitespace(filled(text))
    flat = lists.flatten()
    owner = pc.list_parent_indices(lists).to_numpy()
    full = pc.greater(pc.binary_length(flat), 0)
    owner = owner[full.to_numpy(zero_copy_only=False)]
    words = pc.filter(flat, full).cast(pa.large_string())
    return words, np.searchsorted(owner, np.arange(len(text) + 1))


def code_points(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The code points of all texts in a row, and where each text starts."""
    text = filled(text)
    starts = np.concatenate(([0], np.cumsum(pc.utf8_length(text).to_numpy().astype(np.int64))))
    offsets = np.frombuffer(text.buffers()[1], np.int64)[text.offset : text.offset + len(text) + 1]
    raw = text.buffers()[2]
    whole = bytes(memoryview(raw)[offsets[0] : offsets[-1]]) if raw is not None and len(text) else b""
    return np.frombuffer(whole.decode("utf-8").encode("utf-32-le"), np.uint32), starts


def slices(text: pa.Array, size: int) -> Iterator[pa.Array]:
    """The batch in slices of about `size` bytes; a longer text is a slice of its own. Binary values stay binary."""
    text = text if pa.types.is_large_binary(text.type) else filled(text)
    if not len(text):
        yield text
        return
    ends = np.cumsum(pc.binary_length(text).to_numpy().astype(np.int64))
    at = 0
    while at < len(text):
        base = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, base + size, "right")))
        yield text.slice(at, to - at)
        at = to
    # A worker lives on after its task; what it no longer needs goes back to the system.
    pa.default_memory_pool().release_unused()
