"""SimHash near-duplicates: fingerprints that differ in few bits, found by the pigeonhole principle.

A fingerprint is cut into `distance` pieces and a few more. Two fingerprints that differ in at most `distance`
bits agree in all pieces but `distance` of them, so every choice of that many agreeing pieces is one block key:
close pairs share a block, and a join on the block then compares all bits. Three pieces more than the distance
make keys of about 32 bits: chance meetings stay rare up to billions of documents.

* Equal fingerprints are brought together first, so copies never meet in pairs.
* Blocks with one member are dropped. In every other block each member is first compared with the smallest
  member alone; what these links connect needs no further comparison. The join on blocks only returns links
  between parts that are not yet connected, and each in the first block that a pair shares.
* Both sides of that join are read from files and shuffled by block, so a very full block can be split.

Null texts count as empty. Texts without words have fingerprint zero and are linked like any other. Rows may
repeat and ids may be null or repeat: every row is returned. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from variantry.llm.arrow_text import bound_batches, slices
from variantry.llm.bitmap import WORDS, bitmap, marked
from variantry.llm.components import components
from variantry.llm.simhash_bits import fingerprints
from variantry.llm.store import stored

BITS = 64
SHINGLE_WORDS = 3
MAX_DISTANCE = 3
#: Pieces beyond the distance: more of them make keys longer, and blocks smaller.
EXTRA_PIECES = 3
SLICE_BYTES = 1 << 20


def fingerprint(text: Column, width: int = SHINGLE_WORDS) -> Column:
    """The fingerprint of each text as a long."""

    def compute(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            parts = [fingerprints(part, width) for part in slices(batch, SLICE_BYTES)]
            yield pa.concat_arrays([pa.array(part.view("int64")) for part in parts])

    bound_batches()
    return F.arrow_udf(compute, "long")(text)


def piece_masks(distance: int, extra: int = EXTRA_PIECES) -> list[int]:
    """One mask for every choice of `extra` among `distance + extra` pieces of the fingerprint."""
    pieces = distance + extra
    ends = [BITS * i // pieces for i in range(pieces + 1)]
    masks = [(1 << b) - (1 << a) for a, b in zip(ends, ends[1:], strict=False)]
    return [sum(chosen) for chosen in combinations(masks, extra)]


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def _differing(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def close_links(prints: DataFrame, distance: int = MAX_DISTANCE) -> DataFrame:
    """Links (a, b) that connect all distinct fingerprints of `prints` (print: long) within `distance` bits."""
    masks = [_signed(mask) for mask in piece_masks(distance)]
    keys = prints.select("print").distinct().select(
        "print", F.posexplode(F.array(*[F.col("print").bitwiseAND(F.lit(mask)) for mask in masks])).alias("choice", "part")
    )
    blocks = keys.groupBy("choice", "part").agg(F.min("print").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    members = stored(keys.join(blocks.drop("n"), ["choice", "part"]), "members")
    near_first = members.where(_differing("print", "first") <= distance)
    stars = components(near_first.select(F.col("print").alias("a"), F.col("first").alias("b")))
    labelled = members.select("print", "choice", "part").join(stars, F.col("print") == F.col("node"), "left")
    labelled = stored(
        labelled.select("print", "choice", "part", F.coalesce("root", "print").alias("root")), "labelled"
    )
    left = labelled.select("choice", "part", F.col("print").alias("a"), F.col("root").alias("root_a"))
    right = labelled.select(
        F.col("choice").alias("choice_b"), F.col("part").alias("part_b"), F.col("print").alias("b"),
        F.col("root").alias("root_b"),
    )
    apart = F.col("a").bitwiseXOR(F.col("b"))
    first_shared = F.coalesce(*[F.when(apart.bitwiseAND(F.lit(mask)) == 0, i) for i, mask in enumerate(masks)])
    joined = left.join(
        right,
        (F.col("choice") == F.col("choice_b")) & (F.col("part") == F.col("part_b")) & (F.col("a") < F.col("b"))
        & (F.col("root_a") != F.col("root_b")) & (_differing("a", "b") <= distance)
        & (first_shared == F.col("choice")),
    )
    return stars.select(F.col("node").alias("a"), F.col("root").alias("b")).union(joined.select("a", "b"))


def _grouped(prints: DataFrame, distance: int) -> DataFrame:
    """Each distinct fingerprint of `prints` (id, print) with its smallest id, number of rows and root fingerprint."""
    smallest = prints.groupBy("print").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("n"))
    roots = components(close_links(smallest, distance))
    grouped = smallest.join(roots, F.col("print") == F.col("node"), "left")
    return stored(grouped.select("print", "id", "n", F.coalesce("root", "print").alias("root")), "grouped")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE_WORDS,
    distance: int = MAX_DISTANCE,
) -> DataFrame:
    """One row per row of `docs`: its id, fingerprint (16 hex digits) and component_id.

    component_id is the smallest id that links of at most `distance` bits reach, null if all of them are null.
    """
    prints = stored(docs.select(F.col(id_col).alias("id"), fingerprint(F.col(text_col), width).alias("print")), "prints")
    grouped = _grouped(prints, distance)
    classes = stored(grouped.groupBy("root").agg(F.min("id").alias("component_id")), "classes")
    named = stored(grouped.join(classes, "root").select("print", "component_id"), "named")
    return prints.join(named, "print").select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE_WORDS,
    distance: int = MAX_DISTANCE, words: int = WORDS,
) -> DataFrame:
    """The row with the smallest id (null last) of each component, with all its columns.

    Rows are stored once with their fingerprints, which are costly and needed three times. Rows whose fingerprint has
    no other row in its component stay where they are, found by a fixed-size bitmap of the fingerprints that have; only
    the texts of the others are shuffled, combined by component in each task.
    """
    whole = docs.select(F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("doc"))
    printed = stored(whole.select("doc", fingerprint(F.col(f"doc.`{text_col}`"), width).alias("print")), "printed")
    grouped = _grouped(printed.select(F.col(f"doc.`{id_col}`").alias("id"), "print"), distance)
    several = grouped.groupBy("root").agg(F.sum("n").alias("rows")).where("rows > 1").select("root")
    several = stored(grouped.join(several, "root").select("print", "root"), "several")
    parted = marked(printed, "print", bitmap(several.select(F.col("print").alias("key")), words), "shared", words)
    found = parted.where("shared").join(several.withColumnRenamed("print", "several_print"), F.col("print") == F.col("several_print"), "left")
    doc_id = F.col(f"doc.`{id_col}`")
    order = F.struct(doc_id.isNull(), doc_id)
    kept = found.where("root is not null").groupBy("root").agg(F.min_by("doc", order).alias("doc"))
    alone = parted.where("not shared").select("doc").union(found.where("root is null").select("doc"))
    return alone.union(kept.select("doc")).select("doc.*")
