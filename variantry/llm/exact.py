"""Exact duplicates: groups of equal 128-bit content hash whose bytes are compared.

Texts are equal when they are identical without ASCII white space. Only hashes, ids and lengths of all rows
are shuffled. A fixed-size bitmap of the hashes that occur more than once then picks the rows whose texts must be
compared; these texts are grouped by hash and by their bytes, which combines copies before the shuffle, so a group
that holds a third of all rows adds one row per task. Should one hash stand for several texts, they become groups
of their own: a group is a hash with the SHA-256 of the text, and the query fails if even these cannot tell texts apart.

Null texts count as empty. Of a group stays the row with most code points, then the smallest id (null last);
rows that repeat all of this are numbered, so exactly one stays.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from variantry.llm.bitmap import WORDS, bitmap, marked
from variantry.llm.store import stored
from variantry.llm.words import text_of, without_spaces


def content_hash(text: Column) -> Column:
    """128 bits as 32 hexadecimal digits."""
    return F.md5(text)


def _repeated(hashes: DataFrame, words: int) -> DataFrame:
    """The bitmap of the hashes that more than one row has."""
    often = hashes.groupBy("hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return bitmap(often.select(F.xxhash64("hash").alias("key")), words)


def _compared(texts: DataFrame) -> DataFrame:
    """Groups (hash, sha) of `texts` (hash, norm), formed by bytes; fails if one stands for two texts."""
    by_bytes = texts.groupBy("hash", "norm").agg(F.lit(1).alias("one"))
    groups = by_bytes.groupBy("hash", F.sha2("norm", 256).alias("sha")).agg(F.count(F.lit(1)).alias("texts"))
    checked = F.when(F.col("texts") == 1, F.col("sha")).otherwise(F.raise_error(F.lit("two texts with equal hashes")))
    return groups.select("hash", checked.alias("sha"))


def duplicate_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    hashed: Callable[[Column], Column] = content_hash, words: int = WORDS,
) -> DataFrame:
    """One row per row of `docs`: its id, keep_id, group_size, kept and text_sha256."""
    texts = docs.select(F.col(id_col).alias("id"), text_of(F.col(text_col)).alias("text"))
    texts = texts.select("id", F.length("text").alias("n_chars"), without_spaces(F.col("text")).alias("norm"))
    texts = texts.withColumn("hash", hashed(F.col("norm")))
    rows = stored(
        texts.select("id", "n_chars", "hash", F.sha2("norm", 256).alias("sha"), F.monotonically_increasing_id().alias("row")),
        "rows",
    )
    to_compare = texts.select("hash", "norm", F.xxhash64("hash").alias("key"))
    to_compare = marked(to_compare, "key", _repeated(rows, words), "repeated", words).where("repeated")
    compared = _compared(to_compare.select("hash", "norm"))
    best = F.struct((-F.col("n_chars")).alias("size"), F.col("id").isNull().alias("unnamed"), "id", "row")
    keepers = rows.groupBy("hash", "sha").agg(F.min(best).alias("keep"), F.count(F.lit(1)).alias("n"))
    keepers = keepers.where("n > 1").join(compared, ["hash", "sha"], "left_semi")
    keepers = stored(keepers.select("hash", "sha", "n", F.col("keep.id").alias("keep_id"), F.col("keep.row").alias("keep_row")), "keepers")
    joined = rows.join(keepers, ["hash", "sha"], "left")
    alone = F.col("n").isNull()
    return joined.select(
        F.col("id").alias(id_col), F.when(alone, F.col("id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"), (alone | (F.col("row") == F.col("keep_row"))).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def drop_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    hashed: Callable[[Column], Column] = content_hash, words: int = WORDS,
) -> DataFrame:
    """The rows of `docs` that stay, with all their columns.

    Rows whose hash is not repeated stay where they are. The others are grouped by hash and bytes, and the best
    row of each group is taken; only these texts are shuffled, once per task and group.
    """
    names = docs.columns
    whole = docs.select(F.struct(*[F.col(f"`{name}`") for name in names]).alias("doc"))
    norm = without_spaces(F.col(f"doc.`{text_col}`"))
    keyed = whole.select("doc", hashed(norm).alias("hash"), F.xxhash64(hashed(norm)).alias("key"))
    hashes = stored(keyed.select("hash"), "hashes")
    parted = marked(keyed, "key", _repeated(hashes, words), "repeated", words)
    single = parted.where("not repeated").select("doc")
    size, doc_id = F.length(text_of(F.col(f"doc.`{text_col}`"))), F.col(f"doc.`{id_col}`")
    order = F.struct(-size, doc_id.isNull(), doc_id)
    groups = parted.where("repeated").groupBy("hash", norm.alias("norm")).agg(F.min_by("doc", order).alias("doc"))
    return single.union(groups.select("doc")).select("doc.*")
