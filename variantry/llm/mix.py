"""Mixing sources to target weights by systematic sampling.

Every source gets a target number of words: its share of all words by weight, but at most `repeat` times its own
size, the excess going to the others by weight. A document's expected number of copies is its source's target over
its source's size. These are summed along the documents of a source, one random offset is added, and a document
is emitted once for every whole number that the sum crosses on it. Documents are summed in order of size, so
every range of sizes is sampled evenly and the words taken stay near the target.

The sum is formed in two steps, as a source may hold most of all rows: documents are numbered inside buckets of
(source, size class, slice of a hash), and the buckets' counts are summed per source. A source has at most
SIZE_CLASSES x SLICES buckets, whatever the data. Only built-in functions are used, and reruns agree: the
order depends on ids and texts alone.

Null texts have size 0 and no words to give; a null source is a source of its own. Rows may repeat.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from variantry.llm.words import text_of, word_count

WEIGHTS = (1, 2, 3)
REPEAT = 3
SEED = 20
#: Sizes share a class when they agree in their number of digits and the first two: 90 per power of ten.
SIZE_CLASSES = 90 * 18
SLICES = 256


def size_class(size: Column) -> Column:
    digits = size.cast("string")
    return (F.length(digits) * 100 + F.substring(digits, 1, 2).cast("int")).cast("int")


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, repeat: int = REPEAT) -> DataFrame:
    """Adds `target` to a table of one row per source (source, source_size).

    Sources in order of code points, null last, have the weights in turn. Sources are taken in order of the
    size they can give per weight; `level` is what a unit of weight gets if all before are used up. It rises
    as long as sources are used up and falls afterwards, so the largest one is the common level.
    """
    turn = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last()))
    listed = sizes.withColumn("turn", turn)
    listed = listed.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), F.pmod(F.col("turn") - 1, F.lit(len(weights))) + 1))
    everything = W.partitionBy()
    before = W.orderBy(F.col("source_size") / F.col("weight"), "turn").rowsBetween(W.unboundedPreceding, -1)
    used, passed = (F.coalesce(F.sum(name).over(before), F.lit(0)) for name in ("source_size", "weight"))
    words_left = F.sum("source_size").over(everything) - repeat * used
    weight_left = F.sum("weight").over(everything) - passed
    level = words_left.cast("double") / weight_left.cast("double")
    levelled = listed.withColumn("level", level).withColumn("level", F.max("level").over(everything))
    target = F.least((F.lit(repeat) * F.col("source_size")).cast("double"), F.col("weight") * F.col("level"))
    return levelled.withColumn("target", target).select("source", "source_size", "target")


def offset(source: Column, seed: int) -> Column:
    """A number from 0 to below 1 for each source."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(source, F.lit(""))))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(2.0**32)


def _key(source: str) -> Column:
    """A source as a join key that null can equal."""
    return F.coalesce(F.concat(F.lit("="), F.col(source)), F.lit(""))


def with_copies(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    weights: Sequence[int] = WEIGHTS, repeat: int = REPEAT, seed: int = SEED,
) -> DataFrame:
    """Every row of `docs` as a struct `doc`, with size, source_size, target and copies (0 to `repeat`)."""
    whole = docs.select(F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("doc"))
    text, doc_id = text_of(F.col(f"doc.`{text_col}`")), F.coalesce(F.col(f"doc.`{id_col}`").cast("string"), F.lit(""))
    sized = whole.select(
        "doc", F.col(f"doc.`{source_col}`").alias("source"), word_count(text).alias("size"),
        F.md5(F.concat(doc_id, F.lit(":"), text)).alias("digest"),
    )
    sized = sized.select(
        "doc", "source", "size", size_class(F.col("size")).alias("class"), F.substring("digest", 1, 2).alias("slice"), "digest",
        _key("source").alias("key"),
    )
    bucket = ["key", "class", "slice"]
    counts = sized.groupBy(*bucket, "source").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("words"))
    targets = source_targets(counts.groupBy("source").agg(F.sum("words").alias("source_size")), weights, repeat)
    targets = targets.withColumn("key", _key("source")).withColumnRenamed("source", "named")
    before = W.partitionBy("key").orderBy("class", "slice").rowsBetween(W.unboundedPreceding, -1)
    starts = counts.select(*bucket, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start")).join(targets, "key")
    numbered = sized.withColumn("place", F.row_number().over(W.partitionBy(*bucket).orderBy("size", "digest")))
    placed = numbered.join(starts, bucket)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    at = (F.col("start") + F.col("place")).cast("double")
    shift = offset(F.col("source"), seed)
    copies = (F.floor(at * rate + shift) - F.floor((at - 1) * rate + shift)).cast("long")
    return placed.select("doc", "size", "source_size", "target", copies.alias("copies"))


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mixture: rows of `docs`, some left out, some repeated."""
    taken = with_copies(docs, **options).where("copies > 0")
    return taken.select("doc", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("doc.*")


def mixed_sizes(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """One row per document: id, size, source_size, target and the words taken."""
    return with_copies(docs, id_col=id_col, **options).select(
        F.col(f"doc.`{id_col}`").alias(id_col), "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken")
    )
