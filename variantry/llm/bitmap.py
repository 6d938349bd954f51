"""A bitmap of hashed keys, of a size that does not depend on the data, to set rows aside before a shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: At most this many rows of two longs are broadcast, whatever the data (1 MB).
WORDS = 1 << 16


def bitmap(keys: DataFrame, words: int = WORDS) -> DataFrame:
    """The bitmap of `keys` (key: long): at most `words` rows (word, bits)."""
    return keys.selectExpr(
        f"pmod(shiftrightunsigned(key, 6), {words}L) as word", "shiftleft(1L, cast(key & 63 as int)) as bits"
    ).groupBy("word").agg(F.bit_or("bits").alias("bits"))


def marked(df: DataFrame, key: str, table: DataFrame, flag: str, words: int = WORDS) -> DataFrame:
    """`df` with a boolean column: false only if the bitmap lacks the key; no row of `df` moves."""
    probe = table.select(F.col("word").alias(f"{flag}_word"), F.col("bits").alias(f"{flag}_bits"))
    on = F.expr(f"pmod(shiftrightunsigned(`{key}`, 6), {words}L) = {flag}_word")
    hit = F.expr(f"coalesce({flag}_bits & shiftleft(1L, cast(`{key}` & 63 as int)), 0L) <> 0")
    return df.join(F.broadcast(probe), on, "left").withColumn(flag, hit).drop(f"{flag}_word", f"{flag}_bits")
