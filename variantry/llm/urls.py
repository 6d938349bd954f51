"""URL filters: a blocked Bloom filter passes possible hits to an exact hash join.

The list has two kinds of entries. A rule (host, path, verdict) fits its host and all subdomains when the url's path
starts with the rule's path; the longest fitting rule decides (then the longest host). A listed url blocks all urls
of the same canonical form that no rule fits. Anything else is allowed.

A url is looked up by a few keys: each end of its host with each start of its path that a rule may name, and its
canonical form. The filter holds the keys of all entries. Its number of blocks is a parameter and does not depend
on the data, so its broadcast is bounded: BLOCKS rows of five longs, 0.7 MB. Keys that pass meet the
entries in a hash join on the key, which removes false positives. Distinct urls are judged, then joined to the pages.
Only built-in functions are used.

A null url or one without `://` has an empty host and path, fits no entry and is allowed. Rows may repeat and ids may
be null. An entry listed twice counts once; of rules with equal host and path but different verdicts, block wins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from variantry.llm.store import stored

BLOCKS = 1 << 14
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Parameters that name how a page was reached, not the page.
TRACKING = r"^(utm_[^=]*|ref|fbclid|gclid)(=|$)"
RULE = "host string, path string, verdict string"
LONGS = range(4)


def host_of(url: Column) -> Column:
    """From the first :// up to / ? # or the end, A-Z in lower case; empty without ://."""
    return F.coalesce(F.translate(F.regexp_extract(url, "://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """From the host up to ? # or the end."""
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical_of(url: Column) -> Column:
    """Host and path with the parameters that matter; null without a host.

    The scheme, a leading www. or m., default ports, a closing slash or .html, the fragment and tracking parameters
    are left out; parameters are sorted.
    """
    host = F.regexp_replace(F.regexp_replace(host_of(url), r"^(www|m)\.", ""), ":(80|443)$", "")
    path = F.regexp_replace(path_of(url), r"(/+|\.html)$", "")
    query = F.coalesce(F.regexp_extract(url, r"://[^?#]*\?([^#]*)", 1), F.lit(""))
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda part: (part != "") & ~part.rlike(TRACKING)))
    tail = F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(F.lit(""))
    return F.when(host != "", F.concat(host, path, tail))


def _anchor(path: Column) -> Column:
    """A path up to its last slash."""
    return F.regexp_extract(path, "^(?s)(.*/)?", 0)


def entries_of(rules: DataFrame, listed: DataFrame) -> DataFrame:
    """All entries under the keys they are looked up by."""
    by_rule = rules.select(
        F.concat(F.lit("r:"), "host", _anchor(F.col("path"))).alias("key"), F.col("path").alias("start"),
        F.concat("host", "path").alias("rule"), F.length("host").alias("host_length"), "verdict",
    )
    by_url = listed.select(canonical_of(F.col("url")).alias("canonical")).where("canonical is not null").select(
        F.concat(F.lit("u:"), "canonical").alias("key"), F.lit("").alias("start"), F.lit(None).cast("string").alias("rule"),
        F.lit(-1).alias("host_length"), F.lit("block").alias("verdict"),
    )
    return by_rule.union(by_url).groupBy("key", "start", "rule", "host_length").agg(F.max("verdict").alias("verdict"))


def _with_bits(df: DataFrame, blocks: int) -> DataFrame:
    """Adds the key's block and, for each of its four longs, a mask of two bits."""
    second = F.xxhash64("key", F.lit(1))
    masks = {
        f"mask{i}": F.expr(
            f"shiftleft(1L, cast(shiftrightunsigned(second, {12 * i}) & 63 as int))"
            f" | shiftleft(1L, cast(shiftrightunsigned(second, {12 * i + 6}) & 63 as int))"
        )
        for i in LONGS
    }
    return df.withColumn("block", F.pmod(F.xxhash64("key"), F.lit(blocks))).withColumn("second", second).withColumns(masks).drop("second")


def bloom_filter(keys: DataFrame, blocks: int = BLOCKS) -> DataFrame:
    """Blocks of four longs that hold all keys (key: string); at most `blocks` rows."""
    return _with_bits(keys, blocks).groupBy("block").agg(*[F.bit_or(f"mask{i}").alias(f"long{i}") for i in LONGS])


def possible_hits(keyed: DataFrame, bloom: DataFrame, blocks: int = BLOCKS) -> DataFrame:
    """The rows whose key may be in the filter."""
    found = _with_bits(keyed, blocks).join(F.broadcast(bloom), "block")
    return found.where(" and ".join(f"long{i} & mask{i} = mask{i}" for i in LONGS)).select(*keyed.columns)


def _keys(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """Every key of every url. Rules bound how long an end of the host and how deep a start of the path can matter."""
    labels = rules.agg(F.coalesce(F.max(F.size(F.split("host", r"\."))), F.lit(0))).scalar()
    depth = rules.agg(F.coalesce(F.max(F.length(F.regexp_replace("path", "[^/]", ""))), F.lit(0))).scalar()
    split = urls.withColumns({"labels": F.split("host", r"\."), "parts": F.split("path", "/"), "most": labels, "deepest": depth})
    ends = F.expr("transform(sequence(1, least(most, size(labels)) + 1), n -> array_join(slice(labels, -least(n, size(labels)), least(n, size(labels))), '.'))")
    starts = F.expr("transform(sequence(0, least(deepest, size(parts) - 1)), n -> if(n = 0, '', concat(array_join(slice(parts, 1, n), '/'), '/')))")
    ends, starts = F.array_distinct(ends), F.array_distinct(starts)
    hosts = split.select("url", "path", "canonical", ends.alias("ends"), starts.alias("starts"))
    pairs = F.expr("flatten(transform(ends, e -> transform(starts, s -> concat('r:', e, s))))")
    keys = F.array_append(pairs, F.concat(F.lit("u:"), "canonical"))
    return hosts.select("url", "path", F.explode(keys).alias("key"))


def decisions(urls: DataFrame, rules: DataFrame, listed: DataFrame, blocks: int = BLOCKS) -> DataFrame:
    """The rule (or null) and verdict of those distinct urls (url: string) that any entry fits."""
    distinct = urls.where("url is not null").select("url").distinct()
    parts = distinct.select("url", *[f(F.col("url")).alias(n) for f, n in ((host_of, "host"), (path_of, "path"), (canonical_of, "canonical"))])
    entries = entries_of(rules, listed)
    hits = possible_hits(_keys(parts.where("host <> ''"), rules), bloom_filter(entries.select("key"), blocks), blocks)
    exact = hits.join(entries.hint("shuffle_hash"), "key").where(F.col("path").startswith(F.col("start")))
    rank = F.struct(F.coalesce(F.length("rule"), F.lit(-1)).alias("length"), "host_length", "rule", "verdict")
    best = exact.groupBy("url").agg(F.max(rank).alias("best"))
    return best.select("url", "best.rule", "best.verdict")


def judge(
    pages: DataFrame, rules: DataFrame, listed: DataFrame, id_col: str = "page_id", url_col: str = "url", blocks: int = BLOCKS,
) -> DataFrame:
    """One row per page: its id, host, path, the rule that decides (or null) and the verdict, allow or block."""
    named = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"))
    made = stored(decisions(named, rules, listed, blocks), "decisions").withColumnRenamed("url", "judged")
    return named.join(made, F.col("url") == F.col("judged"), "left").select(
        F.col("id").alias(id_col), host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), "rule",
        F.coalesce("verdict", F.lit("allow")).alias("verdict"),
    )
