"""Rows that name a listed gene or rsID, or lie in a listed region.

Each criterion adds one boolean column to the table, so that criteria can be combined
and counted. No criterion changes the number of rows.
"""

from __future__ import annotations

import operator
import warnings
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from variantry.functions.text import as_number, as_whole_number, col, tokens
from variantry.names import ROW_ORDER, SITE_KEYS, SYMBOL

IN_REGION = "_in_region"
IN_GENES = "_in_genes"
IN_RSIDS = "_in_rsids"

# Positions per bin. A bin can hold at most that many distinct interval starts.
BIN_BITS = 14

# VCF positions are 32-bit numbers; a region may be open beyond them.
LAST_POSITION = (1 << 31) - 1

# Rows whose cell cannot match are spread over this many keys of the join.
SPREAD = 4096

# Columns that tell rows of one cell apart.
TELLING = (*SITE_KEYS, "SAMPLE", ROW_ORDER)

Listing = DataFrame | Iterable[str]


def mark_listed(df: DataFrame, name: str, wanted: Listing, flag: str) -> DataFrame:
    """Add `flag`: whether any entry of the cell is in the list, exactly and case-sensitively.

    A list that the caller holds becomes part of the filter. A table is matched against the
    distinct cells, of which there are far fewer than rows, and the cells found are joined
    back. No row is ever duplicated, and hot cells shrink to one before the first shuffle.
    A second key comes from the cell; for cells that cannot match (null, empty or a dot) it
    comes from the columns that name a row's site, which spreads them.
    """
    cell = col(name).cast("string")
    if not isinstance(wanted, DataFrame):
        known = list(dict.fromkeys(value for value in wanted if value is not None))
        hit = F.exists(tokens(cell), lambda token: token.isin(*known)) if known else F.lit(False)
        return df.withColumn(flag, F.coalesce(hit, F.lit(False)))
    found = _found_cells(df, name, wanted, _part=_part_of(F.xxhash64(cell))).withColumn(flag, F.lit(True))
    # Both parts come from columns: a join leaves constants out of its keys, and then they spread nothing.
    placed = df.withColumn("_place", _part_of(F.when(_possible(cell), F.xxhash64(cell)).otherwise(_apart(df, name))))
    marked = placed.join(found, (cell == F.col("_cell")) & (F.col("_place") == F.col("_part")), "left")
    return marked.drop("_cell", "_part", "_place").withColumn(flag, F.coalesce(F.col(flag), F.lit(False)))


def _part_of(value: Column) -> Column:
    return F.pmod(value, F.lit(SPREAD)).cast("int")


def _possible(cell: Column) -> Column:
    return F.coalesce(~cell.isin("", "."), F.lit(False))


def _apart(df: DataFrame, name: str) -> Column:
    """A hash that differs between most rows."""
    telling = [other for other in TELLING if other in df.columns and other != name]
    return F.xxhash64(*[col(other) for other in telling or df.columns])


def _found_cells(df: DataFrame, name: str, wanted: DataFrame, **more: Column) -> DataFrame:
    """The distinct cells with an entry in the list, and `more` that follows from the cell."""
    listed = wanted.select(F.col(wanted.columns[0]).cast("string").alias("_wanted")).dropna()
    cells = df.select(col(name).cast("string").alias("_cell"), *[value.alias(key) for key, value in more.items()])
    cells = cells.where(_possible(F.col("_cell"))).distinct()
    entries = cells.select("_cell", *more, F.explode(tokens(F.col("_cell"))).alias("_wanted"))
    return entries.join(listed, "_wanted", "left_semi").select("_cell", *more).distinct()


def _keep_listed(df: DataFrame, name: str, wanted: DataFrame) -> DataFrame:
    """The rows with an entry in the list; rows whose cell cannot match are left out before the join."""
    cell = col(name).cast("string")
    keyed = df.where(_possible(cell)).withColumn("_key", cell)
    return keyed.join(_found_cells(df, name, wanted), F.col("_key") == F.col("_cell"), "left_semi").drop("_key")


def match_genes(df: DataFrame, genes: Listing | None, column: str = SYMBOL) -> DataFrame:
    """Keep the rows naming a listed gene; without a list or the column, keep all."""
    if genes is None:
        return df
    if column not in df.columns:
        warnings.warn(f"column {column!r} not found, genes are not filtered", stacklevel=2)
        return df
    if isinstance(genes, DataFrame):
        return _keep_listed(df, column, genes)
    return mark_listed(df, column, genes, IN_GENES).where(IN_GENES).drop(IN_GENES)


def match_rsids(df: DataFrame, rsids: Listing | None, column: str = "ID") -> DataFrame:
    """Keep the rows naming a listed rsID; without a list or the column, keep all."""
    return match_genes(df, rsids, column)


def chromosome(value: Column) -> Column:
    """A chromosome in lower case and without `chr`, as regions name it."""
    return F.replace(F.lower(value.cast("string")), F.lit("chr"), F.lit(""))


def position(df: DataFrame, name: str = "POS") -> Column:
    """The position as a whole number; null where the cell holds anything else."""
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        return as_number(df, name).try_cast("bigint")
    return as_whole_number(df, name)


def region_bins(regions: DataFrame) -> DataFrame:
    """Regions `(chrom, start, end)` cut along bins: `(_chrom, _bin, _spans)`, one row per bin.

    The spans of a bin cover exactly the positions its regions cover. Regions that
    reach beyond the bin they start in are first reduced to the farthest one per
    starting bin, and spans to the longest one per start, so overlapping regions do
    not multiply and no bin lists more spans than it has positions.
    """
    first = F.shiftright(F.col("start"), BIN_BITS)
    last = F.shiftright(F.col("end"), BIN_BITS)
    clipped = regions.select("chrom", "start", F.least(F.col("end"), F.lit(LAST_POSITION)).alias("end"))
    valid = clipped.where("start <= end").select("chrom", "start", "end", first.alias("_bin"), last.alias("_last"))

    def edge(bin_: Column) -> Column:
        return F.shiftleft(bin_ + 1, BIN_BITS) - 1

    heads = valid.select("chrom", "_bin", F.col("start").alias("_from"), F.least("end", edge(F.col("_bin"))).alias("_to"))
    reach = valid.where("_last > _bin").groupBy("chrom", "_bin").agg(F.max("end").alias("end"))
    tails = reach.select(
        "chrom", "end", F.explode(F.sequence(F.col("_bin") + 1, F.shiftright(F.col("end"), BIN_BITS))).alias("_bin")
    ).select(
        "chrom", "_bin", F.shiftleft(F.col("_bin"), BIN_BITS).alias("_from"), F.least("end", edge(F.col("_bin"))).alias("_to")
    )
    spans = heads.unionByName(tails).groupBy("chrom", "_bin", "_from").agg(F.max("_to").alias("_to"))
    return spans.groupBy(F.col("chrom").alias("_chrom"), "_bin").agg(
        F.collect_list(F.struct("_from", "_to")).alias("_spans")
    )


def mark_regions(df: DataFrame, regions: DataFrame, flag: str = IN_REGION) -> DataFrame:
    """Add `flag`: whether the position lies in a region, both ends included.

    The join is an equi-join on chromosome and bin; adaptive execution broadcasts the bins
    if they turn out to be small. Regions end at LAST_POSITION at the latest.
    """
    bins = region_bins(regions)
    pos = F.col("_pos")
    placed = df.withColumn("_pos", position(df))
    here = (chromosome(col("CHROM")) == F.col("_chrom")) & (F.shiftright(pos, BIN_BITS) == F.col("_bin"))
    inside = F.exists(F.col("_spans"), lambda span: pos.between(span["_from"], span["_to"]))
    marked = placed.join(bins, here, "left").withColumn(flag, F.coalesce(inside, F.lit(False)))
    return marked.drop("_pos", "_chrom", "_bin", "_spans")


#: The most chromosomes whose bounds become a filter of their own; beyond, the bounds of all regions together do.
MAX_BOUNDS = 256


def region_bounds(df: DataFrame, regions: DataFrame) -> Column:
    """A condition that all rows in a region meet and that reaches the scan: positions between the regions' ends.

    The first start and last end per chromosome are read from the regions, one row each. Over data in order of chromosome
    and position, files and row groups whose own smallest and largest positions lie apart from them are not read.
    """
    valid = regions.where("start <= end")
    ends = valid.groupBy("chrom").agg(F.min("start").alias("low"), F.max("end").alias("high")).limit(MAX_BOUNDS + 1).collect()
    if len(ends) > MAX_BOUNDS:
        ends = valid.agg(F.lit(None).alias("chrom"), F.min("start").alias("low"), F.max("end").alias("high")).collect()
    if not isinstance(df.schema["POS"].dataType, T.IntegralType):
        # Only numbers have bounds that a scan can use.
        wanted = [row["chrom"] for row in ends if row["chrom"] is not None]
        return chromosome(col("CHROM")).isin(wanted) if wanted else F.lit(bool(ends))
    # A scan only takes conditions that it understands as a whole, so positions stand alone once more.
    positions = [col("POS").between(max(row["low"], -LAST_POSITION), min(row["high"], LAST_POSITION)) for row in ends]
    named = [F.lit(True) if row["chrom"] is None else chromosome(col("CHROM")) == row["chrom"] for row in ends]
    if not ends:
        return F.lit(False)
    both = [here & there for here, there in zip(positions, named, strict=True)]
    return reduce(operator.or_, positions) & reduce(operator.or_, both)


def match_regions(df: DataFrame, regions: DataFrame) -> DataFrame:
    """Keep the rows that lie in a region."""
    near = df.where(region_bounds(df, regions))
    return mark_regions(near, regions).where(IN_REGION).drop(IN_REGION)


def _given(wanted: Listing) -> Column:
    """Whether a list has entries; for a table this is found while the plan runs."""
    if isinstance(wanted, DataFrame):
        return wanted.limit(1).agg(F.count(F.lit(1))).scalar() > 0
    return F.lit(any(value is not None for value in wanted))


def criteria(
    df: DataFrame, genes: Listing | None, rsids: Listing | None, regions: DataFrame | None
) -> tuple[DataFrame, dict[str, Listing]]:
    """The table with one flag per criterion that is given and whose column exists, and the list behind each flag."""
    flags: dict[str, Listing] = {}
    if regions is not None and {"CHROM", "POS"} <= set(df.columns):
        df = mark_regions(df, regions)
        flags[IN_REGION] = regions
    for name, wanted, flag in ((SYMBOL, genes, IN_GENES), ("ID", rsids, IN_RSIDS)):
        if wanted is not None and name in df.columns:
            wanted = wanted if isinstance(wanted, DataFrame) else list(wanted)
            df = mark_listed(df, name, wanted, flag)
            flags[flag] = wanted
    return df, flags


def mark_criteria(
    df: DataFrame,
    genes: Listing | None = None,
    rsids: Listing | None = None,
    regions: DataFrame | None = None,
) -> tuple[DataFrame, list[str]]:
    """Add one flag per applicable criterion; return the table and the flags added.

    A criterion that is not given, or whose column is missing, is left out.
    """
    marked, flags = criteria(df, genes, rsids, regions)
    return marked, list(flags)


def match_any(
    df: DataFrame,
    genes: Listing | None = None,
    rsids: Listing | None = None,
    regions: DataFrame | None = None,
) -> DataFrame:
    """Keep the rows that meet any criterion; if none applies or has entries, keep all."""
    return keep_any(*criteria(df, genes, rsids, regions))


def keep_any(marked: DataFrame, flags: dict[str, Listing]) -> DataFrame:
    """The rows that meet any criterion, of what `criteria` returns."""
    if not flags:
        return marked
    nothing = reduce(operator.and_, [~_given(wanted) for wanted in flags.values()])
    return marked.where(reduce(operator.or_, [F.col(flag) for flag in flags]) | nothing).drop(*flags)
