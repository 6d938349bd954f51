"""A variant table over the driver's order tables, and its SQL twin.

Every line item is one annotation row: its part is the locus, its supplier gives the
sample and the family. Nullable columns and cells with several entries come from
columns that have suitable values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

FAMILIES = [f"F{i}" for i in range(25)]

# One expression per column that Spark and DuckDB read alike.
EXPRESSIONS = {
    "SAMPLE": "concat('S', l_suppkey % 4)",
    "CHROM": "concat('chr', l_partkey % 22 + 1)",
    "POS": "l_partkey",
    "REF": "l_returnflag",
    "ALT": "l_linestatus",
    "ID": "case when l_linenumber = 1 then '.' else concat('rs', l_partkey, ', rs', l_suppkey) end",
    "INFO['DP']": "cast(nullif(l_quantity, 10) as bigint)",
    "INFO['TEXT_AF']": "case l_linenumber when 1 then '.' when 2 then 'NA' when 3 then 'zz' when 4 then '' "
    "else cast(l_discount as {text}) end",
    "FORMAT['SAOBS']": "cast(nullif(l_linenumber, 7) as {text})",
    "FORMAT['AF']": "l_tax",
    "ANN['MAX_AF']": "nullif(l_discount, 0)",
    "ANN['IMPACT']": "case p_size % 4 when 0 then 'HIGH' when 1 then 'MODERATE' when 2 then 'LOW' else 'MODIFIER' end",
    "ANN['SYMBOL']": "concat(p_brand, ';', p_type)",
    "family": "concat('F', s_nationkey)",
    "_dataset_index": "s_nationkey",
    # A total order of the rows, standing in for their order in a file.
    "_row_order": "((l_orderkey * 8 + l_linenumber) * 1000000 + l_partkey) * 10000 + l_suppkey",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The variant table; parts and suppliers join by whatever strategy their size allows."""
    lines = table(spark, sf_dir, "lineitem")
    parts = table(spark, sf_dir, "part")
    suppliers = table(spark, sf_dir, "supplier")
    joined = lines.join(parts, lines.l_partkey == parts.p_partkey).join(
        suppliers, lines.l_suppkey == suppliers.s_suppkey
    )
    return joined.selectExpr(
        *[f"{sql.format(text='string')} as `{name}`" for name, sql in EXPRESSIONS.items()]
    )


VARIANTS_SQL = (
    "variants as (select "
    + ", ".join(f"{sql.format(text='varchar')} as \"{name}\"" for name, sql in EXPRESSIONS.items())
    + " from lineitem join part on l_partkey = p_partkey join supplier on l_suppkey = s_suppkey)"
)


def regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regions over the nations: every nation is an interval on one chromosome."""
    return table(spark, sf_dir, "nation").selectExpr(
        "cast(n_nationkey % 22 + 1 as string) as chrom",
        "cast(n_nationkey * 50 as bigint) as start",
        "cast(n_nationkey * 50 + 20 as bigint) as end",
    )


REGIONS_SQL = (
    "regions as (select concat('chr', n_nationkey % 22 + 1) as r_chrom, n_nationkey * 50 as r_start, "
    "n_nationkey * 50 + 20 as r_end from nation)"
)
