"""Gene, rsID and region lists, and the two dictionaries of column names."""

from __future__ import annotations

import csv
import io

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from variantry.config import ConfigError
from variantry.functions.text import WHITESPACE, col
from variantry.names import ROW_ORDER
from variantry.operators.membership import chromosome
from variantry.sources.files import whole_text
from variantry.sources.tables import read_delimited

# Accepted headers, compared in lower case.
SYMBOL_HEADERS = ("symbol", "gene symbol", "gene_symbol")
RSID_HEADERS = ("rsid", "rs_id", "rs id", "rsid_paper")


def _distinct(table: DataFrame, name: str, alias: str) -> DataFrame:
    return table.select(col(name).alias(alias)).dropna().distinct()


def read_genes(spark: SparkSession, path: str) -> DataFrame:
    """The distinct entries of the column `Gene Symbol` of a TSV file."""
    table = read_delimited(spark, path)
    if "Gene Symbol" not in table.columns:
        raise ConfigError(f"{path} has no column 'Gene Symbol' but {table.drop(ROW_ORDER).columns}")
    return _distinct(table, "Gene Symbol", "symbol")


def rsids_of(table: DataFrame, name: str) -> DataFrame:
    """The distinct trimmed entries that start with `rs`."""
    trimmed = table.select(F.trim(col(name), F.lit(WHITESPACE)).alias("rsid"))
    return trimmed.where(F.col("rsid").startswith("rs")).distinct()


def read_genes_and_rsids(spark: SparkSession, path: str) -> tuple[DataFrame | None, DataFrame | None]:
    """Symbols and rsIDs of a CSV or TSV file, each None if its column is absent."""
    table = read_delimited(spark, path, separator="," if path.lower().endswith(".csv") else "\t")
    names = [name for name in table.columns if name != ROW_ORDER]

    def header(accepted: tuple[str, ...]) -> str | None:
        return next((name for name in names if name.lower() in accepted), None)

    symbol, rsid = header(SYMBOL_HEADERS), header(RSID_HEADERS)
    genes = None if symbol is None else _distinct(table, symbol, "symbol")
    rsids = None if rsid is None else rsids_of(table, rsid)
    if (genes is None or genes.isEmpty()) and (rsids is None or rsids.isEmpty()):
        raise ConfigError(f"{path} has neither gene symbols nor rsIDs, columns: {names}")
    return genes, rsids


def read_regions(spark: SparkSession, path: str) -> DataFrame:
    """The first three columns of a headerless BED file as `chrom, start, end`."""
    table = spark.read.csv(path, sep="\t", header=False)
    if len(table.columns) < 3:
        raise ConfigError(f"{path} needs at least the columns chromosome, start and end")
    regions = table.select(
        chromosome(F.col("_c0")).alias("chrom"),
        F.col("_c1").try_cast("bigint").alias("start"),
        F.col("_c2").try_cast("bigint").alias("end"),
    )
    bad = regions.where("start is null or end is null").count()
    if bad:
        raise ConfigError(f"{path} has {bad} lines without whole-number coordinates")
    return regions


def read_dtypes(path: str) -> dict[str, str]:
    """`{column: dtype}` from a small CSV file with the columns column_name and dtype."""
    lines = csv.DictReader(io.StringIO(whole_text(path)))
    rows = [((row.get("column_name") or "").strip(), (row.get("dtype") or "").strip()) for row in lines]
    return {name: dtype for name, dtype in rows if name and dtype}


def read_renames(path: str) -> dict[str, str]:
    """`{old: new}` from the rows of a small CSV file that have exactly two fields."""
    return {row[0]: row[1] for row in csv.reader(io.StringIO(whole_text(path))) if len(row) == 2}
