"""Typing, renaming, provenance and column choice."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from variantry.functions.text import as_number, as_truth, as_whole_number, col
from variantry.names import SOURCE_DATASET


def rename_columns(df: DataFrame, renames: dict[str, str]) -> DataFrame:
    """Rename the columns that are present; unknown names are ignored."""
    return df.withColumnsRenamed({old: new for old, new in renames.items() if old in df.columns})


def typed(df: DataFrame, name: str, dtype: str) -> Column:
    """One column under a declared type; missing or unreadable becomes 0, null or false."""
    if dtype == "int64":
        truncated = as_number(df, name).try_cast("bigint")
        return F.coalesce(as_whole_number(df, name), truncated, F.lit(0).cast("bigint"))
    if dtype == "float64":
        return as_number(df, name)
    if dtype in ("bool", "boolean"):
        return F.coalesce(as_truth(df, name), F.lit(False))
    return col(name)


def coerce_types(df: DataFrame, dtypes: dict[str, str]) -> DataFrame:
    """Apply a `{column: dtype}` table to the columns that are present."""
    return df.select(*[typed(df, name, dtypes.get(name, "string")).alias(name) for name in df.columns])


# Fixed columns that hold numbers whether or not a table declares them.
FIXED_TYPES = {"POS": as_whole_number, "QUAL": as_number}


def fixed_types(df: DataFrame, declared: dict[str, str]) -> DataFrame:
    """Type the fixed columns that `declared` leaves out; what is no number there becomes null."""
    return df.withColumns({name: kind(df, name) for name, kind in FIXED_TYPES.items() if name in df.columns and name not in declared})


def with_provenance(df: DataFrame, family: Column | str | None = None, filename: Column | str | None = None) -> DataFrame:
    """Put `family` and `filename` first.

    By default both come from the file each row was read from: the base name, and
    its part before the first dot. That needs `df` to be a plain file scan.
    """
    filename = F.col("_metadata.file_name") if filename is None else filename
    filename = F.lit(filename) if isinstance(filename, str) else filename
    family = F.split_part(filename, F.lit("."), F.lit(1)) if family is None else family
    family = F.lit(family) if isinstance(family, str) else family
    return df.select(family.alias("family"), filename.alias("filename"), *[col(name) for name in df.columns])


def with_source_dataset(df: DataFrame, source: Column | str) -> DataFrame:
    """Put the name of the source dataset last."""
    source = F.lit(source) if isinstance(source, str) else source
    return df.withColumn(SOURCE_DATASET, source)


def drop_columns(df: DataFrame, names: list[str]) -> DataFrame:
    """Drop the columns that are present, matched by exact name, keeping the order."""
    unwanted = set(names)
    kept = [name for name in df.columns if name not in unwanted]
    return df if len(kept) == len(df.columns) else df.select(*[col(name) for name in kept])


def priority_order(df: DataFrame, first: list[str]) -> DataFrame:
    """The given columns first, as far as present, then the others by name."""
    lead = [name for name in first if name in df.columns]
    rest = sorted(name for name in df.columns if name not in lead)
    return df.select(*[col(name) for name in lead + rest])


def resolve(df: DataFrame, name: str) -> str | None:
    """The column with this name, else the first that differs only in case."""
    if name in df.columns:
        return name
    return next((candidate for candidate in df.columns if candidate.lower() == name.lower()), None)


def common_type(types: list[T.DataType]) -> T.DataType:
    """The type several datasets agree on for one column: equal, a wider number, or text."""
    distinct = list(dict.fromkeys(types))
    if len(distinct) == 1:
        return distinct[0]
    known = [kind for kind in distinct if not isinstance(kind, T.NullType)]
    if len(known) == 1:
        return known[0]
    if all(isinstance(kind, T.IntegralType) for kind in known):
        return T.LongType()
    if all(isinstance(kind, (T.IntegralType, T.FractionalType)) for kind in known):
        return T.DoubleType()
    return T.StringType()
