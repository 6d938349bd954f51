"""One row per sample and variant: the collapse of annotation rows."""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from variantry.functions.schema import with_source_dataset
from variantry.functions.text import col, quoted
from variantry.names import COLLAPSE_KEYS, ROW_ORDER, SITE_KEYS, SOURCE_DATASET
from variantry.operators.gather import gather_distinct

# Texts left out when several values are joined.
UNJOINED = ("nan", "None")


def available_keys(df: DataFrame, keys: list[str] = COLLAPSE_KEYS) -> list[str]:
    """The key columns that exist, or else the genomic coordinates that do."""
    present = [key for key in keys if key in df.columns]
    for key in keys:
        if key not in present:
            warnings.warn(f"key column {key!r} not found", stacklevel=2)
    return present or [key for key in SITE_KEYS if key in df.columns]


def joined(name: str) -> Column:
    """An array column as a cell: null, the only value, or the values joined by `;`."""
    values = quoted(name)
    unjoined = ", ".join(f"'{text}'" for text in UNJOINED)
    several = f"filter({values}, value -> value not in ({unjoined}))"
    return F.expr(
        f"case when size({values}) <= 1 then get({values}, 0) when size({several}) > 0 then array_join({several}, ';') end"
    )


def collapse(
    df: DataFrame,
    keys: list[str] = COLLAPSE_KEYS,
    source: Column | str | None = None,
    order: str = "first",
    drop_null_keys: bool = True,
) -> DataFrame:
    """Group by the keys and reduce every other column to its distinct values.

    A cell is null, the single value as text, or several joined by `;`. Column order
    stays; the name of the source dataset, if given, comes last. A table without key
    columns, or with nothing but keys, passes through. A `source` column must be one
    of the keys or constant within them.
    """
    keys = available_keys(df, keys)
    columns = [name for name in df.columns if name not in keys and name != ROW_ORDER]
    if not keys or not columns:
        result = df.drop(ROW_ORDER)
    else:
        rows = df.dropna(subset=[f"`{key}`" for key in keys]) if drop_null_keys else df
        cells = gather_distinct(rows, keys, columns, order=order)
        result = cells.select(
            *[
                col(name) if name in keys else joined(name).alias(name)
                for name in df.columns
                if name != ROW_ORDER
            ]
        )
    if source is None or SOURCE_DATASET in result.columns:
        return result
    return with_source_dataset(result, source)
