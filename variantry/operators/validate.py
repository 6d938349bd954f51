"""Key uniqueness: checks, previews and quarantine."""

from __future__ import annotations

import warnings

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from variantry.functions.text import col
from variantry.names import DATASET_INDEX, ROW_ORDER, SITE_KEYS, UNIQUE_KEYS

N_ROWS = "n_rows"
PREVIEW = 10


class ValidationError(ValueError):
    """The data break a rule that later steps rely on."""


def uniqueness_keys(df: DataFrame, group_keys: list[str] = ()) -> list[str]:
    """The available key columns, or none if the genomic coordinates are incomplete.

    Rows of several files are unique per file, so `filename` counts if it is a group key.
    """
    present = [key for key in UNIQUE_KEYS if key in df.columns]
    if len(present) >= 4:
        return [*present, *[key for key in group_keys if key == "filename"]]
    warnings.warn(f"too few key columns to check uniqueness: {present}", stacklevel=2)
    return []


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """The keys held by more than one row, with their row counts; null keys do not count."""
    named = df.select(*[col(key) for key in keys]).dropna()
    return named.groupBy(*[col(key) for key in keys]).agg(F.count(F.lit(1)).alias(N_ROWS)).where(F.col(N_ROWS) > 1)


def group_rows(source: DataFrame, group_keys: list[str]) -> DataFrame:
    """The keys of the rows a collapse of `source` will have."""
    return source.select(*[col(key) for key in group_keys]).dropna().distinct()


def preview(duplicates: DataFrame, limit: int = PREVIEW) -> DataFrame:
    """The first few duplicate keys in key order."""
    keys = [name for name in duplicates.columns if name != N_ROWS]
    return duplicates.orderBy(*[col(key) for key in keys]).limit(limit)


def require_unique(df: DataFrame, keys: list[str]) -> None:
    """Raise if a key is held by several rows, listing the first ones and the totals."""
    counts = df.select(*[col(key) for key in keys]).dropna().groupBy(*[col(key) for key in keys]).count()
    total = counts.agg(
        F.count(F.lit(1)).alias("keys"),
        F.coalesce(F.sum("count"), F.lit(0)).alias("rows"),
        F.count_if(F.col("count") > 1).alias("duplicates"),
    ).first()
    if not total["duplicates"]:
        return
    shown = preview(duplicate_keys(df, keys)).collect()
    lines = [
        "  - " + " ".join(f"{key}={row[key]}" for key in keys) + f" ({row[N_ROWS]} rows)" for row in shown
    ]
    if total["duplicates"] > len(shown):
        lines.append(f"  ... and {total['duplicates'] - len(shown)} more")
    raise ValidationError(
        f"{total['duplicates']} keys have several rows: expected {total['keys']} rows, found {total['rows']}\n"
        + "\n".join(lines)
    )


def rows_of(df: DataFrame, duplicates: DataFrame, keys: list[str]) -> DataFrame:
    """The rows whose key is among the duplicates."""
    return df.join(duplicates.select(*[col(key) for key in keys]), keys, "left_semi").select(
        *[col(name) for name in df.columns]
    )


def rows_without(df: DataFrame, duplicates: DataFrame, keys: list[str]) -> DataFrame:
    """The rows whose key is not among the duplicates."""
    return df.join(duplicates.select(*[col(key) for key in keys]), keys, "left_anti").select(
        *[col(name) for name in df.columns]
    )


def quarantine(collapsed: DataFrame, source: DataFrame, group_keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """Split off all rows of duplicated keys: `(clean collapsed rows, distinct source rows)`."""
    keys = uniqueness_keys(collapsed, group_keys)
    plain = source.drop(ROW_ORDER)
    if not keys:
        return collapsed, plain.limit(0)
    duplicates = duplicate_keys(group_rows(source, group_keys), keys)
    return rows_without(collapsed, duplicates, keys), rows_of(plain, duplicates, keys).distinct()


def dataset_duplicates(df: DataFrame, keys: list[str] = SITE_KEYS) -> DataFrame:
    """Keys held by several rows of one dataset, for all datasets in one pass."""
    return duplicate_keys(df, [DATASET_INDEX, *keys])


def dataset_families(df: DataFrame, family: str = "family") -> DataFrame:
    """Per dataset its smallest and largest family name: equal if there is just one."""
    return df.groupBy(DATASET_INDEX).agg(
        F.min(col(family)).alias("family"), F.max(col(family)).alias("last_family")
    )


def require_dataset_uniqueness(df: DataFrame, names: list[str], keys: list[str] = SITE_KEYS) -> None:
    """Raise if a variant has several rows in one dataset, with a preview per dataset."""
    present = [key for key in keys if key in df.columns]
    if len(present) < len(keys):
        warnings.warn(f"uniqueness not checked, key columns present: {present}", stacklevel=2)
        return
    duplicates = dataset_duplicates(df, keys)
    counts = {row[DATASET_INDEX]: row["count"] for row in duplicates.groupBy(DATASET_INDEX).count().collect()}
    if not counts:
        return
    first = min(counts)
    shown = preview(duplicates.where(F.col(DATASET_INDEX) == first)).collect()
    lines = ["  - " + " ".join(f"{key}={row[key]}" for key in keys) + f" ({row[N_ROWS]} rows)" for row in shown]
    totals = ", ".join(f"{names[index]}: {count}" for index, count in sorted(counts.items()))
    raise ValidationError(f"variants with several rows in one dataset ({totals})\n" + "\n".join(lines))


def require_families(df: DataFrame, names: list[str]) -> list[str]:
    """Each dataset has exactly one family and no two share one; return them by dataset.

    A dataset without any rows left has no family and is skipped.
    """
    rows = dataset_families(df).orderBy(DATASET_INDEX).collect()
    seen: dict[str, str] = {}
    for row in rows:
        name = names[row[DATASET_INDEX]]
        if row["family"] is None or row["family"] != row["last_family"]:
            raise ValidationError(f"{name} must have exactly one family")
        if row["family"] in seen:
            raise ValidationError(f"family {row['family']!r} is in both {seen[row['family']]} and {name}")
        seen[row["family"]] = name
    return list(seen)
