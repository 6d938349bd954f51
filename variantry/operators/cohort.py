"""One row per variant over many datasets."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from variantry.functions.schema import common_type
from variantry.functions.text import col, quoted, text_of, text_sql
from variantry.names import COHORT_ANNOTATIONS, DATASET_INDEX, ROW_COUNT, ROW_ORDER, SAMPLE_AF, SITE_KEYS
from variantry.operators.gather import GROUP_ROWS, gather_distinct, with_row_order

INTERNAL = (DATASET_INDEX, ROW_ORDER)
FAMILY = "_family"
#: Variants with at least this share of all rows are known to be fewer than its inverse.
HOT_SHARE = 1 / (1 << 16)


def row_counts(df: DataFrame, keys: list[str] = SITE_KEYS) -> DataFrame:
    """The keys and how many rows each has."""
    # Spelled as the tests that joins add by themselves, so that one count serves several joins.
    given = [col(key).isNotNull() for key in keys]
    given += [~F.isnan(col(key)) for key in keys if isinstance(df.schema[key].dataType, T.FractionalType) and not isinstance(df.schema[key].dataType, T.DecimalType)]
    named = df.select(*[col(key) for key in keys]).where(reduce(and_, given))
    return named.groupBy(*[col(key) for key in keys]).agg(F.count(F.lit(1)).alias(ROW_COUNT))


def below_cutoff(df: DataFrame, cutoff: int, keys: list[str] = SITE_KEYS) -> DataFrame:
    """The rows of variants with fewer than `cutoff` rows; counting reads the keys only.

    Variants that hold HOT_SHARE of all rows are left out by a broadcast of at most 65,536 keys, before any of their rows
    moves. The rows of the others meet the keys that stay in a shuffle, which no variant can fill.
    """
    counts = row_counts(df, keys)
    share = counts.agg(F.sum(ROW_COUNT) * F.lit(HOT_SHARE)).scalar()
    hot = counts.where((F.col(ROW_COUNT) >= cutoff) & (F.col(ROW_COUNT) >= share)).drop(ROW_COUNT)
    rare = counts.where(F.col(ROW_COUNT) < cutoff).drop(ROW_COUNT)
    left = df.join(F.broadcast(hot), keys, "left_anti").join(rare, keys, "left_semi")
    return left.select(*[col(name) for name in df.columns])


def check_cutoff(cutoff: int | None, n_datasets: int) -> None:
    """A cutoff must be at least 2 and at most the number of datasets."""
    if cutoff is not None and not 2 <= cutoff <= n_datasets:
        raise ValueError(f"row count cutoff {cutoff} must be between 2 and the {n_datasets} datasets")


def default_columns(df: DataFrame) -> list[str]:
    """Columns gathered by default, in output order, without keys and sample frequency."""
    names = [name for name in COHORT_ANNOTATIONS if name in df.columns]
    names += [name for name in df.columns if name.startswith("INFO[")]
    names += [name for name in df.columns if name.startswith("AF_")]
    names += [name for name in ("family", "SAMPLE") if name in df.columns]
    return list(dict.fromkeys(names))


def first_value(name: str, order: list[str]) -> Column:
    """The first non-null value in the given order."""
    # A single number keeps the aggregation buffer flat, which a struct would not.
    rank = col(order[0]) if len(order) == 1 else F.struct(*[col(part) for part in order])
    return F.min_by(col(name), F.when(col(name).isNotNull(), rank))


def family_frequencies(
    df: DataFrame, families: list[str], keys: list[str] = SITE_KEYS, value: str = SAMPLE_AF, by: str = "family",
    prefix: str = "AF_", order: list[str] | None = None,
) -> DataFrame:
    """One column per family with the first value it has for the variant.

    Values are reduced per (variant, family) before the shuffle, so the pivot sees at
    most one value per family, whatever the number of rows of a variant.
    """
    order = order or [ROW_ORDER]
    named = (df if order != [ROW_ORDER] else with_row_order(df)).dropna(subset=[f"`{key}`" for key in keys])
    firsts = named.groupBy(*[col(key) for key in keys], col(by).alias("_by")).agg(first_value(value, order).alias("_value"))
    wide = firsts.groupBy(*[col(key) for key in keys]).pivot("_by", families).agg(F.first("_value", ignorenulls=True))
    return wide.select(*[col(key) for key in keys], *[col(name).alias(f"{prefix}{name}") for name in families])


def frequency_conflicts(df: DataFrame, keys: list[str] = SITE_KEYS, value: str = SAMPLE_AF, by: str = "family") -> DataFrame:
    """Variants for which one family has several different values."""
    named = df.select(*[col(key) for key in keys], col(by).alias("family"), col(value).alias("_value")).dropna()
    return (
        named.distinct()
        .groupBy(*[col(key) for key in keys], "family")
        .agg(F.count(F.lit(1)).alias("n_values"))
        .where("n_values > 1")
    )


def with_family_columns(df: DataFrame, families: list[str]) -> DataFrame:
    """Add a null frequency column for every family that has none."""
    missing = {f"AF_{family}": F.lit(None).cast("double") for family in sorted(families) if f"AF_{family}" not in df.columns}
    return df.withColumns(missing) if missing else df


PAIRS = "_pairs"
#: Up to so many families have an aggregate each; more would make every row of a shuffle wide.
WIDE = 64


def _first_of(family: str) -> Column:
    """The first frequency of one family among the pairs of a variant."""
    return F.get(F.filter(F.col(PAIRS), lambda pair: pair["family"] == family), F.lit(0))["value"]


def _gather_in_families(
    rows: DataFrame, keys: list[str], listed: list[str], firsts: list[str], families: list[str] | None, rank: list[str],
) -> DataFrame:
    """Sorted lists, first values and frequencies of each variant from one pass over the rows and, up to WIDE families, one shuffle.

    Rows are reduced per variant before it, so that a task sends distinct values and one frequency per family. For more families
    rows are reduced per (variant, family) first; what a variant then brings together is at most one row per family.
    """
    slots = {f"c{i}": name for i, name in enumerate(listed)}
    order = F.struct(*[col(name) for name in rank])

    def first(name: str, where: Column | None = None) -> Column:
        given = col(name).isNotNull() if where is None else where & col(name).isNotNull()
        return F.min(F.when(given, F.struct(order.alias("rank"), col(name).alias("value"))))

    sets = [F.expr(f"collect_set({text_sql(quoted(name), rows.schema[name].dataType)})").alias(slot) for slot, name in slots.items()]
    heads = {f"v{i}": name for i, name in enumerate(firsts)}
    measures = [*sets, *[first(name).alias(slot) for slot, name in heads.items()]]
    count = F.count(F.lit(1)).alias(GROUP_ROWS)
    keyed = [col(key) for key in keys]
    if len(families or []) <= WIDE:
        own = {f"f{i}": name for i, name in enumerate(families or [])}
        by_family = [first(SAMPLE_AF, col("family").cast("string") == name).alias(slot) for slot, name in own.items()]
        groups = rows.groupBy(*keyed).agg(*measures, *by_family, count).withColumns({slot: F.array_sort(slot) for slot in slots})
        frequencies = [F.col(f"{slot}.value").alias(f"AF_{name}") for slot, name in own.items()]
    else:
        parts = rows.groupBy(*keyed, col("family").cast("string").alias(FAMILY)).agg(*measures, first(SAMPLE_AF).alias("frequency"), count)
        merged = [F.array_sort(F.array_distinct(F.flatten(F.collect_list(slot)))).alias(slot) for slot in slots]
        merged += [F.min(slot).alias(slot) for slot in heads]
        given = F.col(FAMILY).isNotNull() & F.col("frequency").isNotNull()
        pair = F.struct(F.col(FAMILY).alias("family"), F.col("frequency.value").alias("value"))
        merged.append(F.collect_list(F.when(given, pair)).alias(PAIRS))
        groups = parts.groupBy(*keyed).agg(*merged, F.sum(GROUP_ROWS).alias(GROUP_ROWS))
        frequencies = [_first_of(family).alias(f"AF_{family}") for family in families]
    return groups.select(
        *keyed, *[F.col(slot).alias(name) for slot, name in slots.items()],
        *[F.col(f"{slot}.value").alias(name) for slot, name in heads.items()], *frequencies, F.col(GROUP_ROWS),
    )


def cohort(
    df: DataFrame,
    columns: str = "default",
    row_count_only: bool = False,
    cutoff: int | None = None,
    families: list[str] | None = None,
    keys: list[str] = SITE_KEYS,
    order: str = "first",
    unique: bool = False,
    rank: list[str] | None = None,
) -> DataFrame:
    """Combine the rows of many datasets into one row per variant.

    Every gathered column becomes the array of its distinct texts; existing `AF_`
    columns keep their first value; the sample frequency becomes `AF_<family>` for
    each of `families`. `ROW_COUNT` is the number of rows combined. `columns` is
    "default" or "all". `unique` states that no dataset has a variant twice, which
    bounds the rows of a variant by the number of datasets. `rank` names the columns
    that decide which frequency is first, in place of the order of datasets and rows.
    """
    if row_count_only:
        counts = row_counts(df, keys)
        return counts if cutoff is None else counts.where(F.col(ROW_COUNT) < cutoff)
    if columns not in ("default", "all"):
        raise ValueError(f"columns must be 'default' or 'all', not {columns!r}")
    if order == "first":
        df = with_row_order(df)
    rows = df.dropna(subset=[f"`{key}`" for key in keys])
    # Counts come first, so that only rows of variants that stay are gathered.
    rows = rows if cutoff is None else below_cutoff(rows, cutoff, keys)
    has_frequency = SAMPLE_AF in df.columns and bool(families)
    if columns == "default":
        chosen = default_columns(df)
    else:
        chosen = [name for name in df.columns if name not in keys and name not in INTERNAL]
    listed = [name for name in chosen if name != SAMPLE_AF and not name.startswith("AF_")]
    firsts = [name for name in chosen if name.startswith("AF_")]

    if rank is None:
        rank = [DATASET_INDEX] if unique and DATASET_INDEX in df.columns else [name for name in INTERNAL if name in df.columns]
    if not rank:
        rows, rank = with_row_order(rows), [ROW_ORDER]
    pairs = families if has_frequency else None
    if order == "sorted":
        result = _gather_in_families(rows, keys, listed, firsts, pairs, rank)
    else:
        # First values and frequencies are gathered like the lists, in the same steps.
        kept = {name: quoted(name) for name in firsts}
        if has_frequency:
            given = f"family is not null and {quoted(SAMPLE_AF)} is not null"
            kept[PAIRS] = f"if({given}, struct(cast(family as string) as family, {quoted(SAMPLE_AF)} as value), null)"
        result = gather_distinct(rows, keys, listed, order=order, unique=unique, values=kept)
        result = result.withColumns({name: F.get(col(name), F.lit(0)) for name in firsts}) if firsts else result
        if has_frequency:
            result = result.withColumns({f"AF_{name}": _first_of(name) for name in families}).drop(PAIRS)

    output: list[str] = []
    frequencies = [f"AF_{family}" for family in families] if has_frequency else []
    for name in chosen:
        if name == SAMPLE_AF:
            output += frequencies
        elif columns == "default" and name == "family":
            output += [*frequencies, name]
        else:
            output.append(name)
    output += [name for name in frequencies if name not in output]
    output = list(dict.fromkeys(output))
    return result.select(
        *[col(key) for key in keys], *[col(name) for name in output], F.col(GROUP_ROWS).alias(ROW_COUNT)
    )


def union_aligned(frames: list[DataFrame]) -> DataFrame:
    """Union by name; missing columns are null, differing types are widened."""
    kinds: dict[str, list[T.DataType]] = {}
    for frame in frames:
        for field in frame.schema:
            kinds.setdefault(field.name, []).append(field.dataType)
    target = {name: common_type(types) for name, types in kinds.items()}

    def cell(field: T.StructField) -> Column:
        # A number or truth value becomes the text it has in an export, wherever it was stored.
        as_text = isinstance(target[field.name], T.StringType)
        value = text_of(field.name, field.dataType) if as_text else col(field.name).cast(target[field.name])
        return value.alias(field.name)

    aligned = [frame.select(*[cell(field) for field in frame.schema]) for frame in frames]
    result = aligned[0]
    for frame in aligned[1:]:
        result = result.unionByName(frame, allowMissingColumns=True)
    return result
