"""Distinct values per group, in order of first appearance, without hot tasks.

A group may hold any share of the rows, so its rows are never brought together in
one step. Rows are first combined within blocks of consecutive rows, blocks then
within ranges of blocks, ranges at last into the group. A range is an input partition: the
rows of a group in one range are sent to one task, which combines its blocks and then
the range. What travels after that are distinct values only, so a step of a group stays
small however many rows it has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from variantry.functions.text import col, quoted, text_of, text_sql
from variantry.names import DATASET_INDEX, ROW_ORDER

GROUP_ROWS = "_group_rows"

# ROW_ORDER comes from monotonically_increasing_id: 33 bits number the rows of an
# input partition, the bits above number the partitions.
BLOCK_BITS = 14  # rows in a block: at most 16,384
RANGE_BITS = 19  # blocks in a range: those of an input partition
DATASET_BITS = 10  # datasets in a range: 1,024

_BLOCK = "_block"
_RANGE = "_range"
_DATASETS = "_datasets"
_ROWS = "_rows"


def with_row_order(df: DataFrame) -> DataFrame:
    """Number the rows as they are read, unless they carry their order already.

    Within a file the numbers follow the file. Apply before any shuffle: rows computed
    again after the loss of an executor must get the same numbers.
    """
    return df if ROW_ORDER in df.columns else df.withColumn(ROW_ORDER, F.monotonically_increasing_id())


def _block() -> Column:
    return F.shiftright(F.col(ROW_ORDER), BLOCK_BITS)


def _row_steps() -> list[dict[str, Column]]:
    same = {_RANGE: F.col(_RANGE)}
    return [{**same, _BLOCK: _block()}, same, {}]


def _dataset_steps(unique: bool) -> list[dict[str, Column]]:
    if unique:
        return [{_DATASETS: F.shiftright(F.col(DATASET_INDEX), DATASET_BITS)}, {}]
    same = {_DATASETS: F.col(_DATASETS), _RANGE: F.col(_RANGE)}
    return [{**same, _BLOCK: _block()}, same, {_DATASETS: F.shiftright(F.col(_DATASETS), DATASET_BITS)}, {}]


def gather_distinct(
    df: DataFrame,
    keys: list[str],
    columns: list[str],
    order: str = "first",
    unique: bool = False,
    values: dict[str, str] | None = None,
) -> DataFrame:
    """One row per key: for each column the array of its distinct texts, and the row count.

    `order="first"` keeps values in order of first appearance, by dataset and then by
    row; `order="sorted"` sorts them, which lets Spark drop repeated values before the
    only shuffle. `unique=True` states that no dataset has a key twice, as after a
    uniqueness check; ranges of datasets are then combined first. `values` adds columns of
    distinct non-null values of SQL expressions as they are, in order of first appearance.
    """
    kinds = {name: df.schema[name].dataType for name in columns}
    if order == "sorted":
        return _gather_sorted(df, keys, kinds)
    if order != "first":
        raise ValueError(f"unknown order {order!r}")
    by_dataset = DATASET_INDEX in df.columns
    rank = [DATASET_INDEX, ROW_ORDER] if by_dataset else [ROW_ORDER]
    df = with_row_order(df)
    # Positions as names keep the structs free of quotes and dots.
    slots = {f"c{i}": name for i, name in enumerate(columns)}
    state = df.select(
        *[col(key) for key in keys],
        *[F.col(name) for name in rank],
        *[text_of(name, kinds[name]).alias(slot) for slot, name in slots.items()],
        *[F.expr(sql).alias(f"v{i}") for i, sql in enumerate((values or {}).values())],
        F.lit(1).cast("bigint").alias(GROUP_ROWS),
    )
    steps = _dataset_steps(unique) if by_dataset else _row_steps()
    if _RANGE in steps[0]:
        # Dealt by range, so that the first two steps need no shuffle of their own.
        state = state.withColumn(_RANGE, F.shiftright(_block(), RANGE_BITS))
        state = state.withColumn(_DATASETS, F.col(DATASET_INDEX)) if by_dataset else state
        state = state.repartition(*[col(key) for key in keys], *[F.col(name) for name in steps[1]])
    slots |= {f"v{i}": name for i, name in enumerate(values or {})}
    for depth, step in enumerate(steps):
        state = _combine(state, keys, list(slots), rank, step, depth > 0)
        rank = list(step)
    return state.select(
        *[col(key) for key in keys], *[F.col(slot).alias(name) for slot, name in slots.items()], F.col(GROUP_ROWS)
    )


def _combine(
    state: DataFrame,
    keys: list[str],
    slots: list[str],
    rank: list[str],
    step: dict[str, Column],
    nested: bool,
) -> DataFrame:
    """Merge the rows of each (key, step) in rank order, keeping first appearances."""
    grouped = state.withColumns({f"{name}_next": value for name, value in step.items()}) if step else state
    rows = F.expr(f"sort_array(collect_list(struct({', '.join(rank + slots)})))")
    grouped = grouped.groupBy(*[col(key) for key in keys], *[F.col(f"{name}_next").alias(name) for name in step]).agg(
        rows.alias(_ROWS), F.sum(GROUP_ROWS).alias(GROUP_ROWS)
    )

    def merged(slot: str) -> Column:
        values = f"{_ROWS}.{slot}"
        if not nested:
            return F.expr(f"array_distinct(array_compact({values}))")
        # Most groups lie in one block and have nothing to merge.
        return F.expr(f"if(size({_ROWS}) = 1, get({values}, 0), array_distinct(flatten({values})))")

    return grouped.select(
        *[col(key) for key in keys],
        *[F.col(name) for name in step],
        *[merged(slot).alias(slot) for slot in slots],
        F.col(GROUP_ROWS),
    )


def _gather_sorted(df: DataFrame, keys: list[str], kinds: dict[str, T.DataType]) -> DataFrame:
    """Sets are merged before the shuffle, so a group sends its distinct values only."""
    sets = [F.expr(f"sort_array(collect_set({text_sql(quoted(name), kind)}))").alias(name) for name, kind in kinds.items()]
    return df.groupBy(*[col(key) for key in keys]).agg(*sets, F.count(F.lit(1)).alias(GROUP_ROWS))
