"""Writing datasets and exporting tables."""

from __future__ import annotations

import json
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from variantry.functions.schema import priority_order
from variantry.functions.text import col, quoted, text_of, text_sql
from variantry.names import ROW_ORDER, SOURCE_DATASET, SOURCE_DATASET_EXPORTED
from variantry.sources.tables import SIDECAR


def write_sidecar(spark: SparkSession, path: str, metadata: dict) -> None:
    text = json.dumps(metadata, indent=1, sort_keys=True, default=str)
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(
        f"{path.rstrip('/')}/{SIDECAR}"
    )


def write_dataset(
    df: DataFrame, path: str, metadata: dict | None = None, partition_by: list[str] | None = None, cluster_by: list[str] | None = None
) -> dict:
    """Write Parquet and, beside it, column order, shape and whatever else is given.

    With `cluster_by`, files hold ranges of these columns and are sorted inside, so that later reads skip files and row
    groups outside the values they want. The row count is read back from the file footers: a count taken while writing
    would be wrong after a lost executor.
    """
    spark = df.sparkSession
    order = [col(name) for name in cluster_by or [] if name in df.columns]
    laid_out = df.repartitionByRange(*order).sortWithinPartitions(*order) if order else df
    writer = laid_out.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    visible = [name for name in df.columns if name != ROW_ORDER]
    record = {
        "column_order": df.columns,
        "schema": df.schema.jsonValue(),
        "partition_by": partition_by or [],
        "cluster_by": [name for name in cluster_by or [] if name in df.columns],
        "final_shape": [spark.read.parquet(path).count(), len(visible)],
        **(metadata or {}),
    }
    write_sidecar(spark, path, record)
    return record


def value_types(written: DataFrame, types: dict[str, T.DataType]) -> dict[str, str]:
    """Which text columns hold only values of their former type, from one pass over a written table.

    A collapsed column stays text if any cell joins several values.
    """
    candidates = {
        name: kind
        for name, kind in types.items()
        if name in written.columns
        and isinstance(kind, (T.NumericType, T.BooleanType))
        and isinstance(written.schema[name].dataType, T.StringType)
    }
    if not candidates:
        return {}
    misfits = [
        # Joined cells are told by their separator, before a cast that would fail.
        F.count_if(col(name).contains(";") | (col(name).isNotNull() & col(name).try_cast(kind).isNull())).alias(str(i))
        for i, (name, kind) in enumerate(candidates.items())
    ]
    counts = written.agg(*misfits).first()
    return {name: kind.simpleString() for i, (name, kind) in enumerate(candidates.items()) if counts[i] == 0}


@contextmanager
def case_sensitive(spark: SparkSession) -> Iterator[None]:
    """Let `filename` and `FILENAME` stand side by side while a plan is built and run."""
    before = spark.conf.get("spark.sql.caseSensitive")
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        yield
    finally:
        spark.conf.set("spark.sql.caseSensitive", before)


def as_text(df: DataFrame, list_style: str = "joined") -> DataFrame:
    """All columns in the form they are exported in.

    Lists of several values are joined by `;`, or with `list_style="brackets"` written
    as `['a', 'b']`; a list of one value is written as the value.
    """
    def cell(field: T.StructField) -> Column:
        value, kind = quoted(field.name), field.dataType
        if list_style == "brackets" and isinstance(kind, T.ArrayType):
            listed = f"""concat("['", {text_sql(value, kind, "', '")}, "']")"""
            return F.expr(f"if(size({value}) > 1, {listed}, {text_sql(value, kind)})")
        return text_of(field.name, kind)

    return df.select(*[cell(field).alias(field.name) for field in df.schema if field.name != ROW_ORDER])


def export_tsv(
    df: DataFrame,
    path: str,
    sort_by: list[str] | None = None,
    first: list[str] | None = None,
    null_value: str = ".",
    list_style: str = "joined",
) -> None:
    """Export as tab-separated part files with a header, nulls as `.`.

    `sort_by` orders rows over all part files; `first` puts columns in front and sorts
    the others by name.
    """
    spark = df.sparkSession
    if sort_by:
        df = df.orderBy(*[col(name) for name in sort_by if name in df.columns])
    with case_sensitive(spark):
        table = as_text(df, list_style)
        if SOURCE_DATASET in table.columns:
            table = table.withColumnRenamed(SOURCE_DATASET, SOURCE_DATASET_EXPORTED)
        if first:
            table = priority_order(table, first)
        table.write.mode("overwrite").csv(
            path, sep="\t", header=True, nullValue=null_value, emptyValue="", quote='"', escape='"',
            ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
        )
