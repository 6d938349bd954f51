"""Annotation tables: TSV files, stored datasets, and lists of datasets."""

from __future__ import annotations

import csv
import json
import warnings
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from variantry.functions.text import col, quoted
from variantry.names import DATASET_INDEX, ROW_ORDER, SOURCE_DATASET
from variantry.operators.cohort import union_aligned
from variantry.sources.files import (
    exists,
    expanded,
    first_file,
    is_folder,
    leading_lines,
    location,
    partition_names,
    provenance_sql,
    small_text,
)

# Cells that pandas documents as null when reading a CSV file.
NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

SIDECAR = "_dataset"
DRIVER_READERS = 16
MAX_LINE = 1 << 24
# Fixed value: the folder name that stands for null in a partition column.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def _header(spark: SparkSession, path: str, separator: str) -> tuple[str, ...]:
    line = next(leading_lines(spark, path, MAX_LINE), None)
    if line is None:
        raise ValueError(f"{path} is empty")
    return tuple(next(csv.reader([line], delimiter=separator)))


def read_delimited(spark: SparkSession, paths: list[str] | str, separator: str = "\t", provenance: bool = False) -> DataFrame:
    """Delimited files with a header as text columns, null tokens turned into nulls.

    Files with equal headers are read in one scan, the scans are united by column
    name. Each file keeps its row order in a hidden column. `provenance` adds the
    family and file name of every row.
    """
    paths = [place for path in ([paths] if isinstance(paths, str) else paths) for place in expanded(spark, path) or [path]]
    with ThreadPoolExecutor(DRIVER_READERS) as readers:
        headers = list(readers.map(lambda path: _header(spark, path, separator), paths))
        folders = list(readers.map(lambda path: is_folder(spark, path), paths))
    groups: dict[tuple[tuple[str, ...], bool], list[str]] = {}
    for header, folder, path in zip(headers, folders, paths, strict=True):
        groups.setdefault((header, folder), []).append(path)
    nulls = ", ".join(f"'{token}'" for token in NULL_TOKENS)
    scans = []
    for (header, folder), group in groups.items():
        schema = T.StructType([T.StructField(name, T.StringType()) for name in header])
        scan = spark.read.schema(schema).csv(group, sep=separator, header=True, quote='"', escape='"')
        named = [F.expr(sql) for sql in provenance_sql(folder)] if provenance else []
        cells = [F.expr(f"if({quoted(name)} in ({nulls}), null, {quoted(name)})").alias(name) for name in header]
        scans.append(scan.select(*named, *cells, F.monotonically_increasing_id().alias(ROW_ORDER)))
    return scans[0] if len(scans) == 1 else union_aligned(scans)


def check_inputs(spark: SparkSession, paths: list[str], extensions: tuple[str, ...]) -> None:
    """Stop before any work if an input is missing or has the wrong extension."""
    wrong = [path for path in paths if not path.endswith(extensions)]
    missing = [path for path in paths if path not in wrong and not exists(spark, path)]
    if wrong or missing:
        raise ValueError(f"not {' or '.join(extensions)} files: {wrong}; not found: {missing}")


def read_sidecar(spark: SparkSession, path: str) -> dict:
    """What was recorded when the dataset was written, or nothing."""
    place = f"{path.rstrip('/')}/{SIDECAR}"
    return json.loads(small_text(spark, place)) if exists(spark, place) else {}


@dataclass(frozen=True)
class Stored:
    """The columns in a dataset's files, those its folders stand for, and all as they are read."""

    files: T.StructType
    folders: T.StructType
    table: T.StructType


def stored_schema(spark: SparkSession, path: str) -> Stored:
    """From what was recorded beside the dataset, without a Spark job; else from its folders and file footers."""
    sidecar = read_sidecar(spark, path)
    if "schema" in sidecar:
        schema, partitions = T.StructType.fromJson(sidecar["schema"]), sidecar.get("partition_by") or []
    else:
        partitions = partition_names(spark, path)
        schema = spark.read.parquet(path).schema
        # Text such as "007" must not become a number.
        schema = T.StructType([T.StructField(f.name, T.StringType()) if f.name in partitions else f for f in schema])
    kinds = {field.name: field.dataType for field in schema}
    order = [name for name in sidecar.get("column_order", []) if name in kinds]
    order += [name for name in kinds if name not in order]
    narrowed = sidecar.get("value_types", {})
    table = T.StructType([
        T.StructField(name, T.DataType.fromDDL(narrowed[name]) if name in narrowed else kinds[name]) for name in order
    ])
    return Stored(
        T.StructType([T.StructField(name, kind) for name, kind in kinds.items() if name not in partitions]),
        T.StructType([T.StructField(name, kinds[name]) for name in partitions]), table,
    )


def _folder_value(place: int) -> str:
    """The value in a folder name of a path, counted from the end; names are escaped, and paths once more."""
    name = f"element_at(split(_path, '/'), {place})"
    text = f"substring({name}, instr({name}, '=') + 1)"
    for _ in range(2):
        text = f"url_decode(replace({text}, '+', '%2B'))"
    return f"nullif({text}, '{NULL_PARTITION}')"


def _scan(spark: SparkSession, paths: list[str], stored: Stored, *extra: Column) -> DataFrame:
    """Datasets of one schema in one scan; columns of folders come from the path of each row's file."""
    depth = len(stored.folders)
    rows = spark.read.schema(stored.files).option("recursiveFileLookup", "true").parquet(*paths)
    rows = rows.withColumn("_path", F.col("_metadata.file_path")) if depth or extra else rows
    values = {
        field.name: F.expr(_folder_value(i - depth - 1)).try_cast(field.dataType) for i, field in enumerate(stored.folders)
    }
    cells = [
        values[field.name].alias(field.name) if field.name in values else col(field.name).try_cast(field.dataType).alias(field.name)
        if stored.files[field.name].dataType != field.dataType else col(field.name)
        for field in stored.table
    ]
    return rows.select(*cells, *extra)


def read_dataset(spark: SparkSession, path: str) -> DataFrame:
    """A stored dataset with its recorded column order and value types."""
    stored = stored_schema(spark, path)
    if not stored.folders:
        return _scan(spark, [path], stored)
    # One root: Spark's own partition columns let filters leave out folders.
    rows = spark.read.schema(T.StructType([*stored.files, *stored.folders])).parquet(path)
    return rows.select(*[col(field.name).try_cast(field.dataType).alias(field.name) for field in stored.table])


def read_path_list(spark: SparkSession, path: str) -> list[str]:
    """The paths named in a list file, one per line; comments, blanks and missing paths are left out."""
    if not exists(spark, path):
        raise FileNotFoundError(path)
    lines = [row[0].strip() for row in spark.read.text(path).collect()]
    found = []
    for line in lines:
        if not line or line.startswith("#"):
            continue
        if exists(spark, line):
            found.append(line)
        else:
            warnings.warn(f"dataset {line} not found", stacklevel=2)
    return found


def _inspect(spark: SparkSession, path: str) -> Stored | Exception:
    try:
        first_file(spark, path)
        return stored_schema(spark, path)
    except (PySparkException, FileNotFoundError) as error:
        return error
    except Py4JJavaError as error:
        # Files of another format are only told by their footers, in a Spark job.
        if "CANNOT_READ_FILE_FOOTER" not in str(error) and "is not a Parquet file" not in str(error):
            raise
        return error


def valid_datasets(spark: SparkSession, paths: list[str]) -> dict[str, Stored]:
    """The readable datasets among the paths with their schemas; none is an error."""
    with ThreadPoolExecutor(DRIVER_READERS) as readers:
        found = dict(zip(paths, readers.map(lambda path: _inspect(spark, path), paths)))
    valid = {}
    for path, stored in found.items():
        if isinstance(stored, Exception):
            warnings.warn(f"dataset {path} cannot be read: {str(stored)[:500]}", stacklevel=2)
            continue
        if SOURCE_DATASET not in stored.table.names:
            warnings.warn(f"dataset {path} lacks {SOURCE_DATASET}, was it collapsed?", stacklevel=2)
        valid[path] = stored
    if not valid:
        raise ValueError("no valid datasets")
    return valid


def _with_family(df: DataFrame) -> DataFrame:
    """Name the family of datasets without that column by their position, from 1."""
    position = (F.col(DATASET_INDEX) + 1).cast("string")
    return df.withColumn("family", F.col("family").cast("string") if "family" in df.columns else position)


def read_datasets(spark: SparkSession, paths: list[str]) -> tuple[DataFrame, list[str]]:
    """Many datasets as one table with a dataset number, and the paths by number.

    Datasets with equal schemas share one scan, so the plan grows with the number of
    different schemas and not with the number of datasets.
    """
    stored = valid_datasets(spark, paths)
    valid = list(stored)
    groups: dict[str, list[int]] = {}
    for index, schemas in enumerate(stored.values()):
        groups.setdefault(json.dumps([schemas.files.json(), schemas.folders.json(), schemas.table.json()]), []).append(index)
    frames = []
    for members in groups.values():
        schemas = stored[valid[members[0]]]
        if len(members) == 1:
            frames.append(_with_family(_scan(spark, [valid[members[0]]], schemas, F.lit(members[0]).alias(DATASET_INDEX))))
            continue
        folder = F.regexp_replace(
            F.regexp_replace("_path", "(/[^/]*){%d}$" % (len(schemas.folders) + 1), ""), "^file:/+", "/"
        )
        numbers = spark.createDataFrame(
            [(location(spark, valid[index]), index) for index in members], "_root string, _number int"
        )
        placed = _scan(spark, [valid[index] for index in members], schemas, folder.alias("_folder"))
        numbered = placed.join(F.broadcast(numbers), F.col("_folder") == F.col("_root"), "left")
        lost = F.raise_error(F.concat(F.lit("no dataset of the list is at "), F.col("_folder"))).cast("int")
        frames.append(_with_family(
            numbered.withColumn(DATASET_INDEX, F.coalesce("_number", lost)).drop("_folder", "_root", "_number")
        ))
    return union_aligned(frames), valid


def number_datasets(df: DataFrame, by: str = SOURCE_DATASET) -> tuple[DataFrame, list[str]]:
    """Number the datasets within one table by a column, and the names by number."""
    names = [row[0] for row in df.select(by).distinct().orderBy(by).collect()]
    if None in names:
        raise ValueError(f"rows without {by}")
    numbers = df.sparkSession.createDataFrame(list(zip(names, range(len(names)))), f"{by} string, {DATASET_INDEX} int")
    return df.join(F.broadcast(numbers), by), names

