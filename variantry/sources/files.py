"""Small driver-side questions about paths, asked through the cluster's file system and without a Spark job."""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import SparkSession


def _hadoop_path(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop, hadoop.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    hadoop, file_system = _hadoop_path(spark, path)
    return bool(file_system.exists(hadoop))


def is_folder(spark: SparkSession, path: str) -> bool:
    hadoop, file_system = _hadoop_path(spark, path)
    return bool(file_system.exists(hadoop)) and bool(file_system.getFileStatus(hadoop).isDirectory())


def location(spark: SparkSession, path: str) -> str:
    """The path in the form `without_scheme` gives to the paths Spark reports for rows."""
    hadoop, file_system = _hadoop_path(spark, path)
    return re.sub("^file:/+", "/", file_system.makeQualified(hadoop).toUri().toString()).rstrip("/")


def _visible(file_system, hadoop) -> list:
    """What a folder holds but for hidden names, in order of names, as Spark reads it."""
    found = sorted(file_system.listStatus(hadoop), key=lambda status: status.getPath().getName())
    return [status for status in found if not status.getPath().getName().startswith(("_", "."))]


def expanded(spark: SparkSession, path: str) -> list[str]:
    """The path if it is there, else what it matches as a pattern."""
    hadoop, file_system = _hadoop_path(spark, path)
    if file_system.exists(hadoop):
        return [path]
    return [status.getPath().toString() for status in file_system.globStatus(hadoop) or []]


def first_file(spark: SparkSession, path: str) -> str:
    """The path of the first file of a file, folder or pattern."""
    for place in expanded(spark, path):
        hadoop, file_system = _hadoop_path(spark, place)
        waiting = [file_system.getFileStatus(hadoop)]
        while waiting:
            status = waiting.pop(0)
            if not status.isDirectory():
                return status.getPath().toString()
            waiting = _visible(file_system, status.getPath()) + waiting
    raise FileNotFoundError(path)


def partition_names(spark: SparkSession, path: str) -> list[str]:
    """The columns that the folders below a dataset stand for, from the outermost to the innermost."""
    hadoop, file_system = _hadoop_path(spark, path)
    names = []
    while True:
        folders = [s for s in _visible(file_system, hadoop) if s.isDirectory() and "=" in s.getPath().getName()]
        if not folders:
            return names
        hadoop = folders[0].getPath()
        escaped = hadoop.getName().split("=")[0]
        names.append(re.sub("%([0-9A-F]{2})", lambda code: chr(int(code[1], 16)), escaped))


def front(spark: SparkSession, path: str, size: int) -> bytes:
    """At most `size` bytes from the start of a file, decompressed by its extension."""
    hadoop, file_system = _hadoop_path(spark, path)
    codecs = spark._jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(spark._jsc.hadoopConfiguration())
    codec = codecs.getCodec(hadoop)
    stream = file_system.open(hadoop)
    try:
        return bytes((stream if codec is None else codec.createInputStream(stream)).readNBytes(size))
    finally:
        stream.close()


FRONT_BYTES = 1 << 16


def leading_lines(spark: SparkSession, path: str, most: int) -> Iterator[str]:
    """The lines at the front of a file, folder or pattern, read in growing pieces of up to `most` bytes as they are asked for."""
    path = first_file(spark, path)
    size, given = FRONT_BYTES, 0
    while True:
        data = front(spark, path, size)
        lines = data.decode("utf-8", "replace").split("\n")
        whole = len(data) < size
        # What ends without a line break may go on beyond the piece.
        lines = lines if whole and lines[-1] else lines[:-1]
        yield from (line.rstrip("\r") for line in lines[given:])
        given = len(lines)
        if whole or size >= most:
            return
        size = min(size * 8, most)


def small_text(spark: SparkSession, folder: str) -> str:
    """The text of the files of a folder, in order of names."""
    hadoop, file_system = _hadoop_path(spark, folder)
    parts = []
    for status in _visible(file_system, hadoop):
        parts.append(front(spark, status.getPath().toString(), int(status.getLen()) + 1).decode())
    return "".join(parts)


def whole_text(path: str) -> str:
    """A small file, or the files of a folder, through the file system of the running session; without one, a local file."""
    spark = SparkSession.getActiveSession()
    if spark is None:
        with open(path, encoding="utf-8", newline="") as handle:
            return handle.read()
    if is_folder(spark, path):
        return small_text(spark, path)
    hadoop, file_system = _hadoop_path(spark, path)
    return front(spark, path, int(file_system.getFileStatus(hadoop).getLen()) + 1).decode("utf-8")


def base_name(path: str) -> str:
    return path.rstrip("/").rsplit("/", 1)[-1]


def stem(path: str) -> str:
    """The base name without its last extension."""
    return re.sub(r"\.[^.]*$", "", base_name(path))


def input_path(folder: bool) -> str:
    """SQL for the path of the input that a scanned row came from: its file, or the folder of that."""
    return "regexp_replace(_metadata.file_path, '/[^/]*$', '')" if folder else "_metadata.file_path"


def provenance_sql(folder: bool) -> list[str]:
    """SQL for the family and name of the input that a scanned row came from; the family is the name's first part."""
    name = f"url_decode(replace(substring_index({input_path(folder)}, '/', -1), '+', '%2B'))"
    return [f"split_part({name}, '.', 1) as family", f"{name} as filename"]
