"""Names and sizes of files on any file system that Arrow knows, listed by tasks."""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.session import materialize

# Workers get this code by value: the package need not be installed on them.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Files read by one task at least, and bytes of their contents in one batch.
_ROWS, _BATCH = 5000, 4 << 20


def locate(uri: str) -> tuple[fs.FileSystem, str, str]:
    """The file system of a path or URI, the path on it, and what to put before such paths."""
    uri = re.sub("^file:/+", "/", uri)
    uri = re.sub("^s3[an]://", "s3://", uri)
    if "://" not in uri:
        return fs.LocalFileSystem(), uri, ""
    system, path = fs.FileSystem.from_uri(uri)
    return system, path, uri.removesuffix(path)


def list_files(folder: str) -> list[tuple[str, int]]:
    """Paths and sizes of all files in a folder and below it, or of one file, by path."""
    system, root, prefix = locate(folder)
    info = system.get_file_info(root)
    found = [info] if info.is_file else system.get_file_info(fs.FileSelector(root, recursive=True))
    return sorted((prefix + f.path, f.size) for f in found if f.is_file)


def _expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What lies in each folder: files with their sizes, folders with none."""
    for batch in batches:
        for folder in batch.column("path").to_pylist():
            system, root, prefix = locate(folder)
            info = system.get_file_info(root)
            if info.type == fs.FileType.NotFound:
                raise FileNotFoundError(folder)
            found = [info] if info.is_file else system.get_file_info(fs.FileSelector(root))
            for a in range(0, len(found), _ROWS):
                part = found[a : a + _ROWS]
                paths = [prefix + f.path for f in part]
                sizes = [f.size if f.is_file else None for f in part]
                yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(sizes, pa.int64())], names=["path", "n_bytes"])


def list_tree(spark: SparkSession, folder: str, hidden: bool = True) -> DataFrame:
    """``path, n_bytes`` of all files in a folder and below it, or of one file.

    Folders are rows, expanded by tasks one level at a time, so neither the driver nor a task
    holds the names of a whole tree. Without ``hidden``, names that begin with ``_`` or ``.`` and
    what lies below them are left out.
    """
    system, root, prefix = locate(folder)
    folders = spark.createDataFrame([(prefix + root,)], "path string")
    tasks, files = int(spark.conf.get("spark.sql.shuffle.partitions")), None
    while files is None or not folders.isEmpty():
        level = folders if files is None else folders.repartition(tasks, "path")
        found = level.mapInArrow(_expand, "path string, n_bytes bigint")
        if not hidden:
            found = found.where(~F.regexp_extract("path", "[^/]*$", 0).rlike("^[_.]"))
        found = materialize(found, "listing")
        folders = found.where("n_bytes is null").select("path")
        here = found.where("n_bytes is not null")
        files = here if files is None else files.unionByName(here)
    return files


def spread(rows: DataFrame, size: str, tasks_bytes: int = 128 << 20) -> DataFrame:
    """Rows that stand for something of ``size`` bytes, over as many tasks as that takes, at least
    as many as there are cores (or rows), none larger than its rows make it."""
    total = rows.agg(F.coalesce(F.sum(size), F.lit(0)).alias("size"), F.count("*").alias("n")).first()
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(max(1, min(total["n"], max(cores, total["size"] // tasks_bytes))))


def read_contents(listed: DataFrame) -> DataFrame:
    """``path, content`` of listed files, read by tasks."""

    def read(batches):
        for batch in batches:
            paths, bodies, size = [], [], 0
            for path in batch.column("path").to_pylist():
                system, name, _ = locate(path)
                with system.open_input_stream(name, compression=None) as stream:
                    bodies.append(stream.read())
                paths.append(path)
                size += len(bodies[-1])
                if size >= _BATCH:
                    yield pa.RecordBatch.from_arrays([pa.array(paths), pa.array(bodies, pa.binary())], names=["path", "content"])
                    paths, bodies, size = [], [], 0
            if paths:
                yield pa.RecordBatch.from_arrays([pa.array(paths), pa.array(bodies, pa.binary())], names=["path", "content"])

    return spread(listed, "n_bytes").mapInArrow(read, "path string, content binary")
