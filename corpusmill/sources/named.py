"""Documents as files under their own names, written in two phases."""

from __future__ import annotations

import json
import sys
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from corpusmill.sources.listing import locate

# Workers get this code by value: the package need not be installed on them.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Written once every file is in place.
DONE = "_SUCCESS"


@dataclass
class Staged(WriterCommitMessage):
    """The folder in which one attempt of one task left its files, and their number."""

    folder: str
    n_files: int


def check_name(name: str) -> str:
    """A relative name that stays below its folder."""
    if not name or name.startswith("/") or any(part in ("", ".", "..") for part in name.split("/")):
        raise ValueError(f"not a file name: {name!r}")
    return name


class StagingWriter(DataSourceWriter):
    """First phase: every attempt of a task writes into a folder of its own. Of those only the ones
    whose messages reach the driver are named in the manifest, so a failed, repeated or
    speculative attempt leaves nothing that is moved on."""

    def __init__(self, options: dict):
        self.staging = options["path"]

    def write(self, rows: Iterator[Row]) -> Staged:
        folder = f"{self.staging}/{uuid.uuid4().hex}"
        system, root, _ = locate(folder)
        made, n = set(), 0
        for row in rows:
            path = f"{root}/{check_name(row.name)}"
            parent = path.rsplit("/", 1)[0]
            if parent not in made:
                system.create_dir(parent, recursive=True)
                made.add(parent)
            with system.open_output_stream(path) as out:
                out.write(bytes(row.content))
            n += 1
        return Staged(folder, n)

    def commit(self, messages: list[Staged | None]) -> None:
        system, root, _ = locate(self.staging)
        system.create_dir(root, recursive=True)
        with system.open_output_stream(f"{root}/manifest.json") as out:
            out.write(json.dumps([m.folder for m in messages if m and m.n_files]).encode())

    def abort(self, messages: list[Staged | None]) -> None:
        system, root, _ = locate(self.staging)
        if system.get_file_info(root).type != fs.FileType.NotFound:
            system.delete_dir(root)


class NamedFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return "named_files"

    def schema(self) -> str:
        return "name string, content binary"

    def writer(self, schema, overwrite: bool) -> StagingWriter:
        return StagingWriter(self.options)


def _move(folder: str):
    """Second phase: staged files go to their names. Doing it again does no harm."""

    def move(batches):
        for batch in batches:
            for staged in batch.column("staged").to_pylist():
                system, root, _ = locate(staged)
                target = locate(folder)[1]
                if system.get_file_info(root).type == fs.FileType.NotFound:
                    continue
                n = 0
                for info in system.get_file_info(fs.FileSelector(root, recursive=True)):
                    if info.is_file:
                        path = f"{target}/{info.path[len(root) + 1 :]}"
                        system.create_dir(path.rsplit("/", 1)[0], recursive=True)
                        system.move(info.path, path)
                        n += 1
                yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], names=["n"])

    return move


def sink_named_documents(docs: DataFrame, folder: str, name: str = "file_name", text: str = "text", tasks: int | None = None) -> None:
    """Write each document into ``folder`` as a file of its own name, empty ones too; files of other
    names that lie there stay.

    Names must be unique, which is checked first: two documents of one name are an error before
    anything is written. Tasks stage their files; when all have ended well, other tasks move
    them, a whole file at a time; ``_SUCCESS`` comes last. A lost or repeated task leaves no
    partial and no second file in ``folder``; a failed job leaves none there at all (tasks that
    outlive it may leave staged ones, in a folder of their own that readers pass over).
    """
    spark = docs.sparkSession
    twice = docs.groupBy(name).agg(F.count("*").alias("n")).where(F.col(name).isNull() | (F.col("n") > 1)).first()
    if twice:
        raise ValueError(f"no name of one document: {twice[0]!r}")
    spark.dataSource.register(NamedFiles)
    staging = f"{folder.rstrip('/')}/_staging-{uuid.uuid4().hex}"
    rows = docs.select(F.col(name).alias("name"), F.coalesce(text, F.lit("")).cast("binary").alias("content"))
    rows = rows.repartition(tasks) if tasks else rows
    rows.write.format("named_files").mode("append").save(staging)
    system, root, _ = locate(staging)
    with system.open_input_stream(f"{root}/manifest.json") as held:
        # One folder per task.
        staged = json.loads(held.read())
    if staged:
        moves = spark.createDataFrame([(s,) for s in staged], "staged string").repartition(len(staged))
        moves.mapInArrow(_move(folder), "n bigint").write.format("noop").mode("overwrite").save()
    system.delete_dir(root)
    with system.open_output_stream(f"{locate(folder)[1]}/{DONE}"):
        pass
