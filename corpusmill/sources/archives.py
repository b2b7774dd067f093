"""Web archives (WARC, gzip) as a Spark data source.

``spark.read.format("warc").load(folder)`` yields one row per record. Archives are cut at
the starts of gzip members, which is where archive writers start records, so that one
large file is read by many tasks. Bodies of records whose type is not asked for are let go
while they are read. An index of the records' places lets a few be read without the others.
"""

from __future__ import annotations

import sys
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, InputPartition

from corpusmill.operators.ranks import hash_rank, running_offsets
from corpusmill.session import materialize
from corpusmill.sources.listing import list_files, list_tree, locate, spread

# Workers get this module by value: the package need not be installed on them.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SCHEMA = (
    "file string, record_no bigint, warc_type string, url string, "
    "headers map<string,string>, content binary"
)
ARCHIVE_SUFFIX = ".warc.filtered.gz"
# A record is numbered by the place of its gzip member in the file and its place within it.
_RECORDS_PER_MEMBER = 1 << 22
_CHUNK = 1 << 20


@dataclass
class ArchiveSplit(InputPartition):
    path: str
    start: int
    end: int

    def __init__(self, path: str, start: int, end: int):
        super().__init__(path)
        self.path, self.start, self.end = path, start, end


def list_archives(folder: str, suffix: str = ARCHIVE_SUFFIX) -> list[tuple[str, int]]:
    """Paths and sizes of the archives in a folder and all below it, sorted by path."""
    return [(path, size) for path, size in list_files(folder) if path.endswith(suffix)]


class _Members:
    """The decompressed bytes of an archive from the first record start in a byte range on."""

    def __init__(self, stream, start: int):
        self.stream, self.raw, self.at = stream, b"", start
        stream.seek(start)
        self.member, self.inflate, self.ready = start, None, b""
        # Decompressed bytes of the member so far, what is ready included.
        self.given = 0

    def _more(self) -> bool:
        chunk = self.stream.read(_CHUNK)
        self.raw += chunk
        return bool(chunk)

    def _opening(self, size: int) -> bytes:
        """The first decompressed bytes, if a gzip member begins here."""
        inflate, out, fed = zlib.decompressobj(31), b"", 0
        while len(out) < size and not inflate.eof:
            if fed == len(self.raw) and not self._more():
                break
            try:
                out += inflate.decompress(self.raw[fed:], size - len(out))
            except zlib.error:
                return b""
            fed = len(self.raw) - len(inflate.unconsumed_tail)
        return out

    def seek_record(self, end: int) -> bool:
        """Go to the first gzip member in the range that opens with a record."""
        while True:
            found = self.raw.find(b"\x1f\x8b\x08")
            if found < 0:
                drop = max(len(self.raw) - 2, 0)
                self.at, self.raw = self.at + drop, self.raw[drop:]
                if self.at >= end or not self._more():
                    return False
                continue
            self.at, self.raw = self.at + found, self.raw[found:]
            if self.at >= end:
                return False
            if self._opening(5) == b"WARC/":
                self.member = self.at
                return True
            self.at, self.raw = self.at + 1, self.raw[1:]

    def read(self) -> bytes:
        """The next piece of decompressed data; empty at the end of the file."""
        while True:
            if not self.raw and not self._more():
                return b""
            if self.inflate is None:
                self.inflate, self.member, self.given = zlib.decompressobj(31), self.at, 0
            data = self.inflate.decompress(self.raw)
            left = self.inflate.unused_data
            self.at += len(self.raw) - len(left)
            self.raw = left
            if self.inflate.eof:
                self.inflate = None
            if data:
                self.given += len(data)
                return data

    @property
    def place(self) -> int:
        """Where what is ready begins in the member; below 0 if that was in the one before."""
        return self.given - len(self.ready)

    def fill(self) -> bool:
        piece = self.read()
        self.ready += piece
        return bool(piece)


def _headers(block: bytes) -> dict[str, str]:
    pairs = (line.split(b":", 1) for line in block.split(b"\r\n")[1:] if b":" in line)
    return {k.strip().decode("latin-1"): v.strip().decode("utf-8", "replace") for k, v in pairs}


def _body(block: bytes, content_type: str) -> bytes:
    """An HTTP response without its status line and headers."""
    if content_type.startswith("application/http") or block.startswith(b"HTTP/"):
        head, blank, body = block.partition(b"\r\n\r\n")
        return body if blank else b""
    return block


class CutOff(ValueError):
    """An archive ends within a record."""


@dataclass
class _Record:
    """One record: the member and the place in it where it begins, its header, its length and how
    much of that the archive lacks; the block if it was wanted."""

    member: int
    place: int
    ordinal: int
    headers: dict[str, str]
    length: int
    missing: int
    block: bytes | None


def _take(members: _Members, length: int, keep: bool) -> tuple[bytes | None, int]:
    """The next ``length`` bytes, and how many the archive lacks. Unwanted ones are let go as they come."""
    parts, have = [], 0
    while True:
        part, members.ready = members.ready[: length - have], members.ready[length - have :]
        have += len(part)
        if keep:
            parts.append(part)
        if have == length or not members.fill():
            return (b"".join(parts) if keep else None), length - have


def _walk(stream, start: int, end: int, wanted) -> Iterator[_Record]:
    """The records of the gzip members that start in ``[start, end)``; ``wanted`` says of which
    headers the block is kept."""
    members = _Members(stream, start)
    if not members.seek_record(end):
        return
    last_member, ordinal = -1, 0
    while True:
        members.ready = members.ready.lstrip(b"\r\n")
        if not members.ready:
            # The next record opens a member; it belongs to this split if that one does.
            if members.inflate is None and members.at >= end:
                return
            if not members.fill():
                if members.inflate is not None and members.member != last_member:
                    # The file ends in a member before its record can be told.
                    yield _Record(members.member, 0, 0, {}, 0, 1, None)
                return
            continue
        member, place, cut = members.member, members.place, False
        while b"\r\n\r\n" not in members.ready and not cut:
            cut = not members.fill()
        head, _, members.ready = members.ready.partition(b"\r\n\r\n")
        headers = _headers(head)
        length = int(headers.get("Content-Length", 0))
        block, missing = _take(members, length, wanted(headers))
        ordinal = ordinal + 1 if member == last_member else 0
        last_member = member
        yield _Record(member, place, ordinal, headers, length, max(missing, int(cut)), block)


def _content(headers: dict[str, str], block: bytes) -> bytes:
    return _body(block, headers.get("Content-Type", "")) if headers.get("WARC-Type") == "response" else block


def read_split(path: str, start: int, end: int, kind: str | None, truncated: str = "error") -> Iterator[tuple]:
    """Records of the gzip members that start in ``[start, end)``. One that the archive ends in is
    an error, or left out if ``truncated`` is ``skip``; ``index_records`` counts them."""

    def wanted(headers: dict[str, str]) -> bool:
        return kind is None or headers.get("WARC-Type") == kind

    system, name, _ = locate(path)
    with system.open_input_file(name) as stream:
        for record in _walk(stream, start, end, wanted):
            if record.missing and truncated == "error":
                raise CutOff(f"{path} ends {record.missing} bytes before the record at {record.member}")
            if record.block is None or record.missing:
                continue
            headers = record.headers
            number = record.member * _RECORDS_PER_MEMBER + record.ordinal
            yield path, number, headers.get("WARC-Type"), headers.get("WARC-Target-URI"), headers, _content(headers, record.block)


class ArchiveReader(DataSourceReader):
    def __init__(self, options: dict):
        self.folder = options["path"]
        self.suffix = options.get("suffix", ARCHIVE_SUFFIX)
        self.split_bytes = int(options.get("splitbytes", 128 << 20))
        self.first, self.count = int(options.get("first", 0)), options.get("count")
        self.truncated = options.get("truncated", "error")
        self.kind = None

    def pushFilters(self, filters):
        for item in filters:
            if isinstance(item, EqualTo) and item.attribute == ("warc_type",):
                self.kind = item.value
            else:
                yield item

    def partitions(self):
        listed = list_archives(self.folder, self.suffix)[self.first :]
        return [
            ArchiveSplit(path, at, min(at + self.split_bytes, size))
            for path, size in (listed if self.count is None else listed[: int(self.count)])
            for at in range(0, size, self.split_bytes)
        ]

    def read(self, split: ArchiveSplit) -> Iterator[tuple]:
        return read_split(split.path, split.start, split.end, self.kind, self.truncated)


class ArchiveSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> ArchiveReader:
        return ArchiveReader(self.options)


def scan_archives(spark: SparkSession, folder: str, suffix: str = ARCHIVE_SUFFIX) -> DataFrame:
    """``path, n_bytes`` of each archive by path; only names and sizes are read, by tasks."""
    return list_tree(spark, folder).where(F.endswith("path", F.lit(suffix))).orderBy("path")


def _splits(archives: DataFrame, split_bytes: int) -> DataFrame:
    """``path, start, end``: archives cut into ranges of bytes, spread over tasks."""
    starts = F.sequence(F.lit(0).cast("bigint"), F.greatest(F.col("n_bytes") - 1, F.lit(0)), F.lit(split_bytes).cast("bigint"))
    cut = archives.where("n_bytes > 0").select("path", "n_bytes", F.explode(starts).alias("start"))
    ends = F.least(F.col("start") + split_bytes, F.col("n_bytes")).alias("end")
    return spread(cut.select("path", "start", ends).withColumn("size", F.col("end") - F.col("start")), "size")


def _batches(rows: Iterator[tuple], schema: pa.Schema, weigh) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += 100 + weigh(row)
        if size >= _CHUNK << 2:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)


_ARROW = pa.schema(
    [("file", pa.string()), ("record_no", pa.int64()), ("warc_type", pa.string()), ("url", pa.string()),
     ("headers", pa.map_(pa.string(), pa.string())), ("content", pa.binary())]
)
_INDEX = "file string, record_no bigint, warc_type string, url string, member bigint, place bigint, length bigint, missing bigint"
_ARROW_INDEX = pa.schema(
    [("file", pa.string()), ("record_no", pa.int64()), ("warc_type", pa.string()), ("url", pa.string()),
     ("member", pa.int64()), ("place", pa.int64()), ("length", pa.int64()), ("missing", pa.int64())]
)


def read_archives(
    archives: DataFrame, warc_type: str | None = "response", split_bytes: int = 128 << 20, truncated: str = "error"
) -> DataFrame:
    """Records of listed archives (``path, n_bytes``), the responses by default."""

    def read(batches):
        for batch in batches:
            for split in batch.to_pylist():
                rows = read_split(split["path"], split["start"], split["end"], warc_type, truncated)
                rows = ((*r[:4], list(r[4].items()), r[5]) for r in rows)
                yield from _batches(rows, _ARROW, lambda r: len(r[5]))

    return _splits(archives, split_bytes).mapInArrow(read, SCHEMA)


def scan_records(
    spark: SparkSession,
    folder: str,
    suffix: str = ARCHIVE_SUFFIX,
    warc_type: str | None = "response",
    split_bytes: int = 128 << 20,
    first: int = 0,
    count: int | None = None,
    truncated: str = "error",
) -> DataFrame:
    """Records of the archives of a folder, the responses by default; with ``first`` and
    ``count``, of that slice of the archives in path order. Archives are listed by tasks."""
    listed = scan_archives(spark, folder, suffix)
    if first or count is not None:
        last = first + count - 1 if count is not None else (1 << 62)
        places = running_offsets(listed.withColumn("_one", F.lit(1)), "path", "_one", "position")
        listed = listed.join(places.where(F.col("position").between(first, last)).select("path"), "path")
    return read_archives(listed, warc_type, split_bytes, truncated)


def index_records(archives: DataFrame, split_bytes: int = 128 << 20) -> DataFrame:
    """``file, record_no, warc_type, url, member, place, length, missing`` of every record of listed
    archives, by one pass that keeps no block: where its gzip member begins in the file and it in the
    member, its length, and how many bytes of it the archive lacks (0 for whole records)."""

    def index(batches):
        for batch in batches:
            for split in batch.to_pylist():
                system, name, _ = locate(split["path"])
                with system.open_input_file(name) as stream:
                    rows = (
                        (split["path"], r.member * _RECORDS_PER_MEMBER + r.ordinal, r.headers.get("WARC-Type"),
                         r.headers.get("WARC-Target-URI"), r.member, r.place, r.length, r.missing)
                        for r in _walk(stream, split["start"], split["end"], lambda _: False)
                    )
                    yield from _batches(rows, _ARROW_INDEX, lambda r: len(r[3] or ""))

    return _splits(archives, split_bytes).mapInArrow(index, _INDEX)


def read_indexed(index: DataFrame) -> DataFrame:
    """The records that the rows of an index stand for, and no others: files are opened at the
    records' members. Rows of a member are read in one pass."""

    def read(batches):
        path, members, stream = None, None, None
        try:
            for batch in batches:
                rows = []
                for row in batch.to_pylist():
                    if row["file"] != path:
                        if stream:
                            stream.close()
                        system, name, _ = locate(row["file"])
                        path, stream, members = row["file"], system.open_input_file(name), None
                    if members is None or members.member != row["member"] or members.place > row["place"]:
                        members = _Members(stream, row["member"])
                        members.fill()
                    _take(members, row["place"] - members.place, keep=False)
                    while b"\r\n\r\n" not in members.ready and members.fill():
                        pass
                    head, _, members.ready = members.ready.partition(b"\r\n\r\n")
                    headers = _headers(head)
                    block, missing = _take(members, row["length"], keep=True)
                    if missing:
                        raise CutOff(f"{path} ends {missing} bytes before the record at {row['member']}")
                    rows.append((path, row["record_no"], row["warc_type"], row["url"], list(headers.items()), _content(headers, block)))
                    if sum(len(r[5]) for r in rows) > _CHUNK << 2:
                        yield from _batches(iter(rows), _ARROW, lambda r: len(r[5]))
                        rows = []
                yield from _batches(iter(rows), _ARROW, lambda r: len(r[5]))
        finally:
            if stream:
                stream.close()

    # Rows of a member stay together; members of one file go to many tasks.
    placed = spread(index, "length").select(*index.columns)
    tasks = placed.rdd.getNumPartitions()
    return index.repartition(tasks, "file", "member").sortWithinPartitions("file", "member", "place").mapInArrow(read, SCHEMA)


def sample_archives(archives: DataFrame, k: int, warc_type: str = "response", seed: int = 0) -> DataFrame:
    """``k`` whole records at random, or all if there are fewer: of the index ``k`` rows are drawn, and
    only their blocks are unpacked."""
    index = materialize(index_records(archives), "records")
    whole = index.where((F.col("warc_type") == warc_type) & (F.col("missing") == 0))
    keyed = whole.withColumn("key", F.concat_ws(":", F.regexp_extract("file", "[^/]*$", 0), F.col("url"), F.col("record_no")))
    drawn = materialize(hash_rank(keyed, "key", seed, limit=k).select(*index.columns), "drawn")
    return read_indexed(drawn)
