"""Data sources that read text in byte ranges, each of which finds its own first line or record.

``mudlark_fastq`` gives FASTQ records, ``mudlark_text`` lines. A file is cut at any byte: a line or record belongs to the range in
which it begins, and is read to its end wherever that lies. So no range needs to know of another and no row is shuffled. A
FASTQ record begins at a line with ``@`` that has a line with ``+`` two further down: no other line of a record can be such a line, since two
lines below a quality line that happens to begin with ``@`` stands a sequence.

A file is gzip if its first bytes say so, whatever its name. Such a file can't be entered in the middle: the first of its
ranges reads all of it, the others give nothing.

Files are opened by the file systems of pyarrow (local, S3, GCS, HDFS, ABFS).
"""

from __future__ import annotations

import fnmatch
import gzip
import json
import os
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Bytes of a range, and of a read.
RANGE, BLOCK = 64 << 20, 4 << 20
GZIP = b"\x1f\x8b"
FASTQ = "file string, header string, seq string, qual string"
TEXT = "file string, value string"


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path and the path in it; an error where pyarrow knows none."""
    if "://" not in path and not path.startswith("file:"):
        path = os.path.abspath(path)
    return fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))


def reachable(paths: list[str]) -> bool:
    """Whether pyarrow can open what Spark would."""
    try:
        for p in paths:
            file_system(p)
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError):
        return False
    return True


def files_of(path: str) -> list[tuple[str, int]]:
    """Path as Spark would name it, and size, of the files that a file, a folder or a pattern in the last part of a path stands for.

    As Spark does, a folder's files are those in it and in its folders ``column=value``; hidden ones are left out."""
    system, inner = file_system(path)
    head = path[: -len(inner)] if path.endswith(inner) else ("" if "://" in path else "file://")
    head = head or "file://"
    if any(c in os.path.basename(inner) for c in "*?["):
        found = [x for x in system.get_file_info(fs.FileSelector(os.path.dirname(inner))) if fnmatch.fnmatch(x.base_name, os.path.basename(inner))]
    else:
        one = system.get_file_info(inner)
        if one.type == fs.FileType.NotFound:
            raise FileNotFoundError(path)
        found = [one]
        if one.type == fs.FileType.Directory:
            below = [(x, x.path[len(inner.rstrip("/")) + 1 :].split("/")[:-1]) for x in system.get_file_info(fs.FileSelector(inner, recursive=True))]
            found = [x for x, folders in below if all("=" in f and not f.startswith(".") for f in folders)]
    return sorted((head + x.path, x.size) for x in found if x.type == fs.FileType.File and not x.base_name.startswith(("_", ".")))


@dataclass
class Range(InputPartition):
    """Bytes from ``start`` up to ``end`` of a file."""

    file: str
    start: int
    end: int


def _blocks(stream, rest: bytes = b"") -> Iterator[list[bytes]]:
    """Lines of a stream without their ends, some at a time."""
    while data := stream.read(BLOCK):
        data = rest + data
        cut = data.rfind(b"\n") + 1
        rest = data[cut:]
        if cut:
            yield data[:cut].split(b"\n")[:-1]
    if rest:
        lines = rest.split(b"\n")
        yield lines[:-1] if rest.endswith(b"\n") else lines


def _entered(part: Range):
    """The stream at the first line that begins in the range, its offset, and where the range ends; None if it has none."""
    system, inner = file_system(part.file)
    stream = system.open_input_file(inner)
    if stream.read(2) == GZIP:
        if part.start:
            return None
        stream.seek(0)
        return gzip.GzipFile(fileobj=stream), b"", 0, 1 << 62
    if not part.start:
        stream.seek(0)
        return stream, b"", 0, part.end
    # the byte before tells whether a line begins just here
    at, rest = part.start - 1, b""
    stream.seek(at)
    while data := stream.read(BLOCK):
        if (i := data.find(b"\n")) >= 0:
            at, rest = at + i + 1, data[i + 1 :]
            return (stream, rest, at, part.end) if at < part.end else None
        at += len(data)
        if at >= part.end:
            return None
    return None


def _text(values: list[bytes]) -> pa.Array:
    """Lines as text, without a carriage return; bytes that are no UTF-8 become replacement characters."""
    values = [v[:-1] if v.endswith(b"\r") else v for v in values]
    try:
        return pa.array(values, type=pa.binary()).cast(pa.string())
    except pa.ArrowInvalid:
        return pa.array([v.decode("utf-8", "replace") for v in values])


def _owned(lines: list[bytes], at: int, end: int, step: int) -> int:
    """How many of the lines, which begin at ``at``, belong to units of ``step`` lines that begin before ``end``."""
    for i in range(0, len(lines), step):
        if at >= end:
            return i
        at += sum(map(len, lines[i : i + step])) + step
    return len(lines)


class TextReader(DataSourceReader):
    def __init__(self, options):
        self.paths, self.range = json.loads(options["paths"]), int(options.get("rangebytes", RANGE))

    def partitions(self) -> list[Range]:
        out = [Range(f, a, min(a + self.range, size)) for p in self.paths for f, size in files_of(p) for a in range(0, size, self.range)]
        return out or [Range("", 0, 0)]

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        found = _entered(partition) if partition.file else None
        if found is None:
            return
        stream, rest, at, end = found
        for lines in _blocks(stream, rest):
            size = sum(map(len, lines)) + len(lines)
            own = lines[: _owned(lines, at, end, 1)] if at + size > end else lines
            if own:
                yield pa.RecordBatch.from_arrays([pa.array([partition.file] * len(own)), _text(own)], names=["file", "value"])
            at += size
            if at >= end:
                return


class FastqReader(TextReader):
    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        found = _entered(partition) if partition.file else None
        if found is None:
            return
        stream, rest, at, end = found
        lines: list[bytes] = []
        aligned = not partition.start
        for more in _blocks(stream, rest):
            lines += more
            if not aligned:
                if len(lines) < 6:
                    continue
                at, lines = self.first(lines, at, partition.file)
                aligned = True
            whole = len(lines) // 4 * 4
            size = sum(map(len, lines[:whole])) + whole
            own = _owned(lines[:whole], at, end, 4) if at + size > end else whole
            if own:
                yield self.records(lines[:own], partition.file)
            at, lines = at + size, lines[whole:]
            if at >= end:
                return
        if not aligned and lines:  # the file's last lines
            at, lines = self.first(lines, at, partition.file)
        if lines and at < end:
            own = _owned(lines, at, end, 4)
            yield self.records(lines[: min(own, len(lines))], partition.file)

    @staticmethod
    def first(lines: list[bytes], at: int, file: str) -> tuple[int, list[bytes]]:
        """The offset of the first line that begins a record, and the lines from there; none if a record's last lines are all there is."""
        for i in range(min(4, len(lines))):
            if lines[i].startswith(b"@") and i + 2 < len(lines) and lines[i + 2].startswith(b"+"):
                return at + sum(map(len, lines[:i])) + i, lines[i:]
        if len(lines) >= 6:
            raise ValueError(f"a record does not start with @ in {file}")
        # fewer than six lines at a file's end: the last lines of one record are at most three, what is over is no record
        if len(lines) > 3:
            raise ValueError(f"a record has no + line in {file}")
        return at + sum(map(len, lines)) + len(lines), []

    @staticmethod
    def records(lines: list[bytes], file: str) -> pa.RecordBatch:
        head, seq, plus, qual = (_text(lines[i::4]) for i in range(4))
        if not pc.all(pc.starts_with(head, "@")).as_py():
            raise ValueError(f"a record does not start with @ in {file}")
        if len(plus) != len(head) or not pc.all(pc.starts_with(plus, "+")).as_py():
            raise ValueError(f"a record has no + line in {file}")
        if len(qual) != len(head) or not pc.all(pc.equal(pc.utf8_length(seq), pc.utf8_length(qual))).as_py():
            raise ValueError(f"sequence and quality differ in length in {file}")
        return pa.RecordBatch.from_arrays([pa.array([file] * len(head)), pc.utf8_slice_codeunits(head, 1), seq, qual], names=["file", "header", "seq", "qual"])


class TextSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "mudlark_text"

    def schema(self) -> str:
        return TEXT

    def reader(self, schema) -> DataSourceReader:
        return TextReader(self.options)


class FastqSource(TextSource):
    @classmethod
    def name(cls) -> str:
        return "mudlark_fastq"

    def schema(self) -> str:
        return FASTQ

    def reader(self, schema) -> DataSourceReader:
        return FastqReader(self.options)


def in_ranges(spark: SparkSession, source: type[DataSource], path, range_bytes: int = RANGE):
    """A path's, or several paths', rows read in byte ranges."""
    spark.dataSource.register(source)
    paths = [path] if isinstance(path, str) else [str(p) for p in path]
    return spark.read.format(source.name()).option("paths", json.dumps(paths)).option("rangeBytes", str(range_bytes)).load()
