"""FASTQ files as a data source: spark.read.format("fastq").

A file is cut into ranges of bytes, and each range is moved to the beginnings of records inside its own task, so that no
line is shuffled and no pass counts lines before. Gzip files can't be cut; each is read by one task.
"""

from __future__ import annotations

import gzip
import json
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

SCHEMA = "file string, pos long, read_id string, seq string, qual string"
CHUNK, SPLIT = 4 << 20, 128 << 20


def located(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") or path.startswith("/") else f"/{path}")


def reachable(path: str) -> bool:
    """Whether the path is one that tasks can open without Spark's readers."""
    try:
        system, inner = located(path)
        return system.get_file_info(inner).type != fs.FileType.NotFound
    except (pa.ArrowException, OSError, ValueError):
        return False


@dataclass
class Piece(InputPartition):
    """The records whose headers begin in bytes start to end of a file."""

    path: str
    start: int
    end: int


def complete(lines: list[bytes]) -> int:
    """The first of a few lines that begins a record: @ on it and + on the line after next. A quality line may begin with @, but the line after next is then a sequence."""
    return next((i for i in range(len(lines) - 2) if lines[i].startswith(b"@") and lines[i + 2].startswith(b"+")), -1)


def records(stream, start: int, end: int) -> Iterator[tuple[list[int], list[bytes], list[bytes], list[bytes]]]:
    """(positions, headers, sequences, qualities) of the records whose headers begin from start and before end, a chunk at a time; a record that is cut off at the end of the file is left out."""
    at, rest, aligned = max(start - 1, 0), b"", start == 0
    stream.seek(at)
    if not aligned:
        # up to the first line that begins at start or behind it
        while True:
            data = stream.read(CHUNK)
            cut = data.find(b"\n")
            if not data or cut >= 0:
                rest, at = (data[cut + 1 :], at + cut + 1) if data else (b"", at)
                break
            at += len(data)
    while at < end:
        data = stream.read(CHUNK)
        text = rest + data
        if not data and text and not text.endswith(b"\n"):
            text += b"\n"
        lines = text.split(b"\n")
        rest = lines.pop()
        if not aligned:
            first = complete(lines)
            if first < 0:
                if not data:
                    return
                rest = text
                continue
            at += sum(len(x) + 1 for x in lines[:first])
            lines, aligned = lines[first:], True
        n = len(lines) // 4 * 4
        rest = b"".join(x + b"\n" for x in lines[n:]) + rest
        positions, headers = [], []
        for i in range(0, n, 4):
            if at >= end:
                n = i
                break
            positions.append(at)
            at += sum(map(len, lines[i : i + 4])) + 4
        headers = lines[0:n:4]
        if headers:
            yield positions, headers, lines[1:n:4], lines[3:n:4]
        if not data or (n < len(lines) // 4 * 4):
            return


class FastqReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        paths = json.loads(options["paths"]) if "paths" in options else [options["path"]]
        self.paths, self.split = paths, int(options.get("splitbytes", SPLIT))

    def partitions(self) -> list[InputPartition]:
        found = []
        for path in self.paths:
            system, inner = located(path)
            info = system.get_file_info(inner)
            files = [info] if info.is_file else system.get_file_info(fs.FileSelector(inner, recursive=True)) if info.type == fs.FileType.Directory else None
            if files is None:
                raise FileNotFoundError(path)
            prefix = path[: len(path) - len(inner)] if path.endswith(inner) else path.split("//")[0] + "//" if "://" in path else ""
            for f in files:
                hidden = any(p.startswith(("_", ".")) for p in f.path[len(inner) :].split("/"))
                if f.is_file and not hidden:
                    step = f.size if f.path.endswith(".gz") else self.split
                    found += [Piece(prefix + f.path, at, min(at + step, f.size)) for at in range(0, f.size, max(step, 1))]
        return found or [Piece("", 0, 0)]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        if not partition.path:
            return
        system, inner = located(partition.path)
        packed = inner.endswith(".gz")
        with system.open_input_file(inner) as raw:
            stream = gzip.GzipFile(fileobj=raw) if packed else raw
            for pos, head, seq, qual in records(stream, partition.start, 1 << 62 if packed else partition.end):
                text = lambda x: pc.utf8_rtrim(pa.array(x, pa.binary()).cast(pa.string()), "\r")
                name = pc.replace_substring_regex(text(head), r"^@?(\S*)[\s\S]*$", r"\1")
                yield pa.RecordBatch.from_arrays([pa.array([partition.path] * len(pos), pa.string()), pa.array(pos, pa.int64()), name, text(seq), text(qual)], ["file", "pos", "read_id", "seq", "qual"])


class FastqSource(DataSource):
    """file, pos (the record's first byte, after decompression), read_id (the header up to white space), seq, qual.

    Options: path or paths (a JSON list) of files or folders, hidden ones left out; splitbytes.
    """

    @classmethod
    def name(cls) -> str:
        return "fastq"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> DataSourceReader:
        return FastqReader(dict(self.options))
