"""SGML files as a data source, the same for batches and streams.

    register(spark)
    spark.read.format("sgml_documents").load("s3://archive/sgml")

Files are read through Arrow's file systems (local, HDFS, S3, GCS, Azure) in ranges that
any number of tasks share; a document belongs to the range in which it begins. Where it
begins does not depend on the ranges, so neither do ids. Documents come out in bounded
Arrow batches; one longer than ``longest`` bytes comes in parts of that size.

Options: ``pattern`` (searched in file names), ``split`` (bytes of a range), ``longest``,
``perFile`` (stop after so many closed documents of a file; what follows is not read),
and ``log`` for streams.
"""

from __future__ import annotations

import json
import posixpath
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    DataSourceStreamReader,
    InputPartition,
)

from smudgelex.plans.workers import ship
from smudgelex.sources.boundaries import BLOCK, LONGEST, look_back, pieces

NAME = "sgml_documents"
SCHEMA = "value string, source string, begin bigint, part int, state string"
SPLIT = 64 * 1024 * 1024
BATCH = 8 * 1024 * 1024
# Fixed value: names that do not start with a dot and have two characters or more.
DEFAULT_PATTERN = r"^[^\.].+"
_COMPRESSED = (".gz", ".bz2", ".zst", ".lz4", ".br")


def file_system(root: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    if "://" not in root and not root.startswith("file:"):
        return pafs.LocalFileSystem(), posixpath.abspath(root)
    if root.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + root.removeprefix("file:").lstrip("/")
    return pafs.FileSystem.from_uri(root)


def list_files(root: str, pattern: str) -> list[tuple[str, int]]:
    """Paths and sizes of the files below ``root``, in the order of their paths."""
    fs, path = file_system(root)
    info = fs.get_file_info(path)
    if info.type == pafs.FileType.File:
        found = [info]
    else:
        found = fs.get_file_info(pafs.FileSelector(path, recursive=True, allow_not_found=True))
    name = re.compile(pattern)
    return sorted((f.path, f.size or 0) for f in found if f.is_file and name.search(f.base_name))


@dataclass
class Ranges(InputPartition):
    """Ranges ``(path, begin, end)`` of files that one task reads; no end is the file's."""

    ranges: list[tuple[str, int, int | None]]


def plan(files: Sequence[tuple[str, int]], split: int, whole: bool) -> list[Ranges]:
    """Large files in several ranges, small ones together; compressed ones are whole."""
    out, held = [], 0
    for path, size in files:
        step = size if whole or path.endswith(_COMPRESSED) else split
        for begin in range(0, max(size, 1), max(step, 1)):
            last = begin + step >= size
            length = min(step, size - begin) + 4096
            if not out or held + length > split:
                out.append(Ranges([]))
                held = 0
            out[-1].ranges.append((path, begin, None if last else begin + step))
            held += length
    return out


class _Corpus:
    """What batch and stream readers share."""

    def __init__(self, options: dict[str, str]):
        if "path" not in options:
            raise ValueError(f"{NAME} needs a path")
        self.root = options["path"]
        self.pattern = options.get("pattern", DEFAULT_PATTERN)
        self.split = int(options.get("split", SPLIT))
        self.longest = int(options.get("longest", LONGEST))
        per_file = options.get("perfile", options.get("perFile"))
        self.per_file = None if per_file is None else int(per_file)
        re.compile(self.pattern)

    def plan(self, files: Sequence[tuple[str, int]]) -> list[Ranges]:
        return plan(files, self.split, self.per_file is not None)

    def read(self, partition: Ranges) -> Iterator[pa.RecordBatch]:
        fs, _ = file_system(self.root)
        held, size = [], 0
        for path, begin, end in partition.ranges:
            for row in self._documents(fs, path, begin, end):
                held.append(row)
                size += len(row[0])
                if size >= BATCH:
                    yield _batch(held)
                    held, size = [], 0
        if held:
            yield _batch(held)

    def _documents(self, fs: pafs.FileSystem, path: str, begin: int, end: int | None) -> Iterator[tuple]:
        # Little is read at a time where little is wanted.
        block = BLOCK if self.per_file is None else 1 << 16
        closed = 0
        if self.per_file == 0:
            return
        if path.endswith(_COMPRESSED):
            stream, at = fs.open_input_stream(path, compression="detect"), 0
        else:
            stream = fs.open_input_file(path)
            at = look_back(lambda a, n: stream.read_at(n, a), begin) if begin else 0
            stream.seek(at)
        with stream:
            for piece in pieces(stream.read, at, begin, end, block, self.longest):
                state = "whole" if piece.whole else "last part" if piece.ended else "part"
                if piece.whole and piece.data.isspace():
                    continue
                yield piece.data, path, piece.begin, piece.part, state
                closed += state == "whole" and piece.data.endswith(b"</DOC>")
                if closed == self.per_file:
                    return


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    values, sources, begins, parts, states = zip(*rows)
    columns = [
        pa.array([v.decode("utf-8", "replace") for v in values], pa.string()),
        pa.array(sources, pa.string()),
        pa.array(begins, pa.int64()),
        pa.array(parts, pa.int32()),
        pa.array(states, pa.string()),
    ]
    return pa.RecordBatch.from_arrays(columns, names=["value", "source", "begin", "part", "state"])


class CorpusReader(_Corpus, DataSourceReader):
    def partitions(self) -> list[Ranges]:
        return self.plan(list_files(self.root, self.pattern)) or [Ranges([])]


class CorpusStream(_Corpus, DataSourceStreamReader):
    """New files, each once.

    Every offset is the number of a list of files, written to the folder ``log`` before
    Spark hears of it; so a batch that is run again reads the same files, whatever has
    arrived since, and a file that comes late with an old date is not missed. A query
    that starts with a new checkpoint goes through all lists anew.
    """

    def __init__(self, options: dict[str, str]):
        super().__init__(options)
        if "log" not in options:
            raise ValueError("a stream needs a folder for its log")
        self.log_fs, self.log = file_system(options["log"])
        self.log_fs.create_dir(self.log, recursive=True)
        self.known: set[str] = set()
        self.last = 0

    def _list(self, number: int) -> str:
        return f"{self.log}/{number:09d}.json"

    def _files(self, number: int) -> list[tuple[str, int]]:
        with self.log_fs.open_input_stream(self._list(number)) as f:
            return [(path, size) for path, size in json.loads(f.read())]

    def initialOffset(self) -> dict:
        return {"list": 0}

    def latestOffset(self) -> dict:
        while self.log_fs.get_file_info(self._list(self.last + 1)).type == pafs.FileType.File:
            self.last += 1
            self.known.update(path for path, _ in self._files(self.last))
        new = [f for f in list_files(self.root, self.pattern) if f[0] not in self.known]
        if new:
            # A list is there as a whole or not at all.
            draft = f"{self.log}/draft"
            with self.log_fs.open_output_stream(draft) as f:
                f.write(json.dumps(new).encode())
            self.log_fs.move(draft, self._list(self.last + 1))
            self.last += 1
            self.known.update(path for path, _ in new)
        return {"list": self.last}

    def partitions(self, start: dict, end: dict) -> list[Ranges]:
        files = [f for n in range(start["list"] + 1, end["list"] + 1) for f in self._files(n)]
        return self.plan(files) or [Ranges([])]


class CorpusSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> CorpusReader:
        return CorpusReader(dict(self.options))

    def streamReader(self, schema) -> CorpusStream:
        return CorpusStream(dict(self.options))


def register(spark: SparkSession) -> None:
    ship(spark)
    spark.dataSource.register(CorpusSource)
