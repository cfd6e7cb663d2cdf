"""A data source for folders of JSON log lines: files in order of name, each line with its file and place, in batch or as a tail.

    spark.dataSource.register(LogFolder)
    spark.read.format("log_folder").load("file:///runs/log")
    spark.readStream.format("log_folder").load("file:///runs/log")

A partition is a range of a file's bytes; a line belongs to the range in which it begins.  Equality tests on ``file``, ``event`` and ``run_id`` come to
the source: the first leaves files out before they are opened, the others let lines go that don't have the value as a substring before they are
parsed; Spark tests what is left.  The tail's offset has the length of each file up to its last line feed, so a restart goes on where the
last committed batch ended, lines that are being written are read when they are whole, and new files are found.  Paths are opened through Arrow's file
systems, so executors must reach the folder.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, InputPartition

SCHEMA = "file string, pos long, value string, event string, run_id string"
#: Fields that are read from each line as columns.
FIELDS = ("event", "run_id")


def _open(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path if "://" in path else f"file://{path}")


@dataclass
class Piece(InputPartition):
    file: str
    begin: int
    end: int

    def __post_init__(self):
        self.value = (self.file, self.begin, self.end)


class _Folder:
    """What batch and tail share."""

    def __init__(self, options):
        self.path, self.suffix = options["path"].rstrip("/"), options.get("suffix", ".jsonl")
        self.block = int(options.get("block", 32 << 20))
        self.wanted: dict[str, str] = {}

    def sizes(self) -> dict[str, int]:
        """Files by name and their lengths, in order of name; no folder has no files."""
        from pyarrow import fs

        system, root = _open(self.path)
        found = system.get_file_info(fs.FileSelector(root, allow_not_found=True))
        return {f.base_name: f.size for f in sorted(found, key=lambda f: f.base_name) if f.is_file and f.base_name.endswith(self.suffix) and not f.base_name.startswith((".", "_"))}

    def whole(self, name: str, size: int, begin: int = 0) -> int:
        """The place behind the file's last line feed before ``size``."""
        system, root = _open(self.path)
        with system.open_input_file(f"{root}/{name}") as f:
            at = size
            while at > begin:
                low = max(begin, at - (1 << 16))
                f.seek(low)
                cut = f.read(at - low).rfind(b"\n")
                if cut >= 0:
                    return low + cut + 1
                at = low
        return begin

    def pieces(self, ranges: dict[str, tuple[int, int]]) -> list[Piece]:
        names = [n for n in ranges if self.wanted.get("file", n) == n]
        return [Piece(n, a, min(a + self.block, ranges[n][1])) for n in names for a in range(*ranges[n], self.block)]

    def lines(self, piece: Piece) -> Iterator[tuple[int, bytes]]:
        """Lines that begin in the piece, the last one read to its end."""
        system, root = _open(self.path)
        with system.open_input_file(f"{root}/{piece.file}") as f:
            size, at = f.size(), piece.begin
            rest = b""
            if at:  # a line that began before belongs to the piece before, unless this is where one ends
                f.seek(at - 1)
                before = f.read(1)
                if before != b"\n":
                    while at < size:
                        f.seek(at)
                        part = f.read(1 << 16)
                        if (cut := part.find(b"\n")) >= 0:
                            at += cut + 1
                            break
                        at += len(part)
            f.seek(at)
            while at < piece.end or rest:
                part = f.read(1 << 20)
                data = rest + part
                start = 0
                while at < piece.end and (cut := data.find(b"\n", start)) >= 0:
                    yield at, data[start:cut]
                    at += cut + 1 - start
                    start = cut + 1
                rest = data[start:] if at < piece.end else b""
                if not part:
                    if rest:
                        yield at, rest
                    return

    def rows(self, piece: Piece | None) -> Iterator[tuple]:
        """A piece's lines; Spark asks for None where there are no pieces."""
        if piece is None:
            return
        tests = [self.wanted[f].encode() for f in FIELDS if f in self.wanted and self.wanted[f].isascii() and not set(self.wanted[f]) & {'"', "\\", "/"} and self.wanted[f].isprintable()]
        for at, line in self.lines(piece):
            if not line.strip() or any(t not in line for t in tests):
                continue
            text = line.decode("utf-8", "replace").rstrip("\r")
            try:
                got = json.loads(text)
            except ValueError:
                got = None
            fields = [got.get(f) if isinstance(got, dict) else None for f in FIELDS]
            yield (piece.file, at, text, *(x if isinstance(x, str) else None if x is None else json.dumps(x) for x in fields))


class _Batch(_Folder, DataSourceReader):
    def pushFilters(self, filters):
        for f in filters:
            if isinstance(f, EqualTo) and len(f.attribute) == 1 and f.attribute[0] in ("file", *FIELDS) and isinstance(f.value, str):
                self.wanted[f.attribute[0]] = f.value
            yield f  # Spark tests them all again

    def partitions(self):
        return self.pieces({n: (0, size) for n, size in self.sizes().items()})

    def read(self, partition):
        return self.rows(partition)


class _Tail(_Folder, DataSourceStreamReader):
    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        return {n: self.whole(n, size) for n, size in self.sizes().items()}

    def partitions(self, start: dict, end: dict):
        return self.pieces({n: (start.get(n, 0), stop) for n, stop in sorted(end.items()) if stop > start.get(n, 0)})

    def read(self, partition):
        return self.rows(partition)


class LogFolder(DataSource):
    """Options: path; suffix (.jsonl); block (bytes of a partition, 32 MiB)."""

    @classmethod
    def name(cls) -> str:
        return "log_folder"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Batch(self.options)

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _Tail(self.options)


def _registered(spark: SparkSession) -> None:
    spark.dataSource.register(LogFolder)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def read_log(spark: SparkSession, folder: str, **options) -> DataFrame:
    _registered(spark)
    return spark.read.format("log_folder").options(**options).load(folder)


def tail_log(spark: SparkSession, folder: str, **options) -> DataFrame:
    _registered(spark)
    return spark.readStream.format("log_folder").options(**options).load(folder)
