"""Spool folders as a stream of listings: whole files in consume order, checked for changes.

A batch is a list of files (path, time, length) that the driver plans from names and sizes
alone; the list is the batch's offset, so a repeated batch reads the same files or fails.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from eventflow.functions.text import decode_text
from eventflow.sources.files import DEFAULT_SUFFIX, MAX_BLOB, _cut_lines, _file_headers
from eventflow.sources.tail import _filesystem

FORMAT = "spool_files"
READ_BYTES = 1 << 22
DEFAULT_RANGE = 64 << 20
DEFAULT_FILES = 1000
ROWS = pa.schema([("path", pa.string()), ("empty", pa.bool_()), ("value", pa.binary())])


class FileChanged(RuntimeError):
    """A file that was listed changed, or is gone, before it was read to its end."""


@dataclass
class FileRange(InputPartition):
    path: str
    modified: int
    length: int
    start: int
    stop: int


def _is_file(info: pafs.FileInfo, path: str, modified: int, length: int) -> bool:
    return info.type == pafs.FileType.File and info.size == length and (info.mtime_ns or 0) == modified


class _Folder:
    """What is in a spool folder, and which of it was planned already."""

    def __init__(self, options: dict):
        self.uri = options["path"]
        self.fs, self.base = _filesystem(self.uri)
        self.state_fs, self.state = _filesystem(options["statepath"])
        self.include, self.ignore = re.compile(options["include"]), re.compile(options["ignore"])
        self.suffix, self.recursive = options["suffix"], options["recursive"] == "true"
        self.order, self.seed = options["order"], options["seed"]
        self.most = int(options["maxfiles"])
        self.policy, self.archive = options["deletepolicy"], options.get("archivedir")
        self.range_bytes, self.blob = int(options["rangebytes"]), int(options["blob"])

    def taken(self, path: str) -> bool:
        *dirs, name = path[len(self.base.rstrip("/")) + 1 :].split("/")
        if name.startswith(".") or name.endswith(self.suffix) or self.ignore.fullmatch(name):
            return False
        if any(d.startswith(".") or self.ignore.fullmatch(d) for d in dirs):
            return False
        return self.include.fullmatch(name) is not None

    def listing(self) -> list[list]:
        """[path, time, length] of the candidates in consume order."""
        selector = pafs.FileSelector(self.base, recursive=self.recursive, allow_not_found=True)
        files = [
            [i.path, i.mtime_ns or 0, i.size] for i in self.fs.get_file_info(selector)
            if i.type == pafs.FileType.File and self.taken(i.path)
        ]
        if self.order == "random":
            return sorted(files, key=lambda f: hashlib.sha256(f"{self.seed}:{f[0]}".encode()).digest())
        sign = -1 if self.order == "youngest" else 1
        return sorted(files, key=lambda f: (sign * f[1], f[0]))

    def planned(self) -> dict[int, list[list]]:
        """Files of each batch planned before, by its number."""
        selector = pafs.FileSelector(self.state, allow_not_found=True)
        out = {}
        for info in self.state_fs.get_file_info(selector):
            if info.base_name.endswith(".json"):
                with self.state_fs.open_input_stream(info.path) as handle:
                    out[int(info.base_name[:-5])] = json.loads(handle.read())
        return out

    def remember(self, number: int, files: list[list]) -> None:
        self.state_fs.create_dir(self.state, recursive=True)
        own = f"{self.state}/{number}.json"
        with self.state_fs.open_output_stream(own + ".new") as handle:
            handle.write(json.dumps(files).encode())
        self.state_fs.move(own + ".new", own)

    def retire(self, files: list[list]) -> None:
        """Apply the delete policy to files that were delivered; repeating it does nothing."""
        for path, modified, length in files:
            [info] = self.fs.get_file_info([path])
            if not _is_file(info, path, modified, length):
                continue  # retired before, or written anew since
            if self.policy == "immediate":
                self.fs.delete_file(path)
            elif self.policy == "rename":
                self.fs.move(path, path + self.suffix)
            elif self.policy == "archive":
                _, folder = _filesystem(self.archive)
                target = f"{folder.rstrip('/')}/{path[len(self.base.rstrip('/')) + 1 :]}"
                self.fs.create_dir(target.rpartition("/")[0], recursive=True)
                self.fs.move(path, target)


class SpoolFiles(DataSource):
    """``format("spool_files")``; see ``stream_spool_files``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self):
        return "path string, empty boolean, value binary"

    def streamReader(self, schema) -> DataSourceStreamReader:
        return SpoolFilesReader(self.options)


class SpoolFilesReader(DataSourceStreamReader):
    def __init__(self, options):
        self.options = dict(options)
        self.folder = _Folder(self.options)
        self.seen: set[tuple] | None = None
        self.last: dict = {"batch": 0, "files": []}

    def __getstate__(self):
        return {"options": self.options}

    def __setstate__(self, state):
        self.__init__(state["options"])

    def initialOffset(self) -> dict:
        return {"batch": 0, "files": []}

    def latestOffset(self) -> dict:
        if self.seen is None:
            held = self.folder.planned()
            self.seen = {tuple(f) for files in held.values() for f in files}
            if held and max(held) > self.last["batch"]:
                self.last = {"batch": max(held), "files": held[max(held)]}
        new = [f for f in self.folder.listing() if tuple(f) not in self.seen][: self.folder.most]
        if new:
            self.last = {"batch": self.last["batch"] + 1, "files": new}
            self.seen.update(map(tuple, new))
        return self.last

    def partitions(self, start: dict, end: dict):
        files = end["files"] if end["batch"] != start["batch"] else []
        if not files:
            return [FileRange("", 0, 0, 0, 0)]
        # A batch is planned here before it runs, also one repeated after a restart.
        self.folder.remember(end["batch"], files)
        if self.seen is not None:
            self.seen.update(map(tuple, files))
        self.last = max(self.last, end, key=lambda o: o["batch"])
        found = self.folder.fs.get_file_info([f[0] for f in files])
        out = []
        for info, (path, modified, length) in zip(found, files):
            if not _is_file(info, path, modified, length):
                raise FileChanged(f"file changed since it was listed: {path}")
            step = length if self.folder.blob else self.folder.range_bytes
            for at in range(0, max(length, 1), max(step, 1)):
                out.append(FileRange(path, modified, length, at, min(at + step, length)))
        return out

    def read(self, partition) -> Iterator[pa.RecordBatch]:
        if not partition.path:
            return
        fs = self.folder.fs
        if not partition.length:
            yield _rows(partition.path, [b""], True)
        elif self.folder.blob:
            with fs.open_input_file(partition.path) as handle:
                while piece := handle.read(self.folder.blob):
                    yield _rows(partition.path, [piece], False)
        else:
            yield from _lines(fs, partition)
        [info] = fs.get_file_info([partition.path])
        if not _is_file(info, partition.path, partition.modified, partition.length):
            raise FileChanged(f"file changed while it was read: {partition.path}")

    def commit(self, end: dict) -> None:
        self.folder.retire(end["files"])


def _rows(path: str, values: list[bytes], empty: bool) -> pa.RecordBatch:
    n = len(values)
    return pa.record_batch([pa.array([path] * n, pa.string()), pa.array([empty] * n), pa.array(values, pa.binary())], schema=ROWS)


def _lines(fs, part: FileRange) -> Iterator[pa.RecordBatch]:
    """Lines that start in the range; only the one that ends beyond it is read on."""
    with fs.open_input_file(part.path) as handle:
        handle.seek(part.start)
        at, held, skip = part.start, b"", False
        if part.start:
            handle.seek(part.start - 1)
            skip = handle.read(1) != b"\n"
        pieces: list[bytes] = []
        while True:
            beyond = at >= part.stop
            if beyond and (skip or not (pieces or held)):
                return  # no line that starts here is open
            block = handle.read(min(READ_BYTES, (part.length if beyond else part.stop) - at))
            if not block:
                if pieces and not skip:  # the last line lacks its newline
                    yield _rows(part.path, [b"".join(pieces)], False)
                return
            at += len(block)
            if skip:
                first = block.find(b"\n")
                if first < 0:
                    continue  # still inside a line that began earlier
                block, skip = block[first + 1 :], False
            if beyond:
                end = block.find(b"\n")
                if end < 0:
                    pieces.append(block)
                    continue
                yield _rows(part.path, [b"".join([*pieces, block[:end]])], False)
                return
            *whole, rest = block.split(b"\n")
            if whole:
                whole[0] = b"".join([*pieces, whole[0]])
                yield _rows(part.path, whole, False)
                pieces = []
            if rest:
                pieces.append(rest)


def stream_spool_files(
    spark: SparkSession,
    path: str,
    state_path: str,
    *,
    include: str = "^.*$",
    ignore: str = "^$",
    suffix: str = DEFAULT_SUFFIX,
    recursive: bool = False,
    order: str = "oldest",
    seed: int = 0,
    delete_policy: str = "never",
    archive_dir: str | None = None,
    max_files_per_trigger: int = DEFAULT_FILES,
    range_bytes: int = DEFAULT_RANGE,
    deserializer: str = "LINE",
    max_blob_length: int = MAX_BLOB,
    max_line_length: int = 2048,
    charset: str = "UTF-8",
    output_charset: str = "UTF-8",
    file_header: str | None = None,
    basename_header: str | None = None,
    decode_policy: str = "FAIL",
    compat: bool = False,
) -> DataFrame:
    """Events of the files of a spool folder, each file once, as a stream.

    A batch takes the next ``max_files_per_trigger`` files, oldest (ties by name), youngest
    or, by ``seed``, random first; its events follow that order. Large files are cut into
    ranges of ``range_bytes``. An empty file gives one event with an empty body. A planned
    file that changes its time or length, or goes, before the batch has read it fails the
    batch. A name that is used again with another time or length is a new file.

    ``state_path`` (one for each stream, in a folder that outlives it) lists the files of
    each planned batch, so that a restart neither misses nor repeats one. ``delete_policy``
    says what becomes of delivered files: never, rename (the suffix is added), immediate or
    archive. Folders must be reachable from every executor through Arrow's file systems.
    """
    if order not in ("oldest", "youngest", "random"):
        raise ValueError("order must be oldest, youngest or random")
    if delete_policy not in ("never", "rename", "immediate", "archive"):
        raise ValueError("delete_policy must be never, rename, immediate or archive")
    if delete_policy == "archive" and not archive_dir:
        raise ValueError("delete_policy 'archive' needs archive_dir")
    if deserializer.upper() not in ("LINE", "BLOB"):
        raise ValueError("deserializer must be LINE or BLOB")
    spark.dataSource.register(SpoolFiles)
    options = {
        "path": _uri(path), "statepath": _uri(state_path), "include": include, "ignore": ignore, "suffix": suffix,
        "recursive": str(recursive).lower(), "order": order, "seed": str(seed), "maxfiles": str(max_files_per_trigger),
        "deletepolicy": delete_policy, "rangebytes": str(range_bytes),
        "blob": str(max_blob_length if deserializer.upper() == "BLOB" else 0),
    }
    if archive_dir:
        options["archivedir"] = _uri(archive_dir)
    files = spark.readStream.format(FORMAT).options(**options).load()
    if deserializer.upper() == "BLOB":
        headers = _file_headers(file_header, basename_header, F.col("path")).alias("headers")
        return files.select(headers, F.col("value").alias("body"))
    lines = files.select(decode_text(F.col("value"), decode_policy, charset).alias("value"), F.col("path").alias("_path"))
    # An empty file is one empty line here, and one event like any empty line.
    return _cut_lines(lines, max_line_length, output_charset, compat, file_header, basename_header)


def _uri(path: str) -> str:
    """A folder as Arrow's file systems name it."""
    return path if re.match(r"^[a-z][a-z0-9+.-]*:", path) else f"file://{path}"
