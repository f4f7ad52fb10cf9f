"""Growing files as a Spark data source: new complete lines since the last position.

Works in batch (``spark.read``) and streaming (``spark.readStream``). The driver lists
files; executors read byte ranges, so one hot file is spread over many tasks.
"""

from __future__ import annotations

import hashlib
import json
import logging
import re
import time
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    DataSourceStreamReader,
    InputPartition,
)

from eventflow.schema import EVENT_SCHEMA

log = logging.getLogger(__name__)
FORMAT = "growing_files"
BYTE_OFFSET_HEADER = "byteoffset"  # fixed value
BLOCK = 1 << 16
READ_BYTES = 1 << 22
NEWLINE, RETURN = 10, 13
PLANNED = ".planned"
DEFAULT_RANGE = 64 << 20
DEFAULT_IDLE_SECONDS = 120.0


@dataclass
class ByteRange(InputPartition):
    path: str
    first: int  # first byte not yet delivered of the whole slice
    start: int
    stop: int
    end: int  # end of the whole slice
    headers: dict
    flush: bool = True  # an unfinished last line is due
    table: str = ""  # folder of line ends: lines then belong to the range they end in
    key: str = ""  # the file's name there
    begin: int = 0  # start of the whole slice; ``first`` may lie before it, in an open line


def _filesystem(uri: str):
    """(file system, path) of a folder or file; Spark's S3 scheme names are accepted."""
    return pafs.FileSystem.from_uri(re.sub(r"^s3[an]:", "s3:", uri))


NO_RANGE = ByteRange("", 0, 0, 0, 0, {"u": "", "h": {}})


class _Settings:
    """Options of one read: file groups, headers and limits."""

    def __init__(self, options: dict):
        groups = json.loads(options["groups"])
        self.groups = {name: (d, re.compile(rx)) for name, (d, rx) in groups.items()}
        if not self.groups:
            raise ValueError("at least one file group is required")
        # Option names are case-insensitive in Spark, their values are not.
        self.group_headers = json.loads(options.get("groupheaders", "{}"))
        self.positions = parse_positions(options.get("positions", "[]"))
        self.skip_to_end = options.get("skiptoend", "false").lower() == "true"
        self.byte_offset = options.get("byteoffset", "false").lower() == "true"
        self.file_header = options.get("fileheader") or None
        self.idle_seconds = float(options.get("idleseconds", "-1"))
        self.range_bytes = int(options.get("rangebytes", DEFAULT_RANGE))
        self.state_path = options.get("statepath") or None
        self.budget = int(options.get("maxbytes", "0"))
        self.log_gone = options.get("loggone", "false").lower() == "true"

    def files(self, known: set[int] = frozenset()) -> list[dict]:
        """Matching files of every group, oldest first.

        A file whose inode is ``known`` belongs to its group under a name that does not
        match, too: it was rotated.
        """
        found = {}
        for group, (directory, pattern) in self.groups.items():
            fs, base = _filesystem(directory)
            for info in fs.get_file_info(pafs.FileSelector(base, recursive=False, allow_not_found=True)):
                if info.type != pafs.FileType.File:
                    continue
                inode = _inode(fs, info.path)
                matches = pattern.fullmatch(info.base_name) is not None
                if matches or (inode and inode in known):
                    found.setdefault(
                        info.path,
                        {
                            "path": info.path,
                            "uri": directory,
                            "size": info.size,
                            "mtime": info.mtime_ns or 0,
                            "inode": inode,
                            "rotated": not matches,
                            "group": group,
                        },
                    )
        return sorted(found.values(), key=lambda f: (f["mtime"], f["path"]))

    def flushes(self, f: dict) -> bool:
        """Whether an unfinished last line is due: the file has not changed for long enough."""
        return self.idle_seconds >= 0 and time.time_ns() - f["mtime"] > self.idle_seconds * 1e9

    def headers_of(self, f: dict) -> dict:
        headers = dict(self.group_headers.get(f["group"], {}))
        if self.file_header:
            headers[self.file_header] = f["path"]
        return headers


def _inode(fs, path: str) -> int:
    """File identity; stores without inodes report 0 and rely on the path alone."""
    if isinstance(fs, pafs.LocalFileSystem):
        import os

        return os.stat(path).st_ino
    return 0


def parse_positions(text: str) -> dict[str, list[int]]:
    """``[{"inode":…, "pos":…, "file":…}]`` to ``{file: [inode, pos, epoch]}``.

    The epoch counts restarts of the same file at 0 (it was truncated).
    """
    out = {}
    for entry in json.loads(text):
        for key in ("inode", "pos", "file"):
            if entry.get(key) is None:
                raise ValueError(f"position entry lacks '{key}': {entry}")
        out[entry["file"]] = [int(entry["inode"]), int(entry["pos"]), int(entry.get("epoch", 0))]
        if "flushed" in entry:
            out[entry["file"]].append(int(entry["flushed"]))
    return out


def render_positions(offset: dict) -> str:
    """Positions as the list accepted by the ``positions`` option."""
    return json.dumps(
        [
            {"inode": inode, "pos": pos, "file": path, "epoch": epoch, **({"flushed": flag[0]} if flag else {})}
            for path, (inode, pos, epoch, *flag) in sorted(offset.items())
        ]
    )


def _begin(f: dict, known: dict, skip_to_end: bool) -> tuple[int, int]:
    """(position, epoch) to resume at: same path and inode, and the file has not shrunk.

    A rotated file goes on where it was; a file renamed to another matching name is new.
    """
    seen = known.get(f["path"])
    if seen is None or seen[0] != f["inode"]:
        same = [e for e in known.values() if f["rotated"] and e[0] == f["inode"]]
        if not same:
            return (f["size"] if skip_to_end else 0), 0
        seen = max(same, key=lambda e: (e[2], e[1]))
    return (0, seen[2] + 1) if f["size"] < seen[1] else (seen[1], seen[2])


def _last_line_end(path: str, uri: str, begin: int, size: int) -> int:
    """Offset after the last newline in ``[begin, size)``, or ``begin``."""
    fs, _ = _filesystem(uri)
    with fs.open_input_file(path) as handle:
        stop = size
        while stop > begin:
            start = max(begin, stop - BLOCK)
            handle.seek(start)
            at = handle.read(stop - start).rfind(b"\n")
            if at >= 0:
                return start + at + 1
            stop = start
    return begin


def _next_line_end(path: str, uri: str, begin: int, size: int) -> int:
    """Offset after the first newline in ``[begin, size)``, or ``begin``."""
    fs, _ = _filesystem(uri)
    with fs.open_input_file(path) as handle:
        handle.seek(begin)
        at = begin
        while at < size and (block := handle.read(min(BLOCK, size - at))):
            found = block.find(b"\n")
            if found >= 0:
                return at + found + 1
            at += len(block)
    return begin


def share(pending: dict[str, int], budget: int) -> dict[str, int]:
    """The budget dealt over files: what one leaves is dealt to those that have more.

    Files come in turn; where the budget has no byte for each, the first ones get theirs.
    """
    if budget < len(pending):
        return {path: int(i < budget) for i, path in enumerate(pending)}
    out, left, waiting = {}, budget, len(pending)
    for path in sorted(pending, key=pending.get):
        out[path] = min(pending[path], left // waiting)
        left, waiting = left - out[path], waiting - 1
    return out


def _targets(settings: _Settings, known: dict, skip_to_end: bool, turn: int):
    """(file, begin, epoch, idle, limit): how far each file may be read, by its size alone."""
    now, found = time.time_ns(), []
    for f in settings.files({e[0] for e in known.values()}):
        begin, epoch = _begin(f, known, skip_to_end)
        idle = settings.idle_seconds >= 0 and now - f["mtime"] > settings.idle_seconds * 1e9
        found.append((f, begin, epoch, idle))
    pending = {f["path"]: f["size"] - begin for f, begin, _, _ in found if f["size"] > begin}
    at = turn % len(pending) if pending else 0
    pending = dict([*list(pending.items())[at:], *list(pending.items())[:at]])
    dealt = share(pending, settings.budget) if settings.budget else pending
    limits = [(f, begin, epoch, idle, begin + dealt.get(f["path"], 0)) for f, begin, epoch, idle in found]
    return limits, next(iter(pending), None)


def _advance(settings: _Settings, known: dict, skip_to_end: bool, turn: int = 0) -> dict:
    """New positions of all files after their last line end, given the known ones.

    With a budget the file whose turn it is gets one line even if that is longer than its
    share (or alone, if longer than the whole budget), so that no file waits for ever.
    """
    limits, first = _targets(settings, known, skip_to_end, turn)
    out, spent = {}, 0
    ends = {}
    for f, begin, _, idle, limit in sorted(limits, key=lambda x: x[0]["path"] != first):
        end = begin
        if limit > begin:
            whole = limit == f["size"]
            end = limit if whole and idle else _last_line_end(f["path"], f["uri"], begin, limit)
            if end == begin and settings.budget and f["path"] == first:
                end = _next_line_end(f["path"], f["uri"], limit, f["size"]) if not whole else begin
                end = begin if end == limit else end
            if settings.budget and f["path"] != first and spent + end - begin > settings.budget:
                end = begin  # the first file took more than its share
        spent += end - begin
        ends[f["path"]] = end
    for f, _, epoch, _, _ in limits:
        out[f["path"]] = [f["inode"], ends[f["path"]], epoch]
    return out


def _key(path: str, inode: int, epoch: int) -> str:
    """A file's name among the line ends; it stays when the file is rotated."""
    return f"{inode or hashlib.md5(path.encode()).hexdigest()}-{epoch}"


class LineEnds:
    """Where the last line ended in each range that tasks have read, one small file a range."""

    def __init__(self, folder: str):
        self.fs, self.folder = _filesystem(folder)

    def write(self, part: ByteRange, line: int | None) -> None:
        self.fs.create_dir(self.folder, recursive=True)
        held = {"key": part.key, "end": part.end, "carry": part.first, "line": line}
        own = f"{self.folder}/{part.key}-{part.start}-{part.end}"
        fresh = f"{own}.{uuid.uuid4().hex}"  # two attempts of a task may write at once
        with self.fs.open_output_stream(fresh) as handle:
            handle.write(json.dumps(held).encode())
        self.fs.move(fresh, own + ".json")

    def held(self) -> list[tuple[str, dict]]:
        selector = pafs.FileSelector(self.folder, allow_not_found=True)
        out = []
        for info in self.fs.get_file_info(selector):
            if info.base_name.endswith(".json"):
                with self.fs.open_input_stream(info.path) as handle:
                    out.append((info.path, json.loads(handle.read())))
        return out

    def carries(self) -> dict[tuple[str, int], int]:
        """Start of the unfinished line of each slice read, by file and end of the slice."""
        out: dict[tuple[str, int], int] = {}
        for _, e in self.held():
            at = (e["key"], e["end"])
            out[at] = max(out.get(at, 0), e["carry"], e["line"] or 0)
        return out

    def forget(self, ends: dict[str, int]) -> None:
        """Drop what lies before the committed position of each file."""
        for path, e in self.held():
            if e["end"] < ends.get(e["key"], 0):
                self.fs.delete_file(path)


def _sizes(settings: _Settings, known: dict, carries: dict, turn: int = 0) -> dict:
    """New positions by sizes alone: [inode, bytes read, epoch, whether the rest is flushed]."""
    out = {}
    for f, begin, epoch, idle, limit in _targets(settings, known, False, turn)[0]:
        flushed = 0
        if limit == begin:
            seen = known.get(f["path"])
            same = seen is not None and (seen[0], seen[2]) == (f["inode"], epoch)
            flushed = seen[3] if same and len(seen) > 3 else 0
            open_line = carries.get((_key(f["path"], f["inode"], epoch), begin), begin) < begin
            if idle and begin == f["size"] and open_line:
                flushed = 1
        out[f["path"]] = [f["inode"], limit, epoch, flushed]
    return out


def _plan(settings: _Settings, known: dict, target: dict, carries: dict | None = None) -> list[ByteRange]:
    """Byte ranges between two positions, cut at ``range_bytes``.

    With ``carries`` positions are sizes: a slice then goes on from the unfinished line of
    the one before it, and a flushed file gives that line as it is.
    """
    files = settings.files({e[0] for e in target.values()})
    by_path, by_inode = {f["path"]: f for f in files}, {f["inode"]: f for f in files}
    ranges = []
    for path, (inode, end, epoch, *flag) in target.items():
        f = by_path.get(path)
        if f is None or f["inode"] != inode:
            f = by_inode.get(inode) if inode else None  # rotated since
        seen = known.get(path)
        if f is not None and f["rotated"] and (seen is None or seen[0] != inode):
            seen = next((e for e in known.values() if e[0] == inode), None)
        same = seen is not None and (seen[0], seen[2]) == (inode, epoch)
        begin = seen[1] if same else 0
        flush = bool(flag and flag[0]) and not (same and len(seen) > 3 and seen[3])
        if begin > end or (begin == end and not flush):
            continue
        if f is None or f["size"] < end:
            # Nothing can bring these bytes back; what is in the file now comes next.
            if not settings.log_gone:
                raise OSError(f"{path}: bytes {begin} to {end} are gone, the file was removed or cut")
            log.warning("%s: bytes %s to %s are gone, the file was removed or cut", path, begin, end)
            continue
        key, path, headers = _key(path, inode, epoch), f["path"], settings.headers_of(f)
        more = {"u": f["uri"], "h": headers}
        if carries is None:
            for start in range(begin, end, settings.range_bytes):
                stop = min(start + settings.range_bytes, end)
                ranges.append(ByteRange(path, begin, start, stop, end, more, settings.flushes(f)))
            continue
        was_flushed = same and len(seen) > 3 and seen[3]
        carry = begin if was_flushed else carries.get((key, begin), begin)
        table = settings.state_path + ".lines"
        if flush and begin == end:
            ranges.append(ByteRange(path, carry, end, end, end, more, True, table, key, begin))
        for start in range(begin, end, settings.range_bytes):
            stop = min(start + settings.range_bytes, end)
            ranges.append(ByteRange(path, carry, start, stop, end, more, False, table, key, begin))
    return ranges


def _line_batch(data: bytes, base: int, stop: int, fixed: dict, byte_offset: bool):
    """Complete lines of ``data`` that start before ``stop``, as one Arrow batch.

    ``base`` is the file offset of ``data``. Line ends are removed with array operations.
    """
    raw = np.frombuffer(data, dtype=np.uint8)
    ends = np.flatnonzero(raw == NEWLINE)
    starts = np.concatenate([[0], ends[:-1] + 1]).astype(np.int64)
    count = int(np.searchsorted(starts, stop - base))
    if count == 0:
        return None
    starts, ends = starts[:count], ends[:count]
    raw = raw[: ends[-1] + 1]
    keep = raw != NEWLINE
    returns = ends[ends > 0] - 1
    keep[returns[raw[returns] == RETURN]] = False
    offsets = np.concatenate([[0], np.cumsum(keep)[ends]]).astype(np.int64)
    body = pa.Array.from_buffers(
        pa.large_binary(), count, [None, pa.py_buffer(offsets), pa.py_buffer(raw[keep])]
    ).cast(pa.binary())
    keys, values = list(fixed), [pa.array(np.full(count, v, dtype=object), pa.string()) for v in fixed.values()]
    if byte_offset:
        keys.append(BYTE_OFFSET_HEADER)
        values.append(pa.array(starts + base).cast(pa.string()))
    width = len(keys)
    order = np.arange(count * width).reshape(width, count).T.ravel()
    items = pa.concat_arrays(values).take(pa.array(order)) if width else pa.array([], pa.string())
    names = pa.array(np.tile(np.array(keys, dtype=object), count), pa.string())
    headers = pa.MapArray.from_arrays(
        pa.array(np.arange(count + 1, dtype=np.int32) * width), names, items
    )
    return pa.RecordBatch.from_arrays([headers, body], names=["headers", "body"])


def _read_range(part: ByteRange, byte_offset: bool) -> Iterator[pa.RecordBatch]:
    """Lines that start in ``[start, stop)``; the last one may reach past ``stop``."""
    fs, _ = _filesystem(part.headers["u"])
    fixed = part.headers["h"]
    with fs.open_input_file(part.path) as handle:
        skip = False
        if part.start > part.first:
            # A line that began in an earlier range belongs to that range.
            handle.seek(part.start - 1)
            skip = handle.read(1) != b"\n"
        handle.seek(part.start)
        offset = base = part.start  # next byte to read, first byte not yet turned into rows
        held: list[bytes] = []
        while offset < part.end and base < part.stop:
            if skip and offset >= part.stop:
                return  # inside a line of an earlier range, which alone reads on
            block = handle.read(min(READ_BYTES, (part.stop if offset < part.stop else part.end) - offset))
            if not block:
                raise OSError(f"{part.path} was cut while it was read; the batch is planned again")
            offset += len(block)
            cut = block.rfind(b"\n") + 1
            if not cut:
                held.append(block)
                continue
            data = b"".join([*held, block[:cut]])
            held = [block[cut:]]
            if skip:
                first = data.find(b"\n") + 1
                data, base, skip = data[first:], base + first, False
            if data and base < part.stop:
                batch = _line_batch(data, base, part.stop, fixed, byte_offset)
                if batch is not None:
                    yield batch
            base += len(data)
        rest = b"".join(held)
        if rest and part.flush and not skip and base < part.stop and offset >= part.end:
            # Idle file: its unfinished line is due.
            yield _line_batch(rest + b"\n", base, part.stop, fixed, byte_offset)


def _open_line(handle, first: int, stop: int) -> bytes:
    """What lies between the last newline in ``[first, stop)``, or ``first``, and ``stop``."""
    held: list[bytes] = []
    while stop > first:
        start = max(first, stop - BLOCK)
        handle.seek(start)
        block = handle.read(stop - start)
        at = block.rfind(b"\n")
        held.append(block[at + 1 :])
        if at >= 0:
            break
        stop = start
    return b"".join(reversed(held))


def _read_ended(part: ByteRange, byte_offset: bool) -> Iterator[pa.RecordBatch]:
    """Lines that end in the range; where the last one ended is written for the next plan.

    Bytes before the range are read only if a line that began there ends in it.
    """
    fs, _ = _filesystem(part.headers["u"])
    fixed, line = part.headers["h"], None
    with fs.open_input_file(part.path) as handle:
        if part.flush:  # an idle file's unfinished line, from where it began
            handle.seek(part.first)
            rest = handle.read(part.stop - part.first)
            if rest:
                yield _line_batch(rest + b"\n", part.first, part.stop, fixed, byte_offset)
            return
        held: list[bytes] = []
        offset = begin = part.start
        while offset < part.stop:
            handle.seek(offset)
            block = handle.read(min(READ_BYTES, part.stop - offset))
            if not block:
                raise OSError(f"{part.path} was cut while it was read; the batch is planned again")
            cut = block.rfind(b"\n") + 1
            if not cut:
                held.append(block)
            else:
                if line is None:
                    held.insert(0, _open_line(handle, part.first, part.start))
                    begin = part.start - len(held[0])
                yield _line_batch(b"".join([*held, block[:cut]]), begin, offset + cut, fixed, byte_offset)
                line = begin = offset + cut
                held = [block[cut:]]
            offset += len(block)
    LineEnds(part.table).write(part, line)


class GrowingFiles(DataSource):
    """``format("growing_files")``; see ``read_tail`` for the options."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self):
        return EVENT_SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return GrowingFilesReader(self.options)

    def streamReader(self, schema) -> DataSourceStreamReader:
        return GrowingFilesStreamReader(self.options)


class GrowingFilesReader(DataSourceReader):
    def __init__(self, options):
        self.settings = _Settings(options)

    def partitions(self):
        known = self.settings.positions
        start, target = dict(known), {}
        for f, begin, epoch, _, limit in _targets(self.settings, known, self.settings.skip_to_end, 0)[0]:
            path = f["path"]
            target[path] = [f["inode"], limit, epoch]
            if self.settings.skip_to_end and (path not in known or known[path][0] != f["inode"]):
                start[path] = [f["inode"], limit, epoch]
        ranges = _plan(self.settings, start, target)
        return ranges or [NO_RANGE]

    def read(self, partition):
        if partition.path:
            yield from _read_range(partition, self.settings.byte_offset)


class GrowingFilesStreamReader(DataSourceStreamReader):
    def __init__(self, options):
        self.settings = _Settings(options)
        self.known: dict | None = None
        self.turn = 0

    @property
    def ends(self) -> "LineEnds | None":
        return LineEnds(self.settings.state_path + ".lines") if self.settings.state_path else None

    def _saved(self) -> dict:
        """Positions of the last planned (else committed) batch, if a state file is configured."""
        for suffix in (PLANNED, "") if self.settings.state_path else ():
            fs, at = _filesystem(self.settings.state_path + suffix)
            if fs.get_file_info(at).type == pafs.FileType.File:
                with fs.open_input_stream(at) as handle:
                    return parse_positions(handle.read().decode())
        return {}

    def _save(self, positions: dict, suffix: str = "") -> None:
        fs, at = _filesystem(self.settings.state_path)
        with fs.open_output_stream(at + suffix + ".new") as handle:
            handle.write(render_positions(positions).encode())
        fs.move(at + suffix + ".new", at + suffix)

    def initialOffset(self) -> dict:
        start = dict(self.settings.positions)
        if self.settings.skip_to_end:
            for f in self.settings.files():
                start[f["path"]] = [f["inode"], *_begin(f, start, True)]
        return {"files": start}

    def latestOffset(self) -> dict:
        if self.known is None:
            self.known = self._saved() or self.initialOffset()["files"]
        if self.ends:
            self.known = _sizes(self.settings, self.known, self.ends.carries(), self.turn)
        else:
            self.known = _advance(self.settings, self.known, False, self.turn)
        self.turn += 1
        return {"files": self.known}

    def partitions(self, start: dict, end: dict):
        self.known = end["files"]
        if self.settings.state_path:  # a driver that starts anew goes on from here
            self._save(self.known, PLANNED)
        carries = self.ends.carries() if self.ends else None
        ranges = _plan(self.settings, start["files"], end["files"], carries)
        return ranges or [NO_RANGE]

    def read(self, partition):
        if partition.table:
            yield from _read_ended(partition, self.settings.byte_offset)
        elif partition.path:
            yield from _read_range(partition, self.settings.byte_offset)

    def commit(self, end: dict) -> None:
        if self.settings.state_path:
            self._save(end["files"])
            self.ends.forget({_key(p, e[0], e[2]): e[1] for p, e in end["files"].items()})


def _options(groups, group_headers, positions, skip_to_end, byte_offset, file_header,
             idle_seconds, range_bytes, state_path, max_bytes=None, log_gone=True) -> dict[str, str]:
    options = {
        "groups": json.dumps({name: list(g) for name, g in groups.items()}),
        "groupheaders": json.dumps(group_headers or {}),
        "skiptoend": str(skip_to_end).lower(),
        "byteoffset": str(byte_offset).lower(),
        "rangebytes": str(range_bytes),
    }
    options["loggone"] = str(log_gone).lower()
    if max_bytes:
        options["maxbytes"] = str(max_bytes)
    if state_path:
        options["statepath"] = state_path
    if positions:
        options["positions"] = positions
    if file_header:
        options["fileheader"] = file_header
    if idle_seconds is not None:
        options["idleseconds"] = str(idle_seconds)
    return options


def read_tail(
    spark: SparkSession,
    groups: dict[str, tuple[str, str]],
    *,
    group_headers: dict[str, dict[str, str]] | None = None,
    positions: str | None = None,
    skip_to_end: bool = False,
    byte_offset: bool = False,
    file_header: str | None = None,
    idle_seconds: float | None = None,
    range_bytes: int = DEFAULT_RANGE,
    state_path: str | None = None,
    max_bytes_per_batch: int | None = None,
    log_gone: bool = False,
    streaming: bool = True,
) -> DataFrame:
    """Events from files that grow: ``groups={name: (folder, file-name pattern)}``.

    An unterminated last line waits for its newline, or for ``idle_seconds`` without a
    change. A position holds while path and inode match; a file that shrank restarts at 0. A
    file rotated to a name that does not match is read to its end, the new file from 0. A
    file that is cut while it is read, or whose planned bytes are gone, fails the batch
    (``log_gone``: such bytes are logged and passed over).

    ``positions`` (JSON list) seeds the start of a new query. ``state_path`` (one for each
    stream) keeps positions over a restart, and line ends: tasks write beside it where the
    last line of their range ended, and the next plan goes on from there, so the driver
    reads names and sizes only. A stream without it looks for the last newline of each
    file on the driver; a batch read never does.

    ``max_bytes_per_batch`` bounds what a batch reads: the budget is dealt evenly over the
    files that have grown, in turn where it is short, and may stop inside a file. A line
    that goes on beyond the budget is delivered by the batch in which it ends (without
    ``state_path``: alone, when its file's turn comes). Folders must be reachable from every
    executor (a shared mount or an Arrow file-system URI).
    """
    spark.dataSource.register(GrowingFiles)
    options = _options(groups, group_headers, positions, skip_to_end, byte_offset, file_header,
                       idle_seconds, range_bytes, state_path, max_bytes_per_batch, log_gone)
    reader = spark.readStream if streaming else spark.read
    return reader.format(FORMAT).options(**options).load()


def tail_positions(groups: dict[str, tuple[str, str]], positions: str | None = None, **kw) -> str:
    """Positions after a batch ``read_tail`` with the same arguments and file state."""
    args = dict(group_headers=None, skip_to_end=False, byte_offset=False, file_header=None,
                idle_seconds=None, range_bytes=DEFAULT_RANGE, state_path=None)
    settings = _Settings(_options(groups, positions=positions, **{**args, **kw}))
    return render_positions(_advance(settings, settings.positions, settings.skip_to_end))
