"""Spool directories: complete files to events, in batch or as a stream."""

from __future__ import annotations

import re
from datetime import datetime, timezone
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventflow.functions.text import decode_text
from eventflow.schema import empty_headers, header_map
from eventflow.sources.payloads import read_lines

DEFAULT_SUFFIX = ".COMPLETED"
MAX_BLOB = 100_000_000  # fixed value: default length of a blob


def candidate(
    name: Column, include: str = "^.*$", ignore: str = "^$", suffix: str = DEFAULT_SUFFIX
) -> Column:
    """Whether a file name is taken: patterns match the full name."""
    return (
        ~F.endswith(name, F.lit(suffix))
        & ~F.startswith(name, F.lit("."))
        & name.rlike(rf"\A(?:{include})\z")
        & ~name.rlike(rf"\A(?:{ignore})\z")
    )


def _open_dirs(path: Column, root: str, ignore: str) -> Column:
    """No directory between the root and the file is hidden or ignored."""
    plain = re.sub("^file:/+", "/", root).rstrip("/") + "/"
    local = F.regexp_replace(path, "^file:/+", "/")
    parts = F.split(F.substring(local, len(plain) + 1, 1 << 30), "/")
    dirs = F.slice(parts, F.lit(1), F.size(parts) - 1)
    return ~F.exists(dirs, lambda d: d.startswith(".") | d.rlike(rf"\A(?:{ignore})\z"))


def qualified(spark: SparkSession, path: str) -> str:
    """The folder as listings name it: with its scheme and host."""
    own = spark._jvm.org.apache.hadoop.fs.Path(path)
    return own.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(own).toString()


def _scan(spark: SparkSession, path: str, recursive: bool) -> DataFrame:
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", str(recursive).lower())
        .load(path)
    )


def _name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def _taken(path: Column, root: str, include, ignore, suffix, recursive: bool) -> Column:
    keep = candidate(_name(path), include, ignore, suffix)
    return keep & _open_dirs(path, root, ignore) if recursive else keep


def _empty_paths(scan: DataFrame) -> DataFrame:
    """Files a scan lists but does not read because they hold no bytes.

    Only names pass through the driver, which holds the scan's file index anyway.
    """
    listed = [(re.sub("^file:/+", "file:/", unquote(p)),) for p in scan.inputFiles()]
    names = scan.sparkSession.createDataFrame(listed, "path string")
    return names.join(scan.select("path"), "path", "left_anti")


def _modified(spark: SparkSession, path: str) -> datetime:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    return datetime.fromtimestamp(
        fs.getFileStatus(target).getModificationTime() / 1000, timezone.utc
    )


def list_spool(
    spark: SparkSession,
    path: str,
    *,
    include: str = "^.*$",
    ignore: str = "^$",
    suffix: str = DEFAULT_SUFFIX,
    recursive: bool = False,
) -> DataFrame:
    """Candidate files ``(path, name, modified, length)``. Listing reads no content."""
    path = qualified(spark, path)
    scan = _scan(spark, path, recursive)
    taken = _taken(F.col("path"), path, include, ignore, suffix, recursive)
    files = scan.filter(taken).select(
        "path", _name(F.col("path")).alias("name"), F.col("modificationTime").alias("modified"), "length"
    )
    empty = [r.path for r in _empty_paths(scan).filter(taken).collect()]
    if not empty:
        return files
    rows = [(p, p.rsplit("/", 1)[-1], _modified(spark, p), 0) for p in empty]
    return files.unionByName(spark.createDataFrame(rows, files.schema))


def consume_order(listing: DataFrame, order: str = "oldest", seed: int = 0) -> DataFrame:
    """Listing in consume order: by time (ties by name), or shuffled."""
    order = order.lower()
    if order == "random":
        return listing.orderBy(F.xxhash64("path", F.lit(seed)))
    if order not in ("oldest", "youngest"):
        raise ValueError("order must be oldest, youngest or random")
    time = F.col("modified").asc() if order == "oldest" else F.col("modified").desc()
    return listing.orderBy(time, F.col("name").asc())


def _file_headers(file_header: str | None, basename_header: str | None, path: Column) -> Column:
    entries = {}
    if file_header:
        entries[file_header] = F.regexp_replace(path, "^file:/+", "/")
    if basename_header:
        entries[basename_header] = F.element_at(F.split(path, "/"), -1)
    return header_map(entries) if entries else empty_headers()


def read_spool(
    spark: SparkSession,
    path: str,
    *,
    include: str = "^.*$",
    ignore: str = "^$",
    suffix: str = DEFAULT_SUFFIX,
    recursive: bool = False,
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
    """Events of all candidate files.

    LINE splits large files across tasks (the text source reads byte ranges), BLOB makes
    one event per file, or several of at most ``max_blob_length`` bytes. An empty file gives one event with an empty body. Lines end at
    the byte 0x0A, so ``charset`` must be ASCII-compatible.
    """
    path = qualified(spark, path)
    scan = _scan(spark, path, recursive)
    taken = _taken(F.col("path"), path, include, ignore, suffix, recursive)
    headers = _file_headers(file_header, basename_header, F.col("path")).alias("headers")
    empty = _empty_paths(scan).filter(taken).select(headers, F.lit(b"").alias("body"))
    if deserializer.upper() == "BLOB":
        whole = scan.filter(taken).select(headers, F.explode(_blobs(max_blob_length)).alias("body"))
        return whole.unionByName(empty)
    if deserializer.upper() != "LINE":
        raise ValueError("deserializer must be LINE or BLOB")
    lines = _text(spark.read, path, recursive, charset, decode_policy, include, ignore, suffix)
    events = _cut_lines(
        lines, max_line_length, output_charset, compat, file_header, basename_header
    )
    return events.unionByName(empty)


def stream_spool(
    spark: SparkSession,
    path: str,
    *,
    include: str = "^.*$",
    ignore: str = "^$",
    suffix: str = DEFAULT_SUFFIX,
    recursive: bool = False,
    order: str = "oldest",
    delete_policy: str = "never",
    archive_dir: str | None = None,
    max_files_per_trigger: int | None = None,
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
    """Streaming spool: each file is read once, position kept in the checkpoint.

    ``delete_policy`` never/immediate/archive maps to the source's clean-up option.
    Files come oldest or youngest first; a random order is for batch listings only. BLOB
    gives one event per file, at most ``max_blob_length`` bytes each. An empty file gives no
    event in a stream: the file source skips it (``read_spool`` gives one).
    """
    if order.lower() not in ("oldest", "youngest"):
        raise ValueError("a stream reads oldest or youngest files first")
    if delete_policy not in ("never", "immediate", "archive"):
        raise ValueError("delete_policy must be never, immediate or archive")
    if delete_policy == "archive" and not archive_dir:
        raise ValueError("delete_policy 'archive' needs archive_dir")
    path = qualified(spark, path)
    reader = spark.readStream.option("latestFirst", str(order.lower() == "youngest").lower())
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if delete_policy == "immediate":
        reader = reader.option("cleanSource", "delete")
    elif delete_policy == "archive":
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    if deserializer.upper() == "BLOB":
        files = (
            reader.format("binaryFile")
            .schema("path string, modificationTime timestamp, length long, content binary")
            .option("recursiveFileLookup", str(recursive).lower()).load(path)
        )
        taken = _taken(F.col("path"), path, include, ignore, suffix, recursive)
        headers = _file_headers(file_header, basename_header, F.col("path")).alias("headers")
        return files.filter(taken).select(headers, F.explode(_blobs(max_blob_length)).alias("body"))
    if deserializer.upper() != "LINE":
        raise ValueError("deserializer must be LINE or BLOB")
    lines = _text(reader, path, recursive, charset, decode_policy, include, ignore, suffix)
    return _cut_lines(
        lines, max_line_length, output_charset, compat, file_header, basename_header
    )


def _blobs(length: int) -> Column:
    """Content in pieces of at most ``length`` bytes."""
    starts = F.sequence(F.lit(1), F.greatest(F.octet_length("content"), F.lit(1)), F.lit(length))
    return F.transform(starts, lambda s: F.substring(F.col("content"), s, F.lit(length)))


def _text(reader, path, recursive, charset, decode_policy, include, ignore, suffix) -> DataFrame:
    options = {"recursiveFileLookup": str(recursive).lower(), "lineSep": "\n"}
    lines = reader.format("text").options(**options).load(path)
    # This path is URL-encoded (unlike the one of a binary scan); '+' stands for itself.
    encoded = F.col("_metadata.file_path")
    plain = F.when(
        F.contains(encoded, F.lit("%")), F.url_decode(F.replace(encoded, F.lit("+"), F.lit("%2B")))
    ).otherwise(encoded)
    taken = _taken(plain, path, include, ignore, suffix, recursive)
    value = decode_text(F.col("value").cast("binary"), decode_policy, charset)
    return lines.filter(taken).select(
        value.alias("value"), plain.alias("_path")
    )


def _cut_lines(lines, max_length, charset, compat, file_header, basename_header) -> DataFrame:
    headers = _file_headers(file_header, basename_header, F.col("_path"))
    shaped = lines.select(headers.alias("headers"), F.col("value"))
    # The reader already split lines, so only over-long ones are left to cut. Each
    # value was one line: give its newline back, so an empty line stays one event.
    with_newline = shaped.withColumn("value", F.concat("value", F.lit("\n")))
    return read_lines(with_newline, "value", max_length, charset, compat).drop("line_no")


def assert_unchanged(before: DataFrame, after: DataFrame) -> None:
    """Raise if a file of an earlier listing changed, or its name was reused."""
    changed = (
        before.alias("b")
        .join(after.alias("a"), "path")
        .filter((F.col("a.length") != F.col("b.length")) | (F.col("a.modified") != F.col("b.modified")))
        .select("path")
    )
    bad = changed.take(1)
    if bad:
        raise RuntimeError(f"file changed while being read: {bad[0]['path']}")
