"""Partitioned folders read whole file by file, listed by tasks: the driver holds no file names."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventflow.sources.files import qualified
from eventflow.sources.tail import _filesystem

NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
#: What Spark writes as %XX in the name of a partition's folder.
ESCAPED = re.compile("[\x01-\x1f\"#%'*/:=?\\\\\x7f{\\[\\]^]")
BATCH_ROWS, BATCH_BYTES = 1024, 4 << 20


def reached(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a qualified folder, as tasks reach it."""
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), re.sub("^file:/*", "/", uri)
    return _filesystem(uri)


def _escape(text: str) -> str:
    return ESCAPED.sub(lambda m: f"%{ord(m[0]):02X}", text)


def partition_folder(column: str, value: str | None) -> str:
    """Name of the folder of a partition; null and the empty text share one."""
    return f"{_escape(column)}={_escape(value) if value else NO_VALUE}"


def partition_value(text: str) -> str | None:
    """The value a partition folder's name stands for."""
    return None if text == NO_VALUE else re.sub("%([0-9A-Fa-f]{2})", lambda m: chr(int(m[1], 16)), text)


def _shown(info: pafs.FileInfo) -> bool:
    return not info.base_name.startswith(("_", "."))


def read_whole_files(spark: SparkSession, path: str, partitions: list[str]) -> DataFrame:
    """Each file of a folder partitioned by these columns, as ``(value, *partitions)``.

    The rows are those of ``spark.read.text(path, wholetext=True)`` with string partition
    columns (empty and hidden files are left out), but that one keeps every file's name and
    status in the driver. Here tasks list one level after the other and read the files, so
    the driver's memory does not grow with their number. A file is one row in a task's
    memory. Tasks reach the folder through Arrow's file systems.
    """
    root = qualified(spark, path)
    tasks = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))

    def values(held: list[tuple]) -> list[pa.Array]:
        return [pa.array([h[i] for h in held], pa.string()) for i in range(len(partitions) + 1)]

    def level(k: int):
        """Rows (folder, partition values) of the sub-folders that have a value of column ``k``."""
        names = ["_folder", *partitions]

        def below(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            fs, _ = reached(root)
            for row in (r for b in batches for r in zip(*(b.column(n).to_pylist() for n in names))):
                found = []
                for info in fs.get_file_info(pafs.FileSelector(row[0])):
                    column, _, text = info.base_name.partition("=")
                    if info.type == pafs.FileType.Directory and column == _escape(partitions[k]):
                        found.append((info.path, *row[1 : k + 1], partition_value(text), *row[k + 2 :]))
                for i in range(0, len(found), BATCH_ROWS):
                    yield pa.record_batch(values(found[i : i + BATCH_ROWS]), names)

        return below

    def contents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, _ = reached(root)
        names = ["_folder", *partitions]
        held, data, size = [], [], 0

        def batch() -> pa.RecordBatch:
            return pa.record_batch([pa.array(data, pa.binary()), *values(held)[1:]], ["value", *partitions])

        for row in (r for b in batches for r in zip(*(b.column(n).to_pylist() for n in names))):
            for info in fs.get_file_info(pafs.FileSelector(row[0])):
                if info.type != pafs.FileType.File or not info.size or not _shown(info):
                    continue
                with fs.open_input_stream(info.path) as handle:
                    held.append(row)
                    data.append(handle.read())
                size += len(data[-1])
                if len(held) >= BATCH_ROWS or size >= BATCH_BYTES:
                    yield batch()
                    held, data, size = [], [], 0
        if held:
            yield batch()

    kinds = ", ".join(f"`{c}` string" for c in partitions)
    folders = spark.createDataFrame([(reached(root)[1], *[None] * len(partitions))], f"_folder string, {kinds}")
    for k in range(len(partitions)):
        # By name, not in turn: a repeated task gets the same folders.
        folders = folders.mapInArrow(level(k), folders.schema).repartition(tasks, "_folder")
    files = folders.mapInArrow(contents, f"value binary, {kinds}")
    return files.withColumn("value", F.col("value").cast("string"))
