"""Partitioned text files written by tasks: the driver holds no file names."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventflow.session import stored
from eventflow.sources.files import qualified
from eventflow.sources.folders import partition_folder, reached

SCHEMES = ("file:", "hdfs:")  # where Arrow needs no credentials of its own and a rename is cheap
MANIFEST = ["staged", "folder", "name"]


def can_stage(spark: SparkSession, path: str) -> bool:
    """Whether tasks reach the folder of this path through Arrow."""
    root = qualified(spark, path)
    try:
        return root.startswith(SCHEMES) and bool(reached(root))
    except (OSError, ValueError):
        return False


def _runs(batch: pa.RecordBatch, keys: list[str]) -> list[int]:
    """Where runs of rows with equal keys begin, and the number of rows."""
    n, new = batch.num_rows, np.zeros(max(batch.num_rows - 1, 0), bool)
    for k in keys:
        c = pc.fill_null(batch.column(k), "")  # null shares the folder of the empty text
        new |= pc.not_equal(c[1:], c[:-1]).to_numpy(zero_copy_only=False)
    return [0, *(np.flatnonzero(new) + 1).tolist(), n] if n else []


def write_by_tasks(lines: DataFrame, path: str, partition_by: list[str]) -> None:
    """Add text files of the lines ``value``, partitioned as Spark's writer does it.

    Rows of a partition must lie in one task, next to each other: each run becomes one file,
    in the order of its rows. Tasks write below a hidden folder and list their files in a
    table, which holds those of one attempt of each task; only when all are written, tasks move
    the listed files to their place. So a failed job publishes nothing, and the driver, to which
    Spark's writer sends the name of each folder, gets none.
    """
    spark = lines.sparkSession
    root = qualified(spark, path)
    fs, base = reached(root)
    job = uuid.uuid4().hex
    hidden = f"{base.rstrip('/')}/_staged-{job}"

    def stage(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, _ = reached(root)
        task, own = TaskContext.get().partitionId(), f"{hidden}/{uuid.uuid4().hex}"
        done, last, out = 0, None, None
        try:
            for batch in batches:
                at, listed = _runs(batch, partition_by), []
                text = batch.column("value").cast(pa.large_binary())
                ends = np.frombuffer(text.buffers()[1], np.int64)[text.offset :] if at else []
                keys = [batch.column(k) for k in partition_by]
                for first, stop in zip(at, at[1:]):
                    key = [k[first].as_py() or "" for k in keys]
                    if key != last:
                        if out:
                            out.close()
                        else:
                            fs.create_dir(own, recursive=True)
                        name = f"part-{task:05d}-{job}-{done:06d}.txt"
                        out, last, done = fs.open_output_stream(f"{own}/{name}"), key, done + 1
                        folder = "/".join(map(partition_folder, partition_by, key))
                        listed.append((f"{own}/{name}", f"{base.rstrip('/')}/{folder}", name))
                    if ends[stop] > ends[first]:
                        out.write(text.buffers()[2][int(ends[first]) : int(ends[stop])])
                yield pa.record_batch([pa.array([x[i] for x in listed], pa.string()) for i in range(3)], MANIFEST)
        finally:
            if out:
                out.close()

    def publish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, _ = reached(root)
        for batch in batches:
            for staged, folder, name in zip(*(batch.column(c).to_pylist() for c in MANIFEST)):
                fs.create_dir(folder, recursive=True)
                try:
                    fs.move(staged, f"{folder}/{name}")
                except OSError:  # another attempt of this task may have moved it
                    if fs.get_file_info(f"{folder}/{name}").type != pafs.FileType.File:
                        raise
            yield pa.record_batch([pa.array([batch.num_rows], pa.int64())], ["files"])

    ended = F.concat(F.coalesce(F.col("value"), F.lit("")), F.lit("\n")).cast("binary").alias("value")
    rows = lines.select(*[F.col(c).cast("string").alias(c) for c in partition_by], ended)
    try:
        fs.create_dir(base, recursive=True)
        files = stored(rows.mapInArrow(stage, ", ".join(f"{c} string" for c in MANIFEST)), "staged-files")
        files.mapInArrow(publish, "files long").agg(F.sum("files")).collect()
        if spark._jsc.hadoopConfiguration().getBoolean("mapreduce.fileoutputcommitter.marksuccessfuljobs", True):
            fs.open_output_stream(f"{base.rstrip('/')}/_SUCCESS").close()
    finally:
        if fs.get_file_info(hidden).type == pafs.FileType.Directory:
            fs.delete_dir(hidden)
