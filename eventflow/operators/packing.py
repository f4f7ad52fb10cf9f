"""Greedy packing of events into size- and count-limited send batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventflow.session import materialize

# Limits of the record store.
MAX_COUNT, MAX_BYTES, MAX_EVENT = 500, 5_000_000, 1_000_000
DEFAULT_COUNT = 100
MAIN, SPILL, DROPPED = "main", "spill", "dropped"


def pack_batches(
    df: DataFrame,
    order_by: list[str],
    *,
    max_count: int = DEFAULT_COUNT,
    max_bytes: int = MAX_BYTES,
    max_event: int = MAX_EVENT,
    lane: Column | None = None,
    lanes: int | None = None,
    key_from_event: bool = False,
) -> DataFrame:
    """Pack events, in order within each lane, into batches.

    An event over ``max_event`` is not sent (kind ``dropped``). An event that would
    overflow ``max_bytes`` closes its batch and is sent alone after it (kind ``spill``).
    Lanes are independent senders; by default rows are hashed over ``lanes`` of them, so
    a hot key cannot make one lane large. Each lane is folded as its rows stream by,
    never held. Adds ``lane``, ``batch``, ``batch_kind`` and ``partition_key``.
    """
    if not 1 <= max_count <= MAX_COUNT or not 1 <= max_bytes <= MAX_BYTES:
        raise ValueError("batch limits out of range")
    if not 1 <= max_event <= MAX_EVENT:
        raise ValueError("event limit out of range")
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if lane is None:
        lane = F.pmod(F.xxhash64(*order_by), F.lit(lanes or 4 * tasks))
    keyed = F.concat(F.lit("pk_"), F.pmod(F.xxhash64(*order_by), F.lit(2**31 - 1)))
    if key_from_event:
        keyed = F.when(F.map_contains_key("headers", "key"), F.col("headers")["key"]).otherwise(keyed)
    staged = (
        df.withColumn("lane", lane.cast("bigint"))
        .withColumn("partition_key", keyed)
        .withColumn("_size", F.octet_length("body").cast("bigint"))
        .repartition(tasks, "lane")
        .sortWithinPartitions("lane", *order_by)
    )
    schema = T.StructType(
        [
            *[f for f in staged.schema.fields if f.name != "_size"],
            T.StructField("batch", T.LongType()),
            T.StructField("batch_kind", T.StringType()),
        ]
    )
    return staged.mapInArrow(_packer(max_count, max_bytes, max_event), schema)


def _packer(max_count: int, max_bytes: int, max_event: int):
    """Arrow task: rows arrive sorted by lane; state is one open batch."""

    def fold(sizes: np.ndarray, state: list[int]) -> tuple[np.ndarray, np.ndarray]:
        n = len(sizes)
        batch = np.empty(n, dtype=np.int64)
        spill = np.zeros(n, dtype=bool)
        total = np.concatenate([[0], np.cumsum(sizes)])
        i = 0
        while i < n:  # one step per batch, not per row
            number, count, used = state
            fits = int(np.searchsorted(total, total[i] + max_bytes - used, side="right")) - 1
            end = min(fits, i + max_count - count, n)
            batch[i:end] = number
            state[1], state[2] = count + end - i, used + int(total[end] - total[i])
            i = end
            if state[1] == max_count:
                state[:] = [number + 1, 0, 0]
            elif i < n:
                batch[i], spill[i] = number, True
                i += 1
                state[:] = [number + 1, 0, 0]
        return batch, spill

    def run(chunks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state = None, [0, 0, 0]
        for chunk in chunks:
            if chunk.num_rows == 0:
                continue
            at = chunk.schema.get_field_index("_size")
            sizes = chunk.column(at).to_numpy(zero_copy_only=False)
            lanes = chunk.column(chunk.schema.get_field_index("lane")).to_numpy(zero_copy_only=False)
            batch = np.zeros(len(sizes), dtype=np.int64)
            kind = np.full(len(sizes), MAIN, dtype=object)
            oversize = sizes > max_event
            kind[oversize] = DROPPED
            edges = [0, *(np.flatnonzero(np.diff(lanes)) + 1).tolist(), len(lanes)]
            for lo, hi in zip(edges[:-1], edges[1:]):
                if lanes[lo] != current:
                    current, state = lanes[lo], [0, 0, 0]
                rows = lo + np.flatnonzero(~oversize[lo:hi])
                if len(rows):
                    numbers, spilled = fold(sizes[rows], state)
                    batch[rows] = numbers
                    kind[rows[spilled]] = SPILL
            columns = [c for i, c in enumerate(chunk.columns) if i != at]
            names = [n for n in chunk.schema.names if n != "_size"]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(batch, mask=oversize), pa.array(kind, pa.string())],
                names=[*names, "batch", "batch_kind"],
            )

    return run


def retry_failed(
    df: DataFrame,
    send: Callable[[DataFrame], DataFrame],
    attempts: int = 100,
    rollback: bool = False,
) -> DataFrame:
    """Send, then resend only what failed, up to ``attempts`` times.

    ``send`` returns its input rows with a boolean ``sent``. Rows still unsent at the
    end are returned; with ``rollback`` they are an error, so the batch runs again.
    """
    pending = df
    for _ in range(attempts):
        result = materialize(send(pending))
        pending = result.filter(~F.coalesce("sent", F.lit(False))).drop("sent")
        if pending.isEmpty():
            break
    if rollback and not pending.isEmpty():
        raise RuntimeError(f"events left unsent after {attempts} attempts")
    return pending
