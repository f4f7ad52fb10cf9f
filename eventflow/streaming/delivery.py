"""Delivery rules inside ``foreachBatch``.

A micro-batch may run again after a failure, so writers are keyed by batch id: running
a batch twice replaces its output instead of adding to it.
"""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventflow.sinks.files import write_events

log = logging.getLogger(__name__)
Writer = Callable[[DataFrame, int], None]


def batch_key(series: int, batch_id: int) -> int:
    """64-bit key of a batch of a stream; consecutive batches have consecutive keys."""
    return series * 1_000_000 + batch_id


def batch_writer(path: str, fmt: str = "parquet") -> Writer:
    """Idempotent writer: each batch owns one sub-folder."""

    def write(df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").format(fmt).save(f"{path.rstrip('/')}/batch_id={batch_id}")

    return write


def text_writer(path: str, serializer: str = "TEXT") -> Writer:
    def write(df: DataFrame, batch_id: int) -> None:
        write_events(df, f"{path.rstrip('/')}/batch_id={batch_id}", serializer, mode="overwrite")

    return write


def deliver(
    routed: DataFrame, batch_id: int, required: dict[str, Writer], optional: dict[str, Writer] = {}
) -> dict[str, str]:
    """Write a routed batch (columns ``channel``, ``required``) channel by channel.

    Required channels go first and any failure fails the batch (it is retried whole);
    a failing optional channel is logged and skipped.
    """
    held = routed.persist(StorageLevel.MEMORY_AND_DISK)
    outcome = {}
    try:
        for name, write in required.items():
            part = held.filter((F.col("channel") == name) & F.col("required"))
            write(part.drop("channel", "required"), batch_id)
            outcome[name] = "committed"
        for name, write in optional.items():
            part = held.filter((F.col("channel") == name) & ~F.col("required"))
            try:
                write(part.drop("channel", "required"), batch_id)
                outcome[name] = "committed"
            except Exception as error:  # best effort by definition
                log.warning("optional channel %s failed for batch %s: %s", name, batch_id, error)
                outcome[name] = "failed"
    finally:
        held.unpersist()
    return outcome


def by_priority(sinks: dict[str, Writer], priorities: dict[str, int]) -> list[tuple[str, Writer]]:
    """Sinks by falling priority; those without one follow with -1, -2, …

    A second sink with a priority already taken is ignored.
    """
    taken: dict[int, tuple[str, Writer]] = {}
    unset = -1
    for name, write in sinks.items():
        level = priorities.get(name)
        if level is None:
            level, unset = unset, unset - 1
        if level in taken:
            log.warning("sink %s ignored: priority %s is already used", name, level)
            continue
        taken[level] = (name, write)
    return [taken[level] for level in sorted(taken, reverse=True)]


def write_failover(
    df: DataFrame, batch_id: int, sinks: dict[str, Writer], priorities: dict[str, int] | None = None
) -> str:
    """Write to the first sink that works, in priority order; returns its name."""
    errors = []
    for name, write in by_priority(sinks, priorities or {}):
        try:
            write(df, batch_id)
            return name
        except Exception as error:
            errors.append(f"{name}: {error}")
            log.warning("sink %s failed for batch %s: %s", name, batch_id, error)
    raise RuntimeError("all sinks failed: " + "; ".join(errors))


def write_balanced(
    df: DataFrame,
    batch_id: int,
    sinks: dict[str, Writer],
    mode: str = "round_robin",
    order: Callable[[int, list[str]], list[str]] | None = None,
) -> str:
    """One sink per batch, the next one on failure; returns the sink used.

    The starting point depends on the batch id only, so a retried batch starts at the
    same sink.
    """
    names = list(sinks)
    if len(names) < 2:
        raise ValueError("balancing needs at least two sinks")
    if order is not None:
        names = order(batch_id, names)
    elif mode == "round_robin":
        at = batch_id % len(names)
        names = names[at:] + names[:at]
    elif mode == "random":
        import random

        random.Random(batch_id).shuffle(names)
    else:
        raise ValueError("mode must be 'round_robin' or 'random'")
    for name in names:
        try:
            sinks[name](df, batch_id)
            return name
        except Exception as error:
            log.warning("sink %s failed for batch %s: %s", name, batch_id, error)
    raise RuntimeError("all sinks failed")


def process_each(
    df: DataFrame,
    open_resource: Callable[[], object],
    process: Callable[[object, object], None],
    close: Callable[[object], None] | None = None,
) -> None:
    """Hand every row to a callback with a per-task resource (a client, a connection).

    All rows are tried; if any failed the job fails, so the batch is run again. The
    callback must tolerate a row it has seen before.
    """

    def run(rows) -> None:
        resource, failed, last = None, 0, None
        try:
            for row in rows:
                if resource is None:
                    resource = open_resource()
                try:
                    process(resource, row)
                except Exception as error:
                    failed, last = failed + 1, error
        finally:
            if resource is not None and close is not None:
                close(resource)
        if failed:
            raise RuntimeError(f"{failed} events failed, last error: {last}")

    df.foreachPartition(run)
