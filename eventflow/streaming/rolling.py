"""Rolling output: one directory of files per roll of a stream."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame

from eventflow.session import run_series
from eventflow.sinks.files import write_events


def roll_name(
    index: int, *, prefix: str = "", extension: str = "", series: int | None = None,
    at: float | None = None,
) -> str:
    """``<prefix><series>-<n>[.ext]``, or ``<prefix><yyyyMMddHHmmss>-<n>`` given a time."""
    if at is not None:
        stem = datetime.fromtimestamp(at, timezone.utc).strftime("%Y%m%d%H%M%S")
    else:
        stem = str(series)
    return f"{prefix}{stem}-{index}" + (f".{extension}" if extension else "")


def write_rolling(
    events: DataFrame,
    path: str,
    checkpoint: str,
    *,
    interval_seconds: float = 30,
    serializer: str = "TEXT",
    prefix: str = "",
    extension: str = "",
    path_manager: str = "default",
    series: int | None = None,
    compression: str | None = None,
    once: bool = False,
    name: str | None = None,
):
    """Start a stream that rolls its output every interval (every batch if <= 0).

    The roll index is the batch id, so a repeated batch overwrites its own roll.
    ``series`` names the run; by default it is the time of the first start, kept beside the
    checkpoint, so a batch repeated after a restart keeps its name.
    ``path_manager='rolltime'`` names a roll by the start second of its interval.
    """
    series = series if series is not None else run_series(events.sparkSession, checkpoint)

    def roll(df: DataFrame, batch_id: int) -> None:
        index = batch_id + 1
        if path_manager == "rolltime":
            started = series / 1000 + batch_id * max(interval_seconds, 0)
            target = roll_name(index, prefix=prefix, extension=extension, at=started)
        else:
            target = roll_name(index, prefix=prefix, extension=extension, series=series)
        folder = f"{path}/{target}"
        write_events(df, folder, serializer, compression=compression, mode="overwrite")

    writer = events.writeStream.option("checkpointLocation", checkpoint).foreachBatch(roll)
    if name:
        writer = writer.queryName(name)
    if once:
        writer = writer.trigger(availableNow=True)
    elif interval_seconds > 0:
        writer = writer.trigger(processingTime=f"{interval_seconds} seconds")
    return writer.start()
