"""File output: text forms of events, bucketed and rolling directories."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventflow.functions.avro import EVENT_RECORD, event_file_format
from eventflow.functions.bucketing import bucket_path
from eventflow.functions.text import dump, header_and_text
from eventflow.operators.indexing import key_of, not_above, slice_bounds, slice_number
from eventflow.schema import empty_body, empty_headers
from eventflow.session import stored
from eventflow.sinks.staged import can_stage, write_by_tasks

SERIALIZERS = ("TEXT", "HEADER_AND_TEXT", "AVRO_EVENT")


def serialize_text(df: DataFrame, serializer: str | Callable[[DataFrame], Column] = "TEXT") -> Column:
    """Line of text for an event."""
    if callable(serializer):
        return serializer(df)
    if serializer == "TEXT":
        return F.col("body").cast("string")
    if serializer == "HEADER_AND_TEXT":
        return header_and_text(F.col("headers"), F.col("body"))
    raise ValueError(f"unknown serializer: {serializer}")


def write_events(
    df: DataFrame,
    path: str,
    serializer: str | Callable[[DataFrame], Column] = "TEXT",
    *,
    partition_by: list[str] = (),
    compression: str | None = None,
    max_records_per_file: int = 0,
    append_newline: bool = True,
    mode: str = "append",
    placed: bool = False,
) -> None:
    """Write events; the committer publishes files only when the job succeeds.

    AVRO_EVENT writes Avro files of event records; headers without a value are left out.
    A session that cannot write Avro raises. A function makes the line of each event.

    ``placed`` says that the rows of each partition lie in one task, next to each other. Plain
    text is then added by tasks alone (``write_by_tasks``) where they reach the folder: Spark's
    writer sends the names of all partitions to the driver.
    """
    if serializer == "AVRO_EVENT":
        present = F.map_filter(F.col("headers"), lambda _, v: v.isNotNull())
        headers = F.coalesce(present, empty_headers()).alias("headers")
        body = F.coalesce(F.col("body"), empty_body()).alias("body")
        out = df.select(*partition_by, headers, body).write.option("avroSchema", EVENT_RECORD)
        fmt = event_file_format(df.sparkSession)
    else:
        out = df.select(*partition_by, serialize_text(df, serializer).alias("value")).write
        # An empty lineSep is not allowed, so bodies that bring their own newline
        # (append_newline=False) have it removed first: the writer restores it.
        if not append_newline:
            line = F.regexp_replace("value", "\n$", "")
            out = (
                df.select(*partition_by, serialize_text(df, serializer).alias("value"))
                .withColumn("value", line)
                .write
            )
        out, fmt = out.option("lineSep", "\n"), "text"
        plain = not compression and not max_records_per_file and append_newline and mode == "append"
        if placed and plain and can_stage(df.sparkSession, path):
            lines = df.select(*partition_by, serialize_text(df, serializer).alias("value"))
            write_by_tasks(lines, path, list(partition_by))
            return
    if compression:
        out = out.option("compression", compression)
    if max_records_per_file:
        out = out.option("maxRecordsPerFile", max_records_per_file)
    if partition_by:
        out = out.partitionBy(*partition_by)
    out.mode(mode).format(fmt).save(path)


def with_buckets(df: DataFrame, pattern: str, name: str = "bucket", **options) -> DataFrame:
    return df.withColumn(name, bucket_path(pattern, F.col("headers"), **options))


def event_bytes(df: DataFrame, serializer: str | Callable[[DataFrame], Column] = "TEXT") -> Column:
    """Bytes that an event takes in a file, before compression: its line and line end, or
    the texts and the body of an Avro event record."""
    if serializer != "AVRO_EVENT":
        return F.coalesce(F.octet_length(serialize_text(df, serializer)), F.lit(0)).cast("bigint") + 1
    parts = F.concat(F.map_keys("headers"), F.filter(F.map_values("headers"), lambda v: v.isNotNull()))
    texts = F.aggregate(parts, F.lit(0).cast("bigint"), lambda n, x: n + F.octet_length(x))
    return F.coalesce(texts, F.lit(0)) + F.coalesce(F.octet_length("body"), F.lit(0))


SLICE_ROWS = 8192  # events of a slice of the order, about
BROADCAST_FILES = 100_000  # listed files that the driver may hold to broadcast them


def with_rolls(
    df: DataFrame,
    size: Column,
    *,
    by: str = "bucket",
    roll_size: int = 0,
    roll_count: int = 0,
    roll_interval: int = 0,
    roll_clock: Column | None = None,
    order_by: list[str] = (),
    name: str = "roll",
) -> DataFrame:
    """Add the file each event goes to within its bucket, by bytes, events and seconds.

    An event opens a new file where the bytes (or events) before it reach a multiple of
    ``roll_size`` (``roll_count``), so no file is over a limit by more than its last event;
    ``roll_interval`` first splits a bucket by ``roll_clock`` (epoch millis, by default the
    ``timestamp`` header). A limit of 0 does not roll; events
    without a time share the span ``none``.

    With ``order_by`` (unique keys) the sums run through a bucket in that order, over all
    tasks. They are made from keys and sizes alone: the order is cut into slices, each
    (bucket, slice) is summed by itself, and what lies before it comes from the slices'
    totals, one row each, so a bucket with most of the events spreads over as many tasks as
    there are slices. What is left is the first key of each file within each slice; an event
    finds its file by bisection of its own slice's, so headers and bodies are not shuffled
    here as long as the lists can be broadcast (at most ``BROADCAST_FILES`` files; more are
    joined by sorting). Slices hold at most about ``SLICE_ROWS`` events, so that list stays short
    however large a bucket grows. Without an order each task rolls its own files. An event larger
    than the limit ends its file.
    """
    clock = F.col("headers")["timestamp"].cast("bigint") if roll_clock is None else roll_clock
    span = F.floor(clock / F.lit(1000 * roll_interval)) if roll_interval else F.lit(0)
    staged = df.withColumn("_span", span.cast("bigint"))

    def number(parts: list[Column]) -> Column:
        parts = ([F.coalesce(F.col("_span").cast("string"), F.lit("none"))] if roll_interval else []) + parts
        parts += [F.floor(F.col("_bytes") / F.lit(roll_size))] if roll_size else []
        parts += [F.floor(F.col("_events") / F.lit(roll_count))] if roll_count else []
        return F.concat_ws("-", *[p.cast("string") for p in parts])

    def summed(rows: DataFrame, inside: list[str]) -> DataFrame:
        sums = Window.partitionBy(by, "_span", "_slice").orderBy(*inside).rowsBetween(Window.unboundedPreceding, -1)
        return rows.withColumns({
            "_bytes": F.coalesce(F.sum("_size").over(sums), F.lit(0)), "_events": F.count(F.lit(1)).over(sums),
        })

    if not order_by:
        own = staged.withColumns({"_size": size, "_row": F.monotonically_increasing_id()})
        own = summed(own.withColumn("_slice", F.shiftright("_row", 33)), ["_row"])
        return own.withColumn(name, number([F.col("_slice")])).select(*df.columns, name)
    order = list(order_by)
    slices = max(2 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-df.count() // SLICE_ROWS))
    part = slice_number(df, order, slice_bounds(df, order, slices)).cast("bigint")
    keys = staged.select(
        by, "_span", part.alias("_slice"), size.alias("_size"),
        *[F.col(c) for c in order if c not in (by, "_span")],
    )
    # One row an event, of its keys: written once, for the totals and the sums.
    keys = stored(keys, "roll-keys")
    before = Window.partitionBy(by, "_span").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    group = [by, "_span", "_slice"]
    totals = keys.groupBy(*group).agg(F.sum("_size").alias("_all"), F.count(F.lit(1)).alias("_rows")).select(
        *[F.col(c).alias(f"{c}_t") for c in group],
        F.coalesce(F.sum("_all").over(before), F.lit(0)).alias("_bytes0"),
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_events0"),
    )
    same = [F.col(c).eqNullSafe(F.col(f"{c}_t")) for c in group]
    placed = summed(keys, order).join(totals, same).withColumns({
        "_bytes": F.col("_bytes") + F.col("_bytes0"), "_events": F.col("_events") + F.col("_events0"),
    })
    # A file that runs over a slice's start has an entry in each slice it reaches.
    firsts = placed.groupBy(*group, number([]).alias(name)).agg(F.min(key_of(order)).alias("_key"))
    table = stored(
        firsts.groupBy(F.col(by).alias("_by"), F.col("_span").alias("_at"), F.col("_slice").alias("_in")).agg(
            F.sort_array(F.collect_list(F.struct("_key", name))).alias("_files")  # one entry a file
        ).withColumn("_keys", F.col("_files._key")), "rolls",
    )
    most, listed = table.agg(F.max(F.size("_files")), F.sum(F.size("_files"))).first()
    if (listed or 0) > BROADCAST_FILES:
        table = table.hint("merge")  # its size on disk, which Spark goes by, is a small part of that in memory
    staged = staged.withColumn("_slice", part)
    joined = staged.join(table, F.col(by).eqNullSafe(F.col("_by")) & F.col("_span").eqNullSafe(F.col("_at"))
                         & F.col("_slice").eqNullSafe(F.col("_in")))
    place = not_above(F.col("_keys"), key_of(order), most or 0) - 1
    return joined.withColumn(name, F.get(F.col("_files"), place)[name]).select(*df.columns, name)


def write_bucketed(
    df: DataFrame,
    path: str,
    pattern: str,
    *,
    serializer: str = "TEXT",
    tz: str | None = None,
    round_unit: str | None = None,
    round_value: int = 1,
    clock: Column | None = None,
    compression: str | None = None,
    roll_count: int = 0,
    roll_size: int = 0,
    roll_interval: int = 0,
    roll_clock: Column | None = None,
    order_by: list[str] = (),
    files_per_bucket: int = 0,
    mode: str = "append",
) -> None:
    """Files under one directory per bucket, at most ``roll_count`` events per file.

    By default each task writes the buckets it meets. ``files_per_bucket`` gathers a
    bucket first, salted over that many tasks so a hot bucket does not land on one.

    ``roll_size`` (bytes), ``roll_interval`` (seconds) or an ``order_by`` make a folder
    ``roll=...`` with one file for each roll of a bucket (see ``with_rolls``); rows keep the
    order inside a file. Files are shuffled to tasks whole, so a hot bucket spreads by files.
    """
    staged = with_buckets(
        df, pattern, "bucket", tz=tz, round_unit=round_unit, round_value=round_value, clock=clock
    )
    if roll_size or roll_interval or order_by:
        rolled = with_rolls(
            staged, event_bytes(staged, serializer), roll_size=roll_size, roll_count=roll_count,
            roll_interval=roll_interval, roll_clock=roll_clock, order_by=order_by,
        )
        rolled = rolled.repartition("bucket", "roll").sortWithinPartitions("bucket", "roll", *order_by)
        write_events(
            rolled, path, serializer, partition_by=["bucket", "roll"], compression=compression, mode=mode, placed=True
        )
        return
    if files_per_bucket:
        # By the row's place, not its content: a hot bucket may hold equal events.
        salt = F.pmod(F.monotonically_increasing_id(), F.lit(files_per_bucket))
        staged = staged.withColumn("_salt", salt).repartition("bucket", "_salt").drop("_salt")
    write_events(
        staged, path, serializer, partition_by=["bucket"], compression=compression,
        max_records_per_file=roll_count, mode=mode,
    )


def log_events(df: DataFrame, max_bytes: int = 16) -> DataFrame:
    """Printable form of events."""
    return df.select(dump(F.col("headers"), F.col("body"), max_bytes).alias("line"))


def write_null(df: DataFrame) -> None:
    """Run the flow, keep nothing."""
    df.write.format("noop").mode("overwrite").save()
