"""Record shaping: broker, RPC and log records to events. Pure projections.

The transports are Spark connectors (or any table with the same columns).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventflow.functions import headers as hdr
from eventflow.schema import body_bytes, empty_body, empty_headers, header_map, to_events




def topic_to_events(
    df: DataFrame,
    *,
    set_topic_header: bool = True,
    topic_header: str = "topic",
    event_format: bool = False,
    clock: Column | None = None,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Topic records ``(key, value, topic, partition)`` to events.

    ``event_format`` means ``value`` is a struct already decoded to headers and body.
    Stamps ``timestamp``, ``topic`` and ``partition`` unless present; a non-null key
    always wins over a ``key`` header.
    """
    now = F.unix_millis(F.current_timestamp()) if clock is None else clock
    headers = F.coalesce(F.col("value.headers"), empty_headers()) if event_format else empty_headers()
    body = F.col("value.body") if event_format else F.col("value")
    absent = {"timestamp": now}
    if set_topic_header:
        absent[topic_header] = F.col("topic")
    absent["partition"] = F.col("partition")
    stamped = hdr.put(headers, absent, preserve=True)
    key = F.col("key").cast("string")
    keyed = F.when(key.isNotNull(), hdr.put(stamped, {"key": key})).otherwise(stamped)
    return df.select(*keep, keyed.alias("headers"), body_bytes(body, binary=True).alias("body"))


SLICE_FAN, SLICE_LEVELS = 1000, 2


def read_topic(spark, options: dict[str, str], streaming: bool = True) -> DataFrame:
    """Topic reader when the connector is on the classpath (``subscribe`` or
    ``subscribePattern``, ``maxOffsetsPerTrigger`` for batch bounds)."""
    reader = spark.readStream if streaming else spark.read
    return reader.format("kafka").options(**options).load()


def dirty_reads(
    df: DataFrame,
    arrival: str,
    slice_width: int,
    keys: tuple[str, ...] = ("topic", "partition"),
    offset: str = "offset",
) -> DataFrame:
    """Re-delivered records per key: offset not above the one seen just before it.

    Arrival order is cut into slices of ``slice_width``, so one hot partition is spread
    over many tasks; the first record of each slice is compared with the last record
    of the slice before it. Slices are joined in the same way, ``SLICE_FAN`` at a time, so
    a hot key meets in one task only when few slices of it are left.
    """
    keys = list(keys)
    sliced = df.select(*keys, offset, arrival).withColumn(
        "_slice", F.floor(F.col(arrival) / F.lit(slice_width))
    )
    inside = Window.partitionBy(*keys, "_slice").orderBy(arrival)
    previous = F.lag(offset).over(inside)
    flagged = sliced.withColumn("_dirty", (previous > 0) & (previous >= F.col(offset)))
    per_slice = flagged.groupBy(*keys, "_slice").agg(
        F.count_if("_dirty").alias("_inside"),
        F.count(F.lit(1)).alias("_rows"),
        F.min_by(offset, arrival).alias("_first"),
        F.max_by(offset, arrival).alias("_last"),
    )
    for _ in range(SLICE_LEVELS):
        per_slice = _join_slices(
            per_slice.withColumn("_group", F.floor(F.col("_slice") / F.lit(SLICE_FAN))), [*keys, "_group"]
        ).withColumnRenamed("_group", "_slice")
    joined = _join_slices(per_slice, keys)
    return joined.select(*keys, F.col("_rows").alias("records"), F.col("_inside").alias("dirty_reads"))


def _join_slices(slices: DataFrame, by: list[str]) -> DataFrame:
    """Neighbouring slices made one; a first record not above the last one before counts."""
    before = F.lag("_last").over(Window.partitionBy(*by).orderBy("_slice"))
    edges = slices.withColumn("_edge", (before > 0) & (before >= F.col("_first")))
    return edges.groupBy(*by).agg(
        (F.sum("_inside") + F.count_if("_edge")).alias("_inside"),
        F.sum("_rows").alias("_rows"),
        F.min_by("_first", "_slice").alias("_first"),
        F.max_by("_last", "_slice").alias("_last"),
    )


# Message property -> header name.
AMQP_TEXT = {
    "app_id": "app-id",
    "content_encoding": "content-encoding",
    "content_type": "content-type",
    "correlation_id": "correlation-id",
    "expiration": "expiration",
    "message_id": "message-id",
    "reply_to": "replyTo",
    "type": "type",
    "user_id": "user-id",
    "exchange": "exchange",
    "routing_key": "routing-key",
}
AMQP_NUMBER = {"delivery_mode": "delivery-mode", "priority": "priority"}


def amqp_to_events(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Queue messages: properties to headers, user headers on top (null becomes '').

    Missing or empty text properties give no header. Columns absent from ``df`` are
    taken as unset.
    """
    entries: dict[str, Column] = {}
    for column, name in AMQP_TEXT.items():
        if column in df.columns:
            entries[name] = F.when(F.col(column) != "", F.col(column))
    for column, name in AMQP_NUMBER.items():
        if column in df.columns:
            entries[name] = F.col(column)
    if "timestamp" in df.columns:
        entries["timestamp"] = F.unix_millis(F.col("timestamp").cast("timestamp"))
    envelope = [entries.pop(n) for n in ("exchange", "routing-key") if n in entries]
    props = header_map(entries, drop_null=True)
    if "headers" in df.columns:
        user = F.coalesce(F.col("headers"), empty_headers())
        user = F.transform_values(user, lambda _, v: F.coalesce(v, F.lit("")))
        props = hdr.overlay(props, user)
    if envelope:
        names = [n for c, n in AMQP_TEXT.items() if n in ("exchange", "routing-key") and c in df.columns]
        props = hdr.put_present(props, dict(zip(names, envelope)))
    return df.select(*keep, props.alias("headers"), body_bytes(F.col("body"), binary=True).alias("body"))


def jms_to_events(
    df: DataFrame, charset: str = "UTF-8", keep: tuple[str, ...] = ()
) -> DataFrame:
    """Messages ``(properties, type, text, bytes)``: properties to headers, payload by type."""
    body = F.when(F.col("type") == "text", F.encode("text", charset)).when(
        F.col("type").isin("bytes", "object"), F.col("bytes")
    )
    return to_events(df, F.col("properties"), body, keep=keep, binary=True)


def category_to_events(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Log entries ``(category, message)``; a null category gives no header."""
    return to_events(
        df, {"category": F.col("category")}, F.col("message"), keep=keep, drop_null=True
    )


def stream_records_to_events(
    df: DataFrame, clock: Column | None = None, keep: tuple[str, ...] = ()
) -> DataFrame:
    """Binary records ``data``: undecodable ones are skipped, the rest stamped now."""
    now = F.unix_millis(F.current_timestamp()) if clock is None else clock
    good = df.filter(F.is_valid_utf8(F.col("data").cast("string")))
    return to_events(good, {"timestamp": now}, F.col("data"), keep=keep, binary=True)


STATUS_FIELDS = (
    # Output field, path in the nested status, type.
    ("user_friends_count", "user.friends_count", "int"),
    ("user_location", "user.location", "string"),
    ("user_description", "user.description", "string"),
    ("user_statuses_count", "user.statuses_count", "int"),
    ("user_followers_count", "user.followers_count", "int"),
    ("user_name", "user.name", "string"),
    ("user_screen_name", "user.screen_name", "string"),
    ("text", "text", "string"),
    ("retweet_count", "retweet_count", "bigint"),
    ("retweeted", "retweeted", "boolean"),
    ("in_reply_to_user_id", "in_reply_to_user_id", "bigint"),
    ("source", "source", "string"),
    ("in_reply_to_status_id", "in_reply_to_status_id", "bigint"),
)


def flatten_status(df: DataFrame, id_prefix: str = "") -> DataFrame:
    """Nested status records to 17 flat fields; only the first media entity counts."""
    media = F.get(F.col("media"), F.lit(0))
    flat = [F.col(path).cast(dtype).alias(name) for name, path, dtype in STATUS_FIELDS]
    return df.select(
        F.concat(F.lit(id_prefix), F.col("id").cast("string")).alias("id"),
        F.date_format("created_at", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("created_at"),
        *flat,
        media["media_url_https"].alias("media_url_https"),
        media["expanded_url"].alias("expanded_url"),
    )


# Header names of log records, after a caller-chosen prefix.
LOG_HEADERS = ("logger.name", "log.level", "message.encoding", "address", "timestamp")


def logs_to_events(
    df: DataFrame,
    address: Column | None = None,
    prefix: str = "client.log.",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Log records ``(logger, ts_ms, level, message[s])``; a collection fans out."""
    if "messages" in df.columns:
        df = df.withColumn("message", F.explode("messages"))
    name, level, encoding, addr, time = (prefix + n for n in LOG_HEADERS)
    entries = {
        name: F.col("logger"),
        time: F.col("ts_ms"),
        level: F.col("level"),
        encoding: F.lit("UTF8"),
    }
    if address is not None:
        entries[addr] = address
    return to_events(df, entries, F.col("message"), keep=keep)


def legacy_to_events(
    df: DataFrame, marker: str = "legacy", keep: tuple[str, ...] = ()
) -> DataFrame:
    """Old-style events ``(host, timestamp, priority, nanos, fields, body)``."""
    base = header_map(
        {
            "host": F.col("host"),
            "timestamp": F.col("timestamp"),
            "pri": F.col("priority"),
            "nanos": F.col("nanos"),
        }
    )
    fields = F.transform_values(
        F.coalesce(F.col("fields"), F.create_map().cast("map<string,binary>")),
        lambda _, v: v.cast("string"),
    )
    headers = hdr.put(hdr.overlay(base, fields), {marker: F.lit("yes")})
    return df.select(*keep, headers.alias("headers"), F.coalesce("body", empty_body()).alias("body"))


def batches_to_events(df: DataFrame, batch: str = "batch", keep: tuple[str, ...] = ()) -> DataFrame:
    """Batches ``array<struct<headers,body>>`` to one event per element."""
    e = df.select(*keep, F.explode(batch).alias("_e"))
    return to_events(e, F.col("_e.headers"), F.col("_e.body"), keep=keep, binary=True)


def events_to_batches(
    df: DataFrame, by: list[str], position: str, size: int = 100
) -> DataFrame:
    """Inverse of ``batches_to_events``: arrays of at most ``size`` events per key.

    ``position`` numbers the events of a key; a batch takes ``size`` consecutive
    numbers, so no array grows with the data. Adds ``batch_no`` and ``batch``.
    """
    item = F.struct(position, F.map_entries("headers").alias("headers"), F.col("body"))
    rows = df.groupBy(*by, F.floor(F.col(position) / F.lit(size)).alias("batch_no")).agg(
        F.array_sort(F.collect_list(item)).alias("batch")
    )
    return rows.withColumn(
        "batch",
        F.transform(
            "batch",
            lambda e: F.struct(
                F.map_from_entries(e["headers"]).alias("headers"), e["body"].alias("body")
            ),
        ),
    )
