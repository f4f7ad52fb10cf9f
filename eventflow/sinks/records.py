"""Records for message brokers, search indexes and HTTP targets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventflow.functions.bucketing import bucket_path, index_name
from eventflow.functions.text import regex_groups


def to_topic_records(
    df: DataFrame,
    topic: str,
    *,
    allow_override: bool = True,
    topic_header: str = "topic",
    partition_header: str | None = None,
    default_partition: int | None = None,
    event_format: bool = False,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Events to ``(topic, key, value, partition)``.

    With override the topic header wins over the expanded topic pattern; without it the
    topic is used literally. A partition header beats the static one and must be a
    number. ``event_format`` packs headers and body together as JSON.
    """
    h = F.col("headers")
    if allow_override:
        # The pattern is only expanded (and its timestamp only needed) without a header.
        target = F.when(h[topic_header].isNotNull(), h[topic_header]).otherwise(bucket_path(topic))
    else:
        target = F.lit(topic)
    partition = F.lit(default_partition).cast("int")
    if partition_header:
        given = h[partition_header]
        partition = F.when(given.isNotNull(), given.cast("int")).otherwise(partition)
    value = F.col("body")
    if event_format:
        doc = F.struct(h.alias("headers"), F.col("body").cast("string").alias("body"))
        value = F.to_json(doc).cast("binary")
    return df.select(
        *keep,
        target.alias("topic"),
        h["key"].alias("key"),
        value.alias("value"),
        partition.alias("partition"),
    )


def write_topic(records: DataFrame, options: dict[str, str]) -> None:
    """Send records when the connector is on the classpath."""
    records.write.format("kafka").options(**options).save()


def carry_over(failed: DataFrame, next_batch: DataFrame) -> DataFrame:
    """Failed records go back in front of the next batch; the rest was committed."""
    return failed.unionByName(next_batch, allowMissingColumns=True)


def to_index_documents(
    df: DataFrame,
    prefix: str,
    doc_type: str = "log",
    keep: tuple[str, ...] = (),
    index: Column | None = None,
    **options,
) -> DataFrame:
    """Events to ``(index, type, document)`` for a search index.

    ``index`` replaces the name built from ``prefix`` and the event's time.
    """
    name = index if index is not None else index_name(prefix, F.col("headers"), **options)
    return df.select(
        *keep,
        name.alias("index"),
        bucket_path(doc_type, F.col("headers")).alias("type"),
        F.col("body").cast("string").alias("document"),
    )


def regex_columns(
    df: DataFrame, pattern: str, names: list[str], keep: tuple[str, ...] = ()
) -> DataFrame:
    """Groups of the body as columns; events that do not match give no row."""
    text = F.col("body").cast("string")
    return df.filter(text.rlike(rf"\A(?:{pattern})\z")).select(
        *keep, *regex_groups(text, pattern, names)
    )


def classify_status(
    code: Column,
    *,
    backoff: dict[str, bool] | None = None,
    rollback: dict[str, bool] | None = None,
    count: dict[str, bool] | None = None,
    default_backoff: bool = True,
    default_rollback: bool = True,
    default_count: bool = False,
) -> Column:
    """Response rules as ``struct<backoff,rollback,count>``: code, then class, then default."""
    text = code.cast("string")
    group = F.concat(F.substring(text, 1, 1), F.lit("XX"))

    def rule(table: dict[str, bool] | None, otherwise: bool) -> Column:
        if not table:
            return F.lit(otherwise)
        pairs = [p for k, v in table.items() for p in (F.lit(str(k)), F.lit(v))]
        known = F.create_map(*pairs)
        return F.coalesce(known[text], known[group], F.lit(otherwise))

    return F.struct(
        rule(backoff, default_backoff).alias("backoff"),
        rule(rollback, default_rollback).alias("rollback"),
        rule(count, default_count).alias("count"),
    )


def postable(df: DataFrame) -> DataFrame:
    """Events worth a request: empty bodies are consumed without one."""
    return df.filter(F.octet_length("body") > 0)
