"""The given tables as events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventflow.functions.text import csv_line
from eventflow.schema import to_events
from eventflow.session import tune


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    tune(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def epoch_ms(column: str | Column) -> Column:
    """Epoch millis of a zone-less timestamp (taken as UTC)."""
    c = F.col(column) if isinstance(column, str) else column
    return F.unix_millis(c.cast("timestamp"))


def events(spark: SparkSession, sf_dir: str, keep: tuple[str, ...] = ("event_id",)) -> DataFrame:
    df = table(spark, sf_dir, "events")
    return as_events(df, keep)


def as_events(df: DataFrame, keep: tuple[str, ...] = ("event_id",)) -> DataFrame:
    """Activity rows to events: ids, type and time as headers, properties as body."""
    return to_events(
        df,
        {
            "event_id": F.col("event_id"),
            "user_id": F.col("user_id"),
            "event_type": F.col("event_type"),
            "timestamp": epoch_ms("ts"),
        },
        F.col("props"),
        keep=keep,
    )


def documents(spark: SparkSession, sf_dir: str, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    df = table(spark, sf_dir, "documents")
    return to_events(
        df,
        {"doc_id": F.col("doc_id"), "lang": F.col("lang"), "source": F.col("source")},
        F.col("text"),
        keep=keep,
    )


def pages(spark: SparkSession, sf_dir: str, keep: tuple[str, ...] = ("page_id",)) -> DataFrame:
    df = table(spark, sf_dir, "pages")
    return to_events(
        df, {"page_id": F.col("page_id"), "url": F.col("url")}, F.col("html"), keep=keep
    )


def conversations(
    spark: SparkSession, sf_dir: str, keep: tuple[str, ...] = ("conv_id", "turn")
) -> DataFrame:
    df = table(spark, sf_dir, "conversations")
    return to_events(
        df,
        {"conv_id": F.col("conv_id"), "turn": F.col("turn"), "role": F.col("role")},
        F.col("text"),
        keep=keep,
    )


ORDER_COLUMNS = ("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")


def orders_csv(spark: SparkSession, sf_dir: str, quote_all: bool = True) -> DataFrame:
    df = table(spark, sf_dir, "orders")
    return to_events(
        df,
        {"o_orderkey": F.col("o_orderkey"), "timestamp": epoch_ms("o_orderdate")},
        csv_line(list(ORDER_COLUMNS), quote_all),
        keep=("o_orderkey",),
    )
