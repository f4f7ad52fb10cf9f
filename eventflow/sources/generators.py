"""Synthetic load, generated on the executors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventflow.schema import empty_headers

STRESS_BYTE = "7F"  # fixed value


def sequence(spark: SparkSession, total: int, start: int = 0, partitions: int | None = None):
    """``total`` events whose body is a decimal counter."""
    ids = spark.range(start, start + total, 1, partitions)
    return ids.select(
        empty_headers().alias("headers"), F.col("id").cast("string").cast("binary").alias("body")
    )


def sequence_stream(spark: SparkSession, rows_per_second: int = 1) -> DataFrame:
    ticks = spark.readStream.format("rate").option("rowsPerSecond", rows_per_second).load()
    return ticks.select(
        "timestamp",
        empty_headers().alias("headers"),
        F.col("value").cast("string").cast("binary").alias("body"),
    )


def stress(spark: SparkSession, total: int, size: int = 500, partitions: int | None = None):
    """``total`` events of ``size`` identical bytes."""
    body = F.unhex(F.lit(STRESS_BYTE * size))
    return spark.range(0, total, 1, partitions).select(
        empty_headers().alias("headers"), body.alias("body")
    )
