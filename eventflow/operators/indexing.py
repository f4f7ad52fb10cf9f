"""Slices of a global order, and row numbers in it, without a copy of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SAMPLES = 32  # keys sampled for each slice


def slice_bounds(df: DataFrame, order_by: list[str], slices: int) -> list[tuple]:
    """Keys that cut the order into about ``slices`` even parts, from a sample of the keys.

    Reads only the key columns; the driver gets some tens of keys for each slice.
    """
    if slices < 2:
        return []
    some = df.select(*order_by).orderBy(F.rand(11)).limit(SAMPLES * slices)
    ordered = [tuple(r) for r in some.orderBy(*order_by).collect()]
    cuts = [ordered[i * len(ordered) // slices] for i in range(1, slices)] if ordered else []
    return [c for i, c in enumerate(cuts) if not i or c != cuts[i - 1]]


def slice_number(df: DataFrame, order_by: list[str], bounds: list[tuple]) -> Column:
    """How many of ``bounds`` are not above a row's key, by bisection; nulls come first.

    The number is a function of the key alone, so every pass over the rows, and every
    repeated task, puts a row into the same slice.
    """
    if not bounds:
        return F.lit(0)
    types = [df.schema[c].dataType for c in order_by]
    table = F.array(*[
        F.struct(*[F.lit(v).cast(t).alias(f"k{i}") for i, (v, t) in enumerate(zip(b, types))]) for b in bounds
    ])
    return not_above(table, key_of(order_by), len(bounds))


def key_of(order_by: list[str]) -> Column:
    """The order columns as one comparable value; nulls come first."""
    return F.struct(*[F.col(c).alias(f"k{i}") for i, c in enumerate(order_by)])


def not_above(table: Column, key: Column, most: int) -> Column:
    """How many entries of a sorted array of at most ``most`` are not above ``key``."""
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(most.bit_length()))])
    return F.aggregate(
        steps, F.lit(0), lambda at, step: F.when(F.get(table, at + step - 1) <= key, at + step).otherwise(at)
    )


def with_arrival_index(
    df: DataFrame, order_by: list[str], name: str = "arrival_index", partitions: int | None = None
) -> DataFrame:
    """Add a dense 0-based index in ``order_by`` order (make the keys unique).

    Two passes read the keys only: a sample gives the bounds of slices, a count gives the
    rows before each slice. The rows themselves are shuffled once, by slice, and numbered
    inside it. ``df`` must give the same rows each time it is read.
    """
    n = partitions or 2 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bounds = slice_bounds(df, order_by, n)
    sliced = df.withColumn("_slice", slice_number(df, order_by, bounds))
    sizes = {r[0]: r[1] for r in sliced.groupBy("_slice").count().collect()}  # one row a slice
    before, base = 0, []
    for i in range(len(bounds) + 1):
        base.append(before)
        before += sizes.get(i, 0)
    inside = F.row_number().over(Window.partitionBy("_slice").orderBy(*order_by))
    start = F.get(F.lit(base).cast("array<bigint>"), F.col("_slice"))
    return sliced.withColumn(name, start + inside - 1).drop("_slice")
