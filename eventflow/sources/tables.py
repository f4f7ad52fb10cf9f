"""Incremental reads of a database table or query."""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import asdict, dataclass

import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventflow.functions.text import csv_line
from eventflow.schema import to_events

MARKER = "$@$"  # fixed value: stands for the last value in a custom query
DEFAULT_ROWS = 10_000


@dataclass
class ReadStatus:
    """What was being read and how far; saved only after a batch succeeded."""

    source: str
    url: str
    table: str | None
    columns: str | None
    query: str | None
    last: str

    def same_read(self, other: "ReadStatus") -> bool:
        mine, theirs = asdict(self), asdict(other)
        mine.pop("last"), theirs.pop("last")
        return mine == theirs


def load_status(path: str, expected: ReadStatus) -> ReadStatus:
    """Saved status if it describes the same read; otherwise back it up and start over."""
    fs, at = pafs.FileSystem.from_uri(path)
    if fs.get_file_info(at).type == pafs.FileType.NotFound:
        return expected
    with fs.open_input_stream(at) as handle:
        text = handle.read().decode()
    try:
        saved = ReadStatus(**json.loads(text))
    except (ValueError, TypeError):
        saved = None
    if saved is not None and saved.same_read(expected):
        return saved
    with fs.open_output_stream(at + ".bak") as handle:
        handle.write(text.encode())
    return expected


def save_status(path: str, status: ReadStatus) -> None:
    """Write beside the target, then rename: a crash leaves the old or the new status."""
    fs, at = pafs.FileSystem.from_uri(path)
    with fs.open_output_stream(at + ".new") as handle:
        handle.write(json.dumps(asdict(status)).encode())
    fs.move(at + ".new", at)


def page_query(table: str, columns: str, order_by: str, offset: str, max_rows: int) -> str:
    """One page in standard SQL; the order key makes paging stable."""
    return (
        f"SELECT {columns} FROM {table} ORDER BY {order_by} "
        f"OFFSET {int(offset)} ROWS FETCH NEXT {int(max_rows)} ROWS ONLY"
    )


def custom_query(query: str, last: str) -> str:
    return query.replace(MARKER, last)


def read_jdbc_incremental(
    spark: SparkSession,
    url: str,
    status: ReadStatus,
    *,
    order_by: str | None = None,
    max_rows: int = DEFAULT_ROWS,
    properties: dict[str, str] | None = None,
) -> DataFrame:
    """The next page of a table, or the next result of a ``$@$`` query.

    The database does the filtering and limiting, so only new rows cross the wire.
    """
    if status.query:
        sql = custom_query(status.query, status.last)
    else:
        if not order_by:
            raise ValueError("order_by is required: pages of an unordered table overlap")
        sql = page_query(status.table, status.columns or "*", order_by, status.last, max_rows)
    return spark.read.format("jdbc").options(url=url, query=sql, **(properties or {})).load()


def advance(status: ReadStatus, rows: DataFrame, order_by: str | None = None) -> ReadStatus:
    """Status after the rows: row count for pages, last first-column value for queries."""
    if status.query:
        first = rows.columns[0]
        key = order_by or first
        last = rows.agg(F.max_by(F.col(first), F.col(key)).cast("string").alias("v")).first()["v"]
        return ReadStatus(**{**asdict(status), "last": last if last is not None else status.last})
    return ReadStatus(**{**asdict(status), "last": str(int(status.last) + rows.count())})


def poll(
    spark: SparkSession,
    url: str,
    status_path: str,
    expected: ReadStatus,
    process: Callable[[DataFrame], None],
    *,
    order_by: str | None = None,
    max_rows: int = DEFAULT_ROWS,
    read: Callable[..., DataFrame] = read_jdbc_incremental,
    **options,
) -> ReadStatus:
    """Read the next rows, process them, then move the saved position.

    The rows are held while they are processed and counted, so the database is asked
    once; if processing fails the position stays and the rows come again.
    """
    status = load_status(status_path, expected)
    rows = read(spark, url, status, order_by=order_by, max_rows=max_rows, **options).persist()
    try:
        if rows.isEmpty():
            return status
        process(rows)
        moved = advance(status, rows, None if status.query is None else order_by)
        save_status(status_path, moved)
        return moved
    finally:
        rows.unpersist()


def read_jdbc_whole(
    spark: SparkSession, url: str, table: str, column: str, lower, upper, parts: int,
    properties: dict[str, str] | None = None,
) -> DataFrame:
    """First full load, spread over ``parts`` connections by a numeric column."""
    return (
        spark.read.format("jdbc")
        .options(
            url=url, dbtable=table, partitionColumn=column, lowerBound=str(lower),
            upperBound=str(upper), numPartitions=str(parts), **(properties or {}),
        )
        .load()
    )


def rows_to_events(
    df: DataFrame,
    columns: list[str] | None = None,
    quote_all: bool = True,
    sep: str = ",",
    clock: Column | None = None,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Table rows to events: the row as one CSV line, stamped with ``timestamp``."""
    now = F.unix_millis(F.current_timestamp()) if clock is None else clock
    line = csv_line(columns or df.columns, quote_all, sep)
    return to_events(df, {"timestamp": now}, line, keep=keep)
