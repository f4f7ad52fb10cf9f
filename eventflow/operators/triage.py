"""Telling good, undecodable and failing events apart."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult

from eventflow.functions import headers as hdr

# Marker headers.
DONE_HEADER, POISON_HEADER = "IS_PROCESSED_SUCCESSFULLY", "POISONED_EVENT"
OK, DROPPED, POISON = "ok", "dropped", "poison"


def json_records(ddl: str) -> Callable[[Column], Column]:
    """Body parser: a JSON array of records; null when it does not parse."""
    return lambda body: F.from_json(body.cast("string"), f"array<{ddl}>")


def typed_rows(
    df: DataFrame,
    parse: str | Callable[[Column], Column],
    name: str = "row",
    first_only: bool = False,
) -> DataFrame:
    """Bodies to 0..n typed rows per event.

    ``parse`` is the record type of a JSON array, or any function from the body to an
    array column. A body that does not parse gives no row. ``first_only`` keeps the
    first record.
    """
    parsed = (json_records(parse) if isinstance(parse, str) else parse)(F.col("body"))
    if first_only:
        parsed = F.slice(parsed, 1, 1)
    return df.withColumn(name, F.explode(parsed))


def typed_rows_by(
    df: DataFrame,
    parse: Callable[[bytes], Iterable[tuple]],
    ddl: str,
    *,
    first_only: bool = False,
) -> DataFrame:
    """Bodies to 0..n typed rows by a Python function, for forms that no Column can read.

    ``parse`` takes a body and gives the records' values in the order of ``ddl``; a body on
    which it raises ValueError gives no row, and so does a null one. The function is a table
    function that meets each event by a lateral join: it runs where the events are (nothing
    is shuffled), bodies and rows pass in Arrow batches, and it may give any number of rows.
    All columns of ``df`` stay, the record's columns come last.
    """
    table = _record_table(parse, first_only)
    return df.lateralJoin(table(F.col("body").outer(), F.lit(T.StructType.fromDDL(ddl).json())))


def _record_table(parse: Callable[[bytes], Iterable[tuple]], first_only: bool):
    class Records:
        @staticmethod
        def analyze(body: AnalyzeArgument, schema: AnalyzeArgument) -> AnalyzeResult:
            if body.dataType != T.BinaryType():
                raise ValueError("records are read from a binary body")
            return AnalyzeResult(schema=T.StructType.fromJson(json.loads(schema.value)))

        def eval(self, body: bytes, schema: str):
            try:
                records = [] if body is None else [tuple(r) for r in parse(bytes(body))]
            except ValueError:
                return
            yield from records[:1] if first_only else records

    return F.udtf(Records, useArrow=True)


def undecodable(df: DataFrame, parse: str | Callable[[Column], Column]) -> DataFrame:
    """The events ``typed_rows`` drops: unparseable or empty."""
    parsed = (json_records(parse) if isinstance(parse, str) else parse)(F.col("body"))
    return df.filter(F.coalesce(F.size(parsed), F.lit(0)) < 1)


def split_poison(df: DataFrame, parsed: Column, processed: Column) -> DataFrame:
    """Add ``status``: ``dropped`` (did not parse), ``ok`` or ``poison`` (processing failed).

    Outcomes are also marked in the headers, so a retry can tell them apart.
    """
    status = (
        F.when(parsed.isNull(), F.lit(DROPPED))
        .when(F.coalesce(processed, F.lit(False)), F.lit(OK))
        .otherwise(F.lit(POISON))
    )
    out = df.withColumn("status", status)
    mark = hdr.put_present(
        F.col("headers"),
        {
            DONE_HEADER: F.when(F.col("status") == OK, F.lit("true")),
            POISON_HEADER: F.when(F.col("status") == POISON, F.lit("true")),
        },
    )
    return out.withColumn("headers", mark)


def commit_or_raise(triaged: DataFrame, write: Callable[[DataFrame], None]) -> dict[str, int]:
    """Write the good events only if none is poisoned; otherwise fail the whole batch."""
    held = triaged.persist()
    try:
        counts = {r["status"]: r["count"] for r in held.groupBy("status").count().collect()}
        if counts.get(POISON):
            raise RuntimeError(f"{counts[POISON]} poisoned events, batch rolled back")
        write(held.filter(F.col("status") == OK))
    finally:
        held.unpersist()
    return counts


def undelivered(put: DataFrame, delivered: DataFrame, keys: list[str]) -> DataFrame:
    """Events put into a flow that no sink has delivered."""
    return put.join(delivered.select(*keys).distinct(), keys, "left_anti")
