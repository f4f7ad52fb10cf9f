"""The event envelope and how tables become events and back."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

EVENT_SCHEMA = T.StructType(
    [
        T.StructField("headers", T.MapType(T.StringType(), T.StringType(), True), True),
        T.StructField("body", T.BinaryType(), True),
    ]
)

#: JSON form of an event, as carried by HTTP-style payloads.
JSON_EVENTS_DDL = "array<struct<headers:map<string,string>,body:string>>"


def is_utf8(charset: str) -> bool:
    return charset.upper().replace("-", "") == "UTF8"


def empty_body() -> Column:
    return F.lit(b"")


def empty_headers() -> Column:
    return F.create_map().cast("map<string,string>")


def header_map(entries: dict[str, Column], drop_null: bool = False) -> Column:
    """Build a header map; every value is rendered as a string.

    ``drop_null=True`` makes a null value mean "no such header" (absent and
    null-valued headers are different things).
    """
    if not entries:
        return empty_headers()
    pairs = [part for k, v in entries.items() for part in (F.lit(k), v.cast("string"))]
    built = F.create_map(*pairs)
    if not drop_null:
        return built
    # Lambdas are interpreted, so take them only for rows that do have a null.
    complete = reduce(and_, [v.isNotNull() for v in entries.values()])
    return F.when(complete, built).otherwise(F.map_filter(built, lambda _, v: v.isNotNull()))


def body_bytes(body: Column | None, charset: str = "UTF-8", binary: bool = False) -> Column:
    """Event body from text (encoded) or bytes; null becomes the empty body."""
    if body is None:
        return empty_body()
    if not binary:
        # A cast keeps the bytes as they are; encode() would go through a Java string.
        body = body.cast("binary") if is_utf8(charset) else F.encode(body, charset)
    return F.coalesce(body, empty_body())


def to_events(
    df: DataFrame,
    headers: dict[str, Column] | Column,
    body: Column | None,
    *,
    keep: tuple[str, ...] = (),
    charset: str = "UTF-8",
    binary: bool = False,
    drop_null: bool = False,
) -> DataFrame:
    """Project any table to events; ``keep`` carries columns beside the envelope."""
    hdr = header_map(headers, drop_null) if isinstance(headers, dict) else headers
    return df.select(
        *keep,
        F.coalesce(hdr, empty_headers()).alias("headers"),
        body_bytes(body, charset, binary).alias("body"),
    )


def header(name: str, headers: str = "headers") -> Column:
    """Value of a header; null when absent or null-valued."""
    return F.col(headers)[name]


def has_header(name: str, headers: str = "headers") -> Column:
    """True when the key is present, whatever its value."""
    return F.map_contains_key(F.col(headers), name)


def body_text(charset: str = "UTF-8", body: str = "body") -> Column:
    """Body as text; malformed input raises (see ``functions.text`` for policies)."""
    if is_utf8(charset):
        return F.col(body).cast("string")
    return F.decode(F.col(body), charset)


def from_events(df: DataFrame, columns: dict[str, str], body_as: str | None = None) -> DataFrame:
    """Promote headers to typed columns: ``{"user_id": "bigint", ...}``."""
    out = [header(name).cast(dtype).alias(name) for name, dtype in columns.items()]
    if body_as:
        out.append(body_text().alias(body_as))
    return df.select(*out)


def make_rows(events) -> list[tuple[dict, bytes]]:
    """``(headers, body)`` pairs as rows of EVENT_SCHEMA; text is encoded, None is empty."""
    return [
        (dict(h or {}), b.encode() if isinstance(b, str) else bytes(b or b"")) for h, b in events
    ]
