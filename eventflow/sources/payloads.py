"""Request payloads and raw byte chunks to events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventflow.functions import headers as hdr
from eventflow.functions.text import cut_lines, whole_lines
from eventflow.schema import JSON_EVENTS_DDL, body_bytes, empty_headers, is_utf8, to_events

JSON_CHARSETS = ("UTF-8", "UTF-16", "UTF-32")


def parse_json_events(
    df: DataFrame, payload: str = "payload", charset: str = "UTF-8", keep: tuple[str, ...] = ()
) -> tuple[DataFrame, DataFrame]:
    """JSON arrays of ``{headers, body}`` to (events, rejected payloads).

    A payload that is not such an array is rejected whole. Bodies keep the charset.
    """
    if charset.upper() not in JSON_CHARSETS:
        raise ValueError(f"charset must be one of {JSON_CHARSETS}")
    raw = F.col(payload)
    if dict(df.dtypes)[payload] == "binary":
        raw = F.decode(raw, charset)
    # Two steps, so that a payload is parsed once however often its events are used.
    text = F.regexp_replace(raw, r"\A[\s\ufeff]+|\s+\z", "")
    parsed = F.from_json(F.concat(F.lit('{"a":'), text, F.lit(',"z":1}')), f"a {JSON_EVENTS_DDL}, z int")
    staged = df.withColumns({"_text": text, "_parsed": parsed})
    staged = staged.withColumn("_events", _strict_events(F.col("_text"), F.col("_parsed"))).drop("_parsed", "_text")
    # A rejected payload has no events and explodes to no row.
    events = staged.select(*keep, F.explode("_events").alias("_e"))
    out = to_events(events, F.col("_e.headers"), F.col("_e.body"), keep=keep, charset=charset)
    return out, staged.filter(F.col("_events").isNull()).drop("_events")


def _strict_events(text: Column, parsed: Column) -> Column:
    """Events of a payload that is one array and nothing else, with plain values only.

    The parser stops behind the first value, so a payload is parsed as a field of an object
    whose last field must come through, and counted as an item of an array: no text behind
    the payload passes both. It renders nested values as text, so where a text looks like
    one a second look, at variants, tells a nested value from a text in quotes.
    """
    events = parsed["a"]
    items = F.json_array_length(F.concat(F.lit("["), text, F.lit(",1]")))
    good = text.startswith("[") & (parsed["z"] == 1) & (items == 2)
    looks_nested = lambda v: F.coalesce(v.rlike(r"\A[\[{]"), F.lit(False))
    values = lambda e: F.map_values(F.coalesce(e["headers"], F.create_map().cast("map<string,string>")))
    suspect = F.exists(events, lambda e: looks_nested(e["body"]) | F.exists(values(e), looks_nested))
    kinds = F.from_json(text, "array<struct<headers: map<string,variant>, body: variant>>")
    is_nested = lambda v: F.coalesce(
        F.try_variant_get(v, "$", "map<string,variant>").isNotNull()
        | F.try_variant_get(v, "$", "array<variant>").isNotNull(), F.lit(False)
    )
    variants = lambda e: F.map_values(F.coalesce(e["headers"], F.create_map().cast("map<string,variant>")))
    nested = F.exists(kinds, lambda e: is_nested(e["body"]) | F.exists(variants(e), is_nested))
    plain = F.when(F.coalesce(suspect, F.lit(False)), ~F.coalesce(nested, F.lit(True))).otherwise(F.lit(True))
    return F.when(F.coalesce(good, F.lit(False)), F.when(plain, events))


def parse_blob_request(
    df: DataFrame,
    params: str = "params",
    payload: str = "payload",
    mandatory: list[str] = (),
    keep: tuple[str, ...] = (),
) -> tuple[DataFrame, DataFrame]:
    """Requests (``map<string,array<string>>`` parameters, bytes) to (events, rejected).

    The first value of each parameter becomes a header; a missing mandatory parameter
    rejects the request.
    """
    ok = F.lit(True)
    for name in mandatory:
        ok = ok & F.coalesce(F.map_contains_key(params, name), F.lit(False))
    headers = F.transform_values(F.col(params), lambda _, v: F.get(v, F.lit(0)))
    good = to_events(df.filter(ok), headers, F.col(payload), keep=keep, binary=True)
    return good, df.filter(~ok)


def read_lines(
    df: DataFrame,
    text: str = "body",
    max_length: int = 2048,
    charset: str = "UTF-8",
    compat: bool = False,
) -> DataFrame:
    """One event per line of a text column, over-long lines in pieces; adds ``line_no``."""
    carried = [c for c in df.columns if c not in (text, "body", "headers")]
    headers = F.col("headers") if "headers" in df.columns else empty_headers()
    content = F.col(text)
    if dict(df.dtypes)[text] == "binary":
        content = content.cast("string") if is_utf8(charset) else F.decode(content, charset)
    # Step by step, so the text is split once although its parts are used repeatedly.
    t = F.col("_text")
    staged = (
        df.select(*carried, headers.alias("headers"), content.alias("_text"))
        .select(*carried, "headers", "_text", F.split(t, "\n", -1).alias("_parts"))
        .select(*carried, "headers", "_text", whole_lines(F.col("_parts"), t).alias("_whole"))
    )
    lines = cut_lines(F.col("_whole"), t, max_length, compat)
    return staged.select(*carried, "headers", F.posexplode(lines).alias("line_no", "_line")).select(
        *carried, "line_no", "headers", body_bytes(F.col("_line"), charset).alias("body")
    )


def frame_lines(
    df: DataFrame, chunk: str = "body", max_length: int = 512
) -> tuple[DataFrame, DataFrame]:
    """Newline-terminated lines of a connection's text to (events, refused connections).

    A line longer than ``max_length`` ends its connection: the lines before it are
    events, the connection is refused from there on. Text after the last newline is
    not complete and stays out.
    """
    carried = [c for c in df.columns if c not in (chunk, "headers", "body")]
    text = F.col(chunk).cast("string") if dict(df.dtypes)[chunk] == "binary" else F.col(chunk)
    df = df.select(*carried, F.split(text, "\n", -1).alias("_parts"))
    parts = F.col("_parts")
    complete = F.slice(parts, F.lit(1), F.size(parts) - 1)
    # Position of the first over-long piece, or 0; the unterminated tail counts too.
    too_long = F.array_position(F.transform(parts, lambda x: F.length(x) > max_length), True)
    staged = df.withColumn("_bad", too_long).withColumn("_lines", complete)
    kept = F.when(F.col("_bad") > 0, F.slice("_lines", F.lit(1), (F.col("_bad") - 1).cast("int")))
    rows = staged.select(
        *carried,
        F.posexplode(kept.otherwise(F.col("_lines"))).alias("line_no", "_line"),
    )
    events = rows.select(
        *carried,
        "line_no",
        empty_headers().alias("headers"),
        body_bytes(F.col("_line")).alias("body"),
    )
    return events, staged.filter(F.col("_bad") > 0).select(*carried, F.col("_bad").alias("failed_line"))


def frame_datagrams(
    df: DataFrame, payload: str = "body", address: str = "address",
    header: str = "REMOTE_ADDRESS", keep: tuple[str, ...] = (),
) -> DataFrame:
    """Datagrams: text up to the first newline, sender address in a header."""
    text = F.col(payload).cast("string")
    return to_events(
        df, {header: F.col(address)}, F.substring_index(text, "\n", 1), keep=keep
    )


def decode_event_format(df: DataFrame, value: str = "value") -> DataFrame:
    """JSON-encoded events in a message value to a ``struct<headers,body>`` column."""
    parsed = F.from_json(
        F.col(value).cast("string"), "struct<headers:map<string,string>,body:string>"
    )
    return df.withColumn(
        value,
        F.struct(
            parsed["headers"].alias("headers"),
            body_bytes(parsed["body"]).alias("body"),
        ),
    )


def overlay_headers(df: DataFrame, extra: Column) -> DataFrame:
    return df.withColumn("headers", hdr.overlay(F.col("headers"), extra))
