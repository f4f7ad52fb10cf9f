"""Syslog lines to events."""

from __future__ import annotations

import codecs
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventflow.functions.text import decode_by
from eventflow.schema import empty_body, header_map

# Message patterns, header names and status words.
RFC5424 = (
    r"(?:\<(\d{1,3})\>)"
    r"(?:(\d?)\s?)"
    r"(?:(\d{4}[-]\d{2}[-]\d{2}[T]\d{2}[:]\d{2}[:]\d{2}"
    r"(?:\.\d{1,6})?(?:[+-]\d{2}[:]\d{2}|Z)?)|-)"
    r"\s(?:([\w][\w\d\.@\-]*)|-)\s(.*)$"
)
RFC3164 = (
    r"(?:\<(\d{1,3})\>)"
    r"(?:(\d)?\s?)"
    r"([A-Z][a-z][a-z]\s{1,2}\d{1,2}\s\d{2}[:]\d{2}[:]\d{2})"
    r"\s([\w][\w\d\.@-]*)\s(.*)$"
)
FACILITY, SEVERITY = "Facility", "Severity"
STATUS_HEADER = "syslog.status"
INVALID, INCOMPLETE = "Invalid", "Incomplete"
KEEPABLE = ("priority", "version", "timestamp", "hostname")
MIN_SIZE, DEFAULT_SIZE = 10, 2500

SEP = "\u0001"


@dataclass(frozen=True)
class SyslogFormat:
    """A user message format: five groups priority, version, stamp, host, body."""

    regex: str
    search: str | None = None
    replace: str | None = None
    date_format: str | None = None


def keep_set(keep_fields: str | None) -> frozenset[str] | None:
    """``none`` -> None, ``all`` -> the word ``all``, else the named fields found."""
    if keep_fields is None:
        return None
    text = keep_fields.strip().lower()
    if text in ("false", "none"):
        return None
    if text in ("true", "all"):
        return frozenset(["all"])
    return frozenset(f for f in KEEPABLE if f in text)


def split_messages(
    df: DataFrame, raw: str, max_size: int = DEFAULT_SIZE, as_bytes: bool = False
) -> DataFrame:
    """Cut raw bytes into messages: one per non-blank line, over-long ones in pieces.

    Adds ``message`` (binary) and ``cut`` (the piece reached the size limit). ``as_bytes``
    is for bytes that need not be UTF-8.
    """
    size = max(max_size, MIN_SIZE)
    text = F.col(raw).cast("string")
    if as_bytes:  # a character for each byte, and back
        text = F.decode(F.col(raw).cast("binary"), "ISO-8859-1")

    def to_bytes(value: Column) -> Column:
        return F.encode(value, "ISO-8859-1") if as_bytes else value.cast("binary")

    def pieces(line: Column) -> Column:
        data = to_bytes(line)
        count = F.ceil(F.octet_length(data) / F.lit(size)).cast("int")
        return F.transform(
            F.sequence(F.lit(0), F.greatest(count, F.lit(1)) - 1),
            lambda n: F.substr(data, n * size + 1, F.lit(size)),
        )

    lines = F.filter(F.split(text, "\n", -1), lambda x: x != "")
    # Most input is one short line already.
    length = F.char_length(text) if as_bytes else F.octet_length(text)
    simple = (length <= size) & ~F.contains(text, F.lit("\n")) & (text != "")
    parts = F.when(simple, F.array(to_bytes(text))).otherwise(
        F.flatten(F.transform(lines, pieces))
    )
    out = df.withColumn("message", F.explode(parts))
    return out.withColumn("cut", F.octet_length("message") >= size)


def parse_syslog(
    df: DataFrame,
    raw: str = "body",
    *,
    keep_fields: str | None = None,
    max_size: int = DEFAULT_SIZE,
    formats: tuple[SyslogFormat, ...] = (),
    now: Column | None = None,
    compat: bool = False,
    status_header: str = STATUS_HEADER,
    extra_headers: dict[str, Column] | None = None,
    charset: str = "UTF-8",
    port: Column | None = None,
    port_charsets: dict[int, str] | None = None,
) -> DataFrame:
    """Parse raw syslog bytes or text into events (replaces ``headers`` and ``body``).

    User formats are tried first, then RFC 5424, then RFC 3164. By default stamps
    honour their zone and a year-less stamp rolls to the nearest year; ``compat``
    ignores the zone after a fraction and only ever rolls back. Columns of ``df``
    other than ``raw``/``headers``/``body`` are kept; ``extra_headers`` adds e.g. a
    port header.

    Bytes are taken as ``charset``, or as what ``port_charsets`` has for their ``port``;
    messages are cut at the byte 0x0A, so these must be ASCII-compatible. Headers and
    bodies of events are UTF-8. An unknown charset raises.
    """
    now = F.current_timestamp() if now is None else now
    keep = keep_set(keep_fields)
    carried = [c for c in df.columns if c not in (raw, "headers", "body")]
    names = [charset, *(port_charsets or {}).values()]
    plain = all(codecs.lookup(n).name == "utf-8" for n in names)
    cut = split_messages(df, raw, max_size, as_bytes=not plain)
    if not plain:
        chosen = F.lit(charset)
        for number, name in (port_charsets or {}).items():
            chosen = F.when(port.cast("int") == number, F.lit(name)).otherwise(chosen)
        decoded = decode_by(F.col("message"), F.col("_charset"), names)
        cut = cut.withColumn("_charset", chosen).withColumn("message", decoded.cast("binary"))
    text = F.col("message").cast("string")
    good = text.rlike(r"^<[0-9]{1,3}>")
    all_formats = [*formats, SyslogFormat(RFC5424), SyslogFormat(RFC3164)]

    # One regex evaluation per format: the replacement starts with a separator and the
    # format number, which no message does (they start with '<'), and puts the five
    # groups behind, body last, so a bounded split is exact whatever the body holds.
    tagged = text
    for i, fmt in enumerate(all_formats):
        groups = SEP.join(f"${g}" for g in range(1, 6))
        replaced = F.regexp_replace(tagged, rf"\A(?:{fmt.regex})\z", f"{SEP}{i}{SEP}{groups}")
        # Built-in formats need a leading '<', so they cannot touch a tagged text.
        guard = 0 < i < len(formats)
        tagged = F.when(tagged.startswith(SEP), tagged).otherwise(replaced) if guard else replaced
    # Small projections one after another: each compiles to a method the JIT accepts.
    staged = cut.select(
        *carried, "message", "cut", good.alias("good"), F.when(good, tagged).alias("t")
    ).select(
        *carried, "message", "cut", "good",
        F.when(F.col("t").startswith(SEP), F.split("t", SEP, 7)).alias("m"),
    )

    def group(i: int) -> Column:
        return F.nullif(F.col("m")[i + 2], F.lit(""))

    n = len(formats)
    number = F.col("m")[1]
    stamp = F.col("stamp")
    when = F.when(number == str(n), _rfc5424_time(stamp, compat)).when(
        number == str(n + 1), _rfc3164_time(stamp, now)
    )
    for i, fmt in enumerate(formats):
        when = when.when(number == str(i), _user_time(stamp, fmt))
    staged = staged.select(
        *carried, "message", "cut", "good", "m", group(2).alias("stamp")
    ).select(
        *carried, "message", "cut", "good", "m", "stamp",
        (number == str(n + 1)).alias("yearless"), when.alias("at"),
    )
    rolled = _roll_year(F.col("at"), now, compat)
    millis = F.unix_millis(F.when(F.col("yearless"), rolled).otherwise(F.col("at")))

    priority = F.substring_index(F.substring(F.col("message").cast("string"), 2, 4), ">", 1)
    code = F.when(F.col("good"), priority.cast("int")).otherwise(F.lit(0))
    body = group(4)
    if keep is not None and "all" not in keep:
        blank = "null" if compat else "-"
        if "hostname" in keep:
            body = F.concat(F.coalesce(group(3), F.lit(blank)), F.lit(" "), F.col("m")[6])
        else:
            body = F.col("m")[6]
        if "timestamp" in keep:
            body = F.concat(F.coalesce(stamp, F.lit(blank)), F.lit(" "), body)
        if "version" in keep:
            body = F.concat(F.coalesce(F.concat(group(1), F.lit(" ")), F.lit("")), body)
        if "priority" in keep:
            body = F.concat(F.lit("<"), group(0), F.lit(">"), body)
        body = F.when(body != "", body)
    payload = F.col("message")
    if keep is None or "all" not in keep:
        payload = F.coalesce(body.cast("binary"), F.col("message"))

    status = F.when(~F.col("good"), F.lit(INVALID)).when(F.col("cut"), F.lit(INCOMPLETE))
    entries = {
        FACILITY: F.shiftright(code, 3),
        SEVERITY: F.pmod(code, F.lit(8)),
        "priority": group(0),
        "version": group(1),
        "timestamp": millis,
        "host": group(3),
        **(extra_headers or {}),
    }
    headers = header_map(entries, drop_null=True)
    flagged = F.map_concat(headers, F.create_map(F.lit(status_header), status))
    headers = F.when(status.isNull(), headers).otherwise(flagged)
    return staged.select(
        *carried, headers.alias("headers"), F.coalesce(payload, empty_body()).alias("body")
    )


def _user_time(stamp: Column, fmt: SyslogFormat) -> Column:
    if fmt.search is not None and fmt.replace is not None:
        stamp = F.regexp_replace(stamp, fmt.search, fmt.replace)
    if fmt.date_format is None:
        return F.lit(None).cast("timestamp")
    return F.try_to_timestamp(stamp, F.lit(fmt.date_format))


def _rfc5424_time(stamp: Column, compat: bool) -> Column:
    honest = stamp.try_cast("timestamp")
    if not compat:
        return honest
    # The first date format that fits ignores whatever follows the fraction, and reads
    # the fraction as a count of milliseconds.
    digits = F.regexp_extract(stamp, r"\.(\d{1,3})", 1)
    local = F.unix_millis(F.substring(stamp, 1, 19).try_cast("timestamp"))
    counted = F.timestamp_millis(local + digits.try_cast("bigint"))
    return F.when(digits != "", counted).otherwise(honest)


def _rfc3164_time(stamp: Column, now: Column) -> Column:
    dated = F.concat(F.year(now).cast("string"), F.replace(stamp, F.lit("  "), F.lit(" ")))
    return F.try_to_timestamp(dated, F.lit("yyyyMMM d HH:mm:ss"))


def _roll_year(at: Column, now: Column, compat: bool) -> Column:
    """Move a stamp dated in the current year to within 11 months back, 1 month ahead."""
    one_year = F.expr("INTERVAL '1' YEAR")
    ahead = at - F.expr("INTERVAL '1' MONTH") > now
    behind = at + F.expr("INTERVAL '11' MONTH") < now
    return (
        F.when(ahead, at - one_year)
        .when(behind, (at - one_year) if compat else (at + one_year))
        .otherwise(at)
    )


def typed_syslog(df: DataFrame) -> DataFrame:
    """Syslog events as typed rows."""
    h = F.col("headers")
    return df.select(
        h[FACILITY].cast("int").alias("facility"),
        h[SEVERITY].cast("int").alias("severity"),
        F.coalesce(h["timestamp"].cast("bigint"), F.lit(0).cast("bigint")).alias("timestamp"),
        F.coalesce(h["host"], F.lit("")).alias("hostname"),
        F.col("body").cast("string").alias("message"),
    )


__all__ = ["SyslogFormat", "parse_syslog", "split_messages", "typed_syslog", "keep_set"]
