"""Header- and time-based bucket names, compiled once into native columns."""

from __future__ import annotations

import re
import socket

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# The escape grammar and the date pattern behind each letter.
TAG = re.compile(r"%(\w|%)|%\{([\w\.-]+)\}|%\[(\w+)\]", re.ASCII)
DATE_PATTERNS = {
    "a": "EEE",
    "A": "EEEE",
    "b": "MMM",
    "B": "MMMM",
    "c": "EEE MMM d HH:mm:ss yyyy",
    "d": "dd",
    "e": "d",
    "D": "MM/dd/yy",
    "H": "HH",
    "I": "hh",
    "j": "DDD",
    "k": "H",
    "l": "h",
    "m": "MM",
    "M": "mm",
    "n": "M",
    "p": "a",
    "S": "ss",
    "y": "yy",
    "Y": "yyyy",
    "z": "ZZZ",
}
ROUND_LIMITS = {"second": 60, "minute": 60, "hour": 24}
UTC_NAMES = {"UTC", "ETC/UTC", "GMT", "ETC/GMT", "Z", "+00:00"}


def session_zone() -> str:
    spark = SparkSession.getActiveSession()
    return spark.conf.get("spark.sql.session.timeZone") if spark else "UTC"


def is_utc(tz: str) -> bool:
    return tz.upper() in UTC_NAMES


def wall_clock(ms: Column, tz: str | None = None) -> Column:
    """A timestamp that shows the wall time of ``tz`` when rendered in the session zone."""
    zone, here = tz or session_zone(), session_zone()
    ts = F.timestamp_millis(ms)
    if zone == here or (is_utc(zone) and is_utc(here)):
        return ts
    return F.convert_timezone(
        F.lit(here), F.lit(zone), ts.cast("timestamp_ntz")
    ).cast("timestamp")


def zone_offset_ms(ms: Column, tz: str) -> Column:
    """Offset of ``tz`` from UTC at the instant, in milliseconds."""
    here = session_zone()
    local = wall_clock(ms, tz).cast("timestamp_ntz")
    as_utc = F.convert_timezone(F.lit("UTC"), F.lit(here), local).cast("timestamp")
    return F.unix_millis(as_utc) - ms


def round_down(ms: Column, unit: str, value: int = 1, tz: str | None = None) -> Column:
    """Round epoch millis down to a multiple of ``value`` within the enclosing unit.

    7-minute rounding restarts every hour, 5-hour rounding every day (of ``tz``).
    """
    unit = unit.lower()
    if unit not in ROUND_LIMITS:
        raise ValueError(f"unit must be one of {sorted(ROUND_LIMITS)}")
    n = 1 if value <= 0 else value
    if n > ROUND_LIMITS[unit]:
        raise ValueError(f"{unit} rounding must be within 1..{ROUND_LIMITS[unit]}")
    zone = tz or session_zone()
    step, cycle = {"second": (1000, 60), "minute": (60_000, 60), "hour": (3_600_000, 24)}[unit]
    # Integer arithmetic on local millis: position in the enclosing unit, then in the step.
    local = ms if is_utc(zone) else ms + zone_offset_ms(ms, zone)
    within = F.pmod(local, F.lit(step * cycle))
    rounded = ms - F.pmod(within, F.lit(step * n))
    if unit == "hour" and not is_utc(zone):
        # A clock change between the rounded and the given time shifts the wall hour.
        hour = F.floor(within / F.lit(step))
        got = F.pmod(F.floor((rounded + zone_offset_ms(rounded, zone)) / F.lit(step)), F.lit(24))
        shift = F.pmod(hour - F.pmod(hour, F.lit(n)) - got + 12, F.lit(24)) - 12
        rounded = (rounded + shift * step).cast("bigint")
    return F.when(ms > 0, rounded).otherwise(
        F.raise_error(F.lit("timestamp must be positive")).cast("bigint")
    )


def event_millis(headers: Column, name: str = "timestamp") -> Column:
    """Epoch millis of an event; a missing or non-numeric header is an error."""
    value = headers[name].try_cast("bigint")
    return F.coalesce(
        value,
        F.raise_error(F.lit(f"event header '{name}' is missing or not a number")).cast("bigint"),
    )


def static_names(host: str | None = None, ip: str | None = None, fqdn: str | None = None):
    """Values of ``%[localhost] %[IP] %[FQDN]``, resolved once on the driver."""

    def resolve(name: str) -> str:
        given = {"localhost": host, "ip": ip, "fqdn": fqdn}[name]
        if given is not None:
            return given
        here = socket.gethostname()
        if name == "localhost":
            return here
        return socket.gethostbyname(here) if name == "ip" else socket.getfqdn(here)

    return resolve


def bucket_path(
    pattern: str,
    headers: Column | None = None,
    *,
    tz: str | None = None,
    round_unit: str | None = None,
    round_value: int = 1,
    clock: Column | None = None,
    statics=None,
) -> Column:
    """Expand a bucket pattern for each event.

    ``clock`` (epoch millis) replaces the ``timestamp`` header for the whole call.
    Neighbouring date letters and the text between them become one ``date_format``.
    """
    headers = F.col("headers") if headers is None else headers
    resolve = statics or static_names()
    zone = tz or session_zone()
    raw_ms = clock.cast("bigint") if clock is not None else event_millis(headers)
    ms = round_down(raw_ms, round_unit, round_value, zone) if round_unit else raw_ms
    when = wall_clock(ms, zone)

    out: list[Column] = []
    run: list[tuple[str, str]] = []  # ("date", pattern) and ("text", literal) pieces

    def flush() -> None:
        while run and run[0][0] == "text":
            out.append(F.lit(run.pop(0)[1]))
        tail = []
        while run and run[-1][0] == "text":
            tail.append(F.lit(run.pop()[1]))
        if run:
            java = "".join(
                p if kind == "date" else "'" + p.replace("'", "''") + "'" for kind, p in run
            )
            out.append(F.date_format(when, java))
            run.clear()
        out.extend(reversed(tail))

    position = 0
    for tag in TAG.finditer(pattern):
        if tag.start() > position:
            run.append(("text", pattern[position : tag.start()]))
        position = tag.end()
        letter, name, static = tag.groups()
        if name is not None:
            flush()
            out.append(F.coalesce(headers[name], F.lit("")))
        elif static is not None:
            if static.lower() not in ("localhost", "ip", "fqdn"):
                raise ValueError(f"unknown static escape: {static}")
            run.append(("text", resolve(static.lower())))
        elif letter == "z" and not (is_utc(zone) and is_utc(session_zone())):
            flush()
            out.append(_offset_text(ms, zone))
        elif letter in DATE_PATTERNS:
            run.append(("date", DATE_PATTERNS[letter]))
        elif letter == "s":
            flush()
            # Truncation toward zero, as integer division gives.
            out.append((ms / F.lit(1000)).cast("bigint").cast("string"))
        elif letter == "t":
            flush()
            out.append(raw_ms.cast("string") if clock is not None else headers["timestamp"])
        else:
            # '%%' and unknown letters still need a readable timestamp.
            flush()
            shown = F.lit("%" if letter == "%" else "")
            out.append(F.when(raw_ms.isNotNull(), shown))
    if position < len(pattern):
        run.append(("text", pattern[position:]))
    flush()
    return F.concat(*out) if out else F.lit("")


def _offset_text(ms: Column, zone: str) -> Column:
    minutes = (zone_offset_ms(ms, zone) / F.lit(60_000)).cast("int")
    size = F.abs(minutes)
    return F.concat(
        F.when(minutes < 0, F.lit("-")).otherwise(F.lit("+")),
        F.lpad(F.floor(size / F.lit(60)).cast("string"), 2, "0"),
        F.lpad(F.pmod(size, F.lit(60)).cast("string"), 2, "0"),
    )


def index_name(
    prefix: str,
    headers: Column | None = None,
    *,
    mode: str = "simple",
    date_format: str = "yyyy-MM-dd",
    tz: str = "Etc/UTC",
    clock: Column | None = None,
    statics=None,
) -> Column:
    """Target index of an event: the expanded prefix, plus its date in ``time`` mode.

    The date comes from ``timestamp``, else ``@timestamp``, else the clock.
    """
    headers = F.col("headers") if headers is None else headers
    now = clock if clock is not None else F.unix_millis(F.current_timestamp())
    base = bucket_path(prefix, headers, statics=statics)
    if mode == "simple":
        return base
    if mode != "time":
        raise ValueError("mode must be 'simple' or 'time'")

    def filled(name: str) -> Column:
        return F.when(F.trim(headers[name]) != "", headers[name])

    ms = F.coalesce(filled("timestamp"), filled("@timestamp"), now.cast("string")).cast("bigint")
    return F.concat(base, F.lit("-"), F.date_format(wall_clock(ms, tz), date_format))
