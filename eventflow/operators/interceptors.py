"""Per-event transforms and filters. Each factory returns ``DataFrame -> DataFrame``."""

from __future__ import annotations

import re
import socket
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventflow.functions import headers as hdr
from eventflow.schema import body_bytes, body_text, empty_body

Step = Callable[[DataFrame], DataFrame]
H = "headers"


def _set(headers: Callable[[], Column]) -> Step:
    return lambda df: df.withColumn(H, headers())


def put_header(name: str, value: Column, preserve: bool = False) -> Step:
    return _set(lambda: hdr.put(F.col(H), {name: value}, preserve))


def add_timestamp(
    header: str = "timestamp", preserve: bool = False, clock: Column | None = None
) -> Step:
    """Stamp epoch millis; ``clock`` replaces the processing time (replay, tests)."""

    def step(df: DataFrame) -> DataFrame:
        now = F.unix_millis(F.current_timestamp()) if clock is None else clock
        return put_header(header, now.cast("bigint"), preserve)(df)

    return step


def add_host(
    header: str = "host", use_ip: bool = True, preserve: bool = False, host: str | None = None
) -> Step:
    """Stamp the host that builds the flow; an unresolvable host leaves events alone."""
    if host is None:
        try:
            name = socket.gethostname()
            host = socket.gethostbyname(name) if use_ip else socket.getfqdn(name)
        except OSError:
            return lambda df: df
    return lambda df: put_header(header, F.lit(host), preserve)(df)


def add_static(key: str = "key", value: str = "value", preserve: bool = True) -> Step:
    return lambda df: put_header(key, F.lit(value), preserve)(df)


def add_uuid(
    header: str = "id",
    preserve: bool = True,
    prefix: str = "",
    content: Iterable[str] | None = None,
) -> Step:
    """Unique id per event. ``content`` names columns or headers to hash instead, so a
    replayed event gets the same id."""

    def step(df: DataFrame) -> DataFrame:
        if content is None:
            value = F.uuid()
        else:
            cells = [F.col(c) if c in df.columns else F.col(H)[c] for c in content]
            value = F.sha2(F.concat_ws("|", *[c.cast("string") for c in cells]), 256)
        return put_header(header, F.concat(F.lit(prefix), value), preserve)(df)

    return step


def remove_headers(
    with_name: str | None = None,
    from_list: str | None = None,
    separator: str = r"\s*,\s*",
    matching: str | None = None,
) -> Step:
    """Drop headers by exact name, by a separated list, or by a full-match pattern."""
    names = set()
    if with_name is not None:
        names.add(with_name)
    if from_list is not None:
        names.update(re.split(separator, from_list))

    def hit(key: Column) -> Column:
        found = key.isin(sorted(names)) if names else F.lit(False)
        return found | key.rlike(rf"\A(?:{matching})\z") if matching is not None else found

    if not names and matching is None:
        return lambda df: df
    return lambda df: df.withColumn(H, hdr.remove(F.col(H), hit))


def search_replace(pattern: str, replacement: str | None = "", charset: str = "UTF-8") -> Step:
    """Replace every match in the body; ``$n`` refers to groups."""
    if not pattern:
        raise ValueError("search pattern is required")

    def step(df: DataFrame) -> DataFrame:
        text = F.regexp_replace(body_text(charset), pattern, replacement or "")
        return df.withColumn("body", body_bytes(text, charset))

    return step


def regex_filter(pattern: str = ".*", exclude: bool = False) -> Step:
    """Keep (or drop) the events whose body contains a match."""

    def step(df: DataFrame) -> DataFrame:
        found = body_text().rlike(pattern)
        return df.filter(~found if exclude else found)

    return step


def as_is(value: Column) -> Column:
    return value


def as_millis(pattern: str) -> Callable[[Column], Column]:
    """Group serializer: a date in ``pattern`` becomes epoch millis; bad dates raise."""
    return lambda value: F.unix_millis(F.to_timestamp(value, pattern)).cast("string")


def regex_extract(
    pattern: str,
    serializers: list[str | tuple[str, Callable[[Column], Column]]],
    optional_groups: Iterable[int] = (),
) -> Step:
    """Put the groups of the first match into headers, group i to the i-th name.

    A group that took no part in the match gives a null header, one that matched the empty
    text an empty one; listed in ``optional_groups`` it gives null for both. Extra groups or
    names are ignored; events without a match pass unchanged.
    """
    if not pattern:
        raise ValueError("a pattern is required")
    try:
        n_groups = re.compile(pattern).groups
    except re.error:
        n_groups = len(re.findall(r"(?<!\\)\((?!\?[^<P]|\?<[=!])", pattern))
    if not serializers:
        raise ValueError("at least one serializer is required")
    pairs = [(s, as_is) if isinstance(s, str) else s for s in serializers]
    if any(not name or not name.strip() for name, _ in pairs):
        raise ValueError("a serializer name must not be blank")
    pairs = pairs[:n_groups]
    optional = set(optional_groups)
    may_be_idle = re.search(r"[?*|{]", pattern) is not None

    def took_part(text: Column, i: int) -> Column:
        # The first match again, kept by the atomic group; a reference to an idle group fails.
        return text.rlike(rf"\A(?>(?s:.*?)(?:{pattern}))\{i}")

    def step(df: DataFrame) -> DataFrame:
        text = body_text()
        entries = {}
        for i, (name, serialize) in enumerate(pairs, 1):
            group = F.regexp_extract(text, pattern, i)
            if i in optional:
                group = F.when(group != "", group)
            elif may_be_idle:  # looked at only where the group is empty
                group = F.when((group != "") | took_part(text, i), group)
            entries[name] = serialize(group)
        if not entries:
            return df
        changed = hdr.put(F.col(H), entries)
        return df.withColumn(H, F.when(text.rlike(pattern), changed).otherwise(F.col(H)))

    return step


def chain(steps: Iterable[Step]) -> Step:
    """Apply steps in order."""
    steps = list(steps)

    def run(df: DataFrame) -> DataFrame:
        for step in steps:
            df = df.transform(step)
        return df

    return run


def limit_size(max_bytes: int, flag_header: str = "syslog.status", flag: str = "Incomplete") -> Step:
    """Cut bodies over the limit and flag the events."""

    def step(df: DataFrame) -> DataFrame:
        over = F.octet_length("body") > max_bytes
        return df.select(
            *[c for c in df.columns if c not in (H, "body")],
            F.when(over, hdr.put(F.col(H), {flag_header: F.lit(flag)}))
            .otherwise(F.col(H))
            .alias(H),
            F.when(over, F.substring("body", 1, max_bytes)).otherwise(F.col("body")).alias("body"),
        )

    return step


def non_null_body(df: DataFrame) -> DataFrame:
    return df.withColumn("body", F.coalesce("body", empty_body()))


def event_status(valid: Column, corrupt: Column | None = None) -> Column:
    """``valid`` / ``invalid`` / ``corrupt`` per event; a null verdict is corrupt."""
    bad = F.lit(False) if corrupt is None else F.coalesce(corrupt, F.lit(True))
    return (
        F.when(bad | valid.isNull(), F.lit("corrupt"))
        .when(valid, F.lit("valid"))
        .otherwise(F.lit("invalid"))
    )


def validate_events(
    df: DataFrame, valid: Column, corrupt: Column | None = None
) -> DataFrame:
    """Counts per status."""
    return df.groupBy(event_status(valid, corrupt).alias("status")).agg(
        F.count(F.lit(1)).alias("events")
    )


def split_valid(
    df: DataFrame, valid: Column, corrupt: Column | None = None
) -> tuple[DataFrame, DataFrame]:
    """(events that pass, events that do not)."""
    ok = event_status(valid, corrupt) == "valid"
    return df.filter(ok), df.filter(~ok)


def dedupe_events(
    df: DataFrame, id_header: str = "id", event_time: str | None = None, delay: str | None = None
) -> DataFrame:
    """One event per id header; events without an id are all kept.

    Streams need ``event_time`` and ``delay``: they bound the state.
    """
    if df.isStreaming and not (event_time and delay):
        raise ValueError("a stream needs event_time and delay, or its state grows without bound")
    keyed = df.withColumn("_id", F.col(H)[id_header])
    bounded = df.isStreaming and event_time and delay
    if bounded:
        keyed = keyed.withWatermark(event_time, delay)
    known = keyed.filter(F.col("_id").isNotNull())
    if bounded:
        known = known.dropDuplicatesWithinWatermark(["_id"])
    else:
        known = known.dropDuplicates(["_id"])
    return known.unionByName(keyed.filter(F.col("_id").isNull())).drop("_id")
