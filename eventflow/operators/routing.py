"""Content-based routing: which channels an event goes to."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventflow.operators.indexing import with_arrival_index

CHANNEL, REQUIRED = "channel", "required"


def channel_names(names: str | list[str] | None, known: list[str] | None = None) -> list[str]:
    """Channel list from a space-separated string; unknown names are an error."""
    if not names:
        return []
    parts = names.split(" ") if isinstance(names, str) else list(names)
    for name in parts:
        if known is not None and name not in known:
            raise ValueError(f"unknown channel: {name}")
    return parts


def _array(names: list[str]) -> Column:
    return F.array(*[F.lit(n) for n in names]) if names else F.array().cast("array<string>")


def explode_channels(df: DataFrame, required: Column, optional: Column) -> DataFrame:
    """One row per (event, channel) with a ``required`` flag."""

    def tagged(names: Column, flag: bool) -> Column:
        return F.transform(
            names, lambda c: F.struct(c.alias(CHANNEL), F.lit(flag).alias(REQUIRED))
        )

    routes = F.concat(tagged(required, True), tagged(optional, False))
    out = df.withColumn("_route", F.explode(routes))
    return out.select(*df.columns, F.col("_route.channel"), F.col("_route.required"))


def route(
    df: DataFrame, selector: Callable[[DataFrame], tuple[Column, Column]]
) -> DataFrame:
    """Route with a custom selector returning (required, optional) channel arrays."""
    return explode_channels(df, *selector(df))


def replicate(df: DataFrame, channels: list[str], optional: list[str] = ()) -> DataFrame:
    """Every event to every channel; those listed as optional are best effort."""
    required = [c for c in channels if c not in optional]
    best_effort = [c for c in channels if c in optional]
    return explode_channels(df, _array(required), _array(best_effort))


def _tables(mapping, default, optional, channels):
    """Checked channel lists: (default, required by value, optional by value)."""
    fallback = channel_names(default, channels)
    required = {v: channel_names(names, channels) for v, names in mapping.items()}
    for v, names in required.items():
        if not names:
            raise ValueError(f"no channel configured for header value {v!r}")
    extra = {}
    for v, names in (optional or {}).items():
        taken = required.get(v) or fallback
        extra[v] = [c for c in channel_names(names, channels) if c not in taken]
    return fallback, required, extra


def multiplex_columns(
    value: Column,
    mapping: dict[str, str | list[str]],
    default: str | list[str] | None = None,
    optional: dict[str, str | list[str]] | None = None,
    channels: list[str] | None = None,
) -> tuple[Column, Column]:
    """(required, optional) channel arrays chosen by a header value.

    Blank or unmapped values take the default list. An optional list loses the
    channels already required for the same value.
    """
    fallback, required, extra = _tables(mapping, default, optional, channels)

    def lookup(table: dict[str, list[str]], otherwise: Column) -> Column:
        if not table:
            return otherwise
        pairs = [p for v, names in table.items() for p in (F.lit(v), _array(names))]
        return F.coalesce(F.create_map(*pairs)[value], otherwise)

    mapped = {v: names for v, names in required.items() if v.strip()}
    return lookup(mapped, _array(fallback)), lookup(extra, _array([]))


def multiplex(
    df: DataFrame,
    header: str,
    mapping: dict[str, str | list[str]],
    default: str | list[str] | None = None,
    optional: dict[str, str | list[str]] | None = None,
    channels: list[str] | None = None,
) -> DataFrame:
    """Route by a header value: one row per (event, channel).

    The routes of every value are known up front, so the plan holds one constant table
    from value to routes and a single lookup per event.
    """
    fallback, required, extra = _tables(mapping, default, optional, channels)

    def routes(value: str | None) -> str:
        known = required.get(value) if value is not None and value.strip() else None
        items = [(c, "true") for c in known or fallback]
        items += [(c, "false") for c in extra.get(value, [])]
        made = [f"named_struct('channel', {_quoted(c)}, 'required', {r})" for c, r in items]
        empty = "cast(array() as array<struct<channel:string,required:boolean>>)"
        return f"array({', '.join(made)})" if made else empty

    table = ", ".join(f"{_quoted(v)}, {routes(v)}" for v in dict.fromkeys([*required, *extra]))
    chosen = F.expr(routes(None))
    if table:
        chosen = F.coalesce(F.expr(f"map({table})")[F.col("headers")[header]], chosen)
    out = df.withColumn("_route", F.explode(chosen))
    return out.select(*df.columns, F.col("_route.channel"), F.col("_route.required"))


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def round_robin(
    df: DataFrame,
    channels: list[str],
    optional: list[str] = (),
    order_by: list[str] | None = None,
) -> DataFrame:
    """Event i to channel ``i mod n``; optional channels rotate separately.

    Without ``order_by`` each task rotates on its own (no shuffle, even within one
    event per task). With it, i is the global position in that order.
    """
    required = [c for c in channels if c not in optional]
    if order_by:
        indexed = with_arrival_index(df, order_by, "_i")
    else:
        # Low bits count rows in the task; high bits are the task number.
        indexed = df.withColumn("_i", F.monotonically_increasing_id())

    def pick(names: list[str]) -> Column:
        if not names:
            return _array([])
        at = F.pmod(F.col("_i"), F.lit(len(names))).cast("int")
        return F.array(F.get(_array(names), at))

    return explode_channels(indexed, pick(required), pick(list(dict.fromkeys(optional)))).drop("_i")


def union_flows(*flows: DataFrame) -> DataFrame:
    """Fan-in: all events of all flows, duplicates kept."""
    out = flows[0]
    for flow in flows[1:]:
        out = out.unionByName(flow, allowMissingColumns=True)
    return out


def split_balance(
    df: DataFrame,
    sinks: list[str],
    mode: str = "round_robin",
    batch_size: int = 100,
    order_by: list[str] | None = None,
    seed: int = 0,
) -> DataFrame:
    """Assign whole batches to sinks, in turn or at random; adds ``batch`` and ``sink``."""
    if len(sinks) < 2:
        raise ValueError("balancing needs at least two sinks")
    if not order_by:
        raise ValueError("order_by fixes which events form a batch")
    n = F.lit(len(sinks))
    out = with_arrival_index(df, order_by, "_i").withColumn(
        "batch", F.floor(F.col("_i") / F.lit(batch_size))
    )
    if mode == "round_robin":
        at = F.pmod(F.col("batch"), n)
    elif mode == "random":
        at = F.pmod(F.xxhash64(F.col("batch"), F.lit(seed)), n)
    else:
        raise ValueError("mode must be 'round_robin' or 'random'")
    return out.withColumn("sink", F.get(_array(sinks), at.cast("int"))).drop("_i")


def to_partition(
    df: DataFrame, header: str, static: int | None = None, name: str = "partition"
) -> DataFrame:
    """Target partition: the header when present, else the static one (else null)."""
    value = F.col("headers")[header]
    number = F.when(value.isNotNull(), value.cast("int"))
    return df.withColumn(name, F.coalesce(number, F.lit(static).cast("int")))
