"""Header map edits. Each call is one pass over the map, however many keys it sets."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def put(headers: Column, entries: dict[str, Column], preserve: bool = False) -> Column:
    """Set headers; ``preserve`` leaves keys that are already present (even if null)."""
    if not entries:
        return headers
    names = list(entries)
    added = F.create_map(
        *[part for k, v in entries.items() for part in (F.lit(k), v.cast("string"))]
    )
    if preserve:
        if len(names) == 1:
            return F.when(F.map_contains_key(headers, names[0]), headers).otherwise(
                F.map_concat(headers, added)
            )
    # Lambdas are interpreted: filter only where a map does hold one of the keys.
    taken = F.arrays_overlap(F.map_keys(headers), F.array(*[F.lit(n) for n in names]))
    if preserve:
        missing = F.map_filter(added, lambda k, _: ~F.map_contains_key(headers, k))
        return F.map_concat(headers, F.when(taken, missing).otherwise(added))
    kept = F.when(taken, F.map_filter(headers, lambda k, _: ~k.isin(names))).otherwise(headers)
    return F.map_concat(kept, added)


def put_present(headers: Column, entries: dict[str, Column]) -> Column:
    """Set the headers whose new value is non-null; leave the others as they are."""
    added = F.map_filter(
        F.create_map(
            *[part for k, v in entries.items() for part in (F.lit(k), v.cast("string"))]
        ),
        lambda _, v: v.isNotNull(),
    )
    return overlay(headers, added)


def overlay(base: Column, top: Column) -> Column:
    """Map union where ``top`` wins on equal keys."""
    shared = F.arrays_overlap(F.map_keys(base), F.map_keys(top))
    kept = F.map_filter(base, lambda k, _: ~F.map_contains_key(top, k))
    return F.map_concat(F.when(shared, kept).otherwise(base), top)


def remove(headers: Column, hit: Callable[[Column], Column]) -> Column:
    """Drop the headers whose name satisfies ``hit``."""
    return F.map_filter(headers, lambda k, _: ~hit(k))


def render(headers: Column) -> Column:
    """``{k=v, k2=v2}`` with keys sorted, null values shown as ``null``."""
    entries = F.array_sort(F.map_entries(headers))
    shown = F.transform(
        entries, lambda e: F.concat(e["key"], F.lit("="), F.coalesce(e["value"], F.lit("null")))
    )
    return F.concat(F.lit("{"), F.array_join(shown, ", "), F.lit("}"))
