"""Events as relational tables with spill tables for long values, and back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# In-row limits before a value continues in a spill table.
PAYLOAD_LIMIT, NAME_LIMIT, VALUE_LIMIT = 16384, 251, 251


def shred_events(df: DataFrame, event_id: str = "event_id") -> dict[str, DataFrame]:
    """Tables ``event``, ``payload_spill``, ``header``, ``name_spill``, ``value_spill``.

    Header rows are numbered within their event by sorted name, so a replay produces
    the same ids. Narrow projections only: no shuffle.
    """
    body = F.col("body")
    event = df.select(event_id, F.substring(body, 1, PAYLOAD_LIMIT).alias("payload"),
                      (F.octet_length(body) > PAYLOAD_LIMIT).alias("payload_spilled"))
    payload_spill = df.filter(F.octet_length(body) > PAYLOAD_LIMIT).select(
        event_id, F.expr(f"substring(body, {PAYLOAD_LIMIT + 1})").alias("payload")
    )
    entries = df.select(
        event_id, F.posexplode(F.array_sort(F.map_entries("headers"))).alias("header_no", "e")
    ).select(event_id, "header_no", F.col("e.key").alias("k"), F.col("e.value").alias("v"))
    header = entries.select(
        event_id,
        "header_no",
        F.substring("k", 1, NAME_LIMIT).alias("name"),
        F.substring("v", 1, VALUE_LIMIT).alias("value"),
        (F.length("k") > NAME_LIMIT).alias("name_spilled"),
        F.coalesce(F.length("v") > VALUE_LIMIT, F.lit(False)).alias("value_spilled"),
    )
    name_spill = entries.filter(F.length("k") > NAME_LIMIT).select(
        event_id, "header_no", F.expr(f"substring(k, {NAME_LIMIT + 1})").alias("name")
    )
    value_spill = entries.filter(F.length("v") > VALUE_LIMIT).select(
        event_id, "header_no", F.expr(f"substring(v, {VALUE_LIMIT + 1})").alias("value")
    )
    return {
        "event": event,
        "payload_spill": payload_spill,
        "header": header,
        "name_spill": name_spill,
        "value_spill": value_spill,
    }


def assemble_events(tables: dict[str, DataFrame], event_id: str = "event_id") -> DataFrame:
    """Inverse of ``shred_events``.

    Equi-joins on the event id throughout; a group holds one event's headers, so no
    group grows with the data.
    """
    at = [event_id, "header_no"]
    names = tables["name_spill"].select(*at, F.col("name").alias("_n"))
    values = tables["value_spill"].select(*at, F.col("value").alias("_v"))
    full = (
        tables["header"]
        .join(names, at, "left")
        .join(values, at, "left")
        .select(
            event_id,
            F.struct(
                F.concat("name", F.coalesce("_n", F.lit(""))).alias("key"),
                F.concat("value", F.coalesce("_v", F.lit(""))).alias("value"),
            ).alias("e"),
        )
    )
    headers = full.groupBy(event_id).agg(
        F.map_from_entries(F.array_sort(F.collect_list("e"))).alias("headers")
    )
    spill = tables["payload_spill"].select(event_id, F.col("payload").alias("_p"))
    return (
        tables["event"]
        .join(spill, event_id, "left")
        .join(headers, event_id, "left")
        .select(
            event_id,
            F.coalesce("headers", F.create_map().cast("map<string,string>")).alias("headers"),
            F.concat("payload", F.coalesce("_p", F.lit(b""))).alias("body"),
        )
    )
