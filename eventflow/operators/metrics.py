"""Flow accounting: source, channel, sink, error and byte counters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

SLOT_BYTES = 100  # fixed value: accounting unit of body bytes


def slots(body: str = "body") -> Column:
    return F.ceil(F.octet_length(body) / F.lit(SLOT_BYTES)).cast("bigint")


def observed(
    df: DataFrame, observation: Observation | str, accepted: Column | None = None
) -> DataFrame:
    """Count received/accepted events and bytes as the data flows by (no extra pass).

    Give a name instead of an Observation on a stream; progress reports carry it.
    """
    ok = F.lit(True) if accepted is None else F.coalesce(accepted, F.lit(False))
    return df.observe(
        observation,
        F.count(F.lit(1)).alias("received"),
        F.count_if(ok).alias("accepted"),
        F.coalesce(F.sum(F.octet_length("body")), F.lit(0)).alias("bytes"),
    )


def source_counters(df: DataFrame, accepted: Column, by: list[str] = (), batch_size: int = 100):
    """Received and accepted events, and the number of append batches they make."""
    received = F.count(F.lit(1))
    return df.groupBy(*by).agg(
        received.alias("received"),
        F.count_if(accepted).alias("accepted"),
        F.ceil(received / F.lit(batch_size)).cast("bigint").alias("append_batches"),
    )


def channel_counters(routed: DataFrame, capacity_slots: int | None = None) -> DataFrame:
    """Per channel: events, bytes, slots, and fill level when a capacity is given."""
    out = routed.groupBy("channel").agg(
        F.count(F.lit(1)).alias("events"),
        F.sum(F.octet_length("body")).cast("bigint").alias("bytes"),
        F.sum(slots()).alias("slots"),
    )
    if capacity_slots:
        out = out.withColumn("fill_percent", F.col("slots") * 100 / F.lit(capacity_slots))
    return out


def put_take_counters(put: DataFrame, taken: DataFrame, by: list[str]) -> DataFrame:
    """Per channel: put and take counts and what is still inside."""
    p = put.groupBy(*by).agg(F.count(F.lit(1)).alias("put"))
    t = taken.groupBy(*by).agg(F.count(F.lit(1)).alias("taken"))
    joined = p.join(t, by, "full_outer")
    return joined.select(
        *by,
        F.coalesce("put", F.lit(0)).alias("put"),
        F.coalesce("taken", F.lit(0)).alias("taken"),
        (F.coalesce("put", F.lit(0)) - F.coalesce("taken", F.lit(0))).alias("size"),
    )


def batch_classes(df: DataFrame, batch: str, batch_size: int, all_batches: DataFrame | None = None):
    """Batches by fill: ``empty``, ``underflow`` (short) or ``complete``.

    ``all_batches`` lists batch ids that may have no event at all.
    """
    sizes = df.groupBy(batch).agg(F.count(F.lit(1)).alias("n"))
    if all_batches is not None:
        sizes = all_batches.select(batch).distinct().join(sizes, batch, "left")
    n = F.coalesce("n", F.lit(0))
    kind = (
        F.when(n == 0, F.lit("empty"))
        .when(n < batch_size, F.lit("underflow"))
        .otherwise(F.lit("complete"))
    )
    return sizes.groupBy(kind.alias("batch_class")).agg(
        F.count(F.lit(1)).alias("batches"), F.sum(n).cast("bigint").alias("events")
    )


def error_counters(triaged: DataFrame, by: list[str] = ()) -> DataFrame:
    """Deserialization and processing errors, rollbacks (groups with a poisoned event)."""
    return triaged.groupBy(*by).agg(
        F.count(F.lit(1)).alias("attempted"),
        F.count_if(F.col("status") == "dropped").alias("deserialization_errors"),
        F.count_if(F.col("status") == "poison").alias("processing_errors"),
        F.max((F.col("status") == "poison").cast("int")).alias("rolled_back"),
    )


def failure_counts(failed: DataFrame, by: str = "topic") -> DataFrame:
    return failed.groupBy(by).agg(F.count(F.lit(1)).alias("failures"))


def named_counters(df: DataFrame, group: str, counters: dict[str, Column], time: str) -> DataFrame:
    """Long table of named counters with first and last time seen."""
    wide = df.groupBy(F.col(group).alias("counter_group")).agg(
        F.min(time).alias("start_time"),
        F.max(time).alias("stop_time"),
        *[F.count_if(c).alias(name) for name, c in counters.items()],
    )
    return wide.unpivot(
        ["counter_group", "start_time", "stop_time"], list(counters), "counter", "value"
    )


def ingest_stats(df: DataFrame, text: str, seconds: Column, skipped: Column) -> DataFrame:
    """Documents, documents per second, megabytes of text, skipped documents."""
    docs = F.count_if(~skipped)
    return df.agg(
        docs.alias("docs"),
        (docs / F.max(seconds)).alias("docs_per_second"),
        (F.sum(F.when(~skipped, F.octet_length(text))) / F.lit(1024 * 1024)).alias("text_mb"),
        F.count_if(skipped).alias("skipped"),
    )


class FlowProgress(StreamingQueryListener):
    """Keeps put/take counters of running queries, by query name."""

    def __init__(self) -> None:
        self.counters: dict[str, dict[str, int]] = {}

    def onQueryStarted(self, event) -> None:
        self.counters.setdefault(event.name or str(event.id), {"batches": 0, "events": 0})

    def onQueryProgress(self, event) -> None:
        p = event.progress
        entry = self.counters.setdefault(p.name or str(p.id), {"batches": 0, "events": 0})
        entry["batches"] += 1
        entry["events"] += p.numInputRows

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass
