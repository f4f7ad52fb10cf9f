"""A flow: source -> steps -> selector -> channel sinks, for batch and streams."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventflow.operators.interceptors import Step, chain
from eventflow.operators.routing import explode_channels
from eventflow.session import run_series
from eventflow.streaming.delivery import Writer, batch_key, deliver


@dataclass(frozen=True)
class Flow:
    """An immutable description; each method returns an extended copy."""

    source: DataFrame
    steps: tuple[Step, ...] = ()
    selector: Callable[[DataFrame], tuple[Column, Column]] | None = None
    required: dict[str, Writer] = field(default_factory=dict)
    optional: dict[str, Writer] = field(default_factory=dict)

    def through(self, *steps: Step) -> "Flow":
        return replace(self, steps=self.steps + steps)

    def select_by(self, selector: Callable[[DataFrame], tuple[Column, Column]]) -> "Flow":
        return replace(self, selector=selector)

    def to(self, channel: str, write: Writer, optional: bool = False) -> "Flow":
        if optional:
            return replace(self, optional={**self.optional, channel: write})
        return replace(self, required={**self.required, channel: write})

    def events(self) -> DataFrame:
        """Events after all steps."""
        return chain(self.steps)(self.source)

    def routed(self) -> DataFrame:
        """One row per event and channel. Without a selector events go everywhere."""
        events = self.events()
        if self.selector is not None:
            return explode_channels(events, *self.selector(events))
        every = F.array(*[F.lit(c) for c in self.required]) if self.required else F.array().cast(
            "array<string>"
        )
        extra = F.array(*[F.lit(c) for c in self.optional]) if self.optional else F.array().cast(
            "array<string>"
        )
        return explode_channels(events, every, extra)

    def run(self, batch_id: int | None = None) -> dict[str, str]:
        """Run a batch flow once.

        Each run adds its output; to repeat a failed run in place pass the same id again.
        """
        key = time.time_ns() if batch_id is None else batch_id
        return deliver(self.routed(), key, self.required, self.optional)

    def start(
        self,
        checkpoint: str,
        *,
        interval: str | None = None,
        once: bool = False,
        name: str | None = None,
    ):
        """Start a streaming flow; the checkpoint moves only after required channels did.

        Writers get a batch key made of the checkpoint's own series and the batch number, so
        a repeated batch replaces its output and another checkpoint adds to the folder.
        """
        series = run_series(self.source.sparkSession, checkpoint)

        def batch(df: DataFrame, batch_id: int) -> None:
            deliver(df, batch_key(series, batch_id), self.required, self.optional)

        writer = (
            self.routed().writeStream.option("checkpointLocation", checkpoint).foreachBatch(batch)
        )
        if name:
            writer = writer.queryName(name)
        if once:
            writer = writer.trigger(availableNow=True)
        elif interval:
            writer = writer.trigger(processingTime=interval)
        return writer.start()
