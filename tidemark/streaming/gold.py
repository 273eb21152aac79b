"""Streams that keep current states and the star schema up to date.

One query stores raw envelopes; a second decodes them micro-batch by
micro-batch, merges current states and, where streaming owns it, rebuilds the
star schema once the orders that were touched are complete. Orders that are
not wait and are looked at again with the next batch, on idle ticks and until
a deadline.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.contracts import SOURCES
from tidemark.functions.columns import type_of
from tidemark.operators import affected, quality
from tidemark.plans import gold, silver
from tidemark.plans.layers import Lake
from tidemark.sources.control import table_lock
from tidemark.sources.store import Table
from tidemark.streaming import stream

OUTCOMES = ("skipped", "deferred", "published", "no_change")


def schemas() -> dict[str, dict[str, str]]:
    """The decoded columns of every table and their types. Excluded columns are not among them: an event that bears one is quarantined."""
    return {t: {x: type_of(x) or "string" for x in (*c.columns, *c.log_only)} for t, c in SOURCES.items()}


@dataclass
class Reconciler:
    """Publishes the star schema when its sources are complete."""

    lake: Lake
    pending: stream.Pending = field(default_factory=stream.Pending)
    clock: Callable[[], float] = time.monotonic
    sleep: Callable[[float], None] = time.sleep
    last: dict[str, Any] = field(default_factory=dict)

    def incomplete(self) -> int:
        """Orders that wait: of those touched, or of all where too many were."""
        orders, items = self.lake.silver("orders"), self.lake.silver("order_items")
        if not orders.exists() or not items.exists():
            return 0
        lines = items.read().where(~F.coalesce("_is_deleted", F.lit(False)))
        ids = None if self.pending.all else self.lake.spark.createDataFrame([(i,) for i in sorted(self.pending.ids)], "order_id int")
        return quality.incomplete_orders(orders.read(), lines if ids is None else affected.within(lines, ids, "order_id"), ids).count()

    def reconcile(self, final: bool = False) -> str:
        """skipped: batch owns the star schema, tables are missing, or a rule is broken; deferred: orders wait. `final` falls back to a whole rebuild where a rule is broken, and raises if that breaks one too."""
        if self.lake.settings.gold_owner != "streaming" or not all(self.lake.silver(t).exists() for t in SOURCES):
            return "skipped"
        if n := self.incomplete():
            self.last = {"incomplete": n}
            return "deferred"
        name = uuid.uuid4().hex
        try:
            self.last = gold.build(self.lake, name)
        except gold.QualityError as e:
            self.last = {"error": str(e)}
            if not final:
                return "skipped"
            self.last = gold.build(self.lake, name, full=True)
        self.pending.clear()
        return "no_change" if self.last["mode"] == "no_change" else "published"

    def retried(self) -> str:
        """Reconcile again until it isn't deferred or the time is up."""
        s = self.lake.settings.streaming
        until = self.clock() + s.retry_seconds
        while (out := self.reconcile()) == "deferred" and self.clock() < until:
            self.sleep(s.retry_interval_seconds)
        return out


def touched_orders(typed: dict[str, DataFrame]) -> DataFrame | None:
    """Ids of the orders that a micro-batch speaks of."""
    frames = [df for t, df in typed.items() if t in affected.ORDER_TABLES]
    return affected.ids(frames, "order_id") if frames else None


def raw_to_gold(lake: Lake, raw: DataFrame, checkpoint: str, query: str = "cdc", reconciler: Reconciler | None = None, every: str | None = None) -> StreamingQuery:
    """Raw envelopes into typed events, histories, current states and, if its sources are complete, the star schema. Each step of a replayed micro-batch is a no-op."""
    kinds = schemas()
    tables = {t: lake.streamed(t) for t in SOURCES}
    quarantine = Table(lake.spark, f"{lake.root}/bronze_cdc/_quarantine")

    def then(typed: dict[str, DataFrame], n: int) -> None:
        owner = f"{query}:{n}"
        with table_lock(lake.lock(), owner, lake.settings.lock_ttl_seconds, lake.settings.lock_wait_seconds):
            held = silver.merge_streamed(lake, typed, query, n)
            if reconciler is not None and held:
                if (ids := touched_orders(held)) is not None:
                    reconciler.pending.add(ids)
                reconciler.retried()

    return stream.split(raw, tables, quarantine, kinds, {t: (c.key,) for t, c in SOURCES.items()}, checkpoint, query, every, then)
