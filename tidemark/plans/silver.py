"""Current state and history of every source table, from its raw events.

A table whose progress is unknown is built whole, from batch and streamed
events alike; else the events committed since are appended to the history and
merged into the current state under the sequence guard. The history is written
first and once per raw version, so a run that stops between the two can be
repeated.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.contracts import SOURCES, Contract
from tidemark.functions.columns import typed
from tidemark.operators import current
from tidemark.plans.layers import Lake, progress
from tidemark.sources.store import CHANGE, Table

DONE = "bronze_version"
GUARD = (*current.SEQUENCE, "_bronze_event_id")


@dataclass(frozen=True)
class Built:
    table: str
    mode: str
    version: int


def state(events: DataFrame, c: Contract) -> DataFrame:
    return current.normalised(current.current_state(events, [c.key], c.columns), c.trim, c.lower, c.upper, c.phones)


def log(events: DataFrame, c: Contract) -> DataFrame:
    return current.normalised(current.change_history(events, c.name, c.columns), c.trim, c.lower, c.upper, c.phones)


def changed_version(table: Table) -> int:
    """The newest version that changed rows; commits of metadata alone don't count."""
    for v in table.versions()[::-1]:
        if table.entry(v).changes:
            return v
    return 0


def everything(lake: Lake, name: str, version: int) -> DataFrame:
    """All raw events of a table, batch and streamed."""
    rows = typed(lake.bronze(name).read(version)).withColumn("_event_id", F.col("_event_id").cast("string"))
    if lake.streamed(name).exists():
        rows = rows.unionByName(typed(lake.streamed(name).read()), allowMissingColumns=True)
    return rows


def one(lake: Lake, name: str, full: bool) -> Built:
    c, raw, now, history = SOURCES[name], lake.bronze(name), lake.silver(name), lake.history(name)
    version, done = raw.entry().version, progress(now, DONE)
    if full or done is None:
        events = everything(lake, name, version)
        history.overwrite(log(events, c), metadata={DONE: version})
        now.overwrite(state(events, c), keys=(c.key,), metadata={DONE: version})
        return Built(name, "snapshot", changed_version(now))
    if done > version:
        raise ValueError(f"{name}: current state is at {done}, raw events only at {version}")
    if done == version:
        return Built(name, "no_change", changed_version(now))
    events = raw.changes(done + 1, version).where(F.col(CHANGE) == "insert").drop(CHANGE, "_commit_version")
    history.append(log(events, c), metadata={DONE: version}, writer="batch", txn=version)
    if now.merge(state(events, c), [c.key], GUARD, metadata={DONE: version}) is None:
        now.commit("progress", None, metadata={DONE: version})
    return Built(name, "incremental", changed_version(now))


def build(lake: Lake, full: bool = False) -> dict[str, Built]:
    return lake.each(lambda t: one(lake, t, full), SOURCES)


def preflight(lake: Lake, events: dict[str, DataFrame]) -> None:
    """All targets must fit before any is written. A target that is yet to be made fits."""
    for name, df in events.items():
        table, c = lake.silver(name), SOURCES[name]
        if table.exists() and (off := set(table.read().columns) ^ set(state(df, c).columns)):
            raise ValueError(f"{name}: columns differ from the current state's: {', '.join(sorted(off))}")


def merge_streamed(lake: Lake, typed_events: dict[str, DataFrame], query: str, batch: int) -> dict[str, DataFrame]:
    """A micro-batch of decoded events into history and current state; returns what it held. Late events stay in the history only, replayed batches change nothing."""
    held = {t: df for t, df in typed_events.items() if not df.isEmpty()}
    preflight(lake, held)

    def work(name: str) -> None:
        c, events = SOURCES[name], held[name]
        lake.history(name).append(log(events, c), writer=query, txn=batch)
        lake.silver(name).merge(state(events, c), [c.key], GUARD, writer=query, txn=batch)

    lake.each(work, held)
    return held


def versions(lake: Lake) -> dict[str, int]:
    """What a release is built from: the version of each current state, and of the customers' history."""
    out = lake.each(lambda t: changed_version(lake.silver(t)), SOURCES)
    return out | {"app_users_history": changed_version(lake.history("app_users"))}
