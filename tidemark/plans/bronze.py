"""Bounded extraction of change events into append-only tables.

One query finds how far each table may be read; each table then reads its
events in (cursor, upper], checks them in one pass and commits them with the
new cursor. Row images are kept as text: typing is the next layer's work.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from tidemark.contracts import SOURCES
from tidemark.plans.layers import Lake, progress
from tidemark.settings import Source
from tidemark.sources import outbox

CURSOR = "last_event_id"


def image_schema(table: str) -> StructType:
    """The columns of a table's row image, excluded ones left out, all text."""
    s = StructType()
    for c in (*SOURCES[table].columns, *SOURCES[table].log_only):
        s = s.add(c, StringType())
    return s


class Log(Protocol):
    """A change-event log: event_id, source_table, operation, row_data (JSON), occurred_at."""

    def bounds(self, cursors: Mapping[str, int], most: int) -> dict[str, tuple[int | None, int | None]]: ...

    def events(self, table: str, cursor: int, upper: int) -> DataFrame: ...


@dataclass
class FrameLog:
    """A log that is a DataFrame."""

    log: DataFrame

    def bounds(self, cursors: Mapping[str, int], most: int) -> dict[str, tuple[int | None, int | None]]:
        return {r.source_table: (r.upper, r.newest) for r in outbox.bounds(self.log.where(F.col("source_table").isin(*cursors)), cursors, most).collect()}  # a row a table

    def events(self, table: str, cursor: int, upper: int) -> DataFrame:
        return outbox.events(self.log, table, image_schema(table), cursor, upper)


@dataclass
class JdbcLog:
    """A log in a PostgreSQL table, read in partitions of its event ids."""

    spark: SparkSession
    source: Source
    table: str = "change_events"

    def _options(self) -> dict[str, str]:
        s = self.source
        return outbox.jdbc_options(s.url, s.user, s.password, s.driver, s.fetch_size, s.query_timeout_seconds)

    def bounds_sql(self, cursors: Mapping[str, int], most: int) -> str:
        log = f"{self.source.schema}.{self.table}"
        values = ", ".join(f"('{t}', {int(c)})" for t, c in sorted(cursors.items()))
        window = f"SELECT e.event_id FROM {log} e WHERE e.source_table = c.source_table AND e.event_id > c.cursor ORDER BY e.event_id LIMIT {int(most)}"
        newest = f"SELECT max(e.event_id) FROM {log} e WHERE e.source_table = c.source_table"
        return f"SELECT c.source_table, (SELECT max(w.event_id) FROM ({window}) w) AS upper, ({newest}) AS newest FROM (VALUES {values}) AS c(source_table, cursor)"

    def bounds(self, cursors: Mapping[str, int], most: int) -> dict[str, tuple[int | None, int | None]]:
        rows = outbox.retried(lambda: outbox.read_query(self.spark, self.bounds_sql(cursors, most), self._options()).collect(), self.source.attempts, self.source.delay_seconds)
        return {r["source_table"]: (r["upper"], r["newest"]) for r in rows}

    def events_sql(self, table: str, cursor: int, upper: int) -> str:
        return f"SELECT event_id, source_table, operation, CAST(row_data AS text) AS row_data, occurred_at FROM {self.source.schema}.{self.table} WHERE source_table = '{table}' AND event_id > {cursor} AND event_id <= {upper}"

    def events(self, table: str, cursor: int, upper: int) -> DataFrame:
        n = outbox.partitions_for(cursor, upper, self.source.events_per_partition, self.source.most_partitions)
        log = outbox.read_partitioned(self.spark, self.events_sql(table, cursor, upper), "event_id", cursor + 1, upper + 1, n, self._options(), self.source.most_partitions)
        return outbox.events(log, table, image_schema(table), cursor, upper)


@dataclass(frozen=True)
class Extracted:
    table: str
    mode: str
    rows: int
    cursor: int
    version: int | None


def cursor_of(lake: Lake, name: str) -> int | None:
    """The last event id that a table holds: from its commits, or, where none says so, from its rows once (and then marked)."""
    table = lake.bronze(name)
    found = progress(table, CURSOR)
    if found is None and table.exists():
        found = table.read().agg(F.max("_event_id")).first()[0] or 0
        table.commit("recover", None, metadata={CURSOR: found})
    return found


def extract(lake: Lake, log: Log, batch_id: str) -> dict[str, Extracted]:
    """Every source table's new events, up to the bound. A table without new events gets no commit."""
    known = lake.each(lambda t: cursor_of(lake, t), SOURCES)
    bounds = log.bounds({t: c or 0 for t, c in known.items()}, lake.settings.source.most_events)

    def one(name: str) -> Extracted:
        cursor = known[name]
        upper, newest = bounds.get(name, (None, None))
        outbox.guard(cursor, newest)
        table, first = lake.bronze(name), cursor is None
        if upper is None and not first:
            return Extracted(name, "no_change", 0, cursor or 0, table.entry().version)
        upper = upper or 0
        rows = outbox.with_metadata(log.events(name, cursor or 0, upper), batch_id, lake.settings.system, lake.settings.source.schema, name)

        def write() -> int:
            version = table.append(rows, metadata={CURSOR: upper, "batch_id": batch_id}, check=lambda written: checked(name, written, upper))
            assert version is not None
            return version

        version = outbox.retried(write, lake.settings.source.attempts, lake.settings.source.delay_seconds)
        entry = table.entry(version)
        return Extracted(name, "snapshot" if first else "incremental", int(entry.metadata["rows"]), upper, version)

    return lake.each(one, SOURCES)


def checked(name: str, rows: DataFrame, upper: int) -> dict[str, int]:
    """Counts of a batch for its commit; invalid events are an error."""
    s = outbox.statistics(rows, (SOURCES[name].key,)).first()
    if s.n_invalid or (s.n_rows and s.last_id != upper):
        raise ValueError(f"{name}: {s.n_invalid} invalid events, last {s.last_id} of {upper}")
    return {"rows": s.n_rows, "inserts": s.n_insert, "updates": s.n_update, "deletes": s.n_delete}
