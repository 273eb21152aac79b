"""Structured Streaming: sources, the raw sink, and micro-batches into versioned tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tidemark.operators import current
from tidemark.sources.store import CHANGE, Files, Table
from tidemark.streaming import cdc


def kafka(spark: SparkSession, servers: str, *, topics: str | None = None, pattern: str | None = None, starting: str = "earliest", fail_on_loss: bool = True, most: int | None = None, **options: str) -> DataFrame:
    """A Kafka stream of exactly one of topics or pattern (needs Spark's Kafka package)."""
    if (topics is None) == (pattern is None):
        raise ValueError("give topics or pattern")
    reader = spark.readStream.format("kafka").options(**options).option("kafka.bootstrap.servers", servers).option("startingOffsets", starting)
    reader = reader.option("failOnDataLoss", str(fail_on_loss).lower()).option("includeHeaders", "true")
    reader = reader.option("subscribe", topics) if topics else reader.option("subscribePattern", pattern)
    return (reader.option("maxOffsetsPerTrigger", most) if most else reader).load()


def files(spark: SparkSession, path: str, schema: StructType, most: int | None = 8, most_bytes: int | None = None) -> DataFrame:
    """A stream of Parquet files as they arrive, so many a micro-batch at most, or, where `most_bytes` is given, so many bytes (Spark takes one of the two). The folder is made if there is none, so readers may start before writers."""
    folder = Files(spark, path)
    folder.fs.mkdirs(folder.root)
    reader = spark.readStream.schema(schema)
    if most_bytes:
        return reader.option("maxBytesPerTrigger", most_bytes).parquet(path)
    return (reader.option("maxFilesPerTrigger", most) if most else reader).parquet(path)


def guard_checkpoint(spark: SparkSession, checkpoint: str, target_exists: bool) -> None:
    """A checkpoint, on any file system, whose target is gone would skip what the target lost."""
    if not target_exists and Files(spark, checkpoint).names("."):
        raise RuntimeError(f"{checkpoint} exists but its target doesn't; remove both or restore the target")


def _started(writer: Any, checkpoint: str, every: str | None) -> StreamingQuery:
    writer = writer.option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def append(stream: DataFrame, path: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    return _started(stream.writeStream.format("parquet").outputMode("append").option("path", path), checkpoint, every)


def to_current(stream: DataFrame, table: Table, checkpoint: str, writer: str, keys: Sequence[str], columns: Sequence[str], every: str | None = None) -> StreamingQuery:
    """Events merged into a current-state table. State is the table itself: late events lose against its sequence, replayed batches against its transactions."""

    def batch(df: DataFrame, n: int) -> None:
        newest = current.current_state(df, keys, columns).persist()  # the merge reads it more than once
        try:
            if not newest.isEmpty():
                table.merge(newest, keys, [*current.SEQUENCE, "_bronze_event_id"], writer=writer, txn=n)
        finally:
            newest.unpersist()

    return _started(stream.writeStream.foreachBatch(batch), checkpoint, every)


def split(stream: DataFrame, tables: Mapping[str, Table], quarantine: Table, schemas: Mapping[str, Mapping[str, str]], keys: Mapping[str, Sequence[str]], checkpoint: str, query: str, every: str | None = None, then: Callable[[dict[str, DataFrame], int], None] | None = None) -> StreamingQuery:
    """Raw envelopes into typed tables and quarantine, each written once a batch; `then` gets what was committed.

    A batch is decoded once and kept; one count over what is kept says which tables have rows, and only those are written.
    """

    def batch(df: DataFrame, n: int) -> None:
        kept = cdc.decoded(df, schemas, keys).persist()
        try:
            name = f"{query}:{n}"
            bad = F.col("_quarantine_reason").isNotNull()
            found = {(r.bad, r.source_table) for r in kept.groupBy(bad.alias("bad"), F.when(~bad, F.col("source_table")).alias("source_table")).count().collect()}
            written = {t: tables[t].append(cdc.of_table(kept, t, schemas[t], name), writer=query, txn=n) for t in schemas if (False, t) in found}
            if (True, None) in found:
                quarantine.append(cdc.quarantined(kept, name), writer=query, txn=n)
            if then:
                # a replayed batch has no new version; its rows are found by its name
                committed = lambda t, v: tables[t].read().where(f"_batch_id = '{name}'") if v is None else tables[t].changes(v, v).drop(CHANGE, "_commit_version")
                then({t: committed(t, v) for t, v in written.items()}, n)
        finally:
            kept.unpersist()

    return _started(stream.writeStream.foreachBatch(batch), checkpoint, every)


class Pending:
    """Orders whose facts wait for complete sources. Past `most`, all orders are looked at instead."""

    def __init__(self, most: int = 5000):
        self.most, self.ids, self.all = most, set(), False

    def add(self, ids: DataFrame) -> None:
        if not self.all:
            self.ids |= {r[0] for r in ids.distinct().limit(self.most + 1).collect()}
            if len(self.ids) > self.most:
                self.ids, self.all = set(), True

    def clear(self) -> None:
        self.ids, self.all = set(), False
