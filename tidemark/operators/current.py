"""Current state from change events, and the guard that keeps late events out."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import event_hash, optional, phone, require, trimmed, typed

#: The total order of events of a key, newest first by these columns in turn.
SEQUENCE = ("_event_occurred_at", "_ingestion_priority", "_source_event_sequence", "_source_event_subsequence")


def latest(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in the order given."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def sequenced(events: DataFrame) -> DataFrame:
    """Events with the columns of their total order: a change stream outranks a batch at the same time."""
    stream = optional(events, "_ingestion_type", "string") == "streaming_cdc"
    stream = F.coalesce(stream, F.lit(False))
    lsn, offset = optional(events, "_source_lsn", "bigint"), optional(events, "_kafka_offset", "bigint")
    return events.withColumns(
        {
            "_ingestion_priority": F.when(stream, 2).otherwise(1),
            "_ingestion_mode": F.when(stream, "streaming").otherwise("batch"),
            "_source_event_sequence": F.when(stream, F.coalesce(lsn, offset)).otherwise(F.col("_event_id").try_cast("bigint")),
            "_source_event_subsequence": F.when(stream, F.coalesce(offset, F.lit(-1))).otherwise(F.lit(0)).cast("bigint"),
            "_source_lsn": lsn,
            "_kafka_offset": offset,
            "_kafka_partition": optional(events, "_kafka_partition", "int"),
        }
    )


def current_state(events: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """One row a key, its newest event's; a deleted key stays as a tombstone."""
    ready = sequenced(typed(require(events, [*keys, "_event_id", "_operation", "_event_occurred_at"])))
    order = [F.col(c).desc_nulls_last() for c in SEQUENCE] + [F.col("_event_id").cast("string").desc_nulls_last()]
    found = latest(ready, keys, order)
    kept = [c for c in columns if c not in keys]
    return found.select(*keys, *kept, "_operation", (F.col("_operation") == "DELETE").alias("_is_deleted"), *SEQUENCE, "_ingestion_mode", F.col("_event_id").cast("string").alias("_bronze_event_id"))


def change_history(events: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    """Every event, normalised, with an id that repeats when the event does."""
    ready = sequenced(typed(events))
    name = event_hash(
        F.lit(table), F.col("_event_id"), optional(ready, "_batch_id", "string"), F.col("_source_lsn"), F.col("_kafka_partition"), F.col("_kafka_offset"), F.col("_operation")
    )
    return ready.select(*columns, "_operation", *SEQUENCE, "_source_lsn", "_kafka_partition", "_kafka_offset", name.alias("_history_event_id"))


def alive(df: DataFrame) -> DataFrame:
    return df.where(~F.coalesce(F.col("_is_deleted"), F.lit(False)))


def newer(source: str, target: str, sequence: Sequence[str]) -> Column:
    """Whether the source row's sequence lies after the target's, column by column, null lowest; equal is not newer."""
    out = F.lit(False)
    for name in reversed(sequence):
        s, t = F.col(f"{source}.{name}"), F.col(f"{target}.{name}")
        out = F.coalesce(s > t, s.isNotNull() & t.isNull()) | (s.eqNullSafe(t) & out)
    return out


def differs(source: str, target: str, columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, (~F.col(f"{source}.{c}").eqNullSafe(F.col(f"{target}.{c}")) for c in columns), F.lit(False))


def upsert(
    target: DataFrame, source: DataFrame, keys: Sequence[str], sequence: Sequence[str] = (), *,
    delete_keys: DataFrame | None = None, hard: bool = False, drop_missing: bool = False, keep_on_update: Sequence[str] = ("created_at",), ignore: Sequence[str] = ("created_at", "_silver_updated_at"),
) -> DataFrame:
    """The target after a keyed merge, each row marked `_change`: none, insert, update or delete (the old row).

    Null keys never match. A row changes only if the source is newer (where a
    sequence is given) and some compared column differs. `hard` deletes rows
    whose source says DELETE; `delete_keys` deletes the keys it names;
    `drop_missing` deletes keys that the source doesn't hold. One shuffle by key.
    """
    if set(target.columns) != set(source.columns):
        raise ValueError("source and target must have the same columns")
    columns = target.columns
    marked = source.select(*columns).withColumn("_delete", (F.col("_operation") == "DELETE") if hard else F.lit(False))
    if delete_keys is not None:
        gone = delete_keys.select(*keys).distinct().withColumn("_delete", F.lit(True))
        marked = marked.unionByName(gone, allowMissingColumns=True)
    match = reduce(lambda a, b: a & b, (F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys))
    both = target.withColumn("_old", F.lit(True)).alias("t").join(marked.withColumn("_new", F.lit(True)).alias("s"), match, "full")
    had, has = F.col("t._old").isNotNull(), F.col("s._new").isNotNull()
    after = newer("s", "t", sequence) if sequence else F.lit(True)
    if delete_keys is not None and sequence:
        after = after | (F.col("s._delete") & reduce(lambda a, b: a & b, (F.col(f"s.{c}").isNull() for c in sequence)))
    compared = [c for c in columns if c not in {*keys, *ignore}]
    change = (
        F.when(had & ~has, F.lit("delete") if drop_missing else F.lit("none"))
        .when(had & has & F.col("s._delete") & after, "delete")
        .when(had & has & ~F.col("s._delete") & after & differs("s", "t", compared), "update")
        .when(had & has, "none")
        .when(~F.col("s._delete"), "insert")
    )
    both = both.withColumn("_change", change).where("_change is not null")
    take = F.col("_change").isin("insert", "update")
    kept = {c for c in keep_on_update if c in columns}
    return both.select(*[F.when((F.col("_change") == "insert") | (take & F.lit(c not in kept)), F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c) for c in columns], "_change")


def merged(result: DataFrame) -> DataFrame:
    return result.where("_change <> 'delete'").drop("_change")


def insert_only(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows whose key is new, one a key (the smallest by all columns, so reruns agree)."""
    fresh = source.join(target.select(*keys).distinct(), list(keys), "left_anti")
    return latest(fresh, keys, [F.col(c) for c in fresh.columns if c not in keys] or [F.lit(0)])


def normalised(df: DataFrame, trim: Sequence[str] = (), lower: Sequence[str] = (), upper: Sequence[str] = (), phones: Sequence[str] = ()) -> DataFrame:
    out = {}
    for c in df.columns:
        v = trimmed(F.col(c)) if c in trim else F.col(c)
        v = F.lower(v) if c in lower else F.upper(v) if c in upper else v
        out[c] = phone(v) if c in phones else v
    return df.select(*[v.alias(c) for c, v in out.items()])
