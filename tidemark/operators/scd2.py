"""Slowly changing dimensions of type 2: replay of history, snapshot difference, temporal lookup."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import OPEN_END, surrogate_key


def _end() -> Column:
    return F.lit(OPEN_END).cast("timestamp_ntz")


def replay(events: DataFrame, key: str, time: str, order: Sequence[str], attribute_hash: str, type1: Sequence[str] = (), carried: Sequence[str] = (), operation: str = "_operation", event_id: str | None = None, initial: str | None = None) -> DataFrame:
    """Versions of every key from its events.

    A version starts at an event that is no DELETE and whose attributes differ
    from the last known ones, or that follows a DELETE. It ends where the next
    version starts or a DELETE closes it. Type-1 columns take the version's
    last known value. All windows run over one partitioning and order: runs of
    events are numbered first and then aggregated by (key, version).
    """
    if event_id:
        events = events.dropDuplicates([event_id])
    e = events.where(F.col(key).isNotNull())
    w = Window.partitionBy(key).orderBy(*[F.col(c).asc_nulls_last() for c in order])
    deleted = F.col(operation) == "DELETE"
    known = F.last(F.when(~deleted, F.col(attribute_hash)), True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    e = e.withColumns({"_known": known, "_was": F.lag(operation).over(w)})
    starts = ~deleted & (F.col("_known").isNull() | ~F.col(attribute_hash).eqNullSafe(F.col("_known")) | F.coalesce(F.col("_was") == "DELETE", F.lit(False)))
    e = e.withColumn("_starts", starts).withColumn("_closes", deleted & ~F.coalesce(F.col("_was") == "DELETE", F.lit(False)))
    e = e.withColumn("_version", F.sum(F.col("_starts").cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    position = F.struct(*[F.struct(F.col(c).isNull().alias("z"), F.col(c).alias("v")).alias(c) for c in order])
    first = lambda c: F.min_by(F.col(c), F.when(F.col("_starts"), position))
    versions = (
        e.where("_version > 0")
        .groupBy(key, "_version")
        .agg(
            first(time).alias("_start"),
            *([first(initial).alias("_initial")] if initial else []),
            first(operation).alias("_how"),
            first(attribute_hash).alias("attribute_hash"),
            *[first(c).alias(c) for c in carried],
            *[F.max_by(F.col(c), F.when(~deleted & F.col(c).isNotNull(), position)).alias(c) for c in type1],
            F.min(F.when(F.col("_closes"), F.col(time))).alias("_closed"),
        )
    )
    by_version = Window.partitionBy(key).orderBy("_version")
    follows = F.lead("_start").over(by_version)
    begin = F.when((F.col("_version") == 1) & (F.col("_how") != "SEED"), F.coalesce("_initial", "_start")).otherwise(F.col("_start")) if initial else F.col("_start")
    until = F.coalesce(F.col("_closed"), follows)
    return versions.select(
        key, F.col("_version").cast("int").alias("version"), "attribute_hash", *carried, *type1, begin.alias("effective_from"),
        F.coalesce(until, _end()).alias("effective_to"), until.isNull().alias("is_current"), F.col("_closed").isNotNull().alias("is_deleted"),
    )


def with_keys(versions: DataFrame, key: str, into: str) -> DataFrame:
    """The surrogate key of each version: of its key, start (in microseconds, whatever the session's zone) and attributes."""
    start = F.unix_micros(F.col("effective_from").cast("timestamp"))
    return versions.withColumn(into, surrogate_key(F.col(key), start, F.col("attribute_hash")))


def affected(history: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """All history of the keys that new events touch: replaying it gives what a full replay would, late events and re-inserts too."""
    return history.join(new.select(key).distinct(), key, "left_semi")


def difference(source: DataFrame, current: DataFrame, key: str, hashed: str, type1: Sequence[str]) -> DataFrame:
    """What a snapshot asks of a dimension's current members: rows (key, action) of INSERT, CLOSE, TYPE1 and the source's columns. A changed member gives CLOSE and INSERT."""
    c = current.select(F.col(key).alias("_key"), F.col(hashed).alias("_hash"), *[F.col(t).alias(f"_{t}") for t in type1])
    j = source.join(c, F.col(key) == F.col("_key"), "left")
    fresh, moved = F.col("_key").isNull(), ~F.col(hashed).eqNullSafe(F.col("_hash"))
    touched = reduce(lambda a, b: a | b, (~F.col(t).eqNullSafe(F.col(f"_{t}")) for t in type1), F.lit(False))
    actions = F.when(fresh, F.array(F.lit("INSERT"))).when(moved, F.array(F.lit("CLOSE"), F.lit("INSERT"))).when(touched, F.array(F.lit("TYPE1"))).otherwise(F.array().cast("array<string>"))
    return j.withColumn("action", F.explode(actions)).select("action", *source.columns)


def apply(dimension: DataFrame, staged: DataFrame, key: str, type1: Sequence[str], at: str = "effective_from") -> DataFrame:
    """The dimension after staged actions: closed members end at the new member's start, type-1 columns are overwritten, inserts become current."""
    change = staged.where("action <> 'INSERT'").select(F.col(key).alias("_key"), F.col("action").alias("_action"), F.col(at).alias("_at"), *[F.col(t).alias(f"_{t}") for t in type1])
    j = dimension.join(change, (F.col(key) == F.col("_key")) & F.col("is_current"), "left")
    closes, sets = F.coalesce(F.col("_action") == "CLOSE", F.lit(False)), F.coalesce(F.col("_action") == "TYPE1", F.lit(False))
    new = {c: F.col(c) for c in dimension.columns}
    new |= {"effective_to": F.when(closes, F.col("_at")).otherwise(F.col("effective_to")), "is_current": F.col("is_current") & ~closes}
    new |= {t: F.when(sets, F.col(f"_{t}")).otherwise(F.col(t)) for t in type1}
    inserted = staged.where("action = 'INSERT'").drop("action").withColumns({"effective_to": _end(), "is_current": F.lit(True)})
    return j.select(*[v.alias(c) for c, v in new.items()]).unionByName(inserted.select(*dimension.columns))


def lookup(facts: DataFrame, dimension: DataFrame, on: Column, at: Column, key: str, into: str, member: str) -> DataFrame:
    """facts with the key of the version valid at `at`; the first version where the fact lies before all; else 0.

    The first version's start is opened to the past, so there is one equi-join
    with a range condition instead of two joins.
    """
    w = Window.partitionBy(member).orderBy("effective_from", key)
    d = dimension.withColumn("_first", F.row_number().over(w) == 1).select(F.col(member).alias("_member"), F.col(key).alias("_key"), F.when(~F.col("_first"), F.col("effective_from")).alias("_from"), F.col("effective_to").alias("_to"))
    valid = (on == F.col("_member")) & (F.col("_from").isNull() | (at >= F.col("_from"))) & (at < F.col("_to"))
    return facts.join(d, valid, "left").withColumn(into, F.coalesce("_key", F.lit(0))).drop("_member", "_key", "_from", "_to")


def violations(dimension: DataFrame, key: str, version: str) -> DataFrame:
    """(rule, violations): more than one current, none current though none deleted last, empty intervals, overlaps. One shuffle by key."""
    w = Window.partitionBy(key).orderBy("effective_from", version)
    d = dimension.withColumn("_before", F.lag("effective_to").over(w))
    by_key = d.groupBy(key).agg(
        F.sum(F.col("is_current").cast("int")).alias("_current"), F.max_by("is_deleted", F.struct("effective_to", version)).alias("_gone"),
        F.sum((F.col("effective_from") >= F.col("effective_to")).cast("int")).alias("_empty"), F.sum((F.col("_before") > F.col("effective_from")).cast("int")).alias("_overlaps"),
    )
    total = by_key.agg(
        F.sum((F.col("_current") > 1).cast("long")).alias("many_current"), F.sum(((F.col("_current") == 0) & ~F.col("_gone")).cast("long")).alias("no_current"),
        F.sum("_empty").alias("empty_interval"), F.sum("_overlaps").alias("overlap"),
    )
    rules = ("many_current", "no_current", "empty_interval", "overlap")
    return total.select(F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.coalesce(F.col(r), F.lit(0)).cast("long").alias("violations")) for r in rules])).alias("v")).select("v.*")
