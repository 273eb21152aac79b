"""The audit over all layers: keys, lineage, progress, and the star schema as released."""

from __future__ import annotations

from typing import Any

from pyspark.sql import functions as F

from tidemark.contracts import GOLD, SOURCES
from tidemark.functions.columns import any_of, require
from tidemark.operators import current
from tidemark.plans import bronze, gold, silver
from tidemark.plans.layers import Lake, progress

METADATA = ("_record_hash", "_ingested_at", "_batch_id", "_source_system", "_source_schema", "_source_table", "_ingestion_type", "_operation", "_event_id", "_event_occurred_at")


class AuditError(ValueError):
    """A layer breaks a rule."""


def table(lake: Lake, name: str) -> dict[str, int]:
    """One table's raw events and current state; an error names the first rule that is broken."""
    key, raw, now = SOURCES[name].key, lake.bronze(name), lake.silver(name)
    if not raw.exists() or not now.exists():
        raise AuditError(f"{name}: a layer is missing")
    cursor, done = progress(raw, bronze.CURSOR), progress(now, silver.DONE)
    if cursor is None or done != raw.entry().version:
        raise AuditError(f"{name}: raw events are at version {raw.entry().version} and event {cursor}, the current state at version {done}")
    events, state = require(raw.read(), METADATA), require(now.read(), ("_source_event_sequence", "_ingestion_mode"))
    e = events.agg(F.count("*").alias("n"), F.countDistinct("_event_id").alias("ids"), F.count_if(any_of(F.col(c).isNull() for c in METADATA)).alias("bare")).first()
    beyond = (F.col("_ingestion_mode") == "batch") & (F.col("_source_event_sequence") > cursor)
    s = state.agg(F.count("*").alias("n"), F.countDistinct(key).alias("keys"), F.count_if(F.col(key).isNull()).alias("bare"), F.count_if(beyond).alias("beyond"), F.count_if(~F.coalesce("_is_deleted", F.lit(False))).alias("alive")).first()
    streamed = lake.streamed(name).read().count() if lake.streamed(name).exists() else 0
    rules = {
        "raw events lack metadata": e.bare, "raw events repeat": e.n - e.bare - e.ids if e.bare else e.n - e.ids, "keys are null": s.bare, "keys repeat": s.n - s.bare - s.keys,
        "rows lie beyond the cursor": s.beyond, "more rows than events": max(0, s.n - e.n - streamed),
    }
    if bad := {r: n for r, n in rules.items() if n > 0}:
        raise AuditError(f"{name}: {bad}")
    return {"bronze_versions": e.n, "silver_rows": s.alive}


def report(lake: Lake) -> dict[str, Any]:
    """Counts of every table and the star schema's totals, or an error."""
    tables = lake.each(lambda t: table(lake, t), SOURCES)
    release, now = lake.releases().latest(), silver.versions(lake)
    if release is None:
        raise AuditError("nothing is published")
    if release["silver_versions"] != now:
        raise AuditError(f"the release stands on {release['silver_versions']}, current states are at {now}")
    star = {n: lake.gold(n).read(release["gold_versions"][n]) for n in GOLD}
    source = {t: current.alive(lake.silver(t).read(now[t])) for t in ("orders", "order_items")}
    facts = star.pop("fact_sales")
    return {"tables": tables, "gold": gold.gate(facts, source["orders"], source["order_items"], star, full=True)}
