"""Command line: python -m tidemark.jobs COMMAND --config base.toml [--config local.toml].

generate   an invented change log into Parquet
batch      extract, current states, star schema (--mode, --full, --validate)
validate   the audit over all layers
ingest     Kafka into raw envelopes
merge      raw envelopes into current states and, if streaming owns it, the star schema
reconcile  publish the star schema now, rebuilding it whole if need be
"""

from __future__ import annotations

import argparse
import json
import sys
import time
from typing import Any

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tidemark import settings
from tidemark.plans import batch, bronze, validate
from tidemark.plans.layers import Lake
from tidemark.sources.generator import Shop
from tidemark.sources.store import Files
from tidemark.streaming import cdc, gold, stream

RECORD = "key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp"
IDLE_SECONDS = 10


def session(s: settings.Settings) -> SparkSession:
    builder = SparkSession.builder.appName("tidemark").config("spark.sql.adaptive.enabled", "true").config("spark.scheduler.mode", "FAIR").config("spark.sql.session.timeZone", s.timezone)
    for k, v in s.spark.items():
        builder = builder.master(v) if k == "master" else builder.config(k, v)
    return builder.getOrCreate()


def envelope_schema(spark: SparkSession) -> StructType:
    return cdc.normalise(spark.createDataFrame([], RECORD)).schema


class Progress:
    """One line a micro-batch that held rows, and every tenth that held none."""

    def __init__(self) -> None:
        self.seen, self.empty = -1, 0

    def line(self, last: dict[str, Any] | None) -> str | None:
        if not last or last["batchId"] == self.seen:
            return None
        self.seen = last["batchId"]
        self.empty = 0 if last["numInputRows"] else self.empty + 1
        if self.empty % 10:
            return None
        return json.dumps({"batch": last["batchId"], "rows": last["numInputRows"], "ms": last.get("durationMs", {}).get("triggerExecution")})


def follow(query: StreamingQuery, reconciler: gold.Reconciler | None) -> None:
    """Until the query ends: report its progress, and look at waiting orders when nothing arrives."""
    progress = Progress()
    while not query.awaitTermination(IDLE_SECONDS):
        if line := progress.line(query.lastProgress):
            print(line, flush=True)
        if reconciler and (reconciler.pending.ids or reconciler.pending.all) and not query.status["isTriggerActive"]:
            print(json.dumps({"reconcile": reconciler.reconcile()}), flush=True)


def checkpoint(s: settings.Settings, query: str) -> str:
    return f"{(s.streaming.checkpoints or s.lake + '/checkpoints').rstrip('/')}/{query}-{s.streaming.checkpoint_version}"


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="tidemark")
    p.add_argument("command", choices=("generate", "batch", "validate", "ingest", "merge", "reconcile"))
    p.add_argument("--config", action="append", default=[])
    p.add_argument("--mode", choices=batch.MODES, default="all")
    p.add_argument("--full", action="store_true")
    p.add_argument("--validate", action="store_true")
    p.add_argument("--available-now", action="store_true", help="stop when what is there has been read")
    p.add_argument("--log", help="a change log in Parquet, instead of the database")
    p.add_argument("--seed", type=int, default=42)
    p.add_argument("--customers", type=int, default=100)
    p.add_argument("--orders", type=int, default=500)
    p.add_argument("--rounds", type=int, default=0)
    a = p.parse_args(argv)
    s = settings.load(a.config)
    spark = session(s)
    lake, raw = Lake(spark, s), f"{s.lake.rstrip('/')}/bronze_cdc/_envelopes"
    if a.command == "generate":
        if not a.log:
            p.error("generate needs --log")
        shop = Shop(a.seed).bootstrap(a.customers, a.orders)
        for _ in range(a.rounds):
            shop.change()
        shop.log(spark).write.mode("overwrite").parquet(a.log)
        out: Any = {"events": len(shop.events)}
    elif a.command == "batch":
        log = bronze.FrameLog(spark.read.parquet(a.log)) if a.log else bronze.JdbcLog(spark, s.source)
        out = batch.run(lake, log, a.mode, a.full, a.validate)
    elif a.command == "validate":
        out = validate.report(lake)
    elif a.command == "reconcile":
        r = gold.Reconciler(lake)
        r.pending.all = True
        out = {"outcome": r.reconcile(final=True), **r.last}
    elif a.command == "ingest":
        if not s.streaming.enabled:
            p.error("streaming is not enabled")
        stream.guard_checkpoint(spark, checkpoint(s, "raw"), bool(Files(spark, raw).names(".")))
        source = stream.kafka(spark, s.streaming.servers, topics=s.streaming.topics or None, pattern=s.streaming.pattern or None, starting=s.streaming.starting, fail_on_loss=s.streaming.fail_on_loss, most=s.streaming.most_offsets)
        query = stream.append(cdc.normalise(source), raw, checkpoint(s, "raw"), None if a.available_now else s.streaming.every)
        follow(query, None)
        out = {"ended": time.time()}
    else:
        stream.guard_checkpoint(spark, checkpoint(s, "merge"), lake.silver("orders").exists())
        reconciler = gold.Reconciler(lake)
        source = stream.files(spark, raw, envelope_schema(spark), s.streaming.most_files, s.streaming.most_bytes or None)
        follow(gold.raw_to_gold(lake, source, checkpoint(s, "merge"), "merge", reconciler, None if a.available_now else s.streaming.every), reconciler)
        out = {"outcome": reconciler.reconcile(final=True) if a.available_now else "ended", **reconciler.last}
    print(json.dumps(out, default=str))
    return 0


if __name__ == "__main__":
    sys.exit(main())
