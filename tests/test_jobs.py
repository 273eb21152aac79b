from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from tidemark import settings
from tidemark.jobs.__main__ import RECORD, Progress, envelope_schema, main
from tidemark.plans import gold
from tidemark.plans.layers import Lake
from tidemark.sources.generator import Shop
from tidemark.streaming import cdc, stream
from tidemark.streaming.gold import Reconciler, raw_to_gold


def envelopes(spark, events):
    """Raw envelopes of generated change events."""
    out = []
    for n, table, operation, row, at in events:
        image = json.loads(row)
        image.pop("password_hash", None)
        body = {"before" if operation == "DELETE" else "after": image, "source": {"schema": "s", "table": table, "lsn": n}, "op": {"INSERT": "c", "UPDATE": "u", "DELETE": "d"}[operation], "ts_ms": int(at.timestamp() * 1000)}
        out.append((b"{}", json.dumps(body).encode(), "t", 0, n, at))
    return cdc.normalise(spark.createDataFrame(out, RECORD))


def test_streams_wait_for_whole_orders(spark, tmp_path):
    shop = Shop(7).bootstrap(3, 3)
    last = max(i for i, e in enumerate(shop.events) if e[1] == "order_items")
    lake = Lake(spark, settings.load([], {}, lake=f"file://{tmp_path}/lake", gold_owner="streaming"))
    late, reconciler = [shop.events[last]], Reconciler(lake)
    source = stream.files(spark, f"{tmp_path}/in", envelope_schema(spark))
    for events, outcome in ((shop.events[:last] + shop.events[last + 1 :], "deferred"), (late, "published")):
        envelopes(spark, events).write.mode("append").parquet(f"{tmp_path}/in")
        query = raw_to_gold(lake, source, f"{tmp_path}/checkpoint", reconciler=reconciler)
        query.awaitTermination()
        assert bool(lake.releases().latest()) == (outcome == "published")
    assert lake.gold("fact_sales").read().count() == len(shop.rows["order_items"]) and not reconciler.pending.ids
    assert reconciler.reconcile() == "no_change"
    assert {r[0] for r in lake.silver("orders").read().select("_ingestion_mode").distinct().collect()} == {"streaming"}
    # order headers that disagree with their lines beyond the gate's sums make facts break a rule
    orders = lake.silver("orders")
    one = orders.read().limit(1).withColumn("total_amount", F.col("total_amount") + 5).withColumn("_source_event_sequence", F.col("_source_event_sequence") + 10_000)
    orders.merge(one.withColumn("_event_occurred_at", F.col("_event_occurred_at") + F.expr("interval 1 day")), ["order_id"], ("_event_occurred_at",))
    assert reconciler.reconcile() == "skipped" and "monetary_mismatch" in reconciler.last["error"]
    with pytest.raises(gold.QualityError):
        reconciler.reconcile(final=True)


def test_deferred_retries_end(spark, tmp_path):
    lake = Lake(spark, settings.load([], {}, lake=f"file://{tmp_path}/lake", streaming={"retry_seconds": 5}))
    now = [0.0]
    r = Reconciler(lake, clock=lambda: now[0], sleep=lambda s: now.__setitem__(0, now[0] + s))
    assert r.reconcile() == "skipped"
    r.reconcile = lambda: "deferred"
    assert r.retried() == "deferred" and now[0] == 6


def test_progress_is_throttled():
    p = Progress()
    batches = [{"batchId": i, "numInputRows": 0} for i in range(20)]
    assert sum(p.line(b) is not None for b in batches) == 2 and p.line(batches[-1]) is None and p.line(None) is None
    assert json.loads(p.line({"batchId": 20, "numInputRows": 3}))["rows"] == 3


def test_command_line(spark, tmp_path, capsys):
    config = tmp_path / "c.toml"
    config.write_text(f'lake = "file://{tmp_path}/lake"\nruns = "{tmp_path}/runs"\n')
    log = ["--config", str(config), "--log", f"{tmp_path}/log"]
    assert main(["generate", *log, "--customers", "2", "--orders", "2", "--rounds", "0"]) == 0
    assert main(["batch", *log, "--mode", "bronze"]) == 0
    assert json.loads(capsys.readouterr().out.splitlines()[-1])["bronze"]["orders"]["rows"] == 2
    assert main(["reconcile", "--config", str(config)]) == 0
    assert json.loads(capsys.readouterr().out.splitlines()[-1])["outcome"] == "skipped"
    with pytest.raises(SystemExit):
        main(["ingest", "--config", str(config)])
