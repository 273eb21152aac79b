from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from tidemark import settings
from tidemark.contracts import GOLD, SOURCES
from tidemark.plans import batch, bronze, gold, silver, validate
from tidemark.plans.layers import Lake
from tidemark.sources.generator import Shop


def lake_at(spark, path, **more):
    return Lake(spark, settings.load([], {}, lake=f"file://{path}/lake", runs=f"{path}/runs", **more))


def rows(df, *drop):
    return sorted(map(str, df.select(*sorted(c for c in df.columns if c not in drop)).collect()))


def test_batch_runs_incremental_equals_full(spark, tmp_path):
    shop, lake = Shop().bootstrap(4, 8), lake_at(spark, tmp_path, buckets=3)
    first = batch.run(lake, bronze.FrameLog(shop.log(spark)), check=True, batch_id="one")
    assert first["gold"]["mode"] == "full" and first["bronze"]["orders"]["rows"] == 8
    assert first["validation"]["gold"]["fact_rows"] == len(shop.rows["order_items"])
    assert json.loads((tmp_path / "runs" / "one.json").read_text())["status"] == "SUCCEEDED"
    again = batch.run(lake, bronze.FrameLog(shop.log(spark)))
    assert again["no_change"] and "silver" not in again
    shop.change()
    second = batch.run(lake, bronze.FrameLog(shop.log(spark)), check=True)
    assert second["gold"]["mode"] == "incremental" and second["silver"]["orders"] == "incremental"
    assert second["validation"]["gold"]["fact_rows"] == len(shop.rows["order_items"])
    other = lake_at(spark, tmp_path / "other")
    batch.run(other, bronze.FrameLog(shop.log(spark)))
    for t in SOURCES:
        assert rows(lake.silver(t).read()) == rows(other.silver(t).read()), t
    assert rows(lake.gold("dim_customer").read()) == rows(other.gold("dim_customer").read())
    money = [c for c in lake.gold("fact_sales").read().columns if c.endswith("_amount") or c.startswith("source_") or "allocated" in c]
    assert rows(lake.gold("fact_sales").read().select(money)) == rows(other.gold("fact_sales").read().select(money))
    versions = lake.gold("dim_shop").read().where("source_shop_id is not null").groupBy("source_shop_id").agg(F.sum(F.col("is_current").cast("int")).alias("n"))
    assert {r.n for r in versions.collect()} == {1} and lake.gold("dim_shop").read().count() == 5
    assert lake.releases().read("fact_sales", lake.gold("fact_sales")).count() == len(shop.rows["order_items"])
    silver.preflight(lake, {"shops": lake.bronze("shops").read()})
    lake.silver("orders").append(lake.silver("orders").read().limit(1).withColumn("more", F.lit(1)))
    with pytest.raises(ValueError, match="more"):
        silver.preflight(lake, {"shops": lake.bronze("shops").read(), "orders": lake.bronze("orders").read()})
    with pytest.raises(validate.AuditError, match="keys repeat"):
        validate.table(lake, "orders")


def test_damaged_runs_fail_and_say_so(spark, tmp_path):
    shop, lake = Shop(1).bootstrap(2, 2), lake_at(spark, tmp_path, source={"delay_seconds": 0, "attempts": 1})
    bad = shop.log(spark).withColumn("operation", F.when(F.col("source_table") == "orders", "MERGE").otherwise(F.col("operation")))
    with pytest.raises(ValueError, match="invalid events"):
        batch.run(lake, bronze.FrameLog(bad), "bronze", batch_id="bad")
    assert json.loads((tmp_path / "runs" / "bad.json").read_text())["status"] == "FAILED" and not lake.bronze("orders").exists()
    batch.run(lake, bronze.FrameLog(shop.log(spark)), "bronze")
    with pytest.raises(ValueError, match="regressed"):
        bronze.extract(lake, bronze.FrameLog(shop.log(spark).where("event_id < 3")), "less")
    with pytest.raises(ValueError):
        batch.run(lake, None, "bronze")


def test_bounds_and_recovered_cursors(spark, tmp_path):
    shop, lake = Shop(2).bootstrap(3, 3), lake_at(spark, tmp_path, source={"most_events": 2})
    log = bronze.FrameLog(shop.log(spark))
    got = bronze.extract(lake, log, "a")
    assert got["app_users"].rows == 2 and got["orders"].rows == 2
    users = lake.bronze("app_users")
    users.files.delete("_log")
    users.overwrite(users.spark.read.parquet(f"{users.path}/data/*"))
    assert bronze.cursor_of(lake, "app_users") == got["app_users"].cursor and users.entry().operation == "recover"
    assert bronze.extract(lake, log, "b")["app_users"].rows == 1 and users.read().count() == 3
    assert "password_hash" not in users.read().columns
    users.commit("x", None, metadata={bronze.CURSOR: True})
    with pytest.raises(ValueError, match="damaged"):
        bronze.cursor_of(lake, "app_users")


def test_gold_owner(spark, tmp_path):
    lake = lake_at(spark, tmp_path, gold_owner="streaming")
    with pytest.raises(ValueError, match="owns"):
        batch.run(lake, None, "gold")


def test_jdbc_sql():
    log = bronze.JdbcLog(None, settings.Source(schema="s"))
    assert "('a', 1), ('b', 2)" in log.bounds_sql({"b": 2, "a": 1}, 5) and "LIMIT 5" in log.bounds_sql({"a": 0}, 5)
    assert log.events_sql("a", 3, 9).endswith("WHERE source_table = 'a' AND event_id > 3 AND event_id <= 9")


def test_settings(tmp_path):
    (tmp_path / "a.toml").write_text('lake = "${ROOT:-/x}/lake"\n[source]\nhost = "${HOST}"\nport = "${PORT:-1}"\n')
    (tmp_path / "b.toml").write_text("[source]\nmost_events = 7\n")
    files = [str(tmp_path / "a.toml"), str(tmp_path / "b.toml")]
    s = settings.load(files, {"HOST": "h"})
    assert (s.lake, s.source.host, s.source.port, s.source.most_events) == ("/x/lake", "h", 1, 7) and "password" not in repr(s)
    for bad in ({"lake": ""}, {"lake": "x", "nonsense": 1}, {"lake": "x", "gold_owner": "me"}, {"lake": "x", "streaming": {"enabled": "true"}}, {"lake": "x", "parallel_tables": 0}):
        with pytest.raises(ValueError):
            settings.load([], {}, **bad)
    with pytest.raises(ValueError, match="HOST"):
        settings.load(files, {})


def test_generator_repeats():
    assert Shop(3).bootstrap(2, 3).change().events == Shop(3).bootstrap(2, 3).change().events
    assert set(GOLD) and silver.GUARD and gold.REFERENCES
