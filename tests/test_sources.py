from __future__ import annotations

import datetime as dt
import json
import os

import pytest

from tidemark.operators import current
from tidemark.sources import control, outbox
from tidemark.sources.release import Releases
from tidemark.sources.store import Conflict, Table
from tidemark.streaming import cdc, stream


def frame(spark, rows, schema="k int, v string"):
    return spark.createDataFrame(rows, schema)


def content(df):
    return sorted(tuple(r) for r in df.collect())


def test_versions_and_idempotent_commits(spark, tmp_path):
    t = Table(spark, f"file://{tmp_path}/t")
    assert not t.exists()
    assert t.append(frame(spark, [(1, "a")]), writer="w", txn=0, metadata={"last_event_id": 3}) == 0
    assert t.append(frame(spark, [(1, "a")]), writer="w", txn=0) is None
    assert t.append(frame(spark, [(2, "b")]), writer="w", txn=1) == 1
    assert content(t.read()) == [(1, "a"), (2, "b")] and content(t.read(0)) == [(1, "a")]
    assert t.metadata("last_event_id") == 3 and [e.version for e in t.history()] == [1, 0]
    with pytest.raises(ValueError):
        t.read(9)


def test_lost_races_fail(spark, tmp_path):
    t = Table(spark, f"file://{tmp_path}/t")
    t.create(frame(spark, []).schema)
    t.create(frame(spark, []).schema)
    assert t.read().count() == 0
    t.append(frame(spark, [(1, "a")]))
    with pytest.raises(Conflict):
        t.append(frame(spark, [(2, "b")]), expected=0)
    assert not t.files.create("x", "_log", f"{1:020d}.json")
    assert content(t.read()) == [(1, "a")]


def test_dead_writers_block_nobody(spark, tmp_path):
    """A writer that dies between its guard and the rename leaves the guard; one that dies earlier leaves files that no entry names."""
    t = Table(spark, f"file://{tmp_path}/t")
    t.append(frame(spark, [(1, "a")]))
    guard = tmp_path / "t/_log" / f".lock-{1:020d}.json"
    guard.write_text("")
    with pytest.raises(Conflict):  # it may still be at work
        t.append(frame(spark, [(2, "b")]))
    os.utime(guard, (1, 1))
    assert t.append(frame(spark, [(2, "b")])) == 1 and not guard.exists()
    assert content(t.read()) == [(1, "a"), (2, "b")]
    assert t.vacuum(older=0) == 1 and content(t.read()) == [(1, "a"), (2, "b")]  # the folder of the lost race


def test_progress_is_carried_and_old_versions_go(spark, tmp_path):
    t = Table(spark, f"file://{tmp_path}/t")
    t.append(frame(spark, [(0, "a")]), metadata={"done": 7})
    for n in range(1, 5):
        t.append(frame(spark, [(n, "b")]))
    for n in range(110):
        t.commit("note", None, metadata={"n": n})
    assert t.metadata("done") == 7 and t.metadata("n") == 109
    assert t.compact() == 115 and len(t.entry().folders) == 1 and t.read().count() == 5
    assert t.ensure(owner="x") == 116 and t.ensure(owner="x") is None
    assert t.vacuum(keep=1, pinned=[0], older=0) == 4 and t.versions() == [0, 116]
    assert content(t.read(0)) == [(0, "a")] and t.read().count() == 5 and t.metadata("done") == 7


def test_merge_rewrites_only_files_with_its_keys(spark, tmp_path):
    t = Table(spark, f"file://{tmp_path}/t")
    t.overwrite(frame(spark, [(k, "a") for k in range(40)]).repartitionByRange(4, "k"))
    files = set(t.files.below(t.entry().folders[0]))
    t.merge(frame(spark, [(3, "x"), (100, "n")]), ["k"])
    assert len(files & set(t.entry().folders)) == 3 and t.read().count() == 41
    assert t.merge(frame(spark, [(3, "x")]), ["k"]) is None and not [n for n in t.files.names("data") if n.startswith("2-")]
    before = set(t.entry().folders)
    v = t.merge(frame(spark, [(200, "n"), (None, "z")]), ["k"])  # inserts rewrite nothing
    assert before < set(t.entry().folders) and content(t.changes(v, v).select("_change_type").distinct()) == [("insert",)]
    t.merge(frame(spark, [(3, "y")]), ["k"], drop_missing=True)
    assert content(t.read()) == [(3, "y")]


def test_new_columns_are_added_on_append(spark, tmp_path):
    t = Table(spark, f"file://{tmp_path}/t")
    t.append(frame(spark, [(1, "a")]))
    t.append(frame(spark, [(2, "b", 1.0)], "k int, v string, w double"))
    assert sorted(map(str, t.read().collect())) == sorted(map(str, frame(spark, [(1, "a", None), (2, "b", 1.0)], "k int, v string, w double").collect()))


def test_merge_rewrites_only_touched_buckets(spark, tmp_path):
    whole, split = Table(spark, f"file://{tmp_path}/a"), Table(spark, f"file://{tmp_path}/b", 8)
    steps = [([(k, "a") for k in range(40)], []), ([(3, "x")], [7]), ([(3, "x")], []), ([(99, "new"), (None, "z")], []), ([(k, "y") for k in range(40)], [99])]
    before = ()
    for n, (rows, gone) in enumerate(steps):
        got = [t.merge(frame(spark, rows, "k bigint, v string" if n == 3 else "k int, v string"), ["k"], delete_keys=frame(spark, [(g,) for g in gone], "k int") if n else None) for t in (whole, split)]
        assert got[0] == got[1] and sorted(map(str, whole.read().collect())) == sorted(map(str, split.read().collect())), n
        if n == 1:
            assert len(set(before) - set(split.entry().folders)) in (1, 2) and len(before) == 8
        before = split.entry().folders
    changes = [sorted(map(str, t.changes(0, 3).collect())) for t in (whole, split)]
    assert changes[0] == changes[1] and split.entry().keys == ("k",)
    split.append(frame(spark, [(500, "late")]))
    split.merge(frame(spark, [(500, "later")]), ["k"])
    split.set_properties(owner="x")
    assert split.read().where("k = 500").first().v == "later" and split.entry().buckets == 8 and split.read(0).count() == 40


def test_merge_and_change_feed(spark, tmp_path):
    t = Table(spark, f"file://{tmp_path}/t")
    t.merge(frame(spark, [(1, "a"), (2, "b"), (3, "c")]), ["k"])
    v = t.merge(frame(spark, [(1, "x"), (2, "b"), (4, "d")]), ["k"], delete_keys=frame(spark, [(3,)], "k int"))
    assert content(t.read()) == [(1, "x"), (2, "b"), (4, "d")]
    assert content(t.changes(v, v).select("k", "v", "_change_type")) == [(1, "a", "update_preimage"), (1, "x", "update_postimage"), (3, "c", "delete"), (4, "d", "insert")]
    assert t.merge(frame(spark, [(2, "b")]), ["k"]) is None


def test_release_pins_versions(spark, tmp_path):
    t, r = Table(spark, f"file://{tmp_path}/t"), Releases(spark, f"file://{tmp_path}/r", ("t",))
    v = t.overwrite(frame(spark, [(1, "a")]))
    r.publish("b1", {"s": 0}, {"t": v})
    t.overwrite(frame(spark, []))
    assert content(r.read("t", t)) == [(1, "a")] and r.advanced({"s": 2}) == {"s": (0, 2)}
    for bad in ({"t": True}, {}, {"t": -1}):
        with pytest.raises(ValueError):
            r.publish("b2", {}, bad)
    with pytest.raises(ValueError):
        r.advanced({"s": -1})


def test_locks_and_status(spark, tmp_path):
    with control.local_lock(f"{tmp_path}/l"):
        with pytest.raises(TimeoutError), control.local_lock(f"{tmp_path}/l", wait=0):
            pass
    t = Table(spark, f"file://{tmp_path}/t")
    t.create(frame(spark, []).schema)
    with control.table_lock(t, "a"):
        with pytest.raises(TimeoutError), control.table_lock(t, "b", wait=0):
            pass
        with control.table_lock(t, "c", clock=lambda: 1e12):
            pass
    s = control.RunStatus(str(tmp_path), "run")
    s.set("RUNNING")
    began = s.get()["started_at"]
    s.set("SUCCEEDED", rows=1)
    assert s.get()["started_at"] == began and s.get()["rows"] == 1


def test_outbox(spark):
    log = spark.createDataFrame([(i, "a" if i % 2 else "b", "INSERT", json.dumps({"id": i, "secret": "x"}), dt.datetime(2026, 1, 1)) for i in range(1, 11)], "event_id bigint, source_table string, operation string, row_data string, occurred_at timestamp")
    assert {r.source_table: (r.upper, r.newest) for r in outbox.bounds(log, {"a": 3}, 2).collect()} == {"a": (7, 9), "b": (4, 10)}
    from pyspark.sql.types import StructType

    e = outbox.events(log, "a", StructType.fromDDL("id int, secret string"), 3, 7, ("secret",))
    assert content(e.select("id", "_event_id")) == [(5, 5), (7, 7)] and "secret" not in e.columns
    assert len(outbox.with_metadata(e, "b", "pg", "public", "a").first()._record_hash) == 64
    assert outbox.partitions_for(0, 250_000, 100_000, 4) == 3 and outbox.partitions_for(5, 5, 10, 4) == 1
    for bad in ((9, 3), (9, None), (True, 9), (-1, 3)):
        with pytest.raises(ValueError):
            outbox.guard(*bad)
    outbox.guard(None, None)
    tries = []

    def work():
        tries.append(1)
        if len(tries) < 3:
            raise OSError
        return "done"

    slept = []
    assert outbox.retried(work, 3, 2, slept.append) == "done" and slept == [2, 4]
    with pytest.raises(ValueError):
        outbox.read_partitioned(spark, "select 1", "id", 5, 5, 1, {})


SCHEMAS = {"t": {"id": "int", "amount": "decimal(12,2)", "seen_at": "timestamp"}}


def record(n, value):
    return (None, None if value is None else bytearray(value.encode()), "top", 0, n, dt.datetime(2026, 1, 1))


def envelope(op="c", table="t", **row):
    image = {"after": row} if op != "d" else {"before": row}
    return json.dumps({**image, "source": {"schema": "public", "table": table, "lsn": 1}, "op": op, "ts_ms": 1767261600000})


CASES = [
    (envelope(id=1, amount="1.50", seen_at=1767261600000000), None), (envelope("d", id=2), None), (envelope(id=3, extra=1), "unexpected_payload_fields:extra"), (envelope(id=4, amount="x"), "invalid_field_type:amount"),
    (envelope(amount="1"), "invalid_primary_key"), (envelope(table="u", id=1), "unknown_table"), (envelope("x", id=1), "unsupported_operation"), (None, "tombstone"), ("{", "invalid_json"), ('{"op":"c"}', "missing_source_metadata"),
]


def test_cdc_cases(spark):
    raw = cdc.normalise(spark.createDataFrame([record(i, v) for i, (v, _) in enumerate(CASES)], "key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp"))
    tables, bad = cdc.decode(raw, SCHEMAS, {"t": ["id"]}, "q:1:0")
    assert {r.offset: r._quarantine_reason for r in bad.collect()} == {i: e for i, (_, e) in enumerate(CASES) if e}
    good = {r.id: r for r in tables["t"].collect()}
    assert set(good) == {1, 2} and good[2]._operation == "DELETE" and good[1].seen_at == dt.datetime(2026, 1, 1, 10) and len(good[1]._record_hash) == 64
    assert cdc.statistics(raw).count() == 3


def test_stream_split_is_replayed_once(spark, tmp_path):
    rows = spark.createDataFrame([record(0, CASES[0][0]), record(1, CASES[3][0])], "key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp")
    cdc.normalise(rows).write.parquet(f"{tmp_path}/in")
    source = stream.files(spark, f"{tmp_path}/in", cdc.normalise(rows).schema)
    t, q = Table(spark, f"file://{tmp_path}/t"), Table(spark, f"file://{tmp_path}/q")
    seen = []
    for checkpoint in ("a", "b"):
        stream.split(source, {"t": t}, q, SCHEMAS, {"t": ["id"]}, f"{tmp_path}/{checkpoint}", "query", then=lambda d, n: seen.append(d["t"].count())).awaitTermination()
    assert t.read().count() == 1 and q.read().count() == 1 and seen == [1, 1]
    source = stream.files(spark, f"{tmp_path}/in", cdc.normalise(rows).schema, most_bytes=1 << 20)
    stream.append(source, f"{tmp_path}/raw", f"{tmp_path}/c").awaitTermination()
    assert spark.read.parquet(f"{tmp_path}/raw").count() == 2


def test_late_events_lose(spark, tmp_path):
    t = Table(spark, f"file://{tmp_path}/t")
    schema = "user_id int, v string, _event_id string, _operation string, _event_occurred_at timestamp"
    newer = spark.createDataFrame([(1, "new", "2", "UPDATE", dt.datetime(2026, 1, 2))], schema)
    late = spark.createDataFrame([(1, "late", "1", "INSERT", dt.datetime(2026, 1, 1))], schema)
    for e in (newer, late):
        t.merge(current.current_state(e, ["user_id"], ["user_id", "v"]), ["user_id"], current.SEQUENCE)
    assert [r.v for r in t.read().collect()] == ["new"]


def test_guards(spark, tmp_path):
    os.makedirs(f"{tmp_path}/cp/offsets")
    with pytest.raises(RuntimeError):
        stream.guard_checkpoint(spark, f"file://{tmp_path}/cp", False)
    stream.guard_checkpoint(spark, f"file://{tmp_path}/cp", True)
    stream.guard_checkpoint(spark, f"file://{tmp_path}/none", False)
    with pytest.raises(ValueError):
        stream.kafka(spark, "h:1", topics="a", pattern="b")
    p = stream.Pending(2)
    p.add(spark.createDataFrame([(1,), (2,)], "id int"))
    assert p.ids == {1, 2}
    p.add(spark.createDataFrame([(3,)], "id int"))
    assert p.all and not p.ids
