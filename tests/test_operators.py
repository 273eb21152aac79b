from __future__ import annotations

import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from tidemark.contracts import GOLD, SOURCES
from tidemark.functions import columns as c
from tidemark.operators import affected, allocate, current, dimensions, fact, quality, scd2

T0 = dt.datetime(2026, 1, 1, 10)


def at(hours):
    return T0 + dt.timedelta(hours=hours)


def test_rounding_rest_goes_to_last_line(spark):
    df = spark.createDataFrame([(1, i, D(10), D(10)) for i in (1, 2, 3)] + [(2, 1, D(5), D(0)), (2, 2, D(5), D(0))], "o int, i int, amount decimal(18,2), w decimal(18,2)")
    got = {(r.o, r.i): r.part for r in allocate.allocate(df, "o", "i", {"part": F.col("amount")}, F.col("w")).collect()}
    assert got == {(1, 1): D("3.33"), (1, 2): D("3.33"), (1, 3): D("3.34"), (2, 1): D("0.00"), (2, 2): D("5.00")}


def test_half_cents_round_to_even(spark):
    r = spark.range(1).select(*[allocate.share(F.lit(D(a)).cast("decimal(18,2)"), F.lit(D("1")).cast("decimal(18,2)"), F.lit(D("8")).cast("decimal(28,2)")).alias(n) for n, a in (("a", "0.04"), ("b", "0.12"), ("c", "-0.12"))]).first()
    assert (r.a, r.b, r.c) == (D("0.00"), D("0.02"), D("-0.02"))  # 0.005, 0.015, -0.015


@pytest.mark.parametrize(("header", "first", "second"), [(D(50), (D("20.00"), D("137.50")), (D("30.00"), D("276.50"))), (D(0), (D("0.00"), D("115.50")), (D("0.00"), D("346.50")))])
def test_discount_levels(spark, header, first, second):
    schema = "o int, i int, gross decimal(18,2), own decimal(18,2), header decimal(18,2), ship decimal(18,2), tax decimal(18,2)"
    df = spark.createDataFrame([(1, 1, D(100), D(10), header, D(30), D(8)), (1, 2, D(300), D(0), header, D(30), D(24))], schema)
    got = allocate.with_discounts(df, "o", "i", "gross", "own", "header", "ship", "tax").orderBy("i").collect()
    assert [r.shipping_allocated for r in got] == [D("7.50"), D("22.50")]
    assert [r.total_discount for r in got] == [first[0], second[0]]
    assert sum(r.net for r in got) == D(400) + D(32) + D(30) - header


EVENT = "user_id int, email string, _operation string, _event_id string, _event_occurred_at timestamp, _ingestion_type string, _source_lsn bigint, _kafka_offset bigint"


def test_stream_beats_batch_at_the_same_time_and_deletes_stay(spark):
    e = spark.createDataFrame(
        [(1, "a", "INSERT", "5", at(0), "batch_change_event", None, None), (1, "b", "UPDATE", "t:0:1", at(0), "streaming_cdc", 9, 1), (2, "c", "INSERT", "6", at(0), None, None, None), (2, "c", "DELETE", "7", at(1), None, None, None)], EVENT
    )
    got = {r.user_id: (r.email, r._is_deleted) for r in current.current_state(e, ["user_id"], ["user_id", "email"]).collect()}
    assert got == {1: ("b", False), 2: ("c", True)}
    assert current.current_state(e.limit(0), ["user_id"], ["user_id", "email"]).count() == 0


def test_upsert_rules(spark):
    schema = "k int, v string, seq int, created_at string"
    t = spark.createDataFrame([(1, "a", 5, "old"), (2, "b", 5, "old"), (3, "c", 5, "old"), (None, "n", 1, "old")], schema)
    s = spark.createDataFrame([(1, "x", 6, "new"), (2, "y", 5, "new"), (3, "c", 9, "new"), (4, "z", None, "new"), (None, "m", 9, "new")], schema)
    got = sorted(((r.k, r.v, r.created_at, r._change) for r in current.upsert(t, s, ["k"], ["seq"]).collect()), key=str)
    assert (1, "x", "old", "update") in got and (2, "b", "old", "none") in got and (4, "z", "new", "insert") in got
    assert (3, "c", "old", "update") in got  # its sequence differs
    assert (None, "n", "old", "none") in got and (None, "m", "new", "insert") in got
    with pytest.raises(ValueError):
        current.upsert(t, s.drop("v"), ["k"])
    gone = current.upsert(t, s, ["k"], ["seq"], drop_missing=True, delete_keys=spark.createDataFrame([(2,)], "k int"))
    assert {r.k for r in current.merged(gone).collect()} >= {1, 3, 4}


HISTORY = "user_id int, a string, last_login string, _operation string, t timestamp_ntz, id string"


def history(spark, rows):
    return spark.createDataFrame([(1, a, login, op, at(h), str(n)) for n, (a, login, op, h) in enumerate(rows)], HISTORY).withColumn("attribute_hash", F.sha2("a", 256))


def replayed(df):
    v = scd2.replay(df, "user_id", "t", ["t", "id"], "attribute_hash", type1=["last_login"], carried=["a"], event_id="id")
    return [(r.a, r.last_login, r.effective_from, r.effective_to, r.is_current, r.is_deleted) for r in v.orderBy("effective_from").collect()]


END = dt.datetime(9999, 12, 31)


@pytest.mark.parametrize(
    ("events", "expected"),
    [
        ([("x", None, "INSERT", 0)], [("x", None, at(0), END, True, False)]),
        ([("x", None, "INSERT", 0), ("y", None, "UPDATE", 1)], [("x", None, at(0), at(1), False, False), ("y", None, at(1), END, True, False)]),
        ([("x", None, "INSERT", 0), ("x", None, "DELETE", 2)], [("x", None, at(0), at(2), False, True)]),
        ([("x", None, "INSERT", 0), ("x", "l", "UPDATE", 1)], [("x", "l", at(0), END, True, False)]),
        ([("x", None, "INSERT", 0), ("x", None, "DELETE", 1), ("x", None, "DELETE", 2), ("x", None, "INSERT", 3)], [("x", None, at(0), at(1), False, True), ("x", None, at(3), END, True, False)]),
        ([("x", None, "DELETE", 0)], []),
    ],
)
def test_replay(spark, events, expected):
    assert replayed(history(spark, events)) == expected
    assert replayed(history(spark, events).union(history(spark, events))) == expected


def test_lookup_falls_back_to_the_first_version(spark):
    d = spark.createDataFrame([(7, 100, at(0), at(5)), (7, 200, at(5), END)], "m int, key bigint, effective_from timestamp_ntz, effective_to timestamp_ntz")
    f = spark.createDataFrame([(1, 7, at(-9)), (2, 7, at(0)), (3, 7, at(5)), (4, 8, at(1))], "id int, m_id int, at timestamp_ntz")
    got = {r.id: r.found for r in scd2.lookup(f, d, F.col("m_id"), F.col("at"), "key", "found", "m").collect()}
    assert got == {1: 100, 2: 100, 3: 200, 4: 0}


def test_snapshot_difference_and_apply(spark):
    schema = "id int, h string, v int, effective_from timestamp_ntz"
    dim = spark.createDataFrame([(1, "a", 1, at(0)), (2, "b", 1, at(0)), (4, "d", 1, at(0))], schema).withColumns({"effective_to": F.lit(END).cast("timestamp_ntz"), "is_current": F.lit(True)})
    src = spark.createDataFrame([(1, "A", 1, at(9)), (2, "b", 2, at(9)), (3, "c", 1, at(9)), (4, "d", 1, at(9))], schema)
    staged = scd2.difference(src, dim.where("is_current"), "id", "h", ["v"])
    assert sorted((r.id, r.action) for r in staged.collect()) == [(1, "CLOSE"), (1, "INSERT"), (2, "TYPE1"), (3, "INSERT")]
    after = {(r.id, r.h): (r.v, r.is_current, r.effective_to) for r in scd2.apply(dim, staged, "id", ["v"]).collect()}
    assert after == {(1, "a"): (1, False, at(9)), (1, "A"): (1, True, END), (2, "b"): (2, True, END), (3, "c"): (1, True, END), (4, "d"): (1, True, END)}


def test_columns(spark):
    r = spark.createDataFrame([("+84 901 112", "  ", None)], "p string, b string, n string").select(
        c.phone(F.col("p")).alias("p"), c.trimmed(F.col("b")).alias("b"), c.phone(F.col("n")).alias("n"), c.natural_hash(F.col("n"), F.lit("x")).alias("h1"), c.natural_hash(F.lit(""), F.lit("x")).alias("h2"),
        c.time_key(F.lit("2026-01-01 00:00:00").cast("timestamp")).alias("t1"), c.time_key(F.lit("2026-01-01 23:59:59").cast("timestamp")).alias("t2"),
    ).first()
    assert (r.p, r.b, r.n, r.t1, r.t2) == ("+84901112", None, None, 1, 86400) and r.h1 == r.h2
    assert c.type_of("public_user_id") is None and c.type_of("order_id") == "int" and c.type_of("is_x") == "boolean" and c.type_of("unit_price") == "decimal(12,2)"


def test_contracts_cover_the_same_tables():
    assert len(SOURCES) == 12 and all(s.key == s.columns[0] and not set(s.excluded) & set(s.columns) for s in SOURCES.values())
    assert set(affected.targets(SOURCES)) == set(GOLD) and affected.targets(["orders"])[-1] == "fact_sales" and affected.targets(["shops"]) == ("dim_shop",)


def sales_inputs(spark):
    m, place = D("0.00"), '{"street":"s","city":"c"}'
    t = {
        "orders": spark.createDataFrame([(1, 5, "N1", "paid", place, None, D(400), D(30), D(32), D(50), at(1))], "order_id int, customer_id int, order_number string, order_status string, shipping_address_snapshot string, billing_address_snapshot string, subtotal_amount decimal(18,2), shipping_amount decimal(18,2), tax_amount decimal(18,2), discount_amount decimal(18,2), created_at timestamp_ntz"),
        "order_items": spark.createDataFrame([(11, 1, 3, 21, "VND", 1, D(100), D(8), D(10)), (12, 1, 3, 21, "VND", 1, D(300), D(24), m)], "order_item_id int, order_id int, shop_id int, product_variant_id int, currency string, quantity int, unit_price decimal(18,2), tax_amount decimal(18,2), discount_amount decimal(18,2)"),
        "payments": spark.createDataFrame([(1, 1, "card", "pending", at(1)), (2, 1, "card", "paid", at(2))], "payment_id int, order_id int, payment_method string, payment_status string, updated_at timestamp_ntz"),
        "shipments": spark.createDataFrame([], "shipment_id int, order_id int, carrier string, shipment_status string, updated_at timestamp_ntz"),
        "order_vouchers": spark.createDataFrame([(1, 1, 9)], "order_voucher_id int, order_id int, voucher_id int"),
        "vouchers": spark.createDataFrame([(9, "V", "v", "fixed", "{}", at(0), at(9), D(1), True)], "voucher_id int, voucher_code string, voucher_name string, discount_type string, scope_json string, starts_at timestamp_ntz, ends_at timestamp_ntz, minimum_order_amount decimal(18,2), is_active boolean"),
    }
    span = [(at(-5), at(0)), (at(0), END)]
    dim = lambda cols, ids, keys: spark.createDataFrame([(*ids, k, *s) for k, s in zip(keys, span, strict=True)], cols + ", effective_from timestamp_ntz, effective_to timestamp_ntz")
    d = {
        "dim_customer": dim("source_customer_id int, customer_key bigint", [5], [1, 2]), "dim_product": dim("source_product_variant_id int, source_category_id int, product_key bigint", [21, 4], [3, 4]),
        "dim_shop": dim("source_shop_id int, shop_key bigint", [3], [5, 6]), "dim_category": dim("source_category_id int, category_key bigint", [4], [7, 8]),
    }
    return t, d


def test_sales_fact(spark):
    t, d = sales_inputs(spark)
    got = fact.sales(t, d).orderBy("source_order_item_id").collect()
    assert [r.order_discount_amount_allocated for r in got] == [D("10.00"), D("30.00")] and sum(r.net_sales_amount for r in got) == D("412.00")
    r = got[0]
    assert (r.customer_key, r.product_key, r.shop_key, r.category_key) == (2, 4, 6, 8)
    assert r.ship_to_location_key > 0 and r.bill_to_location_key == 0 and r.promotion_key > 0 and r.payment_key > 0 and r.shipping_key == 0
    again = dimensions.payments(t["payments"]).where("payment_status = 'paid'").first()
    assert again.payment_key == r.payment_key and again.paid_flag
    assert dimensions.locations(t["orders"].select(*[F.lit(None).cast("string").alias(a) for a in dimensions.ADDRESS]).limit(0), t["orders"]).first().location_key == r.ship_to_location_key
    m = quality.metrics(fact.sales(t, d)).first()
    assert (m.n_rows, m.n_keys, m.n_invalid, m.n_unresolved) == (2, 2, 0, 2)


def test_product_and_category_versions(spark):
    cat = spark.createDataFrame([(1, None, "A", "a", True, at(0), at(9)), (2, 1, "B", "b", True, at(0), at(1))], "category_id int, parent_category_id int, category_name string, slug string, is_active boolean, created_at timestamp_ntz, updated_at timestamp_ntz")
    got = {r.category_id: (r.parent_category_name, r.effective_from) for r in dimensions.categories(cat).collect()}
    assert got == {1: (None, at(9)), 2: ("A", at(9))}


def test_affected_orders_through_vouchers(spark):
    ov = spark.createDataFrame([(1, 9), (2, 8)], "order_id int, voucher_id int")
    got = affected.orders({"vouchers": spark.createDataFrame([(9,)], "voucher_id int"), "payments": spark.createDataFrame([(7,), (None,)], "order_id int")}, ov)
    assert sorted(r.order_id for r in got.collect()) == [1, 7]


def test_incomplete_orders_ignore_deleted(spark):
    o = spark.createDataFrame([(1, D(10), D(1), False), (2, D(10), D(1), False), (3, D(10), D(1), True)], "order_id int, subtotal_amount decimal(18,2), tax_amount decimal(18,2), _is_deleted boolean")
    i = spark.createDataFrame([(1, 2, D(5), D(1))], "order_id int, quantity int, unit_price decimal(18,2), tax_amount decimal(18,2)")
    assert [r.order_id for r in quality.incomplete_orders(o, i).collect()] == [2]
