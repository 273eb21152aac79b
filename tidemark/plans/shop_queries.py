"""The test tables read as a shop's tables: the star schema's operators, each with the SQL that gives the same rows."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.contracts import ADDRESS, SOURCES, TYPE2
from tidemark.functions import columns as c
from tidemark.operators import affected, dimensions, fact, quality, scd2
from tidemark.plans import bronze, gold, queries, silver
from tidemark.plans.queries import MONEY, query, read, scratch
from tidemark.sources import catalog, outbox
from tidemark.sources.store import Table
from tidemark.streaming import cdc, stream

Tables = dict[str, DataFrame]


def _day(start: str, days: Column) -> Column:
    return F.to_timestamp_ntz(F.lit(start)) + F.make_dt_interval(days.cast("int"))


def shop_tables(spark: SparkSession, d: str) -> Tables:
    """Orders, lines, payments (a third of the orders has two), shipments (of every other order), vouchers and their uses."""
    o, line = read(spark, d, "orders"), queries._lines(spark, d)
    key, money = F.col("o_orderkey"), (lambda x: F.lit(x).cast(MONEY))
    place = F.to_json(F.struct(F.col("o_orderpriority").alias("street"), F.concat(F.lit("c"), F.col("o_custkey") % 50).alias("city")))
    orders = o.select(
        key.alias("order_id"), F.col("o_custkey").alias("customer_id"), F.concat(F.lit("N"), key).alias("order_number"), F.col("o_orderstatus").alias("order_status"),
        F.when(key % 5 != 0, place).alias("shipping_address_snapshot"), F.lit(None).cast("string").alias("billing_address_snapshot"), money("30").alias("shipping_amount"),
        (F.col("o_totalprice").cast(MONEY) * F.lit("0.05").cast("decimal(4,2)")).cast(MONEY).alias("discount_amount"), (F.col("o_orderdate") + F.make_dt_interval(secs=(key % 86400).cast("decimal(18,6)"))).alias("created_at"),
    )
    items = line.select(
        F.col("l_orderkey").alias("order_id"), (F.col("l_orderkey") * 100 + F.col("line_id")).alias("order_item_id"), F.col("l_suppkey").alias("shop_id"), F.col("l_partkey").alias("product_variant_id"),
        F.lit("VND").alias("currency"), F.col("l_quantity").cast("int").alias("quantity"), F.col("gross").alias("unit_price"), (F.col("l_tax") * 100).cast(MONEY).alias("tax_amount"), (F.col("l_discount") * 100).cast(MONEY).alias("discount_amount"),
    )
    paid = o.select(key.alias("payment_id"), key.alias("order_id"), F.col("o_orderpriority").alias("payment_method"), F.when(F.col("o_orderstatus") == "F", "paid").otherwise("pending").alias("payment_status"), F.col("o_orderdate").alias("updated_at"))
    again = o.where(key % 3 == 0).select((key + 10_000_000).alias("payment_id"), key.alias("order_id"), F.lit("card").alias("payment_method"), F.lit("paid").alias("payment_status"), (F.col("o_orderdate") + F.expr("INTERVAL 1 DAY")).alias("updated_at"))
    shipments = o.where(key % 2 == 0).select(key.alias("shipment_id"), key.alias("order_id"), F.col("o_orderpriority").alias("carrier"), F.when(key % 4 == 0, "delivered").otherwise("pending").alias("shipment_status"), F.col("o_orderdate").alias("updated_at"))
    uses = o.where(key % 4 == 0).select(key.alias("order_id"), F.explode(F.array(F.col("o_custkey") % 20, F.col("o_custkey") % 20 + 1)).alias("voucher_id"))
    i = F.col("id")
    vouchers = spark.range(21).select(
        i.alias("voucher_id"), F.concat(F.lit("V"), i).alias("voucher_code"), F.concat(F.lit("name "), i).alias("voucher_name"), F.when(i % 2 == 0, "fixed").otherwise("percent").alias("discount_type"), F.lit("{}").alias("scope_json"),
        _day("2024-01-01", i).alias("starts_at"), _day("2025-01-01", i).alias("ends_at"), i.cast(MONEY).alias("minimum_order_amount"), (i > 10).alias("is_active"),
    )
    return {"orders": orders, "order_items": items, "payments": paid.unionByName(again), "shipments": shipments, "order_vouchers": uses, "vouchers": vouchers}


def shop_dimensions(spark: SparkSession, d: str) -> Tables:
    """Two versions of every customer (but every tenth), shop and category; of a product the second may be of another category. Keys are 2 * id + version."""
    turn = {"dim_customer": "1997-01-01", "dim_shop": "1998-06-01", "dim_product": "1996-03-01", "dim_category": "1999-01-01"}

    def versions(df: DataFrame, dimension: str, key: str, *columns: Column) -> DataFrame:
        middle, end = F.to_timestamp_ntz(F.lit(turn[dimension])), F.to_timestamp_ntz(F.lit(c.OPEN_END))
        both = df.withColumn("v", F.explode(F.array(F.lit(1), F.lit(2))))
        span = [F.when(F.col("v") == 1, F.to_timestamp_ntz(F.lit("1996-01-01"))).otherwise(middle).alias("effective_from"), F.when(F.col("v") == 1, middle).otherwise(end).alias("effective_to")]
        return both.select(*columns, (F.col("id") * 2 + F.col("v")).alias(key), *span)

    part = read(spark, d, "part").select(F.col("p_partkey").alias("id"), "p_size")
    category = F.when(F.col("v") == 1, F.col("p_size") % 7).otherwise(F.col("p_size") % 5)
    return {
        "dim_customer": versions(read(spark, d, "customer").select(F.col("c_custkey").alias("id")).where("id % 10 <> 0"), "dim_customer", "customer_key", F.col("id").alias("source_customer_id")),
        "dim_shop": versions(read(spark, d, "supplier").select(F.col("s_suppkey").alias("id")), "dim_shop", "shop_key", F.col("id").alias("source_shop_id")),
        "dim_product": versions(part, "dim_product", "product_key", F.col("id").alias("source_product_variant_id"), category.alias("source_category_id")),
        "dim_category": versions(spark.range(6), "dim_category", "category_key", F.col("id").cast("int").alias("source_category_id")),
    }


def _version_sql(on: str, turn: str, at: str, known: str) -> str:
    """2 * id + version as of a time; 0 where the member isn't known or there is no time."""
    return f"CASE WHEN ({known}) AND {at} IS NOT NULL THEN 2 * {on} + CASE WHEN {at} >= TIMESTAMP '{turn}' THEN 2 ELSE 1 END ELSE 0 END"


@query(f"""WITH {queries._LINES_SQL},
x AS (SELECT l.*, od.o_custkey, od.o_orderstatus, od.o_orderpriority, od.o_orderkey, od.o_orderdate + to_seconds(od.o_orderkey % 86400) AS moment, coalesce(CAST(CAST(od.o_totalprice AS DECIMAL(18,2)) * 0.05 AS DECIMAL(18,2)), 0) AS header, CASE WHEN od.o_orderkey IS NULL THEN 0 ELSE 30 END AS ship,
 CAST(CAST(l_quantity AS INTEGER) * gross AS DECIMAL(18,2)) AS amount, CAST(l_discount * 100 AS DECIMAL(18,2)) AS own, CAST(l_tax * 100 AS DECIMAL(18,2)) AS tax, p_size, s_suppkey, p_partkey, c_custkey
 FROM lines l LEFT JOIN orders od ON l_orderkey = o_orderkey LEFT JOIN part ON l_partkey = p_partkey LEFT JOIN supplier ON l_suppkey = s_suppkey LEFT JOIN customer ON o_custkey = c_custkey),
b AS (SELECT *, sum(own) OVER w AS all_own, CAST(greatest(header - sum(own) OVER w, 0) AS DECIMAL(18,2)) AS beyond, sum(amount) OVER w AS g FROM x WINDOW w AS (PARTITION BY l_orderkey)),
r AS (SELECT *, {queries._share_sql('beyond', 'amount', 'g')} AS r1, {queries._share_sql('header', 'amount', 'g')} AS r2, {queries._share_sql('CAST(ship AS DECIMAL(18,2))', 'amount', 'g')} AS r3 FROM b),
m AS (SELECT *, CASE WHEN line_id = max(line_id) OVER w THEN beyond - (sum(r1) OVER w - r1) ELSE r1 END AS e1, CASE WHEN line_id = max(line_id) OVER w THEN header - (sum(r2) OVER w - r2) ELSE r2 END AS e2, CASE WHEN line_id = max(line_id) OVER w THEN ship - (sum(r3) OVER w - r3) ELSE r3 END AS e3 FROM r WINDOW w AS (PARTITION BY l_orderkey)),
y AS (SELECT *, CASE WHEN all_own <= header THEN own + e1 ELSE e2 END AS total_discount, CASE WHEN p_partkey IS NULL THEN NULL WHEN moment IS NOT NULL AND moment >= TIMESTAMP '1996-03-01' THEN p_size % 5 ELSE p_size % 7 END AS category FROM m)
SELECT l_orderkey AS order_id, l_orderkey * 100 + line_id AS item_id, CASE WHEN o_orderkey IS NULL THEN NULL ELSE concat('N', o_orderkey) END AS order_number, o_orderstatus AS order_status, coalesce(CAST(strftime(moment, '%Y%m%d') AS INTEGER), 0) AS date_key,
 coalesce(CAST(hour(moment) * 3600 + minute(moment) * 60 + second(moment) + 1 AS INTEGER), 0) AS time_key, CAST({_version_sql('c_custkey', '1997-01-01', 'moment', 'c_custkey % 10 <> 0')} AS BIGINT) AS customer_key, CAST({_version_sql('p_partkey', '1996-03-01', 'moment', 'p_partkey IS NOT NULL')} AS BIGINT) AS product_key,
 CAST({_version_sql('s_suppkey', '1998-06-01', 'moment', 's_suppkey IS NOT NULL')} AS BIGINT) AS shop_key, CAST({_version_sql('category', '1999-01-01', 'moment', 'category < 6')} AS BIGINT) AS category_key, CASE WHEN o_orderkey % 5 <> 0 THEN concat('c', o_custkey % 50) END AS city,
 CASE WHEN o_orderkey % 4 = 0 THEN array_to_string(list_sort([concat('V', o_custkey % 20), concat('V', o_custkey % 20 + 1)]), ',') END AS voucher_codes, CASE WHEN o_orderkey % 3 = 0 THEN 'card' ELSE o_orderpriority END AS payment_method, CASE WHEN o_orderkey % 3 = 0 OR o_orderstatus = 'F' THEN 'paid' WHEN o_orderkey IS NOT NULL THEN 'pending' END AS payment_status,
 CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority END AS carrier, CASE WHEN o_orderkey % 4 = 0 THEN true WHEN o_orderkey % 2 = 0 THEN false END AS delivered, amount AS gross, CAST(total_discount AS DECIMAL(18,2)) AS discount, CAST(e3 AS DECIMAL(18,2)) AS shipping, CAST(amount + tax + e3 - total_discount AS DECIMAL(18,2)) AS net FROM y""")
def fact_sales(spark: SparkSession, d: str) -> DataFrame:
    """The whole sales fact, its content keys resolved through the dimensions that they point to."""
    t = shop_tables(spark, d)
    f = fact.sales(t, shop_dimensions(spark, d))
    nowhere = t["orders"].select(*[F.lit(None).cast("string").alias(a) for a in ADDRESS]).limit(0)
    places = dimensions.locations(nowhere, t["orders"]).select(F.col("location_key").alias("ship_to_location_key"), "city")
    codes = gold.promotion_members(t["order_vouchers"], t["vouchers"]).select("promotion_key", "voucher_codes")
    pay = dimensions.payments(t["payments"]).select("payment_key", "payment_method", "payment_status")
    ship = dimensions.shipping(t["shipments"]).select("shipping_key", "carrier", F.col("delivered_flag").alias("delivered"))
    f = f.join(places, "ship_to_location_key", "left").join(codes, "promotion_key", "left").join(pay, "payment_key", "left").join(ship, "shipping_key", "left")
    return f.select(
        F.col("source_order_id").alias("order_id"), F.col("source_order_item_id").alias("item_id"), "order_number", "order_status", F.col("order_date_key").alias("date_key"), F.col("order_time_key").alias("time_key"), "customer_key", "product_key", "shop_key", "category_key",
        "city", "voucher_codes", "payment_method", "payment_status", "carrier", "delivered", F.col("gross_sales_amount").alias("gross"), F.col("total_discount_amount").alias("discount"), F.col("shipping_amount_allocated").alias("shipping"), F.col("net_sales_amount").alias("net"),
    )


def _text(df: DataFrame, names: tuple[str, ...]) -> DataFrame:
    """df with the columns that a contract names and df lacks, as null text."""
    return df.withColumns({n: F.lit(None).cast("string") for n in names if n not in df.columns})


@query("""SELECT p_partkey AS id, p_name AS product_name, CASE WHEN p_partkey % 50 = 0 THEN NULL ELSE p_brand END AS brand, greatest(TIMESTAMP '2024-01-01' + to_days(p_size), CASE WHEN p_partkey % 50 = 0 THEN NULL ELSE TIMESTAMP '2024-01-20' END) AS effective_from,
 sha256(concat_ws('||', p_partkey, CASE WHEN p_partkey % 50 = 0 THEN '' ELSE CAST(p_partkey % 9 AS VARCHAR) END, CASE WHEN p_partkey % 50 = 0 THEN '' ELSE CAST(p_size AS VARCHAR) END, '', '', '', '', CASE WHEN p_partkey % 50 = 0 THEN '' ELSE p_name END, CASE WHEN p_partkey % 50 = 0 THEN '' ELSE p_brand END, '', CASE WHEN p_partkey % 50 = 0 THEN '' ELSE 'true' END, '', p_type, 'active', '', '', '', '', '', '', '')) AS attribute_hash
 FROM part""".replace("p_name AS product_name", "CASE WHEN p_partkey % 50 = 0 THEN NULL ELSE p_name END AS product_name"))
def dim_product(spark: SparkSession, d: str) -> DataFrame:
    """Variants with their products (one in fifty has lost its own), the hash of their attributes and when they last changed."""
    p = read(spark, d, "part")
    product = p.where("p_partkey % 50 <> 0").select(F.col("p_partkey").alias("product_id"), (F.col("p_partkey") % 9).alias("shop_id"), F.col("p_size").alias("category_id"), F.col("p_name").alias("product_name"), F.col("p_brand").alias("brand"), F.lit(True).alias("is_featured"), _day("2024-01-20", F.lit(0)).alias("updated_at"), _day("2023-01-01", F.lit(0)).alias("created_at"))
    variant = p.select(F.col("p_partkey").alias("product_variant_id"), F.col("p_partkey").alias("product_id"), F.col("p_type").alias("variant_name"), F.lit("active").alias("status"), F.lit(None).cast("timestamp_ntz").alias("updated_at"), _day("2024-01-01", F.col("p_size")).alias("created_at"))
    own = ("public_product_id", "product_sku", "product_slug", "attributes_json", "status", "images_json")
    got = dimensions.products(_text(variant, ("public_variant_id", "variant_sku", "options_json", "is_default", "currency", "weight_kg", "images_json")), _text(product, own))
    return got.select(F.col("product_variant_id").alias("id"), "product_name", "brand", "effective_from", "attribute_hash")


@query("""SELECT s_suppkey AS id, sha256(concat_ws('||', '', s_name, '', CASE WHEN s_acctbal < 0 THEN 'closed' ELSE 'open' END)) AS attribute_hash, TIMESTAMP '2024-01-01' + to_days(s_nationkey) AS effective_from FROM supplier""")
def dim_shop(spark: SparkSession, d: str) -> DataFrame:
    s = read(spark, d, "supplier").select(F.col("s_suppkey").alias("shop_id"), F.col("s_name").alias("shop_name"), F.when(F.col("s_acctbal") < 0, "closed").otherwise("open").alias("status"), F.lit(None).cast("timestamp_ntz").alias("updated_at"), _day("2024-01-01", F.col("s_nationkey")).alias("created_at"))
    return dimensions.shops(_text(s, TYPE2["dim_shop"])).select(F.col("shop_id").alias("id"), "attribute_hash", "effective_from")


def _customer_history(spark: SparkSession, d: str) -> DataFrame:
    """A customer's events: the balance's sign is the status, and events of its id change it; an error deletes."""
    e = read(spark, d, "events").join(read(spark, d, "customer").select(F.col("c_custkey").alias("user_id"), "c_name"), "user_id")
    ts = F.col("ts")
    rows = e.select(
        F.col("user_id"), F.col("c_name").alias("username"), F.col("c_name").alias("first_name"), F.lit("X").alias("last_name"), F.col("event_type").alias("status"), ts.alias("_event_occurred_at"), ts.alias("updated_at"), _day("2020-01-01", F.lit(0)).alias("created_at"), ts.alias("last_login"),
        F.when(F.col("event_type") == "error", "delete").otherwise("update").alias("_operation"), F.lit(1).alias("_ingestion_priority"), F.col("event_id").alias("_source_event_sequence"), F.lit(0).alias("_source_event_subsequence"), F.col("event_id").cast("string").alias("_history_event_id"),
    )
    return _text(rows, ("public_user_id", *TYPE2["dim_customer"]))


@query("""WITH ev AS (SELECT user_id, event_id, ts, event_type, CASE WHEN event_type = 'error' THEN 'DELETE' ELSE 'UPDATE' END AS op, c_name FROM events JOIN customer ON user_id = c_custkey),
f AS (SELECT *, last_value(CASE WHEN op <> 'DELETE' THEN event_type END IGNORE NULLS) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS known, lag(op) OVER w AS was FROM ev WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
g AS (SELECT *, op <> 'DELETE' AND (known IS NULL OR known <> event_type OR coalesce(was = 'DELETE', false)) AS starts FROM f),
h AS (SELECT *, sum(CASE WHEN starts THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS version FROM g),
b AS (SELECT *, lead(ts) OVER w AS nxt, lead(op) OVER w AS nop FROM h WHERE starts OR op = 'DELETE' WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
l AS (SELECT user_id, version, arg_max(ts, (ts, event_id)) AS last_login FROM h WHERE op <> 'DELETE' AND version > 0 GROUP BY ALL)
SELECT b.user_id, CAST(b.version AS INTEGER) AS version, c_name AS username, concat(c_name, ' X') AS full_name, event_type AS status, l.last_login, CASE WHEN b.version = 1 THEN TIMESTAMP '2020-01-01' ELSE b.ts END AS effective_from, coalesce(nxt, TIMESTAMP '9999-12-31') AS effective_to, nxt IS NULL AS is_current, coalesce(nop = 'DELETE', false) AS is_deleted,
 sha256(concat_ws('||', c_name, '', c_name, 'X', '', event_type)) AS attribute_hash FROM b JOIN l ON b.user_id = l.user_id AND b.version = l.version WHERE starts""")
def dim_customer(spark: SparkSession, d: str) -> DataFrame:
    """Versions of customers replayed from their history; the first starts at their registration."""
    got = gold.customer_versions(_customer_history(spark, d))
    return got.select(F.col("source_customer_id").alias("user_id"), "version", "username", "full_name", "status", "last_login", "effective_from", "effective_to", "is_current", "is_deleted", "attribute_hash")


@query("""WITH s AS (SELECT c_custkey, CASE WHEN c_custkey % 7 = 0 THEN 'MOVED' ELSE c_mktsegment END AS seg, CASE WHEN c_custkey % 5 = 0 THEN 0 ELSE c_acctbal END AS bal FROM customer),
t AS (SELECT c_custkey, c_mktsegment AS seg, c_acctbal AS bal FROM customer WHERE c_custkey % 11 <> 0)
SELECT t.c_custkey, t.seg, CAST(CASE WHEN s.seg = t.seg THEN s.bal ELSE t.bal END AS DOUBLE) AS bal, TIMESTAMP '2024-01-01' AS effective_from, CASE WHEN s.seg = t.seg THEN TIMESTAMP '9999-12-31' ELSE TIMESTAMP '2024-06-01' END AS effective_to, s.seg = t.seg AS is_current FROM t JOIN s USING (c_custkey)
UNION ALL SELECT s.c_custkey, s.seg, CAST(s.bal AS DOUBLE), TIMESTAMP '2024-06-01', TIMESTAMP '9999-12-31', true FROM s LEFT JOIN t USING (c_custkey) WHERE t.c_custkey IS NULL OR s.seg <> t.seg""")
def scd2_apply(spark: SparkSession, d: str) -> DataFrame:
    """A dimension after a snapshot: members that are new, closed and started again, or overwritten."""
    cust, end = read(spark, d, "customer"), F.to_timestamp_ntz(F.lit(c.OPEN_END))
    k = F.col("c_custkey")
    source = cust.select("c_custkey", F.when(k % 7 == 0, "MOVED").otherwise(F.col("c_mktsegment")).alias("seg"), F.when(k % 5 == 0, 0.0).otherwise(F.col("c_acctbal")).alias("bal"), _day("2024-06-01", F.lit(0)).alias("effective_from"))
    now = cust.where("c_custkey % 11 <> 0").select("c_custkey", F.col("c_mktsegment").alias("seg"), F.col("c_acctbal").alias("bal"), _day("2024-01-01", F.lit(0)).alias("effective_from"), end.alias("effective_to"), F.lit(True).alias("is_current"))
    return scd2.apply(now, scd2.difference(source, now, "c_custkey", "seg", ["bal"]), "c_custkey", ["bal"])


@query("""WITH a AS (SELECT c_mktsegment AS street, concat('n', c_nationkey) AS city FROM customer UNION ALL SELECT o_orderpriority, concat('c', o_custkey % 50) FROM orders WHERE o_orderkey % 5 <> 0)
SELECT DISTINCT street, city, sha256(concat_ws('||', '', '', '', street, '', '', city, '', '', '')) AS content_hash FROM a""")
def dim_location(spark: SparkSession, d: str) -> DataFrame:
    """Distinct addresses of the address book and of the orders' JSON."""
    book = _text(read(spark, d, "customer").select(F.col("c_mktsegment").alias("street"), F.concat(F.lit("n"), "c_nationkey").alias("city")), ADDRESS)
    return dimensions.locations(book, shop_tables(spark, d)["orders"]).select("street", "city", "content_hash")


@query("""SELECT 'payment' AS dimension, concat(o_orderpriority, '/', CASE WHEN o_orderstatus = 'F' THEN 'paid' ELSE 'pending' END) AS member, o_orderstatus = 'F' AS flag FROM orders UNION SELECT 'payment', 'card/paid', true FROM orders WHERE o_orderkey % 3 = 0
UNION SELECT 'shipping', concat(o_orderpriority, '/', CASE WHEN o_orderkey % 4 = 0 THEN 'delivered' ELSE 'pending' END), o_orderkey % 4 = 0 FROM orders WHERE o_orderkey % 2 = 0 UNION SELECT 'payment', 'unknown/unknown', false UNION SELECT 'shipping', 'unknown/unknown', false""")
def dim_payment_and_shipping(spark: SparkSession, d: str) -> DataFrame:
    """Methods and carriers with their status, and their unknown members."""
    t = shop_tables(spark, d)
    pay = dimensions.with_unknown(dimensions.payments(t["payments"]), "payment_key", "dim_payment").select(F.lit("payment").alias("dimension"), F.concat_ws("/", "payment_method", "payment_status").alias("member"), F.col("paid_flag").alias("flag"))
    ship = dimensions.with_unknown(dimensions.shipping(t["shipments"]), "shipping_key", "dim_shipping").select(F.lit("shipping").alias("dimension"), F.concat_ws("/", "carrier", "shipment_status").alias("member"), F.col("delivered_flag").alias("flag"))
    return pay.unionByName(ship)


@query("""SELECT o_orderkey AS order_id FROM orders WHERE o_orderkey % 4 = 0 AND (o_custkey % 20 IN (3, 8) OR o_custkey % 20 + 1 IN (3, 8)) UNION SELECT o_orderkey FROM orders WHERE o_orderkey % 97 = 0 UNION SELECT l_orderkey FROM lineitem WHERE l_partkey % 500 = 0""")
def affected_orders_of_changes(spark: SparkSession, d: str) -> DataFrame:
    """Orders that changes of vouchers, payments and lines touch."""
    t = shop_tables(spark, d)
    return affected.orders({"vouchers": t["vouchers"].where("voucher_id in (3, 8)"), "payments": t["payments"].where("order_id % 97 = 0"), "order_items": t["order_items"].where("product_variant_id % 500 = 0")}, t["order_vouchers"])


@query("""SELECT 'category' AS kind, CAST(n_nationkey AS BIGINT) AS id FROM nation WHERE n_nationkey IN (1, 2) OR (n_nationkey >= 5 AND n_nationkey % 5 IN (1, 2)) UNION SELECT 'product', p_partkey FROM part WHERE p_size = 7 OR p_size = 9""")
def affected_members(spark: SparkSession, d: str) -> DataFrame:
    """Changed categories with their children, and products changed by themselves or by a variant."""
    n = read(spark, d, "nation").select(F.col("n_nationkey").alias("category_id"), F.when(F.col("n_nationkey") >= 5, F.col("n_nationkey") % 5).alias("parent_category_id"))
    p = read(spark, d, "part").select(F.col("p_partkey").alias("product_id"), "p_size")
    categories = affected.categories(n.where("category_id in (1, 2)"), n).select(F.lit("category").alias("kind"), F.col("category_id").cast("bigint").alias("id"))
    products = affected.products({"products": p.where("p_size = 7"), "product_variants": p.where("p_size = 9")}).select(F.lit("product").alias("kind"), F.col("product_id").alias("id"))
    return categories.unionByName(products)


_TABLES = {
    "orders": {"o_orderkey": "int", "o_custkey": "int", "o_orderstatus": "string", "o_totalprice": "decimal(12,2)", "o_orderdate": "timestamp", "o_orderpriority": "string", "paid": "boolean", "weight": "decimal(8,3)", "note": "string", "changed": "timestamp"},
    "customer": {"c_custkey": "int", "c_name": "string", "c_nationkey": "int", "c_acctbal": "decimal(12,2)", "c_mktsegment": "string", "active": "boolean", "weight": "decimal(8,3)", "note": "string", "seen": "timestamp", "changed": "timestamp"},
    "part": {"p_partkey": "int", "p_name": "string", "p_brand": "string", "p_type": "string", "p_size": "int", "p_retailprice": "decimal(12,2)", "active": "boolean", "weight": "decimal(8,3)", "note": "string", "changed": "timestamp"},
}
_TABLE_KEYS = {"orders": ["o_orderkey"], "customer": ["c_custkey"], "part": ["p_partkey"]}


def _many_envelopes(spark: SparkSession, d: str) -> DataFrame:
    """Rows of three tables of ten columns as one topic's records; some lack their key, some have a flag that is none, some come from a table that no one knows."""
    records = []
    for table, schema in _TABLES.items():
        key = F.col(_TABLE_KEYS[table][0])
        df = read(spark, d, table)
        micros = F.lit(1_700_000_000_000_000) + key * 1_000_000
        more = {"paid": F.when(key % 19 == 0, "maybe").otherwise((key % 2 == 0).cast("string")), "active": (key % 2 == 0), "weight": (key % 1000).cast("decimal(8,3)"), "note": F.when(key % 3 == 0, F.concat(F.lit("n\"é "), key)), "changed": micros, "seen": F.lit("2024-05-06 07:08:09")}
        df = df.withColumns({n: v for n, v in more.items() if n in schema})
        if "o_orderdate" in schema:
            df = df.withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))
        row = F.struct(*[F.when((key % 23 == 0) & F.lit(n == key._jc.toString()), F.lit(None)).otherwise(F.col(n)).alias(n) for n in schema])
        name = F.when(key % 29 == 0, "elsewhere").otherwise(table)
        envelope = F.to_json(F.struct(row.alias("after"), F.struct(F.lit("public").alias("schema"), name.alias("table"), key.alias("lsn")).alias("source"), F.lit("c").alias("op"), (F.lit(1_700_000_000_000) + key).alias("ts_ms")))
        records.append(df.select(F.lit(None).cast("binary").alias("key"), envelope.cast("binary").alias("value"), F.lit(table).alias("topic"), F.lit(0).alias("partition"), key.alias("offset"), F.lit(None).cast("timestamp").alias("timestamp")))
    return records[0].unionByName(records[1]).unionByName(records[2])


def _common(table: str, df: DataFrame) -> DataFrame:
    """Typed rows of any of the tables in one form."""
    first, flag, money, text = {"orders": ("o_orderkey", "paid", "o_totalprice", "o_orderpriority"), "customer": ("c_custkey", "active", "c_acctbal", "c_mktsegment"), "part": ("p_partkey", "active", "p_retailprice", "p_type")}[table]
    return df.select(F.lit(table).alias("tbl"), F.col(first).alias("id"), F.col(flag).alias("flag"), F.col(money).alias("money"), F.col(text).alias("text"), F.col("weight"), "note", F.col("changed").cast("timestamp_ntz").alias("changed"), F.col("_event_occurred_at").cast("timestamp_ntz").alias("occurred_at"))


_COMMON_SQL = """SELECT '{t}' AS tbl, CAST({k} AS INTEGER) AS id, {k} % 2 = 0 AS flag, CAST({m} AS DECIMAL(12,2)) AS money, {x} AS text, CAST({k} % 1000 AS DECIMAL(8,3)) AS weight, CASE WHEN {k} % 3 = 0 THEN concat('n"é ', {k}) END AS note, make_timestamp(1700000000000000 + {k} * 1000000) AS changed, make_timestamp((1700000000000 + {k}) * 1000) AS occurred_at FROM {t} WHERE {k} % 23 <> 0 AND {k} % 29 <> 0"""


@query(" UNION ALL ".join(_COMMON_SQL.format(t=t, k=k, m=m, x=x) + (f" AND {k} % 19 <> 0" if t == "orders" else "") for t, k, m, x in (("orders", "o_orderkey", "o_totalprice", "o_orderpriority"), ("customer", "c_custkey", "c_acctbal", "c_mktsegment"), ("part", "p_partkey", "p_retailprice", "p_type"))))
def cdc_decode_tables(spark: SparkSession, d: str) -> DataFrame:
    """One topic's records decoded into three tables of ten columns."""
    tables, _ = cdc.decode(cdc.normalise(_many_envelopes(spark, d)), _TABLES, _TABLE_KEYS, "q:1:0")
    a, b, e = (_common(t, df) for t, df in tables.items())
    return a.unionByName(b).unionByName(e)


@query("""SELECT source_table, count(*) AS n, min(lsn) AS min_lsn, max(lsn) AS max_lsn FROM (SELECT CASE WHEN event_id % 101 = 0 OR event_id % 103 = 0 THEN NULL ELSE 'ev' END AS source_table, CASE WHEN event_id % 101 = 0 OR event_id % 103 = 0 THEN NULL ELSE event_id END AS lsn FROM events) GROUP BY source_table""")
def cdc_statistics(spark: SparkSession, d: str) -> DataFrame:
    return cdc.statistics(cdc.normalise(queries._envelopes(spark, d)))


@query("""SELECT tbl, reason, count(*) AS n FROM (
 SELECT 'orders' AS tbl, CASE WHEN o_orderkey % 29 = 0 THEN 'unknown_table' WHEN o_orderkey % 23 = 0 THEN 'invalid_primary_key' WHEN o_orderkey % 19 = 0 THEN 'invalid_field_type:paid' END AS reason FROM orders
 UNION ALL SELECT 'customer', CASE WHEN c_custkey % 29 = 0 THEN 'unknown_table' WHEN c_custkey % 23 = 0 THEN 'invalid_primary_key' END FROM customer UNION ALL SELECT 'part', CASE WHEN p_partkey % 29 = 0 THEN 'unknown_table' WHEN p_partkey % 23 = 0 THEN 'invalid_primary_key' END FROM part) GROUP BY ALL""")
def stream_split_tables(spark: SparkSession, d: str) -> DataFrame:
    """A stream of raw envelopes split into typed tables and quarantine, twice: the replayed batch changes nothing."""
    at = scratch(spark, "split")
    raw = cdc.normalise(_many_envelopes(spark, d))
    raw.write.parquet(f"{at}/raw")
    tables, bad = {t: Table(spark, f"{at}/{t}") for t in _TABLES}, Table(spark, f"{at}/quarantine")
    for checkpoint in ("first", "again"):
        stream.split(stream.files(spark, f"{at}/raw", raw.schema, None), tables, bad, _TABLES, _TABLE_KEYS, f"{at}/{checkpoint}", "split").awaitTermination()
    good = [t.read().select(F.lit(n).alias("tbl"), F.lit(None).cast("string").alias("reason")) for n, t in tables.items()]
    rows = good[0].unionByName(good[1]).unionByName(good[2]).unionByName(bad.read().select(F.col("topic").alias("tbl"), F.col("_quarantine_reason").alias("reason")))
    return rows.groupBy("tbl", "reason").agg(F.count("*").alias("n"))


def _log(spark: SparkSession, d: str) -> DataFrame:
    """Customers as changes in an event log, row images as JSON."""
    e = read(spark, d, "customer")
    image = F.to_json(F.struct(F.col("c_custkey").alias("user_id"), F.concat(F.lit("  "), F.upper("c_name"), F.lit(" ")).alias("username"), F.concat(F.lit("+84 "), "c_custkey").alias("phone_number"), F.col("c_mktsegment").alias("status"), F.lit("hidden").alias("password_hash"), F.lit("2024-01-02 03:04:05").alias("created_at")))
    kind = F.when(F.col("c_custkey") % 9 == 0, "DELETE").otherwise("INSERT")
    return e.select(F.col("c_custkey").alias("event_id"), F.lit("app_users").alias("source_table"), kind.alias("operation"), image.alias("row_data"), (F.to_timestamp(F.lit("2024-03-01")) + F.make_dt_interval(F.col("c_custkey").cast("int"))).alias("occurred_at"))


@query("""SELECT CAST(c_custkey AS INTEGER) AS user_id, lower(c_name) AS username, concat('+84', c_custkey) AS phone_number, lower(c_mktsegment) AS status, TIMESTAMP '2024-01-02 03:04:05' AS created_at, CASE WHEN c_custkey % 9 = 0 THEN 'DELETE' ELSE 'INSERT' END AS operation, c_custkey % 9 = 0 AS is_deleted,
 TIMESTAMP '2024-03-01' + to_days(CAST(c_custkey AS INTEGER)) AS occurred_at, 'batch' AS mode, c_custkey AS sequence FROM customer WHERE c_custkey > 10""")
def log_to_current_state(spark: SparkSession, d: str) -> DataFrame:
    """Events past a cursor, their images parsed without excluded columns, as the normalised current state."""
    found = {r.source_table: (r.upper, r.newest) for r in outbox.bounds(_log(spark, d), {"app_users": 10}, 1 << 40).collect()}  # a row a table
    events = outbox.events(_log(spark, d), "app_users", bronze.image_schema("app_users"), 10, found["app_users"][0])
    s = silver.state(outbox.with_metadata(events, "b", "shop", "public", "app_users"), SOURCES["app_users"])
    return s.select("user_id", "username", "phone_number", "status", F.col("created_at").cast("timestamp_ntz").alias("created_at"), F.col("_operation").alias("operation"), F.col("_is_deleted").alias("is_deleted"), F.col("_event_occurred_at").cast("timestamp_ntz").alias("occurred_at"), F.col("_ingestion_mode").alias("mode"), F.col("_source_event_sequence").alias("sequence"))


@query("""SELECT CAST(c_custkey AS INTEGER) AS user_id, lower(c_name) AS username, sha256(concat_ws('||', 'app_users', c_custkey, 'b', CASE WHEN c_custkey % 9 = 0 THEN 'DELETE' ELSE 'INSERT' END)) AS id FROM customer""")
def log_to_history(spark: SparkSession, d: str) -> DataFrame:
    """Every event of the log, normalised, with its id."""
    events = outbox.events(_log(spark, d), "app_users", bronze.image_schema("app_users"), -1, 1 << 40)
    h = silver.log(outbox.with_metadata(events, "b", "shop", "public", "app_users"), SOURCES["app_users"])
    return h.select("user_id", "username", F.col("_history_event_id").alias("id"))


@query("""SELECT count(*) AS rows, CAST(count(*) FILTER (c_custkey % 9 <> 0) AS BIGINT) AS inserts, CAST(0 AS BIGINT) AS updates, CAST(count(*) FILTER (c_custkey % 9 = 0) AS BIGINT) AS deletes, max(c_custkey) AS last FROM customer""")
def checked_append(spark: SparkSession, d: str) -> DataFrame:
    """A batch of events that is checked after it is written and before it counts; its counts are the commit's, and a second try of it is none."""
    table = Table(spark, scratch(spark, "app_users"))
    events = outbox.events(_log(spark, d), "app_users", bronze.image_schema("app_users"), -1, 1 << 40)
    rows = outbox.with_metadata(events, "b", "shop", "public", "app_users")
    last = rows.agg(F.max("_event_id")).first()[0]
    for _ in range(2):
        table.append(rows, writer="batch", txn=1, metadata={"last": last}, check=lambda written: bronze.checked("app_users", written, last))
    known = {k: int(table.metadata(k)) for k in ("rows", "inserts", "updates", "deletes", "last")}
    if table.read().count() != known["rows"] or table.entry().version != 0:
        raise RuntimeError("the batch was written twice")
    return spark.createDataFrame([tuple(known.values())], ", ".join(f"{k} long" for k in known))


@query("SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderkey % 2 = 1 THEN o_custkey END AS o_custkey FROM orders")
def append_new_columns(spark: SparkSession, d: str) -> DataFrame:
    """An append that brings a column which older rows lack; then the table is compacted, and what no version needs goes."""
    o = read(spark, d, "orders")
    table = Table(spark, scratch(spark, "orders"))
    table.append(o.where("o_orderkey % 2 = 0").select("o_orderkey", "o_orderstatus"))
    table.append(o.where("o_orderkey % 2 = 1").select("o_orderkey", "o_orderstatus", "o_custkey"))
    table.compact()
    table.vacuum(keep=1, older=0)
    return table.read()


@query("SELECT o_orderkey, o_orderstatus FROM orders UNION ALL SELECT n_nationkey, n_name FROM nation")
def catalog_table(spark: SparkSession, d: str) -> DataFrame:
    """A table of the session's catalog, written, appended to and read by name (and moved to a folder, as the name goes)."""
    name, path = f"tidemark_{uuid.uuid4().hex}", scratch(spark, "table")
    catalog.write(read(spark, d, "orders").select("o_orderkey", "o_orderstatus"), name, path=f"{path}/data")
    try:
        catalog.write(read(spark, d, "nation").select(F.col("n_nationkey").cast("bigint").alias("o_orderkey"), F.col("n_name").alias("o_orderstatus")), name, "append")
        catalog.write(catalog.read(spark, name), f"{path}/copy")
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    return catalog.read(spark, f"{path}/copy")


@query("""SELECT 'duplicate' AS rule, concat('{"l_orderkey":', l_orderkey, ',"l_linenumber":', l_linenumber, ',"count":', count(*), '}') AS details FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
UNION ALL SELECT 'missing', concat('{"o_orderkey":', o_orderkey, '}') FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)
UNION ALL SELECT 'dangling', concat('{"dimension":"part","key":', l_partkey, '}') FROM (SELECT DISTINCT l_partkey FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size > 5))""")
def quality_rules(spark: SparkSession, d: str) -> DataFrame:
    """Violations of three rules as rows of a rule and its details."""
    lines, orders = read(spark, d, "lineitem"), read(spark, d, "orders")
    twice = quality.rule("duplicate", quality.duplicates(lines, ["l_orderkey", "l_linenumber"]))
    lost = quality.rule("missing", quality.missing(orders, lines, {"o_orderkey": "l_orderkey"}).select("o_orderkey"))
    return twice.unionByName(lost).unionByName(quality.rule("dangling", quality.dangling(lines, {"l_partkey": ("part", read(spark, d, "part").where("p_size > 5"), "p_partkey")})))


@query("SELECT o_orderkey AS order_id FROM orders WHERE o_orderkey % 10 = 0 AND (o_orderkey % 7 = 0 OR o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)) AND o_orderkey % 4 <> 0")
def incomplete_orders_of_ids(spark: SparkSession, d: str) -> DataFrame:
    """Of the orders asked about, those that wait for lines; a deleted order (every fourth) waits for nothing."""
    o = read(spark, d, "orders")
    lines = read(spark, d, "lineitem").select(F.col("l_orderkey").alias("order_id"), F.lit(1).alias("quantity"), F.col("l_extendedprice").cast(MONEY).alias("unit_price"), F.col("l_tax").cast(MONEY).alias("tax_amount"))
    sums = lines.groupBy("order_id").agg(F.sum("unit_price").alias("subtotal_amount"), F.sum("tax_amount").alias("tax_amount"))
    header = o.select(F.col("o_orderkey").alias("order_id"), (F.col("o_orderkey") % 4 == 0).alias("_is_deleted")).join(sums, "order_id", "left")
    off = F.when(F.col("order_id") % 7 == 0, 1).otherwise(0).cast(MONEY)
    ids = o.where("o_orderkey % 10 = 0").select(F.col("o_orderkey").alias("order_id"))
    return quality.incomplete_orders(header.withColumn("subtotal_amount", F.coalesce("subtotal_amount", F.lit(0)) + off), lines, ids)


@query("SELECT CAST(strftime(f, '%Y%m%d') AS INTEGER) AS date_key, strftime(f, '%A') AS day_name FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS f FROM orders) UNION ALL SELECT 0, 'Unknown'")
def dim_date_members(spark: SparkSession, d: str) -> DataFrame:
    """Days in a versioned dimension: the unknown member and the days of two runs, of which the second finds most there."""
    o = read(spark, d, "orders").select(F.col("o_orderdate").alias("created_at"))
    table = Table(spark, scratch(spark, "dim_date"))
    for part in (o.where("month(created_at) < 7"), o):
        gold.add_members(table, dimensions.days(part, "created_at"), "date_key", "dim_date")
    return table.read().select("date_key", "day_name")


@query("""WITH s AS (SELECT s_suppkey, s_name, s_nationkey, CASE WHEN s_suppkey % 6 = 0 THEN 'moved' ELSE 'open' END AS later FROM supplier)
SELECT s_suppkey AS shop, 'open' AS status, TIMESTAMP '2024-01-01' AS effective_from, CASE WHEN later = 'moved' THEN TIMESTAMP '2024-06-01' ELSE TIMESTAMP '9999-12-31' END AS effective_to, later = 'open' AS is_current FROM s WHERE s_suppkey % 4 <> 3
UNION ALL SELECT s_suppkey, later, CASE WHEN s_suppkey % 4 = 3 THEN TIMESTAMP '2024-01-01' ELSE TIMESTAMP '2024-06-01' END, TIMESTAMP '9999-12-31', true FROM s WHERE s_suppkey % 4 = 3 OR later = 'moved' UNION ALL SELECT NULL, 'unknown', NULL, NULL, NULL""")
def dim_shop_versions(spark: SparkSession, d: str) -> DataFrame:
    """Shops in a versioned dimension: a first snapshot, then one with new shops (which start at their creation) and moved ones."""
    table = Table(spark, scratch(spark, "dim_shop"))
    for second in (False, True):
        s = read(spark, d, "supplier").where(F.lit(second) | (F.col("s_suppkey") % 4 != 3))
        moved = F.when(F.lit(second) & (F.col("s_suppkey") % 6 == 0), "moved").otherwise("open")
        at = F.to_timestamp(F.lit("2024-06-01" if second else "2024-01-01"))
        shops = _text(s.select(F.col("s_suppkey").alias("shop_id"), F.col("s_name").alias("shop_name"), moved.alias("status"), at.alias("updated_at"), F.to_timestamp(F.lit("2024-01-01")).alias("created_at")), TYPE2["dim_shop"])
        gold.version_members("dim_shop", table, gold.members_of("dim_shop", {"shops": shops}))
    return table.read().select(F.col("source_shop_id").alias("shop"), "status", F.col("effective_from").cast("timestamp_ntz").alias("effective_from"), F.col("effective_to").cast("timestamp_ntz").alias("effective_to"), "is_current")
