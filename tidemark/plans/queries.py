"""The library's operators over the test tables, each with the SQL that gives the same rows."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions import columns as c
from tidemark.operators import affected, allocate, current, dimensions, quality, scd2
from tidemark.sources import outbox
from tidemark.sources.release import Releases
from tidemark.sources.store import Table
from tidemark.streaming import cdc, stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}
MONEY = "decimal(18,2)"


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _lines(spark: SparkSession, d: str) -> DataFrame:
    """Lines with an id in their order: the source has none that is unique."""
    rest = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
    w = Window.partitionBy("l_orderkey").orderBy(*rest)
    return read(spark, d, "lineitem").withColumn("line_id", F.row_number().over(w)).withColumn("gross", F.col("l_extendedprice").cast(MONEY))


def _orders(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "orders").select("o_orderkey", F.col("o_totalprice").cast(MONEY).alias("total"))


_LINES_SQL = """lines AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) AS line_id,
 CAST(l_extendedprice AS DECIMAL(18,2)) AS gross FROM lineitem),
o AS (SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(18,2)) AS total FROM orders)"""


def _share_sql(a: str, w: str, t: str) -> str:
    """a * w / t, half-even to cents, in whole cents."""
    p, t = f"(CAST({a} * 100 AS HUGEINT) * CAST({w} * 100 AS HUGEINT))", f"CAST({t} * 100 AS HUGEINT)"
    return f"CAST(CAST({p} // {t} + CASE WHEN 2 * ({p} % {t}) > {t} OR (2 * ({p} % {t}) = {t} AND ({p} // {t}) % 2 = 1) THEN 1 ELSE 0 END AS DECIMAL(18,0)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(18,2))"


@query(f"""WITH {_LINES_SQL}, r AS (SELECT *, CASE WHEN sum(gross) OVER w > 0 THEN {_share_sql('total', 'gross', '(sum(gross) OVER w)')} ELSE 0 END AS raw
 FROM lines JOIN o ON l_orderkey = o_orderkey WINDOW w AS (PARTITION BY l_orderkey))
SELECT l_orderkey, CAST(line_id AS INTEGER) AS line_id, gross, CAST(CASE WHEN line_id = max(line_id) OVER w THEN total - (sum(raw) OVER w - raw) ELSE raw END AS DECIMAL(18,2)) AS allocated FROM r WINDOW w AS (PARTITION BY l_orderkey)""")
def fact_sales_allocation(spark: SparkSession, d: str) -> DataFrame:
    """An order's total shared over its lines by gross, exact to the cent."""
    f = _lines(spark, d).join(_orders(spark, d), F.col("l_orderkey") == F.col("o_orderkey"))
    return allocate.allocate(f, "l_orderkey", "line_id", {"allocated": F.col("total")}, F.col("gross")).select("l_orderkey", "line_id", "gross", "allocated")


@query(f"""WITH {_LINES_SQL}, a AS (SELECT l_orderkey, line_id, gross, CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(6,2)) AS DECIMAL(18,2)) AS own, CAST((total * 0.05) AS DECIMAL(18,2)) AS header, CAST(l_tax * 100 AS DECIMAL(18,2)) AS tax, CAST(30 AS DECIMAL(18,2)) AS ship FROM lines JOIN o ON l_orderkey = o_orderkey),
b AS (SELECT *, sum(own) OVER w AS all_own, greatest(header - sum(own) OVER w, 0) AS beyond, sum(gross) OVER w AS g FROM a WINDOW w AS (PARTITION BY l_orderkey)),
r AS (SELECT *, {_share_sql('beyond', 'gross', 'g')} AS r1, {_share_sql('header', 'gross', 'g')} AS r2, {_share_sql('ship', 'gross', 'g')} AS r3 FROM b),
x AS (SELECT *, CASE WHEN line_id = max(line_id) OVER w THEN beyond - (sum(r1) OVER w - r1) ELSE r1 END AS e1, CASE WHEN line_id = max(line_id) OVER w THEN header - (sum(r2) OVER w - r2) ELSE r2 END AS e2, CASE WHEN line_id = max(line_id) OVER w THEN ship - (sum(r3) OVER w - r3) ELSE r3 END AS e3 FROM r WINDOW w AS (PARTITION BY l_orderkey)),
y AS (SELECT *, CASE WHEN all_own <= header THEN own + e1 ELSE e2 END AS total_discount FROM x)
SELECT l_orderkey, CAST(line_id AS INTEGER) AS line_id, CAST(total_discount AS DECIMAL(18,2)) AS total_discount, CAST(e3 AS DECIMAL(18,2)) AS shipping, CAST(gross + tax + e3 - total_discount AS DECIMAL(18,2)) AS net FROM y""")
def fact_two_level_discount(spark: SparkSession, d: str) -> DataFrame:
    """Line and order discounts, shipping and net of every line."""
    f = _lines(spark, d).join(_orders(spark, d), F.col("l_orderkey") == F.col("o_orderkey"))
    f = f.withColumn("own", (F.col("gross") * F.col("l_discount").cast("decimal(6,2)")).cast(MONEY)).withColumn("header", (F.col("total") * F.lit("0.05").cast("decimal(4,2)")).cast(MONEY))
    f = f.withColumn("tax", (F.col("l_tax") * 100).cast(MONEY)).withColumn("ship", F.lit(30).cast(MONEY))
    f = allocate.with_discounts(f, "l_orderkey", "line_id", "gross", "own", "header", "ship", "tax")
    return f.select("l_orderkey", "line_id", "total_discount", F.col("shipping_allocated").alias("shipping"), "net")


@query("SELECT user_id, event_id, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n FROM events) WHERE n = 1")
def latest_event_per_user(spark: SparkSession, d: str) -> DataFrame:
    return current.latest(read(spark, d, "events"), ["user_id"], [F.col("ts").desc(), F.col("event_id").desc()]).select("user_id", "event_id", "event_type", "value")


@query("SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC, l_linenumber DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC) AS n FROM lineitem) WHERE n = 1")
def latest_line_per_order(spark: SparkSession, d: str) -> DataFrame:
    order = ["l_shipdate", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
    return current.latest(read(spark, d, "lineitem"), ["l_orderkey"], [F.col(x).desc() for x in order]).select("l_orderkey", *order)


def _change_events(spark: SparkSession, d: str) -> DataFrame:
    """Events as changes of a user: an error deletes, a signup inserts, others update."""
    operation = F.when(F.col("event_type") == "error", "DELETE").when(F.col("event_type") == "signup", "INSERT").otherwise("UPDATE")
    e = read(spark, d, "events")
    return e.select("user_id", "event_type", "value", F.col("event_id").alias("_event_id"), operation.alias("_operation"), F.col("ts").cast("timestamp").alias("_event_occurred_at"))


_LATEST_SQL = "SELECT *, CASE event_type WHEN 'error' THEN 'DELETE' WHEN 'signup' THEN 'INSERT' ELSE 'UPDATE' END AS op, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n FROM events"


@query(f"SELECT CAST(user_id AS INTEGER) AS user_id, event_type, value, op AS operation, op = 'DELETE' AS is_deleted FROM ({_LATEST_SQL}) WHERE n = 1")
def current_state_with_tombstones(spark: SparkSession, d: str) -> DataFrame:
    s = current.current_state(_change_events(spark, d), ["user_id"], ["user_id", "event_type", "value"])
    return s.select("user_id", "event_type", "value", F.col("_operation").alias("operation"), F.col("_is_deleted").alias("is_deleted"))


@query(f"SELECT CAST(user_id AS INTEGER) AS user_id, event_type, value FROM ({_LATEST_SQL}) WHERE n = 1 AND op <> 'DELETE'")
def current_state_alive(spark: SparkSession, d: str) -> DataFrame:
    return current.alive(current.current_state(_change_events(spark, d), ["user_id"], ["user_id", "event_type", "value"])).select("user_id", "event_type", "value")


@query("SELECT CAST(user_id AS INTEGER) AS user_id, event_type, CAST(event_id AS BIGINT) AS sequence, sha256(concat('users||', event_id, '||', CASE event_type WHEN 'error' THEN 'DELETE' WHEN 'signup' THEN 'INSERT' ELSE 'UPDATE' END)) AS history_event_id FROM events")
def change_history_ids(spark: SparkSession, d: str) -> DataFrame:
    """Every event with the id that it gets again when it is read again."""
    h = current.change_history(_change_events(spark, d), "users", ["user_id", "event_type"])
    return h.select("user_id", "event_type", F.col("_source_event_sequence").alias("sequence"), F.col("_history_event_id").alias("history_event_id"))


def _split_by_hour(spark: SparkSession, d: str, late: bool) -> DataFrame:
    late_ones = F.col("event_id") % 3 == 0
    e = read(spark, d, "events").where(late_ones if late else ~late_ones)
    return current.latest(e, ["user_id"], [F.col("ts").desc(), F.col("event_id").desc()]).select("user_id", "event_id", "event_type", "value", "ts")


_SPLIT_SQL = "SELECT user_id, event_id, event_type, value, ts FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n FROM events WHERE (event_id % 3 = 0) = {late}) WHERE n = 1"


@query(f"""WITH t AS ({_SPLIT_SQL.format(late='false')}), s AS ({_SPLIT_SQL.format(late='true')})
SELECT coalesce(t.user_id, s.user_id) AS user_id, CASE WHEN s.user_id IS NOT NULL AND (t.user_id IS NULL OR (s.ts, s.event_id) > (t.ts, t.event_id)) THEN s.event_id ELSE t.event_id END AS event_id,
 CASE WHEN t.user_id IS NULL THEN 'insert' WHEN s.user_id IS NOT NULL AND (s.ts, s.event_id) > (t.ts, t.event_id) THEN 'update' ELSE 'none' END AS change FROM t FULL JOIN s ON t.user_id = s.user_id""")
def sequence_guarded_upsert(spark: SparkSession, d: str) -> DataFrame:
    """Late rows lose against newer ones of the target."""
    r = current.upsert(_split_by_hour(spark, d, False), _split_by_hour(spark, d, True), ["user_id"], ["ts", "event_id"])
    return r.select("user_id", "event_id", F.col("_change").alias("change"))


@query("""WITH t AS (SELECT * FROM orders WHERE o_orderkey % 2 = 0 OR o_orderkey % 3 <> 0), s AS (SELECT * FROM orders WHERE o_orderkey % 3 = 0)
SELECT coalesce(t.o_orderkey, s.o_orderkey) AS o_orderkey, CASE WHEN s.o_orderkey IS NOT NULL THEN 'X' ELSE t.o_orderstatus END AS o_orderstatus FROM t FULL JOIN s ON t.o_orderkey = s.o_orderkey WHERE NOT (coalesce(t.o_orderkey, s.o_orderkey) % 5 = 0)""")
def upsert_with_delete_keys(spark: SparkSession, d: str) -> DataFrame:
    o = read(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    source = o.where("o_orderkey % 3 = 0 and o_orderkey % 5 <> 0").withColumn("o_orderstatus", F.lit("X"))
    r = current.upsert(o.where("o_orderkey % 2 = 0 or o_orderkey % 3 <> 0"), source, ["o_orderkey"], delete_keys=o.where("o_orderkey % 5 = 0"))
    return current.merged(r)


@query("SELECT p_brand, min(p_type) AS p_type FROM part WHERE p_brand NOT IN (SELECT p_brand FROM part WHERE p_partkey <= 10) GROUP BY p_brand")
def insert_only_members(spark: SparkSession, d: str) -> DataFrame:
    p = read(spark, d, "part")
    return current.insert_only(p.where("p_partkey <= 10").select("p_brand", "p_type"), p.select("p_brand", "p_type"), ["p_brand"])


def _history(spark: SparkSession, d: str) -> DataFrame:
    e = _change_events(spark, d).withColumn("attribute_hash", F.sha2("event_type", 256))
    return e.withColumn("_event_occurred_at", F.col("_event_occurred_at").cast("timestamp_ntz"))


_SCD2_SQL = """e AS (SELECT user_id, event_id, ts, event_type, value, CASE WHEN event_type = 'error' THEN 'DELETE' ELSE 'UPDATE' END AS op FROM events),
f AS (SELECT *, last_value(CASE WHEN op <> 'DELETE' THEN event_type END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS known, lag(op) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS was FROM e),
g AS (SELECT *, op <> 'DELETE' AND (known IS NULL OR known <> event_type OR coalesce(was = 'DELETE', false)) AS starts FROM f),
h AS (SELECT *, sum(CASE WHEN starts THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS version FROM g),
b AS (SELECT *, lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS nxt, lead(op) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS nop FROM h WHERE starts OR op = 'DELETE'),
l AS (SELECT user_id, version, arg_max(value, (ts, event_id)) AS value FROM h WHERE op <> 'DELETE' AND version > 0 GROUP BY ALL),
v AS (SELECT b.user_id, CAST(b.version AS INTEGER) AS version, b.event_type, l.value, b.ts AS effective_from, coalesce(nxt, TIMESTAMP '9999-12-31') AS effective_to, nxt IS NULL AS is_current, coalesce(nop = 'DELETE', false) AS is_deleted
 FROM b JOIN l ON b.user_id = l.user_id AND b.version = l.version WHERE starts)"""


def _versions(spark: SparkSession, d: str) -> DataFrame:
    return scd2.replay(_history(spark, d), "user_id", "_event_occurred_at", ["_event_occurred_at", "_event_id"], "attribute_hash", type1=["value"], carried=["event_type"])


@query(f"WITH {_SCD2_SQL} SELECT * FROM v")
def scd2_replay(spark: SparkSession, d: str) -> DataFrame:
    return _versions(spark, d).select("user_id", "version", "event_type", "value", "effective_from", "effective_to", "is_current", "is_deleted")


@query("SELECT CAST(0 AS BIGINT) AS n_different, count(DISTINCT user_id) AS n_users FROM events")
def scd2_incremental_equals_full(spark: SparkSession, d: str) -> DataFrame:
    """Replaying the touched users' history gives what a full replay does."""
    h = _history(spark, d)
    full = _versions(spark, d)
    new = h.where("_event_id % 10 = 0")
    part = scd2.replay(scd2.affected(h, new, "user_id"), "user_id", "_event_occurred_at", ["_event_occurred_at", "_event_id"], "attribute_hash", type1=["value"], carried=["event_type"])
    both = full.join(new.select("user_id").distinct(), "user_id", "left_anti").select(full.columns).unionByName(part)
    off = full.exceptAll(both).unionByName(both.exceptAll(full)).agg(F.count("*").alias("n_different"))
    return off.crossJoin(h.agg(F.countDistinct("user_id").alias("n_users")))  # one row each


@query(f"""WITH {_SCD2_SQL} SELECT 'many_current' AS rule, count(*) AS violations FROM (SELECT user_id FROM v WHERE is_current GROUP BY user_id HAVING count(*) > 1)
UNION ALL SELECT 'no_current', count(*) FROM (SELECT user_id FROM v GROUP BY user_id HAVING count(*) FILTER (is_current) = 0 AND NOT arg_max(is_deleted, (effective_to, version)))
UNION ALL SELECT 'empty_interval', count(*) FROM v WHERE effective_from >= effective_to
UNION ALL SELECT 'overlap', count(*) FROM (SELECT effective_from, lag(effective_to) OVER (PARTITION BY user_id ORDER BY effective_from, version) AS b FROM v) WHERE b > effective_from""")
def scd2_violations(spark: SparkSession, d: str) -> DataFrame:
    return scd2.violations(_versions(spark, d), "user_id", "version")


@query("""WITH s AS (SELECT c_custkey, CASE WHEN c_custkey % 7 = 0 THEN 'MOVED' ELSE c_mktsegment END AS seg, CASE WHEN c_custkey % 5 = 0 THEN 0 ELSE c_acctbal END AS bal FROM customer),
t AS (SELECT c_custkey, c_mktsegment AS seg, c_acctbal AS bal FROM customer WHERE c_custkey % 11 <> 0),
j AS (SELECT s.*, t.c_custkey AS k, t.seg AS tseg, t.bal AS tbal FROM s LEFT JOIN t USING (c_custkey))
SELECT c_custkey, 'INSERT' AS action, seg, CAST(bal AS DOUBLE) AS bal FROM j WHERE k IS NULL OR seg <> tseg UNION ALL SELECT c_custkey, 'CLOSE', seg, CAST(bal AS DOUBLE) FROM j WHERE k IS NOT NULL AND seg <> tseg
UNION ALL SELECT c_custkey, 'TYPE1', seg, CAST(bal AS DOUBLE) FROM j WHERE k IS NOT NULL AND seg = tseg AND bal <> tbal""")
def scd2_snapshot_diff(spark: SparkSession, d: str) -> DataFrame:
    cust = read(spark, d, "customer")
    source = cust.select("c_custkey", F.when(F.col("c_custkey") % 7 == 0, "MOVED").otherwise(F.col("c_mktsegment")).alias("seg"), F.when(F.col("c_custkey") % 5 == 0, 0.0).otherwise(F.col("c_acctbal")).alias("bal"))
    now = cust.where("c_custkey % 11 <> 0").select("c_custkey", F.col("c_mktsegment").alias("seg"), F.col("c_acctbal").alias("bal"))
    return scd2.difference(source, now, "c_custkey", "seg", ["bal"]).select("c_custkey", "action", "seg", "bal")


_LOOKUP_SQL = f"""WITH {_SCD2_SQL}, p AS (SELECT event_id, user_id, ts - INTERVAL {{h}} HOUR AS at FROM events WHERE event_type IN ('view', 'purchase')),
d AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY effective_from, version) = 1 AS first FROM v)
SELECT p.event_id, coalesce(d.version, 0) AS version FROM p LEFT JOIN d ON p.user_id = d.user_id AND (d.first OR p.at >= d.effective_from) AND p.at < d.effective_to"""


def _looked_up(spark: SparkSession, d: str, hours: int) -> DataFrame:
    facts = read(spark, d, "events").where(F.col("event_type").isin("view", "purchase")).select("event_id", F.col("user_id").alias("who"), (F.col("ts") - F.expr(f"INTERVAL {hours} HOURS")).alias("at"))
    versions = _versions(spark, d).withColumn("number", F.col("version"))
    return scd2.lookup(facts, versions, F.col("who").cast("int"), F.col("at"), "number", "version", "user_id").select("event_id", "version")


@query(_LOOKUP_SQL.format(h=0))
def asof_temporal_join(spark: SparkSession, d: str) -> DataFrame:
    return _looked_up(spark, d, 0)


@query(_LOOKUP_SQL.format(h=720))
def prehistory_fallback(spark: SparkSession, d: str) -> DataFrame:
    return _looked_up(spark, d, 720)


@query("""SELECT CAST(strftime(f, '%Y%m%d') AS INTEGER) AS date_key, f AS full_date, CAST(dayofweek(f) + 1 AS SMALLINT) AS day_of_week, strftime(f, '%A') AS day_name, CAST(day(f) AS SMALLINT) AS day_of_month, CAST(dayofyear(f) AS SMALLINT) AS day_of_year,
 CAST(week(f) AS SMALLINT) AS week_of_year, CAST(month(f) AS SMALLINT) AS month_number, strftime(f, '%B') AS month_name, CAST(quarter(f) AS SMALLINT) AS quarter_number, CAST(year(f) AS SMALLINT) AS year_number, dayofweek(f) IN (0, 6) AS is_weekend, f = last_day(f) AS is_month_end,
 CASE WHEN month(f) BETWEEN 3 AND 5 THEN 'Spring' WHEN month(f) BETWEEN 6 AND 8 THEN 'Summer' WHEN month(f) BETWEEN 9 AND 11 THEN 'Autumn' ELSE 'Winter' END AS season_name, CAST(year(f) AS SMALLINT) AS fiscal_year, CAST(quarter(f) AS SMALLINT) AS fiscal_quarter
 FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS f FROM orders)""")
def dim_date(spark: SparkSession, d: str) -> DataFrame:
    return dimensions.days(read(spark, d, "orders"), "o_orderdate")


@query("""SELECT k AS time_key, strftime(TIMESTAMP '2000-01-01' + to_seconds(k - 1), '%H:%M:%S') AS full_time, CAST((k - 1) // 3600 AS SMALLINT) AS hour_24, CAST(((k - 1) // 60) % 60 AS SMALLINT) AS minute_number, CAST((k - 1) % 60 AS SMALLINT) AS second_number,
 CASE WHEN (k - 1) // 3600 < 12 THEN 'AM' ELSE 'PM' END AS am_pm, CASE WHEN (k - 1) // 3600 BETWEEN 5 AND 11 THEN 'morning' WHEN (k - 1) // 3600 BETWEEN 12 AND 17 THEN 'afternoon' WHEN (k - 1) // 3600 BETWEEN 18 AND 21 THEN 'evening' ELSE 'night' END AS day_part
 FROM (SELECT DISTINCT CAST(hour(ts) * 3600 + minute(ts) * 60 + second(ts) + 1 AS INTEGER) AS k FROM events)""")
def dim_time(spark: SparkSession, d: str) -> DataFrame:
    return dimensions.seconds(read(spark, d, "events"), "ts")


@query("""SELECT DISTINCT n_name, r_name, sha256(concat(coalesce(n_name, ''), '||', coalesce(r_name, ''), '||', coalesce(CAST(k AS VARCHAR), ''))) AS content_hash FROM (
 SELECT n_name, r_name, n_nationkey AS k FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey UNION ALL SELECT n_name, r_name, n_nationkey FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)""")
def dim_location_content_hash(spark: SparkSession, d: str) -> DataFrame:
    place = read(spark, d, "nation").join(read(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    side = lambda t, k: read(spark, d, t).select(F.col(k).alias("n_nationkey")).join(place, "n_nationkey").select("n_name", "r_name", "n_nationkey")
    both = side("customer", "c_nationkey").unionByName(side("supplier", "s_nationkey")).distinct()
    return both.select("n_name", "r_name", c.natural_hash(F.col("n_name"), F.col("r_name"), F.col("n_nationkey")).alias("content_hash"))


@query("""WITH s AS (SELECT l_orderkey AS order_id, CAST(count(*) AS INTEGER) AS voucher_count, string_agg(DISTINCT p_brand, ',' ORDER BY p_brand) AS voucher_codes, string_agg(DISTINCT p_name, ',' ORDER BY p_name) AS voucher_names, string_agg(DISTINCT p_type, ',' ORDER BY p_type) AS discount_types,
 string_agg(DISTINCT CAST(p_size % 3 AS VARCHAR), ',' ORDER BY CAST(p_size % 3 AS VARCHAR)) AS promotion_scope, min(TIMESTAMP '2024-01-01' + to_days(p_size)) AS promotion_start_at, max(TIMESTAMP '2025-01-01' + to_days(p_size)) AS promotion_end_at, max(CAST(p_retailprice AS DECIMAL(18,2))) AS minimum_order_amount, bool_or(p_size > 40) AS is_active
 FROM lineitem LEFT JOIN part ON l_partkey = p_partkey GROUP BY l_orderkey)
SELECT * REPLACE (coalesce(voucher_codes, '') AS voucher_codes, coalesce(voucher_names, '') AS voucher_names, coalesce(discount_types, '') AS discount_types, coalesce(promotion_scope, '') AS promotion_scope),
 sha256(concat(coalesce(voucher_codes, ''), '||', coalesce(discount_types, ''), '||', coalesce(promotion_scope, ''))) AS natural_promotion_hash FROM s""")
def dim_promotion_sets(spark: SparkSession, d: str) -> DataFrame:
    """Parts as vouchers, an order's lines as their uses."""
    day = lambda start: F.to_timestamp_ntz(F.lit(start)) + F.make_dt_interval(F.col("p_size"))
    vouchers = read(spark, d, "part").select(
        F.col("p_partkey").alias("voucher_id"), F.col("p_brand").alias("voucher_code"), F.col("p_name").alias("voucher_name"), F.col("p_type").alias("discount_type"), (F.col("p_size") % 3).alias("scope_json"),
        day("2024-01-01").alias("starts_at"), day("2025-01-01").alias("ends_at"), F.col("p_retailprice").cast(MONEY).alias("minimum_order_amount"), (F.col("p_size") > 40).alias("is_active"),
    )
    return dimensions.promotions(read(spark, d, "lineitem").select(F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("voucher_id")), vouchers).drop("promotion_key", "promotion_type")


@query("SELECT DISTINCT o_orderstatus, o_orderpriority, sha256(concat(coalesce(o_orderstatus, ''), '||', coalesce(o_orderpriority, ''))) AS content_hash FROM orders")
def dim_payment_like(spark: SparkSession, d: str) -> DataFrame:
    return dimensions.members(read(spark, d, "orders"), "key", ["o_orderstatus", "o_orderpriority"]).drop("key")


@query("SELECT DISTINCT l_returnflag, l_linestatus, sha256(concat(coalesce(l_returnflag, ''), '||', coalesce(l_linestatus, ''))) AS content_hash FROM lineitem")
def dim_shipping_like(spark: SparkSession, d: str) -> DataFrame:
    return dimensions.members(read(spark, d, "lineitem"), "key", ["l_returnflag", "l_linestatus"]).drop("key")


@query("SELECT n_nationkey AS k, n_name AS name, CASE WHEN n_nationkey = 0 THEN NULL ELSE n_name END AS known FROM nation UNION ALL SELECT 0, NULL, NULL")
def unknown_member(spark: SparkSession, d: str) -> DataFrame:
    n = read(spark, d, "nation").select(F.col("n_nationkey").alias("k"), F.col("n_name").alias("name"), F.when(F.col("n_nationkey") != 0, F.col("n_name")).alias("known"))
    return dimensions.with_unknown(n, "k")


@query("""WITH n AS (SELECT n_nationkey AS id, CASE WHEN n_nationkey >= 5 THEN n_nationkey % 5 END AS parent, n_name AS name, TIMESTAMP '2024-01-01' + to_days(n_nationkey) AS at FROM nation)
SELECT n.id, n.name, p.name AS parent_name, greatest(n.at, coalesce(p.at, n.at)) AS effective_from FROM n LEFT JOIN n p ON n.parent = p.id""")
def category_parent_selfjoin(spark: SparkSession, d: str) -> DataFrame:
    at = F.to_timestamp_ntz(F.lit("2024-01-01")) + F.make_dt_interval(F.col("n_nationkey"))
    n = read(spark, d, "nation").select(F.col("n_nationkey").alias("category_id"), F.when(F.col("n_nationkey") >= 5, F.col("n_nationkey") % 5).alias("parent_category_id"), F.col("n_name").alias("category_name"), F.lit("s").alias("slug"), F.lit(True).alias("is_active"), at.alias("created_at"), at.alias("updated_at"))
    return dimensions.categories(n).select(F.col("category_id").alias("id"), F.col("category_name").alias("name"), F.col("parent_category_name").alias("parent_name"), "effective_from")


@query("SELECT DISTINCT l_orderkey AS order_id FROM lineitem WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_size = 7) OR l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_acctbal < 0)")
def affected_orders(spark: SparkSession, d: str) -> DataFrame:
    lines = read(spark, d, "lineitem").select(F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("p_partkey"), F.col("l_suppkey").alias("s_suppkey"))
    by_part = affected.within(lines, read(spark, d, "part").where("p_size = 7"), "p_partkey")
    by_supplier = affected.within(lines, read(spark, d, "supplier").where("s_acctbal < 0"), "s_suppkey")
    return affected.ids([by_part, by_supplier], "order_id")


@query("SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem WHERE l_quantity < 10 AND (l_orderkey, l_linenumber) NOT IN (SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_quantity >= 10)")
def stale_fact_keys(spark: SparkSession, d: str) -> DataFrame:
    f = read(spark, d, "lineitem")
    return affected.stale(f.where("l_quantity < 10"), f.where("l_quantity >= 10"), ["l_orderkey", "l_linenumber"]).distinct()


@query("SELECT 'part' AS dimension, l_partkey AS key FROM (SELECT DISTINCT l_partkey FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size > 5)) UNION ALL SELECT 'supplier', l_suppkey FROM (SELECT DISTINCT l_suppkey FROM lineitem WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0))")
def referential_integrity(spark: SparkSession, d: str) -> DataFrame:
    return quality.dangling(read(spark, d, "lineitem"), {"l_partkey": ("part", read(spark, d, "part").where("p_size > 5"), "p_partkey"), "l_suppkey": ("supplier", read(spark, d, "supplier").where("s_acctbal > 0"), "s_suppkey")})


@query("""SELECT count(*) AS n_rows, count(DISTINCT (l_orderkey, l_linenumber)) AS n_keys, count(DISTINCT l_partkey) AS n_surrogates, count_if(l_quantity <= 0 OR l_discount < 0.05) AS n_invalid, count_if(l_suppkey % 50 = 0) AS n_unresolved, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS total_gross FROM (SELECT *, l_discount - 0.05 AS m FROM lineitem)""")
def fact_metrics_one_pass(spark: SparkSession, d: str) -> DataFrame:
    f = read(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.col("l_quantity").alias("quantity"), F.when(F.col("l_discount") < 0.05, -1).otherwise(1).alias("m"), (F.col("l_suppkey") % 50).alias("k"), F.col("l_extendedprice").cast(MONEY).alias("gross"))
    return quality.metrics(f, ("l_orderkey", "l_linenumber"), "l_partkey", ["m"], ["k"], ["gross"]).withColumn("total_gross", F.col("total_gross").cast("decimal(38,2)"))


@query("SELECT o_orderkey FROM orders LEFT JOIN (SELECT l_orderkey, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS s FROM lineitem GROUP BY l_orderkey) ON o_orderkey = l_orderkey WHERE s IS NULL OR abs(CAST(o_totalprice AS DECIMAL(18,2)) - s) > 0.01")
def reconciliation(spark: SparkSession, d: str) -> DataFrame:
    actual = read(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.sum(F.col("l_extendedprice").cast(MONEY)).alias("s"))
    return quality.unreconciled(_orders(spark, d), actual, "o_orderkey", {"total": "s"}).select("o_orderkey")


@query("SELECT l_orderkey, l_linenumber, count(*) AS count FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def duplicate_keys(spark: SparkSession, d: str) -> DataFrame:
    return quality.duplicates(read(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
def source_rows_missing_from_fact(spark: SparkSession, d: str) -> DataFrame:
    return quality.missing(read(spark, d, "orders"), read(spark, d, "lineitem"), {"o_orderkey": "l_orderkey"}).select("o_orderkey")


@query("""SELECT count(*) AS n_rows, max(event_id) AS last_id, count_if(event_type = 'error') AS n_invalid, count_if(event_type = 'signup') AS n_insert, count_if(event_type IN ('view', 'click')) AS n_update, count_if(event_type = 'purchase') AS n_delete FROM events""")
def change_event_stats(spark: SparkSession, d: str) -> DataFrame:
    kind = F.when(F.col("event_type") == "signup", "INSERT").when(F.col("event_type").isin("view", "click"), "UPDATE").when(F.col("event_type") == "purchase", "DELETE").otherwise("BAD")
    e = read(spark, d, "events").select("user_id", F.col("event_id").alias("_event_id"), F.col("ts").alias("_event_occurred_at"), kind.alias("_operation"))
    return outbox.statistics(e, ("user_id",))


@query("SELECT event_type, max(event_id) FILTER (n <= 50 AND event_id > cursor) AS upper, max(event_id) AS newest FROM (SELECT *, row_number() OVER (PARTITION BY event_type, event_id > cursor ORDER BY event_id) AS n FROM (SELECT *, CASE event_type WHEN 'view' THEN 100 WHEN 'click' THEN 200 ELSE -1 END AS cursor FROM events)) GROUP BY event_type")
def bounded_micro_batch(spark: SparkSession, d: str) -> DataFrame:
    """The upper bound of each table's next bounded batch."""
    return outbox.bounds(read(spark, d, "events"), {"view": 100, "click": 200}, 50, "event_type", "event_id")


@query("""SELECT c_custkey, nullif(trim(concat('  ', c_name, ' ')), '') AS trimmed, lower(c_name) AS lowered, upper(c_mktsegment) AS uppered, concat('+', regexp_replace(c_name, '[^0-9]', '', 'g')) AS phone, CAST(NULL AS VARCHAR) AS blank FROM customer""")
def text_normalization(spark: SparkSession, d: str) -> DataFrame:
    cust = read(spark, d, "customer").select("c_custkey", F.concat(F.lit("  "), "c_name", F.lit(" ")).alias("trimmed"), F.col("c_name").alias("lowered"), F.col("c_mktsegment").alias("uppered"), F.concat(F.lit("+"), "c_name").alias("phone"), F.lit("   ").alias("blank"))
    return current.normalised(cust, trim=["trimmed", "blank"], lower=["lowered"], upper=["uppered"], phones=["phone"])


@query("""SELECT CAST(event_id AS INTEGER) AS event_id, TRY_CAST(event_type AS INTEGER) AS kind_id, CAST(value AS DECIMAL(12,2)) AS total_amount, event_type = 'true' AND NULL AS is_active FROM events""")
def name_driven_typing(spark: SparkSession, d: str) -> DataFrame:
    e = read(spark, d, "events").select("event_id", F.col("event_type").alias("kind_id"), F.col("value").alias("total_amount"), F.col("event_type").alias("is_active"))
    return c.typed(e)


SQL["name_driven_typing"] = "SELECT CAST(event_id AS INTEGER) AS event_id, TRY_CAST(event_type AS INTEGER) AS kind_id, CAST(value AS DECIMAL(12,2)) AS total_amount, TRY_CAST(event_type AS BOOLEAN) AS is_active FROM events"


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, CAST(json_extract_string(props, '$.k') AS VARCHAR) AS k_text, json_extract_string(props, '$.absent') AS absent FROM events")
def json_extract_typed(spark: SparkSession, d: str) -> DataFrame:
    e = read(spark, d, "events").withColumn("m", F.from_json("props", "map<string,string>", {"primitivesAsString": "true"}))
    return e.select("event_id", F.try_element_at("m", F.lit("k")).try_cast("int").alias("k"), F.get_json_object("props", "$.k").alias("k_text"), F.try_element_at("m", F.lit("absent")).alias("absent"))


def _envelopes(spark: SparkSession, d: str) -> DataFrame:
    """Events as transport records: deletes carry the row before, some values are broken on purpose."""
    e = read(spark, d, "events")
    i = F.col("event_id")
    amount = F.when(i % 13 == 0, "oops").otherwise(F.col("value").cast("decimal(12,2)").cast("string"))
    extra = F.when(i % 17 == 0, F.lit("x"))
    row = F.struct(i.alias("event_id"), F.col("event_type"), amount.alias("amount"), (F.unix_micros(F.col("ts").cast("timestamp"))).alias("seen_at"), extra.alias("surprise"))
    gone = F.col("event_type") == "error"
    envelope = F.to_json(
        F.struct(
            F.when(gone, row).alias("before"), F.when(~gone, row).alias("after"), F.struct(F.lit("public").alias("schema"), F.lit("ev").alias("table"), i.alias("lsn")).alias("source"),
            F.when(gone, "d").when(F.col("event_type") == "signup", "c").otherwise("u").alias("op"), F.unix_millis(F.col("ts").cast("timestamp")).alias("ts_ms"),
        )
    )
    value = F.when(i % 101 == 0, F.lit(None)).when(i % 103 == 0, F.lit("{broken")).otherwise(envelope)
    records = e.select(F.lit(None).cast("binary").alias("key"), value.cast("binary").alias("value"), F.lit("ev").alias("topic"), (i % 8).cast("int").alias("partition"), i.alias("offset"), F.col("ts").cast("timestamp").alias("timestamp"))
    return records.repartition(8)  # a topic is read in as many tasks as it has partitions


_SCHEMAS = {"ev": {"event_id": "int", "event_type": "string", "amount": "decimal(12,2)", "seen_at": "timestamp"}}
_KEYS = {"ev": ["event_id"]}


@query("""SELECT event_id, CASE WHEN event_id % 17 = 0 THEN 'amount,surprise' ELSE 'amount' END AS unexpected FROM events WHERE event_id % 101 <> 0 AND event_id % 103 <> 0""")
def schema_drift_detection(spark: SparkSession, d: str) -> DataFrame:
    """Fields of the payloads that a contract without an amount doesn't know, in order."""
    known = {"ev": {k: v for k, v in _SCHEMAS["ev"].items() if k != "amount"}}
    df = cdc.decoded(cdc.normalise(_envelopes(spark, d)), known, _KEYS)
    fields = F.regexp_extract("_quarantine_reason", "^unexpected_payload_fields:(.*)$", 1)
    return df.select(F.col("offset").alias("event_id"), fields.alias("unexpected")).where("unexpected <> ''")


def _decoded(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    tables, bad = cdc.decode(cdc.normalise(_envelopes(spark, d)), _SCHEMAS, _KEYS, "q:1:0")
    return tables["ev"], bad


@query("""SELECT CAST(event_id AS INTEGER) AS event_id, event_type, CAST(value AS DECIMAL(12,2)) AS amount, CASE event_type WHEN 'error' THEN 'DELETE' WHEN 'signup' THEN 'INSERT' ELSE 'UPDATE' END AS operation, concat('ev:', event_id % 8, ':', event_id) AS transport_id, CAST(ts AS TIMESTAMP) AS seen_at
 FROM events WHERE event_id % 101 <> 0 AND event_id % 103 <> 0 AND event_id % 17 <> 0 AND event_id % 13 <> 0""")
def cdc_decode(spark: SparkSession, d: str) -> DataFrame:
    good, _ = _decoded(spark, d)
    return good.select("event_id", "event_type", "amount", F.col("_operation").alias("operation"), F.col("_event_id").alias("transport_id"), F.col("seen_at").cast("timestamp_ntz").alias("seen_at"))


@query("""SELECT reason, count(*) AS n FROM (SELECT CASE WHEN event_id % 101 = 0 THEN 'tombstone' WHEN event_id % 103 = 0 THEN 'invalid_json' WHEN event_id % 17 = 0 THEN 'unexpected_payload_fields:surprise' WHEN event_id % 13 = 0 THEN 'invalid_field_type:amount' END AS reason FROM events) WHERE reason IS NOT NULL GROUP BY reason""")
def cdc_quarantine(spark: SparkSession, d: str) -> DataFrame:
    _, bad = _decoded(spark, d)
    return bad.groupBy(F.col("_quarantine_reason").alias("reason")).agg(F.count("*").alias("n"))


@query("""SELECT event_id, sha256(concat('{"event_id":', event_id, ',"event_type":"', event_type, '","odd":', CASE WHEN event_id % 2 = 1 THEN '1' ELSE 'null' END, '}')) AS record_hash FROM events""")
def record_hashes(spark: SparkSession, d: str) -> DataFrame:
    """The hash of a row as JSON, null fields kept."""
    e = read(spark, d, "events").withColumn("odd", F.when(F.col("event_id") % 2 == 1, 1))
    return e.select("event_id", c.record_hash(["event_id", "event_type", "odd"]).alias("record_hash"))


@query("SELECT count(*) AS n, count(DISTINCT (l_orderkey, l_linenumber)) AS n_keys, true AS in_range FROM lineitem")
def surrogate_keys(spark: SparkSession, d: str) -> DataFrame:
    k = read(spark, d, "lineitem").select(c.surrogate_key(F.col("l_orderkey"), F.col("l_linenumber")).alias("k"))
    return k.agg(F.count("*").alias("n"), F.countDistinct("k").alias("n_keys"), F.bool_and(F.col("k") >= 0).alias("in_range"))


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder on shared storage: below spark.checkpoint.dir, or, on one machine where that is unset, a local one."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        base = tempfile.gettempdir()
    return f"{base}/tidemark/{uuid.uuid4().hex}/{name}"


@query(f"SELECT CAST(user_id AS INTEGER) AS user_id, event_type, value, op AS operation FROM ({_LATEST_SQL}) WHERE n = 1")
def stream_available_now(spark: SparkSession, d: str) -> DataFrame:
    """A stream of files merged into current state, micro-batch by micro-batch, then replayed: the state stays."""
    at = scratch(spark, "stream")
    _change_events(spark, d).repartition(3, F.col("_event_id") % 3).write.parquet(f"{at}/in")
    source = stream.files(spark, f"{at}/in", _change_events(spark, d).schema, 1)
    table = Table(spark, f"{at}/state")
    for checkpoint in ("first", "again"):
        stream.to_current(source, table, f"{at}/{checkpoint}", "users", ["user_id"], ["user_id", "event_type", "value"]).awaitTermination()
    return table.read().select("user_id", "event_type", "value", F.col("_operation").alias("operation"))


@query("SELECT o_orderkey, o_orderstatus, c_name FROM orders JOIN customer ON o_custkey = c_custkey")
def release_snapshot_read(spark: SparkSession, d: str) -> DataFrame:
    """Two tables as a release pins them, read after newer commits."""
    at = scratch(spark, "release")
    tables = {n: Table(spark, f"{at}/{n}") for n in ("orders", "customer")}
    releases = Releases(spark, at, tuple(tables))
    pinned = {n: t.overwrite(read(spark, d, n)) for n, t in tables.items()}
    releases.publish("first", {}, {n: v or 0 for n, v in pinned.items()})
    tables["orders"].append(read(spark, d, "orders").withColumn("o_orderstatus", F.lit("later")))
    tables["customer"].overwrite(read(spark, d, "customer").limit(0))
    o, cust = (releases.read(n, t) for n, t in tables.items())
    return o.join(cust, o.o_custkey == cust.c_custkey).select("o_orderkey", "o_orderstatus", "c_name")


@query("""SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN 'X' ELSE c_mktsegment END AS segment, CASE WHEN c_custkey % 4 = 3 THEN 'insert' ELSE 'update_postimage' END AS change, 1 AS version FROM customer WHERE c_custkey % 4 = 3 OR c_custkey % 5 = 0
UNION ALL SELECT c_custkey, c_mktsegment, 'update_preimage', 1 FROM customer WHERE c_custkey % 5 = 0 AND c_custkey % 4 <> 3
UNION ALL SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN 'X' ELSE c_mktsegment END, 'delete', 2 FROM customer WHERE c_custkey % 9 = 0""")
def change_feed_range(spark: SparkSession, d: str) -> DataFrame:
    """What two merges changed, from their feeds: new and changed rows, then deletes."""
    cust = read(spark, d, "customer").select("c_custkey", F.col("c_mktsegment").alias("segment"))
    table = Table(spark, scratch(spark, "customer"))
    table.overwrite(cust.where("c_custkey % 4 <> 3"))
    moved = cust.withColumn("segment", F.when(F.col("c_custkey") % 5 == 0, "X").otherwise(F.col("segment")))
    table.merge(moved, ["c_custkey"])
    table.merge(moved.limit(0), ["c_custkey"], delete_keys=cust.where("c_custkey % 9 = 0"))
    return table.changes(1, 2).select("c_custkey", "segment", F.col("_change_type").alias("change"), F.col("_commit_version").cast("int").alias("version"))


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus FROM orders WHERE o_orderkey % 5 <> 0""")
def bucketed_table_merge(spark: SparkSession, d: str) -> DataFrame:
    """A merge into a table of 16 buckets, which rewrites those that it touches."""
    o = read(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    table = Table(spark, scratch(spark, "orders"), 16)
    table.overwrite(o.where("o_orderkey % 2 = 0 or o_orderkey % 3 <> 0"), keys=("o_orderkey",))
    source = o.where("o_orderkey % 3 = 0 and o_orderkey % 5 <> 0").withColumn("o_orderstatus", F.lit("X"))
    table.merge(source, ["o_orderkey"], delete_keys=o.where("o_orderkey % 5 = 0"))
    return table.read()


@query("SELECT o_orderkey AS order_id FROM orders WHERE o_orderkey % 7 = 0 OR o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
def incomplete_orders_gate(spark: SparkSession, d: str) -> DataFrame:
    """Orders whose lines don't add up to their header (every seventh is made to miss by one) or that have none."""
    money = "decimal(18,2)"
    lines = read(spark, d, "lineitem").select(F.col("l_orderkey").alias("order_id"), F.lit(1).alias("quantity"), F.col("l_extendedprice").cast(money).alias("unit_price"), F.col("l_tax").cast(money).alias("tax_amount"))
    sums = lines.groupBy("order_id").agg(F.sum("unit_price").alias("subtotal_amount"), F.sum("tax_amount").alias("tax_amount"))
    header = read(spark, d, "orders").select(F.col("o_orderkey").alias("order_id")).join(sums, "order_id", "left")
    off = F.when(F.col("order_id") % 7 == 0, 1).otherwise(0).cast(money)
    return quality.incomplete_orders(header.withColumn("subtotal_amount", F.coalesce("subtotal_amount", F.lit(0)) + off), lines)
