"""The star schema, whole or for the keys that changes touch, and its release.

Readers see the release's versions only, so tables may be committed one after
another; the release is published last, once the quality rules hold. Ids and
candidate facts that are used more than once are written below `work`.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.contracts import GOLD, SOURCES, TYPE1, TYPE2
from tidemark.functions import columns as c
from tidemark.operators import affected, current, dimensions, fact, quality, scd2
from tidemark.plans import silver
from tidemark.plans.layers import Lake
from tidemark.sources.store import Files, Table

#: Snapshot dimensions: (source key, member column, surrogate key).
VERSIONED = {"dim_shop": ("shop_id", "source_shop_id", "shop_key"), "dim_category": ("category_id", "source_category_id", "category_key"), "dim_product": ("product_variant_id", "source_product_variant_id", "product_key")}
CUSTOMER = ("user_id", "source_customer_id", "customer_key")
#: The fact's key columns: (dimension, its key).
REFERENCES = {
    "order_date_key": ("dim_date", "date_key"), "order_time_key": ("dim_time", "time_key"), "customer_key": ("dim_customer", "customer_key"), "product_key": ("dim_product", "product_key"), "shop_key": ("dim_shop", "shop_key"), "category_key": ("dim_category", "category_key"),
    "ship_to_location_key": ("dim_location", "location_key"), "bill_to_location_key": ("dim_location", "location_key"), "promotion_key": ("dim_promotion", "promotion_key"), "payment_key": ("dim_payment", "payment_key"), "shipping_key": ("dim_shipping", "shipping_key"),
}
#: What an order's header says and what its facts add up to.
TOTALS = {"subtotal_amount": "gross_sales_amount", "discount_amount": "total_discount_amount", "tax_amount": "tax_amount", "shipping_amount": "shipping_amount_allocated", "total_amount": "net_sales_amount"}


class QualityError(ValueError):
    """The star schema breaks a rule."""


class Work:
    """Results that are used more than once, written in the lake and removed at the end."""

    def __init__(self, lake: Lake, batch_id: str):
        self.lake, self.path = lake, f"{lake.root}/work/{batch_id}"

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{self.path}/{name}")
        return self.lake.spark.read.schema(df.schema).parquet(f"{self.path}/{name}")

    def __enter__(self) -> Work:
        return self

    def __exit__(self, *_: object) -> None:
        Files(self.lake.spark, f"{self.lake.root}/work").delete(self.path.rsplit("/", 1)[1])


def customer_versions(history: DataFrame) -> DataFrame:
    """Versions of customers, replayed from their history."""
    source, member, key = CUSTOMER
    at = F.coalesce("_event_occurred_at", "updated_at", "created_at")
    events = history.withColumns({"_at": at, "attribute_hash": c.natural_hash(*[F.col(a) for a in TYPE2["dim_customer"]]), "_operation": F.upper("_operation"), "full_name": F.nullif(F.trim(F.concat_ws(" ", "first_name", "last_name")), F.lit(""))})
    events = events.withColumnRenamed(source, member).withColumnRenamed("created_at", "registered_at")
    order = ("_at", *current.SEQUENCE[1:], "_history_event_id")
    carried = ("public_user_id", *TYPE2["dim_customer"], "full_name", "registered_at")
    return scd2.with_keys(scd2.replay(events, member, "_at", order, "attribute_hash", TYPE1["dim_customer"], carried, event_id="_history_event_id", initial="registered_at"), member, key)


def members_of(name: str, t: Mapping[str, DataFrame]) -> DataFrame:
    """The members that the source tables hold now, with their attributes, hash and start."""
    source, member, _ = VERSIONED[name]
    df = {"dim_shop": lambda: dimensions.shops(t["shops"]), "dim_category": lambda: dimensions.categories(t["categories"]), "dim_product": lambda: dimensions.products(t["product_variants"], t["products"])}[name]()
    extra = [F.col("category_id").alias("source_category_id")] if name == "dim_product" else []
    return df.select(F.col(source).alias(member), *extra, *TYPE2[name], *TYPE1.get(name, ()), F.col("created_at").alias("source_created_at"), "attribute_hash", "effective_from", F.lit(False).alias("is_deleted"))


def version_members(name: str, table: Table, members: DataFrame) -> None:
    """Members into their dimension: new ones start at their creation, changed ones close and start again, type-1 columns are overwritten."""
    _, member, key = VERSIONED[name]
    type1 = TYPE1.get(name, ())
    born = F.coalesce("source_created_at", "effective_from")
    if not table.exists():
        first = scd2.with_keys(members.withColumn("effective_from", born), member, key)
        table.overwrite(dimensions.with_unknown(first.withColumns({"effective_to": F.lit(c.OPEN_END).cast("timestamp"), "is_current": F.lit(True)}), key, name), keys=(key,))
        return
    held = affected.within(table.read(), members, member)
    known = held.select(member).distinct().withColumn("_known", F.lit(True))
    start = F.when(F.col("_known"), F.col("effective_from")).otherwise(born)
    source = scd2.with_keys(members.join(known, member, "left").withColumn("effective_from", start).drop("_known"), member, key)
    staged = scd2.difference(source, held.where("is_current"), member, "attribute_hash", type1)
    table.merge(scd2.apply(held, staged, member, type1), [key])


def add_members(table: Table, members: DataFrame, key: str, name: str) -> None:
    """Members that the dimension doesn't hold yet."""
    if not table.exists():
        table.overwrite(dimensions.with_unknown(current.latest(members, [key], [F.col(x) for x in members.columns if x != key]), key, name))
        return
    fresh = current.insert_only(table.read(), members, [key])
    if not fresh.isEmpty():
        table.append(fresh)


def put_members(table: Table, members: DataFrame, key: str, name: str) -> None:
    if table.exists():
        table.merge(members, [key])
    else:
        table.overwrite(dimensions.with_unknown(members, key, name), keys=(key,))


def promotion_members(order_vouchers: DataFrame, vouchers: DataFrame) -> DataFrame:
    """Distinct voucher combinations; terms that differ between orders take the smallest value."""
    by_order = dimensions.promotions(order_vouchers, vouchers)
    return by_order.groupBy("promotion_key").agg(*[F.min(x).alias(x) for x in by_order.columns if x not in ("order_id", "promotion_key")])


def gate(facts: DataFrame, orders: DataFrame, items: DataFrame, dims: Mapping[str, DataFrame], full: bool = False) -> dict[str, object]:
    """The report, or an error with the first violations: keys, measures, references, missing lines, money; on a full run also unique members and sound versions."""
    totals = tuple(TOTALS.values())
    m = quality.metrics(facts, totals=totals).first()
    n_orders, n_items = orders.count(), items.count()
    counts = {"lines_missing_or_extra": int(m.n_rows != n_items), "duplicate_lines": m.n_rows - m.n_keys, "duplicate_sales_keys": m.n_rows - m.n_surrogates, "invalid_measures": m.n_invalid, "unresolved_keys": m.n_unresolved}
    if bad := {k: v for k, v in counts.items() if v}:
        raise QualityError(f"facts: {bad} ({m.n_rows} rows, {n_items} source lines)")
    found = [quality.rule("missing_order_item", quality.missing(items.select("order_id", "order_item_id"), facts.select("source_order_id", "source_order_item_id"), {"order_id": "source_order_id", "order_item_id": "source_order_item_id"}))]
    found.append(quality.rule("dangling_reference", quality.dangling(facts, {column: (name, dims[name], key) for column, (name, key) in REFERENCES.items()})))
    actual = facts.groupBy(F.col("source_order_id").alias("order_id")).agg(*[F.sum(a).alias(f"actual_{a}") for a in TOTALS.values()])
    found.append(quality.rule("monetary_mismatch", quality.unreconciled(orders.select("order_id", *TOTALS), actual, "order_id", {e: f"actual_{a}" for e, a in TOTALS.items()})))
    if full:
        for name, key in dict(REFERENCES.values()).items():
            found.append(quality.rule(f"duplicate_member:{name}", quality.duplicates(dims[name], [key])))
        for name, (_, member, key) in {**VERSIONED, "dim_customer": CUSTOMER}.items():
            found.append(quality.rule(f"versions:{name}", scd2.violations(dims[name].where(f"{key} <> 0"), member, key).where("violations > 0")))
    if rows := reduce(DataFrame.unionByName, found).limit(20).collect():
        raise QualityError("; ".join(f"{r.rule} {r.details}" for r in rows))
    return {"orders": n_orders, "order_items": n_items, "fact_rows": m.n_rows} | {t: str(m[f"total_{t}"]) for t in totals}


def alive(lake: Lake, tables: Mapping[str, int]) -> dict[str, DataFrame]:
    return {t: current.alive(lake.silver(t).read(tables[t])) for t in SOURCES}


def build(lake: Lake, batch_id: str, full: bool = False) -> dict[str, object]:
    """Bring the star schema to the current states and publish it. Returns the mode and the gate's report."""
    now, releases = silver.versions(lake), lake.releases()
    release = releases.latest()
    full = full or release is None
    moved = {t: (-1, v) for t, v in now.items()} if full else releases.advanced(now)
    if not moved:
        return {"mode": "no_change"}
    t = alive(lake, now)
    changed = set(moved) - {"app_users_history"}
    feeds = {} if full else {s: lake.silver(s).changes(moved[s][0] + 1, moved[s][1]) for s in changed}
    wanted = set(affected.targets(changed)) | ({"dim_customer"} if "app_users_history" in moved else set())
    with Work(lake, batch_id) as work:
        orders = None if full or "fact_sales" not in wanted else work.keep(affected.orders(feeds, t["order_vouchers"]), "orders")
        of = lambda name: t[name] if orders is None else affected.within(t[name], orders, "order_id")
        touched = lambda name: t[name] if full else current.alive(feeds[name]).where("_change_type in ('insert', 'update_postimage')").drop("_change_type", "_commit_version") if name in feeds else t[name].limit(0)

        def customers() -> None:
            history = lake.history("app_users").read(now["app_users_history"])
            table = lake.gold("dim_customer")
            if full or not table.exists():
                rebuilt = customer_versions(history)
                table.overwrite(dimensions.with_unknown(rebuilt, CUSTOMER[2]), keys=(CUSTOMER[2],))
                return
            new = lake.history("app_users").changes(moved["app_users_history"][0] + 1, moved["app_users_history"][1]) if "app_users_history" in moved else history.limit(0)
            ids = work.keep(affected.ids([new], CUSTOMER[0]), "customers")
            rebuilt = customer_versions(scd2.affected(history, ids, CUSTOMER[0]))
            held = table.read().join(ids.withColumnRenamed(CUSTOMER[0], CUSTOMER[1]), CUSTOMER[1], "left_semi")
            table.merge(rebuilt, [CUSTOMER[2]], delete_keys=affected.stale(held, rebuilt, [CUSTOMER[2]]))

        def versioned(name: str) -> Callable[[], None]:
            def run() -> None:
                s = dict(t)
                if not full and name == "dim_shop":
                    s["shops"] = affected.within(t["shops"], feeds["shops"], "shop_id")
                if not full and name == "dim_product":
                    ids = affected.products(feeds)
                    s |= {x: affected.within(t[x], ids, "product_id") for x in ("products", "product_variants")}
                members = members_of(name, s)
                if not full and name == "dim_category":
                    ids = affected.categories(feeds["categories"], t["categories"])
                    members = affected.within(members, ids.withColumnRenamed("category_id", "source_category_id"), "source_category_id")
                version_members(name, lake.gold(name), members)

            return run

        plans: dict[str, Callable[[], None]] = {
            "dim_customer": customers, **{n: versioned(n) for n in VERSIONED},
            "dim_date": lambda: add_members(lake.gold("dim_date"), dimensions.days(touched("orders"), "created_at"), "date_key", "dim_date"),
            "dim_time": lambda: add_members(lake.gold("dim_time"), dimensions.seconds(touched("orders"), "created_at"), "time_key", "dim_time"),
            "dim_location": lambda: add_members(lake.gold("dim_location"), dimensions.locations(touched("user_addresses"), touched("orders")), "location_key", "dim_location"),
            "dim_payment": lambda: add_members(lake.gold("dim_payment"), dimensions.payments(touched("payments")), "payment_key", "dim_payment"),
            "dim_shipping": lambda: add_members(lake.gold("dim_shipping"), dimensions.shipping(touched("shipments")), "shipping_key", "dim_shipping"),
            "dim_promotion": lambda: put_members(lake.gold("dim_promotion"), promotion_members(of("order_vouchers"), t["vouchers"]), "promotion_key", "dim_promotion"),
        }
        lake.each(lambda name: plans[name](), [n for n in GOLD if n in plans and n in wanted])
        dims = {n: lake.gold(n).read() for n in GOLD if n != "fact_sales"}
        table = lake.gold("fact_sales")
        report: dict[str, object] = {}
        if "fact_sales" in wanted:
            scope = {n: of(n) for n in affected.ORDER_TABLES} | {"vouchers": t["vouchers"]}
            facts = work.keep(fact.sales(scope, dims), "facts")
            report = gate(facts, scope["orders"], scope["order_items"], dims, full)
            if full or not table.exists():
                table.overwrite(facts, keys=("sales_key",))
            else:
                held = table.read().join(orders.withColumnRenamed("order_id", "source_order_id"), "source_order_id", "left_semi")  # type: ignore[union-attr]
                table.merge(facts, ["sales_key"], delete_keys=affected.stale(held, facts, ["sales_key"]))
        releases.publish(batch_id, now, {n: lake.gold(n).entry().version for n in GOLD})
    return {"mode": "full" if full else "incremental", "targets": sorted(wanted), "report": report}
