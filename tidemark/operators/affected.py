"""Which keys a set of changes touches."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import DataFrame

from tidemark.contracts import FEEDS

ORDER_TABLES = ("orders", "order_items", "order_vouchers", "payments", "shipments")


def ids(frames: Iterable[DataFrame], key: str) -> DataFrame:
    return reduce(DataFrame.unionByName, (f.select(key) for f in frames)).where(f"{key} is not null").distinct()


def within(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows of these keys. Spark broadcasts the keys where their measured size is small."""
    return df.join(keys.select(key).distinct(), key, "left_semi")


def orders(changes: Mapping[str, DataFrame], order_vouchers: DataFrame) -> DataFrame:
    """Orders touched by changes of their own tables, and those that hold a changed voucher now or in a changed row."""
    frames = [changes[t].select("order_id") for t in ORDER_TABLES if t in changes]
    if "vouchers" in changes:
        holders = order_vouchers.select("order_id", "voucher_id")
        if "order_vouchers" in changes:
            holders = holders.unionByName(changes["order_vouchers"].select("order_id", "voucher_id"))
        frames.append(within(holders, changes["vouchers"], "voucher_id").select("order_id"))
    return ids(frames, "order_id")


def categories(changed: DataFrame, all_categories: DataFrame) -> DataFrame:
    """Changed categories and their direct children (whose parent's name they carry)."""
    children = all_categories.join(changed.select("category_id").distinct().withColumnRenamed("category_id", "parent_category_id"), "parent_category_id", "left_semi")
    return ids([changed, children], "category_id")


def products(changes: Mapping[str, DataFrame]) -> DataFrame:
    return ids([changes[t] for t in ("products", "product_variants") if t in changes], "product_id")


def stale(existing: DataFrame, rebuilt: DataFrame, keys: list[str]) -> DataFrame:
    return existing.select(*keys).join(rebuilt.select(*keys), keys, "left_anti")


def targets(changed: Iterable[str]) -> tuple[str, ...]:
    """Dimensions and facts to rebuild, dimensions first."""
    return tuple(dict.fromkeys(sorted((t for c in changed for t in FEEDS[c]), key=lambda t: t == "fact_sales")))
