"""Quality rules over the star schema: violations as rows (rule, details), metrics as one row."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import any_of

# Measures that may not be negative, keys that every fact has, and how far sums may be off.
MONEY = ("unit_price_amount", "gross_sales_amount", "line_discount_amount", "order_discount_amount_allocated", "total_discount_amount", "tax_amount", "shipping_amount_allocated", "net_sales_amount")
REQUIRED = ("order_date_key", "order_time_key", "customer_key", "product_key", "shop_key", "category_key", "ship_to_location_key", "bill_to_location_key")
TOLERANCE = 0.01


def metrics(fact: DataFrame, keys: tuple[str, ...] = ("source_order_id", "source_order_item_id"), surrogate: str = "sales_key", money: Iterable[str] = MONEY, required: Iterable[str] = REQUIRED, totals: Iterable[str] = ()) -> DataFrame:
    """Rows, distinct keys, invalid measures, unresolved keys and totals in one pass."""
    bad = any_of([F.col("quantity") <= 0, F.col("quantity").isNull(), *[F.col(m).isNull() | (F.col(m) < 0) for m in money]])
    open_ = any_of([F.col(k).isNull() | (F.col(k) == 0) for k in required])
    return fact.agg(
        F.count("*").alias("n_rows"), F.countDistinct(F.struct(*keys)).alias("n_keys"), F.countDistinct(surrogate).alias("n_surrogates"), F.count_if(bad).alias("n_invalid"), F.count_if(open_).alias("n_unresolved"),
        *[F.sum(t).alias(f"total_{t}") for t in totals],
    )


def duplicates(df: DataFrame, keys: Iterable[str]) -> DataFrame:
    return df.groupBy(*keys).count().where("count > 1")


def dangling(fact: DataFrame, references: Mapping[str, tuple[str, DataFrame, str]]) -> DataFrame:
    """(dimension, key) that facts name and no dimension holds, in one pass: references by fact column are (dimension, its table, its key)."""
    pairs = F.explode(F.array(*[F.struct(F.lit(name).alias("dimension"), F.col(column).cast("bigint").alias("key")) for column, (name, _, _) in references.items()]))
    named = fact.select(pairs.alias("r")).select("r.*").where("key is not null").distinct()
    held = {name: table.select(F.lit(name).alias("dimension"), F.col(key).cast("bigint").alias("key")) for name, table, key in references.values()}
    return named.join(reduce(DataFrame.unionByName, held.values()), ["dimension", "key"], "left_anti")


def unreconciled(expected: DataFrame, actual: DataFrame, key: str, pairs: Mapping[str, str], tolerance: float = TOLERANCE) -> DataFrame:
    """Keys whose totals differ by more than the tolerance, or that have none."""
    off: list[Column] = [F.col(a).isNull() | (F.abs(F.col(e) - F.col(a)) > tolerance) for e, a in pairs.items()]
    return expected.join(actual, key, "left").where(any_of(off))


def missing(source: DataFrame, fact: DataFrame, keys: Mapping[str, str]) -> DataFrame:
    on = reduce(lambda a, b: a & b, (source[s] == fact[f] for s, f in keys.items()))
    return source.join(fact, on, "left_anti")


def incomplete_orders(orders: DataFrame, items: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """Orders whose lines don't yet add up to the header. Tables are read with their tombstones; a deleted order waits for nothing."""
    scope = orders.join(ids.distinct(), "order_id", "left_semi") if ids is not None else orders
    sums = items.groupBy("order_id").agg(F.sum(F.col("quantity") * F.col("unit_price")).alias("_gross"), F.sum("tax_amount").alias("_tax"))
    off = any_of([F.col("_gross").isNull(), F.abs(F.col("_gross") - F.col("subtotal_amount")) > TOLERANCE, F.abs(F.col("_tax") - F.col("tax_amount")) > TOLERANCE])
    alive = ~F.coalesce(F.col("_is_deleted"), F.lit(False)) if "_is_deleted" in orders.columns else F.lit(True)
    return scope.join(sums, "order_id", "left").where(alive & off).select("order_id")


def rule(name: str, violations: DataFrame) -> DataFrame:
    return violations.select(F.lit(name).alias("rule"), F.to_json(F.struct(*violations.columns)).alias("details"))
