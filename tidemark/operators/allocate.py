"""Exact allocation of an order's money to its lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def share(amount: Column, weight: Column, total: Column) -> Column:
    """amount * weight / total, half-even to cents and exact: in whole cents, from quotient and remainder (decimal division would round to six digits first)."""
    cents = lambda x: (F.abs(x) * 100).cast("decimal(18,0)")
    product, whole = cents(amount) * cents(weight), (total * 100).cast("decimal(20,0)")
    quotient = F.call_function("div", product, whole)
    twice = (product - quotient.cast("decimal(18,0)") * whole) * 2
    up = (twice > whole) | ((twice == whole) & (quotient % 2 == 1))
    return (F.signum(amount).cast("decimal(1,0)") * (quotient + up.cast("int")).cast("decimal(18,0)") * F.lit("0.01").cast("decimal(3,2)")).cast("decimal(18,2)")


def allocate(df: DataFrame, order: str, line: str, amounts: dict[str, Column], weight: Column) -> DataFrame:
    """df with one column for every amount: the line with the highest id takes what rounding left (or all, if no line weighs anything). All windows share one partitioning, so there is one shuffle."""
    whole, last = Window.partitionBy(order), Window.partitionBy(order).orderBy(F.col(line).desc())
    # all shares in one window, all rests in a second
    df = df.withColumns({"_last": F.row_number().over(last) == 1, "_weight": F.sum(weight).over(whole)})
    weighs = F.col("_weight") > 0
    df = df.withColumns({f"_raw_{n}": F.when(weighs, share(a, weight, F.when(weighs, F.col("_weight")))).otherwise(F.lit(0)).cast("decimal(18,2)") for n, a in amounts.items()})
    df = df.withColumns({f"_sum_{n}": F.sum(f"_raw_{n}").over(whole) for n in amounts})
    rest = lambda n, a: a - (F.col(f"_sum_{n}") - F.col(f"_raw_{n}"))
    df = df.withColumns({n: F.when(F.col("_last"), rest(n, a)).otherwise(F.col(f"_raw_{n}")).cast("decimal(18,2)") for n, a in amounts.items()})
    return df.drop("_last", "_weight", *[f"_{x}_{n}" for x in ("raw", "sum") for n in amounts])


def with_discounts(lines: DataFrame, order: str, line: str, gross: str, line_discount: str, header_discount: str, shipping: str, tax: str) -> DataFrame:
    """Lines with order_discount_allocated, shipping_allocated, total_discount and net.

    The order's discount beyond the lines' own is shared by gross. Where the
    lines' own discounts exceed the header's, they only inform, and the header's
    discount is shared by gross instead.
    """
    whole = Window.partitionBy(order)
    own = F.sum(F.col(line_discount)).over(whole)
    df = lines.withColumn("_own", own)
    beyond = F.greatest(F.col(header_discount) - F.col("_own"), F.lit(0).cast("decimal(18,2)"))
    df = df.withColumn("_beyond", beyond.cast("decimal(18,2)"))
    df = allocate(df, order, line, {"order_discount_allocated": F.col("_beyond"), "_header": F.col(header_discount), "shipping_allocated": F.col(shipping)}, F.col(gross))
    total = F.when(F.col("_own") <= F.col(header_discount), F.col(line_discount) + F.col("order_discount_allocated")).otherwise(F.col("_header"))
    df = df.withColumn("total_discount", total.cast("decimal(18,2)"))
    net = F.col(gross) + F.col(tax) + F.col("shipping_allocated") - F.col("total_discount")
    return df.withColumn("net", net.cast("decimal(18,2)")).drop("_own", "_beyond", "_header")
