"""The sales fact: one row an order line, money allocated to the cent, keys as of the order's time."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import columns as c
from tidemark.operators import allocate, dimensions, scd2
from tidemark.operators.current import latest

MONEY = "decimal(18,2)"


def _newest(df: DataFrame, key: str, *kept: str) -> DataFrame:
    order = [F.col("updated_at").desc_nulls_last(), F.col(key).desc_nulls_last()]
    return latest(df, ["order_id"], order).select("order_id", *kept)


def sales(t: Mapping[str, DataFrame], d: Mapping[str, DataFrame]) -> DataFrame:
    """The fact from source tables t and the four versioned dimensions d."""
    o = t["orders"].select(
        "order_id", "order_number", F.col("customer_id").alias("source_customer_id"), "order_status", "shipping_address_snapshot", "billing_address_snapshot", "shipping_amount",
        F.col("discount_amount").alias("_header_discount"), F.col("created_at").alias("_ordered_at"),
    )
    i = t["order_items"].select("order_id", "order_item_id", "shop_id", "product_variant_id", "currency", "quantity", "unit_price", "tax_amount", F.col("discount_amount").alias("line_discount_amount"))
    f = i.join(o, "order_id", "left")
    f = f.withColumn("gross_sales_amount", (F.col("quantity") * F.col("unit_price")).cast(MONEY))
    f = f.withColumns({n: F.coalesce(F.col(n), F.lit(0)).cast(MONEY) for n in ("_header_discount", "shipping_amount", "line_discount_amount", "tax_amount")})
    f = allocate.with_discounts(f, "order_id", "order_item_id", "gross_sales_amount", "line_discount_amount", "_header_discount", "shipping_amount", "tax_amount")
    pay, ship = _newest(t["payments"], "payment_id", "payment_method", F.col("payment_status").alias("_paid")), _newest(t["shipments"], "shipment_id", "carrier", "shipment_status")  # type: ignore[arg-type]
    promo = dimensions.promotions(t["order_vouchers"], t["vouchers"]).select("order_id", "promotion_key")
    f = f.join(pay, "order_id", "left").join(ship, "order_id", "left").join(promo, "order_id", "left")
    at = F.col("_ordered_at")
    f = scd2.lookup(f, d["dim_customer"], F.col("source_customer_id"), at, "customer_key", "customer_key", "source_customer_id")
    product = d["dim_product"].select("source_product_variant_id", "product_key", "effective_from", "effective_to")
    f = scd2.lookup(f, product, F.col("product_variant_id"), at, "product_key", "product_key", "source_product_variant_id")
    category_of = d["dim_product"].select(F.col("product_key").alias("_pk"), F.col("source_category_id").alias("_category"))
    first = latest(d["dim_product"], ["source_product_variant_id"], [F.col("effective_from"), F.col("product_key")]).select(F.col("source_product_variant_id").alias("_variant"), F.col("source_category_id").alias("_first_category"))
    f = f.join(category_of, F.col("product_key") == F.col("_pk"), "left").join(first, F.col("product_variant_id") == F.col("_variant"), "left")
    f = f.withColumn("source_category_id", F.coalesce("_category", "_first_category"))
    f = scd2.lookup(f, d["dim_shop"], F.col("shop_id"), at, "shop_key", "shop_key", "source_shop_id")
    category = d["dim_category"].select(F.col("source_category_id").alias("_source_category"), "category_key", "effective_from", "effective_to")
    f = scd2.lookup(f, category, F.col("source_category_id"), at, "category_key", "category_key", "_source_category")
    content = lambda *p: F.when(c.any_of(F.col(x).isNotNull() for x in p), c.surrogate_key(c.natural_hash(*[F.col(x) for x in p]))).otherwise(F.lit(0))
    place = lambda s: F.when(F.col(s).isNull(), F.lit(0)).otherwise(c.surrogate_key(dimensions.address_hash(F.col(s))))
    return f.select(
        c.surrogate_key(F.col("order_id"), F.col("order_item_id")).alias("sales_key"), F.col("order_id").alias("source_order_id"), F.col("order_item_id").alias("source_order_item_id"), "order_number", "order_status",
        F.coalesce(c.date_key(at), F.lit(0)).alias("order_date_key"), F.coalesce(c.time_key(at), F.lit(0)).alias("order_time_key"), "customer_key", "product_key", "shop_key", "category_key",
        place("shipping_address_snapshot").alias("ship_to_location_key"), place("billing_address_snapshot").alias("bill_to_location_key"), F.coalesce("promotion_key", F.lit(0)).alias("promotion_key"),
        content("payment_method", "_paid").alias("payment_key"), content("carrier", "shipment_status").alias("shipping_key"), "source_category_id", "currency", "quantity",
        F.col("unit_price").cast(MONEY).alias("unit_price_amount"), "gross_sales_amount", "line_discount_amount", F.col("order_discount_allocated").alias("order_discount_amount_allocated"),
        F.col("total_discount").alias("total_discount_amount"), "tax_amount", F.col("shipping_allocated").alias("shipping_amount_allocated"), F.col("net").alias("net_sales_amount"),
    )
