"""The tables of every layer: keys, columns, attributes that make a version."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Contract:
    """A source table: its key, what the current state keeps, what only the event log keeps, what is never read, and its normal forms."""

    name: str
    key: str
    columns: tuple[str, ...]
    log_only: tuple[str, ...] = ()
    excluded: tuple[str, ...] = ()
    trim: tuple[str, ...] = ()
    lower: tuple[str, ...] = ()
    upper: tuple[str, ...] = ()
    phones: tuple[str, ...] = ()


def _c(name: str, key: str, columns: str, **more: str) -> Contract:
    return Contract(name, key, (key, *columns.split()), **{k: tuple(v.split()) for k, v in more.items()})


# The source's tables and columns.
SOURCES = {
    c.name: c
    for c in (
        _c("app_users", "user_id", "public_user_id username email first_name last_name phone_number status created_at updated_at last_login", excluded="password_hash", trim="username email first_name last_name phone_number", lower="username email status", phones="phone_number"),
        _c("user_addresses", "address_id", "user_id address_type recipient_name phone_number street ward district city state postal_code country created_at updated_at", log_only="is_default_shipping is_default_billing", trim="address_type recipient_name phone_number street ward district city state postal_code country", lower="address_type", phones="phone_number"),
        _c("shops", "shop_id", "public_shop_id shop_name shop_slug status created_at updated_at", log_only="description logo_url", trim="shop_name shop_slug", lower="status"),
        _c("categories", "category_id", "parent_category_id category_name slug is_active created_at updated_at", log_only="description", trim="category_name slug"),
        _c("products", "product_id", "public_product_id shop_id category_id product_sku product_slug product_name brand attributes_json images_json status is_featured created_at updated_at", log_only="short_description description", trim="product_sku product_slug product_name brand", lower="status", upper="product_sku"),
        _c("product_variants", "product_variant_id", "public_variant_id product_id variant_sku variant_name options_json unit_price compare_at_price currency stock_quantity reserved_quantity weight_kg images_json status is_default created_at updated_at", log_only="dimensions_json", trim="variant_sku variant_name", lower="status", upper="variant_sku currency"),
        _c("vouchers", "voucher_id", "voucher_code voucher_name shop_id discount_type discount_value max_discount_amount minimum_order_amount scope_json starts_at ends_at is_active created_at updated_at", log_only="description usage_limit used_count", trim="voucher_code voucher_name", lower="discount_type", upper="voucher_code"),
        _c("orders", "order_id", "public_order_id customer_id order_number order_status payment_status shipping_address_id billing_address_id shipping_address_snapshot billing_address_snapshot subtotal_amount shipping_amount tax_amount discount_amount total_amount currency created_at updated_at", log_only="customer_note", trim="order_number", lower="order_status payment_status", upper="currency"),
        _c("order_items", "order_item_id", "order_id shop_id product_id product_variant_id product_name_snapshot product_sku_snapshot variant_name_snapshot variant_sku_snapshot options_snapshot quantity unit_price currency tax_amount discount_amount item_subtotal item_total created_at updated_at", trim="product_name_snapshot variant_name_snapshot", upper="currency product_sku_snapshot variant_sku_snapshot"),
        _c("order_vouchers", "order_voucher_id", "order_id voucher_id discount_amount created_at updated_at"),
        _c("payments", "payment_id", "public_payment_id order_id payment_method payment_status amount currency paid_at created_at updated_at", log_only="transaction_reference", lower="payment_method payment_status", upper="currency"),
        _c("shipments", "shipment_id", "public_shipment_id order_id shipment_status carrier tracking_number shipped_at delivered_at created_at updated_at", log_only="shipping_address_snapshot", trim="carrier tracking_number", lower="shipment_status"),
    )
}

#: Attributes whose change makes a new version, in the order they are hashed.
TYPE2 = {
    "dim_customer": ("username", "email", "first_name", "last_name", "phone_number", "status"),
    "dim_shop": ("public_shop_id", "shop_name", "shop_slug", "status"),
    "dim_category": ("parent_category_id", "category_name", "slug", "parent_category_name", "is_active"),
    "dim_product": (
        "product_id", "shop_id", "category_id", "public_product_id", "public_variant_id", "product_sku", "product_slug", "product_name", "brand", "product_status", "is_featured",
        "variant_sku", "variant_name", "variant_status", "options_json", "is_default", "currency", "weight_kg", "attributes_json", "product_images_json", "variant_images_json",
    ),
}
TYPE1 = {"dim_customer": ("last_login",), "dim_product": ("unit_price", "compare_at_price", "stock_quantity", "reserved_quantity")}
ADDRESS = ("address_type", "recipient_name", "phone_number", "street", "ward", "district", "city", "state", "postal_code", "country")

# Names of the star schema's attributes, by what they are read from.
#: Attributes of a day by date part, and by pattern.
DAY = {
    "day_of_month": "DAY", "day_of_week": "DAYOFWEEK", "day_of_year": "DOY", "fiscal_quarter": "QUARTER", "fiscal_year": "YEAR", "month_number": "MONTH", "quarter_number": "QUARTER",
    "week_of_year": "WEEK", "year_number": "YEAR",
}
DAY_WORDS = {"day_name": "EEEE", "month_name": "MMMM"}
#: Attributes of a second of the day: its unit in seconds, and how many of them the next larger unit has.
CLOCK = {"hour_24": (3600, 24), "minute_number": (60, 60), "second_number": (1, 60)}
#: Sets of an order's vouchers by the voucher's column, and those that make the combination's identity.
VOUCHER_SETS = {"discount_types": "discount_type", "promotion_scope": "scope_json", "voucher_codes": "voucher_code", "voucher_names": "voucher_name"}
PROMOTION_IDENTITY = ("voucher_codes", "discount_types", "promotion_scope")
#: What the unknown member of a dimension says.
UNKNOWN = {
    "dim_date": {"day_name": "Unknown", "month_name": "Unknown", "season_name": "Unknown"}, "dim_time": {"am_pm": "NA", "day_part": "Unknown"},
    "dim_location": {"address_type": "unknown", "city": "Unknown", "country": "Unknown", "content_hash": "unknown"},
    "dim_promotion": {"natural_promotion_hash": "none", "promotion_type": "none", "voucher_count": 0, "voucher_codes": "NO_VOUCHER", "promotion_scope": "none", "is_active": False},
    "dim_payment": {"payment_method": "unknown", "payment_status": "unknown", "content_hash": "unknown", "paid_flag": False},
    "dim_shipping": {"carrier": "unknown", "shipment_status": "unknown", "content_hash": "unknown", "shipped_flag": False, "delivered_flag": False},
    "dim_shop": {"shop_name": "Unknown Shop", "status": "unknown"}, "dim_category": {"slug": "unknown", "is_active": False},
    "dim_product": {"product_name": "Unknown Product", "product_status": "unknown", "is_featured": False, "is_default": False},
}

#: What a changed source table rebuilds.
FEEDS = {
    "app_users": ("dim_customer",), "orders": ("dim_date", "dim_time", "dim_location", "fact_sales"), "user_addresses": ("dim_location",), "shops": ("dim_shop",),
    "categories": ("dim_category",), "products": ("dim_product",), "product_variants": ("dim_product",), "order_vouchers": ("dim_promotion", "fact_sales"),
    "vouchers": ("dim_promotion", "fact_sales"), "payments": ("dim_payment", "fact_sales"), "shipments": ("dim_shipping", "fact_sales"), "order_items": ("fact_sales",),
}
GOLD = ("dim_date", "dim_time", "dim_customer", "dim_product", "dim_shop", "dim_category", "dim_location", "dim_promotion", "dim_payment", "dim_shipping", "fact_sales")
