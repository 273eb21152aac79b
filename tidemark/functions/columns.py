"""Column functions: hashes, text normal forms, typing by name, keys of days and seconds."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The divisor of surrogate keys (2**63 - 1), the separator of hashed parts, the open end of an interval.
KEY_RANGE = 9223372036854775807
SEPARATOR = "||"
OPEN_END = "9999-12-31 00:00:00"
#: The seasons from December on, and the hours at which parts of the day begin.
SEASONS = ("Winter", "Spring", "Summer", "Autumn")
PARTS_OF_DAY = ((5, "morning"), (12, "afternoon"), (18, "evening"), (22, "night"))


def natural_hash(*parts: Column) -> Column:
    """SHA-256 of the parts' text; null and '' are the same part."""
    return F.sha2(F.concat_ws(SEPARATOR, *(F.coalesce(p.cast("string"), F.lit("")) for p in parts)), 256)


def surrogate_key(*parts: Column) -> Column:
    """A key from 0 to 2**63 - 2."""
    return F.pmod(F.xxhash64(F.concat_ws(SEPARATOR, *(p.cast("string") for p in parts))), F.lit(KEY_RANGE))


def record_hash(columns: Iterable[str]) -> Column:
    """SHA-256 of the row as JSON, null fields kept."""
    return F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256)


def event_hash(*parts: Column) -> Column:
    """SHA-256 of the parts that are not null."""
    return F.sha2(F.concat_ws(SEPARATOR, *(p.cast("string") for p in parts)), 256)


def trimmed(c: Column) -> Column:
    """Without blanks around it; null where nothing is left."""
    return F.nullif(F.trim(c), F.lit(""))


def phone(c: Column) -> Column:
    """Digits only, a leading + kept."""
    return F.concat(F.when(c.startswith("+"), "+").otherwise(""), F.regexp_replace(c, "[^0-9]", ""))


def optional(df: DataFrame, name: str, kind: str) -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast(kind)


def require(df: DataFrame, names: Iterable[str]) -> DataFrame:
    if missing := sorted(set(names) - set(df.columns)):
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def any_of(conditions: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a | b, (F.coalesce(c, F.lit(False)) for c in conditions), F.lit(False))


def type_of(name: str) -> str | None:
    """The type that a column's name implies."""
    if name == "weight_kg":
        return "decimal(8,3)"
    if name.endswith(("_amount", "_price")) or name == "amount" or name == "discount_value":
        return "decimal(12,2)"
    if name.endswith("_quantity") or name == "quantity" or (name.endswith("_id") and not name.startswith(("public_", "_"))):
        return "int"
    if name.endswith("_at") or name == "last_login":
        return "timestamp"
    return "boolean" if name.startswith("is_") else None


def typed(df: DataFrame) -> DataFrame:
    """Every column in the type of its name; values that don't fit become null."""
    return df.select(*[F.col(c).try_cast(t).alias(c) if (t := type_of(c)) else F.col(c) for c in df.columns])


def date_key(c: Column) -> Column:
    return F.date_format(c, "yyyyMMdd").cast("int")


def time_key(c: Column) -> Column:
    """1 to 86400; 0 is left for the unknown member."""
    return F.hour(c) * 3600 + F.minute(c) * 60 + F.second(c) + 1


def season(month: Column) -> Column:
    """Quarters of a year that begins in December."""
    return F.element_at(F.array(*map(F.lit, SEASONS)), F.floor(month % 12 / 3).cast("int") + 1)


def day_part(hour: Column) -> Column:
    """The last part that begins at the hour or before; before all, the last one."""
    begun = F.lit(PARTS_OF_DAY[-1][1])
    for start, name in PARTS_OF_DAY:
        begun = F.when(hour >= start, name).otherwise(begun)
    return begun
