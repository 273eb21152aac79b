"""Sharding by a permutation-filled lookup table.

Main path: DataFrame functions only, no shuffle. Every shard has its own
order of preference over the slots of a table of prime size: slot (offset +
j * skip) mod size for j = 0, 1, ... with offset and skip hashed from the
shard's name, a permutation because the size is prime. Shards take turns; in
its turn a shard claims its next preferred slot that is still free, until the
table is full. So shares differ by one slot at most, and adding or removing a
shard moves few slots between the others. The table has a fixed size, set by
a parameter and not by the data, and is broadcast; placing a row is one hash
and one probe.

Cases: a null key hashes like ''. Equal keys (repeated rows) go to one shard.
A column named like a result column is replaced (the key's too, once it is hashed). An empty table gives an
empty result.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import common

SLOTS, SHARDS = 16_381, 64
#: The broadcast table may have so many slots at most (4 bytes each, and the key).
MOST_SLOTS = 1_000_003


def _hash(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def table(shards: Sequence[str], slots: int = SLOTS) -> list[int]:
    """The shard (an index) of every slot. The work is bounded by the parameters; no data is seen."""
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shards must be distinct, one at least")
    if slots > MOST_SLOTS or slots < len(shards) or any(slots % p == 0 for p in range(2, int(slots**0.5) + 1)):
        raise ValueError(f"slots must be a prime from {len(shards)} to {MOST_SLOTS}")
    skip = [_hash(f"skip|{s}") % (slots - 1) + 1 for s in shards]
    at = [_hash(f"offset|{s}") % slots for s in shards]
    owner, free = [-1] * slots, slots
    while free:
        for i in range(len(shards)):
            while owner[at[i]] >= 0:
                at[i] = (at[i] + skip[i]) % slots
            owner[at[i]] = i
            free -= 1
            if not free:
                break
    return owner


def slot(key: Column, slots: int = SLOTS) -> Column:
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")))
    return (F.conv(F.substring(digest, 1, 15), 16, 10).cast("long") % slots).cast("int")


def place(df: DataFrame, key: str, shards: Sequence[str], slots: int = SLOTS) -> DataFrame:
    """The table with slot and shard (an index into shards)."""
    owner = json.dumps(table(shards, slots))
    lookup = df.sparkSession.range(1).select(F.posexplode(F.from_json(F.lit(owner), "array<int>")).alias("slot", "shard"))
    rest = [c for c in df.columns if c not in ("slot", "shard")]
    rows = df.withColumn("_slot", slot(F.col(key), slots)).select(*rest, F.col("_slot").alias("slot"))
    return rows.join(F.broadcast(lookup), "slot", "left").select(*rest, "slot", "shard")


def write(df: DataFrame, key: str, shards: Sequence[str], path: str, slots: int = SLOTS) -> None:
    """Parquet files below path, a folder for each shard. Rows are dealt by (shard, salt), so a task holds a part of one shard."""
    placed = place(df, key, shards, slots)
    placed.repartition("shard", F.col("slot") % 16).write.partitionBy("shard").parquet(path)


def names(n: int = SHARDS) -> list[str]:
    return [f"shard-{i:05d}" for i in range(n)]


def op7_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The slot and shard of every document."""
    docs = common.read(spark, sf_dir, "documents").select("doc_id")
    return place(docs, "doc_id", names()).select("doc_id", "slot", "shard")


def oracle_sql() -> str:
    return f"""
WITH t AS (SELECT {json.dumps(table(names()))} AS owner),
d AS (SELECT doc_id, CAST(CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) % {SLOTS} AS INTEGER) AS slot FROM documents)
SELECT doc_id, slot, CAST(owner[slot + 1] AS INTEGER) AS shard FROM d, t
"""
