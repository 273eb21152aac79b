"""The queries of this package and their SQL, by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import ann, media, mixing, neardup, pieces, pii, ppm, quality, sharding, toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        pii.op1_pii, ann.op2_ann, mixing.op3_mix, neardup.op4_jaccard_join, ppm.op5_ppm, pieces.op6_pieces,
        sharding.op7_shard, quality.op8_quality, toxicity.op9_toxicity, media.op10_media,
    )
}


def oracle_sql() -> dict[str, str]:
    return {"op3_mix": mixing.ORACLE_SQL, "op7_shard": sharding.oracle_sql()}
