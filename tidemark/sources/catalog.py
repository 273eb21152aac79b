"""Tables by path or by name in the session's catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def is_path(target: str) -> bool:
    return "/" in target


def read(spark: SparkSession, target: str, **options: str) -> DataFrame:
    """A Parquet folder, or a table of the catalog."""
    return spark.read.options(**options).parquet(target) if is_path(target) else spark.read.options(**options).table(target)


def write(df: DataFrame, target: str, mode: str = "overwrite", path: str | None = None) -> None:
    """To a folder, or to a table of the catalog (an external one where a path is given)."""
    writer = df.write.mode(mode).format("parquet")
    if is_path(target):
        if path:
            raise ValueError("a folder has no other path")
        writer.save(target)
    else:
        (writer.option("path", path) if path else writer).saveAsTable(target)
