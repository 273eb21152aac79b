"""Shared plumbing: session settings, scratch tables on shared storage, connected components."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of one Arrow batch sent to a Python worker. Texts may be long, so few.
ARROW_ROWS = 512


def tune(spark: SparkSession) -> None:
    """Keep Arrow batches small enough for rows that hold whole documents."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir. Only on one machine, where that is unset (tests), a local one serves; a cluster without it is an error."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    return os.path.join(tempfile.gettempdir(), f"tidemark-{spark.sparkContext.applicationId}")


def settle(df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write df to the shared folder and read it back.

    This cuts lineage with files that survive the loss of any executor. They
    lie in a folder of the application, which `drop_scratch` removes.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/tidemark/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}/{name}"
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_scratch(spark: SparkSession) -> None:
    """Delete all that `settle` wrote for this application. Frames made from it can no longer be read."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/tidemark/{spark.sparkContext.applicationId}")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def crc_mod(column: Column, n: int) -> Column:
    """crc32 of the value as text, modulo n; null stays null."""
    return F.crc32(column.cast("string").cast("binary")) % F.lit(n)


def uniform(seed: int, *columns: Column) -> Column:
    """A reproducible number in (0, 1) for each row, from a keyed hash of the columns."""
    key = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(c.cast("string"), F.lit("")) for c in columns])
    return (F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("double") + F.lit(0.5)) / F.lit(float(2**52))


def text_chunks(batches: Iterator[pa.RecordBatch], column: str, limit: int = 4 << 20) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of the batches with their texts as UTF-8, at least one row each and about `limit` bytes of text; null counts as empty."""
    for batch in batches:
        if not batch.num_rows:
            continue
        index = batch.schema.get_field_index(column)
        texts = batch.column(index).cast(pa.large_binary()).to_pylist()
        start, size = 0, 0
        for i, text in enumerate(texts):
            texts[i] = text or b""
            size += len(texts[i])
            if size >= limit:
                yield batch.slice(start, i + 1 - start), texts[start : i + 1]
                start, size = i + 1, 0
        if start < len(texts):
            yield batch.slice(start), texts[start:]


def sorted_groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple[object, pa.Table]]:
    """The groups of equal key of a partition sorted by key, one at a time, across batch borders."""
    held: list[pa.RecordBatch] = []
    current: object = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(batch.schema.get_field_index(key)).to_pylist()
        start = 0
        for i, k in enumerate(keys):
            if held or i > start:
                if k != current:
                    if i > start:
                        held.append(batch.slice(start, i - start))
                    yield current, pa.Table.from_batches(held)
                    held, start, current = [], i, k
            else:
                current = k
        held.append(batch.slice(start))
    if held:
        yield current, pa.Table.from_batches(held)


#: Edges of a node that one task may join at least, and the share of all edges that it may.
LIGHT, SHARE = 256, 5000
#: Edges that a file of `components` holds at least, on average. Every file costs a list entry, a task's start and helper processes.
FILE = 16_384


def _with_least(edges: DataFrame, node: str, least: DataFrame, most: int) -> DataFrame:
    """edges(a, b) with m of their node in column `node`, from least(n, m, edges).

    Nodes of more than `most` edges are broadcast with their m: as their edges
    sum up to the table's at most, there are at most rows / most of them. All
    others are joined by key, which no task gets more than `most` rows of.
    """
    heavy, light = least.where(F.col("edges") > most).select("n", "m"), least.where(F.col("edges") <= most).select("n", "m")
    few = F.broadcast(heavy)
    on = edges[node] == few.n
    return edges.join(few, on).unionByName(edges.join(few, on, "left_anti").join(light, edges[node] == light.n)).drop("n")


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of edges(a, b) by alternating large-star and small-star rounds.

    Returns (node, root): every node of an edge with its component's smallest
    node. Every round is two aggregations and two joins on nodes; nothing is
    collected but two numbers. Each star is written by itself, so the driver
    plans a few scans at a time: one plan of both repeats the first star at
    every place where the second reads it. A hub's edges are not gathered in
    one task: its minimum is pre-aggregated and comes to them by broadcast.
    Self-loops and repeated edges are harmless; no edges give no rows.
    """

    def mark(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    # the first node of an edge is always the larger one
    edges = settle(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "edges")
    before = mark(edges)
    for _ in range(max_rounds):
        if not before[0]:
            break
        most = max(LIGHT, 2 * before[0] // SHARE)  # so SHARE nodes at most are broadcast
        files = -(-before[0] // FILE)  # no star adds edges
        ends = edges.select(F.explode(F.array(F.struct(F.col("a").alias("n"), F.col("b").alias("m")), F.struct(F.col("b").alias("n"), F.col("a").alias("m")))).alias("end"))
        least = ends.groupBy(F.col("end.n").alias("n")).agg(F.min(F.least("end.n", "end.m")).alias("m"), F.count("*").alias("edges"))
        # large star: a node's larger neighbours are linked to the least of it and all its neighbours
        large = settle(_with_least(edges, "b", least, most).select("a", F.col("m").alias("b")).distinct().coalesce(files), "large")
        least = large.groupBy(F.col("a").alias("n")).agg(F.min("b").alias("m"), F.count("*").alias("edges"))
        # small star: a node and its smaller neighbours are linked to the least of these; the node itself takes the place of the least
        linked = F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b"))
        edges = settle(_with_least(large, "a", least, most).select(linked.alias("a"), F.col("m").alias("b")).distinct().coalesce(files), "edges")
        after = mark(edges)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
