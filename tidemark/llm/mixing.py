"""Mixing sources to target weights by Pareto order sampling.

Main path: DataFrame functions only. A source's target is its share of the
mix, at most 2 times its size. Whole copies that the target holds are certain
for every document; the rest is a fixed-size sample: documents are ranked by
(u / (1 - u)) / (p / (1 - p)), their random odds divided by their inclusion
odds, and the head of that order is taken until its words meet the rest of the
target. u is a keyed hash of the document's id, so reruns agree. Inclusion
odds fall with size (by a power, `tilt`), so very long documents do not make a
small sample miss its target; they are normalised, so that a source's add up to
the documents wanted of it, and a document whose odds so come to certainty
stands before all others.

The text is read once; what follows works on (id, source, size). The head of
the order is found without sorting a source in one task: sums by (source, bin
of the order's value) are pre-aggregated, the bin that holds the cut is found
from those sums, and only that bin's documents are put in order. Bins are
small whatever the source's share of all rows (1 / BINS of it). The targets are
found from one row a source and settled.

Cases: a null or empty text has size 0; such documents are taken as a whole
(0 words) like any other. A null source is a source of its own, last in order;
'' is another. Null ids hash as the digest of their text. Repeated rows are
separate documents with equal ranks; of equal ranks any may fall inside the
cut, and which does not change the multiset of results. A table with no words
has targets 0. An empty table gives an empty result. Other columns pass
through, whatever their names (but for the result's).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm import common

WEIGHTS = (3, 1, 2)
TOTAL, CAP = 1.5, 2.0
SEED, TILT = 17, 0.25
BINS = 4096
WORD = r"[^\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sources: DataFrame, weights: tuple[float, ...] = WEIGHTS, total: float = TOTAL, cap: float = CAP) -> DataFrame:
    """sources(source, source_size, docs) with target: total of all sizes shared by weight, stopped at cap times the source's size, the excess reshared.

    The fixed point of resharing is min(cap * size, weight * t) for the t that
    spends the total; sources in order of cap * size / weight fill up one after
    another, so two running sums over the sources find it. One row a source.
    """
    everything = Window.partitionBy(F.lit(0))
    n = F.row_number().over(everything.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (n % len(weights) + 1).cast("int"))
    s = sources.withColumn("weight", weight).withColumn("cap", F.col("source_size") * cap).withColumn("at", F.col("cap") / F.col("weight"))
    order = everything.orderBy("at", F.col("source").asc_nulls_last())
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    whole = everything.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    s = s.withColumn("budget", F.sum("source_size").over(whole) * total)
    s = s.withColumn("full", F.sum("cap").over(upto) + F.col("at") * (F.sum("weight").over(whole) - F.sum("weight").over(upto)) <= F.col("budget"))
    spent = F.sum(F.when(F.col("full"), F.col("cap")).otherwise(0.0)).over(whole)
    left = F.sum(F.when(F.col("full"), 0.0).otherwise(F.col("weight"))).over(whole)
    return s.withColumn("level", (F.col("budget") - spent) / F.nullif(left, F.lit(0.0))).withColumn(
        "target", F.when(F.col("full"), F.col("cap")).otherwise(F.least("cap", F.col("weight") * F.col("level")))
    ).select("source", "source_size", "docs", "target")


def _tilted(size: Column, tilt: float) -> Column:
    return F.pow(F.greatest(size, F.lit(1)).cast("double"), F.lit(-tilt))


def mix(sized: DataFrame, weights: tuple[float, ...] = WEIGHTS, total: float = TOTAL, cap: float = CAP, seed: int = SEED, tilt: float = TILT) -> DataFrame:
    """sized(source, size, u) and other columns, with source_size, target and copies (how often the mix takes the document)."""
    keep = [c for c in sized.columns if c not in ("source_size", "target", "copies")]
    sized = sized.select(*keep)
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("docs"), F.sum(_tilted(F.col("size"), tilt)).alias("tilted"))
    sources = common.settle(sources, "sources")
    goal = common.settle(targets(sources, weights, total, cap).join(sources.select(F.col("source").alias("_s"), "tilted"), F.col("source").eqNullSafe(F.col("_s"))).drop("_s"), "targets")
    few = _few(goal)
    goal = goal.select(F.col("source").alias("_source"), "source_size", F.col("docs").alias("_docs"), "target", F.col("tilted").alias("_tilted"))
    d = sized.join(F.broadcast(goal) if few else goal, F.col("source").eqNullSafe(F.col("_source")), "left").drop("_source")
    share = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    d = d.withColumn("_whole", F.floor(share + F.lit(1e-12)))
    d = d.withColumn("_part", F.greatest(share - F.col("_whole"), F.lit(0.0)))
    d = d.withColumn("_rest", F.col("target") - F.col("_whole") * F.col("source_size"))
    # inclusion probabilities fall with size and add up to the documents wanted of the source
    p = F.col("_part") * F.col("_docs") * _tilted(F.col("size"), tilt) / F.col("_tilted")
    odds = F.col("u") / (1 - F.col("u"))
    d = d.withColumn("_p", p).withColumn("_rank", F.when(F.col("_p") >= 1, F.col("u") - 1).when(F.col("_p") > 0, odds * (1 - F.col("_p")) / F.col("_p")).otherwise(odds))
    spread = F.when(F.col("_rank") < 0, F.col("_rank")).otherwise(F.col("_rank") / (F.col("_rank") + 1))  # the cut lies near rank 1
    d = d.withColumn("_bin", F.floor(spread * BINS))
    sums = d.groupBy("source", "_bin").agg(F.sum("size").alias("_bin_size"), F.first("_rest").alias("_rest"))
    before = F.sum("_bin_size").over(Window.partitionBy("source").orderBy("_bin").rowsBetween(Window.unboundedPreceding, 0)) - F.col("_bin_size")
    sums = sums.withColumn("_before", before).withColumn("_cut", (F.col("_before") + F.col("_bin_size") > F.col("_rest")) & (F.col("_before") <= F.col("_rest")))
    first_cut = sums.where("_cut").groupBy("source").agg(F.min("_bin").alias("_cut_bin"), F.min_by("_before", "_bin").alias("_cut_before")).withColumnRenamed("source", "_source")
    d = d.join(F.broadcast(first_cut) if few else first_cut, F.col("source").eqNullSafe(F.col("_source")), "left").drop("_source")
    inside = F.col("_bin") == F.col("_cut_bin")
    head = d.where(~F.coalesce(inside, F.lit(False))).withColumn("_extra", F.when(F.col("_cut_bin").isNull() | (F.col("_bin") < F.col("_cut_bin")), 1).otherwise(0))
    run = Window.partitionBy("source").orderBy("_rank", "size").rowsBetween(Window.unboundedPreceding, 0)
    middle = F.col("_cut_before") + F.sum("size").over(run) - F.col("size") / 2.0
    tail = d.where(inside).withColumn("_extra", F.when(middle <= F.col("_rest"), 1).otherwise(0))
    extra = F.when(F.col("_part") > 0, F.col("_extra")).otherwise(0)
    return head.unionByName(tail).select(*keep, "source_size", "target", (F.col("_whole") + extra).cast("long").alias("copies"))


def _few(goal: DataFrame, most: int = 10_000) -> bool:
    """Whether the table of sources is proven small enough to broadcast; else Spark picks the join."""
    return goal.limit(most + 1).count() <= most


def draw(key: Column, text: Column, seed: int = SEED) -> Column:
    """A document's random number: of its id, or of its text where that is null."""
    return common.uniform(seed, F.coalesce(key.cast("string"), F.md5(F.coalesce(text, F.lit("")))))


def sized(df: DataFrame, key: str, seed: int = SEED) -> DataFrame:
    return df.select(F.col(key), F.col("source"), words(F.col("text")).alias("size"), draw(F.col(key), F.col("text"), seed).alias("u"))


def op3_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix of all documents: sources weigh 3, 1, 2, repeating, and share 150% of all words, none above 2 times its own."""
    docs = common.settle(sized(common.read(spark, sf_dir, "documents"), "doc_id"), "sizes")
    m = mix(docs)
    return m.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


ORACLE_SQL = f"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size,
         (CAST('0x' || substr(md5('{SEED}|' || coalesce(CAST(doc_id AS VARCHAR), md5(coalesce(text, '')))), 1, 13) AS BIGINT) + 0.5) / 4503599627370496.0::DOUBLE AS u
  FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, count(*) AS docs, sum(pow(CAST(greatest(size, 1) AS DOUBLE), -{TILT}::DOUBLE)) AS tilted FROM d GROUP BY source),
w AS (
  SELECT *, [3.0::DOUBLE, 1.0::DOUBLE, 2.0::DOUBLE][(row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1] AS weight, source_size * 2.0::DOUBLE AS cap FROM s),
f AS (
  SELECT *, sum(cap) OVER o + (cap / weight) * (sum(weight) OVER () - sum(weight) OVER o) <= sum(source_size) OVER () * 1.5::DOUBLE AS is_full,
         CAST(sum(source_size) OVER () AS DOUBLE) * 1.5::DOUBLE AS budget
  FROM w WINDOW o AS (ORDER BY cap / weight, source ASC NULLS LAST ROWS UNBOUNDED PRECEDING)),
g AS (
  SELECT source, source_size, docs, tilted, CASE WHEN is_full THEN cap ELSE least(cap, weight * ((budget - sum(CASE WHEN is_full THEN cap ELSE 0 END) OVER ())
         / nullif(sum(CASE WHEN is_full THEN 0 ELSE weight END) OVER (), 0))) END AS target FROM f),
h AS (
  SELECT d.*, g.source_size, g.target, g.docs, g.tilted, CASE WHEN g.source_size > 0 THEN floor(g.target / g.source_size + 1e-12::DOUBLE) ELSE 0 END AS whole
  FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source),
p AS (
  SELECT *, greatest(CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END - whole, 0) * docs * pow(CAST(greatest(size, 1) AS DOUBLE), -{TILT}::DOUBLE) / tilted AS p FROM h),
r AS (
  SELECT *, CASE WHEN p >= 1 THEN u - 1 WHEN p > 0 THEN (u / (1 - u)) * (1 - p) / p ELSE u / (1 - u) END AS rank FROM p),
t AS (
  SELECT *, sum(size) OVER (PARTITION BY source ORDER BY rank, size ROWS UNBOUNDED PRECEDING) - size / 2.0::DOUBLE AS middle FROM r)
SELECT doc_id, size, source_size, target,
       CAST((whole + CASE WHEN source_size > 0 AND target / source_size - whole > 0 AND middle <= target - whole * source_size THEN 1 ELSE 0 END) * size AS BIGINT) AS taken
FROM t
"""
