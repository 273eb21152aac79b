"""N-gram Jaccard join by a MinHash LSH forest with exact verification.

1. Texts with the same set of shingles are one node (copies are counted, not
   expanded). Every node has a signature: TREES paths of DEPTH minima.
2. A tree's trie is its paths in order: one range-partitioned sort of all trees'
   paths lays out all tries, and a trie node at depth d is a run of neighbours
   that share a prefix of length d. In one pass every leaf is linked to the leaf
   before it and to the first leaf of each run it lies in, never in pairs; runs
   that cross a partition's border are joined through their first leaves there.
3. Links are scored by the share of equal minima; those far from similar are
   dropped. Prefixes count from DEPTH on and are shortened until
   1 - (1 - s^d)^TREES, the chance that two texts of similarity s meet in some
   tree, reaches the target recall for the least similarity that the links found
   so far show (less three deviations, and never below the threshold): data of
   close copies only need no short prefixes, others go down to the threshold's.
4. Connected links are clusters. Inside a cluster, every pair of nodes is
   verified by exact Jaccard. A cluster larger than BLOCK nodes or PACK
   shingles is dealt into blocks, and each pair of blocks is a group of its
   own, so no task gets a whole hot cluster. Pairs are counted where they are
   found and not emitted.
5. Classes are connected components of the verified links.

Cases: a null or empty text has no shingles: it takes part in no link and is
its own class (its id). Very long texts are shingled whole, in slices. Ties:
the class id is the smallest doc_id of the class; null ids count only if there
is no other. Rows with a repeated or null id are separate documents, told apart
by their texts; a row with the same id and text as another is its copy. Other
columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import common
from tidemark.llm.shingles import MinHash, shingles

THRESHOLD, RECALL = 0.8, 0.9995
TREES, DEPTH, SEED = 16, 6, 5
#: Least share of equal minima for a star link to make a cluster. At a similarity of 0.8 the share lies 6 deviations above.
NEAR = 0.55
BLOCK, PACK = 128, 400_000
#: Leaves that one step of the pass over a trie looks at.
LEAVES = 16_384


def enough(similarity: float, recall: float = RECALL, trees: int = TREES, depth: int = DEPTH) -> int:
    """The longest prefix at which two texts of this similarity meet in some tree with the target recall (1, if none does)."""
    return next((d for d in range(depth, 1, -1) if 1 - (1 - similarity**d) ** trees >= recall), 1)


def _key(values: np.ndarray) -> int:
    """A 63-bit key of a set of shingles."""
    import xxhash

    return xxhash.xxh3_64_intdigest(values.tobytes()) >> 1


def signatures(docs: DataFrame) -> DataFrame:
    """doc_id, h (a hash of the text), k (key of the set of shingles), n (their number), sig (minima, tree by tree, 4 bytes each) for every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        minima = MinHash(TREES * DEPTH, SEED)
        for part, texts in common.text_chunks(batches, "text"):
            sets = [shingles(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0), part.column(2), pa.array([_key(s) for s in sets], pa.int64()), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([minima(s).tobytes() if len(s) else b"" for s in sets], pa.binary()),
                ],
                names=["doc_id", "h", "k", "n", "sig"],
            )

    common.tune(docs.sparkSession)
    return docs.select("doc_id", "text", F.xxhash64("text").alias("h")).mapInArrow(run, "doc_id long, h long, k long, n long, sig binary")


def _leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Paths (rows of whole numbers: the tree, then the minima) and keys of a partition's leaves, LEAVES or so at a time."""

    def joined(held: list[pa.RecordBatch]) -> tuple[np.ndarray, np.ndarray]:
        t = pa.Table.from_batches(held)
        paths = np.frombuffer(b"".join(t.column("path").to_pylist()), ">u4").reshape(-1, DEPTH + 1)
        return paths, t.column("k").to_numpy()

    held, rows = [], 0
    for b in batches:
        if b.num_rows:
            held.append(b)
            rows += b.num_rows
        if rows >= LEAVES:
            yield joined(held)
            held, rows = [], 0
    if held:
        yield joined(held)


def _walker(least: int):  # noqa: ANN202
    """Links of the sorted leaves of a partition: (a, b, depth) for the leaf before and for the first leaf of each run of depth `least` or more; and the first leaf of the runs at the partition's ends, with their prefix."""
    looked = range(least, DEPTH + 1)

    def rows(a: np.ndarray, b: np.ndarray, d: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(d, pa.int32()), pa.nulls(len(a), pa.binary())], names=["a", "b", "depth", "prefix"])

    def ends(path: np.ndarray, heads: dict[int, int]) -> pa.RecordBatch:
        prefix = [path[: d + 1].tobytes() for d in looked]
        return pa.RecordBatch.from_arrays([pa.array([heads[d] for d in looked], pa.int64()), pa.nulls(len(prefix), pa.int64()), pa.array(list(looked), pa.int32()), pa.array(prefix, pa.binary())], names=["a", "b", "depth", "prefix"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, before, heads = None, 0, {}
        for paths, keys in _leaves(batches):
            if last is None:
                last, before, heads = paths[0], int(keys[0]), {d: int(keys[0]) for d in looked}
                yield ends(last, heads)
            same = np.cumprod(paths == np.vstack([last[None, :], paths[:-1]]), axis=1).sum(1) - 1  # minima shared with the leaf before (-1: another tree)
            previous = np.append(before, keys[:-1])
            met = same >= least
            yield rows(keys[met], previous[met], same[met])
            for d in looked:
                at = np.where(same < d, np.arange(len(keys)), -1)
                at = np.maximum.accumulate(at)
                first = np.where(at >= 0, keys[np.maximum(at, 0)], heads[d])
                met = (same >= d) & (first != previous)
                yield rows(keys[met], first[met], np.full(int(met.sum()), d))
                heads[d] = int(first[-1])
            last, before = paths[-1], int(keys[-1])
        if last is not None:
            yield ends(last, heads)

    return run


def _links(nodes: DataFrame, threshold: float, recall: float) -> DataFrame:
    """Links (a, b) of near nodes that meet in some trie, at prefixes as short as the data need."""
    least = enough(threshold, recall)
    rows = nodes.select("k", "sig", F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree"))
    number = F.unhex(F.lpad(F.hex(F.col("tree")), 8, "0"))
    leaves = rows.select("k", F.concat(number, F.substring(F.col("sig"), F.col("tree") * (DEPTH * 4) + 1, F.lit(DEPTH * 4))).alias("path"))
    walked = leaves.repartitionByRange("path", "k").sortWithinPartitions("path", "k").mapInArrow(_walker(least), "a long, b long, depth int, prefix binary")
    walked = common.settle(walked, "walked")
    # the ends of partitions: a few rows each
    border = walked.where("prefix is not null").select("a", "depth", "prefix")
    heads = border.groupBy("depth", "prefix").agg(F.min("a").alias("b"))
    inside = walked.where("prefix is null").select("a", "b", "depth")
    links = inside.unionByName(border.join(heads, ["depth", "prefix"]).select("a", "b", "depth")).where("a <> b")
    links = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"), "depth").groupBy("a", "b").agg(F.max("depth").alias("depth"))
    scored = common.settle(_scored(links, nodes), "scored").where(F.col("alike") >= NEAR)
    deviation = 3 * (threshold * (1 - threshold) / (TREES * DEPTH)) ** 0.5
    found = {r.depth: r.least for r in scored.where(F.col("alike") >= threshold - deviation).groupBy("depth").agg(F.min("alike").alias("least")).collect()}  # a row a depth
    d = DEPTH
    while d > least and (shown := [s for at, s in found.items() if at >= d]) and enough(max(threshold, min(shown) - deviation), recall) < d:
        d -= 1
    return scored.where(F.col("depth") >= d).select("a", "b")


def _alike(a, b):  # noqa: ANN001, ANN202
    import pandas as pd

    return pd.Series([float(np.mean(np.frombuffer(x, np.uint32) == np.frombuffer(y, np.uint32))) for x, y in zip(a, b, strict=True)], dtype=float)


def _scored(links: DataFrame, nodes: DataFrame) -> DataFrame:
    """links with alike, the share of equal minima."""
    sigs = nodes.select(F.col("k"), "sig")
    both = links.join(sigs.toDF("a", "sig_a"), "a").join(sigs.toDF("b", "sig_b"), "b")
    alike = F.pandas_udf(_alike, "double")  # type: ignore[call-overload]
    return both.select("a", "b", "depth", alike("sig_a", "sig_b").alias("alike"))


def verify(keys: np.ndarray, sets: list[np.ndarray], copies: np.ndarray, side: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Links of each node (to other nodes, to documents) and its smallest connected key. Pairs are those of different sides, or all if there is one side."""
    n = len(sets)
    sizes = np.array([len(s) for s in sets])
    values = np.concatenate(sets)
    owner = np.repeat(np.arange(n), sizes)
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    first = np.append(True, values[1:] != values[:-1])
    column = np.cumsum(first) - 1
    shared = np.bincount(column)[column] > 1
    owner, column = owner[shared], column[shared]
    common_counts = np.zeros((n, n), np.float32)
    if len(column):
        column = np.cumsum(np.append(True, column[1:] != column[:-1])) - 1
        width = 8192
        cuts = np.searchsorted(column, np.arange(0, column[-1] + 1 + width, width))
        for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
            m = np.zeros((n, width), np.float32)
            m[owner[lo:hi], column[lo:hi] % width] = 1
            common_counts += m @ m.T
    union = sizes[:, None] + sizes[None, :] - common_counts
    linked = common_counts >= threshold * union - 1e-6
    np.fill_diagonal(linked, False)
    if side.any() and not side.all():
        linked &= side[:, None] != side[None, :]
    root = keys.copy()
    while True:
        best = np.where(linked, root[None, :], np.iinfo(np.int64).max).min(1, initial=np.iinfo(np.int64).max)
        new = np.minimum(root, best)
        if (new == root).all():
            break
        root = new
    return linked.sum(1), linked @ copies, root


def _verified(threshold: float):  # noqa: ANN202
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, t in common.sorted_groups(batches, "grp"):
            keys = t.column("k").to_numpy()
            once = np.unique(keys, return_index=True)[1]
            keys = keys[once]
            packed = t.column("set").to_pylist()
            sets = [np.frombuffer(packed[i], np.uint64) for i in once]
            side, copies = t.column("side").to_numpy()[once], t.column("copies").to_numpy()[once]
            if len(keys) < 2:
                texts, docs, root = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64), keys
            else:
                texts, docs, root = verify(keys, sets, copies, side, threshold)
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(root), pa.array(texts.astype(np.int64)), pa.array(docs.astype(np.int64)), t.column("blocks").combine_chunks().take(pa.array(once))], names=["k", "root", "texts", "docs", "blocks"])

    return run


def _sets(rows: DataFrame) -> DataFrame:
    """The packed shingles of each row's text."""
    fields = rows.drop("text").schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in common.text_chunks(batches, "text"):
            yield pa.RecordBatch.from_arrays([*[part.column(part.schema.get_field_index(f.name)) for f in fields], pa.array([shingles(t).tobytes() for t in texts], pa.binary())], names=[*[f.name for f in fields], "set"])

    return rows.mapInArrow(run, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in fields) + ", set binary")


def _distinct_ids(signed: DataFrame) -> bool:
    """Whether no two rows have the same id (null is one). It only picks the plan: the way for repeated ids gives the same result on unique ones."""
    rows, ids = signed.agg(F.count("*"), F.countDistinct(F.struct("doc_id"))).first()
    return rows == ids


def _texts_of(docs: DataFrame, asked: DataFrame, unique: bool) -> DataFrame:
    """asked(first_id, first_h, ...) with the text of a document of this id and hash, one for each row asked for."""
    own = docs.select("doc_id", "text")
    if unique:
        return own.join(asked, own.doc_id.eqNullSafe(asked.first_id)).drop("doc_id")
    hashed = own.withColumn("_h", F.xxhash64("text"))
    found = hashed.join(asked, hashed.doc_id.eqNullSafe(asked.first_id) & (F.col("_h") == asked.first_h)).drop("doc_id", "_h")
    return found.dropDuplicates(["k"])


def _classes(docs: DataFrame, threshold: float, recall: float) -> tuple[DataFrame, DataFrame, bool]:
    """Every row's doc_id and k (null without shingles); every node's k, root, first_id, first_h, links and texts; and whether ids are distinct."""
    if threshold < THRESHOLD:
        raise ValueError(f"the filter on signatures is set for thresholds of {THRESHOLD} and more")
    signed = common.settle(signatures(docs), "signed")
    unique = _distinct_ids(signed)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("z"), "doc_id", "h")).alias("_first")
    nodes = signed.where("n > 0").groupBy("k").agg(first, F.count("*").alias("copies"), F.first("n").alias("n"), F.first("sig").alias("sig"))
    nodes = common.settle(nodes.select("k", F.col("_first.doc_id").alias("first_id"), F.col("_first.h").alias("first_h"), "copies", "n", "sig"), "nodes")
    member = common.components(_links(nodes, threshold, recall))  # node, root
    member = common.settle(member, "members")

    packs = member.join(nodes.select("k", "n"), member.node == nodes.k).groupBy("root").agg(F.count("*").alias("size"), F.sum("n").alias("total"))
    blocks = F.greatest(F.ceil(F.col("size") / BLOCK), F.ceil(F.col("total") / PACK)).cast("int")
    packs = packs.select(F.col("root").alias("_root"), F.when((F.col("size") <= BLOCK) & (F.col("total") <= PACK), 1).otherwise(F.greatest(blocks, F.lit(2))).alias("blocks"))
    dealt = member.join(packs, member.root == packs._root).drop("_root")
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("node", F.lit(SEED)), F.col("blocks")).cast("int"))
    info = dealt.join(nodes.select("k", "first_id", "first_h", "copies"), dealt.node == nodes.k).select("k", "first_id", "first_h", "copies", "root", "blocks", "block")
    found = _texts_of(docs, info, unique).select("k", "copies", "root", "blocks", "block", "text")
    sets = _sets(found)
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    low, high = F.least("block", "other"), F.greatest("block", "other")
    # a cluster's pairs of blocks are numbered and dealt to the tasks in turn, so no task gets several by chance
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    number = (high.cast("long") * (high + 1) / 2).cast("long") + low
    place = F.pmod(F.pmod(F.xxhash64("root"), F.lit(tasks)) + number, F.lit(tasks)).cast("int")
    pairs = sets.select("*", other).select("k", "copies", "blocks", "set", F.xxhash64("root", low, high).alias("grp"), ((F.col("block") != F.col("other")) & (F.col("block") > F.col("other"))).alias("side"), place.alias("place"))
    checked = pairs.repartitionById(tasks, "place").drop("place").sortWithinPartitions("grp").mapInArrow(_verified(threshold), "k long, root long, texts long, docs long, blocks int")
    checked = common.settle(checked, "checked")

    roots = checked.where("blocks = 1").select("k", "root")
    spread = common.components(checked.where("blocks > 1").select(F.col("k").alias("a"), F.col("root").alias("b")))
    roots = roots.union(spread.select("node", "root"))
    counts = checked.groupBy("k").agg(F.sum("texts").alias("texts"), F.sum("docs").alias("docs"))
    state = nodes.select("k", "first_id", "first_h", "copies").join(counts, "k", "left").join(roots.withColumnRenamed("root", "_root"), "k", "left")
    links = F.coalesce("docs", F.lit(0)) + F.col("copies") - 1
    state = common.settle(state.select("k", "first_id", "first_h", F.coalesce("_root", "k").alias("root"), links.alias("links"), F.coalesce("texts", F.lit(0)).alias("texts")), "state")
    return signed.select("doc_id", F.when(F.col("n") > 0, F.col("k")).alias("k")), state, unique


def join(docs: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """doc_id, class_id, links (documents at or above the threshold, copies counted) and texts (different texts among them) for every row of docs(doc_id, text)."""
    rows, state, _ = _classes(docs, threshold, recall)
    names = state.groupBy("root").agg(F.min("first_id").alias("class_id")).withColumnRenamed("root", "_root")
    named = state.join(names, state.root == names._root).select(F.col("k").alias("_k"), "class_id", "links", "texts")
    return rows.join(named, rows.k == named._k, "left").select(
        "doc_id", F.when(F.col("_k").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"), F.coalesce("links", F.lit(0)).cast("long").alias("links"), F.coalesce("texts", F.lit(0)).cast("long").alias("texts")
    )


def one_of_each(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """docs with one row of each class: that of the smallest id (null ids last), of equal ids the one of the smaller hash of its text. Rows without words all stay."""
    _, state, unique = _classes(docs, threshold, RECALL)
    first = F.min(F.struct(F.col("first_id").isNull().alias("z"), "first_id", "first_h")).alias("_first")
    kept = state.groupBy("root").agg(first).select(F.col("_first.first_id").alias("_id"), F.col("_first.first_h").alias("_h"))
    said = F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    rows = docs.withColumn("_own", F.xxhash64("text"))
    chosen = rows.where(said).join(kept, rows.doc_id.eqNullSafe(kept._id) & (rows._own == kept._h), "left_semi")
    if not unique:
        chosen = chosen.dropDuplicates(["doc_id", "_own"])
    return chosen.unionByName(rows.where(~said)).drop("_own")


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of documents that share at least 0.8 of their five-word shingles, and each document's number of links."""
    return join(common.read(spark, sf_dir, "documents").select("doc_id", "text"))
