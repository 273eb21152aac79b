"""Search, mixing and sharding against brute force, and the pipeline."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import ann, common, mixing, sharding

SF = "/root/testdata/sf0.001"


def test_components(spark):
    r = random.Random(1)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(1000, 1060)] + [(5, 5)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    got = {(x.node, x.root) for x in common.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {(x, root(x)) for a, b in edges if a != b for x in (a, b)}
    assert got == want
    assert common.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_components_of_a_hub(spark, monkeypatch):
    """A node with more edges than one task may join: the same components."""
    monkeypatch.setattr(common, "LIGHT", 4)
    monkeypatch.setattr(common, "SHARE", 50)
    r = random.Random(2)
    edges = [(0, i) for i in range(1, 400)] + [(i, i + 1000) for i in range(1, 400, 2)] + [(5000 + i, 5001 + i) for i in range(30)] + [(9000, 9000 + r.randrange(1, 90)) for _ in range(300)]
    got = {(x.node, x.root) for x in common.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {(x, 0 if x < 5000 else 5000 if x < 9000 else 9000) for e in edges for x in e}
    assert got == want


def test_components_plan_few_scans(spark, monkeypatch):
    """The driver holds a round's plans in its memory: each reads a few tables, however long a chain; no star is planned again wherever the next reads it."""
    scans, settle = [], common.settle

    def counted(df, name, *rest):
        scans.append(df._jdf.queryExecution().optimizedPlan().collectLeaves().size())
        return settle(df, name, *rest)

    monkeypatch.setattr(common, "settle", counted)
    monkeypatch.setattr(common, "LIGHT", 5)
    monkeypatch.setattr(common, "SHARE", 10**9)
    edges = [(i + 1, i) for i in range(40)] + [(100, i) for i in range(101, 130)] + [(100, i) for i in range(101, 110)] + [(200, 200), (-7, 300), (300, -9)]
    got = {(x.node, x.root) for x in common.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {(i, 0) for i in range(41)} | {(i, 100) for i in range(100, 130)} | {(i, -9) for i in (-9, -7, 300)}
    assert len(scans) > 3 and max(scans) <= 6


def vectors(spark):
    r = np.random.default_rng(3)
    v = r.standard_normal((1500, 64)).astype(np.float32)
    v[100:160] = v[100]
    rows = [(i, x.tolist()) for i, x in enumerate(v)]
    bad = [(2000, None), (2050, [0.0] * 64), (2100, [float("nan")] + [1.0] * 63), (2150, [None] + [1.0] * 63), (2200, [float("inf")] + [1.0] * 63), (2250, []), (None, [1.0] * 64)]
    return v.astype(float), spark.createDataFrame([(*x, 1, 9.9) for x in rows + bad], "vec_id long, embedding array<float>, rank int, score double")


@pytest.mark.parametrize("block", [ann.BLOCK, 400])
def test_search_recall(spark, block):
    v, df = vectors(spark)
    t = df.select("vec_id", F.col("embedding").cast("array<double>").alias("v")).where(F.col("vec_id").isNotNull() & ann.usable(F.col("v")))
    got = {}
    for r in ann.search(t, t.where("vec_id % 50 == 0"), block=block).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    unit = v / np.linalg.norm(v, axis=1, keepdims=True)
    hits = 0
    assert set(got) == set(range(0, 1500, 50))
    for q, found in got.items():
        s = unit @ unit[q]
        s[q] = -9
        best = np.lexsort((np.arange(len(s)), -s.round(12)))[:5]
        hits += len({f for f, _ in found} & set(best.tolist()))
        assert all(abs(score - s[i]) < 1e-9 for i, score in found) and [x[1] for x in found] == sorted((x[1] for x in found), reverse=True)
    assert hits / (5 * len(got)) >= 0.9
    assert [i for i, _ in got[100]] == [101, 102, 103, 104, 105]  # equal vectors: smaller ids first
    assert ann.search(t.limit(0), t.limit(0)).count() == 0
    assert ann.search(t.where("vec_id < 3"), t.where("vec_id = 0")).count() == 2


def test_search_by_row(spark):
    """Repeated ids ask for themselves; tiny and huge components neither end the search nor change a cosine."""
    r = np.random.default_rng(4)
    v = r.standard_normal((40, 8))
    rows = [(i, x.tolist()) for i, x in enumerate(v)] + [(50, v[1].tolist()), (50, v[2].tolist()), (50, v[2].tolist())] + [(60, (v[3] * 2.0**-660).tolist()), (61, (v[3] * 2.0**660).tolist()), (62, [5e-324] + [0.0] * 7), (63, [1.0, 2.0])]
    t = spark.createDataFrame(rows, "vec_id long, v array<double>").where(ann.usable(F.col("v")))
    unit = lambda x: (y := np.array(x) / np.abs(x).max()) / np.linalg.norm(y)
    want = []
    for n, (i, x) in enumerate(rows):
        if i in (0, 50, 60, 61, 62, 63):
            s = sorted((round(-float(unit(x) @ unit(y)), 9), j) for m, (j, y) in enumerate(rows) if m != n and len(y) == len(x))
            want += [(i, k + 1, j, -c) for k, (c, j) in enumerate(s[:5])]
    got = [(x.query_id, x.rank, x.vec_id, round(x.score, 9)) for x in ann.search(t, t.where("vec_id in (0, 50, 60, 61, 62, 63)")).collect()]
    assert sorted(got) == sorted(want)


def test_search_past_a_cluster():
    """A third of the vectors lie in one tight cluster, a query's five neighbours are a little nearer than that."""
    r = np.random.default_rng(5)
    norm = lambda x: x / np.linalg.norm(x, axis=-1, keepdims=True)
    v, centre = norm(r.standard_normal((8000, 64))), norm(r.standard_normal(64))
    v[:2700] = norm(centre + 0.01 * r.standard_normal((2700, 64)))
    queries = []
    for i in range(20):
        near = r.uniform(0.3, 0.6)
        across = norm((x := r.standard_normal(64)) - (x @ centre) * centre)
        q = near * centre + np.sqrt(1 - near**2) * across
        for j in range(5):
            c = near + r.uniform(0.05, 0.1)
            side = norm((x := r.standard_normal(64)) - (x @ q) * q)
            v[3000 + 5 * i + j] = c * q + np.sqrt(1 - c**2) * side
        queries.append(q)
    index, hits = ann.Index(np.arange(8000), v), 0
    for q in queries:
        best = np.argsort(-(v @ q))[:5].tolist()
        hits += len({i for i, _ in index.search(-1, q, 5)} & set(best))
    assert hits / 100 >= 0.98
    few = ann.Index(np.arange(9), v[:9], m=8)  # fewer directions than collisions asked for
    assert len(few.search(0, v[0], 20)) == 8


def brute_targets(sizes, weights, total, cap):
    """Resharing round by round, as worded."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    out, left, open_ = {}, total * sum(sizes.values()), set(order)
    while open_:
        share = {s: left * w[s] / sum(w[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] > cap * sizes[s]}
        if not over:
            return out | share
        for s in over:
            out[s] = cap * sizes[s]
            left -= out[s]
        open_ -= over
    return out


def test_mixing(spark):
    r = random.Random(2)
    rows = [(i, r.choice(["a", "a", "a", "b", "", None, "ä"]), " ".join(["w"] * r.choice([0, 1, 5, 20, 300]))) for i in range(4000)] + [(None, "b", None), (1, "c", "x y"), (1, "c", "x y")]
    df = spark.createDataFrame([(*x, 7, 8.0) for x in rows], "doc_id long, source string, text string, copies int, target double").withColumns({"bin": F.lit("own"), "rank": F.lit(3), "_docs": F.lit(1)})
    sized = common.settle(mixing.sized(df, "doc_id"), "sizes")
    got = mixing.mix(sized).collect()
    assert len(got) == len(rows) and sorted(map(str, got)) == sorted(map(str, mixing.mix(sized).collect()))
    sizes = {}
    for _, s, t in rows:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    want = brute_targets(sizes, mixing.WEIGHTS, 1.5, 2.0)
    for s, size in sizes.items():
        own = [x for x in got if x.source == s]
        assert all(x.source_size == size and abs(x.target - want[s]) < 1e-6 and 0 <= x.copies <= 2 for x in own)
        assert abs(sum(x.copies * x.size for x in own) - want[s]) <= 300
    for empty in (sized.limit(0), sized.where("size = 0")):
        assert all(x.target == 0 for x in mixing.mix(empty).collect())


def test_sharding(spark):
    names = sharding.names(8)
    owner = sharding.table(names, 1009)
    counts = np.bincount(owner, minlength=8)
    assert counts.max() - counts.min() <= 1
    fewer = sharding.table(names[:-1], 1009)
    moved = sum(a != b for a, b in zip(owner, fewer, strict=True) if a != 7)
    assert moved / 1009 < 0.25
    df = spark.createDataFrame([(i % 50, "x", 3) for i in range(100)] + [(None, None, None)], "doc_id long, text string, shard int")
    got = sharding.place(df, "doc_id", names, 1009).collect()
    assert len(got) == 101 and all(r.shard == owner[r.slot] for r in got) and len({(r.doc_id, r.shard) for r in got}) == 51
    assert sharding.place(df.limit(0), "doc_id", names, 1009).count() == 0
    clash = sharding.place(df.select(F.col("doc_id").alias("slot"), "shard"), "slot", names, 1009)
    assert clash.columns == ["slot", "shard"] and sorted(map(str, clash.collect())) == sorted(str(r) for r in sharding.place(df, "doc_id", names, 1009).select("slot", "shard").collect())
    for bad in (([], 7), (["a", "a"], 7), (["a"], 8), (["a", "b", "c"], 2)):
        with pytest.raises(ValueError):
            sharding.table(*bad)


def test_sharded_files(spark, tmp_path):
    df = spark.createDataFrame([(i, "x") for i in range(200)], "doc_id long, text string")
    sharding.write(df, "doc_id", sharding.names(4), f"{tmp_path}/out", 1009)
    assert spark.read.parquet(f"{tmp_path}/out").count() == 200


def test_pipeline_stages(spark):
    import corpus_pipeline as p

    from tests.llm.test_texts import base_spans, shingled

    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    stage = dict(p.STAGES)
    docs = common.read(spark, SF, "documents")
    kept = common.settle(stage["quality"](spark, docs, SF), "q")
    assert kept.columns == columns and 0 < kept.count() < docs.count()
    unique = common.settle(stage["near_copies"](spark, kept, SF), "n")
    sets = [shingled(r.text) for r in unique.collect()]
    assert not any(a and b and len(a & b) >= 0.8 * len(a | b) for i, a in enumerate(sets) for b in sets[:i])
    clean = common.settle(stage["personal_data"](spark, unique, SF), "p")
    assert clean.count() == unique.count() and all(not base_spans(r.text) and r.n_chars == len(r.text) for r in clean.collect())
    mixed = common.settle(stage["mix"](spark, clean, SF), "m")
    assert mixed.columns == columns and {r.doc_id for r in mixed.collect()} <= {r.doc_id for r in clean.collect()}
    total = clean.agg(F.sum(mixing.words(F.col("text")))).first()[0]
    assert abs(mixed.agg(F.sum(mixing.words(F.col("text")))).first()[0] / total - 1.5) < 0.15
    last = stage["pieces"](spark, mixed, SF)
    assert last.count() == mixed.count() and last.where("not lossless").count() == 0
    for name, f in p.STAGES[:4]:
        assert f(spark, docs.limit(0), SF).count() == 0, name
