"""Quality classifier: a sparse ensemble of rules over text statistics.

Statistics of a text are counts of its bytes, words and lines (one pass in
Python over Arrow batches, no state). Boosted trees are grown on a bounded
sample of labelled rows; every node of every tree is a rule, a conjunction of
comparisons; a lasso logistic regression keeps few rules and weighs them; the
kept rules are compiled to one Spark column expression. Labels, lang, source
and ids are never inputs of a score.

Cases: a null text is scored as the empty text, whose statistics are all 0.
Null labels do not train; of repeated labels of an id the smallest counts. With
no labelled rows, or one class only, the score is the smoothed share of
label 1 (0.5 without any). Rows with equal texts have equal scores. Other
columns pass through; input columns named like result columns are replaced.
An empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import common, trees

#: Labelled rows used to fit, at most: those with the smallest keyed hashes of their ids.
SAMPLE = 20_000
CUT = 0.3

_SETS = {
    "upper": bytes(range(65, 91)), "digit": b"0123456789", "stop": b".,;:?", "shout": b"!", "bar": b"|",
    "odd": b"#$%&*@^~<>{}[]\\=+_`", "quote": b"\"'()-/", "newline": b"\n", "space": b" \t\r\x0b\x0c", "lower": bytes(range(97, 123)),
}
STATS = ("chars", "words", "word_length", "longest", "distinct", "lines", "repeated_lines", "words_a_line", "ends", "short", *_SETS, "foreign")
_WEIGH = np.zeros((256, len(_SETS) + 1))
for _i, _set in enumerate(_SETS.values()):
    _WEIGH[list(_set), _i] = 1
_WEIGH[128:, -1] = 1


def statistics(text: bytes) -> list[float]:
    """The statistics of a text in the order of STATS."""
    n = len(text)
    if not n:
        return [0.0] * len(STATS)
    shares = (np.bincount(np.frombuffer(text, np.uint8), minlength=256) @ _WEIGH) / n
    words, lines = text.split(), text.split(b"\n")
    w = len(words)
    lengths = list(map(len, words)) or [0]
    return [
        float(np.log1p(n)), float(np.log1p(w)), sum(lengths) / max(w, 1), float(np.log1p(max(lengths))), len(set(words)) / max(w, 1),
        float(np.log1p(len(lines))), 1 - len(set(lines)) / len(lines), float(np.log1p(w / len(lines))), float(text.rstrip()[-1:] in (b".", b"!", b"?", b'"')),
        sum(x <= 2 for x in lengths) / max(w, 1), *shares.tolist(),
    ]


def _frame(texts):  # noqa: ANN001, ANN202
    import pandas as pd

    return pd.DataFrame([statistics(t.encode("utf-8", "replace") if t else b"") for t in texts], columns=list(STATS))


def with_statistics(df: DataFrame, text: str = "text", into: str = "stats") -> DataFrame:
    common.tune(df.sparkSession)
    kind = T.StructType([T.StructField(s, T.DoubleType()) for s in STATS])
    return df.withColumn(into, F.pandas_udf(_frame, kind)(F.col(text)))  # type: ignore[call-overload]


@dataclass(frozen=True)
class Rules:
    """score = sigmoid(base + the weights of the rules that hold); a rule is ((feature, at most, at), ...)."""

    base: float
    rules: tuple[tuple[float, tuple], ...]

    def column(self, stats: str) -> Column:
        total = F.lit(self.base)
        for weight, rule in self.rules:
            holds = F.lit(True)
            for feature, left, at in rule:
                c = F.col(f"{stats}.{STATS[feature]}")
                holds = holds & ((c <= F.lit(at)) if left else (c > F.lit(at)))
            total = total + F.when(holds, F.lit(weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))

    def predict(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        for weight, rule in self.rules:
            total += weight * _holds(rule, x)
        return trees.sigmoid(total)


def _holds(rule: tuple, x: np.ndarray) -> np.ndarray:
    out = np.ones(len(x), bool)
    for feature, left, at in rule:
        out &= (x[:, feature] <= at) if left else (x[:, feature] > at)
    return out


def lasso(z: np.ndarray, y: np.ndarray, l1: float, rounds: int = 600) -> tuple[float, np.ndarray]:
    """Logistic regression with an L1 penalty by accelerated proximal gradient; the intercept is free."""
    n, d = z.shape
    step = 4 * n / (np.linalg.norm(np.column_stack([np.ones(n), z]), 2) ** 2)
    w = np.zeros(d + 1)
    w[0] = np.log(y.mean() / (1 - y.mean()))
    v, t = w.copy(), 1.0
    for _ in range(rounds):
        r = trees.sigmoid(v[0] + z @ v[1:]) - y
        new = v - step * np.concatenate([[r.mean()], z.T @ r / n])
        new[1:] = np.sign(new[1:]) * np.maximum(np.abs(new[1:]) - step * l1, 0)
        t, before = (1 + np.sqrt(1 + 4 * t * t)) / 2, t
        v = new + (before - 1) / t * (new - w)
        w = new
    return float(w[0]), w[1:]


def fit(x: np.ndarray, y: np.ndarray, n_trees: int = 24, depth: int = 3, l1: float = 0.002, most: int = 60) -> Rules:
    if not len(y) or y.min() == y.max():
        p = (y.sum() + 0.5) / (len(y) + 1.0) if len(y) else 0.5
        return Rules(float(np.log(p / (1 - p))), ())
    _, forest = trees.boost(x, y, n_trees, depth, 0.3, max(8, len(y) // 1000))
    rules = list(dict.fromkeys(r for t in forest for r in trees.paths(t)))
    if not rules:
        return Rules(float(np.log(y.mean() / (1 - y.mean()))), ())
    z = np.stack([_holds(r, x) for r in rules], 1).astype(float)
    spread = z.std(0)
    keep = spread > 0.01
    rules, z, spread = [r for r, k in zip(rules, keep, strict=True) if k], z[:, keep], spread[keep]
    base, w = lasso(z / spread, y, l1)
    chosen = np.argsort(-np.abs(w), kind="stable")[:most]
    kept = tuple((float(w[i] / spread[i]), rules[i]) for i in chosen if w[i])
    return Rules(base, kept)


def labelled(df: DataFrame, labels: DataFrame, label: str, skip: Column, bound: int = SAMPLE) -> DataFrame:
    """At most `bound` rows of df with a label (column y), chosen by a keyed hash of the id; rows for which `skip` holds never train."""
    one = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~F.coalesce(skip, F.lit(False))).groupBy("doc_id").agg(F.min(label).cast("double").alias("y"))
    few = one.orderBy(F.xxhash64(F.lit(29), "doc_id"), "doc_id").limit(bound)
    return df.select("doc_id", "text").join(F.broadcast(few), "doc_id")  # bounded by the limit above


def train(df: DataFrame, labels: DataFrame, skip: Column, bound: int = SAMPLE) -> Rules:
    sample = with_statistics(labelled(df, labels, "quality", skip, bound)).select("y", "stats.*").toPandas()
    m = sample.to_numpy(float).reshape(-1, len(STATS) + 1)
    m = m[np.lexsort(m.T)]  # the same fit whatever order the rows come in
    return fit(m[:, 1:], m[:, 0])


def score(df: DataFrame, rules: Rules, text: str = "text") -> DataFrame:
    """The table with score, the likelihood that quality is 1."""
    rest = [c for c in df.columns if c != "score"]
    return with_statistics(df, text, "_stats").select(*rest, rules.column("_stats").alias("score"))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(common.crc_mod(doc_id, 5) == 0, F.lit(False))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quality score for every document, learnt from labelled rows that are not held out."""
    docs, labels = common.read(spark, sf_dir, "documents"), common.read(spark, sf_dir, "labels")
    rules = train(docs, labels, held_out(F.col("doc_id")))
    scored = score(docs.select("doc_id", "text"), rules)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"))
