"""Toxicity: a subsequence string-kernel support vector machine with Nystroem landmarks.

The kernel compares tokens by their subsequences of 3 and 4 letters within a
span of SPAN characters, each gap character costing a factor DECAY; a run of
other characters than letters counts as one gap character. So "id.iot" and "idxiot" stay close to
"idiot". A token's two ends count as letters, so how a token begins is told
apart from the same letters inside it. A sentence's value is the largest of its tokens (letters spelled out
with spaces are joined to a token first), a document's the largest of its
sentences.

Training sees a bounded sample of labelled documents. Their sentences inherit
the label; what makes a sentence of a toxic document toxic is found by
multiple-instance witnesses: each toxic document's token that best separates
the labels. Landmarks are drawn from the witnesses and from clean tokens;
kernel values to the landmarks are whitened (Nystroem), a squared-hinge linear
machine is fitted on them, clean tokens that it ranks too high and the tokens that it
ranks highest in toxic documents are added and it is fitted again. As all is linear in the kernel's features, the machine
folds into one weight for each subsequence, a table of fixed size, which is
broadcast. A logistic curve on the largest value, fitted on documents, gives
the score.

Cases: a null or empty text scores as a text without tokens (the lowest).
Null labels do not train; of repeated labels of an id the smallest counts.
Without both classes among the labels the score is the smoothed share of
label 1 (0.5 without any). Equal texts have equal scores. Long tokens are
scored whole, in every window of WINDOW letters, in pieces of a bounded size;
values are sums of whole numbers, so they don't depend on what is scored
beside a token; long landmarks are cut into windows of that size. Other columns pass through; input
columns named like result columns are replaced. An empty table gives an empty
result.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain, combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import common, trees
from tidemark.llm.quality import labelled

#: Labelled documents used to fit, at most.
SAMPLE = 20_000
CUT = 0.3
DECAY, SPAN = 0.5, 6
WINDOW = 14
#: Codes of letters: a-z, the ends of a token, and those of all other alphabets.
LETTERS, EDGE, OTHERS = 40, 26, 13
#: What stands for a token's ends in words that train or are scored.
MARK = "\x02"
#: Windows of a word in one piece, and letters of the pieces that are scored at once.
PIECE, AT_ONCE = 1 << 15, 1 << 16
#: Tokens brought to the driver to fit, at most, of either class, and landmarks.
TOKENS, LANDMARKS = 3000, 128
#: Times that the machine is fitted.
ROUNDS = 4
#: Characters of a token that is used to fit, at most (longer ones are scored, not learnt from).
LONGEST = 200
#: Witnesses whose variants train.
BENT = 24
#: Values of tokens that a worker remembers, at most.
REMEMBERED = 300_000

_OFFSETS = [(0, *c) for p in (3, 4) for c in combinations(range(1, SPAN), p - 1)]
_DIMENSIONS = LETTERS**3 + LETTERS**4
_SPELLED = re.compile(r"(?:(?<=\s)|^)(?:\w[\s.*_-]{1,2}){3,}\w(?=\W|$)")


def spell(token: str) -> list[int]:
    """Letters as codes (those of other alphabets folded to OTHERS codes), MARK as EDGE, a run of other characters as one -1."""
    out: list[int] = []
    for c in token:
        o = ord(c)
        letter = o - 97 if 97 <= o < 123 else EDGE + 1 + o % OTHERS if o > 127 and c.isalpha() else EDGE if c == MARK else -1
        if letter >= 0 or not out or out[-1] >= 0:
            out.append(letter)
    return out


def tokens(text: str) -> set[str]:
    """The distinct tokens of all sentences of a text, lower-cased, with those spelled out joined."""
    text = text.lower()
    out = {t.strip(".,;:!?\"'()[]{}|#$%&*@-_/") for t in set(text.split())}
    if sum(len(t) == 1 for t in out) >= 3:
        out.update(re.sub(r"\W|_", "", m[0]) for m in _SPELLED.finditer(text))
    out.discard("")
    return out


def edged(words: list[str]) -> list[str]:
    """The words with their ends marked."""
    return [MARK + w + MARK for w in words]


def _windows(words: list[str]) -> Iterator[tuple[int, list[int]]]:
    """Each word's windows, whole and overlapping by all but one letter, with the word's place."""
    for i, w in enumerate(words):
        s = spell(w)
        for at in range(max(1, len(s) - WINDOW + 1)):
            yield i, s[at : at + WINDOW]


def features(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Subsequence codes (-1: none) and weights, one row a window, and the word that each window is of. Rows have norm 1 (or 0)."""
    return _features(list(_windows(words)))


def _features(owned: list[tuple[int, list[int]]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    owner, windows = [i for i, _ in owned], [s for _, s in owned]
    grid = np.full((len(windows), WINDOW + SPAN), -1, np.int32)
    for i, s in enumerate(windows):
        grid[i, : len(s)] = s
    codes = np.empty((len(windows), WINDOW * len(_OFFSETS)), np.int32)
    decay = np.empty(len(_OFFSETS) * WINDOW, np.float32)
    for j, offsets in enumerate(_OFFSETS):
        code, bad = np.zeros((len(windows), WINDOW), np.int32), np.zeros((len(windows), WINDOW), bool)
        for o in offsets:
            letter = grid[:, o : o + WINDOW]
            bad |= letter < 0
            code = code * LETTERS + letter
        code += LETTERS**3 if len(offsets) == 4 else 0
        codes[:, j * WINDOW : (j + 1) * WINDOW] = np.where(bad, -1, code)
        decay[j * WINDOW : (j + 1) * WINDOW] = DECAY ** (offsets[-1] + 1 - len(offsets))
    weights = np.where(codes >= 0, decay, 0).astype(np.float32)
    norm = np.sqrt((weights**2).sum(1, keepdims=True))
    return codes, weights / np.where(norm > 0, norm, 1), np.array(owner, np.int64)


def kernel(words: list[str], landmarks: list[str]) -> np.ndarray:
    """Normalised kernel values of each word's windows (the largest of each word) with the landmarks' first windows."""
    lc, lw, lo = features(landmarks)
    lc, lw = lc[np.unique(lo, return_index=True)[1]], lw[np.unique(lo, return_index=True)[1]]
    known = np.unique(lc[lc >= 0])
    at = np.full(_DIMENSIONS, -1, np.int32)
    at[known] = np.arange(len(known))
    dense = np.zeros((len(known) + 1, len(landmarks)), np.float32)
    for j in range(len(landmarks)):
        used = lc[j] >= 0
        np.add.at(dense[:, j], at[lc[j][used]], lw[j][used])
    codes, weights, owner = features(words)
    out = np.zeros((len(codes), len(landmarks)), np.float32)
    index = np.where(codes >= 0, at[np.maximum(codes, 0)], -1)
    for c in range(index.shape[1]):
        rows = np.flatnonzero(index[:, c] >= 0)
        out[rows] += weights[rows, c, None] * dense[index[rows, c]]
    best = np.full((len(words), len(landmarks)), -1, np.float32)
    np.maximum.at(best, owner, out)
    return best


def fold(landmarks: list[str], beta: np.ndarray) -> np.ndarray:
    """The weight of every subsequence in the sum of beta times the kernel with each landmark."""
    codes, weights, owner = features(landmarks)
    first = np.unique(owner, return_index=True)[1]
    out = np.zeros(_DIMENSIONS, np.float32)
    for j, i in enumerate(first):
        used = codes[i] >= 0
        np.add.at(out, codes[i][used], weights[i][used] * beta[j])
    return out


def fixed_point(table: np.ndarray) -> tuple[np.ndarray, float]:
    """The table in whole numbers, and their unit."""
    unit = float(np.abs(table).max()) / 2**30 or 1.0
    return np.rint(table / unit).astype(np.int32), unit


def values(words: list[str], table: np.ndarray | tuple[np.ndarray, float]) -> np.ndarray:
    """The machine's value of each word: the largest of its windows. table: of `fold`, or that as `fixed_point`."""
    if not words:
        return np.zeros(0)
    fixed, unit = fixed_point(table) if isinstance(table, np.ndarray) else table
    out = np.full(len(words), -np.inf)
    held: list[tuple[int, list[int]]] = []
    size = 0
    for i, w in enumerate(words):
        s = spell(w)
        for at in range(0, max(1, len(s) - WINDOW + 1), PIECE):
            held.append((i, s[at : at + PIECE + WINDOW - 1]))
            size += len(held[-1][1])
            if size > AT_ONCE:
                _largest(held, fixed, unit, out)
                held, size = [], 0
    if held:
        _largest(held, fixed, unit, out)
    return out


def _largest(pieces: list[tuple[int, list[int]]], fixed: np.ndarray, unit: float, out: np.ndarray) -> None:
    """Raise each word's value to the largest of its piece's windows. Every subsequence is looked up once; windows take differences of running sums."""
    length = np.array([len(s) for _, s in pieces], np.int64)
    start = np.cumsum(length + SPAN) - length - SPAN
    flat = np.full(int((length + SPAN).sum()), -1, np.int64)
    flat[np.repeat(start - np.cumsum(length) + length, length) + np.arange(length.sum())] = np.fromiter(chain.from_iterable(s for _, s in pieces), np.int64, int(length.sum()))
    n_windows = np.maximum(1, length - WINDOW + 1)
    first = np.cumsum(n_windows) - n_windows
    begin = np.repeat(start - first, n_windows) + np.arange(n_windows.sum())
    end = np.minimum(begin + WINDOW, np.repeat(start + length, n_windows))
    n = len(flat) - SPAN
    value, square = np.zeros(len(begin), np.int64), np.zeros(len(begin), np.int64)
    most = SPAN - 3  # gap characters of a subsequence; DECAY is a half, so weights are shifts
    for offsets in _OFFSETS:
        code, good = np.zeros(n, np.int64), np.ones(n, bool)
        for o in offsets:
            letter = flat[o : o + n]
            good &= letter >= 0
            code *= LETTERS
            code += letter
        code += LETTERS**3 if len(offsets) == 4 else 0
        gap = offsets[-1] + 1 - len(offsets)
        at = np.flatnonzero(good)
        weighed, used = np.zeros(n + 1, np.int64), np.zeros(n + 1, np.int64)
        weighed[at + 1] = fixed[code[at]].astype(np.int64) << most - gap
        used[at + 1] = 1 << 2 * (most - gap)
        weighed, used = np.cumsum(weighed), np.cumsum(used)
        last = np.maximum(end - offsets[-1], begin)
        value += weighed[last] - weighed[begin]
        square += used[last] - used[begin]
    # both carry the factor 2**most
    got = value * unit / np.sqrt(np.maximum(square, 1))
    np.maximum.at(out, np.array([i for i, _ in pieces]), np.maximum.reduceat(got, first))


@dataclass
class Model:
    """Without a table (one class only), every text has the score sigmoid(offset)."""

    table: np.ndarray | None
    bias: float
    slope: float
    offset: float

    def probability(self, top: np.ndarray) -> np.ndarray:
        return trees.sigmoid(self.slope * np.asarray(top) + self.offset)


class Scorer:
    """A document's largest token value; token values are remembered up to a bound."""

    def __init__(self, table: np.ndarray):
        self.table, self.seen = fixed_point(table), {}

    def __call__(self, texts: list[str]) -> np.ndarray:
        own = [tokens(t) for t in texts]
        new = sorted(set().union(*own) - self.seen.keys()) if own else []
        if len(self.seen) + len(new) > REMEMBERED:
            self.seen = {}
            new = sorted(set().union(*own))
        self.seen.update(zip(new, values(edged(new), self.table).tolist(), strict=True))
        return np.array([max(map(self.seen.__getitem__, o), default=-1.0) for o in own])


def parts(word: str) -> list[str]:
    """A landmark in pieces of WINDOW characters, the last one up to its end; they overlap if need be."""
    if len(word) <= WINDOW:
        return [word]
    return [word[i : i + WINDOW] for i in [*range(0, len(word) - WINDOW, WINDOW // 2), len(word) - WINDOW]]


def variants(word: str) -> list[str]:
    """The word with a letter inserted, or a letter covered, at each inner place (words of five letters or more)."""
    if len(word) < 5 or len(word) > WINDOW - 1:
        return []
    return [word[:i] + "xqzj"[i % 4] + word[i:] for i in range(1, len(word))] + [word[:i] + "*" + word[i + 1 :] for i in range(1, len(word) - 1)]


def _machine(x: np.ndarray, y: np.ndarray, weight: np.ndarray, l2: float = 1e-4, rounds: int = 400) -> tuple[np.ndarray, float]:
    """Linear machine with squared hinge loss by accelerated gradient."""
    z = np.column_stack([x, np.ones(len(x))])
    step = 1 / (2 * np.linalg.norm(z * np.sqrt(weight)[:, None], 2) ** 2 / weight.sum() + l2)
    w = v = np.zeros(z.shape[1])
    t = 1.0
    for _ in range(rounds):
        slack = np.maximum(0, 1 - y * (z @ v))
        g = -2 * z.T @ (weight * y * slack) / weight.sum() + l2 * np.append(v[:-1], 0)
        new = v - step * g
        t, before = (1 + np.sqrt(1 + 4 * t * t)) / 2, t
        v, w = new + (before - 1) / t * (new - w), new
    return w[:-1], float(w[-1])


def _logistic(top: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of P(y) on standardised values, by Newton's method with a small ridge."""
    m, s = top.mean(), max(top.std(), 1e-9)
    z = np.column_stack([(top - m) / s, np.ones(len(top))])
    w = np.zeros(2)
    for _ in range(50):
        p = trees.sigmoid(z @ w)
        g = z.T @ (p - y) + np.array([0.5, 0]) * w
        h = (z * (p * (1 - p))[:, None]).T @ z + np.diag([0.5, 1e-6])
        w = w - np.clip(np.linalg.solve(h, g), -2, 2)
    return float(w[0] / s), float(w[1] - w[0] * m / s)


def _texts(part: list[bytes]) -> list[str]:
    return [t.decode("utf-8", "replace") for t in part]


def _counts(sample: DataFrame) -> DataFrame:
    """token, pos, neg: in how many sampled documents of each label the token occurs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in common.text_chunks(batches, "text", 16 << 20):
            got: tuple[Counter, Counter] = (Counter(), Counter())
            for y, t in zip(part.column(part.schema.get_field_index("y")).to_pylist(), _texts(texts), strict=True):
                got[int(y)].update(tokens(t))
            words = sorted(got[0].keys() | got[1].keys())
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array([got[1][w] for w in words], pa.int64()), pa.array([got[0][w] for w in words], pa.int64())], names=["token", "pos", "neg"])

    return sample.mapInArrow(run, "token string, pos long, neg long").groupBy("token").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))


def _witnesses(sample: DataFrame, rank: dict[str, int]) -> DataFrame:
    """token, n: how many toxic documents the token separates best."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in common.text_chunks(batches, "text", 16 << 20):
            got = Counter(min(known, key=rank.__getitem__) for t in _texts(texts) if (known := [w for w in tokens(t) if w in rank]))
            yield pa.RecordBatch.from_arrays([pa.array(list(got), pa.string()), pa.array(list(got.values()), pa.int64())], names=["token", "n"])

    return sample.where("y = 1").select("text").mapInArrow(run, "token string, n long").groupBy("token").agg(F.sum("n").alias("n"))


def _tops(sample: DataFrame, table: np.ndarray, least: float) -> DataFrame:
    """token, n: how many toxic documents have the token as their largest, with a value of `least` or more."""
    shared = sample.sparkSession.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fixed = fixed_point(shared.value)
        for _, texts in common.text_chunks(batches, "text", 16 << 20):
            got: Counter = Counter()
            for t in _texts(texts):
                own = sorted(tokens(t))
                v = values(edged(own), fixed)
                if own and v.max() >= least:
                    got[own[int(v.argmax())]] += 1
            yield pa.RecordBatch.from_arrays([pa.array(list(got), pa.string()), pa.array(list(got.values()), pa.int64())], names=["token", "n"])

    return sample.where("y = 1").select("text").mapInArrow(run, "token string, n long").groupBy("token").agg(F.sum("n").alias("n"))


def _valued(table_of_tokens: DataFrame, table: np.ndarray) -> DataFrame:
    shared = table_of_tokens.sparkSession.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fixed = fixed_point(shared.value)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(values(edged(b.column(0).to_pylist()), fixed).astype(float))], names=["token", "value"])

    return table_of_tokens.select("token").mapInArrow(run, "token string, value double")


def with_top(df: DataFrame, table: np.ndarray, text: str = "text") -> DataFrame:
    """The table with _top, the largest token value of each text."""
    common.tune(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(table)  # fixed size: 4 bytes for each subsequence code

    def top(series: Iterator) -> Iterator:
        import pandas as pd

        scorer = Scorer(shared.value)
        for s in series:
            texts = [t or "" for t in s]
            yield pd.Series(np.concatenate([scorer(texts[i : i + 64]) for i in range(0, len(texts), 64)]) if texts else [], dtype=float)

    import pandas as pd

    top.__annotations__ = {"series": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return df.withColumn("_top", F.pandas_udf(top, "double")(F.col(text)))  # type: ignore[call-overload]


def train(df: DataFrame, labels: DataFrame, skip: Column, bound: int = SAMPLE) -> Model:
    common.tune(df.sparkSession)
    sample = common.settle(labelled(df, labels, "toxic", skip, bound).select("text", "y").distinct(), "toxic")
    n = {int(y): c for y, c in sample.groupBy("y").count().collect()}
    if len(n) < 2:
        p = (n.get(1, 0) + 0.5) / (sum(n.values()) + 1.0)
        return Model(None, 0.0, 0.0, float(np.log(p / (1 - p))))
    counts = common.settle(_counts(sample).where((F.col("pos") + F.col("neg") >= 1) & (F.length("token") <= LONGEST)), "tokens")
    odds = F.log((F.col("pos") + 0.5) / (n[1] + 1)) - F.log((F.col("neg") + 0.5) / (n[0] + 1))
    leading = [r.token for r in counts.where((F.col("pos") >= 3) & (odds > 2)).orderBy(odds.desc(), "token").limit(TOKENS).collect()]
    witnesses = _witnesses(sample, {w: i for i, w in enumerate(leading)}).where("n >= 2")
    # a token that others outrank in its documents still counts if it marks a quarter as many as the strongest
    most = counts.where(odds > 2).agg(F.max("pos")).first()[0] or 0
    strong = counts.where((odds > 2) & (F.col("pos") >= 3) & (4 * F.col("pos") >= most)).select("token", F.col("pos").alias("n"))
    found = witnesses.union(strong).groupBy("token").agg(F.max("n").alias("n")).orderBy(F.col("n").desc(), "token").limit(TOKENS).collect()
    clean = counts.where(F.col("neg") > 4 * F.col("pos"))
    plain = [r.token for r in clean.orderBy(F.xxhash64(F.lit(3), "token"), "token").limit(TOKENS).collect()] + [r.token for r in clean.orderBy(F.col("neg").desc(), "token").limit(TOKENS // 3).collect()]
    if not found:
        p = n[1] / (n[0] + n[1])
        return Model(None, 0.0, 0.0, float(np.log(p / (1 - p))))
    times = {r.token: r.n for r in found}
    good = list(times)
    # inserted and spelled-over letters: some variants of the strongest witnesses train as well, at a lower weight
    bent = sorted({v for w in good[:BENT] for v in variants(w)} - set(plain))
    negatives = sorted(set(plain) - set(good))
    table = bias = None
    near: list[str] = []  # clean tokens that the machine ranked highest
    for _ in range(ROUNDS):
        weight_of = np.sqrt([float(times[w]) for w in good])
        landmarks = good[:LANDMARKS] + near[:LANDMARKS] + [negatives[i] for i in np.linspace(0, len(negatives) - 1, min(LANDMARKS, len(negatives))).astype(int)]
        landmarks = list(dict.fromkeys(p for w in edged(landmarks) for p in parts(w)))
        gram = kernel(landmarks, landmarks).astype(float)
        lam, vec = np.linalg.eigh((gram + gram.T) / 2)
        keep = lam > 1e-6 * lam.max()
        white = vec[:, keep] / np.sqrt(lam[keep])
        bent = [w for w in bent if w not in times]
        negatives = [w for w in negatives if w not in times]
        words = edged(good + bent + negatives)
        x = kernel(words, landmarks) @ white
        y = np.append(np.ones(len(good) + len(bent)), -np.ones(len(negatives)))
        weight = np.concatenate([weight_of / weight_of.sum(), np.full(len(bent), 0.5 / max(len(bent), 1)), np.full(len(negatives), 2.0 / len(negatives))]) * len(words)
        u, bias = _machine(x, y, weight)
        table = fold(landmarks, white @ u)
        # the machine's own witnesses: they may be rarer than those that were counted
        own = _tops(sample, table, -bias - 0.5).join(counts.where(odds > 2).select("token"), "token").orderBy(F.col("n").desc(), "token").limit(TOKENS).collect()
        times = dict(sorted((times | {r.token: max(r.n, times.get(r.token, 0)) for r in own}).items(), key=lambda x: (-x[1], x[0])))
        good = list(times)
        hard = _valued(clean, table).orderBy(F.col("value").desc(), "token").limit(TOKENS).collect()
        near = [r.token for r in hard if r.value + bias > -0.9 and r.token not in set(good)]
        negatives = sorted(set(negatives) | set(near))
    assert table is not None and bias is not None
    tops = with_top(sample, table).select("y", "_top").toPandas().sort_values(["y", "_top"])
    slope, offset = _logistic(tops["_top"].to_numpy(), tops["y"].to_numpy())
    return Model(table, bias, slope, offset)


def score(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The table with score, the likelihood that toxic is 1."""
    rest = [c for c in df.columns if c != "score"]
    if model.table is None:
        return df.select(*rest, F.lit(float(trees.sigmoid(np.array(model.offset)))).alias("score"))
    linear = F.lit(model.slope) * F.col("_top") + F.lit(model.offset)
    return with_top(df, model.table, text).select(*rest, (1 / (1 + F.exp(-linear))).alias("score"))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(common.crc_mod(doc_id, 4) == 2, F.lit(False))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A toxicity score for every document, learnt from labelled rows that are not held out."""
    docs, labels = common.read(spark, sf_dir, "documents"), common.read(spark, sf_dir, "labels")
    model = train(docs, labels, held_out(F.col("doc_id")))
    scored = score(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"))
