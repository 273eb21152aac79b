"""Personal data: rule spans, and candidate spans kept by gradient-boosted trees.

Main path: DataFrame functions only, and no shuffle. Each document's spans
live in arrays of its own row, so neither a hot source nor a large group of
copies gathers anywhere.

Base spans are the leftmost non-overlapping matches of one pattern per kind
(email, ip, card, phone) that pass the kind's test. Generators of high recall
then propose overlapping candidates on the text with the base spans masked;
boosted trees score each from its format and its context; candidates at or
above their kind's calibrated threshold are kept, of overlapping ones by their
score: a candidate goes only if it overlaps a kept one of a higher score (or an
equal one that starts before it).

Cases: a null or empty text has no spans. Repeated rows get equal results.
Other columns pass through; result columns named like input columns replace
them. An empty table gives an empty result. Very long texts take time in
proportion to their length and spans: patterns don't step back over long runs,
arrays are built in blocks, and the text is cut from pieces of fixed length.
"""

from __future__ import annotations

import json
import random

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import common, trees

KINDS = ("email", "ip", "card", "phone")

# The patterns of the contract. Where a quantifier is possessive
# or a look-behind is added, the matches are the same and long runs are linear.
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){13,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: A cheap necessary condition of each base pattern.
HINT = {"email": "@", "ip": ".", "card": "", "phone": "+"}

#: High-recall generators: (kind, pattern).
GENERATORS = (
    ("email", r"(?<![\p{L}0-9._%+-])[\p{L}0-9._%+-]{1,64}+\s?(?:@|\(at\)|\[at\]|\{at\})\s?[\p{L}0-9-]{1,63}+(?:\s?(?:\.|\(dot\)|\[dot\]|\{dot\})\s?[\p{L}0-9-]{1,63}+){1,6}"),
    ("ip", r"(?<![0-9A-Za-z:.])(?:(?:[0-9A-Fa-f]{1,4}:){3,7}[0-9A-Fa-f]{1,4}|(?:[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,5})?::(?:[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,5}))(?![0-9A-Za-z:])"),
    ("card", r"(?<![0-9])[0-9]{4}(?:[\x20./-]{1,2}[0-9]{4}){2}[\x20./-]{1,2}[0-9]{3,7}(?![0-9])"),
    ("phone", r"(?<![0-9A-Za-z(])(?:00[1-9][0-9]{0,2}[\x20.-]?)?[(]?[0-9]{2,4}[)]?(?:[\x20./-]{1,3}[0-9]{2,4}){2,4}(?![0-9A-Za-z])"),
)
#: Documents without any of these can hold no candidate.
CANDIDATE_HINT = r"[0-9][\x20./)-]|[0-9A-Fa-f:]:[0-9A-Fa-f]|@|[\[({]at[\])}]"

CONTEXT = {
    "email": r"(?i)(?:e-?mail|mail|contact|write|courriel|correo|kontakt)\W{0,4}(?:\w{1,4}\W{0,3})?$",
    "ip": r"(?i)(?:\bip|ipv6|address|host|server|adresse)\W{0,4}(?:\w{1,4}\W{0,3})?$",
    "card": r"(?i)(?:card|visa|mastercard|amex|credit|karte|carte|tarjeta)\W{0,4}(?:\w{1,4}\W{0,3})?$",
    "phone": r"(?i)(?:phone|tel|call|fax|mobile|cell|dial|ring|telefon|t.l.phone|tel.fono)\W{0,4}(?:\w{1,4}\W{0,3})?$",
}
AGAINST = r"(?i)(?:version|isbn|issn|order|invoice|sku|ref|page|date|room|build|part|serial|score|id|no|nr|total)\W{0,4}$"
FEATURES = ("kind", "length", "digits", "groups", "first_group", "last_group", "luhn", "parens", "dots", "zeros", "words_at", "told", "against", "glued", "labels", "octets", "double", "letters")
SPAN = "struct<start:int,k:int,end:int,m:string,before:string,after:string>"
#: Elements of a block of `scan`, and characters of a piece of a text.
STEP, PIECE = 64, 1024


def _let(value: Column, body) -> Column:  # noqa: ANN001
    """body(value), with the value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _range(items: Column, start: Column, end: Column) -> Column:
    """The elements from start to end (exclusive), in time of their number (slice would copy the whole array first)."""
    return F.when(end > start, F.transform(F.sequence(start.cast("int"), end.cast("int") - 1), lambda i: F.get(items, i))).otherwise(F.filter(items, lambda _: F.lit(False)))


def scan(items: Column, start: Column, step, out: str, last=None) -> Column:  # noqa: ANN001
    """What step emits along an array: step(state, item) is a struct (state, out), out an array; `last` gives what the final state emits.

    Whatever an aggregate carries is copied for every element. So blocks of STEP
    elements are gone through twice: first for the state each begins with, then
    each for what it emits.
    """
    none = F.array().cast(f"array<{out}>")
    last_block = lambda a: F.floor((F.greatest(F.size(a), F.lit(1)) - 1) / STEP).cast("int")
    blocks = _let(items, lambda a: F.transform(F.sequence(F.lit(0), last_block(a)), lambda b: _range(a, b * STEP, F.least(b * STEP + STEP, F.size(a)))))

    def ahead(s: Column, block: Column) -> Column:
        after = F.aggregate(block, s["now"], lambda state, x: step(state, x)["state"])
        return F.struct(after.alias("now"), F.concat(s["begun"], F.array(s["now"])).alias("begun"))

    def emitted(state: Column, block: Column) -> Column:
        zero = F.struct(state.alias("state"), none.alias("out"))
        more = lambda s, r: F.struct(r["state"].alias("state"), F.concat(s["out"], r["out"]).alias("out"))
        return F.aggregate(block, zero, lambda s, x: F.aggregate(F.array(step(s["state"], x)), s, more), lambda s: s["out"])

    def gone_through(all_blocks: Column) -> Column:
        begun = F.aggregate(all_blocks, F.struct(start.alias("now"), F.filter(F.array(start), lambda _: F.lit(False)).alias("begun")), ahead)
        parts = lambda s: F.transform(F.arrays_zip(s["begun"].alias("s"), all_blocks.alias("b")), lambda z: emitted(z["s"], z["b"]))
        return _let(begun, lambda s: F.flatten(F.concat(parts(s), F.array(last(s["now"])))) if last else F.flatten(parts(s)))

    return _let(blocks, gone_through)


def pieces(text: Column) -> Column:
    """The text in pieces of PIECE characters."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))


def cut(parts: Column, start: Column, end: Column) -> Column:
    """The text between two positions, from its pieces: only those that it touches are read."""
    a, b = F.floor(start / PIECE).cast("int"), F.floor(end / PIECE).cast("int")
    one = F.substring(F.coalesce(F.get(parts, a), F.lit("")), start % PIECE + 1, end - start)
    head, tail = F.substring(F.coalesce(F.get(parts, a), F.lit("")), start % PIECE + 1, F.lit(PIECE)), F.substring(F.coalesce(F.get(parts, b), F.lit("")), F.lit(1), end % PIECE)
    return F.when(a == b, one).otherwise(F.concat(head, F.when(b - a > 1, F.array_join(_range(parts, a + 1, b), "")).otherwise(F.lit("")), tail))


def _matches(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def _only_digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    n = F.length(digits)
    each = F.transform(
        F.sequence(F.lit(1), F.greatest(n, F.lit(1))),
        lambda i: F.coalesce(F.try_to_number(F.substring(digits, n - i + F.lit(1), F.lit(1)), F.lit("9")).cast("int"), F.lit(0)) * F.when(i % 2 == 0, 2).otherwise(1),
    )
    return F.aggregate(each, F.lit(0), lambda s, x: s + F.when(x > 9, x - 9).otherwise(x)) % 10 == 0


def _valid(kind: str, m: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(m, r"\."), lambda p: F.length(F.regexp_replace(p, "^0+(?=.)", "")).between(1, 3) & (F.lpad(F.regexp_replace(p, "^0+(?=.)", ""), 3, "0") <= "255"))
    if kind == "card":
        return _luhn(_only_digits(m))
    if kind == "phone":
        return F.length(_only_digits(m)).between(10, 15)
    return F.lit(True)


def _located(kind: str, text: Column, pattern: str, context: bool = False) -> Column:
    """The matches as structs(start, k, end, m, before, after), by the lengths of what lies between them."""
    k = KINDS.index(kind)
    between, found = F.split(text, pattern, -1), _matches(text, pattern)
    pairs = F.arrays_zip(between.alias("gap"), found.alias("m"), F.slice(between, F.lit(2), F.greatest(F.size(between) - 1, F.lit(0))).alias("rest"))

    def step(at: Column, pair: Column) -> Column:
        begin = at + F.length(pair["gap"])
        stop = begin + F.length(pair["m"])
        span = F.struct(
            begin.alias("start"), F.lit(k).alias("k"), stop.alias("end"), pair["m"].alias("m"),
            (F.right(pair["gap"], F.lit(32)) if context else F.lit("")).alias("before"), (F.left(pair["rest"], F.lit(8)) if context else F.lit("")).alias("after"),
        )
        return F.struct(F.coalesce(stop, at).alias("state"), F.when(pair["m"].isNull(), _none()).otherwise(F.array(span)).alias("out"))

    return scan(pairs, F.lit(0), step, SPAN)


def _none() -> Column:
    return F.array().cast(f"array<{SPAN}>")


def _base(text: Column, kind: str) -> Column:
    pattern = BASE[kind]
    hint = F.contains(text, F.lit(HINT[kind])) if HINT[kind] else text.rlike("[0-9]{2}|[0-9][ -][0-9]")
    return F.when(hint & text.rlike(pattern), F.filter(_located(kind, text, pattern), lambda s: _valid(kind, s["m"]))).otherwise(_none())


def _replaced(parts: Column, length: Column, spans: Column, by) -> Column:  # noqa: ANN001
    """The text with by(span, from, to) in place of each span, from and to being where the part of it lies that no earlier span covers."""

    def step(at: Column, x: Column) -> Column:
        begin, stop = F.greatest(at, x["start"]), F.greatest(at, x["end"])
        return F.struct(stop.alias("state"), F.array(cut(parts, at, begin), by(x, begin, stop)).alias("out"))

    return F.array_join(scan(spans, F.lit(0), step, "string", lambda at: F.array(cut(parts, at, F.greatest(at, length)))), "")


def _features(c: Column) -> Column:
    m, before, after = c["m"], c["before"], c["after"]
    digits = _only_digits(m)
    groups = F.filter(F.split(m, "[^0-9]+"), lambda g: g != "")
    flag = lambda b: F.coalesce(b, F.lit(False)).cast("double")
    told = F.lit(False)
    for i, kind in enumerate(KINDS):
        told = F.when(c["k"] == i, before.rlike(CONTEXT[kind])).otherwise(told)
    values = (
        c["k"].cast("double"), F.length(m).cast("double"), F.length(digits).cast("double"), F.size(groups).cast("double"),
        F.coalesce(F.length(F.get(groups, F.lit(0))), F.lit(0)).cast("double"), F.coalesce(F.length(F.element_at(F.concat(F.array(F.lit("")), groups), -1)), F.lit(0)).cast("double"),
        flag(_luhn(digits)), flag(m.rlike("[()]")), F.regexp_count(m, F.lit(r"\.")).cast("double"), flag(m.startswith("00")), flag(m.rlike(r"(?i)[\[({]at[\])}]")),
        flag(told), flag(before.rlike(AGAINST)), flag(before.rlike(r"[\p{L}0-9]$") | after.rlike(r"^[\p{L}0-9]")),
        F.regexp_count(m, F.lit(r"\p{L}+")).cast("double"), F.regexp_count(m, F.lit(":")).cast("double"),
        flag(F.contains(m, F.lit("::"))), F.regexp_count(m, F.lit(r"\p{L}")).cast("double"),
    )
    return F.struct(c["start"].alias("start"), c["k"].alias("k"), c["end"].alias("end"), c["m"].alias("m"), *[v.alias(n) for v, n in zip(values, FEATURES, strict=True)])


def candidates(text: Column) -> Column:
    """All generators' candidates in the text with their features, in order of (start, kind, end)."""
    found = [F.when(text.rlike(p), _located(k, text, p, context=True)).otherwise(_none()) for k, p in GENERATORS]
    return F.when(text.rlike(CANDIDATE_HINT), F.transform(F.array_sort(F.concat(*found)), _features))


def _synthetic(n: int, seed: int) -> list[dict]:
    """Sentences with one planted item each: personal data (y 1) or something that only looks like it (y 0)."""
    r = random.Random(seed)
    d = lambda k: "".join(r.choice("0123456789") for _ in range(k))
    word = lambda: "".join(r.choice(["th", "er", "on", "an", "re", "he", "in", "ed", "nd", "ha"]) for _ in range(r.randint(1, 4)))
    host = lambda dot: dot.join([word(), r.choice(["com", "org", "net", "de", "fr"])])
    out = []
    for _ in range(n):
        kind, y = r.randrange(4), r.randrange(2)
        lead = " ".join(word() for _ in range(r.randint(0, 5)))
        if kind == 0 and y:
            item = word() + r.choice([" (at) ", "(at)", " [at] ", "[at]", "{at}"]) + host(r.choice([".", " (dot) ", "[dot]"]))
            cue = r.choice(["mail ", "contact ", "write to ", "", ""])
        elif kind == 0:
            item, cue = r.choice([f"{word()} @ {word()}.{word()}", f"{word()}@{word()} .{word()}", f"{word()} @{word()}. {word().title()}"]), r.choice(["", "", "follow "])
        elif kind == 1 and y:
            groups = [f"{r.randrange(65536):x}" for _ in range(8)]
            if r.random() < 0.5:  # a run of zeros left out
                groups = groups[: r.randint(1, 4)] + [""] + groups[: r.randint(1, 3)] if r.random() < 0.8 else ["", "", groups[0]]
            item, cue = ":".join(groups), r.choice(["ip ", "host ", "address ", "from ", "server: ", ""])
        elif kind == 1:
            item, cue = r.choice([":".join(d(2) for _ in range(r.randint(4, 6))), f"{r.choice(['face', 'add', 'Dec', 'a', 'Bad'])}::{r.choice(['bed', 'Add', 'e', 'face', 'b'])}", f"{d(2)}::{d(2)}"]), r.choice(["score ", "date ", "", "build ", "call "])
        elif kind == 2 and y:
            sep = r.choice([".", "/", " - ", ". "])[:2]
            body = d(15)
            check = next(c for c in "0123456789" if sum(sum(divmod(int(x) * (1 + i % 2), 10)) for i, x in enumerate(reversed(body + c))) % 10 == 0)
            item, cue = sep.join((body + check)[i : i + 4] for i in range(0, 16, 4)), r.choice(["card ", "visa ", "credit card: ", ""])
        elif kind == 2:
            item, cue = r.choice([" ", ".", "/", "-"]).join(d(4) for _ in range(4)), r.choice(["order ", "serial ", "part ", "", "invoice "])
        elif y:
            a, b, c = "".join(r.choice("23456789") for _ in range(3)), d(3), d(4)
            item = r.choice([f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"00{r.randint(1, 99)} {a} {b} {c}", f"{a}.{b}.{c}"])
            cue = r.choice(["call ", "tel. ", "phone: ", "mobile ", "fax ", "dial "])
        else:
            item = r.choice([f"{d(4)}-{d(2)}-{d(2)}", f"{d(2)}/{d(2)}/{d(4)}", f"{d(2)} {d(3)} {d(2)}", f"{d(3)}-{d(3)}-{d(4)}", f"{d(2)}.{d(2)}.{d(4)}", f"{d(3)} {d(2)} {d(3)} {d(4)}"])
            cue = r.choice(["version ", "isbn ", "order ", "date ", "page ", "id ", "total ", "", ""])
        text = f"{lead} {cue}{item} {word()}."
        begin = len(lead) + 1 + len(cue)
        out.append({"text": text, "kind": kind, "begin": begin, "stop": begin + len(item), "y": y})
    return out


def training_candidates(spark: SparkSession, n: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of the generators' candidates in n synthetic sentences (bounded, on the driver)."""
    rows = json.dumps(_synthetic(n, seed))
    table = spark.range(1).select(F.explode(F.from_json(F.lit(rows), "array<struct<text:string,kind:int,begin:int,stop:int,y:int>>")).alias("r")).select("r.*")
    found = table.select("kind", "begin", "stop", "y", F.explode(candidates(F.col("text"))).alias("c"))
    hit = (F.col("c.k") == F.col("kind")) & (F.col("c.start") < F.col("stop")) & (F.col("c.end") > F.col("begin")) & (F.col("y") == 1)
    got = found.select(*[F.col(f"c.{f}") for f in FEATURES], hit.cast("double")).orderBy("begin", "stop", "c").collect()
    m = np.array([list(r) for r in got], dtype=float).reshape(len(got), len(FEATURES) + 1)
    return m[:, :-1], m[:, -1]


class Model:
    """Boosted trees and one threshold for each kind, calibrated to a precision on sentences held out from fitting."""

    def __init__(self, base: float, forest: list, thresholds: tuple[float, ...]):
        self.base, self.forest, self.thresholds = base, forest, thresholds

    def margin(self, c: Column) -> Column:
        out = F.lit(self.base)
        for tree in self.forest:
            out = out + trees.column(tree, lambda i: c[FEATURES[i]])
        return out

    def threshold(self, k: Column) -> Column:
        out = F.lit(float("inf"))
        for i, t in enumerate(self.thresholds):
            out = F.when(k == i, F.lit(t)).otherwise(out)
        return out


def fit(x: np.ndarray, y: np.ndarray, n_trees: int = 24, depth: int = 3, precision: float = 0.98) -> Model:
    held = np.arange(len(y)) % 3 == 0
    base, forest = trees.boost(x[~held], y[~held], n_trees, depth)
    margin = base + sum(trees.predict(t, x[held]) for t in forest)
    thresholds = []
    for k in range(len(KINDS)):
        own = x[held][:, 0] == k
        m, t = margin[own], y[held][own]
        order = np.argsort(-m, kind="stable")
        right = np.cumsum(t[order]) / np.arange(1, len(order) + 1)
        last = np.append(m[order][1:] != m[order][:-1], True) if len(order) else np.array([], bool)
        good = np.flatnonzero((right >= precision) & last)
        thresholds.append(float(m[order][good[-1]]) if len(good) else float("inf"))
    return Model(base, forest, tuple(thresholds))


_models: dict[tuple[int, int], Model] = {}


def model(spark: SparkSession, n: int = 4000, seed: int = 7) -> Model:
    """The model of n generated sentences, fitted once a process (its features are computed in this session)."""
    if (n, seed) not in _models:
        _models[n, seed] = fit(*training_candidates(spark, n, seed))
    return _models[n, seed]


_SCORED = "struct<start:int,k:int,end:int,p:double>"


def chosen(spans: Column) -> Column:
    """Of spans in order of their start those that overlap none of a higher score that is kept.

    Spans that overlap, directly or through others, form a chain; each chain is
    gone through by score. So the work is the spans' number, but for long chains.
    """
    none = F.array().cast(f"array<{_SCORED}>")

    def best(chain: Column) -> Column:
        ranked = F.transform(F.array_sort(F.transform(chain, lambda c: F.struct((-c["p"]).alias("q"), c["start"].alias("start"), c["k"].alias("k"), c["end"].alias("end")))), lambda c: F.struct(c["start"].alias("start"), c["k"].alias("k"), c["end"].alias("end"), (-c["q"]).alias("p")))
        clash = lambda got, c: F.exists(got, lambda g: (g["start"] < c["end"]) & (c["start"] < g["end"]))
        several = F.aggregate(ranked, none, lambda got, c: F.when(clash(got, c), got).otherwise(F.concat(got, F.array(c))))
        return F.when(F.size(chain) > 1, several).otherwise(chain)

    def step(s: Column, c: Column) -> Column:
        ends = F.size(s["chain"]) == 0
        joins = ~ends & (c["start"] < s["to"])
        state = F.struct(F.when(joins, F.concat(s["chain"], F.array(c))).otherwise(F.array(c)).alias("chain"), F.when(joins, F.greatest(s["to"], c["end"])).otherwise(c["end"]).alias("to"))
        return F.struct(state.alias("state"), F.when(joins | ends, none).otherwise(best(s["chain"])).alias("out"))

    start = F.struct(none.alias("chain"), F.lit(0).alias("to"))
    return F.when(F.size(spans) > 1, scan(spans, start, step, _SCORED, lambda s: best(s["chain"]))).otherwise(spans)


def _scored(masked: Column, m: Model) -> Column:
    """The candidates that reach their kind's threshold, with their margin p."""
    scored = F.transform(candidates(masked), lambda c: F.struct(c["start"].alias("start"), c["k"].alias("k"), c["end"].alias("end"), m.margin(c).alias("p")))
    kept = F.filter(scored, lambda c: c["p"] >= m.threshold(c["k"]))
    return F.coalesce(kept, F.array().cast(f"array<{_SCORED}>"))


def _plain(spans: Column) -> Column:
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["k"].alias("k"), s["end"].alias("end")))


def listed(spans: Column) -> Column:
    """kind:start:end of the spans in their order, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["k"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def find(df: DataFrame, text: str = "text", use_model: Model | None = None, base: str = "base", every: str = "all") -> DataFrame:
    """Adds base and all (or as named): arrays of struct(start, k, end), code points, end exclusive, k an index of KINDS, sorted by (start, k, end)."""
    m = use_model or model(df.sparkSession)
    clean = F.coalesce(F.col(text), F.lit(""))
    df = df.withColumn("_pii_text", clean)
    t = F.col("_pii_text")
    df = df.withColumns({f"_pii_{k}": _plain(_base(t, k)) for k in KINDS})
    df = df.withColumn(base, F.array_sort(F.concat(*[F.col(f"_pii_{k}") for k in KINDS])))
    df = df.withColumn("_pii_pieces", F.when(F.size(base) > 0, pieces(t)))
    hidden = _replaced(F.col("_pii_pieces"), F.length(t), F.col(base), lambda x, a, b: F.repeat(F.lit("\u0001"), b - a))
    df = df.withColumn("_pii_masked", F.when(F.size(base) > 0, hidden).otherwise(t))
    df = df.withColumn("_pii_scored", _scored(F.col("_pii_masked"), m))
    df = df.withColumn("_pii_added", _plain(chosen(F.col("_pii_scored"))))
    df = df.withColumn(every, F.array_sort(F.concat(base, "_pii_added")))
    return df.drop("_pii_text", "_pii_pieces", "_pii_masked", "_pii_scored", "_pii_added", *[f"_pii_{k}" for k in KINDS])


def redact(df: DataFrame, text: str = "text", use_model: Model | None = None) -> DataFrame:
    """The table with every span's text replaced by its kind in brackets, as [EMAIL]. Overlapping spans become one, named by the first. A null text stays null."""
    columns = df.columns
    found = find(df.withColumn("_pii_row", F.col(text)), "_pii_row", use_model, "_pii_base", "_pii_every")
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    t, spans = F.col("_pii_row"), F.col("_pii_every")
    found = found.withColumn("_pii_cut", F.when(F.size(spans) > 0, pieces(t)))
    out = _replaced(F.col("_pii_cut"), F.length(t), spans, lambda x, a, b: F.when(x["start"] >= a, F.element_at(names, x["k"] + 1)).otherwise(F.lit("")))
    return found.withColumn(text, F.when(F.size(spans) > 0, out).otherwise(t)).select(*columns)


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every whole text of documents."""
    docs = common.read(spark, sf_dir, "documents").select("doc_id", "text")
    found = find(docs)
    count = lambda k: F.size(F.filter("base", lambda s: s["k"] == KINDS.index(k))).cast("long")
    return found.select(
        "doc_id", *[count(k).alias(f"n_{k}") for k in KINDS],
        F.sha2(listed(F.col("base")).cast("binary"), 256).alias("base_sha256"), listed(F.col("all")).alias("spans"),
    )
