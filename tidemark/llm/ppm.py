"""Language-model scoring: prediction by partial matching over bytes, and a smoothed word base.

The model is a byte-context trie over the 256 bytes (0xFF, which UTF-8 has
not, is the end of the text). Its contexts are the LONG bytes before, then one
byte less at a time down to none; a symbol that a context has not seen is
reached by an escape, estimated from the context's number of distinct symbols
(method C), and what a context has seen is excluded from the shorter ones. The
trie is pretrained on the training documents, and every count of it is kept.

No worker holds the trie. A task sums up its texts in chunks: the distinct
paths (LONG bytes and the byte after them) with their training counts, as
packed arrays dealt to buckets by a hash of the last DEALT bytes of the
context. A bucket thus has all counts of its contexts of DEALT bytes and more;
those of shorter ones (256**DEALT numbers at most) travel to all buckets. It
answers each chunk with the probabilities of the paths it asked for, and the
chunk's texts are joined with the answers and scored. `adaptive` gives the
code length of a text under a trie that learns as it goes. Model is a reduced
trie over byte classes that fits a worker; `score` doesn't use it.

The words' counts are gathered in the cluster, pre-aggregated in each task.
Counts of the HOT most frequent words (a fixed number) travel to the workers;
the other words of every document are joined with the counts by word, so no
key of that join is frequent.

Cases: a null or empty text is its end alone. Null ids train. Repeated rows
count as often as they occur and are scored each. Other columns are ignored.
Without training documents every token has probability 1 in the base and the
model is uniform. An empty table gives an empty result.
"""

from __future__ import annotations

import pickle
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import common
from tidemark.llm.shingles import mix

ORDER, LONG = 3, 5
SYMBOLS = 64
END = 63
#: Slots of Model's hash table.
SLOTS = 1 << 22
#: Bytes of a context that deal its paths to buckets.
DEALT = 3
#: Bytes of text in a chunk, and of all texts for each bucket.
CHUNK, BUCKET = 32 << 20, 16 << 20
#: The most frequent words whose counts are broadcast. A fixed number: about 40 MB in a worker.
HOT = 200_000
#: Distinct words a task counts before it passes its counts on.
HELD = 300_000
#: The end token among the words (not UTF-8, so no word).
END_WORD = b"\xff"
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def byte_classes() -> np.ndarray:
    """The class of every byte. Alone: letters (a-z with A-Z), frequent signs, the lead byte and some continuation bytes of accented letters. Grouped: digits, other ASCII signs, controls, other lead bytes, two halves of the other continuation bytes. 0xFF ends a text."""
    c = np.full(256, 33, np.uint8)
    c[:32] = c[127] = 34
    c[97:123] = c[65:91] = np.arange(26)
    for i, b in enumerate(b" \n.,|!#$%&*"):
        c[b] = 35 + i
    c[48:58] = 46
    c[0xC0:0xFF], c[0xC3] = 47, 48
    c[0x80:0xA0], c[0xA0:0xC0] = 49, 50
    for i, letter in enumerate("äöüßéèêçñíó"):
        c[letter.encode()[1]] = 51 + i
    c[255] = END
    return c


CLASSES = byte_classes()
GROUPED = np.isin(CLASSES, np.flatnonzero(np.bincount(CLASSES, minlength=SYMBOLS) > 1))


def layout(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All texts in one array, each led by LONG end bytes, one more at the very end; and where each begins and its end symbol lies."""
    lead = b"\xff" * LONG
    data = np.frombuffer(lead + lead.join(texts) + b"\xff", np.uint8)
    sizes = np.array([len(t) for t in texts], np.int64)
    begin = LONG + np.concatenate([[0], np.cumsum(sizes + LONG)[:-1]]).astype(np.int64)
    return data, begin, begin + sizes


def contexts(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For positions from LONG on: the path (classes of the LONG bytes before and of the byte itself), and the pair (class before, whether a capital; byte)."""
    c = CLASSES[data].astype(np.int64)
    n = len(c) - LONG
    path = c[:n].copy()
    for j in range(1, LONG + 1):
        path <<= 6
        path |= c[j : j + n]
    capital = (data[LONG - 1 : -1] >= 65) & (data[LONG - 1 : -1] < 91)
    return path, (c[LONG - 1 : -1] * 2 + capital) * 256 + data[LONG:]


def coded(begin: np.ndarray, end: np.ndarray, n: int) -> np.ndarray:
    """Which positions from LONG on are bytes or ends of texts, not leads."""
    step = np.zeros(n + 1, np.int32)
    np.add.at(step, begin - LONG, 1)
    np.add.at(step, end + 1 - LONG, -1)
    return np.cumsum(step[:-1]) > 0


def table_of(paths: np.ndarray, chunk: int = 4096) -> np.ndarray:
    """log10 probabilities of all symbols after all contexts of ORDER classes, from counts of paths (dense, SYMBOLS**(ORDER+1))."""
    s = SYMBOLS
    levels = [paths.reshape(s**ORDER, s)]
    for k in range(ORDER - 1, -1, -1):
        levels.append(levels[-1].reshape(s, s**k, s).sum(0))
    out = np.empty((s**ORDER, s), np.float32)
    for at in range(0, s**ORDER, chunk):
        rows = np.arange(at, min(at + chunk, s**ORDER))
        p = np.zeros((len(rows), s))
        reach = np.ones((len(rows), 1))
        open_ = np.ones((len(rows), s), bool)
        for k, level in enumerate(levels):
            c = level[rows % s ** (ORDER - k)].astype(np.float64) * open_
            seen = c > 0
            total, distinct = c.sum(1, keepdims=True), seen.sum(1, keepdims=True)
            last = distinct == open_.sum(1, keepdims=True)  # nothing is left to escape to
            whole = total + np.where(last, 0, distinct)
            safe = np.where(whole > 0, whole, 1)
            p += reach * c / safe
            reach = np.where(whole > 0, reach * np.where(last, 0, distinct) / safe, reach)
            open_ &= ~seen
        left = open_.sum(1, keepdims=True)
        p += np.where(left > 0, reach * open_ / np.where(left > 0, left, 1), 0)
        out[rows] = np.log10(np.maximum(p, 1e-300))
    return out


def residual_of(pairs: np.ndarray) -> np.ndarray:
    """log10 probability of a byte inside its class given the pair's first part, add-one smoothed; 0 where the class is one byte. Indexed like pairs."""
    c = pairs.reshape(-1, 256).astype(np.float64) + 1
    out = np.zeros(c.shape)
    for k in range(SYMBOLS):
        own = np.flatnonzero((CLASSES == k) & (np.arange(256) != 255))
        if len(own) > 1:
            out[:, own] = np.log10(c[:, own] / c[:, own].sum(1, keepdims=True))
    return out.reshape(-1).astype(np.float32)


class Table:
    """Exact lookup of 64-bit keys in two candidate slots; of keys that contend for slots the earlier ones win and the rest stay out (see `kept`)."""

    def __init__(self, keys: np.ndarray, slots: int):
        self.slots, self.keys = slots, np.full(slots, -1, np.int64)
        self.kept = np.zeros(len(keys), bool)
        for place in (0, 1):
            rest = np.flatnonzero(~self.kept)
            at = self._slot(keys[rest], place)
            free = self.keys[at] == -1
            at, rest = at[free], rest[free]
            _, first = np.unique(at, return_index=True)
            self.keys[at[first]] = keys[rest[first]]
            self.kept[rest[first]] = True
        self.value = np.zeros(slots, np.float32)

    def _slot(self, keys: np.ndarray, place: int) -> np.ndarray:
        h = mix(keys.astype(np.uint64))
        return ((h >> np.uint64(32 * place)) & np.uint64(self.slots - 1)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key, -1 where it is not kept."""
        at = self._slot(keys, 0)
        miss = np.flatnonzero(self.keys[at] != keys)
        other = self._slot(keys[miss], 1)
        at[miss] = np.where(self.keys[other] == keys[miss], other, -1)
        return at


class Model:
    """log10 probabilities: the dense table, the long contexts' symbols and escapes, and bytes inside classes."""

    def __init__(self, short: np.ndarray, grams: np.ndarray, n: np.ndarray, pairs: np.ndarray, slots: int = SLOTS):
        self.short, self.residual = table_of(short).reshape(-1), residual_of(pairs)
        order = np.lexsort((grams, -n))
        grams, n = grams[order], n[order]
        self.grams = Table(grams, slots)
        grams, n = grams[self.grams.kept], n[self.grams.kept]
        heads = np.unique(grams >> 6)
        self.heads = Table(heads, slots // 2)
        kept = self.heads.find(grams >> 6) >= 0
        drop = self.grams.find(grams[~kept])
        self.grams.keys[drop] = -1
        grams, n = grams[kept], n[kept].astype(np.float64)
        heads, own = np.unique(grams >> 6, return_inverse=True)
        total, distinct = np.bincount(own, n, len(heads)), np.bincount(own, minlength=len(heads))
        mass = np.bincount(own, 10.0 ** self.short[grams % SYMBOLS ** (ORDER + 1)], len(heads))
        self.grams.value[self.grams.find(grams)] = np.log10(n / (total + distinct)[own])
        # the escape, shared out over what the longer context has not seen
        self.heads.value[self.heads.find(heads)] = np.log10(distinct / (total + distinct)) - np.log10(np.maximum(1 - mass, 1e-9))

    def symbols(self, path: np.ndarray) -> np.ndarray:
        p = self.short[path & (SYMBOLS ** (ORDER + 1) - 1)].astype(np.float64)
        head = self.heads.find(path >> 6)
        known = np.flatnonzero(head >= 0)
        p[known] += self.heads.value[head[known]]
        at = self.grams.find(path[known])
        seen = at >= 0
        p[known[seen]] = self.grams.value[at[seen]]
        return p

    def log_probability(self, texts: list[bytes]) -> np.ndarray:
        """log10 probability of each text with its end."""
        if not texts:
            return np.zeros(0)
        data, begin, end = layout(texts)
        path, pair = contexts(data)
        p = self.symbols(path) + self.residual[pair]
        return np.array([p[b:e].sum() for b, e in zip(begin - LONG, end + 1 - LONG, strict=True)])


def byte_paths(data: np.ndarray) -> np.ndarray:
    """For positions from LONG on: the LONG bytes before and the byte itself, as one number."""
    n = len(data) - LONG
    path = data[:n].astype(np.int64)
    for j in range(1, LONG + 1):
        path <<= 8
        path |= data[j : j + n]
    return path


def summed(code: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes in order with the sums of their counts."""
    if not len(code):
        return code, n
    order = np.argsort(code)
    code, n = code[order], n[order]
    first = np.flatnonzero(np.append(True, code[1:] != code[:-1]))
    return code[first], np.add.reduceat(n, first)


def learnt_paths(path: np.ndarray, learnt: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct paths in order, and how often each was learnt. Path and mark are one number, so values are sorted, not places."""
    marked = np.sort(path << 1 | learnt)
    path = marked >> 1
    first = np.flatnonzero(np.append(True, path[1:] != path[:-1]))
    return path[first], np.add.reduceat(marked & 1, first)


def _block(part: pa.RecordBatch) -> bytes:
    """The batch, compressed."""
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, part.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as stream:
        stream.write_batch(part)
    return out.getvalue().to_pybytes()


def _at(keys: np.ndarray, values: np.ndarray, asked: np.ndarray) -> np.ndarray:
    """The values of the asked keys, 0 for those that are not among the (sorted) keys."""
    if not len(keys):
        return np.zeros(len(asked), np.int64)
    at = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
    return np.where(keys[at] == asked, values[at], 0)


def path_logs(asked: np.ndarray, paths: np.ndarray, n: np.ndarray, short: np.ndarray, short_n: np.ndarray) -> np.ndarray:
    """log10 probabilities of the last bytes of the asked paths after the bytes before them.

    paths and n are the training counts (all that share their last DEALT context
    bytes with an asked path, sorted), short and short_n those of all paths of DEALT bytes.
    """
    mask = lambda k: (1 << 8 * (k + 1)) - 1
    levels = {k: (paths, n) if k == LONG else summed(paths & mask(k), n) for k in range(LONG, DEALT - 1, -1)}
    levels |= {k: summed(short & mask(k), short_n) for k in range(DEALT - 1, -1, -1)}
    out, open_ = np.zeros(len(asked)), np.ones(len(asked), bool)
    above, gone = np.zeros(len(asked), np.int64), np.zeros(len(asked), np.int64)
    for k in range(LONG, -1, -1):
        code, c = levels[k]
        head = code >> 8
        first = np.flatnonzero(np.append(True, head[1:] != head[:-1])) if len(head) else np.zeros(0, np.int64)
        ends, own = head[first], asked & mask(k)
        total = _at(ends, np.add.reduceat(c, first) if len(first) else c, own >> 8)
        distinct = _at(ends, np.diff(np.append(first, len(head))), own >> 8)
        seen = _at(code, c, own)
        # what the longer context has seen is excluded: its symbols, and their counts here
        fresh = distinct - above
        whole = total - gone + np.where(distinct == 256, 0, fresh)
        found = open_ & (seen > 0)
        out[found] += np.log10(seen[found] / whole[found])
        open_ &= ~found
        passed = open_ & (whole > 0)
        out[passed] += np.log10(fresh[passed] / whole[passed])
        above = distinct
        if k:
            below = _at(*levels[k - 1], code & mask(k - 1))
            gone = _at(ends, np.add.reduceat(below, first) if len(first) else below, own >> 8)
    out[open_] -= np.log10(256 - above[open_])
    return out


def adaptive(text: bytes, order: int = ORDER) -> float:
    """log10 probability of a text under a trie over bytes that starts empty and learns each byte after coding it (escape method C, exclusion)."""
    trie: dict[bytes, Counter] = {}
    out, history = 0.0, b""
    for symbol in [*text, 256]:
        excluded: set[int] = set()
        done = False
        for k in range(min(order, len(history)), -1, -1):
            node = trie.get(history[len(history) - k :])
            if not node:
                continue
            live = {s: c for s, c in node.items() if s not in excluded}
            total, distinct = sum(live.values()), len(live)
            if not live:
                continue
            whole = total + (0 if distinct + len(excluded) == 257 else distinct)
            if symbol in live:
                out += float(np.log10(live[symbol] / whole))
                done = True
                break
            out += float(np.log10(distinct / whole))
            excluded |= live.keys()
        if not done:
            out -= float(np.log10(257 - len(excluded)))
        for k in range(min(order, len(history)) + 1):
            trie.setdefault(history[len(history) - k :], Counter())[symbol] += 1
        history = (history + bytes([symbol]))[-order:] if symbol < 256 else history
    return out


_PARTS = "kind int, chunk long, bucket int, word binary, code long, n long"


def _learner(buckets: int):  # noqa: ANN202
    """Counts of words (kind 0), packed paths of a chunk in a bucket with their training counts (1), training counts of paths of DEALT bytes (2), and blocks of rows, compressed, with their chunk (3)."""

    def rows(kind: int, size: int, **columns) -> pa.RecordBatch:  # noqa: ANN003
        types = {"chunk": pa.int64(), "bucket": pa.int32(), "word": pa.binary(), "code": pa.int64(), "n": pa.int64()}
        given = {name: pa.array(columns[name], t) if name in columns else pa.nulls(size, t) for name, t in types.items()}
        return pa.RecordBatch.from_arrays([pa.array(np.full(size, kind, np.int32)), *given.values()], names=["kind", *given])

    def of_words(words: Counter) -> Iterator[pa.RecordBatch]:
        held, n = list(words), np.fromiter(words.values(), np.int64)
        for at in range(0, len(held), 50_000):
            yield rows(0, len(held[at : at + 50_000]), word=held[at : at + 50_000], n=n[at : at + 50_000])

    def of_chunk(chunk: int, parts: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        code, n = summed(np.concatenate([c for c, _ in parts]), np.concatenate([n for _, n in parts]))
        bucket = (mix((code >> 8 & (1 << 8 * DEALT) - 1).astype(np.uint64)) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        edges = np.searchsorted(bucket[order], np.arange(buckets + 1))
        for b in range(buckets):
            if len(own := order[edges[b] : edges[b + 1]]):
                yield rows(1, 1, chunk=[chunk], bucket=[b], word=[_packed(code[own], n[own])])
        code, n = summed(code[n > 0] & (1 << 8 * DEALT) - 1, n[n > 0])
        for at in range(0, len(code), 200_000):
            yield rows(2, len(code[at : at + 200_000]), code=code[at : at + 200_000], n=n[at : at + 200_000])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, size = TaskContext.get().partitionId() << 24, 0
        grams: list[tuple[np.ndarray, np.ndarray]] = []
        words: Counter = Counter()
        for part, texts in common.text_chunks(batches, "text", 2 << 20):
            held = part.column(2).to_numpy(zero_copy_only=False).astype(bool)
            for t, h in zip(texts, held, strict=True):
                if not h:
                    words.update(t.translate(LOWER).split())
                    words[END_WORD] += 1
            data, begin, end = layout(texts)
            use = coded(begin, end, len(data) - LONG)
            path = byte_paths(data)[use]
            grams.append(learnt_paths(path, np.repeat(~held, end + 1 - begin)))
            yield rows(3, 1, chunk=[chunk], word=[_block(part)])
            size += len(data)
            if sum(len(c) for c, _ in grams) > 2_000_000:
                grams = [summed(np.concatenate([c for c, _ in grams]), np.concatenate([n for _, n in grams]))]
            if size > CHUNK:
                yield from of_chunk(chunk, grams)
                chunk, size, grams = chunk + 1, 0, []
            if len(words) > HELD:
                yield from of_words(words)
                words = Counter()
        if grams:
            yield from of_chunk(chunk, grams)
        if words:
            yield from of_words(words)

    return run


def _answerer(shared):  # noqa: ANN001, ANN202
    """For every chunk in a bucket its packed paths with their log10 probabilities."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        short, short_n = _unpacked(shared.value)
        for _, table in common.sorted_groups(batches, "bucket"):
            asked, parts, size = table.column("word"), [], 0
            for a in asked:
                code, n = _unpacked(a.as_py())
                parts.append((code, n))
                size += len(code)
                if size > 4_000_000 and len(parts) > 1:
                    parts = [summed(np.concatenate([c for c, _ in parts]), np.concatenate([n for _, n in parts]))]
                    size = 0
            code, n = summed(np.concatenate([c for c, _ in parts]), np.concatenate([n for _, n in parts]))
            del parts
            p = path_logs(code, code[n > 0], n[n > 0], short, short_n)
            for chunk, a in zip(table.column("chunk"), asked, strict=True):
                own, _ = _unpacked(a.as_py())
                logs = p[np.searchsorted(code, own)]
                yield pa.RecordBatch.from_arrays([pa.array([chunk.as_py()], pa.int64()), pa.array([_packed(own)], pa.binary()), pa.array([_squeezed(logs)], pa.binary())], names=["chunk", "text", "logs"])

    return run


def log_probability(texts: list[bytes], code: np.ndarray, logs: np.ndarray) -> np.ndarray:
    """log10 probability of each text with its end, from those of its paths."""
    data, begin, end = layout(texts)
    path, back = np.unique(byte_paths(data)[coded(begin, end, len(data) - LONG)], return_inverse=True)
    at = np.searchsorted(code, path)
    if not np.array_equal(code[np.minimum(at, len(code) - 1)], path):
        raise RuntimeError("a path of a chunk has no answer")
    sizes = end + 1 - begin
    return np.add.reduceat(logs[at][back], np.cumsum(sizes) - sizes)


def _gathered(counts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Codes and counts as arrays, in order of the code. There are no more codes than the model's size, whatever the input."""
    got = counts.groupBy("code").agg(F.sum("n").alias("n")).toArrow()
    code, n = got.column("code").to_numpy(), got.column("n").to_numpy()
    order = np.argsort(code)
    return code[order], n[order]


def dense(code: np.ndarray, n: np.ndarray, size: int) -> np.ndarray:
    out = np.zeros(size, np.float32)
    out[code] = n
    return out


def _squeezed(a: np.ndarray) -> bytes:
    """The array's bytes, all first bytes before all second ones and so on, compressed."""
    import zstandard

    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(a).view(np.uint8).reshape(len(a), -1).T.tobytes() if len(a) else b"")


def _opened(data: bytes, kind: type) -> np.ndarray:
    import zstandard

    raw = zstandard.ZstdDecompressor().decompress(data)
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(size, -1).T).view(kind).reshape(-1) if raw else np.zeros(0, kind)


def _packed(*arrays: np.ndarray) -> bytes:
    """Arrays of whole numbers, compressed: sorted ones as differences."""
    parts = []
    for a in arrays:
        a = a.astype(np.int64)
        rising = bool(len(a) and (np.diff(a) >= 0).all())
        parts.append((rising, _squeezed(np.diff(a, prepend=0) if rising else a)))
    return pickle.dumps(parts)


def _unpacked(data: bytes) -> list[np.ndarray]:
    return [np.cumsum(a) if rising else a for rising, raw in pickle.loads(data) for a in [_opened(raw, np.int64)]]


_logs: tuple[str, dict[bytes, float]] | None = None


def _word_logs(tag: str, words: list[bytes], counts: list[int]) -> dict[bytes, float]:
    """The words' logarithms, built once in a worker from the counts."""
    global _logs
    if _logs is None or _logs[0] != tag:
        _logs = tag, {w: float(np.log10(c + 1)) for w, c in zip(words, counts, strict=True)}
    return _logs[1]


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[bytes], np.ndarray, np.ndarray]]:
    """Slices of the rows (doc_id, text, held_out) with the paths and logarithms of their chunk, whose answers come before its blocks."""
    current, held, code, logs = None, [], None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        chunks, is_text = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        edges = np.flatnonzero(np.append(True, (chunks[1:] != chunks[:-1]) | (is_text[1:] != is_text[:-1])))
        for a, b in zip(edges.tolist(), [*edges[1:].tolist(), len(chunks)], strict=True):
            part = batch.slice(a, b - a)
            if chunks[a] != current:
                current, held, code = chunks[a], [], None
            if not is_text[a]:
                held += [(_unpacked(g)[0], _opened(p, np.float64)) for g, p in zip(part.column(2).to_pylist(), part.column(3).to_pylist(), strict=True)]
                continue
            if code is None:
                code, logs = np.concatenate([c for c, _ in held]), np.concatenate([p for _, p in held])
                order = np.argsort(code)
                code, logs, held = code[order], logs[order], []
            for block in part.column(2):
                for rows, texts in common.text_chunks(pa.ipc.open_stream(block.as_buffer()), "text", 1 << 20):
                    yield rows, texts, code, logs


def train_is(column):  # noqa: ANN001, ANN201
    return ~F.coalesce(common.crc_mod(column, 7) == 2, F.lit(False))


def score(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every row of docs(doc_id, text)."""
    spark = docs.sparkSession
    common.tune(spark)
    docs = docs.select("doc_id", "text", (~train_is(F.col("doc_id"))).alias("held_out"))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(16, -(-size // BUCKET))
    parts = common.settle(docs.mapInArrow(_learner(buckets), _PARTS), "counts", ("kind",))
    counts = common.settle(parts.where("kind = 0").groupBy("word").agg(F.sum("n").alias("c")), "words")
    total, distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    log_all = float(np.log10(total + 1 * (distinct + 1)))
    top = counts.orderBy(F.col("c").desc(), "word").limit(hot).toArrow()
    words, times = [bytes(w) for w in top.column("word").to_pylist()], top.column("c").to_pylist()
    ends = counts.where(F.col("word") == F.lit(END_WORD)).agg(F.coalesce(F.sum("c"), F.lit(0))).first()[0]
    known_end = float(np.log10(ends + 1)), int(ends > 0)
    del top
    # fixed numbers at most travel: 256**DEALT counts of short paths, `hot` words
    short = spark.sparkContext.broadcast(_packed(*_gathered(parts.where("kind = 2").select("code", "n"))))
    tag = uuid.uuid4().hex
    shared = spark.sparkContext.broadcast((words, times))
    del words, times
    asked = parts.where("kind = 1").select("bucket", "chunk", "word").repartition(buckets, "bucket").sortWithinPartitions("bucket")
    answers = asked.mapInArrow(_answerer(short), "chunk long, text binary, logs binary")
    texts = parts.where("kind = 3").select("chunk", F.col("word").alias("text"))
    both = texts.withColumn("is_text", F.lit(1)).withColumn("logs", F.lit(None).cast("binary")).unionByName(answers.withColumn("is_text", F.lit(0)), allowMissingColumns=True)
    chunks = max(1, texts.select("chunk").distinct().count())
    both = both.select("chunk", "is_text", "text", "logs").repartition(4 * chunks, "chunk").sortWithinPartitions("chunk", "is_text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        logs = _word_logs(tag, *shared.value)
        row = TaskContext.get().partitionId() << 40
        names = ["kind", "row", "doc_id", "held_out", "n_tokens", "n_known", "base", "score", "word", "tf"]
        for part, texts, code, p in _joined(batches):
            n_tokens, n_known, base, rare = [], [], [], []
            for i, t in enumerate(texts):
                words = t.translate(LOWER).split()
                got = [logs.get(w) for w in words]
                unknown = got.count(None)
                n_tokens.append(len(words) + 1)
                n_known.append(len(words) - unknown + known_end[1])
                if unknown:
                    rare += [(row + i, w, n) for w, n in Counter(w for w, v in zip(words, got, strict=True) if v is None).items()]
                    base.append(sum(v for v in got if v is not None) + known_end[0])
                else:
                    base.append(sum(got) + known_end[0])
            n = len(texts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.zeros(n, np.int32)), pa.array(np.arange(row, row + n)), part.column(0), part.column(2), pa.array(n_tokens, pa.int64()), pa.array(n_known, pa.int64()), pa.array(base, pa.float64()), pa.array(log_probability(texts, code, p)), pa.nulls(n, pa.binary()), pa.nulls(n, pa.int64())],
                names=names,
            )
            if rare:
                r, w, f = zip(*rare, strict=True)
                m = len(r)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.ones(m, np.int32)), pa.array(r, pa.int64()), pa.nulls(m, pa.int64()), pa.nulls(m, pa.bool_()), pa.nulls(m, pa.int64()), pa.nulls(m, pa.int64()), pa.nulls(m, pa.float64()), pa.nulls(m, pa.float64()), pa.array(w, pa.binary()), pa.array(f, pa.int64())],
                    names=names,
                )
            row += n

    schema = "kind int, row long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, score double, word binary, tf long"
    scored = common.settle(both.mapInArrow(run, schema), "scored", ("kind",))
    rare = scored.where("kind = 1").select("row", "word", "tf").join(counts, "word")
    rare = rare.groupBy("row").agg(F.sum("tf").alias("_known"), F.sum(F.col("tf") * F.log10(F.col("c") + 1)).alias("_base"))
    rows = scored.where("kind = 0").drop("word", "tf", "kind")
    return rows.join(rare, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("_known", F.lit(0))).alias("n_known"), F.lit(int(total)).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("_base", F.lit(0.0)) - F.col("n_tokens") * log_all).alias("base_score"), "score",
    )


def op5_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's log10 probability under the base and under the trie, both learnt from the documents that are not held out."""
    return score(common.read(spark, sf_dir, "documents").select("doc_id", "text"))
