"""SentencePiece encoding with seeded merge-dropout, and lossless decoding.

A text is cut before its spaces (no piece of the vocabulary holds a space
after another character, which is checked), and each part is merged by an
agenda of candidate merges in order of their score. A candidate that comes to
the top is skipped for good with the probability of the dropout. The draws
are keyed by seed, document and the part's place in it, so reruns agree, and
every occurrence of a word is split anew. With a dropout of 0 the result is the library's own.
Characters outside the vocabulary become their UTF-8 bytes, and so does the
literal U+2581, which otherwise stands for a space; so decoding always gives
the text back.

The vocabulary (its size is the tokenizer's) travels with the function. The
agendas of many parts run at once, in arrays: each step takes the best candidate
of every part, and skips it or merges it. A worker remembers what a part gives
without skips, and how many candidates come to the top for that, for REMEMBERED
parts and those of one round of PARTS more; an occurrence whose draw skips one of
them has an agenda of its own. No shuffle.

Cases: a null text has null ids and decodes to null; the empty text has no ids
and decodes to ''. Very long texts and parts without spaces are encoded whole.
Repeated rows with equal ids have equal results. Null ids of documents are
keyed by the text. Other columns pass through; input columns named like a result
column are replaced. An empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import math
from array import array
from collections.abc import Iterator
from functools import cache
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import common
from tidemark.llm.shingles import mix

DROPOUT, SEED = 0.1, 23
#: Keys that the tests encode under.
VARIANTS = 2
REMEMBERED = 320_000
#: Parts of so many characters at most are merged many at once, with ROWS agendas in a batch.
SHORT, ROWS = 48, 8192
#: Parts that are looked up at once; so few are merged one after another.
PARTS, FEW = 200_000, 8
NONE, NEVER, WORST = float("-inf"), 1 << 60, (1 << 31) - 1
#: What stands for a space, and a part (no other holds a space) for that character itself.
SPACE, LITERAL = "▁", " "


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@cache
def model_bytes(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def _whole(part: str) -> str:
    """A part as it is merged, from the form that it is remembered by."""
    return part[1:] if part[:1] == " " else SPACE + part


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of ranges, one after another."""
    ends = np.cumsum(sizes)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(starts - ends + sizes, sizes)


class Codec:
    """Encoder and decoder of one SentencePiece merge model."""

    def __init__(self, proto: bytes, dropout: float = DROPOUT, seed: int = SEED):
        import sentencepiece

        library = sentencepiece.SentencePieceProcessor(model_proto=proto)
        size = library.get_piece_size()
        if size > 1 << 16:
            raise ValueError("ids are kept in 16 bits")
        self.bytes = [-1] * 256
        self.ids: dict[str, int] = {}
        self.scores: dict[str, float] = {}
        self.pieces: list[bytes] = []
        for i in range(size):
            piece = library.id_to_piece(i)
            if library.is_byte(i):
                self.bytes[int(piece[3:5], 16)] = i
                self.pieces.append(bytes([int(piece[3:5], 16)]))
            elif library.is_control(i) or library.is_unknown(i) or library.is_unused(i):
                self.pieces.append(b"")
            else:
                if SPACE in piece.lstrip(SPACE):
                    raise ValueError("a piece holds a space after another character")
                self.ids[piece] = i
                self.scores[piece] = library.get_score(i)
                self.pieces.append(piece.replace(SPACE, " ").encode())
        if min(self.bytes) < 0:
            raise ValueError("the vocabulary has no byte pieces")
        self.seed = seed & 0xFFFFFFFF
        #: The logarithm of a candidate's staying; skips are geometric gaps apart.
        self.stay = math.log1p(-dropout) if 0 < dropout < 1 else -math.inf if dropout else 0.0
        self._prepare()
        self._forget()

    def _bytes_of(self, text: str) -> list[int]:
        return [self.bytes[b] for b in text.encode("utf-8", "replace")]

    def _gap(self, draw: int) -> int:
        """How many candidates come to the top before the next one that is skipped."""
        return int(math.log(((draw >> 11) + 0.5) * 2.0**-53) / self.stay) if self.stay else NEVER

    def _gaps(self, draw: int) -> Iterator[int]:
        while True:
            yield self._gap(draw)
            draw = (draw * 6364136223846793005 + 1442695040888963407) & 0xFFFFFFFFFFFFFFFF

    def _short(self, symbols: list[str], draw: int) -> list[str]:
        """The agenda of a few candidates: a list of their scores, scanned for the best (the leftmost, if equal)."""
        return self._scanned(symbols, self._gaps(draw))[0]

    def _scanned(self, symbols: list[str], gaps: Iterator[int]) -> tuple[list[str], int]:
        """The symbols merged with skips so far apart, and how many candidates came to the top after the last skip."""
        scores = self.scores.get
        ranks = [scores(a + b, NONE) for a, b in zip(symbols, symbols[1:], strict=False)]
        gap, passed = next(gaps, NEVER), 0
        while ranks:
            best = max(ranks)
            if best == NONE:
                break
            i = ranks.index(best)
            if passed == gap:
                gap, passed = next(gaps, NEVER), 0
                ranks[i] = NONE
                continue
            passed += 1
            symbols[i] = merged = symbols[i] + symbols.pop(i + 1)
            del ranks[i]
            if i < len(ranks):
                ranks[i] = scores(merged + symbols[i + 1], NONE)
            if i:
                ranks[i - 1] = scores(symbols[i - 1] + merged, NONE)
        return symbols, passed

    def _long(self, symbols: list[str], draw: int) -> list[str]:
        """The same with a heap and linked symbols, for parts without a bound."""
        return self._heaped(symbols, self._gaps(draw))[0]

    def _heaped(self, symbols: list[str], gaps: Iterator[int]) -> tuple[list[str], int]:
        n = len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        scores = self.scores
        agenda = [(-s, i, 2) for i in range(n - 1) if (s := scores.get(symbols[i] + symbols[i + 1])) is not None]
        heapq.heapify(agenda)
        gap, passed = next(gaps, NEVER), 0
        while agenda:
            _, i, size = heapq.heappop(agenda)
            left, j = symbols[i], after[i]
            if not left or j >= n or len(left) + len(symbols[j]) != size:
                continue
            if passed == gap:
                gap, passed = next(gaps, NEVER), 0
                continue
            passed += 1
            symbols[i] = merged = left + symbols[j]
            symbols[j] = ""
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (s := scores.get(merged + symbols[k])) is not None:
                    heapq.heappush(agenda, (-s, i, len(merged) + len(symbols[k])))
            if (b := before[i]) >= 0 and (s := scores.get(symbols[b] + merged)) is not None:
                heapq.heappush(agenda, (-s, b, len(symbols[b]) + len(merged)))
        return [s for s in symbols if s], passed

    def _merged(self, part: str, gaps: Iterator[int]) -> tuple[int, bytes]:
        """How many candidates came to the top after the last skip, and the ids of a part (its leading spaces as U+2581), two bytes each."""
        if part == LITERAL:
            return 0, array("H", self._bytes_of(SPACE)).tobytes()
        symbols, passed = self._scanned(list(part), gaps) if len(part) <= SHORT else self._heaped(list(part), gaps)
        return passed, self._pack(symbols)

    def _pack(self, symbols: list[str]) -> bytes:
        ids = list(map(self.ids.get, symbols))
        if None in ids:
            ids = [b for s, i in zip(symbols, ids, strict=True) for b in ([i] if i is not None else self._bytes_of(s))]
        return array("H", ids).tobytes()

    def _prepare(self) -> None:
        """Codes of symbols (a piece's is its id, further ones are single characters), the ids that each stands for, and the pairs that merge."""
        self.code = np.full(0x110000, -1, np.int32)
        self.stands: list[list[int]] = [[i] for i in range(len(self.pieces))]
        for piece, i in self.ids.items():
            if len(piece) == 1:
                self.code[ord(piece)] = i
        single = sorted({c for piece in self.ids for c in piece if c not in self.ids})
        self._number([ord(c) for c in single] + [ord(LITERAL)])
        order = {s: n for n, s in enumerate(sorted(set(self.scores.values()), reverse=True))}
        known = self.ids.keys() | set(single)
        code = lambda s: int(self.code[ord(s)]) if len(s) == 1 else self.ids[s]
        pairs = [(code(p[:i]) << 32 | code(p[i:]), order[self.scores[p]] << 6, m) for p, m in self.ids.items() for i in range(1, len(p)) if p[:i] in known and p[i:] in known]
        keys, ranks, merged = (np.array(c, np.int64) for c in zip(*pairs, strict=True)) if pairs else (np.zeros(0, np.int64),) * 3
        self.bits = max(10, int(8 * len(pairs)).bit_length())
        self.pair_key = np.full(1 << self.bits, -1, np.int64)
        self.pair_rank = np.full(1 << self.bits, WORST, np.int32)
        self.pair_code = np.zeros(1 << self.bits, np.int32)
        at, left = self._slot(keys), np.arange(len(keys))
        while len(left):
            # of several pairs at a free slot one gets it, the others go on to the next slot
            free = left[self.pair_key[at[left]] < 0]
            self.pair_key[at[free]] = keys[free]
            left = left[self.pair_key[at[left]] != keys[left]]
            at[left] = at[left] + 1 & (1 << self.bits) - 1
        self.pair_rank[at], self.pair_code[at] = ranks, merged

    def _number(self, characters: list[int]) -> None:
        """Codes for characters that are no pieces; they stand for their bytes."""
        for c in characters:
            self.code[c] = len(self.stands)
            self.stands.append(self._bytes_of(SPACE if c == ord(LITERAL) else chr(c)))
        sizes = [len(i) for i in self.stands]
        self.size_of, self.start_of = np.array(sizes, np.int64), np.cumsum([0, *sizes[:-1]])
        self.flat = np.array([i for ids in self.stands for i in ids], np.uint16)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - self.bits)).astype(np.int64)

    def _pairs(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The slots of pairs of codes: with rank WORST where they don't merge."""
        keys = left.astype(np.int64) << 32 | right
        at = self._slot(keys)
        got = self.pair_key[at]
        rest = np.flatnonzero((got != keys) & (got >= 0))
        while len(rest):
            at[rest] = at[rest] + 1 & (1 << self.bits) - 1
            got = self.pair_key[at[rest]]
            rest = rest[(got != keys[rest]) & (got >= 0)]
        return at

    def _gaps_of(self, draws: np.ndarray) -> np.ndarray:
        if not self.stay:
            return np.full(len(draws), NEVER)
        return (np.log(((draws >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / self.stay).astype(np.int64)

    def _agendas(self, parts: list[str], draws: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The agendas of parts of SHORT characters at most, all at once: how many candidates came to the top
        after the last skip, how many ids each part has, and the ids of all one after another. Without draws, nothing is skipped."""
        n = len(parts)
        lengths = np.fromiter(map(len, parts), np.int64, n)
        points = np.frombuffer("".join(parts).encode("utf-32-le", "surrogatepass"), np.uint32)
        if len(new := np.unique(points[self.code[points] < 0])):
            self._number(new.tolist())
        codes, starts = self.code[points], np.cumsum(lengths) - lengths
        passed, sizes = np.zeros(n, np.int64), np.zeros(n, np.int64)
        found: list[tuple[np.ndarray, np.ndarray]] = []
        by_length = np.argsort(lengths, kind="stable")
        edges = np.searchsorted(lengths[by_length], [1, 5, 7, 9, 12, 16, 24, SHORT + 1])
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            for at in range(a, b, ROWS):
                rows = by_length[at : min(at + ROWS, b)]
                width = int(lengths[rows[-1]])
                place = np.arange(width)[:, None]
                inside = place < lengths[rows]
                symbols = np.where(inside, codes[np.minimum(starts[rows] + place, len(codes) - 1)], -1)
                passed[rows], merged = self._batch(symbols, None if draws is None else draws[rows])
                used = merged.T >= 0
                flat = merged.T[used]
                # the ids of each symbol, then how many there are for each part
                many = self.size_of[flat]
                ids = self.flat[_ranges(self.start_of[flat], many)]
                sizes[rows] = np.bincount(np.nonzero(used)[0], many, len(rows)).astype(np.int64)
                found.append((rows, ids))
        ends = np.cumsum(sizes)
        out = np.empty(int(ends[-1]) if n else 0, np.uint16)
        for rows, ids in found:
            out[_ranges((ends - sizes)[rows], sizes[rows])] = ids
        return passed, sizes, out

    def _batch(self, symbols: np.ndarray, draws: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        """Columns of codes (-1: none) merged: how many candidates came to the top after the last skip, and the codes left, where each symbol began."""
        width, n = symbols.shape
        done, passed_of = symbols.copy(), np.zeros(n, np.int64)
        column = np.arange(n)
        after = np.repeat(np.arange(1, width + 1)[:, None], n, 1)
        before = after - 2
        rank = np.full((width, n), WORST, np.int32)
        for i in range(width - 1):
            best = self.pair_rank[self._pairs(symbols[i], symbols[i + 1])]
            rank[i] = np.where((symbols[i + 1] >= 0) & (best < WORST), best | i, WORST)
        passed = np.zeros(n, np.int64)
        gap = None if draws is None else self._gaps_of(draws)
        while True:
            top = rank.min(0)
            live = np.flatnonzero(top < WORST)
            if len(live) < 0.75 * len(top):
                done[:, column], passed_of[column] = symbols, passed
                if not len(live):
                    return passed_of, done
                symbols, after, before, rank = symbols[:, live], after[:, live], before[:, live], rank[:, live]
                column, passed, top = column[live], passed[live], top[live]
                if draws is not None and gap is not None:
                    draws, gap = draws[live], gap[live]
                live = np.arange(len(live))
            i = top[live] & 63
            if draws is not None and gap is not None:
                skip = passed[live] == gap[live]
                if skip.any():
                    s = live[skip]
                    rank[i[skip], s] = WORST
                    draws[s] = draws[s] * np.uint64(6364136223846793005) + np.uint64(1442695040888963407)
                    gap[s], passed[s] = self._gaps_of(draws[s]), 0
                    live, i = live[~skip], i[~skip]
            passed[live] += 1
            j = after[i, live]
            merged = self.pair_code[self._pairs(symbols[i, live], symbols[j, live])]
            symbols[i, live], symbols[j, live], rank[j, live] = merged, -1, WORST
            k = after[j, live]
            after[i, live], rank[i, live] = k, WORST
            more = np.flatnonzero(k < width)
            r, to, own = live[more], k[more], i[more]
            before[to, r] = own
            best = self.pair_rank[self._pairs(merged[more], symbols[to, r])]
            rank[own, r] = np.where((symbols[to, r] >= 0) & (best < WORST), best | own, WORST)
            b = before[i, live]
            more = np.flatnonzero(b >= 0)
            r, to = live[more], b[more]
            best = self.pair_rank[self._pairs(symbols[to, r], merged[more])]
            rank[to, r] = np.where(best < WORST, best | to, WORST)

    def encode(self, text: str, key: int = 0) -> np.ndarray:
        """The ids of a text; the key is the document's."""
        return self.encode_all([text], [key])[0]

    def encode_all(self, texts: list[str], keys: list[int]) -> list[np.ndarray]:
        """The ids of texts under the keys of their documents."""
        parts: list[str] = []
        draws, counts = [], []
        for text, key in zip(texts, keys, strict=True):
            own = self._parts(text) if text else []
            parts += own
            counts.append(len(own))
            draws.append(self._drawn(len(own), key)[0])
        drawn = np.concatenate(draws) if draws else np.zeros(0, np.uint64)
        done = [self._encoded(parts[i : i + PARTS], drawn[i : i + PARTS]) for i in range(0, len(parts), PARTS)]
        sizes = np.concatenate([np.zeros(1, np.int64), *[s for s, _ in done]])
        ids = np.concatenate([np.zeros(0, np.uint16), *[i for _, i in done]])
        ends = np.cumsum(sizes)[np.cumsum([0, *counts])]
        return [ids[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]

    def _encoded(self, parts: list[str], draws: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How many ids each part has, and the ids of all one after another."""
        if len(parts) <= FEW:
            got = [np.frombuffer(self._merged(_whole(p), self._gaps(int(d)))[1], np.uint16) for p, d in zip(parts, draws, strict=True)]
            return np.array([len(g) for g in got], np.int64), np.concatenate(got)
        if len(self.places) > REMEMBERED:
            self._forget()
        places = self.places
        new = [p for p in dict.fromkeys(parts) if p not in places]
        short = [p for p in new if len(p) < SHORT]  # a space more, when it is whole
        first = len(self.left)
        if short:
            passed, sizes, ids = self._agendas(list(map(_whole, short)), None)
            places.update(zip(short, range(first, first + len(short)), strict=True))
            self.starts = np.append(self.starts, len(self.pool) + np.cumsum(sizes) - sizes)
            self.left, self.sizes, self.pool = np.append(self.left, passed), np.append(self.sizes, sizes), np.append(self.pool, ids)
        at = np.array([places.get(p, -1) for p in parts], np.int64)
        starts, sizes, pool = self.starts[at], self.sizes[at], [self.pool]
        skipped = np.flatnonzero((at >= 0) & (self._gaps_of(draws) < self.left[at]))
        if len(skipped):
            _, many, ids = self._agendas([_whole(parts[i]) for i in skipped], draws[skipped])
            starts[skipped], sizes[skipped] = len(self.pool) + np.cumsum(many) - many, many
            pool.append(ids)
        end = sum(map(len, pool))
        for i in np.flatnonzero(at < 0).tolist():
            ids = np.frombuffer(self._merged(_whole(parts[i]), self._gaps(int(draws[i])))[1], np.uint16)
            starts[i], sizes[i] = end, len(ids)
            end += len(ids)
            pool.append(ids)
        return sizes, np.concatenate(pool)[_ranges(starts, sizes)]

    def _forget(self) -> None:
        """Nothing remembered: the parts' places, how many candidates each has, where its ids start and how many there are, and the ids (the last place stands for none)."""
        self.places: dict[str, int] = {}
        self.left, self.starts, self.sizes = np.zeros(1, np.int64), np.zeros(1, np.int64), np.zeros(1, np.int64)
        self.pool = np.zeros(0, np.uint16)

    def _parts(self, text: str) -> list[str]:
        """The parts of a text, each without the space before it; one that has none is led by a sign that no part holds."""
        if SPACE in text:
            words = self._literal(text)
        else:
            words = text.split(" ")
            if "" not in words:
                return words
            words = self._spaced(words)  # runs of spaces belong to the part that follows
        return [w[1:] if w[0] == SPACE else " " + w for w in words]

    def _drawn(self, n: int, key: int) -> tuple[np.ndarray, np.ndarray]:
        """The draws of a document's parts, and how many candidates come to the top before the first that is skipped."""
        start = mix(np.array([key ^ self.seed * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF], np.uint64))
        draws = mix(start + np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        return draws, self._gaps_of(draws)

    def _spaced(self, words: list[str]) -> list[str]:
        """The parts of a text cut at its spaces: each with the spaces before it."""
        run, parts = "", []
        for w in words:
            run += SPACE
            if w:
                parts.append(run + w)
                run = ""
        return [*parts, run] if run else parts

    def _literal(self, text: str) -> list[str]:
        """The parts of a text with the literal character that stands for spaces: cut there, the character as a part of its own (LITERAL)."""
        parts = []
        for n, piece in enumerate(text.split(SPACE)):
            if n:
                parts.append(LITERAL)
            if not piece and n:
                continue
            # the space that every text is led by stands before the first piece only
            run = ""
            for m, w in enumerate(piece.split(" ")):
                run += SPACE if m or not n else ""
                if w:
                    parts.append(run + w)
                    run = ""
            if run:
                parts.append(run)
        return parts

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids: the inverse of encode under any seed and dropout."""
        return b"".join(map(self.pieces.__getitem__, ids.tolist())).decode("utf-8", "replace")[1:]


@cache
def _codec(proto: bytes, dropout: float, seed: int) -> Codec:
    """One codec a worker, with its memory, for all its tasks."""
    return Codec(proto, dropout, seed)


def keys_of(keys: list, texts: list[bytes]) -> list[int]:
    """A number of 64 bits for each document."""
    return [int.from_bytes(blake2b(t if k is None else str(k).encode(), digest_size=8).digest()) for k, t in zip(keys, texts, strict=True)]


def _encoded(df: DataFrame, key: str, text: str, model: str | None, dropout: float, seed: int, into: str | None) -> DataFrame:
    common.tune(df.sparkSession)
    df = df.select(*[c for c in df.columns if c not in ("ids", into)])
    names, schema = df.columns, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    proto = model_bytes(model or default_model())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(proto, dropout, seed)
        for part, texts in common.text_chunks(batches, text, 2 << 20):
            null = part.column(names.index(text)).is_null().to_numpy(zero_copy_only=False)
            got = codec.encode_all([t.decode("utf-8", "replace") for t in texts], keys_of(part.column(names.index(key)).to_pylist(), texts))
            ends = np.cumsum([0, *map(len, got)], dtype=np.int32)
            ids = pa.ListArray.from_arrays(pa.array(ends, mask=np.append(null, False)), pa.array(np.concatenate(got).astype(np.int32)))
            more = [pa.array([None if n else codec.decode(g) for g, n in zip(got, null, strict=True)], pa.string())] if into else []
            yield pa.RecordBatch.from_arrays([*part.columns, ids, *more], names=[*names, "ids", *([into] if into else [])])

    return df.mapInArrow(run, f"{schema}, ids array<int>" + (f", `{into}` string" if into else ""))


def encode(df: DataFrame, key: str = "doc_id", text: str = "text", model: str | None = None, dropout: float = DROPOUT, seed: int = SEED) -> DataFrame:
    """The table with ids, an array of int."""
    return _encoded(df, key, text, model, dropout, seed, None)


def round_trip(df: DataFrame, key: str = "doc_id", text: str = "text", into: str = "decoded", model: str | None = None, dropout: float = DROPOUT, seed: int = SEED) -> DataFrame:
    """The table with ids and the text decoded from them, both made in one worker."""
    return _encoded(df, key, text, model, dropout, seed, into)


def decode(df: DataFrame, ids: str = "ids", into: str = "decoded", model: str | None = None) -> DataFrame:
    """The table with the text of the ids."""
    common.tune(df.sparkSession)
    df = df.select(*[c for c in df.columns if c != into])
    names, schema = df.columns, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    proto = model_bytes(model or default_model())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(proto, 0.0, 0)
        for batch in batches:
            column = batch.column(names.index(ids))
            flat, ends = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
            texts = [None if null else codec.decode(flat[a:b]) for a, b, null in zip(ends[:-1], ends[1:], column.is_null().to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*names, into])

    return df.mapInArrow(run, f"{schema}, `{into}` string")


def digest(both: DataFrame) -> DataFrame:
    """doc_id, n_pieces, digests of the ids and of the decoded text, and whether that is the text."""
    own = lambda c: F.sha2(F.coalesce(F.col(c), F.lit("")).cast("binary"), 256)
    return both.select(
        "doc_id", F.greatest(F.size("ids"), F.lit(0)).cast("long").alias("n_pieces"),
        F.sha2(F.array_join("ids", ",").cast("binary"), 256).alias("ids_sha256"), own("decoded").alias("decoded_sha256"), F.col("text").eqNullSafe(F.col("decoded")).alias("lossless"),
    )


def op6_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded with merge-dropout and decoded again."""
    docs = common.read(spark, sf_dir, "documents").select("doc_id", "text")
    return digest(round_trip(docs))
