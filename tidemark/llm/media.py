"""Media columns: signature sniffing.

An Aho-Corasick automaton finds all magic bytes in one pass over a value; a
validator for each format then confirms structure and length. The result
corrects the declared type and carves embedded media: every validated hit is
an item with its offset and length, nested ones too.

Every function of a row looks at that row alone, so nothing is gathered. A
value is held once in a Python worker with the items found in it.

Cases: null bytes are sniffed as empty, of type application/octet-stream with
no items. Magic bytes without a valid structure are no items. Truncated media
are no items. Other columns pass through; input columns named like result
columns are replaced. An empty table gives an empty result. Equal values give
equal results.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import common

UNKNOWN = "application/octet-stream"
RATE = 8000


def _riff(b: memoryview, at: int, form: bytes) -> int:
    if len(b) - at < 12 or bytes(b[at + 8 : at + 12]) != form:
        return 0
    size = struct.unpack_from("<I", b, at + 4)[0] + 8
    return size if at + size <= len(b) else 0


def _wav(b: memoryview, at: int) -> int:
    size = _riff(b, at, b"WAVE")
    if not size:
        return 0
    seen, p = set(), at + 12
    while p + 8 <= at + size:
        name, n = bytes(b[p : p + 4]), struct.unpack_from("<I", b, p + 4)[0]
        if p + 8 + n > at + size or (name == b"data" and b"fmt " not in seen):
            return 0
        seen.add(name)
        p += 8 + n + n % 2
    return size if {b"fmt ", b"data"} <= seen else 0


def _webp(b: memoryview, at: int) -> int:
    size = _riff(b, at, b"WEBP")
    return size if size and bytes(b[at + 12 : at + 15]) == b"VP8" else 0


def _png(b: memoryview, at: int) -> int:
    p, first = at + 8, True
    while p + 12 <= len(b):
        n, name = struct.unpack_from(">I", b, p)[0], bytes(b[p + 4 : p + 8])
        if p + 12 + n > len(b) or first != (name == b"IHDR"):
            return 0
        if zlib.crc32(b[p + 4 : p + 8 + n]) != struct.unpack_from(">I", b, p + 8 + n)[0]:
            return 0
        p, first = p + 12 + n, False
        if name == b"IEND":
            return p - at
    return 0


def _gif(b: memoryview, at: int) -> int:
    if len(b) - at < 14 or bytes(b[at : at + 6]) not in (b"GIF87a", b"GIF89a"):
        return 0
    p = at + 13 + (3 * 2 ** (b[at + 10] % 8 + 1) if b[at + 10] & 128 else 0)
    while p < len(b):
        mark = b[p]
        if mark == 0x3B:
            return p + 1 - at
        if mark == 0x21:
            p += 2
        elif mark == 0x2C and p + 10 <= len(b):
            p += 10 + (3 * 2 ** (b[p + 9] % 8 + 1) if b[p + 9] & 128 else 0) + 1
        else:
            return 0
        while p < len(b) and b[p]:
            p += b[p] + 1
        p += 1
    return 0


def _jpeg(b: memoryview, at: int) -> int:
    p, scan = at + 2, False
    while p + 4 <= len(b):
        if b[p] != 0xFF:
            return 0
        mark = b[p + 1]
        if mark == 0xFF:
            p += 1
            continue
        n = struct.unpack_from(">H", b, p + 2)[0]
        if mark in (0, 0xD8, 0xD9) or n < 2:
            return 0
        p += 2 + n
        scan = mark == 0xDA
        while scan and p + 2 <= len(b) and not (b[p] == 0xFF and b[p + 1] != 0 and not 0xD0 <= b[p + 1] <= 0xD7):
            p += 1
        if scan and p + 2 <= len(b) and b[p + 1] == 0xD9:
            return p + 2 - at
    return 0


def _bmp(b: memoryview, at: int) -> int:
    if len(b) - at < 26:
        return 0
    size, zero, pixels, header = struct.unpack_from("<IIII", b, at + 2)
    return size if zero == 0 and header in (12, 40, 52, 56, 64, 108, 124) and 14 + header <= pixels <= size and at + size <= len(b) else 0


def _crc_table(width: int, polynomial: int) -> list[int]:
    out = []
    for n in range(256):
        c = n << (width - 8)
        for _ in range(8):
            c = (c << 1 ^ polynomial if c >> (width - 1) else c << 1) & ((1 << width) - 1)
        out.append(c)
    return out


# The polynomials of FLAC's frame headers and frames, and block sizes by their code.
_CRC8, _CRC16 = _crc_table(8, 0x07), _crc_table(16, 0x8005)
_BLOCKS = {1: 192} | {n: 576 << (n - 2) for n in range(2, 6)} | {n: 256 << (n - 8) for n in range(8, 16)}


def _flac_header(b: memoryview, p: int) -> tuple[int, int]:
    """Length of a frame's header and its samples; (0, 0) where none stands."""
    if p + 6 > len(b) or b[p] != 0xFF or b[p + 1] & 0xFE != 0xF8 or b[p + 3] & 1 or b[p + 3] >> 4 > 10:
        return 0, 0
    size, rate, first = b[p + 2] >> 4, b[p + 2] & 15, b[p + 4]
    lead = 8 - (first ^ 0xFF).bit_length()  # of the coded number, like UTF-8
    q = p + 5 + (lead - 1 if lead > 1 else 0)
    if not size or rate == 15 or lead in (1, 8) or q + 5 > len(b):
        return 0, 0
    samples = _BLOCKS.get(size, 0)
    if size in (6, 7):
        samples, q = int.from_bytes(b[q : q + size - 5], "big") + 1, q + size - 5
    q += {12: 1, 13: 2, 14: 2}.get(rate, 0)
    crc = 0
    for x in b[p:q]:
        crc = _CRC8[crc ^ x]
    return (q + 1 - p, samples) if q < len(b) and crc == b[q] else (0, 0)


def _flac(b: memoryview, at: int) -> int:
    """The metadata blocks, then frames up to the number of samples that the first block tells; each frame ends where its checksum comes out and the next begins (or all samples are there)."""
    p = at + 4
    while p + 4 <= len(b):
        n, last = int.from_bytes(b[p + 1 : p + 4], "big"), b[p] & 128
        if (p == at + 4 and (b[p] & 127 or n != 34)) or p + 4 + n > len(b):
            return 0
        p += 4 + n
        if last:
            break
    else:
        return 0
    total, found = int.from_bytes(b[at + 21 : at + 26], "big") & (1 << 36) - 1, 0
    while found < total:
        head, samples = _flac_header(b, p)
        if not head:
            return 0
        found, crc, q = found + samples, 0, p
        while True:
            if q >= len(b):
                return 0
            crc = (crc << 8 & 0xFF00) ^ _CRC16[crc >> 8 ^ b[q]]
            q += 1
            if not crc and q >= p + head + 2 and (found >= total or _flac_header(b, q)[0]):
                break
        p = q
    return p - at if total else 0


def _pdf(b: memoryview, at: int) -> int:
    """Up to the last end mark before the next file begins."""
    value = b.obj
    follows = value.find(b"%PDF-", at + 5)
    end = value.rfind(b"%%EOF", at, follows if follows >= 0 else len(value))
    return end + 5 - at if end > 0 and value.rfind(b"startxref", at, end) > 0 else 0


def _gzip(b: memoryview, at: int) -> int:
    if len(b) - at < 18 or b[at + 3] & 0xE0:
        return 0
    d = zlib.decompressobj(31)
    try:
        left = b[at:]
        while left and not d.eof:
            d.decompress(left, 1 << 20)
            left = d.unconsumed_tail
    except zlib.error:
        return 0
    return len(b) - at - len(d.unused_data) if d.eof else 0


# Magic bytes, their offset in the format and media types.
FORMATS: dict[str, tuple[bytes, Callable[[memoryview, int], int]]] = {
    "audio/wav": (b"RIFF", _wav),
    "image/webp": (b"RIFF", _webp),
    "image/png": (b"\x89PNG\r\n\x1a\n", _png),
    "image/gif": (b"GIF8", _gif),
    "image/jpeg": (b"\xff\xd8\xff", _jpeg),
    "image/bmp": (b"BM", _bmp),
    "audio/flac": (b"fLaC", _flac),
    "application/pdf": (b"%PDF-", _pdf),
    "application/gzip": (b"\x1f\x8b\x08", _gzip),
}


@cache
def _automaton():  # noqa: ANN202
    import ahocorasick

    a = ahocorasick.Automaton()
    by_magic: dict[bytes, list[str]] = {}
    for kind, (magic, _) in FORMATS.items():
        by_magic.setdefault(magic, []).append(kind)
    for magic, kinds in by_magic.items():
        a.add_word(magic.decode("latin-1"), (len(magic), tuple(kinds)))
    a.make_automaton()
    return a


def carve(value: bytes) -> list[tuple[int, int, str]]:
    """All validated media in the bytes: (offset, length, type), by offset."""
    view, out = memoryview(value), []
    for end, (n, kinds) in _automaton().iter(value.decode("latin-1")):
        at = end + 1 - n
        for kind in kinds:
            if length := FORMATS[kind][1](view, at):
                out.append((at, length, kind))
                break
    return sorted(out)


def sniff(value: bytes) -> tuple[str, list[tuple[int, int, str]]]:
    """The type that the bytes themselves prove (of an item that starts at 0), and all items."""
    items = carve(value)
    return next((kind for at, _, kind in items if at == 0), UNKNOWN), items


def to_wav(payload: bytes, rate: int = RATE) -> bytes:
    """The payload as unsigned 8-bit mono samples, one byte a sample."""
    pad = len(payload) % 2
    head = struct.pack("<4sI4s4sIHHIIHH4sI", b"RIFF", 36 + len(payload) + pad, b"WAVE", b"fmt ", 16, 1, 1, rate, rate, 1, 8, b"data", len(payload))
    return head + payload + b"\0" * pad


def from_wav(value: bytes) -> bytes:
    """The samples of the first data chunk."""
    if not _wav(memoryview(value), 0):
        raise ValueError("not a WAV file")
    p = 12
    while value[p : p + 4] != b"data":
        n = struct.unpack_from("<I", value, p + 4)[0]
        p += 8 + n + n % 2
    return value[p + 8 : p + 8 + struct.unpack_from("<I", value, p + 4)[0]]


def payload(text: bytes) -> bytes:
    """The text with zero bytes up to a positive multiple of 64."""
    return text + b"\0" * (-len(text) % 64 or (64 if not text else 0))


def sniffed(df: DataFrame, value: str = "media", declared: str = "declared") -> DataFrame:
    """The table with media_type (proven by the bytes, else unknown), corrected (declared is not that type) and items, an array of (offset, length, type)."""
    common.tune(df.sparkSession)
    rest = [c for c in df.columns if c not in ("media_type", "corrected", "items")]
    df = df.select(*rest)
    fields = df.schema
    names = [f.name for f in fields]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in fields] + ["media_type string", "corrected boolean", "items array<struct<offset:bigint,length:bigint,type:string>>"])
    item = pa.list_(pa.struct([("offset", pa.int64()), ("length", pa.int64()), ("type", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, values in common.text_chunks(batches, value):
            found = [sniff(v) for v in values]
            said = part.column(names.index(declared)).to_pylist()
            items = [[{"offset": a, "length": n, "type": t} for a, n, t in x] for _, x in found]
            yield pa.RecordBatch.from_arrays(
                [*part.columns, pa.array([t for t, _ in found], pa.string()), pa.array([t != s for (t, _), s in zip(found, said, strict=True)]), pa.array(items, item)],
                names=[*names, "media_type", "corrected", "items"],
            )

    return df.mapInArrow(run, schema)


def stored(df: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, the unpadded length, the text's payload as a WAV file, and a declared type that may be wrong (dealt by the payload's checksum)."""
    said = ("audio/wav", "image/png", UNKNOWN, None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in common.text_chunks(batches, text, 2 << 20):
            media = [to_wav(payload(t)) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array([len(t) for t in texts], pa.int64()), pa.array(media, pa.binary()), pa.array([said[zlib.crc32(m) % 4] for m in media], pa.string())],
                names=["doc_id", "n_bytes", "media", "declared"],
            )

    common.tune(df.sparkSession)
    return df.select("doc_id", text).mapInArrow(run, "doc_id long, n_bytes long, media binary, declared string")


def digest(media: DataFrame) -> DataFrame:
    """Digests and features of sniffed WAV values, from their stored bytes read back."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for i in range(batch.num_rows):  # one value at a time as Python objects
                x = batch.slice(i, 1).to_pylist()[0]
                samples = from_wav(x["media"])
                level = np.frombuffer(samples, np.uint8)
                crossings = int(np.count_nonzero(np.diff(level >= 128)))
                inside = [item["type"] for item in x["items"] if item["offset"]]
                feature = f"{x['media_type']};declared={x['declared'] or ''};corrected={int(x['corrected'])};u8;{RATE}Hz;samples={len(samples)};peak={int(level.max())};sum={int(level.sum(dtype=np.int64))};crossings={crossings};carved={'+'.join(inside)}"
                rows.append((x["doc_id"], x["n_bytes"], len(samples), hashlib.sha256(samples).hexdigest(), zlib.crc32(samples[-64:]), len(x["media"]), hashlib.sha256(x["media"]).hexdigest(), feature))
            if rows:
                types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
                names = ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

    return media.mapInArrow(run, "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")


def op10_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's text stored as a WAV file under a type that may be wrong; the sniffed type, the payload read back and its features."""
    return digest(sniffed(stored(common.read(spark, sf_dir, "documents"))))
