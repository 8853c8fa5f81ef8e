"""Media columns: 8-bit samples in Ogg containers, written and read as binary columns.

A payload is cut into packets that are dealt in turn to two logical streams;
each stream has a header page, then data pages of up to 255 lacing values, so
packets run on over page borders. The reader looks for pages, verifies each
page's checksum, joins the segments of every logical stream into packets, dates
packets by the granule positions and puts the payload together again.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import batches, blobs

BLOCK, PACKET, RATE = 192, 960, 8000
SERIALS = (0x0A11CE01, 0x0A11CE02)
_PAGE = struct.Struct("<4sBBqIIIB")
_HEAD = struct.Struct("<8sBBHIQ")
_MAGIC = b"PCM8OGG\x00"
_CONTINUED, _FIRST, _LAST = 1, 2, 4
_FLIP = bytes(int(f"{i:08b}"[::-1], 2) for i in range(256))


def checksum(data: bytes) -> int:
    """The container's CRC-32: polynomial 04C11DB7, most significant bit first, started at 0, not inverted.

    It is the reflected CRC of the bit-reversed bytes, read backwards, so zlib can do the work.
    """
    return int(f"{zlib.crc32(data.translate(_FLIP), 0xFFFFFFFF) ^ 0xFFFFFFFF:032b}"[::-1], 2)


def _page(flags: int, granule: int, serial: int, number: int, lacing: bytes, body: bytes) -> bytes:
    head = bytearray(_PAGE.pack(b"OggS", 0, flags, granule, serial, number, 0, len(lacing)))
    whole = bytes(head) + lacing + body
    return whole[:22] + struct.pack("<I", checksum(whole)) + whole[26:]


def _laced(packets: list[bytes]) -> bytes:
    return b"".join(b"\xff" * (len(p) // 255) + bytes((len(p) % 255,)) for p in packets)


def mux(streams: list[tuple[int, bytes, list[bytes]]]) -> bytes:
    """Streams (serial, header packet, data packets of one byte a sample) as one file.

    Header pages come first; data pages follow by time, then by stream.
    """
    first, rest = [], []
    for k, (serial, header, packets) in enumerate(streams):
        first.append(_page(_FIRST | (0 if packets else _LAST), 0, serial, 0, _laced([header]), header))
        lacing, data = _laced(packets), b"".join(packets)
        ends = np.cumsum([len(p) for p in packets])
        at = done = 0
        for number, lo in enumerate(range(0, len(lacing), 255), 1):
            part = lacing[lo : lo + 255]
            size = sum(part)
            ended = len(part) - part.count(255)
            done += ended
            flags = (_CONTINUED if lo and lacing[lo - 1] == 255 else 0) | (_LAST if lo + 255 >= len(lacing) else 0)
            time = int(ends[done - 1]) if done else 0
            rest.append((time, k, number, _page(flags, time if ended else -1, serial, number, part, data[at : at + size])))
            at += size
    return b"".join(first) + b"".join(x[-1] for x in sorted(rest, key=lambda x: x[:3]))


@dataclass
class Stream:
    """A logical stream: its packets with the sample at which each ends (None: not known), and what was wrong."""

    packets: list[bytes] = field(default_factory=list)
    ends: list[int | None] = field(default_factory=list)
    pages: int = 0
    gaps: int = 0
    last: bool = False


def demux(data: bytes) -> tuple[dict[int, Stream], int]:
    """All logical streams by serial number, and the number of damaged pages.

    A page with a wrong checksum or cut short is passed over (the search goes on
    one byte later); a packet that has lost a segment is dropped, and the gap counted.
    """
    streams: dict[int, Stream] = {}
    partial: dict[int, bytes | None] = {}
    expected: dict[int, int] = {}
    at, bad = data.find(b"OggS"), 0
    while at >= 0:
        if at + 27 > len(data):
            bad += 1
            break
        _, version, flags, granule, serial, number, crc, n = _PAGE.unpack_from(data, at)
        lacing = data[at + 27 : at + 27 + n]
        end = at + 27 + n + sum(lacing)
        if version or len(lacing) < n or end > len(data) or checksum(data[at : at + 22] + b"\0\0\0\0" + data[at + 26 : end]) != crc:
            bad += 1
            at = data.find(b"OggS", at + 1)
            continue
        s = streams.setdefault(serial, Stream())
        s.pages += 1
        s.last |= bool(flags & _LAST)
        held = partial.get(serial)
        if number != expected.get(serial, number):
            s.gaps += 1
            held = None
        expected[serial] = number + 1
        if not flags & _CONTINUED:
            s.gaps += held is not None
            held = b""
        skip = bool(flags & _CONTINUED) and held is None
        held = held or b""
        pos, start = at + 27 + n, at + 27 + n
        ended: list[bytes] = []
        for value in lacing:
            pos += value
            if value < 255:
                if skip:
                    skip = False
                else:
                    ended.append(held + data[start:pos])
                held, start = b"", pos
        partial[serial] = None if skip or not lacing or lacing[-1] < 255 else held + data[start:pos]
        time: list[int | None] = [None] * len(ended)
        left = granule
        if granule >= 0 and not flags & _FIRST:
            for i in range(len(ended) - 1, -1, -1):
                time[i] = left
                left -= len(ended[i])
        s.packets += ended
        s.ends += time
        at = data.find(b"OggS", end)
    return streams, bad


def store(text: bytes) -> bytes:
    """A text as a media file: padded by spaces to a positive multiple of 192, one byte a sample."""
    payload = text + b" " * ((-len(text)) % BLOCK or (0 if text else BLOCK))
    packets = [payload[i : i + PACKET] for i in range(0, len(payload), PACKET)]
    return mux([(serial, _HEAD.pack(_MAGIC, k, len(SERIALS), 0, RATE, len(text)), packets[k :: len(SERIALS)]) for k, serial in enumerate(SERIALS)])


@dataclass
class Media:
    payload: bytes
    n_bytes: int
    pages: int
    packets: int
    bad_pages: int
    gaps: int
    seconds: list[float]


def load(data: bytes) -> Media:
    """What store() wrote. Damaged parts are missing from the payload and counted."""
    streams, bad = demux(data)
    lanes: dict[int, list[bytes]] = {}
    n_bytes, pages, gaps, seconds = 0, 0, 0, []
    for s in streams.values():
        pages, gaps = pages + s.pages, gaps + s.gaps
        if not s.packets or len(s.packets[0]) != _HEAD.size or not s.packets[0].startswith(_MAGIC):
            continue
        _, lane, _, _, rate, n_bytes = _HEAD.unpack(s.packets[0])
        lanes[lane] = s.packets[1:]
        seconds.append(max((e for e in s.ends if e is not None), default=0) / rate)
    ordered = [lanes[k] for k in sorted(lanes)]
    payload = b"".join(x[i] for i in range(max(map(len, ordered), default=0)) for x in ordered if i < len(x))
    return Media(payload, n_bytes, pages, sum(map(len, ordered)), bad, gaps, seconds)


def feature(m: Media) -> str:
    """Streams, pages, packets, milliseconds of the longest stream, then the samples' mean (thousandths), variance and crossings of 128 and of the mean."""
    x = np.frombuffer(m.payload, np.uint8)
    n, total, squares = max(1, len(x)), int(x.sum(dtype=np.int64)), int((x.astype(np.uint32) ** 2).sum(dtype=np.int64))
    mean = total // n
    crossings = [int(np.count_nonzero(np.diff(x >= level))) for level in (128, mean)]
    return f"streams={len(m.seconds)} pages={m.pages} packets={m.packets} ms={round(1000 * max(m.seconds, default=0))} mean={1000 * total // n} var={(squares - total * total // n) // n} cross={crossings[0]},{crossings[1]} bad={m.bad_pages}"


_MEDIA = pa.schema([("doc_id", pa.int64()), ("media", pa.binary())])
_READ = pa.schema(
    [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("payload_bytes", pa.int64()), ("payload_sha256", pa.string()), ("tail_crc32", pa.int64())]
    + [("media_bytes", pa.int64()), ("media_sha256", pa.string()), ("feature", pa.string())]
)


def to_media(docs: DataFrame) -> DataFrame:
    """doc_id and media of every row (text null: empty); rows are independent, so nothing is dealt out.

    Other columns are left out. Repeated rows give repeated rows, an empty table an empty one.
    """

    def encode(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            yield from batches(zip(part["doc_id"].to_pylist(), map(store, blobs(part["text"])), strict=True), _MEDIA)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(encode, "doc_id long, media binary")


def from_media(media: DataFrame) -> DataFrame:
    """Sizes, checksums and features of what the media column holds (null or foreign bytes: an empty payload)."""

    def decode(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def row(doc_id: int | None, data: bytes) -> tuple:
            m = load(data)
            return (doc_id, m.n_bytes, len(m.payload), hashlib.sha256(m.payload).hexdigest(), zlib.crc32(m.payload[-16:]), len(data), hashlib.sha256(data).hexdigest(), feature(m))

        for part in parts:
            yield from batches(map(row, part["doc_id"].to_pylist(), blobs(part["media"])), _READ)

    return media.mapInArrow(decode, "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")


def op6_ogg_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents stored as media and read back."""
    return from_media(to_media(spark.read.parquet(f"{sf_dir}/documents.parquet")))
