import hashlib
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sievewright.llm import ogg_media as ogg


def slow_checksum(data: bytes) -> int:
    crc = 0
    for byte in data:
        crc ^= byte << 24
        for _ in range(8):
            crc = ((crc << 1) ^ 0x04C11DB7 if crc & 0x80000000 else crc << 1) & 0xFFFFFFFF
    return crc


@given(st.binary(max_size=300))
def test_checksum(data):
    assert ogg.checksum(data) == slow_checksum(data)


@settings(deadline=None, max_examples=60)
@given(st.binary(max_size=5000))
def test_round_trip(data):
    m = ogg.load(ogg.store(data))
    assert m.payload[: len(data)] == data and set(m.payload[len(data) :]) <= {32}
    assert len(m.payload) % 192 == 0 and len(m.payload) >= 192
    assert (m.n_bytes, m.bad_pages, m.gaps) == (len(data), 0, 0)


@settings(deadline=None, max_examples=60)
@given(st.lists(st.integers(0, 2000), max_size=40))
def test_lacing_of_any_packet_length(sizes):
    packets = [bytes([i % 251]) * n for i, n in enumerate(sizes)]
    streams, bad = ogg.demux(ogg.mux([(7, b"head", packets), (9, b"other", [])]))
    assert bad == 0 and streams[7].packets == [b"head", *packets] and streams[9].packets == [b"other"]
    assert [e for e in streams[7].ends[1:] if e is not None] == [sum(sizes[: i + 1]) for i in range(len(sizes))]
    assert streams[7].last and streams[9].last


def test_long_text_spans_pages_and_is_dated():
    data = bytes(range(256)) * 2000
    m = ogg.load(ogg.store(data))
    assert m.payload[: len(data)] == data and m.pages > 4
    assert m.seconds[0] + m.seconds[1] == len(m.payload) / ogg.RATE


@pytest.mark.parametrize("at", [100, 40_000, 90_000])
def test_damaged_page_is_passed_over(at):
    data = bytes(range(256)) * 800
    media = bytearray(ogg.store(data))
    media[at] ^= 1
    m = ogg.load(bytes(media))
    assert m.bad_pages >= 1 and len(m.payload) < len(data)


def test_foreign_bytes():
    assert ogg.load(b"").payload == b"" and ogg.load(b"OggS no page").payload == b""
    assert ogg.load(ogg.store(b"x")[:40]).payload == b""


def test_query_columns(spark, tmp_path):
    rows = [(1, "Hello OggS", 1), (2, None, 2), (3, "", 3), (None, "é" * 70_000, 4), (5, "Hello OggS", 5), (5, "Hello OggS", 5)]
    spark.createDataFrame(rows, "doc_id long, text string, media int").write.parquet(f"{tmp_path}/documents.parquet")
    got = ogg.op6_ogg_media(spark, str(tmp_path)).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    for doc_id, text, _ in rows:
        raw = (text or "").encode()
        payload = raw + b" " * (-len(raw) % 192) or b" " * 192
        r = by[doc_id]
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest())
        assert r.tail_crc32 == zlib.crc32(payload[-16:])
        stored = ogg.store(raw)
        assert (r.media_bytes, r.media_sha256) == (len(stored), hashlib.sha256(stored).hexdigest())
    assert by[1][1:] == by[5][1:] and by[2][1:] == by[3][1:]


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert ogg.op6_ogg_media(spark, str(tmp_path)).collect() == []
