"""What the operators share: words, Arrow helpers, hashing, and the library's written tables."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from ..tables import forget, new_table, numbered, written

__all__ = ["LOWER", "UPPER", "WORD", "batches", "blobs", "forget", "mixed", "new_table", "numbered", "written"]

#: Words of a text: runs of anything but ASCII white space (bytes.split() cuts at the same bytes).
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def blobs(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """Strings as their UTF-8 bytes, null as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def batches(rows: Iterator[tuple], schema: pa.Schema, most: int = 4096, most_bytes: int = 16 << 20) -> Iterator[pa.RecordBatch]:
    """Record batches of rows, cut by number and by the bytes of their binary and text values."""
    held: list[tuple] = []
    size = 0
    for row in rows:
        held.append(row)
        size += sum(len(x) for x in row if isinstance(x, (bytes, str)))
        if len(held) >= most or size >= most_bytes:
            yield _batch(held, schema)
            held, size = [], 0
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit mixing function (the finaliser of splitmix64) on uint64."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x
