"""Word n-grams, Jaccard similarity, MinHash signatures and bands."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import words

#: The prime of the hash family, and its largest value.
PRIME, TOP = (1 << 61) - 1, (1 << 32) - 1
SEED = 42


def ngrams(x: Column, n: int) -> Column:
    """The distinct n-grams of a text's words; of fewer words, the text itself.

    The words are bound by a lambda: what stands outside of one is derived anew for every n-gram.
    """

    def of(w: Column) -> Column:
        grams = F.transform(F.sequence(F.lit(1), F.size(w) - n + 1), lambda i: F.array_join(F.slice(w, i, n), " "))
        return F.when(F.size(w) < n, F.array(x)).otherwise(F.array_distinct(grams))

    return F.transform(F.array(words(x)), of)[0]


def jaccard(a: Column, b: Column) -> Column:
    both = F.size(F.array_intersect(a, b))
    return F.when((F.size(a) == 0) | (F.size(b) == 0), 0.0).otherwise(both / (F.size(a) + F.size(b) - both))


def coefficients(permutations: int) -> tuple[list[int], list[int]]:
    """All multipliers, then all increments, from one seeded generator."""
    rng = random.Random(SEED)
    return [rng.randint(1, PRIME - 1) for _ in range(permutations)], [rng.randint(0, PRIME - 1) for _ in range(permutations)]


def _reduced(x: np.ndarray) -> np.ndarray:
    x = (x & np.uint64(PRIME)) + (x >> np.uint64(61))
    return np.where(x >= np.uint64(PRIME), x - np.uint64(PRIME), x)


def signatures(hashes: np.ndarray, permutations: int) -> np.ndarray:
    """Per permutation, the least of ((a * h + b) mod PRIME) & TOP over 32-bit hashes.

    a * h has up to 93 bits, so a is cut in two: the upper part's product is reduced, then
    shifted by 30 bits, which modulo 2**61 - 1 is a rotation. The sum of all terms stays below
    2**63, so it is reduced once, at the end.
    """
    prime, top, one = np.uint64(PRIME), np.uint64(TOP), np.uint64(1)
    a, b = (np.array(x, np.uint64)[:, None] for x in coefficients(permutations))
    high, low = a >> np.uint64(30), a & np.uint64((1 << 30) - 1)
    best = np.full(permutations, TOP, np.uint64)
    for lo in range(0, len(hashes), 256):
        h = hashes[None, lo : lo + 256].astype(np.uint64)
        u = h * high  # below 2**63
        v = u >> np.uint64(61)
        u &= prime
        u += v  # at most PRIME + 3: its rotation takes the bits above 2**61 along
        np.right_shift(u, np.uint64(31), out=v)
        u &= np.uint64((1 << 31) - 1)
        u <<= np.uint64(30)
        u += v  # below 2**61 + 2**31
        np.multiply(h, low, out=v)  # below 2**62
        u += v
        u += b  # below 2**63
        np.right_shift(u, np.uint64(61), out=v)
        u &= prime
        u += v  # at most PRIME + 3
        # Less PRIME where it is reached: that adds one and drops the bits from 2**61 on, all above TOP.
        np.add(u, one, out=v)
        v >>= np.uint64(61)
        u += v
        u &= top
        np.minimum(best, u.min(1), out=best)
    return best


def digests(text: str, n: int) -> list[bytes]:
    """The MD5 of every distinct n-gram, in any order."""
    w = text.split()
    grams = set(map(" ".join, zip(*(w[k:] for k in range(n)), strict=False))) if len(w) >= n else {text}
    return [hashlib.md5(g.encode()).digest() for g in grams]


def _signature(found: list[bytes], permutations: int) -> np.ndarray:
    """Each n-gram is hashed to the first four bytes of its MD5."""
    return signatures(np.frombuffer(b"".join(found), "<u4")[::4], permutations).astype(np.int64)


def minhash(x: Column, n: int, permutations: int) -> Column:
    """The signature of a text's n-grams."""

    @F.pandas_udf("array<long>")
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda text: None if text is None else _signature(digests(text, n), permutations))

    return run(x)


def sketch(x: Column, n: int, permutations: int) -> Column:
    """signature, as minhash() gives it, and set, which equal n-gram sets share, in one pass."""

    @F.pandas_udf("signature array<long>, set binary")
    def run(texts: pd.Series) -> pd.DataFrame:
        found = [digests(text, n) for text in texts]
        sets = [hashlib.sha256(b"".join(sorted(own))).digest() for own in found]
        return pd.DataFrame({"signature": [_signature(own, permutations) for own in found], "set": sets})

    return run(x)


def gram_set(x: Column, n: int) -> Column:
    """The MD5s of a text's distinct n-grams, sorted, end to end."""

    @F.pandas_udf("binary")
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda text: None if text is None else b"".join(sorted(digests(text, n))))

    return run(x)


def set_jaccard(a: Column, b: Column) -> Column:
    """jaccard() of two gram_set()s."""

    @F.pandas_udf("double")
    def run(left: pd.Series, right: pd.Series) -> pd.Series:
        def one(x: bytes, y: bytes) -> float:
            # Digests are compared as two numbers each, so no trailing zeros are lost.
            x, y = (np.frombuffer(z, "<u8").reshape(-1, 2) for z in (x, y))
            both = np.concatenate([x, y])
            both = both[np.lexsort((both[:, 1], both[:, 0]))]
            same = int((both[1:] == both[:-1]).all(1).sum())
            return same / (len(both) - same)

        return pd.Series([one(x, y) for x, y in zip(left, right, strict=True)], dtype="float64")

    return run(a, b)


def similarity_estimate(a: Column, b: Column) -> Column:
    """The share of equal places of two signatures."""
    return F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda same: same)) / F.size(a)


def bands(permutations: int, threshold: float) -> tuple[int, int]:
    """Bands and rows whose steepest point lies nearest to the threshold; of equals, fewer bands."""
    fits = [b for b in range(1, permutations + 1) if permutations % b == 0]
    best = min(fits, key=lambda b: (abs((1 / b) ** (b / permutations) - threshold), b))
    return best, permutations // best
