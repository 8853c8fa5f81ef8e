"""LM scoring by logistic context mixing.

The bits of the running text are predicted one by one. A token stands for the bits of its path
in a Huffman tree over the training counts; hashed contexts that run over token borders (the
kind of text, the last token, the last two tokens) and the tree's own counts each predict a bit;
the predictions meet in the logistic domain with weights gated by how much the contexts have
seen, and a table of what then really came refines the mix. Tokens are dealt by the token before
them, so that all that the corpus shows of a context meets in one place: there its tokens are
predicted and learned online, and a text's score is the sum of what its tokens got.

Tokens too rare for the broadcast tree share one path (an escape) by their first byte and are then told
apart by (count + m * spelled) / (the same, summed over that first byte): a second mixer spells each distinct one byte
by byte, from hashed contexts inside the token, and m is the share that
Good and Turing give to unseen tokens. These meet the texts in the same exchange.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from heapq import heapify, heappop, heappush
from itertools import repeat
from math import log, log10
from pickle import dumps, loads
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import batches, blobs, forget, mixed, written

#: Orders of the contexts; 0 stands for the whole token so far.
ORDERS = (1, 2, 3, 5, 0)
SLOT_BITS = 19
#: A token is frequent if it is at least one in so many of all, and of so many bytes at most: this bounds what is broadcast.
FREQUENT, LONG = 1 << 18, 64
#: Bytes of text whose tokens are dealt at once; slots of each of a key's contexts, and tables that these are spread over.
SHARD_BYTES, TEXT_BITS, TABLES = 8 << 20, 22, 16
#: Training tokens of a key on average; tokens that it learns at once at most.
DEALT, RUN = 1 << 21, 1 << 22
#: Tokens predicted between two moves of the weights; how fast these move.
STEP, TEXT_RATE = 4096, 0.1
#: Parts of what is learned first, each predicted from those before it.
PARTS = 5
#: Bytes of text that a task counts before it hands its counts on.
HELD_BYTES = 8 << 20
#: Kinds of texts.
KINDS = 24
GATES, CELLS = 9, 33
RATE, FIRST_WEIGHT = 0.08, 0.3
BLOCK = 1 << 16
_LN10 = log(10)
_MASK = np.uint32((1 << SLOT_BITS) - 1)
_NODE = np.uint32(0x9E3779B1)


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows that the model may not learn from: crc32 of the id as text, mod 7, is 2 (null id: false)."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 7 == 2, F.lit(False))


def spelled(tokens: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The tokens' bytes, each ended by a blank; the hashed contexts (order, byte); the token of each byte."""
    data = np.frombuffer(b" ".join(tokens) + b" ", np.uint8)
    sizes = np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1
    starts = np.cumsum(sizes) - sizes
    of = np.repeat(np.arange(len(tokens)), sizes)
    at = np.arange(len(data)) - starts[of]
    wide = data.astype(np.uint64)
    last = np.zeros(len(data), np.uint64)
    out = []
    for k in range(1, max(ORDERS) + 1):
        shifted = np.zeros(len(data), np.uint64)
        shifted[k:] = wide[:-k] if k < len(data) else 0
        last = last | (np.where(at >= k, shifted, 0).astype(np.uint64) << np.uint64(8 * (k - 1)))
        if k in ORDERS:
            out.append(mixed(last + (np.uint64(k) << np.uint64(56))))
    power = np.cumprod(np.full(int(sizes.max()), 0x100000001B3, np.uint64))
    total = np.cumsum((wide + np.uint64(1)) * power[at])
    before = np.concatenate([[np.uint64(0)], total[:-1]])
    out.append(mixed(before - before[starts][of] + at.astype(np.uint64)))
    return data, np.stack([(h >> np.uint64(32)).astype(np.uint32) for h in out]), of


def _bits(data: np.ndarray, contexts: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each of a byte's 8 places: the place, the bits, and their slots (order, byte)."""
    for t in range(8):
        node = (np.uint32(1 << t) | (data >> (8 - t) if t else np.zeros_like(data)).astype(np.uint32)) * _NODE
        yield t, (data >> (7 - t)) & 1, (contexts + node) & _MASK


def count_bits(tokens: list[bytes], counts: np.ndarray) -> None:
    """Adds what the tokens' bits show to counts (order, 2 * slot + bit)."""
    data, contexts, _ = spelled(tokens)
    for _, bit, slots in _bits(data, contexts):
        for k in range(len(ORDERS)):
            np.add.at(counts[k], slots[k].astype(np.int64) * 2 + bit, np.uint32(1))


def _stretch(p: np.ndarray) -> np.ndarray:
    return np.log(p / (1 - p))


@dataclass
class Mixer:
    """counts as count_bits() makes them; weights (place * GATES + gate, order); cells: what came, by place, gate and mixed prediction."""

    counts: np.ndarray
    weights: np.ndarray
    ones: np.ndarray
    seen: np.ndarray

    @classmethod
    def new(cls, counts: np.ndarray) -> Mixer:
        return cls(counts, np.full((8 * GATES, len(ORDERS)), FIRST_WEIGHT), np.zeros(8 * GATES * CELLS), np.zeros(8 * GATES * CELLS))

    def _inputs(self, t: int, bit: np.ndarray, slots: np.ndarray, without: bool) -> tuple[np.ndarray, np.ndarray]:
        """Stretched predictions (order, byte) and the gates. without: as if the token had not been counted."""
        inputs = np.empty(slots.shape, np.float32)
        came = bit.astype(np.float32)
        other = 1 - came
        for k in range(len(ORDERS)):
            # Both counts of a slot are read at once.
            both = self.counts[k].view(np.uint64).take(slots[k].astype(np.int64)).view(np.uint32)
            zero, one = both[::2].astype(np.float32), both[1::2].astype(np.float32)
            if without:
                one = np.maximum(one - came, 0)
                zero = np.maximum(zero - other, 0)
            inputs[k] = np.log((one + np.float32(0.2)) / (zero + np.float32(0.2)))
        gate = np.minimum(np.log2(zero + one + 1), GATES - 1).astype(np.int64)
        return inputs, t * GATES + gate

    def _mix(self, inputs: np.ndarray, sets: np.ndarray) -> np.ndarray:
        x = np.zeros(inputs.shape[1], np.float32)
        weights = self.weights.T.astype(np.float32)
        for k in range(len(ORDERS)):
            x += weights[k].take(sets) * inputs[k]
        return np.clip(x, -12, 12)

    def learn(self, tokens: list[bytes]) -> None:
        """One online step: predicts the tokens, then moves the weights and notes what came."""
        data, contexts, _ = spelled(tokens)
        for t, bit, slots in _bits(data, contexts):
            inputs, sets = self._inputs(t, bit, slots, True)
            x = self._mix(inputs, sets)
            wrong = bit - 1 / (1 + np.exp(-x))
            n = np.maximum(1, np.bincount(sets, minlength=len(self.weights)))
            for k in range(len(ORDERS)):
                self.weights[:, k] += RATE * np.bincount(sets, wrong * inputs[k], len(self.weights)) / n
            cell = sets * CELLS + np.rint((x + 12) * ((CELLS - 1) / 24)).astype(np.int64)
            self.ones += np.bincount(cell, bit, len(self.ones))
            self.seen += np.bincount(cell, minlength=len(self.seen))

    def log10(self, tokens: list[bytes], without: bool = False) -> np.ndarray:
        """The spelled log10 probability of each token."""
        if not tokens:
            return np.zeros(0)
        total, of = self._bytes(tokens, without)
        return np.bincount(of, total, len(tokens))

    def first(self) -> np.ndarray:
        """The spelled probabilities of a token's first byte (a blank: of the empty token)."""
        return 10.0 ** self._bytes([bytes([b]) for b in range(256)], False)[0][::2]

    def _bytes(self, tokens: list[bytes], without: bool) -> tuple[np.ndarray, np.ndarray]:
        """The log10 probability of each byte, and its token."""
        data, contexts, of = spelled(tokens)
        centre = 1 / (1 + np.exp(-(np.arange(CELLS) * (24 / (CELLS - 1)) - 12)))
        refined = ((self.ones + 20 * np.tile(centre, 8 * GATES)) / (self.seen + 20)).astype(np.float32)
        total = np.zeros(len(data))
        for t, bit, slots in _bits(data, contexts):
            inputs, sets = self._inputs(t, bit, slots, without)
            x = self._mix(inputs, sets)
            place = (x + 12) * ((CELLS - 1) / 24)
            low = np.minimum(place.astype(np.int64), CELLS - 2)
            part = (place - low).astype(np.float32)
            at = sets * CELLS + low
            p = 0.5 / (1 + np.exp(-x)) + 0.5 * (refined[at] * (1 - part) + refined[at + 1] * part)
            total += np.log(np.where(bit == 1, p, 1 - p))
        return total * (1 / _LN10), of


_ASCII = bytes(range(128))


def kind_of(text: bytes) -> int:
    """0 for texts almost all ASCII, else by the commonest other character."""
    if text.isascii():
        return 0
    other = text.translate(None, _ASCII)
    if len(other) * 200 <= len(text):
        return 0
    n, char = max((n, char) for char, n in Counter(other.decode("utf-8", "replace")).items())
    return 1 + ord(char) % (KINDS - 1)


_COUNT = pa.schema([("token", pa.binary()), ("c", pa.int64())])


def token_counts(docs: DataFrame) -> DataFrame:
    """token and c, its number in training texts (0 if only others have it), of all of docs (text, held_out).

    The end of a text is the empty token. Tasks add up before they deal out.
    """

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trained: Counter[bytes] = Counter()
        other: set[bytes] = set()
        held = 0

        def out() -> Iterator[pa.RecordBatch]:
            # All tokens together have no more bytes than the texts held.
            others = [t for t in other if t not in trained]
            tokens, c = [*trained, *others], [*trained.values(), *[0] * len(others)]
            for lo in range(0, len(tokens), 50_000):
                yield pa.RecordBatch.from_arrays([pa.array(tokens[lo : lo + 50_000], pa.binary()), pa.array(c[lo : lo + 50_000], pa.int64())], schema=_COUNT)
            trained.clear()
            other.clear()

        for part in (whole.slice(lo, 512) for whole in parts for lo in range(0, whole.num_rows, 512)):
            for text, apart in zip(blobs(part["text"]), part["held_out"].to_pylist(), strict=True):
                tokens = text.lower().split()
                if apart:
                    other.update(tokens)
                    other.add(b"")
                else:
                    trained.update(tokens)
                    trained[b""] += 1
                held += len(text)
                if held > HELD_BYTES:
                    yield from out()
                    held = 0
        yield from out()

    return docs.select("text", "held_out").mapInArrow(run, "token binary, c long").repartition("token").groupBy("token").agg(F.sum("c").alias("c"))


def _tokens(parts: Iterator[pa.RecordBatch], most: int) -> Iterator[list[bytes]]:
    """Tokens in lists of up to `most`, of bounded length together."""
    held, size = [], 0
    for part in parts:
        for token in part["token"].to_pylist():
            held.append(token)
            size += len(token) + 1
            if len(held) >= most or size >= 32 * most:
                yield held
                held, size = [], 0
    if held:
        yield held


_BLOCKS = pa.schema([("block", pa.int32()), ("data", pa.binary())])


def _bit_counts(tokens: DataFrame) -> np.ndarray:
    """count_bits() of all tokens (token). Its size is fixed, so the driver may hold it; tasks add blocks of it up."""
    size = 2 << SLOT_BITS

    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((len(ORDERS), size), np.uint32)
        some = False
        for part in _tokens(parts, 20_000):
            count_bits(part, counts)
            some = True
        if some:
            flat = counts.reshape(-1, BLOCK)
            yield from batches(((k, x.tobytes()) for k, x in enumerate(flat) if x.any()), _BLOCKS, 64)

    def add(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, None
        for part in parts:
            for block, data in zip(part["block"].to_pylist(), part["data"].to_pylist(), strict=True):
                if block != at:
                    if at is not None:
                        yield pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([held.tobytes()], pa.binary())], schema=_BLOCKS)
                    at, held = block, np.zeros(BLOCK, np.uint32)
                x = np.frombuffer(data, np.uint32)
                held = np.where(held > np.uint32(0xFFFFFFFF) - x, np.uint32(0xFFFFFFFF), held + x)
        if at is not None:
            yield pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([held.tobytes()], pa.binary())], schema=_BLOCKS)

    blocks = tokens.mapInArrow(count, "block int, data binary").repartition("block").sortWithinPartitions("block").mapInArrow(add, "block int, data binary").toArrow()
    counts = np.zeros((len(ORDERS) * size // BLOCK, BLOCK), np.uint32)
    for block, data in zip(blocks["block"].to_pylist(), blocks["data"].to_pylist(), strict=True):
        counts[block] = np.frombuffer(data, np.uint32)
    return counts.reshape(len(ORDERS), size)


_LEARNED = pa.schema([("n", pa.int64()), ("weights", pa.binary()), ("ones", pa.binary()), ("seen", pa.binary())])


def train(tokens: DataFrame) -> tuple[Mixer, Broadcast]:
    """The mixer of all distinct training tokens (token), and the broadcast of its counts."""
    counts = _bit_counts(tokens)
    shared = tokens.sparkSession.sparkContext.broadcast(counts)

    def learn(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mixer, n = Mixer.new(shared.value), 0
        for part in _tokens(parts, 4_000):
            mixer.learn(part)
            n += len(part)
        if n:
            yield from batches(iter([(n, mixer.weights.tobytes(), mixer.ones.tobytes(), mixer.seen.tobytes())]), _LEARNED)

    mixer, total, weights = Mixer.new(counts), 0, 0.0
    # All shards learn at once; then the driver adds them up one after the other.
    learned = written(tokens.mapInArrow(learn, "n long, weights binary, ones binary, seen binary"), "lm-learned")
    for row in learned.toLocalIterator():
        weights = weights + row.n * np.frombuffer(row.weights).reshape(mixer.weights.shape)
        mixer.ones += np.frombuffer(row.ones)
        mixer.seen += np.frombuffer(row.seen)
        total += row.n
    if total:
        mixer.weights = weights / total
    return mixer, shared


def score_tokens(counts: DataFrame, mixer: Mixer, shared: Broadcast, escapes: np.ndarray, prior: float, keys: int) -> DataFrame:
    """Rows of _DEALT (SCORES) with each rare token's count and log10 probability after its escape, of counts (token, c); shared: the mixer's counts; escapes: what each first byte holds."""
    weights, ones, seen = mixer.weights, mixer.ones, mixer.seen

    def rows(parts: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        own = Mixer(shared.value, weights, ones, seen)
        for part in parts:
            at = 0
            for tokens in _tokens(iter([part]), 5_000):
                c = part["c"].slice(at, len(tokens)).to_numpy().astype(np.float64)
                at += len(tokens)
                p = 10.0 ** np.maximum(own.log10(tokens), -290)
                both = np.stack([c, np.log10((c + prior * p) / escapes[[first_byte(t) for t in tokens]])])
                yield from deal_rare(SCORES, 0, 0, tokens, keys, lambda chosen, both=both: (0, len(chosen), both[:, chosen].tobytes()))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return rows_of(rows(parts), _DEALT)

    return counts.select("token", "c").mapInArrow(run, _DEALT_SQL)


def first_byte(token: bytes) -> int:
    return token[0] if token else 32


def _logit(one: np.ndarray, zero: np.ndarray) -> np.ndarray:
    return np.log((one + 0.2) / (zero + 0.2)).astype(np.float32)


@dataclass
class Code:
    """The Huffman tree of frequent tokens and of escapes, one for each first byte of a rare token (the last 256 leaves).

    starts: where a leaf's path begins in nodes (node * 2 + bit), known (what the tree's counts say of
    the bit) and left (the same without this occurrence); sizes: its bits.
    """

    tokens: list[bytes]
    base: np.ndarray
    starts: np.ndarray
    sizes: np.ndarray
    nodes: np.ndarray
    known: np.ndarray
    left: np.ndarray

    @classmethod
    def new(cls, tokens: list[bytes], c: np.ndarray, escapes: np.ndarray, base: float) -> Code:
        """c: the tokens' counts; escapes: what rare tokens hold, by first byte."""
        n = len(tokens) + len(escapes)
        weight = np.zeros(2 * n - 1)
        weight[:n] = [*c, *escapes]
        up, side = np.zeros(2 * n - 1, np.int64), np.zeros(2 * n - 1, np.uint8)
        heap = list(zip(weight[:n].tolist(), range(n), strict=True))
        heapify(heap)
        for node in range(n, 2 * n - 1):
            (a, i), (b, j) = heappop(heap), heappop(heap)
            up[[i, j]], side[j], weight[node] = node, 1, a + b
            heappush(heap, (a + b, node))
        depth = np.zeros(2 * n - 1, np.int64)
        for node in range(2 * n - 3, -1, -1):
            depth[node] = depth[up[node]] + 1
        sizes = depth[:n]
        starts = np.cumsum(sizes) - sizes
        nodes, bits = np.zeros(sizes.sum(), np.uint32), np.zeros(sizes.sum(), np.uint8)
        child, leaf, at = np.arange(n), np.arange(n), starts + sizes - 1
        same, other = np.zeros(len(nodes)), np.zeros(len(nodes))
        while len(leaf := leaf[depth[child] > 0]):
            child, at = child[depth[child] > 0], at[depth[child] > 0]
            nodes[at], bits[at], same[at] = up[child], side[child], weight[child]
            other[at] = weight[up[child]] - weight[child]
            child, at = up[child], at - 1
        turn = np.where(bits == 1, 1, -1).astype(np.float32)
        return cls(tokens, np.log10(np.asarray(c, float) + 1.0) - base, starts, sizes, nodes * np.uint32(2) + bits, turn * _logit(same, other), turn * _logit(np.maximum(same - 1, 0), other))


    def rare_id(self, token: bytes) -> int:
        """The number of a rare token: its escape and a hash."""
        return len(self.tokens) + first_byte(token) + 256 * crc32(token)

    def rare_ids(self, tokens: list[bytes]) -> np.ndarray:
        first = np.array([t[0] if t else 32 for t in tokens], np.int64)
        return len(self.tokens) + first + 256 * np.fromiter(map(crc32, tokens), np.int64, len(tokens))

    def leaves(self, ids: np.ndarray) -> np.ndarray:
        n = len(self.tokens)
        return np.where(ids < n, ids, n + ((ids - n) & 255))


#: What a slot's two counts (zeros * 256 + ones) say; how much they have seen.
_PAIRS = np.arange(1 << 16)
_SAYS = _logit(_PAIRS & 255, _PAIRS >> 8)
_SEEN = np.minimum(np.log2((_PAIRS & 255) + (_PAIRS >> 8) + 1), 4).astype(np.uint8)
_SETS = 125
#: What a bit adds to a slot (zeros in the lower half, ones in the upper), by the bit; the bits of a slot whose counts are beyond 255.
_CAME = np.array([1, 1 << 32], np.uint64)
_LARGE = np.uint64(0xFFFFFF00FFFFFF00)
_HOW_SEEN = np.stack(np.unravel_index(np.arange(_SETS), (5, 5, 5)), 1) / 4
#: First weights of the tree and the contexts: a context that has seen nothing has none, and the tree has less the more they have seen.
START = np.column_stack([1 - 0.3 * _HOW_SEEN.max(1) - 0.2 * _HOW_SEEN[:, 1], 0.2 * _HOW_SEEN]).astype(np.float32)
_CENTRE = (1 / (1 + np.exp(-(np.arange(CELLS) * (24 / (CELLS - 1)) - 12)))).astype(np.float32)


class Shard:
    """Contexts of tokens that learn together, and the mixer that learns from them."""

    def __init__(self, code: Code, bits: int = TEXT_BITS):
        self.code, self.shift = code, np.uint32(32 - bits)
        self.counts = np.zeros((3, 1 << bits), np.uint64)
        self.pairs = np.zeros((3, 1 << bits), np.uint16)
        self.weights = START.T.copy()
        self.ones, self.seen = np.tile(_CENTRE, _SETS) * 20, np.full(_SETS * CELLS, 20.0)

    def log10(self, leaves: np.ndarray, contexts: np.ndarray, learn: bool, times: np.ndarray | None = None) -> np.ndarray:
        """Each token's log10 probability.

        learn: the tree counted the tokens, so each is left out there; the mixer moves after
        each step; the contexts count the tokens, which show after the next close().
        times: how many alike each stands for when they are learned (one by default).
        """
        code = self.code
        out = np.zeros(len(leaves))
        tree = code.left if learn else code.known
        for lo in range(0, len(leaves), STEP):
            own = leaves[lo : lo + STEP]
            sizes = code.sizes[own]
            if not sizes.any():
                continue
            ends = np.cumsum(sizes)
            of = np.repeat(np.arange(len(own)), sizes)
            place = np.arange(len(of)) + np.repeat(code.starts[own] - ends + sizes, sizes)
            node = code.nodes.take(place)
            bit, node = node & np.uint32(1), (node >> np.uint32(1)) * _NODE
            sets = np.zeros(len(of), np.uint8)
            inputs = [tree.take(place)]
            came = _CAME.take(bit) if learn else None
            many = None
            if learn and times is not None:
                many = np.repeat(times[lo : lo + STEP], sizes)
                came *= many.astype(np.uint64)
            for k in range(3):
                slots = (((np.repeat(contexts[k, lo : lo + STEP], sizes) ^ node) * np.uint32(0x85EBCA6B)) >> self.shift).astype(np.int64)
                pair = self.pairs[k].take(slots).astype(np.int64)
                inputs.append(_SAYS.take(pair))
                sets = sets * np.uint8(5) + _SEEN.take(pair)
                if learn:
                    np.add.at(self.counts[k], slots, came)
            sets = sets.astype(np.int64)
            x = self.weights[0].take(sets) * inputs[0]
            for k in range(1, 4):
                x += self.weights[k].take(sets) * inputs[k]
            np.clip(x, -12, 12, out=x)
            p = 1 / (1 + np.exp(-x))
            cell = sets * CELLS + np.rint((x + np.float32(12)) * np.float32((CELLS - 1) / 24)).astype(np.int64)
            final = np.float32(0.5) * (p + (self.ones / self.seen).astype(np.float32).take(cell))
            # 1 - final where the bit is 0; every prediction is well inside 0 and 1.
            logs = np.log(np.abs(final - (np.uint32(1) - bit).astype(np.float32)))
            out[lo : lo + len(own)] = np.bincount(of, logs, len(own)) * (1 / _LN10)
            if learn:
                one = bit.astype(np.float32)
                wrong = one - p
                if many is not None:
                    one *= many
                    wrong *= many
                met = np.bincount(cell, many, len(self.seen))
                n = np.maximum(1, met.reshape(_SETS, CELLS).sum(1))
                for k in range(4):
                    self.weights[k] += TEXT_RATE * np.bincount(sets, wrong * inputs[k], _SETS) / n
                self.ones += np.bincount(cell, one, len(self.ones))
                self.seen += met
        return out

    def close(self) -> None:
        """Shows what was counted. Pairs hold the counts in proportion, 255 at most, and none above 0 gets 0."""
        for counts, pairs in zip(self.counts, self.pairs, strict=True):
            for lo in range(0, len(pairs), BLOCK):
                own, out = counts[lo : lo + BLOCK], pairs[lo : lo + BLOCK]
                out[:] = (own << np.uint64(8)) | (own >> np.uint64(32))
                if np.bitwise_or.reduce(own) & _LARGE:
                    large = np.flatnonzero(own & _LARGE)
                    zero, one = own[large] & np.uint64(0xFFFFFFFF), own[large] >> np.uint64(32)
                    part = np.maximum(zero, one) / 255
                    out[large] = (np.ceil(zero / part).astype(np.uint16) << 8) | np.ceil(one / part).astype(np.uint16)


def hashed(last: np.ndarray, before: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    """Hashed contexts (kind of text, last token, last two) from the numbers of the last token and the one before it (0: none)."""
    one = mixed(last.astype(np.uint64) + np.uint64(2 << 60))
    two = mixed(one ^ (before.astype(np.uint64) + np.uint64(3 << 60)))
    return np.stack([(x >> np.uint64(32)).astype(np.uint32) for x in (mixed(kinds.astype(np.uint64) + np.uint64(1 << 60)), one, two)])


def before_each(ids: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The last token and the one before it (ids + 1, 0: none) at each token of texts that begin at starts."""
    at = np.arange(len(ids)) - np.repeat(starts, np.diff(np.append(starts, len(ids))))
    wide = ids.astype(np.uint64) + np.uint64(1)
    last, before = np.zeros(len(ids), np.uint64), np.zeros(len(ids), np.uint64)
    last[1:], before[2:] = wide[:-1], wide[:-2]
    last[at < 1], before[at < 2] = 0, 0
    return last, before


def contexts_of(ids: np.ndarray, starts: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    """hashed() contexts of the tokens of texts that begin at starts."""
    return hashed(*before_each(ids, starts), np.repeat(kinds, np.diff(np.append(starts, len(ids)))))


def cuts_of(n: int) -> list[int]:
    """The ends of parts that double in size."""
    return [n >> k for k in range(PARTS - 1, -1, -1)]


def score_shard(code: Code, ids: list[np.ndarray], kinds: list[int], held: list[bool]) -> np.ndarray:
    """log10 probabilities of whole texts that one table holds (ids as rare_id() makes them for rare tokens), up to what tells rare tokens of one first byte apart.

    Texts not held out come first, in parts that double in size: each part is predicted from
    the parts before it while the mixer learns, and then counted. Held-out texts are predicted
    from all these and change nothing. A text's kind is one of KINDS, all alike.
    """
    apart = np.array(held, bool)
    own = Shard(code)
    learned = np.flatnonzero(~apart)
    cuts = cuts_of(len(learned))
    out = np.full(len(ids), -log10(KINDS))
    for chosen in (*(learned[lo:hi] for lo, hi in zip([0, *cuts], cuts, strict=False)), np.flatnonzero(apart)):
        if not len(chosen):
            continue
        flat = np.concatenate([ids[i] for i in chosen])
        sizes = np.array([len(ids[i]) for i in chosen], np.int64)
        starts = np.cumsum(sizes) - sizes
        leaves, contexts = code.leaves(flat), contexts_of(flat, starts, np.array(kinds, np.int64)[chosen])
        learn = not apart[chosen[0]]
        out[chosen] += np.add.reduceat(own.log10(leaves, contexts, learn), starts)
        if learn:
            own.close()
    return out


class Keyed:
    """What the whole corpus shows of the contexts of one key, spread over tables that share a mixer.

    A call with learn is predicted in parts, each from all before it, and then counted; the
    first call's parts double in size, a later one is one part.
    """

    def __init__(self, code: Code):
        self.tables = [Shard(code, TEXT_BITS - (TABLES - 1).bit_length()) for _ in range(TABLES)]
        self.learned = False
        for x in self.tables[1:]:
            x.weights, x.ones, x.seen = (getattr(self.tables[0], k) for k in ("weights", "ones", "seen"))

    def log10(self, leaves: np.ndarray, last: np.ndarray, before: np.ndarray, kinds: np.ndarray, learn: bool) -> np.ndarray:
        """Each token's log10 probability. Tokens alike in all are predicted once for a part."""
        table = ((last.astype(np.uint32) * _NODE) >> np.uint32(32 - (TABLES - 1).bit_length())).astype(np.uint8)
        order = np.argsort(table, kind="stable")
        ends = np.cumsum(np.bincount(table, minlength=TABLES))
        out = np.zeros(len(leaves))
        for own, lo, hi in zip(self.tables, [0, *ends], ends, strict=False):
            cuts = cuts_of(hi - lo) if learn and not self.learned else [hi - lo]
            for start, end in zip([0, *cuts], cuts, strict=False):
                part = order[lo + start : lo + end]
                if not len(part):
                    continue
                leaf, kind = leaves[part].astype(np.uint64), kinds[part]
                contexts = hashed(last[part], before[part], kind)
                alike = mixed(mixed(contexts[2].astype(np.uint64) << np.uint64(32) | contexts[1]) + (leaf * np.uint64(KINDS) + kind.astype(np.uint64)))
                # The order of a hash: tokens of many contexts move the mixer together.
                by = np.argsort(alike)
                found = alike[by]
                first = np.flatnonzero(np.append(True, found[1:] != found[:-1]))
                times = np.diff(np.append(first, len(by)))
                one = by[first]
                out[part[by]] = np.repeat(own.log10(leaf[one].astype(np.int64), contexts[:, one], learn, times), times)
                if learn:
                    own.close()
        self.learned |= learn
        return out


def packed(*arrays: np.ndarray) -> tuple[int, bytes]:
    """Unsigned 32-bit arrays one after the other: the number of values, and their bytes by place, compressed."""
    flat = np.concatenate([x.astype(np.uint32, copy=False) for x in arrays])
    return len(flat), pa.compress(flat.view(np.uint8).reshape(-1, 4).T.tobytes(), codec="zstd", asbytes=True)


def unpacked(n: int, data: bytes) -> np.ndarray:
    return np.frombuffer(np.frombuffer(pa.decompress(data, n * 4, codec="zstd"), np.uint8).reshape(4, n).T.tobytes(), np.uint32)


#: Rows of texts handed on at once.
ROWS = 1024
#: Turns of what a key gets: rare tokens and their scores; what is learned; what is held out; rare tokens of texts; the texts' own columns.
SCORES, LEARNED, HELD, RARE, TEXTS = range(5)
_DEALT = pa.schema([("key", pa.int32()), ("turn", pa.int32()), ("rank", pa.int64()), ("block", pa.int64()), ("n", pa.int64()), ("m", pa.int64()), ("data", pa.binary()), ("tokens", pa.binary())])
_DEALT_SQL = "key int, turn int, rank long, block long, n long, m long, data binary, tokens binary"
_PARTIAL = pa.schema([("block", pa.int64()), ("turn", pa.int32()), ("key", pa.int32()), ("n", pa.int64()), ("data", pa.binary())])
_PARTIAL_SQL = "block long, turn int, key int, n long, data binary"
_SCORED = pa.schema(
    [("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64()), ("bits_per_byte", pa.float64())]
)
_SCORED_SQL = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, bits_per_byte double"


def rows_of(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """batches() of few rows, as a row may be large."""
    return batches(rows, schema, 256, 8 << 20)


def cut_by(keys: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each of the keys and where it stands, in order."""
    if not len(keys):
        return
    # Sixteen bits are sorted by radix.
    order = np.argsort(keys.astype(np.uint16) if keys.max() < 1 << 16 else keys, kind="stable")
    found = keys[order]
    starts = np.flatnonzero(np.append(True, found[1:] != found[:-1]))
    for lo, hi in zip(starts, [*starts[1:], len(found)], strict=True):
        yield int(found[lo]), order[lo:hi]


def deal_rare(turn: int, rank: int, block: int, tokens: list[bytes], keys: int, arrays) -> Iterator[tuple]:
    """Rows of distinct tokens by key, joined by blanks, which none has; arrays(chosen) makes n, m and data of the tokens at chosen."""
    own = np.fromiter(map(crc32, tokens), np.int64, len(tokens)) % keys
    for key, chosen in cut_by(own):
        yield (key, turn, rank, block, *arrays(chosen), b" ".join(map(tokens.__getitem__, chosen.tolist())))


class Block:
    """Texts whose tokens are numbered and dealt together."""

    def __init__(self, code: Code, place: dict[bytes, int], splits: np.ndarray, keys: int):
        self.code, self.place, self.splits, self.keys = code, place, splits, keys
        self.clear()

    def clear(self) -> None:
        self.rows: list[tuple] = []
        self.ids: list[np.ndarray] = []
        self.rare: list[bytes] = []
        self.size = 0

    def add(self, rid: int, doc_id: int | None, apart: bool, text: bytes) -> None:
        found = text.lower().split()
        found.append(b"")
        at = np.fromiter(map(self.place.get, found, repeat(-1)), np.int64, len(found))
        self.rare += [found[i] for i in np.flatnonzero(at < 0).tolist()]
        self.ids.append(at)
        self.rows.append((rid, doc_id, apart, len(found), len(text), kind_of(text)))
        # A text without bytes counts too.
        self.size += len(text) + 1

    def deal(self) -> Iterator[tuple]:
        """Rows of _DEALT. A block's number is its first row's; its rank, by which it is learned, is its first training id, wherever it is stored."""
        code = self.code
        rids, doc_ids, apart, n_tokens, n_bytes, kinds = zip(*self.rows, strict=True)
        block = rids[0]
        rank = next((i for i, x in zip(doc_ids, apart, strict=True) if i is not None and not x), 0)
        held, sizes, kinds = np.array(apart), np.array(n_tokens, np.int64), np.array(kinds, np.int64)
        ids = np.concatenate(self.ids)
        text = np.repeat(np.arange(len(sizes)), sizes)
        known = ids >= 0
        base = np.bincount(text[known], code.base[ids[known]], len(sizes))
        n_known = np.bincount(text[known], minlength=len(sizes))
        yield (block % self.keys, TEXTS, rank, block, len(sizes), 0, dumps((doc_ids, held, sizes, np.array(n_bytes, np.int64), n_known, base), 5), b"")

        tokens = list(dict.fromkeys(self.rare))
        numbers = dict(zip(tokens, range(len(tokens)), strict=True))
        which = np.fromiter(map(numbers.__getitem__, self.rare), np.int64, len(self.rare))
        self.rare.clear()
        ids[~known] = code.rare_ids(tokens)[which] if tokens else 0
        place = text[~known]
        by_token = np.argsort(which, kind="stable")
        often = np.bincount(which, minlength=len(tokens))
        starts = np.cumsum(often) - often

        def standing(chosen: np.ndarray) -> tuple[int, int, bytes]:
            n = often[chosen]
            at = by_token[np.arange(n.sum()) + np.repeat(starts[chosen] - np.cumsum(n) + n, n)]
            total, data = packed(n, place[at])
            return total, len(chosen), data

        yield from deal_rare(RARE, rank, block, tokens, self.keys, standing)

        leaves = code.leaves(ids)
        # A rare token's number in 32 bits.
        n = len(code.tokens)
        ids = np.where(known, ids, n + (mixed(ids.astype(np.uint64)) % np.uint64((1 << 32) - n - 2)).astype(np.int64))
        last, before = before_each(ids, np.cumsum(sizes) - sizes)
        # What follows a very frequent token is dealt by the token before that too.
        split = self.splits.take(np.minimum(last, np.uint64(n + 1)).astype(np.int64))
        cls = mixed(before + np.uint64(7 << 60)) % split
        keys = (mixed(mixed(last + np.uint64(5 << 60)) + cls) % np.uint64(self.keys)).astype(np.int64)
        label = (text << 5) | kinds[text]
        arrays = np.stack([x.astype(np.uint32) for x in (label, leaves, last, before)])
        for key, at in cut_by(keys * 2 + held[text]):
            of, *own = arrays.take(at, 1)
            first = np.flatnonzero(np.append(True, of[1:] != of[:-1]))
            total, data = packed(of[first], np.diff(np.append(first, len(at))), *own)
            yield (key >> 1, HELD if key & 1 else LEARNED, rank, block, total, len(first), data, b"")


def predict(parts: Iterator[pa.RecordBatch], code: Code, base: float) -> Iterator[tuple]:
    """Rows of _PARTIAL from rows of _DEALT in order of key, turn, rank and block: sums by text of what a key's tokens get."""
    at, own, turn = None, None, None
    rare: dict[bytes, int] = {}
    values: list[np.ndarray] = []
    table = np.zeros((3, 0))
    held: list[tuple[int, np.ndarray, np.ndarray, np.ndarray]] = []
    size = 0

    def scored() -> Iterator[tuple]:
        nonlocal own
        if not held:
            return
        own = own or Keyed(code)
        sizes = np.concatenate([x[2] for x in held]).astype(np.int64)
        leaves, last, before = np.concatenate([x[3] for x in held], 1)
        kinds = np.repeat(np.concatenate([x[1] for x in held]) & 31, sizes)
        got = own.log10(leaves, last, before, kinds, turn == LEARNED)
        sums = np.add.reduceat(got, np.cumsum(sizes) - sizes).astype(np.float32)
        lo = 0
        for block, label, _, _ in held:
            yield (block, turn, at, len(label), (label >> 5).tobytes() + sums[lo : lo + len(label)].tobytes())
            lo += len(label)
        held.clear()

    for part in parts:
        for key, now, _, block, n, m, data, tokens in zip(*(part[f.name].to_pylist() for f in _DEALT), strict=True):
            if key != at or now != turn or size >= RUN:
                yield from scored()
                size = 0
                if key != at:
                    own, values = None, []
                    rare.clear()
                at, turn = key, now
            if now == SCORES:
                rare.update(zip(tokens.split(b" "), range(len(rare), len(rare) + m), strict=True))
                values.append(np.frombuffer(data).reshape(2, m))
            elif now == RARE:
                if values:
                    c, score = np.concatenate(values, 1)
                    table, values = np.stack([score, np.log10(c + 1.0) - base, c > 0]), []
                flat = unpacked(n, data)
                sums = table[:, np.repeat(np.fromiter(map(rare.__getitem__, tokens.split(b" ")), np.int64, m), flat[:m])]
                texts, of = np.unique(flat[m:], return_inverse=True)
                yield (block, now, key, len(texts), texts.tobytes() + b"".join(np.bincount(of, x, len(texts)).tobytes() for x in sums))
            elif now == TEXTS:
                yield (block, -1, key, n, data)
            else:
                flat = unpacked(n, data)
                held.append((block, flat[:m], flat[m : 2 * m], flat[2 * m :].reshape(3, -1)))
                size += held[-1][3].shape[1]
    yield from scored()


def total(parts: Iterator[pa.RecordBatch], train_tokens: int) -> Iterator[pa.RecordBatch]:
    """Batches of _SCORED from rows of _PARTIAL in order of block and turn."""
    texts, sums = None, np.zeros((3, 0))

    def out() -> Iterator[pa.RecordBatch]:
        if texts is None:
            return
        doc_ids, held, n_tokens, n_bytes, n_known, base = texts
        score = sums[0] - log10(KINDS)
        columns = (doc_ids, held, n_tokens, n_known + np.rint(sums[2]).astype(np.int64), [train_tokens] * len(doc_ids), base + sums[1], score, -score / log10(2) / np.maximum(1, n_bytes))
        whole = pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(columns, _SCORED, strict=True)], schema=_SCORED)
        for lo in range(0, len(doc_ids), ROWS):
            yield whole.slice(lo, ROWS)

    for part in parts:
        for turn, n, data in zip(part["turn"].to_pylist(), part["n"].to_pylist(), part["data"].to_pylist(), strict=True):
            if turn < 0:
                yield from out()
                texts, sums = loads(data), np.zeros((3, n))
                continue
            at = np.frombuffer(data, np.uint32, n)
            # A row names a text once.
            if turn == RARE:
                sums[:, at] += np.frombuffer(data, np.float64, 3 * n, 4 * n).reshape(3, n)
            else:
                sums[0, at] += np.frombuffer(data, np.float32, n, 4 * n)
    yield from out()


def score_texts(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score and bits_per_byte of every row of docs (doc_id, text).

    Null text is an empty text, whose one token is the end. A null doc_id is learned
    from. Repeated rows count as often as they stand. Training texts are learned in blocks of
    SHARD_BYTES as they are stored, each predicted from what came before it of the whole corpus, so equal ones may get
    different scores; held-out texts are predicted from all training texts, equal ones of one kind alike.
    Without training rows N and V are 0 and all rests on the untrained mixers. Other
    columns are left out.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), "text")
    counts = written(token_counts(rows), "lm-counts")
    n, v, once = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count_if(F.col("c") > 0), F.count_if(F.col("c") == 1)).first()
    prior = max(1.0, once * n / max(1, n - once))
    base = log10(n + v + 1)
    often = (F.col("c") >= max(2, -(-n // FREQUENT))) & (F.length("token") <= LONG)
    # At most FREQUENT rows of LONG bytes, as their counts add up to n at most.
    # Frequent tokens have low numbers, which pack well.
    chosen = counts.where(often).orderBy(F.desc("c"), "token").toArrow()
    c = chosen["c"].to_numpy()
    mixer, held = train(counts.where("c > 0").select("token"))
    escapes = prior * mixer.first()
    for row in counts.where(~often).groupBy(F.substring("token", 1, 1).alias("first")).agg(F.sum("c").alias("c")).collect():
        escapes[first_byte(bytes(row.first))] += row.c
    keys = 1 + n // DEALT
    tail_scores = written(score_tokens(counts.where(~often), mixer, held, escapes, prior, keys), "lm-tokens")
    held.unpersist()
    # Keys that a last token (its number + 1) is dealt to; 0 stands for none, the last for all rare ones.
    splits = np.concatenate([[1], 1 + 8 * c // DEALT, [1]]).astype(np.uint64)
    shared = spark.sparkContext.broadcast((Code.new(chosen["token"].to_pylist(), c, escapes, base), splits))

    def deal(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, splits = shared.value
        own = Block(code, dict(zip(code.tokens, range(len(code.tokens)), strict=True)), splits, keys)

        def rows() -> Iterator[tuple]:
            for part in parts:
                for lo in range(0, part.num_rows, 256):
                    cut = part.slice(lo, 256)
                    for x in zip(cut["rid"].to_pylist(), cut["doc_id"].to_pylist(), cut["held_out"].to_pylist(), blobs(cut["text"]), strict=True):
                        own.add(*x)
                        if own.size >= SHARD_BYTES:
                            yield from own.deal()
                            own.clear()
            if own.rows:
                yield from own.deal()

        return rows_of(rows(), _DEALT)

    def predicted(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return rows_of(predict(parts, shared.value[0], base), _PARTIAL)

    def totals(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return total(parts, n)

    dealt = rows.select(F.monotonically_increasing_id().alias("rid"), "doc_id", "held_out", "text").mapInArrow(deal, _DEALT_SQL).unionByName(tail_scores)
    sums = dealt.repartition(keys, "key").sortWithinPartitions("key", "turn", "rank", "block").mapInArrow(predicted, _PARTIAL_SQL)
    out = written(sums.repartition("block").sortWithinPartitions("block", "turn", "key").mapInArrow(totals, _SCORED_SQL), "lm-texts")
    for table in (counts, tail_scores):
        forget(table)
    return out


def op2_context_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents."""
    return score_texts(spark.read.parquet(f"{sf_dir}/documents.parquet"))
