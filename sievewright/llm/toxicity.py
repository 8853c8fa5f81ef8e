"""Toxicity: subword-bag embeddings averaged into a linear softmax, trained jointly in numpy.

A word's vector is the mean of the vectors of its byte n-grams (with marks for
its ends) and of the whole word, all in one hashed table; a text's vector is the
mean over its words (repeats count by their logarithm), scaled by the root of
their number (a plain mean loses a few words in a long text); two linear outputs and a softmax follow. Misspelt and
unseen words share n-gram vectors with those seen. Table and outputs are fitted
together by one task from a bounded sample of labelled rows. As everything up to the
softmax is linear, scoring needs one number a table row, so the broadcast model
is of fixed size, and a text is scored in one pass over all its words.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from math import log
from operator import mul

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import batches, blobs, mixed

#: Rows of each label that are fitted, at most: the documented bound of the sample.
SAMPLE_ROWS = 3000
TABLE_BITS, DIM, SHORTEST, LONGEST = 18, 8, 3, 5
BATCHES, EPOCHS, RATE, DECAY, SEEN = 12, 20, 0.05, 1e-5, 10
MEMO_WORDS = 500_000
_EDGES = b".,;:!?\"'()[]{}<>*#$%&+-=|/\\@^~`_"
_BASE = np.uint64(0x100000001B3)


def subwords(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """For all n-grams (and whole words) of words: the word's number and the table row."""
    data = np.frombuffer(b"".join(b"<" + w + b">" for w in words), np.uint8).astype(np.uint64)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 2
    starts = np.cumsum(sizes) - sizes
    of = np.repeat(np.arange(len(words)), sizes)
    left = np.repeat(starts + sizes, sizes) - np.arange(len(data))
    ids, rows, h = [], [], np.zeros(len(data), np.uint64)
    for n in range(1, min(LONGEST, len(data)) + 1):
        h[: len(data) - n + 1] = h[: len(data) - n + 1] * _BASE + data[n - 1 :] + np.uint64(1)
        if n >= SHORTEST:
            at = left >= n
            ids.append(of[at])
            rows.append(mixed(h[at] + np.uint64(n)))
    power = np.cumprod(np.full(int(sizes.max(initial=1)), _BASE, np.uint64))
    whole = np.add.reduceat(data * power[np.arange(len(data)) - np.repeat(starts, sizes)], starts) if len(words) else h
    ids.append(np.arange(len(words)))
    rows.append(mixed(whole))
    return np.concatenate(ids), (np.concatenate(rows) >> np.uint64(64 - TABLE_BITS)).astype(np.int64)


def plain(piece: bytes) -> bytes:
    return piece.strip(_EDGES) or piece


def weights(text: bytes) -> dict[bytes, float]:
    """The text's words with their weights: 1 + log of the count, so that a word repeated over and over doesn't decide."""
    return {w: 1.0 if c == 1 else 1.0 + log(c) for w, c in Counter(text.lower().split()).items()}


@dataclass
class Model:
    """weight: for each table row, by how much it moves the logit of label 1; bias: the logit of an empty text."""

    weight: np.ndarray
    bias: float

    def word_logits(self, words: list[bytes]) -> np.ndarray:
        of, rows = subwords(words)
        return np.bincount(of, self.weight[rows], len(words)) / np.bincount(of, minlength=len(words))

    def scorer(self):
        """A function from a text to its score; it remembers words, up to MEMO_WORDS."""
        memo: dict[bytes, float] = {}

        def score(texts: list[bytes]) -> list[float]:
            bags = [weights(t) for t in texts]
            new = list(set().union(*bags).difference(memo)) if bags else []
            if len(memo) + len(new) > MEMO_WORDS:
                memo.clear()
                new = list(set().union(*bags))
            for lo in range(0, len(new), 20_000):
                part = new[lo : lo + 20_000]
                memo.update(zip(part, self.word_logits([plain(p) for p in part]).tolist(), strict=True))
            sums = [sum(map(mul, map(memo.__getitem__, bag), bag.values())) / sum(bag.values()) ** 0.5 if bag else 0.0 for bag in bags]
            logits = np.array(sums) + self.bias
            return (1 / (1 + np.exp(-np.clip(logits, -500, 500)))).tolist()

        return score


@dataclass
class _Texts:
    """Texts as sparse arrays: the distinct words' table rows, and the words of each text with their shares."""

    rows: np.ndarray
    of: np.ndarray
    first_row: np.ndarray
    per_word: np.ndarray
    word: np.ndarray
    part: np.ndarray
    ends: np.ndarray

    @classmethod
    def read(cls, texts: list[bytes]) -> _Texts:
        number: dict[bytes, int] = {}
        words, parts, ends = [], [], [0]
        for text in texts:
            bag = weights(text) or {b"": 1.0}
            root = sum(bag.values()) ** 0.5
            words += [number.setdefault(w, len(number)) for w in bag]
            parts += [c / root for c in bag.values()]
            ends.append(len(words))
        of, rows = subwords(list(map(plain, number)))
        order = np.argsort(of, kind="stable")
        of, rows = of[order].astype(np.int32), rows[order].astype(np.int32)
        per_word = np.bincount(of).astype(np.float32)
        return cls(rows, of, np.searchsorted(of, np.arange(len(per_word))), per_word, np.array(words, np.int32), np.array(parts, np.float32), np.array(ends))

    def leanings(self, turn: np.ndarray) -> np.ndarray:
        by_word = np.add.reduceat(turn[self.rows], self.first_row) / self.per_word
        return np.add.reduceat(self.part * by_word[self.word], self.ends[:-1])

    def slope(self, g: np.ndarray) -> np.ndarray:
        """What leanings() hands back to the table's rows."""
        back = np.bincount(self.word, self.part * np.repeat(g, np.diff(self.ends)), len(self.per_word)) / self.per_word
        return np.bincount(self.rows, back.astype(np.float32)[self.of], 1 << TABLE_BITS).astype(np.float32)

    def texts_with(self) -> np.ndarray:
        """About how many texts have each table row."""
        return np.bincount(self.rows, np.bincount(self.word, minlength=len(self.per_word))[self.of], 1 << TABLE_BITS)


def fit(texts: list[bytes], labels: np.ndarray, shares: tuple[float, float], epochs: int | None = None) -> Model:
    """The model of texts with labels 0 and 1; shares: of label 0 and 1 among all labelled rows.

    Table, outputs and biases descend together (Adam over BATCHES fixed parts an epoch; both labels
    weigh the same). Table rows that fewer than SEEN texts use stay at zero. One part is
    not descended on: it sets the logits' scale and bias, with the labels at their shares.
    Without a row of either label the score is the share of label 1 everywhere.
    """
    prior = float(np.log((shares[1] + 1e-6) / (shares[0] + 1e-6)))
    if not len(texts) or labels.min() == labels.max():
        return Model(np.zeros(1 << TABLE_BITS, np.float32), prior)
    rng = np.random.default_rng(0)
    mix = rng.permutation(len(texts))
    parts = [mix[k::BATCHES] for k in range(BATCHES) if len(mix[k::BATCHES])]
    read = [_Texts.read([texts[i] for i in part]) for part in parts]
    apart, unseen = (parts.pop(), read.pop()) if len(parts) > 1 else (parts[0], read[0])
    seen = (sum(x.texts_with() for x in read) >= SEEN)[:, None]
    table = ((rng.random((1 << TABLE_BITS, DIM), np.float32) - 0.5) / DIM) * seen
    out = np.stack([-(o := rng.normal(0, 0.3, DIM).astype(np.float32)), o], 1)
    bias = np.zeros(2, np.float32)
    truth = np.stack([1 - labels, labels], 1).astype(np.float32)
    weight = np.where(labels == 1, 0.5 / labels.mean(), 0.5 / (1 - labels.mean())).astype(np.float32)[:, None]
    state = [(np.zeros_like(x), np.zeros_like(x)) for x in (table, out, bias)]
    step, steps = 0, (epochs or EPOCHS) * len(read)
    while step < steps:
        part, x = parts[step % len(read)], read[step % len(read)]
        step += 1
        # A text's logits are its average vector's products with the outputs; as that is linear, products come first.
        lean = x.leanings(table @ (out[:, 1] - out[:, 0]))
        logits = np.stack([-lean / 2, lean / 2], 1) + bias
        p = np.exp(logits - logits.max(1, keepdims=True))
        g = ((p / p.sum(1, keepdims=True) - truth[part]) * weight[part] / len(part)).astype(np.float32)
        slope = np.stack([-(s := x.slope(g[:, 1])), s], 1) * seen
        grads = (slope @ out.T + DECAY * table, table.T @ slope + DECAY * out, g.sum(0))
        rate = RATE * (1 - (step - 1) / steps)
        for value, grad, (first, second) in zip((table, out, bias), grads, state, strict=True):
            first += 0.1 * (grad - first)
            second += 0.02 * (grad * grad - second)
            value -= rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.98**step)) + 1e-10)
    turn = (table @ (out[:, 1] - out[:, 0])).astype(np.float32)
    scale, shift = _calibrated(unseen.leanings(turn) + float(bias[1] - bias[0]), labels[apart], shares, prior)
    return Model(turn * np.float32(scale), float(bias[1] - bias[0]) * scale + shift)


def _calibrated(logits: np.ndarray, labels: np.ndarray, shares: tuple[float, float], prior: float) -> tuple[float, float]:
    """Scale and shift that make logits most likely for labels, if these had their shares.

    A logistic regression on one number by Newton's steps, held near scale 1 and shift prior.
    """
    n = np.bincount(labels, minlength=2)
    if not n.all():
        return 1.0, prior
    weight = len(labels) * np.array(shares)[labels] / n[labels]
    x, start = np.stack([logits, np.ones(len(logits))], 1), np.array([1.0, prior])
    b = start.copy()
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        slope = x.T @ (weight * (p - labels)) + (b - start)
        b -= np.linalg.solve((x * (weight * p * (1 - p) + 1e-6)[:, None]).T @ x + np.eye(2), slope).clip(-1, 1)
    return (float(b[0]), float(b[1])) if b[0] > 0 else (1.0, prior)


def held_out(doc_id: str = "doc_id"):
    """Rows that no model may learn from: crc32 of the id as text, mod 5, is 0 (null id: false)."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """Fits labels (doc_id, toxic) over docs, outside the held-out fold.

    A document with several labels counts as toxic if one of them says so; null
    labels and labels without document are left out. About SAMPLE_ROWS documents
    of each label are fitted at most, chosen by a hash of the id, by one task: the driver
    gets the model alone, of fixed size, and no texts.
    """
    known = labels.where("doc_id is not null and toxic in (0, 1)").where(~held_out()).groupBy(F.col("doc_id").cast("long").alias("_id")).agg(F.max("toxic").cast("int").alias("_toxic"))
    n = {r[0]: r[1] for r in known.groupBy("_toxic").count().collect()}
    chance = F.xxhash64("_id").bitwiseAND(F.lit((1 << 30) - 1)) / float(1 << 30)
    limit = F.when(F.col("_toxic") == 1, min(1.0, SAMPLE_ROWS / max(1, n.get(1, 0)))).otherwise(min(1.0, SAMPLE_ROWS / max(1, n.get(0, 0))))
    chosen = F.broadcast(known.where(chance < limit))  # about 2 * SAMPLE_ROWS rows of two numbers
    everything = max(1, sum(n.values()))
    shares = (n.get(0, 0) / everything, n.get(1, 0) / everything)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [row for part in parts for row in zip(part["_id"].to_pylist(), blobs(part["text"]), part["_toxic"].to_pylist(), strict=True)]
        rows.sort()
        model = fit([text for _, text, _ in rows], np.array([toxic for _, _, toxic in rows], np.int64), shares)
        yield from batches(iter([(model.weight.tobytes(), model.bias)]), _MODEL)

    rows = docs.select(F.col("doc_id").cast("long").alias("_id"), "text").join(chosen, "_id").select("_id", "text", "_toxic")
    found = rows.repartition(1).mapInArrow(run, "weight binary, bias double").collect()
    return Model(np.frombuffer(found[0]["weight"], np.float32), found[0]["bias"]) if found else fit([], np.array([], np.int64), shares)


_MODEL = pa.schema([("weight", pa.binary()), ("bias", pa.float64())])
_SCORED = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64()), ("predicted", pa.int32())])


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted of every row (text null: as empty, the model's bias)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = shared.value.scorer()
        for part in parts:
            for lo in range(0, part.num_rows, 512):
                cut = part.slice(lo, 512)
                s = of(blobs(cut["text"]))
                yield from batches(zip(cut["doc_id"].to_pylist(), cut["held_out"].to_pylist(), s, [int(x >= 0.5) for x in s], strict=True), _SCORED)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), "text")
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def reject(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of docs, with all their columns, that the model does not predict to be toxic."""
    shared, schema = docs.sparkSession.sparkContext.broadcast(model), docs.schema

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = shared.value.scorer()
        for part in parts:
            for lo in range(0, part.num_rows, 512):
                cut = part.slice(lo, 512)
                keep = [x < 0.5 for x in of(blobs(cut["text"]))]
                yield cut.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, schema)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents by a model of the labels outside the held-out fold."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return score(docs, train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
