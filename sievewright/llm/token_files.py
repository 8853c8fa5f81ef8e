"""Token-ID output: Parquet list columns that allow selective reads of tokens and metadata.

The texts are dealt by ranges of doc_id (one shuffle) and sorted inside each
range; each range is then encoded and written as one file, so file order and row
order together are ascending doc_id order. Token ids are dictionary encoded, the
ascending columns (doc_id, offset in the file) delta encoded; row groups are of
a set size and page indexes are written, so a reader that filters by doc_id
touches few pages and one that wants lengths reads no tokens.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator
from itertools import compress, islice
from operator import not_

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import blobs, new_table

END_ID = 1
#: A worker forgets its table of encoded words beyond so many entries, to bound its memory.
MEMO_WORDS = 1_200_000
ROW_GROUP_BYTES, PAGE_BYTES = 16 << 20, 256 << 10

_FILE = pa.schema([("doc_id", pa.int64()), ("file_offset", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.list_(pa.int32()))])


#: Pieces of plain Latin letters, digits and ASCII signs but the apostrophe, and the words that the tokenizer makes of them.
_PLAIN = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ0-9!-&(-/:-@\\[-`{-~]+")
_WORDS = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+|[0-9]|[!-&(-/:-@\\[-`{-~]+")


class Encoder:
    """Texts to ids (little-endian 32-bit), by the tokenizers library.

    The tokenizer's normaliser and splitter act inside a piece between ASCII white
    space, and no piece's ids depend on its neighbours, so each distinct piece is
    encoded once for each worker and then looked up. Where the tokenizer's words are runs of
    letters, single digits and runs of signs, and a word's last token says that it ends the
    word, plain pieces are split here, encoded many together without normaliser
    and splitter, and cut at these tokens.
    """

    def __init__(self, tokenizer_file: str) -> None:
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.model = Tokenizer.from_file(tokenizer_file)
        self.memo: dict[bytes, bytes] = {}
        self.letters = None
        with open(tokenizer_file, encoding="utf-8") as f:
            form = json.load(f)
        suffix = form["model"].get("end_of_word_suffix")
        splitter = (form.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
        pattern = (splitter[0].get("pattern") or {}).get("Regex", "")
        steps = [x["type"] for x in (form.get("normalizer") or {}).get("normalizers", [])]
        if suffix and r"[\p{L}]+" in pattern.split("|") and splitter[0].get("invert") and steps == ["NFC", "Replace", "Lowercase"]:
            self.letters = Tokenizer.from_file(tokenizer_file)
            self.letters.normalizer = normalizers.Sequence([])
            self.letters.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
            vocabulary = self.model.get_vocab()
            self.last = np.zeros(max(vocabulary.values()) + 1, bool)
            self.last[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True

    def _each(self, pieces: list[str]) -> list[bytes]:
        return [np.array(x.ids, "<u4").tobytes() for x in self.model.encode_batch_fast(pieces, add_special_tokens=False)]

    def _together(self, words: list[str]) -> list[bytes]:
        ids = np.array(self.letters.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, "<u4")
        cuts = ((np.flatnonzero(self.last[ids]) + 1) * 4).tolist()
        data = ids.tobytes()
        return [data[i:j] for i, j in zip([0, *cuts[:-1]], cuts, strict=True)] if len(cuts) == len(words) else self._each(words)

    def learn(self, new: list[bytes]) -> None:
        fast, words, sizes, rest = [], [], [], []
        for piece in new:
            if self.letters is None:
                rest.append(piece)
            elif piece.isalpha():
                fast.append(piece)
                words.append(piece.lower().decode())
                sizes.append(1)
            elif _PLAIN.fullmatch(text := piece.decode()) and "<|" not in text:
                fast.append(piece)
                words += (parts := _WORDS.findall(text.lower()))
                sizes.append(len(parts))
            else:
                rest.append(piece)
        ids = [x for lo in range(0, len(words), 1000) for x in self._together(words[lo : lo + 1000])]
        at = 0
        for piece, n in zip(fast, sizes, strict=True):
            self.memo[piece] = ids[at] if n == 1 else b"".join(ids[at : at + n])
            at += n
        for lo in range(0, len(rest), 1000):
            part = rest[lo : lo + 1000]
            self.memo.update(zip(part, self._each([p.decode() for p in part]), strict=True))

    def __call__(self, texts: list[bytes]) -> list[bytes]:
        cut = [text.split() for text in texts]
        found = [list(map(self.memo.get, pieces)) for pieces in cut]
        holes = [list(compress(range(len(ids)), map(not_, ids))) for ids in found]
        new = {pieces[i] for pieces, at in zip(cut, holes, strict=True) for i in at}
        if len(self.memo) + len(new) > MEMO_WORDS:
            # Words that were met first are mostly the frequent ones; found has what is needed now.
            self.memo = dict(islice(self.memo.items(), MEMO_WORDS // 2))
        self.learn(list(new))
        for pieces, ids, at in zip(cut, found, holes, strict=True):
            for i in at:
                ids[i] = self.memo[pieces[i]]
        return [b"".join(ids) for ids in found]


_ENCODERS: dict[str, Encoder] = {}


def encoder(tokenizer_file: str) -> Encoder:
    """The worker's encoder, which later tasks find with the words that it knows."""
    if tokenizer_file not in _ENCODERS:
        _ENCODERS[tokenizer_file] = Encoder(tokenizer_file)
    return _ENCODERS[tokenizer_file]


def _ranged(rows: DataFrame) -> DataFrame:
    """rows (doc_id, text) dealt by ranges of doc_id and sorted inside them, null ids first.

    The ranges' bounds come from the ids alone, so texts are read once. An id that
    fills several ranges is dealt among them by a hash of the text, which also
    orders rows of one id.
    """
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bounds = sorted(rows.select(F.percentile_approx("doc_id", [k / n for k in range(1, n)], 20 * n)).first()[0] or []) if n > 1 else []
    tie = F.xxhash64("text")
    if bounds:
        literal = F.array(*(F.lit(b).cast("long") for b in bounds))
        steps = F.array(*(F.lit(1 << k) for k in reversed(range(len(bounds).bit_length()))))

        def before(also_equal: bool) -> Column:
            """How many bounds lie below the id (or at it): a binary search."""

            def go(place: Column, step: Column) -> Column:
                bound = F.get(literal, place + step - 1)
                within = bound <= F.col("doc_id") if also_equal else bound < F.col("doc_id")
                return place + F.when(F.coalesce(within, F.lit(False)), step).otherwise(0)

            return F.aggregate(steps, F.lit(0), go)

        rows = rows.withColumn("_to", before(True)).withColumn("_equal", F.col("_to") - before(False))
        share = (F.lit(float(1 << 63)) - tie) / float(1 << 64)
        rows = rows.repartitionById(len(bounds) + 1, (F.col("_to") - F.least(F.floor(share * F.col("_equal")), F.col("_equal") - 1).cast("int") * (F.col("_equal") > 0).cast("int")).cast("int"))
    else:
        rows = rows.repartition(1)
    return rows.sortWithinPartitions("doc_id", tie).select("doc_id", "text")


def write_tokens(docs: DataFrame, path: str, tokenizer_file: str, end_id: int = END_ID) -> None:
    """Encodes all of docs (doc_id, text; other columns are left out) and writes the files to path.

    Null text counts as empty and gives the end id alone; a null doc_id sorts
    first; repeated doc_ids are ordered by a hash of the text, and each row is kept.
    No rows give a folder without rows.
    """
    tail = end_id.to_bytes(4, "little")

    def encode(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        of, at = encoder(tokenizer_file), 0
        for part in parts:
            for lo in range(0, part.num_rows, 256):
                cut = part.slice(lo, 256)
                ids = [x + tail for x in of(blobs(cut["text"]))]
                n = [len(x) // 4 for x in ids]
                ends, starts = [0], []
                for k in n:
                    starts.append(at)
                    at += k
                    ends.append(ends[-1] + k)
                values = pa.Array.from_buffers(pa.int32(), ends[-1], [None, pa.py_buffer(b"".join(ids))])
                yield pa.RecordBatch.from_arrays([cut["doc_id"], pa.array(starts, pa.int64()), pa.array(n, pa.int64()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)], schema=_FILE)

    ranged = _ranged(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text")))
    options = {
        "compression": "zstd",
        "parquet.block.size": str(ROW_GROUP_BYTES),
        "parquet.page.size": str(PAGE_BYTES),
        "parquet.writer.version": "v2",
        "parquet.enable.dictionary": "true",
        "parquet.enable.dictionary#doc_id": "false",
        "parquet.enable.dictionary#file_offset": "false",
    }
    ranged.mapInArrow(encode, "doc_id long, file_offset long, n_tokens long, ids array<int>").write.options(**options).parquet(path)


_ROWS_SQL = "doc_id long, file_offset long, n_tokens long, ids array<int>"


def _files(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """The files' rows, and for each file the ids before it. Only the offset columns are read for the latter, which has one row a file."""
    rows = spark.read.schema(_ROWS_SQL).parquet(path).withColumn("_file", F.col("_metadata.file_name"))
    files = rows.groupBy("_file").agg(F.max(F.col("file_offset") + F.col("n_tokens")).alias("_all"))
    number = F.regexp_extract("_file", r"^part-(\d+)", 1).cast("long")
    before = F.sum("_all").over(Window.orderBy(number, "_file").rowsBetween(Window.unboundedPreceding, -1))
    return rows, files.select("_file", F.coalesce(before, F.lit(0)).alias("_before"))


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """The files' rows with their place in the whole: doc_id, start (ids of all rows before), n_tokens, ids."""
    rows, files = _files(spark, path)
    return rows.join(files, "_file").select("doc_id", (F.col("_before") + F.col("file_offset")).alias("start"), "n_tokens", "ids")


_SUMS = pa.schema([("doc_id", pa.int64()), ("_file", pa.string()), ("file_offset", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])


def _digest(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in parts:
        ids = part["ids"]
        values, ends = memoryview(ids.values.cast(pa.int32()).buffers()[1] or b"").cast("B"), ids.offsets.to_pylist()
        base = ids.values.offset
        sums = [zlib.crc32(values[4 * (base + a) : 4 * (base + b)]) for a, b in zip(ends, ends[1:], strict=False)]
        n = [b - a for a, b in zip(ends, ends[1:], strict=False)]
        yield pa.RecordBatch.from_arrays([part["doc_id"], part["_file"], part["file_offset"], pa.array(n, pa.int64()), pa.array(sums, pa.int64())], schema=_SUMS)


def read_checksums(spark: SparkSession, path: str) -> DataFrame:
    """Every row's doc_id, start, n_tokens and ids_crc32 (of its ids as 32-bit numbers), from the files. The ids are summed where they are read."""
    rows, files = _files(spark, path)
    sums = rows.mapInArrow(_digest, "doc_id long, _file string, file_offset long, n_tokens long, ids_crc32 long")
    return sums.join(files, "_file").select("doc_id", (F.col("_before") + F.col("file_offset")).alias("start"), "n_tokens", "ids_crc32")


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place, length and checksum in the token files, read back from them."""
    import public_tokenizers

    path = new_table(spark, "tokens")
    write_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet"), path, public_tokenizers.path("word_bpe_49k.json"))
    return read_checksums(spark, path)
