"""Chat formatting: quotation linking and reply-ordered conversations without quotes.

Leading '>' marks give each line its quote level. A run of lines of one level is a quoted
passage; passages and the messages' own bodies, paragraphs and lines are normalised
and hashed. A passage is linked to its original, the first message that says it:
in the same conversation if it is earlier there, else anywhere, if it comes before by
(conv_id, turn); what only conversations of larger ids say is no original, so links
make no rings. Originals
are aggregated to one row a hash first, so joins are many to one and a phrase
that everyone repeats multiplies nothing. A message replies to the original of its
outermost linked quote; thread starts follow by pointer jumping.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import blobs, numbered, written

_MARK = re.compile(rb"^(?:[ \t]{0,3}>)+")
_PASSAGE = pa.struct([("level", pa.int32()), ("no", pa.int32()), ("part", pa.int32()), ("hash", pa.binary())])
_PARSED = pa.schema(
    [("rid", pa.int64()), ("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("content", pa.string())]
    + [("n_quotes", pa.int64()), ("max_level", pa.int32()), ("quotes", pa.list_(_PASSAGE)), ("units", pa.list_(pa.binary()))]
)
_PARSED_SQL = "rid long, conv_id long, turn long, role string, content string, n_quotes long, max_level int, quotes array<struct<level:int,no:int,part:int,hash:binary>>, units array<binary>"


def level_of(line: bytes) -> tuple[int, bytes]:
    """A line's quote level and what is behind its marks."""
    found = _MARK.match(line)
    return (found.group().count(b">"), line[found.end() :]) if found else (0, line)


def normal(text: bytes) -> bytes:
    return b" ".join(text.lower().split())


def parse(text: bytes) -> tuple[bytes, list[tuple[int, bytes]]]:
    """The text without quotes, and its quoted passages (level, lines joined), in order.

    Lines end at LF, CR or CRLF; blank lines that removed quotes leave behind at either end go too.
    """
    own, passages, run, at = [], [], [], 0
    for line in [*re.split(rb"\r\n|\r|\n", text), None]:
        level, rest = level_of(line) if line is not None else (-1, b"")
        if level != at and run:
            passages.append((at, b"\n".join(run)))
            run = []
        at = level
        if level > 0:
            run.append(rest)
        elif level == 0:
            own.append(line)
    if not passages:
        return text, []
    return b"\n".join(own).strip(b"\n\r\t "), passages


def _digests(passage: bytes) -> list[bytes]:
    """Hashes of a passage: of the whole, then of each paragraph and of each line that says anything."""
    from xxhash import xxh3_128_digest

    parts = [normal(passage), *(normal(x) for x in re.split(rb"\n\s*\n", passage)), *(normal(x) for x in passage.split(b"\n"))]
    return [xxh3_128_digest(p) for p in dict.fromkeys(parts) if p]


def _units(own: bytes) -> list[bytes]:
    """Hashes of a message's body, paragraphs and lines."""
    from xxhash import xxh3_128_digest

    parts = [normal(own), *(normal(x) for x in re.split(rb"\n\s*\n", own)), *(normal(x) for x in re.split(rb"[\r\n]+", own))]
    return [xxh3_128_digest(p) for p in dict.fromkeys(parts) if p]


def parsed(messages: DataFrame) -> DataFrame:
    """One row a message (conv_id, turn, role, text) with its own text, quoted passages and units; a written table."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for lo in range(0, part.num_rows, 1024):
                cut = part.slice(lo, 1024)
                own, n, top, quotes, units = [], [], [], [], []
                for text, null in zip(blobs(cut["text"]), cut["text"].is_null().to_pylist(), strict=True):
                    body, passages = parse(text)
                    own.append(None if null else body.decode("utf-8", "replace"))
                    n.append(len(passages))
                    top.append(max((level for level, _ in passages), default=0))
                    quotes.append([{"level": level, "no": no, "part": k, "hash": h} for no, (level, p) in enumerate(passages) for k, h in enumerate(_digests(p))])
                    units.append(_units(body))
                columns = [cut[c] for c in ("rid", "conv_id", "turn", "role")] + [pa.array(own, pa.string()), pa.array(n, pa.int64()), pa.array(top, pa.int32()), pa.array(quotes, pa.list_(_PASSAGE)), pa.array(units, pa.list_(pa.binary()))]
                yield pa.RecordBatch.from_arrays(columns, schema=_PARSED)

    rows = messages.select(F.monotonically_increasing_id().alias("rid"), *(F.col(c).cast("long").alias(c) for c in ("conv_id", "turn")), "role", "text")
    return written(rows.mapInArrow(run, _PARSED_SQL), "chat-parsed")


def links(messages: DataFrame) -> DataFrame:
    """The reply links of parsed messages: rid, parent_rid, level (of the quote that tells), n_linked (passages with an original).

    A message without conversation or turn has no place and takes no part. Of passages
    the outermost, then the first counts; of a passage's parts the whole before
    its paragraphs, these before its lines; an original in the same conversation before one elsewhere.
    """
    placed = messages.where("conv_id is not null and turn is not null")
    said = placed.select("conv_id", "turn", "rid", F.explode("units").alias("hash"))
    first = F.min(F.struct("turn", "rid"))
    near = said.groupBy("conv_id", "hash").agg(first.alias("near"))
    far = near.groupBy("hash").agg(F.min(F.struct("conv_id", "near.turn", "near.rid")).alias("far"))
    quotes = placed.select("conv_id", "turn", "rid", F.explode("quotes").alias("q")).select("conv_id", "turn", "rid", "q.*")
    found = quotes.join(near, ["conv_id", "hash"], "left").join(far, "hash", "left")
    in_conv = F.col("near.turn") < F.col("turn")
    elsewhere = (F.col("far.conv_id") < F.col("conv_id")) | ((F.col("far.conv_id") == F.col("conv_id")) & (F.col("far.turn") < F.col("turn")))
    parent = F.when(in_conv, F.col("near.rid")).when(elsewhere, F.col("far.rid"))
    found = found.select("rid", "level", "no", "part", F.when(in_conv, 0).otherwise(1).alias("away"), parent.alias("parent_rid")).where("parent_rid is not null")
    best = F.min(F.struct("level", "part", "no", "away", "parent_rid"))
    per = found.groupBy("rid", "no").agg(best.alias("b")).groupBy("rid").agg(F.min("b").alias("b"), F.count(F.lit(1)).alias("n_linked"))
    return per.select("rid", F.col("b.parent_rid").alias("parent_rid"), F.col("b.level").alias("level"), "n_linked")


def thread_starts(replies: DataFrame) -> DataFrame:
    """rid, start (the first message of its thread) and depth of every row of replies (rid, parent_rid).

    Parents come before their replies, so there are no rings; each round doubles how far a pointer looks.
    """
    at = written(replies.select("rid", F.col("parent_rid").alias("start"), F.lit(1).cast("long").alias("depth")), "chat-threads")
    while True:
        above = at.select(F.col("rid").alias("start"), F.col("start").alias("next"), F.col("depth").alias("more"))
        step = at.join(above, "start", "left").select("rid", F.coalesce("next", "start").alias("start"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"), F.col("next").isNotNull().alias("moved"))
        step = written(step, "chat-threads")
        moved = not step.where("moved").isEmpty()
        at = step.select("rid", "start", "depth")
        if not moved:
            return at


def reply_threads(messages: DataFrame) -> DataFrame:
    """One row a message: conv_id, position, turn, role, content, and its reply link.

    position is its place in its conversation: threads by their first turn, parents before replies, then
    turns. content is the text without quotes (null stays null). parent_conv and
    parent_turn name the message replied to (else null), thread_conv and thread_turn
    the thread's first (itself if it replies to none), depth the replies between, n_quotes and
    n_linked the quoted passages and those with an original. Messages without
    conversation or turn come first in theirs and are never linked; repeated rows are
    rows of their own, the first of them being the original; other columns are left out.
    """
    rows = parsed(messages)
    replies = written(links(rows), "chat-links")
    starts = thread_starts(replies)
    where = rows.select(F.col("rid").alias("_r"), F.col("conv_id").alias("_c"), F.col("turn").alias("_t"))
    linked = replies.join(starts, "rid").join(where.toDF("parent_rid", "parent_conv", "parent_turn"), "parent_rid").join(where.toDF("start", "thread_conv", "thread_turn"), "start")
    linked = linked.select("rid", "parent_conv", "parent_turn", "thread_conv", "thread_turn", "depth", "n_linked")
    out = rows.drop("quotes", "units").join(linked, "rid", "left")
    out = out.select(
        "rid",
        "conv_id",
        "turn",
        "role",
        "content",
        "parent_conv",
        "parent_turn",
        F.coalesce("thread_conv", F.when(F.col("depth").isNull(), F.col("conv_id"))).alias("thread_conv"),
        F.coalesce("thread_turn", F.when(F.col("depth").isNull(), F.col("turn"))).alias("thread_turn"),
        F.coalesce("depth", F.lit(0)).alias("depth"),
        "n_quotes",
        F.coalesce("n_linked", F.lit(0)).alias("n_linked"),
    ).withColumn("_away", F.when(F.col("thread_conv").eqNullSafe(F.col("conv_id")), 0).otherwise(1))
    placed = numbered(out, ["conv_id", "_away", "thread_conv", "thread_turn", "depth", "turn", "role", "content", "rid"], "_at")
    first = placed.groupBy(F.col("conv_id").alias("_c")).agg(F.min("_at").alias("_first"))
    placed = placed.join(first, F.col("conv_id").eqNullSafe(F.col("_c")))
    return placed.select("conv_id", (F.col("_at") - F.col("_first")).alias("position"), "turn", "role", "content", "parent_conv", "parent_turn", "thread_conv", "thread_turn", "depth", "n_quotes", "n_linked")


def op10_quote_threads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations in reply order, without quotes."""
    return reply_threads(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
