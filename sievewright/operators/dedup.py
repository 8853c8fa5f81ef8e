"""Exact and near de-duplication that keep the first record, in the records' order (seq)."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import Dedup
from ..functions import similarity
from ..tables import written
from .graph import components

SEPARATOR = " ||| "


def key(mode: str) -> Column:
    """The text that two records must share: of input, output, both (input_output) or instruction_output; any other mode is input."""
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    if mode == "output":
        return text("output")
    if mode in ("both", "input_output"):
        return F.concat(text("input"), F.lit(SEPARATOR), text("output"))
    if mode == "instruction_output":
        return F.concat(text("instruction"), F.lit(SEPARATOR), text("output"))
    return text("input")


def exact(records: DataFrame, mode: str) -> DataFrame:
    """The first record of every key. Only hashes and places are aggregated, before they are dealt out."""
    hashed = records.withColumn("_key", F.sha2(key(mode), 256))
    first = hashed.groupBy("_key").agg(F.min("seq").alias("seq"))
    return hashed.join(first, ["_key", "seq"], "left_semi").drop("_key")


def signatures(records: DataFrame, rules: Dedup) -> DataFrame:
    """seq and signature of every record's key."""
    return records.select("seq", similarity.minhash(key(rules.key), rules.ngram, rules.permutations).alias("signature"))


def band_rows(signed: DataFrame, rules: Dedup) -> DataFrame:
    """seq, band and values: each signature cut into its bands."""
    n, rows = similarity.bands(rules.permutations, rules.threshold)
    cut = F.posexplode(F.array(*(F.slice("signature", 1 + k * rows, rows) for k in range(n)))).alias("band", "values")
    return signed.select("seq", cut)


def candidates(banded: DataFrame) -> DataFrame:
    """i < j of records that share a bucket, with their earliest bucket: (first, band), first being its first record."""
    first = banded.groupBy("band", "values").agg(F.min("seq").alias("first"), F.count(F.lit(1)).alias("size")).where("size > 1")
    held = banded.join(first.drop("size"), ["band", "values"])
    other = held.select("band", "values", F.col("seq").alias("j"))
    pairs = held.withColumnRenamed("seq", "i").join(other, ["band", "values"]).where("i < j")
    return pairs.groupBy("i", "j").agg(F.min(F.struct("first", "band")).alias("place")).select("i", "j", "place.first", "place.band")


def verified(records: DataFrame, pairs: DataFrame, rules: Dedup) -> DataFrame:
    """Those of pairs whose n-gram sets reach the threshold, with their Jaccard similarity. Sets are made of records in pairs only."""
    ends = pairs.select(F.explode(F.array("i", "j")).alias("seq")).distinct()
    own = records.select("seq", key(rules.key).alias("key")).join(ends, "seq", "left_semi")
    grams = written(own.select("seq", similarity.gram_set(F.col("key"), rules.ngram).alias("grams")), "gram-sets", **{"parquet.block.size": str(16 << 20)})
    a, b = grams.toDF("i", "a"), grams.toDF("j", "b")
    return pairs.join(a, "i").join(b, "j").withColumn("jaccard", similarity.set_jaccard(F.col("a"), F.col("b"))).drop("a", "b").where(F.col("jaccard") >= rules.threshold)


def removed(edges: DataFrame) -> DataFrame:
    """seq of the records that go: edges are visited bucket by bucket, in order of the buckets' first records, and
    take their later record away unless either has gone. Only edges of one component depend on each other."""
    links = edges.select(F.col("i").alias("a"), F.col("j").alias("b"))
    owned = edges.join(components(links).withColumnRenamed("cid", "i"), "i")

    def visit(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, gone = None, set()
        for part in parts:
            out = []
            for comp, i, j in zip(*(part[c].to_pylist() for c in ("comp", "i", "j")), strict=True):
                if comp != at:
                    at, gone = comp, set()
                if i not in gone and j not in gone:
                    gone.add(j)
                    out.append(j)
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.int64())], names=["seq"])

    # Most components have a few edges, so a task passes through many of them, one after the other.
    dealt = owned.select("comp", "first", "band", "i", "j").repartition("comp").sortWithinPartitions("comp", "first", "band", "i", "j")
    return dealt.select("comp", "i", "j").mapInArrow(visit, "seq long")


def near(records: DataFrame, rules: Dedup) -> DataFrame:
    """records without near copies of earlier ones.

    Records of equal n-gram sets share every bucket, so the first of them stands for
    all: it alone can stay, and only it is paired. Of the rest all pairs of
    a bucket are compared, as the visiting order asks for.
    """
    sketched = records.select("seq", similarity.sketch(key(rules.key), rules.ngram, rules.permutations).alias("_s"))
    signed = written(sketched.select("seq", "_s.signature", F.col("_s.set").alias("_set")), "signed")
    lead = signed.groupBy("_set").agg(F.min("seq").alias("seq"))
    firsts = signed.join(lead, ["_set", "seq"], "left_semi").select("seq", "signature")
    pairs = written(candidates(band_rows(firsts, rules)), "near-pairs")
    edges = written(verified(records, pairs, rules), "near-edges")
    kept = firsts.select("seq")
    if not edges.isEmpty():
        kept = kept.join(removed(edges), "seq", "left_anti")
    return records.join(kept, "seq", "left_semi")


def routed(records: DataFrame, rules: Dedup = Dedup()) -> DataFrame:
    """De-duplication by task, with out_seq: the output's order, ordinary tasks before those that only lose exact copies."""
    skip = F.coalesce(F.col("task").isin(*rules.exact_only_tasks), F.lit(False)) if rules.exact_only_tasks else F.lit(False)
    branches = []
    for branch, (rows, mode, also_near) in enumerate([(records.where(~skip), rules.key, rules.near), (records.where(skip), rules.exact_only_key, False)]):
        if rules.exact:
            rows = exact(rows, mode)
        if also_near:
            rows = near(rows, rules)
        branches.append(rows.withColumn("_branch", F.lit(branch)))
    return branches[0].unionByName(branches[1])


