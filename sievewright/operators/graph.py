"""Connected components by joins."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..tables import forget, written
from .joins import hot_keys, spread_join

#: Links that one task may connect by itself, and edges to a partition of the labels beyond.
EDGES = 100_000


def components(links: DataFrame) -> DataFrame:
    """cid and comp, the smallest cid it is connected with, of all cids in links (a, b), a written table.

    Up to EDGES links are connected by one task. Beyond, labels go to neighbours, then
    labels of labels are taken, until none changes; every round is a written table. Hubs,
    and labels that many share, are dealt over several tasks.
    """
    links = links.select("a", "b")
    if links.count() <= EDGES:
        return written(links.coalesce(1).mapInArrow(_joined, "cid long, comp long"), "labels")
    both = written(links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    # There are no more labels than edges, so few edges need few partitions.
    parts = both.count() // EDGES + 1
    hubs = written(hot_keys(both, ["b"]), "hubs")
    labels = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("cid"), F.least("a", "m").alias("comp"))
    labels = written(labels.coalesce(parts), "labels")
    while True:
        near = spread_join(both, labels.withColumnRenamed("cid", "b"), hubs, ["b"], ["a"]).groupBy("a").agg(F.min("comp").alias("m"))
        step = labels.join(near, labels["cid"] == near["a"]).select("cid", F.col("comp").alias("was"), F.least("comp", "m").alias("via"))
        above = labels.select(F.col("cid").alias("via"), F.col("comp").alias("jump"))
        jumped = spread_join(step, above, hot_keys(step, ["via"]), ["via"], ["cid"])
        new = written(jumped.select("cid", F.least("via", "jump").alias("comp"), "was").coalesce(parts), "labels")
        forget(labels)
        labels = new
        if labels.where("comp < was").isEmpty():
            forget(both, hubs)
            out = labels.select("cid", "comp")
            out._written_at = labels._written_at
            return out


def _joined(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """cid and comp of all links of a task, by joining trees; a tree's root is its smallest cid."""
    up: dict[int, int] = {}

    def root(x: int) -> int:
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for part in parts:
        for a, b in zip(part["a"].to_pylist(), part["b"].to_pylist(), strict=True):
            up.setdefault(a, a)
            up.setdefault(b, b)
            x, y = root(a), root(b)
            up[max(x, y)] = min(x, y)
    cids = list(up)
    yield pa.RecordBatch.from_arrays([pa.array(cids, pa.int64()), pa.array(list(map(root, cids)), pa.int64())], names=["cid", "comp"])
