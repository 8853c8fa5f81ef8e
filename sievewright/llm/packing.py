"""Packing: length buckets of least padding, and token-budget batches inside them.

One histogram of all lengths is gathered; a dynamic program over it chooses the
BUCKETS upper bounds that minimise all padding. Inside a bucket, rows are padded
to its bound, and every batch takes as many as fit the token budget. Rows are
numbered by cells dealt by a hash, with the cells' counts added up, so a
hot bucket is many tasks, batches are full but for each bucket's last, and no row is left out.
"""

from __future__ import annotations

from math import ceil

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import WORD, written

BUCKETS, BUDGET = 16, 65_536
#: Lengths up to EXACT have a bin of their own; above, a bin is at most 1 / EXACT of its lengths wide, so bins are few at any scale.
EXACT = 4096
#: Repeated rows are numbered in runs of so many.
RUN = 1000


def length_bin(n: Column) -> Column:
    """The bin of a length: the length itself up to EXACT, then EXACT bins to each doubling."""
    step = F.pow(F.lit(2.0), F.floor(F.log2(F.greatest(n, F.lit(EXACT)) / EXACT))).cast("long")
    return F.when(n <= EXACT, n).otherwise(F.floor(n / step) * step)


def best_bounds(lengths: np.ndarray, counts: np.ndarray, buckets: int) -> list[int]:
    """At most `buckets` upper bounds, the last the largest length, that minimise the padding.

    lengths ascend. Bucket (i, j] pads its rows to lengths[j - 1]; as that cost meets the
    quadrangle inequality, the best cut moves up with j and each layer is solved by
    divide and conquer: O(buckets * n * log n).
    """
    n = len(lengths)
    if n == 0:
        return []
    rows = np.concatenate([[0], np.cumsum(counts)]).astype(np.float64)
    best = np.full(n + 1, np.inf)
    best[0] = 0
    cuts = []
    for _ in range(min(buckets, n)):
        new, cut = np.full(n + 1, np.inf), np.zeros(n + 1, np.int64)
        new[0] = 0
        todo = [(1, n, 0, n - 1)]
        while todo:
            lo, hi, first, last = todo.pop()
            if lo > hi:
                continue
            j = (lo + hi) // 2
            i = np.arange(first, min(last, j - 1) + 1)
            # The tokens themselves are the same for all choices, so the padded size is what counts.
            cost = best[i] + lengths[j - 1] * (rows[j] - rows[i])
            k = int(cost.argmin())
            new[j], cut[j] = cost[k], i[k]
            todo += [(lo, j - 1, first, int(i[k])), (j + 1, hi, int(i[k]), last)]
        best = new
        cuts.append(cut)
    at, bounds = n, []
    for cut in reversed(cuts):
        if at == 0:
            break
        bounds.append(int(lengths[at - 1]))
        at = int(cut[at])
    return bounds[::-1]


def histogram(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Lengths (the largest of each bin, ascending) and numbers of all rows (_n, copies). There are some thousand bins, whatever the rows."""
    bins = rows.groupBy(length_bin(F.col("_n")).alias("bin")).agg(F.max("_n").alias("n"), F.sum("copies").alias("c")).toArrow()
    order = np.argsort(bins["n"].to_numpy())
    return bins["n"].to_numpy()[order], bins["c"].to_numpy()[order]


def pack(docs: DataFrame, buckets: int = BUCKETS, budget: int = BUDGET) -> DataFrame:
    """doc_id, n_tokens (words), bucket (its number), bucket_length, batch (its number in the bucket) and slot of every row.

    A batch of a bucket has budget // bucket_length rows, one at least (a row
    longer than the budget is a batch of its own). Rows of a bucket are numbered in an
    order of hashes, so reruns agree. Null or empty text has length 0, as has its bucket; null
    ids are kept; equal rows take neighbouring places; no rows give no rows.
    """
    size = F.coalesce(F.regexp_count(F.col("text"), F.lit(WORD)), F.lit(0)).cast("long")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), size.alias("_n"))
    equal = written(rows.groupBy("doc_id", "_n").agg(F.count(F.lit(1)).alias("copies")), "pack-rows")
    lengths, counts = histogram(equal)
    bounds = best_bounds(lengths, counts, buckets) or [0]
    bucket = sum((F.when(F.col("_n") > b, 1).otherwise(0) for b in bounds[:-1]), F.lit(0))
    cells = ceil(int(counts.sum()) ** 0.5 / 4) or 1
    key = F.xxhash64("doc_id", "_n")
    dealt = equal.select("doc_id", "_n", "copies", bucket.alias("bucket"), key.alias("_key"), F.pmod(F.xxhash64(key), F.lit(cells)).alias("_cell"))
    # One row a bucket and cell: where each cell's numbers start.
    filled = dealt.groupBy("bucket", "_cell").agg(F.sum("copies").alias("_all"))
    starts = filled.select("bucket", "_cell", F.coalesce(F.sum("_all").over(Window.partitionBy("bucket").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("bucket", "_cell").orderBy("_key", "doc_id", "_n").rowsBetween(Window.unboundedPreceding, -1)
    placed = dealt.withColumn("_before", F.coalesce(F.sum("copies").over(inside), F.lit(0))).join(starts, ["bucket", "_cell"])
    length = F.element_at(F.array(*map(F.lit, bounds)), F.col("bucket") + 1).cast("long")
    fit = F.greatest(F.lit(1), F.floor(F.lit(budget) / F.greatest(F.lit(1), length))).cast("long")
    runs = placed.withColumn("_run", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("copies") - 1) / RUN))))
    runs = runs.repartition("doc_id", "_n", "_run")
    copy = F.explode(F.sequence(F.col("_run") * RUN, F.least(F.col("copies"), (F.col("_run") + 1) * RUN) - 1))
    runs = runs.select("doc_id", "_n", "bucket", (F.col("_start") + F.col("_before")).alias("_first"), copy.alias("_copy")).withColumn("_at", F.col("_first") + F.col("_copy"))
    return runs.select(
        "doc_id",
        F.col("_n").alias("n_tokens"),
        F.col("bucket").cast("int").alias("bucket"),
        length.alias("bucket_length"),
        F.floor(F.col("_at") / fit).cast("long").alias("batch"),
        (F.col("_at") % fit).cast("long").alias("slot"),
    )


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The places of all documents in length buckets and token-budget batches."""
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"))
