"""Mixing sources to target weights by pivotal dependent rounding, in DataFrame functions only.

Every row of a source gets the same expected number of copies, target / source
size. The whole part is given at once; of the fractional part two rows at a time
are paired, and a random amount of words moves from one to the other until one
of them is at 0 or 1 copies. The expected copies of a row stay as they were, and
the words taken from a source stay the same at each step, so a source ends
within one row of its target. Pairing runs inside small blocks dealt by a hash;
each block leaves one row undecided, and the undecided rows are blocked again,
level by level, until one is left for each source. Coins are hashes of the rows'
content: reruns agree whatever the partitions, and a hot source is many blocks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import WORD, written

#: Rows to a block: the length of one sequential chain of pairings.
BLOCK = 64
#: Weights of the sources in code point order (null last), repeated.
WEIGHTS = (5, 2, 1)
#: Words of the mix to all words, and the most copies of a row.
SHARE, MOST = 1.5, 2
#: Repeated rows are numbered in runs of so many.
RUN = 1000
SEED = 1
_NEAR = 1e-9


def word_count(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def _coin(*parts: Column) -> Column:
    """A number in [0, 1) that depends on parts alone."""
    return F.shiftrightunsigned(F.xxhash64(*parts, F.lit(SEED)), 11).cast("double") / float(1 << 53)


def _let(value: Column, body) -> Column:
    """body(value), with value computed once for each row."""
    return F.transform(F.array(value), body)[0]


def source_targets(sizes: DataFrame) -> DataFrame:
    """For each source of sizes (source, size, n rows each): source_size, target and rate (copies a row).

    Targets share SHARE of all words by weight, but none is above MOST times its
    source; what is cut is shared again by weight. In order of cap for each unit of
    weight, the level that the uncapped ones reach is the largest of the levels
    that would hold if all earlier sources were capped.
    """
    per = sizes.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"), F.sum(F.when(F.col("size") > 0, F.col("n")).otherwise(0)).alias("n_filled"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    per = per.withColumn("w", F.element_at(F.array(*map(F.lit, WEIGHTS)), (place % len(WEIGHTS) + 1).cast("int")).cast("long"))
    everything, order = Window.partitionBy(), Window.orderBy((F.col("source_size") / F.col("w")), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    total = SHARE * F.sum("source_size").over(everything)
    open_weight = F.sum("w").over(everything) - F.coalesce(F.sum("w").over(before), F.lit(0))
    level = (total - F.coalesce(F.sum(MOST * F.col("source_size")).over(before), F.lit(0))) / open_weight
    per = per.withColumn("_level", level).withColumn("_level", F.max("_level").over(everything))
    cap = MOST * F.col("source_size").cast("double")
    target = F.least(cap, F.col("_level") * F.col("w"))
    rate = F.when(F.col("source_size") == 0, 0.0).when(target >= cap, float(MOST)).otherwise(target / F.col("source_size"))
    return per.select("source", "source_size", "n_filled", target.alias("target"), rate.alias("rate"))


def _pair(state: Column, x: Column) -> Column:
    """One step of a chain: state has the undecided row (open) and those decided (done)."""
    c = state["open"]

    def moved(m: Column) -> Column:
        # up: words that may move from x to c; down: from c to x. Either happens with the other's share of the chance.
        rise = F.when(m["up"] + m["down"] > 0, _coin(c["key"], x["key"]) * (m["up"] + m["down"]) < m["down"]).otherwise(F.lit(False))
        return _let(F.struct(rise.alias("rise"), m["up"].alias("up"), m["down"].alias("down")), settled)

    def settled(m: Column) -> Column:
        full_c, empty_x = (1 - c["p"]) * c["size"], x["p"] * x["size"]
        empty_c = c["p"] * c["size"]
        c_ends = F.when(m["rise"], full_c <= empty_x).otherwise(empty_c <= (1 - x["p"]) * x["size"])
        shift = F.when(m["rise"], m["up"]).otherwise(-m["down"])
        ended = F.when(c_ends, _row(c, F.when(m["rise"], 1.0).otherwise(0.0))).otherwise(_row(x, F.when(m["rise"], 0.0).otherwise(1.0)))
        left = F.when(c_ends, _row(x, x["p"] - shift / x["size"])).otherwise(_row(c, c["p"] + shift / c["size"]))
        return F.struct(left.alias("open"), F.concat(state["done"], F.array(ended)).alias("done"))

    up, down = F.least((1 - c["p"]) * c["size"], x["p"] * x["size"]), F.least(c["p"] * c["size"], (1 - x["p"]) * x["size"])
    step = _let(F.struct(up.alias("up"), down.alias("down")), moved)
    return F.when(c.isNull(), F.struct(x.alias("open"), state["done"].alias("done"))).otherwise(step)


def _row(r: Column, p: Column) -> Column:
    return F.struct(r["key"].alias("key"), r["doc_id"].alias("doc_id"), r["copy"].alias("copy"), r["size"].alias("size"), F.greatest(F.lit(0.0), F.least(F.lit(1.0), p)).alias("p"))


_ENTRY = "struct<key:bigint,doc_id:bigint,copy:bigint,size:bigint,p:double>"


def _decided(rows: DataFrame, most_rows: int) -> DataFrame:
    """0 or 1 more copies (extra) for each of rows (source, blocks, key, doc_id, copy, size > 0, 0 < p < 1)."""
    out, level, blocks = None, rows, max(1, most_rows)
    while True:
        blocks = -(-blocks // BLOCK)
        level = level.withColumn("blocks", F.ceil(F.col("blocks") / BLOCK).cast("long"))
        entry = F.struct("key", "doc_id", "copy", "size", "p")
        groups = level.groupBy("source", "blocks", F.pmod(F.xxhash64("key", F.lit(blocks)), F.col("blocks")).alias("block")).agg(F.sort_array(F.collect_list(F.struct("size", entry.alias("row"))), asc=False).alias("all"))
        # Large rows meet each other first, so that what is left undecided is small more often.
        groups = groups.withColumn("all", F.transform("all", lambda x: x["row"]))
        empty = F.struct(F.lit(None).cast(_ENTRY).alias("open"), F.array().cast(f"array<{_ENTRY}>").alias("done"))
        groups = groups.select("source", "blocks", F.aggregate("all", empty, _pair).alias("state"))
        groups = written(groups.select("source", "blocks", "state.open", "state.done"), "mix")
        done = groups.select("source", F.explode("done").alias("r")).select("source", "r.*")
        left = groups.select("source", "blocks", "open.*")
        out = done if out is None else out.unionByName(done)
        if blocks <= 1:
            last = F.when(F.col("p") < _NEAR, 0.0).when(F.col("p") > 1 - _NEAR, 1.0).when(_coin(F.col("key")) < F.col("p"), 1.0).otherwise(0.0)
            out = out.unionByName(left.drop("blocks").withColumn("p", last))
            return out.select("source", "doc_id", "copy", "size", F.col("p").cast("long").alias("extra"))
        level = left


def mix_plan(sizes: DataFrame) -> DataFrame:
    """Copies of every row of sizes (doc_id, source, size): adds copy (its number among equal rows), source_size, target and copies.

    Null doc_id and null source are values like others; rows of no words have
    their copies drawn one by one, as they take no words; sources without words get
    none. No rows give no rows. Equal rows are counted before they are dealt out.
    """

    counted = sizes.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), F.col("size").cast("long").alias("size"))
    counted = written(counted.groupBy("doc_id", "source", "size").agg(F.count(F.lit(1)).alias("n")), "mix-sizes")
    sources = written(source_targets(counted), "mix-sources")
    runs = counted.withColumn("run", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / RUN))))
    runs = runs.repartition("doc_id", "source", "size", "run")
    copy = F.explode(F.sequence(F.col("run") * RUN, F.least(F.col("n"), (F.col("run") + 1) * RUN) - 1))
    rows = runs.select("doc_id", "source", "size", copy.alias("copy"))
    s = sources.withColumnRenamed("source", "_source")
    rows = rows.join(s, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    rows = rows.withColumn("whole", F.floor("rate").cast("long")).withColumn("p", F.col("rate") - F.floor("rate")).withColumn("key", F.xxhash64("doc_id", "source", "size", "copy", F.lit(SEED)))
    rows = written(rows, "mix-rows")
    chained = (F.col("size") > 0) & (F.col("p") > _NEAR) & (F.col("p") < 1 - _NEAR)
    most = sources.agg(F.max("n_filled")).first()[0] or 0
    tree = _decided(rows.where(chained).select("source", F.col("n_filled").alias("blocks"), "key", "doc_id", "copy", "size", "p"), most)
    rate = s.select("_source", "source_size", "target", "rate")
    tree = tree.join(rate, F.col("source").eqNullSafe(F.col("_source"))).select("doc_id", "source", "size", "copy", "source_size", "target", (F.floor("rate") + F.col("extra")).cast("long").alias("copies"))
    alone = F.when(_coin(F.col("key")) < F.col("p"), 1).otherwise(0)
    lone = rows.where(~chained).select("doc_id", "source", "size", "copy", "source_size", "target", (F.col("whole") + alone).cast("long").alias("copies"))
    return tree.unionByName(lone)


def mix(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text, source, others) with each row as often as the mix takes it, perhaps not at all.

    Rows that agree in doc_id, source and size share their copies evenly, so texts
    are dealt out once, by a hash of these, and meet one row of the plan.
    """
    columns = docs.columns
    sized = docs.withColumn("_mix_size", word_count()).withColumn("_mix_id", F.col("doc_id").cast("long")).withColumn("_mix_source", F.col("source").cast("string"))
    plan = mix_plan(sized.select(F.col("_mix_id").alias("doc_id"), F.col("_mix_source").alias("source"), F.col("_mix_size").alias("size")))
    key = F.xxhash64("doc_id", "source", "size")
    plan = plan.groupBy("doc_id", "source", "size").agg(F.sum("copies").alias("_p_copies"), F.count(F.lit(1)).alias("_p_rows")).where("_p_copies > 0")
    plan = plan.select(key.alias("_mix_key"), F.col("doc_id").alias("_p_id"), F.col("source").alias("_p_source"), F.col("size").alias("_p_size"), "_p_copies", "_p_rows")
    sized = sized.withColumn("_mix_key", F.xxhash64("_mix_id", "_mix_source", "_mix_size"))
    same = F.col("_mix_id").eqNullSafe(F.col("_p_id")) & F.col("_mix_source").eqNullSafe(F.col("_p_source")) & (F.col("_mix_size") == F.col("_p_size"))
    met = sized.alias("d").join(plan.alias("p"), (F.col("d._mix_key") == F.col("p._mix_key")) & same).drop(F.col("p._mix_key"))
    number = F.row_number().over(Window.partitionBy("_mix_key", "_mix_id", "_mix_source", "_mix_size").orderBy(F.xxhash64("text")))
    own = F.floor(F.col("_p_copies") / F.col("_p_rows")) + F.when(number <= F.col("_p_copies") % F.col("_p_rows"), 1).otherwise(0)
    taken = met.withColumn("_mix_copies", own.cast("long")).where("_mix_copies > 0")
    return taken.withColumn("_mix_n", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_mix_copies")))).select(*columns)


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix of all documents: what each is taken for."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    plan = mix_plan(docs.select("doc_id", "source", word_count().alias("size")))
    return plan.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "source", "copies")
