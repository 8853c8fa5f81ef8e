"""Approximate nearest neighbours: an NN-descent graph and greedy search in it.

Equal vectors are one node. Random projection trees, fitted on a bounded sample,
deal the nodes into small leaves whose pairs give the first neighbour lists. Each
round of NN-descent then gathers at every node some neighbours in either direction
(by joins; at most SIDE of each kind, so hubs stay small), compares these with one another and merges what is
found into the lists of the nodes compared. Queries walk the graph in rounds, from
entries and the node of an equal vector: the nearest OPENED open nodes of a query's beam hand on
their neighbours, the same join brings those handed on before to their vectors, and the
nearest WIDTH stay, until no node of a beam is open. Distances are those of the original vectors
in double precision, in the walk and in building the graph.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import forget, written

#: Neighbours kept for a node, gathered of either kind in a round, handed on for each compared node.
LIST, SIDE, HANDED = 20, 10, 8
ROUNDS, TREES, LEAF = 5, 3, 100
#: Nodes that trees are fitted on and walks start from: the documented bound of the sample.
SAMPLE = 4096
ENTRIES, WIDTH = 16, 400
#: Nodes of a query that hand on their neighbours in one round.
OPENED = 100
#: Queries that are walked together.
QUERIES = 16_384
NEAREST = 10


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and e, of rows of vectors (vec_id, embedding) that take part, each once.

    Left out: null ids, vectors null, empty, zero or with a component null, infinite or
    not a number, and those that are not of the commonest length (of several, the shortest). -0 counts as 0.
    """
    inner = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("e")).where("vec_id is not null and size(e) > 0")
    fine = F.forall("e", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    inner = inner.where(F.coalesce(fine, F.lit(False))).where(F.exists("e", lambda x: x != 0))
    lengths = inner.groupBy(F.size("e").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return inner.where(F.size("e") == (lengths[0] if lengths else 0)).withColumn("e", F.transform("e", lambda x: x + F.lit(0.0).cast("float"))).distinct()


def _unpacked(column: pa.Array, kind: np.dtype) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), -1).astype(np.float64) if len(column) else np.zeros((0, 1))


def _matrix(column: pa.Array, kind=np.float64) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), -1).astype(kind) if len(column) else np.zeros((0, 1), kind)


class Trees:
    """TREES complete binary trees of hyperplanes over a sample of vectors."""

    def __init__(self, sample: np.ndarray, n: int) -> None:
        rng = np.random.default_rng(7)
        leaves = min(max(1, n // LEAF), max(1, len(sample) // 4))
        self.depth = int(np.log2(leaves)) if leaves > 1 else 0
        self.planes = np.zeros((TREES, 2**self.depth, sample.shape[1] if sample.size else 1), np.float32)
        self.cuts = np.zeros((TREES, 2**self.depth))
        for tree in range(TREES):
            held = {1: np.arange(len(sample))}
            for node in range(1, 2**self.depth):
                own = held.pop(node)
                a, b = rng.choice(own, 2, replace=False) if len(own) > 1 else (0, min(1, len(sample) - 1))
                plane = sample[a] - sample[b]
                plane = (plane / (np.linalg.norm(plane) or 1.0)).astype(np.float32)
                side = sample[own] @ plane
                cut = np.median(side) if len(own) else 0
                self.planes[tree, node], self.cuts[tree, node] = plane, cut
                held[2 * node], held[2 * node + 1] = own[side <= cut], own[side > cut]

    def leaves(self, x: np.ndarray) -> Iterator[np.ndarray]:
        for tree in range(TREES):
            node = np.ones(len(x), np.int64)
            for _ in range(self.depth):
                side = np.einsum("ij,ij->i", x, self.planes[tree, node]) > self.cuts[tree, node]
                node = 2 * node + side
            yield node + (tree << 32)


_LISTS = pa.schema([("nid", pa.int64()), ("d", pa.list_(pa.float64())), ("v", pa.list_(pa.int64()))])
_LISTS_SQL = "nid long, d array<double>, v array<long>"


def _lists(rows: list[tuple]) -> pa.RecordBatch:
    n, d, v = zip(*rows, strict=True) if rows else ((), (), ())
    ends = np.concatenate([[0], np.cumsum([len(x) for x in d])]).astype(np.int32)
    flat = [np.concatenate(x) if len(x) else np.zeros(0) for x in (d, v)]
    return pa.RecordBatch.from_arrays([pa.array(n, pa.int64())] + [pa.ListArray.from_arrays(pa.array(ends), pa.array(x, t)) for x, t in zip(flat, (pa.float64(), pa.int64()), strict=True)], schema=_LISTS)


def _compared(most: int, kind: np.dtype):
    """For groups (members of nid, q, a packed vector of kind): each member's nearest others in the group, up to most."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            flat, ends = part["members"].flatten(), part["members"].offsets.to_numpy()
            ends = ends - ends[0]
            nid, held = flat.field(0).to_numpy(zero_copy_only=False), []
            q = _unpacked(flat.field(1), kind)
            for lo, hi in zip(ends[:-1], ends[1:], strict=True):
                ids, first = np.unique(nid[lo:hi], return_index=True)
                if len(ids) < 2:
                    continue
                x = q[lo:hi][first]
                squares = np.einsum("ij,ij->i", x, x)
                d = np.maximum(squares[:, None] + squares - 2 * (x @ x.T), 0)
                np.fill_diagonal(d, np.inf)
                k = min(most, len(ids) - 1)
                near = np.argpartition(d, k - 1, 1)[:, :k]
                held += list(zip(ids, np.take_along_axis(d, near, 1), ids[near], strict=True))
                if len(held) > 20_000:
                    yield _lists(held)
                    held = []
            yield _lists(held)

    return run


def _merged(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For nodes with several lists: the nearest LIST of all, nearest first."""
    for part in parts:
        held = []
        lists, ends = part["lists"].flatten(), part["lists"].offsets.to_numpy()
        ends = ends - ends[0]
        inner = lists.field(0).offsets.to_numpy()
        inner = inner - inner[0]
        d, v = (lists.field(k).flatten().to_numpy(zero_copy_only=False) for k in (0, 1))
        for node, lo, hi in zip(part["nid"].to_pylist(), ends[:-1], ends[1:], strict=True):
            a, b = inner[lo], inner[hi]
            ids, first = np.unique(v[a:b], return_index=True)
            own = d[a:b][first]
            order = np.lexsort((ids, own))[:LIST]
            held.append((node, own[order], ids[order]))
        yield _lists(held)


def _merge(lists: DataFrame) -> DataFrame:
    return lists.groupBy("nid").agg(F.collect_list(F.struct("d", "v")).alias("lists")).mapInArrow(_merged, _LISTS_SQL)


class Index:
    """A graph over vectors (vec_id, e as usable() gives them); all tables are written."""

    def __init__(self, vectors: DataFrame) -> None:
        self.vectors = written(vectors, "ann-vectors")
        reps = self.vectors.groupBy("e").agg(F.min("vec_id").alias("rep"))
        self.nodes = written(reps.select(F.monotonically_increasing_id().alias("nid"), "e", "rep"), "ann-nodes")
        self.n = self.nodes.count()
        share = min(1.0, SAMPLE / max(1, self.n))
        chosen = self.nodes.where(F.xxhash64("rep").bitwiseAND(F.lit((1 << 30) - 1)) < int(share * (1 << 30)))
        sample = chosen.select("nid", "rep", "e").orderBy("rep", "nid").toArrow().combine_chunks()
        self.entry_ids = sample["nid"].to_numpy()
        self.entries = _matrix(sample["e"].combine_chunks()) if len(sample) else np.zeros((0, 1))
        self.graph = self._descended()

    def _packed(self, kind: np.dtype) -> DataFrame:
        """nid and q, the vector's components one after the other."""

        def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part in parts:
                q = _matrix(part["e"], kind)
                yield pa.RecordBatch.from_arrays([part["nid"], pa.array([x.tobytes() for x in q], pa.binary())], names=["nid", "q"])

        return written(self.nodes.select("nid", "e").mapInArrow(run, "nid long, q binary"), "ann-packed")

    def _descended(self) -> DataFrame:
        double = self.nodes.schema["e"].dataType.elementType.typeName() == "double"
        kind = np.dtype(np.float64 if double else np.float32)
        packed = self._packed(kind)
        trees = Trees(self.entries, self.n)

        def leaves(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part in parts:
                for leaf in trees.leaves(_unpacked(part["q"], kind)):
                    yield pa.RecordBatch.from_arrays([pa.array(leaf), part["nid"], part["q"]], names=["leaf", "nid", "q"])

        dealt = written(packed.mapInArrow(leaves, "leaf long, nid long, q binary"), "ann-leaves")
        sizes = dealt.groupBy("leaf").agg(F.ceil(F.count(F.lit(1)) / (LEAF * 1.5)).alias("parts"))
        dealt = dealt.join(sizes, "leaf").withColumn("part", F.pmod(F.xxhash64("nid", "leaf"), F.col("parts")))
        groups = dealt.groupBy("leaf", "part").agg(F.collect_list(F.struct("nid", "q")).alias("members"))
        graph = written(_merge(groups.mapInArrow(_compared(LIST, kind), _LISTS_SQL)), "ann-graph")
        for round_ in range(ROUNDS):
            edges = graph.select("nid", F.explode(F.slice("v", 1, LIST)).alias("v"))
            chance = F.xxhash64("nid", "v", F.lit(round_))
            out = F.row_number().over(Window.partitionBy("nid").orderBy(chance))
            into = F.row_number().over(Window.partitionBy("v").orderBy(chance))
            edges = edges.withColumn("o", out).where(F.col("o") <= SIDE).withColumn("i", into).where(F.col("i") <= SIDE).select("nid", "v")
            both = edges.unionByName(edges.select(F.col("v").alias("nid"), F.col("nid").alias("v")))
            near = both.join(packed.withColumnRenamed("nid", "v"), "v").groupBy("nid").agg(F.collect_list(F.struct("v", "q")).alias("members"))
            found = near.mapInArrow(_compared(HANDED, kind), _LISTS_SQL)
            better = written(_merge(graph.unionByName(found)), "ann-graph")
            forget(graph)
            graph = better
        # Search goes along edges in either direction, of those that come in at most LIST.
        edges = graph.select("nid", F.explode("v").alias("v"))
        into = F.row_number().over(Window.partitionBy("v").orderBy(F.xxhash64("nid", "v")))
        back = edges.withColumn("i", into).where(F.col("i") <= LIST).select(F.col("v").alias("nid"), F.col("nid").alias("v"))
        ways = edges.unionByName(back).groupBy("nid").agg(F.collect_set("v").alias("adj"))
        out = written(self.nodes.select("nid", "e").join(ways, "nid", "left").select("nid", "e", F.coalesce("adj", F.array().cast("array<long>")).alias("adj")), "ann-index")
        forget(packed, dealt, graph)
        return out

    def search(self, queries: DataFrame) -> DataFrame:
        """query_id, rank, vec_id, score: the NEAREST found of queries (query_id, e), the query's own id apart.

        Nearest first, ties to the smaller vec_id, equal vectors each by its own id.
        """
        spark = self.nodes.sparkSession
        queries = written(queries.select("query_id", "e").join(self.nodes.select("e", "nid"), "e", "left"), "ann-queries")
        blocks = max(1, -(-queries.count() // QUERIES))
        found = None
        for block in range(blocks):
            held = queries.where(F.pmod(F.xxhash64("query_id"), F.lit(blocks)) == block).orderBy("query_id", "nid").toArrow().combine_chunks()
            if len(held):
                beams = self._walk(held["query_id"].to_numpy(), _matrix(held["e"].combine_chunks()), held["nid"].to_pylist())
                found = beams if found is None else found.unionByName(beams)
        if found is None:
            found = spark.createDataFrame([], "query_id long, nid long, score double")
        # Of equal vectors no more than NEAREST can be among the results, and the query itself.
        same = Window.partitionBy("nid").orderBy("vec_id")
        members = self.vectors.join(self.nodes.select("nid", "e"), "e").select("nid", "vec_id").distinct().withColumn("k", F.row_number().over(same)).where(F.col("k") <= NEAREST + 1).drop("k")
        named = found.join(members, "nid").where(F.col("vec_id") != F.col("query_id"))
        # An id of several vectors counts by its nearest.
        named = named.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
        rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
        return named.withColumn("rank", rank).where(F.col("rank") <= NEAREST).select("query_id", "rank", "vec_id", "score")

    def _walk(self, ids: np.ndarray, x: np.ndarray, own: list[int | None]) -> DataFrame:
        """Beams of a block of queries: query_id, nid, score of the nearest nodes met. own: the nodes of equal vectors."""
        spark = self.nodes.sparkSession
        shared = spark.sparkContext.broadcast(x)
        start = []
        for lo in range(0, len(x), 256):
            cut = x[lo : lo + 256]
            d = (cut**2).sum(1)[:, None] + (self.entries**2).sum(1) - 2 * cut @ self.entries.T
            near = np.argsort(d, 1, kind="stable")[:, :ENTRIES]
            start += [(lo + i, sorted({*self.entry_ids[near[i]].tolist(), *own[lo + i : lo + i + 1]} - {None})) for i in range(len(cut))]
        columns = "q long, bound double, ask array<long>, open array<long>, ids array<long>, d array<double>, closed array<long>, seen array<long>"
        state = written(spark.createDataFrame([(q, float("inf"), v, v, [], [], [], v) for q, v in start], columns), "ann-walk")

        def measured(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part in parts:
                opened = part["opened"].to_numpy(zero_copy_only=False)
                near, handed = part.filter(pa.array(~opened)), part.filter(pa.array(opened))
                if near.num_rows:
                    d = np.sqrt(((_matrix(near["e"]) - shared.value[near["q"].to_numpy()]) ** 2).sum(1))
                    keep = pa.array(d < near["bound"].to_numpy())
                    yield pa.RecordBatch.from_arrays([near["q"], near["nid"], pa.array(d), near["adj"]], schema=_MET).filter(keep)
                if handed.num_rows:
                    yield pa.RecordBatch.from_arrays([handed["q"], handed["nid"], pa.nulls(handed.num_rows, pa.float64()), handed["adj"]], schema=_MET)

        def moved(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            # A row may hold some ten thousand numbers, so no Python objects are made of them.
            for part in parts:
                new, at = _pieces(part["new"])
                nid, met = new.field(0).to_numpy(), new.field(1).to_numpy(zero_copy_only=False)
                adj, cuts = _pieces(new.field(2))
                adj = adj.to_numpy()
                old = {c: _pieces(part[c]) for c in ("open", "ids", "d", "closed", "seen")}
                old = {c: (v.to_numpy(), ends) for c, (v, ends) in old.items()}
                rows = []
                for r, q in enumerate(part["q"].to_pylist()):
                    opened, held, dist, closed, seen = (v[ends[r] : ends[r + 1]] for v, ends in old.values())
                    own, d = nid[at[r] : at[r + 1]], met[at[r] : at[r + 1]]
                    fine = ~np.isnan(d)
                    held, dist = np.concatenate([held, own[fine]]), np.concatenate([dist, d[fine]])
                    order = np.lexsort((held, dist))[:WIDTH]
                    held, dist = held[order], dist[order]
                    ask = np.setdiff1d(adj[cuts[at[r]] : cuts[at[r + 1]]], seen)
                    closed = np.intersect1d(np.concatenate([closed, opened]), held)
                    bound = float(dist[-1]) if len(dist) == WIDTH else float("inf")
                    rows.append((q, bound, ask, held[~np.isin(held, closed)][:OPENED], held, dist, closed, np.concatenate([seen, ask])))
                if rows:
                    yield _state(rows)

        while True:
            asked = state.select("q", "bound", F.explode("ask").alias("nid"), F.lit(False).alias("opened"))
            asked = asked.unionByName(state.select("q", "bound", F.explode("open").alias("nid"), F.lit(True).alias("opened")))
            steps = asked.join(self.graph, "nid")
            # Only what a row asks for goes on: the vector of a node to be measured, the neighbours of an open one.
            steps = steps.select("q", "bound", "nid", "opened", F.when(~F.col("opened"), F.col("e")).alias("e"), F.when(F.col("opened"), F.col("adj")).alias("adj"))
            met = steps.mapInArrow(measured, "q long, nid long, d double, adj array<long>").groupBy("q").agg(F.collect_list(F.struct("nid", "d", "adj")).alias("new"))
            after = written(state.join(met, "q", "left").mapInArrow(moved, columns), "ann-walk")
            forget(state)
            state = after
            # A node is asked for once and opened once, so a walk ends.
            if state.where("size(ask) > 0 or size(open) > 0").isEmpty():
                break
        best = state.select("q", F.slice(F.arrays_zip(F.col("ids").alias("nid"), F.col("d").alias("score")), 1, 4 * NEAREST).alias("b")).select("q", F.explode("b").alias("b")).select("q", "b.*")
        names = spark.createDataFrame([(i, int(x)) for i, x in enumerate(ids)], "q long, query_id long")
        return best.toDF("q", "nid", "score").join(names, "q").select("query_id", "nid", "score")


_IDS, _FAR = pa.list_(pa.int64()), pa.list_(pa.float64())
_MET = pa.schema([("q", pa.int64()), ("nid", pa.int64()), ("d", pa.float64()), ("adj", _IDS)])
_WALK = pa.schema([("q", pa.int64()), ("bound", pa.float64()), ("ask", _IDS), ("open", _IDS), ("ids", _IDS), ("d", _FAR), ("closed", _IDS), ("seen", _IDS)])


def _pieces(column: pa.ListArray) -> tuple[pa.Array, np.ndarray]:
    """The values of all lists, and where each begins and the last ends; a null list is empty."""
    ends = np.concatenate([[0], np.cumsum(column.value_lengths().fill_null(0).to_numpy())])
    return column.flatten(), ends


def _state(rows: list[tuple]) -> pa.RecordBatch:
    """Rows of _WALK from numbers and arrays."""
    columns = []
    for values, f in zip(zip(*rows, strict=True), _WALK, strict=True):
        if pa.types.is_list(f.type):
            ends = np.concatenate([[0], np.cumsum([len(x) for x in values])]).astype(np.int32)
            columns.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(values), f.type.value_type)))
        else:
            columns.append(pa.array(values, f.type))
    return pa.RecordBatch.from_arrays(columns, schema=_WALK)


def op5_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nearest neighbours of every hundredth vector among all vectors."""
    index = Index(usable(spark.read.parquet(f"{sf_dir}/embeddings.parquet")))
    return index.search(index.vectors.where("vec_id % 100 = 0").select(F.col("vec_id").alias("query_id"), "e"))
