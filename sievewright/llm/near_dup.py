"""MinHash near-dedup by a chosen-path set similarity join.

A document's set is that of its five-word shingles. Documents of equal sets form
one class at once; a class has a MinHash signature. Independent trees branch the
classes: a node chooses signature places by a hash of its path, and each class goes to
the children named by its values there, so similar classes stay together at
some child of every level and others part quickly. In a node of up to
SMALL classes all are compared by signature; in a larger one all with its
first class, and it branches again if it holds classes not known to be connected.
Candidates are confirmed on full sets. As only connection
counts, no pair is looked at whose classes are already connected, so a large group of
near copies costs a star, not its square. The trees are taken round after round (ROUNDS):
what one round connects is one part in the next, which takes up only nodes that hold
several parts. Rows carry sizes and signatures, so no level joins classes again. Nodes that are still large
at DEPTH are compared in square cells of small blocks: nothing is dropped.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from math import floor, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.graph import EDGES, components
from ..operators.joins import hot_keys, spread_join
from .common import batches, blobs, forget, mixed, written

SHINGLE = 5
#: Signature places, branches of a root, chance at most that all trees miss a pair at the threshold after four levels.
PLACES, ROOT_BRANCHES, MISSED = 128, 2, 3e-5
SEED = 8
SMALL, DEPTH = 256, 5
#: Trees that are searched together: the first alone, as it connects the large groups; the last round takes all that are left.
ROUNDS = (1,)
#: Nodes that may be broadcast: their rows have some 60 bytes, those of large ones 200.
FEW = 100_000
#: Classes to a block of a cell, about.
CELL = 400
#: Buckets of document ids that a second reading of the texts is narrowed by.
BUCKETS = 1 << 20

_rng = np.random.default_rng(20240229)
_MULTIPLY = (_rng.integers(0, 1 << 32, PLACES, dtype=np.uint64) | np.uint64(1)).astype(np.uint32)
_ADD = _rng.integers(0, 1 << 32, PLACES, dtype=np.uint64).astype(np.uint32)
_STEP = [np.uint64(x) for x in _rng.integers(0, 1 << 63, SHINGLE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)]


def shingles(text: bytes) -> np.ndarray:
    """The sorted 64-bit hashes of a text's shingles; of its whole word sequence if that is shorter; none without words."""
    from xxhash import xxh3_64_intdigest

    words = text.lower().split()
    if len(words) < SHINGLE:
        return np.array([xxh3_64_intdigest(b" ".join(words), len(words) + 1)] if words else [], np.uint64)
    w = np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words))
    n = len(w) - SHINGLE + 1
    h = w[:n] * _STEP[0]
    for k in range(1, SHINGLE):
        h += w[k : k + n] * _STEP[k]
    return np.unique(mixed(h))


def signature(s: np.ndarray) -> bytes:
    x = (s >> np.uint64(32)).astype(np.uint32)
    best = np.full(PLACES, 0xFFFFFFFF, np.uint32)
    for lo in range(0, len(x), 1024):
        np.minimum(best, (x[lo : lo + 1024, None] * _MULTIPLY + _ADD).min(0), out=best)
    return best.tobytes()


_SKETCH = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("fp", pa.binary()), ("n_shingles", pa.int64()), ("sig", pa.binary())])


def _text_hash() -> Column:
    return F.xxhash64(F.coalesce("text", F.lit("")))


def sketch(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, fp (a hash of the whole set), n_shingles and sig of every row."""
    from xxhash import xxh3_128_digest

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def row(doc_id: int | None, text_hash: int, text: bytes) -> tuple:
            s = shingles(text)
            return (doc_id, text_hash, xxh3_128_digest(s.tobytes()), len(s), signature(s) if len(s) else b"")

        for part in (whole.slice(lo, 512) for whole in parts for lo in range(0, whole.num_rows, 512)):
            yield from batches(map(row, part["doc_id"].to_pylist(), part["text_hash"].to_pylist(), blobs(part["text"])), _SKETCH)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _text_hash().alias("text_hash"), "text")
    return rows.mapInArrow(run, "doc_id long, text_hash long, fp binary, n_shingles long, sig binary")


def _child(place: Column) -> Column:
    """The child of a node that a class goes to by its value at place."""
    return F.xxhash64("node", place, F.substring("sig", place * 4 + 1, F.lit(4))).alias("child")


@dataclass(frozen=True)
class Rules:
    """percent: the least similarity of a link. The rest follows from it.

    agree: of the signatures' low bytes, fewer equal ones than this lie five deviations off at the threshold.
    second: the chance that a node below the root has a second place, so that a pair at the threshold
    meets again in one child on average, and less similar ones die out.
    trees: so many that all miss such a pair with chance MISSED at most.
    """

    percent: int = 85
    agree: int = field(init=False)
    second: float = field(init=False)
    trees: int = field(init=False)

    def __post_init__(self) -> None:
        t = self.percent / 100
        second = 1 / t - 1
        lost = 0.0
        for _ in range(3):
            x = 1 - t + t * lost
            lost = x * (1 - second + second * x)
        miss, trees = (1 - t + t * lost) ** ROOT_BRANCHES, 1
        while miss**trees > MISSED:
            trees += 1
        object.__setattr__(self, "agree", floor(PLACES * t - 5 * sqrt(PLACES * t * (1 - t))))
        object.__setattr__(self, "second", second)
        object.__setattr__(self, "trees", trees)

    def rounds(self) -> list[range]:
        """The trees, round after round."""
        out, start = [], 0
        for n in (*ROUNDS, self.trees):
            if start < self.trees:
                out.append(range(start, min(self.trees, start + n)))
                start += n
        return out


_ROW = ("cid", "n", "low", "sig", "comp")


def _roots(classes: DataFrame, trees: range) -> DataFrame:
    """Every class (_ROW) in every tree of trees, at ROOT_BRANCHES different places of each."""
    ways = []
    for tree in trees:
        places = np.random.default_rng(SEED + tree).choice(PLACES, ROOT_BRANCHES, replace=False)
        ways += [F.struct(F.lit(tree).cast("long").alias("node"), F.lit(int(place)).alias("place")) for place in places]
    rows = classes.select(*_ROW, F.explode(F.array(*ways)).alias("w")).select(*_ROW, "w.node", "w.place")
    return rows.select(_child(F.col("place")).alias("node"), *_ROW)


def _by_size(rows: DataFrame, rules: Rules) -> DataFrame:
    """Nodes cut by size: each class goes to its own size's child and to the next, and sizes within the threshold
    share one. Nothing is lost by it. Nodes whose sizes (least to most) are all within the threshold stay whole."""
    own = F.floor(F.log("n") / np.log(1 / (rules.percent / 100 - 0.001)))
    near = 100 * F.col("least") >= rules.percent * F.col("most")
    sizes = F.explode(F.when(near, F.array(F.lit(0).cast("long"))).otherwise(F.array(own, own + 1)))
    return rows.withColumn("_size", sizes).select(F.xxhash64("node", "_size").alias("node"), *_ROW)


def _children(rows: DataFrame, rules: Rules) -> DataFrame:
    """Each node's one place, or two with the chance second, by its hash."""
    h = F.xxhash64("node", F.lit(SEED))
    first = F.pmod(h, F.lit(PLACES)).cast("int")
    second = F.pmod(first + 1 + F.pmod(F.shiftright(h, 32), F.lit(PLACES - 1)), F.lit(PLACES)).cast("int")
    two = F.pmod(F.shiftright(h, 12), F.lit(1000)) < int(1000 * rules.second)
    dealt = rows.withColumn("place", F.explode(F.when(two, F.array(first, second)).otherwise(F.array(first))))
    return dealt.select(_child(F.col("place")).alias("node"), *_ROW)


def _may_link(rules: Rules, n_a: np.ndarray, n_b: np.ndarray, low_a: np.ndarray, low_b: np.ndarray) -> np.ndarray:
    """Pairs whose sizes and signatures allow the threshold."""
    sizes = 100 * np.minimum(n_a, n_b) >= rules.percent * np.maximum(n_a, n_b)
    return sizes & ((low_a == low_b).sum(1) >= rules.agree)


_EDGES = pa.schema([("node", pa.int64()), ("a", pa.int64()), ("b", pa.int64()), ("rest", pa.bool_())])


def _portions(sizes: np.ndarray, most: int = 200_000) -> Iterator[range]:
    """Runs of nodes with about `most` pairs together."""
    start, pairs = 0, 0
    for k, n in enumerate(sizes.tolist()):
        pairs += n * (n - 1) // 2
        if pairs >= most:
            yield range(start, k + 1)
            start, pairs = k + 1, 0
    if start < len(sizes):
        yield range(start, len(sizes))


def _holds(x: bytes, y: bytes, percent: int) -> bool:
    """Whether two whole sets reach the threshold."""
    s, t = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
    both = len(np.intersect1d(s, t, assume_unique=True))
    return 100 * both >= percent * (len(s) + len(t) - both)


def _forests(mode: str, rules: Rules):
    """For nodes (node, members of cid, n, low, comp, nodes, members): edges between members that may link and are not connected.

    spanning: a spanning forest by signatures, and whether there were other edges (rest).
    The other modes take every edge in the first node alone that its ends share (nodes: a
    member's). ends: the classes at such edges, as a, with their comp as b. exact: edges
    are tried on whole sets (members), unless links found before connect their ends; links come out.
    """

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            flat, ends = part["members"].flatten(), part["members"].offsets.to_numpy()
            ends = ends - ends[0]
            cid, n, comp = (flat.field(k).to_numpy(zero_copy_only=False) for k in (0, 1, 3))
            low = np.frombuffer(b"".join(flat.field(2).to_pylist()), np.uint8).reshape(-1, PLACES)
            nodes = part["node"].to_pylist()
            places = [set(x) for x in flat.field(4).to_pylist()] if mode != "spanning" else []
            sets = flat.field(5) if mode == "exact" else None
            out: list[tuple] = []
            for some in _portions(np.diff(ends)):
                pairs, of = [], []
                for k in some:
                    i, j = np.triu_indices(ends[k + 1] - ends[k], 1)
                    pairs.append(np.stack([i, j]) + ends[k])
                    of.append(np.full(len(i), k))
                (i, j), k = np.concatenate(pairs, 1), np.concatenate(of)
                open_ = (comp[i] != comp[j]) & (cid[i] != cid[j])
                i, j, k = i[open_], j[open_], k[open_]
                keep = np.zeros(len(i), bool)
                for at in range(0, len(i), 50_000):
                    x, y = i[at : at + 50_000], j[at : at + 50_000]
                    keep[at : at + 50_000] = _may_link(rules, n[x], n[y], low[x], low[y])
                i, j, k = i[keep], j[keep], k[keep]
                numbers, first = np.unique(k, return_index=True)
                for number, lo, hi in zip(numbers, first, np.append(first, len(k))[1:], strict=True):
                    found = list(zip(i[lo:hi].tolist(), j[lo:hi].tolist(), strict=True))
                    if mode != "spanning":
                        found = [(x, y) for x, y in found if min(places[x] & places[y]) == nodes[number]]
                    if mode == "ends":
                        out += [(nodes[number], cid[x], comp[x], False) for x in {x for pair in found for x in pair}]
                        continue
                    chosen = _spanning(found, comp, (lambda x, y, sets=sets: _holds(sets[x].as_py(), sets[y].as_py(), rules.percent)) if sets is not None else None)
                    out += [(nodes[number], min(cid[x], cid[y]), max(cid[x], cid[y]), len(chosen) < len(found)) for x, y in chosen]
            yield from batches(iter(out), _EDGES)

    return run


def _spanning(pairs: list[tuple[int, int]], comp: np.ndarray, holds=None) -> list[tuple[int, int]]:
    """Pairs, in turn, that hold and join parts not yet joined; members of one comp are one part."""
    up: dict[int, int] = {}

    def top(x: int) -> int:
        while (y := up.get(x, x)) != x:
            up[x] = up.get(y, y)
            x = up[x]
        return x

    out = []
    for a, b in pairs:
        x, y = top(int(comp[a])), top(int(comp[b]))
        if x != y and (holds is None or holds(a, b)):
            up[max(x, y)] = min(x, y)
            out.append((a, b))
    return out


def _stars(rules: Rules):
    """Members of large nodes that may link with the node's first class."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            if not part.num_rows:
                continue
            cols = {c: part[c].to_numpy(zero_copy_only=False) for c in ("node", "cid", "n", "leader", "leader_n")}
            low, other = (np.frombuffer(b"".join(part[c].to_pylist()), np.uint8).reshape(-1, PLACES) for c in ("low", "leader_low"))
            keep = _may_link(rules, cols["n"], cols["leader_n"], low, other)
            yield pa.RecordBatch.from_arrays([pa.array(cols[c][keep]) for c in ("node", "leader", "cid")] + [pa.array(np.zeros(int(keep.sum()), bool))], schema=_EDGES)

    return run


_SETS = pa.schema([("fp", pa.binary()), ("members", pa.binary())])


def _sets_of(docs: DataFrame, classes: DataFrame, ids: DataFrame) -> DataFrame | None:
    """cid and the whole set (sorted 64-bit hashes) of every class of ids (cid), from the texts; None if there are no ids.

    The texts are read again; rows that can't be wanted are passed over by a bitmap of
    BUCKETS hashed document ids, whose size does not depend on the data.
    """
    from xxhash import xxh3_128_digest

    def bucket(doc_id: str) -> Column:
        return F.pmod(F.xxhash64(F.coalesce(F.col(doc_id).cast("long"), F.lit(-1))), F.lit(BUCKETS)).cast("int").alias("bucket")

    wanted = written(classes.select("cid", "fp", bucket("head")).join(ids, "cid", "left_semi"), "near-wanted")
    hits = wanted.select("bucket").distinct().toArrow()["bucket"].to_numpy()
    if not len(hits):
        forget(wanted)
        return None
    hit = np.zeros(BUCKETS, bool)
    hit[hits] = True
    shared = docs.sparkSession.sparkContext.broadcast(np.packbits(hit))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.unpackbits(shared.value).astype(bool)

        def row(text: bytes) -> tuple:
            s = shingles(text)
            return (xxh3_128_digest(s.tobytes()), s.tobytes())

        for part in parts:
            chosen = part.filter(pa.array(bits[part["bucket"].to_numpy()]))
            yield from batches(map(row, blobs(chosen["text"])), _SETS)

    sets = docs.select(bucket("doc_id"), "text").mapInArrow(run, "fp binary, members binary")
    out = written(sets.join(wanted.select("cid", "fp"), "fp").dropDuplicates(["cid"]).select("cid", "members"), "near-sets")
    forget(wanted)
    return out


_LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _confirmed(sets: DataFrame, pairs: DataFrame, rules: Rules) -> DataFrame:
    """Those of pairs (a, b) whose full sets (cid, members) reach the threshold. Where there are many pairs, a class of many is dealt over several tasks."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            keep = [_holds(x, y, rules.percent) for x, y in zip(part["x"].to_pylist(), part["y"].to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([part["a"], part["b"]], schema=_LINKS).filter(pa.array(keep, pa.bool_()))

    full, many = pairs, pairs.count() > EDGES
    for end, other, name in (("a", "b", "x"), ("b", "a", "y")):
        own = sets.select(F.col("cid").alias(end), F.col("members").alias(name))
        full = spread_join(full, own, hot_keys(pairs, [end]), [end], [other]) if many else full.join(own, end)
    return full.select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def _with_comp(rows: DataFrame, labels: DataFrame | None) -> DataFrame:
    """rows with comp, the part that cid belongs to by labels: itself, if they don't hold it."""
    rows = rows.drop("comp")
    if labels is None:
        return rows.withColumn("comp", F.col("cid"))
    return rows.join(labels, "cid", "left").withColumn("comp", F.coalesce("comp", "cid"))


def _parts_of(rows: DataFrame) -> DataFrame:
    """node, size, leader (the smallest cid), least and most (sizes of sets), of the nodes of rows that hold several parts."""
    nodes = rows.groupBy("node").agg(F.count(F.lit(1)).alias("size"), F.min("cid").alias("leader"), F.min("n").alias("least"), F.max("n").alias("most"), F.min("comp").alias("c0"), F.max("comp").alias("c1"))
    return nodes.where("c0 <> c1").drop("c0", "c1")


_EDGE_COLUMNS = "node long, a long, b long, rest boolean"


class _Search:
    """What is known so far: pairs that were tried, those that hold, the sets they took, labels of connected classes (None: no link)."""

    def __init__(self, docs: DataFrame, classes: DataFrame, rules: Rules) -> None:
        self.docs, self.classes, self.rules = docs, classes, rules
        self.tried: DataFrame | None = None
        self.good: DataFrame | None = None
        self.sets: DataFrame | None = None
        self.labels: DataFrame | None = None

    def confirm(self, pairs: DataFrame) -> None:
        """Tries those of pairs (a, b) that were not tried before, and connects what is confirmed."""
        pairs = pairs.distinct()
        pairs = written(pairs if self.tried is None else pairs.join(self.tried, ["a", "b"], "left_anti"), "near-pairs")
        if pairs.isEmpty():
            return
        self.fetch(pairs.select(F.explode(F.array("a", "b")).alias("cid")).distinct())
        good = written(_confirmed(self.sets, pairs, self.rules), "near-links")
        self.tried = pairs if self.tried is None else self.tried.unionByName(pairs)
        self.good = good if self.good is None else self.good.unionByName(good)
        self.connect(good)

    def fetch(self, ids: DataFrame) -> None:
        """Adds the whole sets of those ids (cid) whose sets are not at hand yet."""
        new = ids if self.sets is None else ids.join(self.sets.select("cid"), "cid", "left_anti")
        if (sets := _sets_of(self.docs, self.classes, new)) is not None:
            self.sets = sets if self.sets is None else self.sets.unionByName(sets)

    def connect(self, good: DataFrame) -> None:
        """Joins the parts that new links join: each label is a link itself."""
        if good.isEmpty():
            return
        old = self.labels
        self.labels = components(good if old is None else good.unionByName(old.select(F.col("cid").alias("a"), F.col("comp").alias("b"))))
        if old is not None:
            forget(old)

    def forests(self, held: DataFrame) -> DataFrame:
        """Edges inside the nodes of held, each of which has few members."""
        members = held.groupBy("node").agg(F.collect_list(F.struct("cid", "n", "low", "comp")).alias("members"))
        return members.mapInArrow(_forests("spanning", self.rules), _EDGE_COLUMNS)

    def stars(self, held: DataFrame) -> DataFrame:
        """Edges from the first class of each node of held; only pairs whose sizes allow them are looked at."""
        sizes = 100 * F.least("n", "leader_n") >= self.rules.percent * F.greatest("n", "leader_n")
        pairs = held.where((F.col("comp") != F.col("leader_comp")) & sizes)
        return pairs.select("node", "cid", "n", "low", "leader", "leader_n", "leader_low").mapInArrow(_stars(self.rules), _EDGE_COLUMNS)

    def search_whole(self, held: DataFrame) -> None:
        """Tries every edge inside the nodes of held. Classes at edges that signatures allow bring their whole sets, so a set travels once a node, not once an edge."""

        def nodes_with(rows: DataFrame, *fields: str) -> DataFrame:
            # A class has few nodes: some for each tree and level.
            full = rows.withColumn("nodes", F.collect_set("node").over(Window.partitionBy("cid")))
            return full.groupBy("node").agg(F.collect_list(F.struct("cid", "n", "low", "comp", "nodes", *fields)).alias("members"))

        ends = nodes_with(held).mapInArrow(_forests("ends", self.rules), _EDGE_COLUMNS)
        ends = written(ends.select("node", F.col("a").alias("cid")).join(held, ["node", "cid"]), "near-ends")
        if ends.isEmpty():
            return
        self.fetch(ends.select("cid").distinct())
        full = ends.join(self.sets, "cid")
        links = nodes_with(full, "members").mapInArrow(_forests("exact", self.rules), _EDGE_COLUMNS).select("a", "b").distinct()
        self.connect(written(links, "near-links"))
        forget(ends)

    def held(self, rows: DataFrame, last: bool) -> DataFrame | None:
        """The rows in nodes of several parts, with the node's size, its least and largest set, and of large nodes the first class; None if there are none."""
        nodes = written(_parts_of(rows), "near-nodes")
        n = nodes.count()
        if not n:
            forget(nodes)
            return None
        # The first class of each large node, once a node: its row brings it to all others with the node's size.
        large = nodes.where(F.col("size") > SMALL).select("node", F.col("leader").alias("cid"))
        lead = rows.join(F.broadcast(large) if n <= FEW else large, ["node", "cid"])
        lead = lead.select("node", F.col("n").alias("leader_n"), F.col("comp").alias("leader_comp"), F.col("low").alias("leader_low"))
        nodes_with = written(nodes.join(F.broadcast(lead) if n <= FEW else lead, "node", "left"), "near-nodes")
        if n <= FEW:
            found = rows.join(F.broadcast(nodes_with), "node")
        else:
            # Narrow rows are dealt out; what is held then gets its signature.
            found = spread_join(rows.drop("low", "sig"), nodes_with, hot_keys(nodes, ["node"], "size"), ["node"], ["cid"])
            found = found.join(self.classes.select("cid", "low", "sig"), "cid")
        # Signatures go on to children only.
        found = found.withColumn("sig", F.when(F.col("size") > SMALL, F.col("sig")))
        found = written(_cells(found) if last else found, "near-held")
        forget(nodes, nodes_with)
        return found

    def descend(self, rows: DataFrame) -> Iterator[tuple[DataFrame, DataFrame]]:
        """The members of small nodes, and their edges: of the first level, then of all below. The first level's edges
        are tried at once, so that large groups of near copies are connected and stay out of the levels below; as
        theirs are tried together, they are looked for together, too."""
        below: DataFrame | None = None
        for depth in range(DEPTH + 1):
            held = self.held(rows, depth == DEPTH)
            if held is None:
                break
            large = held.where(F.col("size") > SMALL)
            deeper = not large.isEmpty()
            if depth == 0:
                yield self.looked_over(held)
            else:
                below = held if below is None else below.unionByName(held)
            if not deeper:
                break
            rows = _with_comp(large, self.labels) if depth == 0 else large
            rows = _by_size(rows, self.rules) if depth == 0 else rows.select("node", *_ROW) if depth + 1 == DEPTH else _children(rows, self.rules)
            # What comes of one part by now is not held again.
            rows = written(rows, "near-rows")
        if below is not None:
            yield self.looked_over(below)

    def looked_over(self, held: DataFrame) -> tuple[DataFrame, DataFrame]:
        """The members of held's small nodes, and the edges of all its nodes, which are tried."""
        small, large = held.where(F.col("size") <= SMALL), held.where(F.col("size") > SMALL)
        edges = written(self.forests(small).unionByName(self.stars(large)), "near-edges")
        self.confirm(edges.select("a", "b"))
        return small, edges

    def run(self) -> DataFrame | None:
        """All trees, round after round. Where an edge of a small node's forest is refused and others were held
        back, these follow at the end."""
        own = self.classes.select("cid", F.col("n_shingles").alias("n"), "low", "sig")
        members: DataFrame | None = None
        rest: DataFrame | None = None
        for trees in self.rules.rounds():
            for small, edges in self.descend(_roots(_with_comp(own, self.labels), trees)):
                small, more = small.select("node", "cid", "n", "low"), edges.where("rest").select("node", "a", "b")
                members = small if members is None else members.unionByName(small)
                rest = more if rest is None else rest.unionByName(more)
        if self.good is not None:
            # The optimizer makes a join of every table below a union: small sides are broadcast, so that none is dealt out.
            refused = written(rest.join(_few(self.good), ["a", "b"], "left_anti").select("node").distinct(), "near-refused")
            # Nodes of one part by now are passed over in the nodes.
            self.search_whole(written(_with_comp(members.join(_few(refused), "node", "left_semi"), self.labels), "near-whole"))
        return self.labels


def _few(rows: DataFrame) -> DataFrame:
    """rows, to be broadcast if there are FEW of them at most: their columns are two numbers at most."""
    return F.broadcast(rows) if rows.count() <= FEW else rows


def _cells(held: DataFrame) -> DataFrame:
    """What is left of large nodes, as cells of two blocks each, so that every pair of a node meets in one cell."""
    blocks = F.ceil(F.col("size") / CELL).cast("long")
    mine = F.pmod(F.xxhash64("cid"), F.col("blocks"))
    dealt = held.withColumn("blocks", blocks).withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    cell = F.xxhash64("node", F.least("mine", "other"), F.greatest("mine", "other"))
    return dealt.withColumn("node", cell).withColumn("size", F.lit(1).cast("long")).drop("blocks", "mine", "other")


def _resolved(docs: DataFrame, rules: Rules) -> DataFrame:
    """doc_id, text_hash, n_shingles, component_id, kept and comp (null for empty sets) of every row."""
    members = written(sketch(docs), "near-sketch")
    filled = members.where("n_shingles > 0").groupBy("fp").agg(F.min("doc_id").alias("head"), F.count(F.lit(1)).alias("copies"), F.first("n_shingles").alias("n_shingles"), F.first("sig").alias("sig"))
    classes = written(_low(filled.withColumn("cid", F.monotonically_increasing_id())), "near-classes")
    labels = _Search(docs, classes, rules).run()
    owned = _with_comp(classes.select("cid", "fp", "head", "copies"), labels)
    heads = owned.groupBy("comp").agg(F.min("head").alias("component_id"), F.count(F.lit(1)).alias("size"))
    owned = written(spread_join(owned, heads.drop("size"), hot_keys(heads, ["comp"], "size"), ["comp"], ["cid"]).select("fp", "copies", "component_id", "comp"), "near-owned")
    rows = members.select("doc_id", "text_hash", "fp", "n_shingles")
    rows = spread_join(rows, owned.drop("copies"), hot_keys(owned, ["fp"], "copies"), ["fp"], ["doc_id", "text_hash"], "left")
    rows = rows.withColumn("component_id", F.when(F.col("comp").isNotNull(), F.col("component_id")).otherwise(F.col("doc_id")))
    return rows.select("doc_id", "text_hash", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"), "comp")


def near_duplicates(docs: DataFrame, percent: int = 85) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row of docs (doc_id, text); links have a similarity of percent or more.

    Null text and texts without words have empty sets and stay alone. A null doc_id is never
    the smallest of its component; where all are null, component_id is null and the rows
    are kept. Repeated rows get equal results. Other columns are left out.
    """
    return _resolved(docs, Rules(percent)).select("doc_id", "n_shingles", "component_id", "kept")


_LOW = pa.schema([("cid", pa.int64()), ("fp", pa.binary()), ("head", pa.int64()), ("copies", pa.int64()), ("n_shingles", pa.int64()), ("sig", pa.binary()), ("low", pa.binary())])


def _low(classes: DataFrame) -> DataFrame:
    """Adds low: the low bytes of the signature."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            low = pa.array([x[::4] for x in part["sig"].to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([part[c] for c in ("cid", "fp", "head", "copies", "n_shingles", "sig")] + [low], schema=_LOW)

    return classes.mapInArrow(run, "cid long, fp binary, head long, copies long, n_shingles long, sig binary, low binary")


def keep_one(docs: DataFrame, percent: int = 80) -> DataFrame:
    """docs with one row of each component: one that has its smallest doc_id (of several, that of the least text hash).

    Rows without shingles stay, repeated ones once. The texts are dealt out once, by id and text hash.
    docs may have any other columns.
    """
    key = F.struct(F.coalesce("doc_id", F.lit(-1)).alias("k"), F.col("text_hash").alias("h"))
    kept = _resolved(docs, Rules(percent)).where("kept").select(key.alias("key"), "comp")
    alone = F.when(F.col("comp").isNull(), F.col("key"))
    chosen = kept.groupBy("comp", alone.alias("alone")).agg(F.min("key").alias("key")).select("key").distinct()
    own = F.struct(F.coalesce(F.col("doc_id").cast("long"), F.lit(-1)).alias("k"), _text_hash().alias("h"))
    rows = docs.select(own.alias("key"), F.struct(*docs.columns).alias("row"))
    return rows.join(chosen, "key").dropDuplicates(["key"]).select("row.*")


def op8_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of near duplicates among all documents."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
