import hashlib
import random
import time

import pytest
from pyspark.sql import functions as F

from sievewright.config import Dedup
from sievewright.functions import similarity
from sievewright.operators import dedup, graph

COLUMNS = "seq long, instruction string, input string, output string, task string"


def seqs(df):
    return sorted(r.seq for r in df.collect())


def test_exact_keys(spark):
    rows = [(0, "i", "a", "o", "요약"), (1, "i", "b", "o", "요약"), (2, "a ||| b", "", "c", "요약"), (3, "a", "", "b ||| c", "요약"), (4, "i", "a", None, "분류")]
    df = spark.createDataFrame(rows, COLUMNS)
    assert seqs(dedup.exact(df, "instruction_output")) == [0, 2, 4]
    assert seqs(dedup.exact(df, "input_output")) == [0, 1, 2, 3, 4]
    assert seqs(dedup.exact(df, "output")) == [0, 2, 3, 4]
    assert seqs(dedup.exact(df, "anything")) == seqs(dedup.exact(df, "input")) == [0, 1, 2]


@pytest.mark.parametrize("text, want", [("a b c d", {"a b c d"}), ("a b c d e f", {"a b c d e", "b c d e f"}), (" a  b ", {" a  b "}), ("a a a a a a a", {"a a a a a"})])
def test_ngrams(spark, text, want):
    assert set(spark.range(1).select(similarity.ngrams(F.lit(text), 5).alias("g")).first().g) == want


def test_long_texts_are_cut_once(spark):
    """Words derived anew for every n-gram took minutes here."""
    text = " ".join(f"w{i}" for i in range(30_000))
    df = spark.createDataFrame([(text,)], "x string")
    began = time.monotonic()
    assert df.select(F.size(similarity.ngrams(F.col("x"), 5)).alias("n")).first().n == 29_996
    assert time.monotonic() - began < 15


def test_sketch_and_sets(spark):
    """Sets by digest give the similarity of the sets themselves; equal sets, and these alone, share their mark."""
    texts = ["a b c d e f g h", "b c d e f g h i j", "a b c d e a b c d e", "e a b c d e a b c d e a b c d", "short", " short", "", "x y z v w " * 30]
    df = spark.createDataFrame(enumerate(texts), "k int, x string")
    rows = df.select("k", "x", similarity.ngrams(F.col("x"), 5).alias("g"), similarity.minhash(F.col("x"), 5, 32).alias("m"), similarity.sketch(F.col("x"), 5, 32).alias("s"), similarity.gram_set(F.col("x"), 5).alias("d"))
    for r in rows.collect():
        assert list(r.s.signature) == list(r.m) and len(r.d) == 16 * len(r.g)
    a, b = rows.select("k", "g", "d", "s").toDF("i", "ga", "da", "sa"), rows.select("k", "g", "d", "s").toDF("j", "gb", "db", "sb")
    for r in a.crossJoin(b).select("ga", "gb", F.expr("sa.set = sb.set").alias("same"), similarity.set_jaccard(F.col("da"), F.col("db")).alias("got"), similarity.jaccard(F.col("ga"), F.col("gb")).alias("want")).collect():
        assert r.got == r.want and r.same == (set(r.ga) == set(r.gb))


def test_jaccard_and_bands(spark):
    arr = lambda *x: F.array(*map(F.lit, x))
    got = spark.range(1).select(similarity.jaccard(arr("x", "y"), arr("y", "z")).alias("a"), similarity.jaccard(F.array().cast("array<string>"), arr("x")).alias("b")).first()
    assert got.a == pytest.approx(1 / 3) and got.b == 0.0
    assert similarity.bands(128, 0.85) == (8, 16) and similarity.bands(128, 0.70) == (16, 8)


def slow_signature(text, n, permutations):
    w = text.split()
    grams = {" ".join(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {text}
    h = [int.from_bytes(hashlib.md5(g.encode()).digest()[:4], "little") for g in grams]
    a, b = similarity.coefficients(permutations)
    return [min(((a[i] * x + b[i]) % similarity.PRIME) & similarity.TOP for x in h) for i in range(permutations)]


def test_signatures_are_exact(spark):
    texts = ["a b c d e f g h", "short", "word " * 40, " ".join(f"w{i}" for i in range(700))]
    df = spark.createDataFrame(enumerate(texts), "i int, x string")
    for r in df.select("x", similarity.minhash(F.col("x"), 5, 32).alias("s")).collect():
        assert list(r.s) == slow_signature(r.x, 5, 32)


def test_visiting_order(spark):
    edges = spark.createDataFrame([(5, 7, 1, 0), (2, 5, 2, 0)], "i long, j long, first long, band int")
    assert seqs(dedup.removed(edges)) == [5, 7]


def test_many_components_are_visited_fast(spark):
    """A task that starts a group anew for every component took a millisecond or more for each."""
    pairs = spark.range(60_000).select((F.col("id") * 3).alias("i"), (F.col("id") * 3 + 1).alias("j"), (F.col("id") * 3).alias("first"), F.lit(0).alias("band"))
    more = pairs.select(F.col("j").alias("i"), (F.col("j") + 1).alias("j"), "first", F.lit(1).alias("band"))
    began = time.monotonic()
    got = dedup.removed(pairs.unionByName(more).coalesce(2)).agg(F.count("seq").alias("n"), F.sum(F.col("seq") % 3).alias("s")).first()
    assert (got.n, got.s) == (60_000, 60_000)
    assert time.monotonic() - began < 40


def slow_near(rows, rules):
    """Buckets in the order in which records make them; every pair in turn."""
    text = {seq: f"{a} ||| {c}" for seq, a, _, c, _ in rows}
    n_bands, n_rows = similarity.bands(rules.permutations, rules.threshold)
    grams = {}
    for seq, t in text.items():
        w = t.split()
        grams[seq] = {" ".join(w[i : i + rules.ngram]) for i in range(len(w) - rules.ngram + 1)} if len(w) >= rules.ngram else {t}
    buckets = {}
    for seq in sorted(text):
        s = slow_signature(text[seq], rules.ngram, rules.permutations)
        for b in range(n_bands):
            buckets.setdefault((b, tuple(s[b * n_rows : (b + 1) * n_rows])), []).append(seq)
    gone = set()
    for members in buckets.values():
        for x, i in enumerate(members):
            for j in members[x + 1 :]:
                if i not in gone and j not in gone and len(grams[i] & grams[j]) / len(grams[i] | grams[j]) >= rules.threshold:
                    gone.add(j)
    return sorted(set(text) - gone)


@pytest.mark.parametrize("partitions", [1, 7])
def test_near_against_the_plain_procedure(spark, partitions):
    rng = random.Random(3)
    rules = Dedup(permutations=32, threshold=0.6)
    rows = []
    base = [[f"w{rng.randrange(500)}" for _ in range(60)] for _ in range(12)]
    for seq in range(90):
        w = list(rng.choice(base))
        for _ in range(rng.choice([0, 1, 2, 4])):
            w[rng.randrange(60)] = f"n{rng.randrange(99)}"
        rows.append((seq, "do it", f"in {seq}", " ".join(w), "요약"))
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = seqs(dedup.near(spark.createDataFrame(rows, COLUMNS).repartition(partitions), rules))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 8)
    want = slow_near(rows, rules)
    assert got == want and len(want) < 60


def test_routes(spark):
    text = " ".join(f"w{i}" for i in range(80))
    near = text + " end"
    rows = [(0, "i", "a", text, "요약"), (1, "i", "a", text, "분류"), (2, "i", "b", text, "분류"), (3, "i", "c", near, "요약"), (4, "i", "a", near, "분류"), (5, "i", "d", "other words", None)]
    df = spark.createDataFrame(rows, COLUMNS)
    order = [r.seq for r in dedup.routed(df).orderBy("_branch", "seq").collect()]
    assert order == [0, 5, 1, 2, 4]
    assert seqs(dedup.routed(df, Dedup(near=False))) == [0, 1, 2, 3, 4, 5]
    assert seqs(dedup.routed(df, Dedup(exact_only_tasks=()))) == [0, 5]
    assert seqs(dedup.routed(df, Dedup(exact=False, near=False))) == [0, 1, 2, 3, 4, 5]


def test_components(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(90, 91), (93, 91)], "a long, b long")
    assert {r.cid: r.comp for r in graph.components(links).collect()} == {**dict.fromkeys(range(41), 0), 90: 90, 91: 90, 93: 90}


def test_components_beyond_one_task(spark, monkeypatch):
    """The rounds of joins, with a hub and a chain, against the single task."""
    from sievewright.operators import graph, joins

    links = [(0, k) for k in range(1, 30)] + [(100 + k, 101 + k) for k in range(12)] + [(29, 200), (300, 300)]
    df = spark.createDataFrame(links, "a long, b long")
    few = sorted(map(tuple, graph.components(df).collect()))
    monkeypatch.setattr(graph, "EDGES", 5)
    monkeypatch.setattr(joins, "MOST", 3)
    assert sorted(map(tuple, graph.components(df).collect())) == few
    assert dict(few)[200] == 0 and dict(few)[112] == 100 and dict(few)[300] == 300


def test_spread_join_equals_join(spark, monkeypatch):
    from sievewright.operators import joins

    monkeypatch.setattr(joins, "MOST", 2)
    rows = spark.createDataFrame([(k % 3, k) for k in range(40)] + [(None, 99), (7, 100)], "key long, v long")
    other = spark.createDataFrame([(0, "a"), (1, "b"), (5, "c")], "key long, w string")
    for how in ("inner", "left", "left_semi"):
        got = joins.spread_join(rows, other, joins.hot_keys(rows.where("key IS NOT NULL"), ["key"]), ["key"], ["v"], how)
        assert sorted(map(str, got.collect())) == sorted(map(str, rows.join(other, "key", how).collect()))
