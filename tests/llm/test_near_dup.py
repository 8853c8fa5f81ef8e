import random

import numpy as np
import pytest

from sievewright.llm import near_dup


def brute(rows):
    """Components by comparing all sets."""
    sets = []
    for _, text in rows:
        w = (text or "").encode().lower().split()
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set()))
    up = list(range(len(rows)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and 100 * both >= 85 * (len(sets[i]) + len(sets[j]) - both) and both:
                up[max(top(i), top(j))] = min(top(i), top(j))
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(top(i), []).append(rows[i][0])
    out = []
    for i, (doc_id, _) in enumerate(rows):
        ids = [x for x in groups[top(i)] if x is not None] if sets[i] else [doc_id]
        smallest = min((x for x in ids if x is not None), default=None)
        out.append((doc_id, len(sets[i]), smallest, doc_id == smallest))
    return sorted(out, key=str)


def run(spark, tmp_path, rows, partitions=3):
    spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, cid int, component_id string").repartition(partitions).write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
    return sorted((tuple(r) for r in near_dup.op8_near_dup(spark, str(tmp_path)).collect()), key=str)


def corpus(seed, n, passages=3):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdefghij", k=4))
    shared = [" ".join(word() for _ in range(60)) for _ in range(passages)]
    rows = []
    while len(rows) < n:
        w = [word() for _ in range(rng.randint(1, 300))]
        if rng.random() < 0.3:
            w += shared[rng.randrange(passages)].split()
        rows.append(" ".join(w))
        for _ in range(rng.choice([0, 0, 0, 1, 4])):
            copy = list(w)
            for _ in range(rng.choice([0, 1, 2, 6])):
                copy[rng.randrange(len(copy))] = word()
            rows.append(" ".join(copy).upper() if rng.random() < 0.3 else "  ".join(copy))
    ids = list(range(len(rows)))
    rng.shuffle(ids)
    return list(zip(ids, rows, strict=True))


def test_against_brute_force(spark, tmp_path):
    rows = corpus(1, 350)
    assert run(spark, tmp_path, rows) == brute(rows)


def test_awkward_rows(spark, tmp_path):
    long = " ".join(f"w{i % 997}x{i}" for i in range(40_000))
    rows = [(1, None), (2, ""), (3, " \t"), (4, "a b"), (5, "A  b"), (6, "a b c d e"), (7, "a b c d e"), (7, "a b c d e"), (None, "a b c d e"), (None, "lone null"), (None, "lone null"), (10, long), (9, long + " end"), (11, "b a")]
    assert run(spark, tmp_path, rows) == brute(rows)


def test_empty_table(spark, tmp_path):
    assert run(spark, tmp_path, []) == []


@pytest.mark.parametrize("depth", [2, 8])
def test_large_groups_branch_and_end_in_cells(spark, tmp_path, monkeypatch, depth):
    """Chains of near copies, more than a node may hold, with the smallest bounds."""
    monkeypatch.setattr(near_dup, "SMALL", 8)
    monkeypatch.setattr(near_dup, "CELL", 6)
    monkeypatch.setattr(near_dup, "DEPTH", depth)
    rng = random.Random(5)
    w = [f"t{i}" for i in range(200)]
    rows = []
    for i in range(90):
        w[rng.randrange(200)] = f"n{i}"
        rows.append((i, " ".join(w)))
    assert run(spark, tmp_path, rows) == brute(rows)


def test_nodes_without_candidates():
    """Portions in which no pair may link, or all are connected, give nothing."""
    import pyarrow as pa

    member = pa.struct([("cid", pa.int64()), ("n", pa.int64()), ("low", pa.binary()), ("comp", pa.int64())])
    apart = [{"cid": c, "n": 10, "low": bytes([c]) * near_dup.PLACES, "comp": c} for c in range(3)]
    one = [{"cid": c, "n": 10, "low": bytes(near_dup.PLACES), "comp": 0} for c in range(4)]
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2, 3], pa.int64()), pa.array([apart, one, []], pa.list_(member))], names=["node", "members"])
    assert sum(b.num_rows for b in near_dup._forests("spanning", near_dup.Rules())(iter([batch]))) == 0
    near = [{"cid": c, "n": 10, "low": bytes(near_dup.PLACES), "comp": c} for c in range(4)]
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2], pa.int64()), pa.array([near, apart], pa.list_(member))], names=["node", "members"])
    (out,) = list(near_dup._forests("spanning", near_dup.Rules())(iter([batch])))
    assert out["a"].to_pylist() == [0, 0, 0] and out["b"].to_pylist() == [1, 2, 3] and out["rest"].to_pylist() == [True] * 3


def test_signature_estimates():
    rng = np.random.default_rng(3)
    a = np.unique(rng.integers(0, 1 << 63, 1000, dtype=np.uint64))
    b = np.unique(np.concatenate([a[:900], rng.integers(0, 1 << 63, 100, dtype=np.uint64)]))
    x, y = (np.frombuffer(near_dup.signature(s), np.uint32) for s in (a, b))
    assert abs((x == y).mean() - 900 / 1100) < 0.15


def test_keep_one(spark):
    rows = [(3, "a b c d e f"), (1, "a b c d e f"), (1, "a b c d e f"), (2, None), (5, "x y z")]
    docs = spark.createDataFrame([(*r, 7) for r in rows], "doc_id long, text string, kept int")
    out = near_dup.keep_one(docs)
    assert out.columns == docs.columns
    assert sorted(r.doc_id for r in out.collect()) == [1, 2, 5]


def test_keep_one_leaves_columns_of_any_name_alone(spark):
    """Names that the operator uses itself, and a very long text."""
    long = " ".join(f"w{i}" for i in range(30_000))
    names = ("key", "row", "_k", "_h", "comp", "text_hash", "_salt")
    rows = [(i, text, *(f"{n}{i}" for n in names)) for i, text in enumerate((long, long + " end", "p q r s t u", None))]
    docs = spark.createDataFrame(rows, ["doc_id", "text", *names])
    assert sorted(map(tuple, near_dup.keep_one(docs).collect())) == sorted(rows[:1] + rows[2:])


def test_keep_one_at_its_threshold(spark):
    """Similarities of 0.8 and a little less, of sets that share their first words."""
    words = [f"w{i}" for i in range(104)]
    at = words[:84] + [f"x{i}" for i in range(10)]  # 80 of 100 + 90 - 80 shingles
    more = words[:99]  # 95 of 100
    docs = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(at)), (3, " ".join(more))], "doc_id long, text string")
    sets = [set(zip(*(t[k:] for k in range(5)))) for t in (words, at, more)]
    assert len(sets[0] & sets[1]) / len(sets[0] | sets[1]) < 0.8
    assert sorted(r.doc_id for r in near_dup.keep_one(docs).collect()) == [1, 2]
    assert sorted(r.doc_id for r in near_dup.keep_one(docs, 70).collect()) == [1]


def test_rules_follow_from_the_threshold():
    assert (near_dup.Rules(85).agree, near_dup.Rules(85).trees) == (88, 6)
    assert near_dup.Rules(80).trees > 6 and near_dup.Rules(80).agree < 88
    for percent in (80, 85):
        flat = [t for trees in near_dup.Rules(percent).rounds() for t in trees]
        assert flat == list(range(near_dup.Rules(percent).trees))


def test_a_large_group_makes_rows_in_proportion(spark, tmp_path, monkeypatch):
    """Rows that are held in nodes grow with a group of near copies, not with its square; later trees pass it over."""
    seen = []
    held = near_dup._Search.held

    def counting(self, rows, last):
        out = held(self, rows, last)
        seen.append(0 if out is None else out.count())
        return out

    monkeypatch.setattr(near_dup._Search, "held", counting)
    monkeypatch.setattr(near_dup, "SMALL", 16)
    base = [f"t{i}" for i in range(300)]
    rows = [(i, " ".join([*base[: i % 290], f"n{i}", *base[i % 290 + 1 :]])) for i in range(400)]
    assert run(spark, tmp_path, rows) == brute(rows)
    assert seen[0] <= 2 * 400 and sum(seen[1:]) <= 4 * 400


def test_many_nodes_and_hot_keys(spark, tmp_path, monkeypatch):
    """The ways for more nodes than may be broadcast, and for many pairs, give the same."""
    from sievewright.operators import joins

    monkeypatch.setattr(near_dup, "FEW", 0)
    monkeypatch.setattr(near_dup, "EDGES", 0)
    monkeypatch.setattr(near_dup, "SMALL", 8)
    monkeypatch.setattr(joins, "MOST", 4)
    rows = corpus(9, 60)
    base = [f"t{i}" for i in range(200)]
    rows += [(1000 + i, " ".join([*base[:i], f"n{i}", *base[i + 1 :]])) for i in range(30)]
    assert run(spark, tmp_path, rows) == brute(rows)
