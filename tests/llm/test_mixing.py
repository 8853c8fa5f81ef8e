import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from sievewright.llm import mixing


def targets(sizes: dict, share=1.5, most=2):
    """Sharing out again and again, as the contract says it."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(names)}
    total, got, open_ = share * sum(sizes.values()), dict.fromkeys(names, 0.0), set(names)
    while open_:
        rest = total - sum(most * sizes[s] for s in names if s not in open_)
        got = {s: rest * weight[s] / sum(weight[x] for x in open_) if s in open_ else most * sizes[s] for s in names}
        above = {s for s in open_ if got[s] > most * sizes[s] * (1 + 1e-12)}
        if not above:
            return got
        open_ -= above
    return {s: most * sizes[s] for s in names}


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def check(rows, got):
    """rows: (doc_id, text, source)."""
    assert len(got) == len(rows)
    sizes = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + words(text)
    want = targets(sizes)
    largest, taken = {}, {}
    for r in got:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(want[r.source], rel=1e-9, abs=1e-6)
        assert 0 <= r.taken <= 2 * r.size
        largest[r.source] = max(largest.get(r.source, 0), r.size)
        taken[r.source] = taken.get(r.source, 0) + r.taken
    for s in sizes:
        assert abs(taken[s] - want[s]) <= largest[s] + 1e-6
    assert sorted((r.doc_id is None, r.doc_id or 0, r.size) for r in got) == sorted((d is None, d or 0, words(t)) for d, t, _ in rows)


def run(spark, tmp_path, rows, partitions=3):
    spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(partitions).write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
    return mixing.op1_mixing(spark, str(tmp_path)).collect()


def test_sources_of_many_sizes(spark, tmp_path):
    rng = np.random.default_rng(0)
    rows = [(i, " ".join(["w"] * int(rng.integers(0, 60))), f"s{min(int(rng.exponential(2)), 6)}") for i in range(1500)]
    got = run(spark, tmp_path, rows)
    check(rows, got)
    again = run(spark, tmp_path, rows[::-1], 7)
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))


def test_awkward_rows(spark, tmp_path):
    rows = [(1, None, "a"), (2, "", "a"), (None, "x y", None), (None, "x y", None), (3, "one  two\tthree", "b"), *[(7, "a b c", "c")] * 5, (8, "w " * 50_000, "é"), (9, " ", "z")]
    check(rows, run(spark, tmp_path, rows))


def test_no_rows_and_no_words(spark, tmp_path):
    assert run(spark, tmp_path, []) == []
    check([(1, "", "a"), (2, None, None)], run(spark, tmp_path, [(1, "", "a"), (2, None, None)]))


def test_runs_of_equal_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(mixing, "RUN", 4)
    rows = [(1, "a b", "s")] * 23 + [(i, "a b c", "t") for i in range(2, 40)]
    check(rows, run(spark, tmp_path, rows))


def test_expected_copies_hold(spark, monkeypatch):
    """Over many seeds, each row's mean copies is its rate."""
    rows = [(i, "s", int(1 + i % 7)) for i in range(12)] + [(100, "t", 40)]
    total = np.zeros(12)
    for seed in range(25):
        monkeypatch.setattr(mixing, "SEED", seed)
        got = mixing.mix_plan(spark.createDataFrame(rows, "doc_id long, source string, size long")).where("source = 's'").collect()
        for r in got:
            total[r.doc_id] += r.copies
    rate = got[0].target / got[0].source_size
    assert abs(total.mean() / 25 - rate) < 0.15
    assert (total / 25 <= 2).all()


def test_mix_keeps_columns(spark):
    docs = spark.createDataFrame([(i % 50, "w " * (i % 9), "ab"[i % 2], i) for i in range(200)], "doc_id long, text string, source string, size long")
    out = mixing.mix(docs)
    assert out.columns == docs.columns
    plan = mixing.mix_plan(docs.select("doc_id", "source", mixing.word_count().alias("size")))
    assert out.count() == plan.agg(F.sum("copies")).first()[0]
