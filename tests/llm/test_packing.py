import itertools
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sievewright.llm import packing


@settings(deadline=None, max_examples=80)
@given(st.dictionaries(st.integers(0, 60), st.integers(1, 9), min_size=1, max_size=9), st.integers(1, 5))
def test_bounds_are_the_best(bins, buckets):
    lengths = np.array(sorted(bins))
    counts = np.array([bins[n] for n in lengths])

    def padding(bounds):
        return sum(c * (min(b for b in bounds if b >= n) - n) for n, c in zip(lengths, counts, strict=True))

    got = packing.best_bounds(lengths, counts, buckets)
    assert got == sorted(set(got)) and got[-1] == lengths[-1] and len(got) <= buckets
    best = min(padding([*chosen, lengths[-1]]) for k in range(min(buckets, len(lengths))) for chosen in itertools.combinations(lengths[:-1].tolist(), k))
    assert padding(got) == best


def run(spark, tmp_path, rows):
    spark.createDataFrame(rows, "doc_id long, text string, bucket int").write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
    return packing.op4_packing(spark, str(tmp_path)).collect()


def check(rows, got):
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted(((r.doc_id, r.n_tokens) for r in got), key=key) == sorted(((i, size(t)) for i, t, _ in rows), key=key)
    batches = {}
    for r in got:
        assert r.n_tokens <= r.bucket_length
        batches.setdefault((r.bucket, r.batch), []).append(r)
    by_bucket = {}
    for (bucket, batch), members in batches.items():
        length = members[0].bucket_length
        most = max(1, packing.BUDGET // max(1, length))
        assert {m.bucket_length for m in members} == {length}
        assert sorted(m.slot for m in members) == list(range(len(members))) and len(members) <= most
        by_bucket.setdefault(bucket, {})[batch] = len(members) == most
    for found in by_bucket.values():
        assert sorted(found) == list(range(len(found)))
        assert all(full for batch, full in found.items() if batch != len(found) - 1)


def test_batches(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(packing, "BUDGET", 200)
    monkeypatch.setattr(packing.pack, "__defaults__", (5, 200))
    rng = np.random.default_rng(0)
    rows = [(i, "w " * int(rng.integers(0, 90)), 1) for i in range(700)]
    got = run(spark, tmp_path, rows)
    check(rows, got)
    assert len({r.bucket for r in got}) == 5
    again = run(spark, tmp_path, rows[::-1])
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))


def test_awkward_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(packing, "RUN", 3)
    rows = [(1, None, 1), (2, "", 1), (None, "a b", 1), (None, "a b", 1), (3, "w " * 90_000, 1), *[(4, "x y z", 1)] * 11]
    check(rows, run(spark, tmp_path, rows))


def test_empty_table(spark, tmp_path):
    assert run(spark, tmp_path, []) == []


@pytest.mark.parametrize("n", [0, 5, 4096, 4097, 10_000, 1_000_003, 123_456_789])
def test_bins_are_narrow(spark, n):
    row = spark.range(1).select(packing.length_bin(packing.F.lit(n).cast("long")).alias("b")).first()
    assert row.b <= n and n - row.b <= n / packing.EXACT
