import random
import zlib

import numpy as np
import pytest

from sievewright.llm import toxicity


def slow_subwords(word: bytes) -> set:
    w = b"<" + word + b">"
    return {w[i : i + n] for n in range(toxicity.SHORTEST, toxicity.LONGEST + 1) for i in range(len(w) - n + 1)}


def test_subwords_of_a_word_do_not_depend_on_its_neighbours():
    words = [b"abc", b"", b"x", b"longer-word", "éé".encode(), b"abc"]
    of, rows = toxicity.subwords(words)
    for k, w in enumerate(words):
        alone = toxicity.subwords([w])[1]
        assert sorted(rows[of == k]) == sorted(alone)
        n = len(w) + 2
        assert len(alone) == 1 + sum(max(0, n - size + 1) for size in range(toxicity.SHORTEST, toxicity.LONGEST + 1))


def corpus(n, seed=0):
    rng = random.Random(seed)
    syllables = ["an", "be", "cor", "du", "el", "fi", "gra", "ho", "in", "ju", "ka", "lo"]
    word = lambda: "".join(rng.choices(syllables, k=rng.randint(1, 4)))
    bad = ["zgrumpf", "xvetch", "qwerk"]
    rows, labels = [], []
    for i in range(n):
        w = [word() for _ in range(rng.randint(5, 200))]
        toxic = int(rng.random() < 0.3)
        for _ in range(toxic * rng.randint(1, 3 + len(w) // 40)):
            x = rng.choice(bad)
            w[rng.randrange(len(w))] = x + rng.choice(["", "s", "ed", "!", rng.choice(syllables)])
        rows.append((i, " ".join(w), 0.5))
        labels.append((i, toxic))
    return rows, labels


@pytest.fixture(scope="module")
def scored(spark, tmp_path_factory):
    rows, labels = corpus(1500)
    rows += [(5001, None, 1.0), (5002, "", 1.0), (None, "an be cor", 1.0), (5003, "an be " * 30_000, 1.0), (3, rows[3][1], 0.5)]
    path = tmp_path_factory.mktemp("tox")
    spark.createDataFrame(rows, "doc_id long, text string, score double").write.parquet(f"{path}/documents.parquet")
    extra = [(7, None), (None, 1), (999_999, 1), (9, 0), (9, 0)]
    spark.createDataFrame(labels + extra, "doc_id long, toxic int").write.parquet(f"{path}/labels.parquet")
    return rows, dict(labels), toxicity.op3_toxicity(spark, str(path)).collect(), path


def test_held_out_rows_are_told_apart(scored):
    rows, labels, got, _ = scored
    assert len(got) == len(rows)
    held = [r for r in got if r.held_out and r.doc_id in labels]
    assert {r.doc_id for r in held} == {i for i in labels if zlib.crc32(str(i).encode()) % 5 == 0}
    right = np.mean([r.predicted == labels[r.doc_id] for r in held])
    assert right > 0.9
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    by = {}
    for r in got:
        by.setdefault(r.doc_id, set()).add(r.score)
    assert by[5001] == by[5002] and len(by[3]) == 1 and by[5003].pop() < 0.5


def test_unseen_misspellings(scored, spark):
    _, _, _, path = scored
    model = toxicity.train(spark.read.parquet(f"{path}/documents.parquet"), spark.read.parquet(f"{path}/labels.parquet"))
    new, clean = model.scorer()([b"an be cor du zgrumpfkalo", b"an be cor du kalohofi"])
    assert new > 0.5 > clean


def test_training_ignores_the_held_out_fold(spark):
    rows, labels = corpus(120, seed=4)
    docs = spark.createDataFrame(rows, "doc_id long, text string, score double")
    model = toxicity.train(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    turned = [(i, 1 - y if zlib.crc32(str(i).encode()) % 5 == 0 else y) for i, y in labels]
    other = toxicity.train(docs, spark.createDataFrame(turned, "doc_id long, toxic int"))
    assert (model.weight == other.weight).all() and model.bias == other.bias


def test_no_labels_and_no_rows(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    got = toxicity.score(docs, toxicity.train(docs, none)).collect()
    assert len(got) == 1 and 0 <= got[0].score <= 1
    assert toxicity.score(docs.limit(0), toxicity.train(docs.limit(0), none)).collect() == []


def test_reject_keeps_columns_and_clean_rows(spark, scored):
    rows, labels, _, path = scored
    docs = spark.read.parquet(f"{path}/documents.parquet")
    model = toxicity.train(docs, spark.read.parquet(f"{path}/labels.parquet"))
    out = toxicity.reject(docs, model)
    assert out.columns == docs.columns
    flagged = toxicity.score(docs, model).where("predicted = 1").count()
    assert out.count() == len(rows) - flagged and flagged > 100


def test_memo_is_bounded(monkeypatch):
    model = toxicity.Model(np.random.default_rng(0).normal(size=1 << toxicity.TABLE_BITS).astype(np.float32), -1.0)
    whole = model.scorer()([b"a b c", b"d e f", b"a"])
    monkeypatch.setattr(toxicity, "MEMO_WORDS", 2)
    score = model.scorer()
    assert [score([t])[0] for t in (b"a b c", b"d e f", b"a")] == pytest.approx(whole)
