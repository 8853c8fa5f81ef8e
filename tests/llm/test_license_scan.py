import re

import duckdb
import pytest

from sievewright.llm import license_scan as scan

ROWS = [
    (1, "Licensed under CC BY-NC 4.0.\nwords here", "x"),
    (2, None, "x"),
    (3, "", "x"),
    (4, "cc by cc by, CC\tBY all rights. Reserved ALL RIGHTS RESERVED", "x"),
    (5, "occ by cc bye ccby éall rights reserved", "x"),
    (6, "w " * 70 + "this work is licensed under the GNU general public license version 3 " + "z " * 300, "x"),
    (7, "Permission granted hereby, free of charge to any person obtaining a copy of this software", "x"),
    (8, "under the version 2 0", "x"),
    (9, "x\r\nLicensed under the Apache License 2.0\r\ny", "x"),
    (None, "cc by", "x"),
    (4, "cc by cc by, CC\tBY all rights. Reserved ALL RIGHTS RESERVED", "x"),
    (11, "License Kelvin K and İ " + "v " * 40_000 + "all rights reserved", "x"),
]


def brute(doc_id, text):
    text = text or ""
    low = text.translate(str.maketrans(scan.UPPER, scan.LOWER))
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    places, base = [], set()
    for phrase, label in scan.PHRASES.items():
        p = phrase.split()
        hits = [i for i in range(len(w)) if w[i : i + len(p)] == p]
        places += hits
        base |= {label} if hits else set()
    labels, best = set(base), 1.0 if places else 0.0
    wordings = {label: set(scan.tokens(wording)) for label, wording in scan.TEMPLATES.items()}
    for i in range(len(w)):
        block = set(w[i : i + scan.WINDOW])
        for label, t in wordings.items():
            share = len(t & block) / len(t)
            alike = [u for u in wordings.values() if u != t and len(t & u) / len(t) >= scan.THRESHOLD]
            if share >= scan.THRESHOLD and all(block & (t - u) for u in alike):
                labels.add(label)
                best = max(best, share)
    return (doc_id, len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)), ",".join(sorted(labels)), best)


def key(r):
    return tuple((x is not None, x) for x in r)


def run(spark, tmp_path, rows):
    spark.createDataFrame(rows, "doc_id long, text string, label string").write.parquet(f"{tmp_path}/documents.parquet")
    return sorted((tuple(r) for r in scan.op9_license_scan(spark, str(tmp_path)).collect()), key=key)


def test_against_brute_force(spark, tmp_path):
    got = run(spark, tmp_path, ROWS)
    want = sorted((brute(*r[:2]) for r in ROWS), key=key)
    assert got == want
    assert any("mit" in r[6] for r in got) and any("gpl-3" in r[6] for r in got)
    with duckdb.connect() as db:
        db.execute(f"create view documents as from '{tmp_path}/documents.parquet/*.parquet'")
        assert sorted((tuple(r) for r in db.execute(scan.oracle()).fetchall()), key=key) == want


def test_empty_table(spark, tmp_path):
    assert run(spark, tmp_path, []) == []


def test_any_order_gives_the_same_matches(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string, label string")
    order = scan.token_order(docs, scan.TEMPLATES)
    col = docs["text"]
    a, b = (docs.select(scan.template_matches(col, o, scan.TEMPLATES).alias("m")).collect() for o in (order, order[::-1]))
    assert [sorted(map(tuple, r.m or [])) for r in a] == [sorted(map(tuple, r.m or [])) for r in b]


@pytest.mark.parametrize("size", range(1, 40))
def test_need(size):
    need = scan._need(size)
    assert need / size >= scan.THRESHOLD - 1e-12 and (need - 1) / size < scan.THRESHOLD


def test_blocks_cross_line_ends_and_start_anywhere(spark):
    bsd = "Redistribution and use in source and binary forms, with or without\nmodification, are permitted"
    mpl = "This Source Code Form is subject to the terms of the Mozilla Public\r\n# License, v. 2.0."
    # Seven of eight tokens over 42 words from place 13 on: no window that starts at 0, 24, 48 ... holds them.
    far = "x " * 13 + "licensed under the apache license " + "x " * 35 + "version 2 " + "x " * 100
    apart = "x " * 13 + "licensed under the apache license " + "x " * 42 + "version 2 " + "x " * 100
    rows = [(1, bsd), (2, mpl), (3, far), (4, apart), (5, bsd.replace("\n", "\n" + "y " * 30))]
    got = {r.doc_id: r.labels for r in scan.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: "bsd", 2: "mpl-2.0", 3: "apache-2.0", 4: "", 5: "bsd"}


def labels_of(spark, text):
    return scan.scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).first().labels.split(",")


def test_alike_templates_are_told_apart(spark):
    """Expectations written by hand, not derived from the rule."""
    texts = ["Licensed under CC BY-NC 4.0", "Licensed under CC BY-SA 4.0", "x Licensed under CC BY-NC 4.0 and then " + "y " * 60 + "licensed under CC BY-SA 4.0"]
    want = ["cc-by,cc-by-nc", "cc-by,cc-by-sa", "cc-by,cc-by-nc,cc-by-sa"]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert [r.labels for r in scan.scan(rows).orderBy("doc_id").collect()] == want


def test_wrapped_notices_are_one_block(spark):
    text = "head\nRedistribution and use in source\nand binary forms, with or without\r\n * modification,\n * are permitted\ntail"
    assert labels_of(spark, text) == ["bsd"]


def test_long_templates_are_refused(spark):
    with pytest.raises(ValueError, match="long"):
        scan.scan(spark.createDataFrame([], "doc_id long, text string"), {"long": " ".join(f"w{i}" for i in range(60))})
