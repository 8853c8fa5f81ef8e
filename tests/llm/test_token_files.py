import zlib

import numpy as np
import public_tokenizers

from tokenizers import Tokenizer

from sievewright.llm import token_files

ROWS = [
    (5, "Hello, world! It's 2024", "a"),
    (1, None, "b"),
    (3, "", None),
    (2, "  tabs\tand\nlines　wide é é <|endoftext|> x<|startoftext|>y " * 40, "c"),
    (None, "no id", "d"),
    (4, "Ünïcode ΣΑΣ Σ İstanbul ﬁ can't we'll", "e"),
    (4, "Ünïcode ΣΑΣ Σ İstanbul ﬁ can't we'll", "e"),
    (9, "word " * 30000, "f"),
]


def brute(rows):
    model = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    at, out = 0, []
    for doc_id, text, *_ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*model.encode(text or "", add_special_tokens=False).ids, 1]
        out.append((doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


def run(spark, tmp_path, rows):
    spark.createDataFrame(rows, "doc_id long, text string, start string").write.parquet(f"{tmp_path}/documents.parquet")
    return sorted((tuple(r) for r in token_files.op7_token_files(spark, str(tmp_path)).collect()), key=lambda r: r[1])


def test_round_trip_of_awkward_rows(spark, tmp_path):
    assert run(spark, tmp_path, ROWS) == brute(ROWS)


def test_empty_table(spark, tmp_path):
    assert run(spark, tmp_path, []) == []


def test_whole_small_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    got = sorted((tuple(r) for r in token_files.op7_token_files(spark, "/root/testdata/sf0.001").collect()), key=lambda r: r[1])
    assert got == brute(rows)


def test_files_have_the_encodings(spark, tmp_path):
    import pyarrow.parquet as pq

    path = f"{tmp_path}/out"
    token_files.write_tokens(spark.createDataFrame(ROWS, "doc_id long, text string, x string"), path, public_tokenizers.path("word_bpe_49k.json"))
    files = sorted(tmp_path.glob("out/part-*"), key=lambda f: -f.stat().st_size)
    group = pq.ParquetFile(files[0]).metadata.row_group(0)
    columns = {group.column(i).path_in_schema: group.column(i) for i in range(group.num_columns)}
    assert "DELTA_BINARY_PACKED" in columns["doc_id"].encodings
    ids = next(c for name, c in columns.items() if name.startswith("ids"))
    assert any("DICTIONARY" in e for e in ids.encodings)
    assert columns["doc_id"].has_offset_index and columns["doc_id"].has_column_index


def test_long_memo_is_forgotten(monkeypatch):
    monkeypatch.setattr(token_files, "MEMO_WORDS", 3)
    of = token_files.Encoder(public_tokenizers.path("word_bpe_49k.json"))
    model = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    texts = ["a b c d e", "f g", "a b", ""]
    want = [np.array(model.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert of([t.encode() for t in texts]) == want



def test_pieces_of_letters():
    of = token_files.Encoder(public_tokenizers.path("word_bpe_49k.json"))
    model = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    texts = ["Straße, ÉCOLE. Ñandú ÿ Ÿ æther don't l'été x. , . a.b a,, ok.. ÀÉÎÕÜ÷× I İ ıs", "é e\u0301 ﬁn K Å Å. \u1e9e naïve, 123. 1a a1 ½ __init__ zzz###"]
    want = [np.array(model.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert of.letters is not None and of([t.encode() for t in texts]) == want
    of.letters = None
    of.memo.clear()
    assert of([t.encode() for t in texts]) == want


def test_an_id_that_fills_several_ranges(spark, tmp_path):
    rows = [(7, f"text {i}", "x") for i in range(300)] + [(i, "some", "x") for i in range(5, 12)] + [(None, "none", "x")] * 40
    got = run(spark, tmp_path, rows)
    texts = sorted(brute(rows), key=str)
    assert sorted((r[0], r[2], r[3]) for r in got if r[0] is not None) == sorted((r[0], r[2], r[3]) for r in texts if r[0] is not None)
    ids = [r[0] for r in got]
    assert ids == [None] * 40 + sorted(i for i in ids if i is not None)
    at = 0
    for _, start, n, _ in got:
        assert start == at
        at += n
