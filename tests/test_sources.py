import json

import pytest

from sievewright.operators import rows
from sievewright.plans import pipeline, registry
from sievewright.sources import files, nested_json


def put(folder, name, value):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(value if isinstance(value, bytes) else json.dumps(value, ensure_ascii=False).encode())


ITEM = {"instruction": "i", "input": "x", "output": "o"}


def test_shapes_and_order(spark, tmp_path):
    put(tmp_path, "b.json", {"source": "s", "instructions": {"tuning_type": "요약", "data": ITEM}})
    put(tmp_path, "a/c.json", [{"instructions": [{"tuning_type": "요약", "data": [{**ITEM, "task": ""}, {**ITEM, "task": "분류", "output": 5}]}]}, {"source": "none"}])
    put(tmp_path, "a/_under.json", [{"consulting_content": "가 나", "consulting_category": "c", "instructions": [{"data": [{**ITEM, "task_category": "tc"}]}]}])
    put(tmp_path, "bad.json", b"{nope")
    put(tmp_path, "bytes.json", b'{"source": "\xff"}')
    put(tmp_path, ".hidden.json", [{"instructions": [{"data": [ITEM]}]}])
    put(tmp_path, "other.txt", b"{}")
    put(tmp_path, "twice.json", b'{"source": "a", "source": "b", "instructions": [{"data": [{"output": null}]}]}')
    put(tmp_path, "sp ace%.json", [1, {"instructions": 3}, {"instructions": [{"data": "x"}]}])
    loaded, errors = nested_json.load(spark, str(tmp_path))
    got = loaded.orderBy("seq").collect()
    assert [(r.seq, r.file_origin, r.task, r.output) for r in got] == [
        (0, "_under.json", "", "o"),
        (1, "c.json", "", "o"),
        (2, "c.json", "분류", "5"),
        (3, "b.json", "요약", "o"),
        (4, "twice.json", "", ""),
    ]
    assert (got[0].consulting_content, got[0].consulting_category, got[0].task_category) == ("가 나", "c", "tc")
    assert got[3].source == "s" and got[4].source == "b"
    assert sorted(r.path.rsplit("/", 1)[1] for r in errors.collect()) == ["bad.json", "bytes.json"]


def test_parts_of_a_file(spark):
    """A file's documents in several rows, in the order of part."""
    document = lambda *xs: json.dumps([{"source": "s", "instructions": {"tuning_type": "요약", "data": {**ITEM, "output": x}}} for x in xs])
    rows_ = [("/b.json", 0, document("e")), ("/a.json", 1, document("c", "d")), ("/a.json", 0, document("a", "b"))]
    files_ = spark.createDataFrame(rows_, "path string, part int, content string").selectExpr("path", "part", "parse_json(content) AS j")
    got = nested_json.flatten(files_).orderBy("seq").collect()
    assert [(r.seq, r.file_origin, r.output) for r in got] == [(0, "a.json", "a"), (1, "a.json", "b"), (2, "a.json", "c"), (3, "a.json", "d"), (4, "b.json", "e")]


def test_no_row_holds_a_file(spark, monkeypatch):
    """load_flatten's files grow with the input, their rows do not."""
    seen, written = [], registry.written
    monkeypatch.setattr(registry, "written", lambda df, *a, **b: seen.append(written(df, *a, **b)) or seen[-1])
    assert registry.QUERIES["load_flatten"](spark, "/root/testdata/sf0.01").count() == 1200
    sizes = seen[0].selectExpr("json_array_length(content) AS n").groupBy().agg({"n": "max"}).first()[0]
    assert sizes <= 16


def test_no_files(spark, tmp_path):
    loaded, errors = nested_json.load(spark, str(tmp_path / "missing"))
    assert loaded is None and errors.count() == 0


CHAT = [
    ({"instruction": " 요약해줘 ", "input": "본문", "output": "결과"}, ("지시: 요약해줘\n\n입력:\n본문", "결과")),
    ({"instruction": "a", "input": "b", "output": "  　"}, None),
    ({"instruction": "a", "output": "c"}, None),
    ({"instruction": "a", "input": "b", "output": None}, None),
    ({"instruction": "a", "input": 7, "output": "c"}, ("지시: a\n\n입력:\n7", "c")),
]


def test_chat_rows(spark, tmp_path):
    put(tmp_path, "rows.json", [r for r, _ in CHAT])
    counts = pipeline.convert_to_chat(spark, str(tmp_path / "rows.json"), str(tmp_path / "out"))
    assert counts == {"total": 5, "converted": 2, "skipped": 3}
    lines = [json.loads(x) for f in sorted((tmp_path / "out").glob("part-*")) for x in f.read_text(encoding="utf-8").splitlines()]
    assert [(m["messages"][1]["content"], m["messages"][2]["content"]) for m in lines] == [w for _, w in CHAT if w]
    assert [m["role"] for m in lines[0]["messages"]] == ["system", "user", "assistant"] and list(lines[0]) == ["messages"]


def test_chat_errors(spark, tmp_path):
    put(tmp_path, "root.json", {"instruction": "a"})
    with pytest.raises(ValueError, match="list"):
        files.read_instruction_rows(spark, str(tmp_path / "root.json"))
    with pytest.raises(FileNotFoundError):
        files.read_instruction_rows(spark, str(tmp_path / "none.json"))


def test_json_array(spark, tmp_path):
    df = spark.createDataFrame([(1, "b", "나"), (0, "a", None)], "seq long, x string, y string")
    assert files.write_json_array(df, str(tmp_path / "d" / "a.json"), ["seq"]) == 2
    assert (tmp_path / "d" / "a.json").read_text(encoding="utf-8") == json.dumps([{"x": "a", "y": None}, {"x": "b", "y": "나"}], ensure_ascii=False, indent=2)
    files.write_json_array(df.limit(0), str(tmp_path / "e.json"), ["seq"])
    assert json.loads((tmp_path / "e.json").read_text()) == []


def test_instruction_rows(spark):
    df = spark.createDataFrame([("a", "b", "c", "t", "tc", "s", "cc", 1)], "instruction string, input string, output string, task string, task_category string, source string, consulting_category string, seq int")
    assert rows.instruction_rows(df).columns == ["instruction", "input", "output", "task", "task_category", "source", "consulting_category"]
    assert rows.instruction_rows(df, False).columns == ["instruction", "input", "output"]
