import json

import pytest

from sievewright.config import Settings
from sievewright.plans import pipeline


def item(k, output, task="요약"):
    return {"instruction": f"{k}번 문서를 요약하시오", "input": f"안녕하세요. 긴 본문 {k} " + "내용 " * 20, "output": output, "task": task}


@pytest.fixture
def settings(tmp_path):
    items = [item(1, "결과는 이러합니다 010-1234-5678"), item(1, "결과는 이러합니다 010-1234-5678"), item(2, "예"), item(3, "예", "분류"), item(4, "둘 셋 넷")]
    for split in ("train", "val"):
        (tmp_path / split).mkdir()
        (tmp_path / split / "a.json").write_text(json.dumps([{"source": "s", "instructions": [{"tuning_type": "요약", "data": items}]}], ensure_ascii=False), encoding="utf-8")
    (tmp_path / "val" / "a.json").rename(tmp_path / "val.json")
    return Settings(str(tmp_path / "train"), str(tmp_path / "val"), str(tmp_path / "out"), str(tmp_path / "reports"), log_file=None)


def test_both_splits(spark, settings, tmp_path):
    assert pipeline.run_pipeline(spark, settings) == {"train": 3, "val": 0}
    out = json.loads((tmp_path / "out" / "train.json").read_text(encoding="utf-8"))
    assert [r["output"] for r in out] == ["결과는 이러합니다 010-1234-5678", "둘 셋 넷", "예"]
    assert out[0]["input"].startswith("긴 본문 1") and out[0]["source"] == "s" and out[2]["task"] == "분류"
    report = json.loads((tmp_path / "reports" / "filter_report_train.json").read_text(encoding="utf-8"))
    assert report == {"total_input": 5, "total_output": 4, "drop_reasons": {"output_too_short(default)": 1}}
    assert json.loads((tmp_path / "reports" / "eda_train_01_raw.json").read_text(encoding="utf-8"))["total_records"] == 5
    assert json.loads((tmp_path / "reports" / "eda_train_02_processed.json").read_text(encoding="utf-8"))["total_records"] == 3
    assert list((tmp_path / "reports" / "pii_report_train").glob("part-*"))
    assert pipeline.convert_splits(spark, str(tmp_path / "out"), {"train.json": "train_con.json"})["train.json"]["converted"] == 3


def test_masking_and_lines(spark, settings, tmp_path):
    given = Settings.of({"train_dir": settings.train_dir, "val_dir": settings.val_dir, "output_dir": settings.output_dir, "report_dir": settings.report_dir, "log_file": None, "personal_data": {"action": "mask"}, "output": {"format": "jsonl", "metadata": False}})
    assert pipeline.run_pipeline(spark, given)["train"] == 3
    lines = [json.loads(x) for f in sorted((tmp_path / "out" / "train.jsonl").glob("part-*")) for x in f.read_text(encoding="utf-8").splitlines()]
    assert lines[0] == {**lines[0], "output": "결과는 이러합니다 [PII]"} and set(lines[0]) == {"instruction", "input", "output"}


def test_settings_are_checked():
    with pytest.raises(ValueError, match="unknown"):
        Settings.of({"outputs": 1})
    with pytest.raises(ValueError, match="format"):
        Settings.of({"output": {"format": "csv"}})


@pytest.mark.parametrize("action, tables", [("flag", 1), ("drop", 1), ("mask", 2)])
def test_texts_are_written_once(spark, monkeypatch, action, tables):
    """Cleaned texts are written a second time only where masking changes them, and all actions judge what they keep."""
    from sievewright.config import PersonalData, Quality, Settings
    from sievewright.operators import cleaning, filtering, personal_data
    from sievewright.plans.records import records

    names, written = [], pipeline.written
    monkeypatch.setattr(pipeline, "written", lambda df, name: names.append(name) or written(df, name))
    rows_, settings = records(spark, "/root/testdata/sf0.001").limit(60), Settings(personal_data=PersonalData(action=action))
    result = pipeline.prepare(rows_, settings)
    assert len(names) == tables
    found = personal_data.with_findings(cleaning.clean_records(rows_, settings.cleaning), settings.personal_data)
    want = filtering.with_reason(personal_data.act(found, settings.personal_data), Quality())
    assert sorted(result.judged.columns) == sorted(want.columns) and result.findings.columns == found.columns
    key = ["seq", "input", "output", "drop_reason"]
    assert sorted(map(str, result.judged.select(key).collect())) == sorted(map(str, want.select(key).collect()))
