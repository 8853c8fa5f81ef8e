import pytest
from pyspark.sql import functions as F

from sievewright.config import Quality
from sievewright.functions import quality
from sievewright.operators import filtering

I, X = "instruction", "x" * 20
VECTORS = [
    ((I, X, "", "요약"), "empty_field"),
    (("abcd", X, "out put", "요약"), "instruction_too_short"),
    ((I, "x" * 19, "out put", "요약"), "input_too_short"),
    ((I, X, "out put", "요약"), None),
    ((I, X, "예", "요약"), "output_too_short(default)"),
    ((I, X, "예", "질의응답"), None),
    ((I, X, "예", "분류"), None),
    ((I, "x" * 10000, "out put", "요약"), None),
    ((I, "x" * 10001, "out put", "요약"), "input_too_long"),
    ((I, X, "a " * 2500 + "b", "요약"), "output_too_long"),
    ((I, X, "가나다라마", "요약"), "output_too_few_words(default)"),
    ((I, X, "   ", "질의응답"), "output_too_few_words(qa)"),
    ((I, "same text as the output", "  same text as the output\n", "요약"), "input_equals_output"),
    ((I, X, "예. 예. 아니오.", "질의응답"), "output_too_repetitive"),
    ((I, X, "예. 아니오.", "질의응답"), None),
    ((I, X, "just one sentence here", "요약"), None),
]


@pytest.fixture
def judged(spark):
    rows = [(i, *r) for i, (r, _) in enumerate(VECTORS)]
    return filtering.with_reason(spark.createDataFrame(rows, "seq long, instruction string, input string, output string, task string"))


def test_first_reason(judged):
    assert [r.drop_reason for r in judged.orderBy("seq").collect()] == [w for _, w in VECTORS]


def test_reasons_partition_the_records(judged):
    report = filtering.report_values(judged)
    assert report["total_input"] == len(VECTORS)
    assert report["total_output"] == filtering.survivors(judged).count() == sum(w is None for _, w in VECTORS)
    assert report["total_input"] - report["total_output"] == sum(report["drop_reasons"].values())


def test_checks_can_be_left_out(spark):
    rows = [(0, I, X, "", "요약"), (1, I, X + "y z", X + "y z", "요약"), (2, I, X, "a. a. a.", "요약")]
    rules = Quality(drop_empty_fields=False, drop_input_equals_output=False, max_repetition=0, min_output=0, min_output_words=0, short_answer_tasks=())
    out = filtering.with_reason(spark.createDataFrame(rows, "seq long, instruction string, input string, output string, task string"), rules)
    assert [r.drop_reason for r in out.collect()] == [None, None, None]


@pytest.mark.parametrize("text, want", [("", 0.0), ("one", 0.0), ("a. b. a", 2 / 3), ("a!a?a\na", 1.0), (" . . ", 0.0), ("b. a. b. a. c", 0.4)])
def test_repetition(spark, text, want):
    assert spark.range(1).select(quality.repetition(F.lit(text)).alias("r")).first().r == pytest.approx(want)
