from sievewright.operators import profiling

COLUMNS = "seq long, instruction string, input string, output string, task string, task_category string, source string, consulting_category string"


def rows(lengths):
    return [(i, "x" * n, "a b", "", "t" if i % 2 else "u", "", "s", None) for i, n in enumerate(lengths)]


def test_sizes(spark):
    found = profiling.profile(spark.createDataFrame(rows([1, 2, 3, 4]), COLUMNS), "raw")
    assert found["field_stats"]["instruction"]["char_len"] == {"min": 1, "max": 4, "mean": 2.5, "median": 3}
    assert found["field_stats"]["input"]["word_count"] == {"min": 2, "max": 2, "mean": 2.0, "median": 2}
    assert found["total_records"] == 4 and found["field_stats"]["output"]["empty_ratio"] == 1.0
    assert list(found["task_distribution"].items()) == [("u", 2), ("t", 2)]
    assert found["category_distribution"] == {"": 4}
    assert "4 records" in profiling.summary(found)


def test_empty_share(spark):
    stats = profiling.profile(spark.createDataFrame(rows([0, 10, 20]), COLUMNS), "x")["field_stats"]["instruction"]
    assert (stats["empty_count"], stats["empty_ratio"], stats["char_len"]["median"]) == (1, 0.3333, 10)


def test_no_rows(spark):
    found = profiling.profile(spark.createDataFrame([], COLUMNS), "x")
    assert found["field_stats"] == {} and found["total_records"] == 0 and found["task_distribution"] == {}


def test_one_histogram_in_order_of_appearance(spark):
    df = spark.createDataFrame(rows([1, 1, 1]), COLUMNS)
    assert [tuple(r) for r in profiling.histogram(df, "task").collect()] == [("u", 2), ("t", 1)]
