"""The quality filter and its report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import Quality
from ..functions.quality import drop_reason


def with_reason(records: DataFrame, rules: Quality = Quality()) -> DataFrame:
    return records.withColumn("drop_reason", drop_reason(rules))


def survivors(judged: DataFrame) -> DataFrame:
    return judged.where(F.col("drop_reason").isNull()).drop("drop_reason")


def report(judged: DataFrame) -> DataFrame:
    """drop_reason and n, most frequent first; the row without reason counts the survivors."""
    return judged.groupBy("drop_reason").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "drop_reason")


def report_values(judged: DataFrame) -> dict:
    """The report as one dict: total_input, total_output, drop_reasons."""
    counts = {r.drop_reason: r.n for r in report(judged).collect()}
    return {"total_input": sum(counts.values()), "total_output": counts.pop(None, 0), "drop_reasons": counts}
