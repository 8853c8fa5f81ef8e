"""Personal data of records: findings, the three actions and the reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import PersonalData
from ..functions import pii

FIELDS = ("instruction", "input", "output")
FLAGS = "_pii_flags"


def record_findings(rules: PersonalData, place: str = "seq") -> Column:
    """All findings of a record, field after field, each with the record's place and its field."""

    def placed(name: str) -> Column:
        found = pii.findings(F.coalesce(F.col(name), F.lit("")), rules)
        return F.transform(found, lambda f: F.struct(f["type"].alias("type"), f["match"].alias("match"), f["span"].alias("span"), F.col(place).cast("long").alias("record_idx"), F.lit(name).alias("field")))

    return F.concat(*map(placed, FIELDS))


def with_findings(records: DataFrame, rules: PersonalData = PersonalData(), place: str = "seq") -> DataFrame:
    """records with an array of findings; the one column that the actions and reports read."""
    return records.withColumn("_findings", record_findings(rules, place))


def act(found: DataFrame, rules: PersonalData = PersonalData()) -> DataFrame:
    """What becomes of records with findings (as with_findings() gives them): noted, masked or dropped."""
    if rules.action == "drop":
        return found.where(F.size("_findings") == 0).drop("_findings")
    if rules.action == "mask":
        own = lambda name: F.filter("_findings", lambda f: f["field"] == name)
        return found.withColumns({n: pii.masked(F.col(n), own(n), rules.token) for n in FIELDS}).drop("_findings")
    return found.withColumn(FLAGS, F.when(F.size("_findings") > 0, F.col("_findings"))).drop("_findings")


def findings_report(found: DataFrame) -> DataFrame:
    """One row a finding, of all records, dropped ones too.

    The outer form keeps Spark from testing the array's size below the generator, which would derive the findings again.
    """
    return found.select(F.explode_outer("_findings").alias("f")).where("f IS NOT NULL").select("f.*")


def type_counts(found: DataFrame) -> DataFrame:
    """type and count, most frequent first."""
    return findings_report(found).groupBy("type").count().orderBy(F.desc("count"), "type")


def flagged_count(found: DataFrame) -> DataFrame:
    """How many records there are, and how many with findings."""
    return found.agg(F.count(F.lit(1)).alias("records"), F.count_if(F.size("_findings") > 0).alias("flagged"))
