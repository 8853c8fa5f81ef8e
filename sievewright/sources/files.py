"""Instruction rows, chat rows and reports in files."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ROW = "instruction string, input string, output string"


def read_parquet(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def read_instruction_rows(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a JSON array. A missing file and a root that is no list are errors."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at):
        raise FileNotFoundError(path)
    raw = spark.read.text(path, wholetext=True)
    parsed = raw.select(F.parse_json("value").alias("j"))
    if not parsed.where("schema_of_variant(j) NOT LIKE 'ARRAY%'").isEmpty():
        raise ValueError(f"{path}: the root must be a list")
    names = [c.split()[0] for c in ROW.split(", ")]
    picked = ", ".join(f"r.value:{n}::string AS {n}" for n in names)
    return spark.sql(f"SELECT r.pos AS pos, {picked} FROM {{parsed}}, LATERAL variant_explode(j) AS r", parsed=parsed)


def write_json_array(rows: DataFrame, path: str, order: list[str]) -> int:
    """One JSON array on the driver's disk, indented, in order; rows pass through the driver one partition at a time."""
    columns = [c for c in rows.columns if c not in order]
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    n = 0
    with open(path, "w", encoding="utf-8") as f:
        f.write("[")
        for row in rows.orderBy(*order).toLocalIterator():
            text = json.dumps({c: row[c] for c in columns}, ensure_ascii=False, indent=2)
            f.write(("," if n else "") + "\n  " + text.replace("\n", "\n  "))
            n += 1
        f.write("\n]" if n else "]")
    return n


def write_jsonl(rows: DataFrame, path: str, one_file: bool = False) -> None:
    """A row a line, by the executors; one_file is for small results."""
    (rows.coalesce(1) if one_file else rows).write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def write_parquet(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").parquet(path)


def write_report(report: dict, path: str) -> None:
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    Path(path).write_text(json.dumps(report, ensure_ascii=False, indent=2), encoding="utf-8")
