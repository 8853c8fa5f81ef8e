"""Joins whose hot keys are dealt over several tasks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows of a key that one task takes; keys that are dealt anew at most. A key beyond the
#: HOT hottest holds less than one in HOT of all rows, so it is no hot spot.
MOST, HOT = 256, 4096


def hot_keys(rows: DataFrame, on: list[str], size: str | None = None) -> DataFrame:
    """The hottest keys, at most HOT, with _salts, the number of tasks that share each.

    rows: one row for each key with its number of rows in column size, or (size None) the rows themselves.
    """
    counted = rows.select(*on, F.col(size).alias("_n")) if size else rows.groupBy(*on).agg(F.count(F.lit(1)).alias("_n"))
    return counted.where(F.col("_n") > MOST).orderBy(F.desc("_n"), *on).limit(HOT).select(*on, F.ceil(F.col("_n") / MOST).cast("int").alias("_salts"))


def spread_join(rows: DataFrame, other: DataFrame, hot: DataFrame, on: list[str], by: list[str], how: str = "inner") -> DataFrame:
    """rows joined with other, which has one row a key (how: inner, left or left_semi).

    Rows of a hot key go to several tasks by a hash of the columns by, and other's row goes
    to each of them: a third of all rows under one key takes as many tasks as any third.
    hot, as hot_keys() gives it, has at most HOT rows, so it is broadcast.
    """
    few = F.broadcast(hot)
    salted = rows.join(few, on, "left").withColumn("_salt", F.coalesce(F.pmod(F.xxhash64(*by), F.col("_salts")).cast("int"), F.lit(0))).drop("_salts")
    copies = F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_salts") - 1, F.lit(0))))
    out = salted.join(other.join(few, on, "left").withColumn("_salt", copies).drop("_salts"), [*on, "_salt"], how)
    return out.drop("_salt")
