"""Instruction rows and chat rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import SYSTEM_PROMPT
from ..functions.text import strip

METADATA = ("task", "task_category", "source", "consulting_category")


def instruction_rows(records: DataFrame, metadata: bool = True) -> DataFrame:
    """instruction, input and output, with the metadata if asked for."""
    return records.select("instruction", "input", "output", *(METADATA if metadata else ()))


def _stripped(rows: DataFrame) -> dict:
    return {c: strip(F.col(c).cast("string")) for c in ("instruction", "input", "output")}


def _usable(rows: DataFrame):
    parts = _stripped(rows).values()
    ok = F.lit(True)
    for p in parts:
        ok = ok & F.coalesce(p != "", F.lit(False))
    return ok


def chat_rows(rows: DataFrame, system: str = SYSTEM_PROMPT) -> DataFrame:
    """messages (system, user, assistant) of rows whose three fields say anything; a null field is a blank one."""
    x = _stripped(rows)
    user = F.concat(F.lit("지시: "), x["instruction"], F.lit("\n\n입력:\n"), x["input"])
    message = lambda role, content: F.struct(F.lit(role).alias("role"), content.alias("content"))
    return rows.where(_usable(rows)).select(F.array(message("system", F.lit(system)), message("user", user), message("assistant", x["output"])).alias("messages"))


def chat_counts(rows: DataFrame) -> DataFrame:
    """total, converted and skipped rows."""
    ok = _usable(rows)
    return rows.agg(F.count(F.lit(1)).alias("total"), F.count_if(ok).alias("converted"), F.count_if(~ok).alias("skipped"))
