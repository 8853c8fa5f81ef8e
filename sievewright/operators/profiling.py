"""Profiles: row counts, value histograms, lengths and words of the text fields."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import word_count

FIELDS = ("instruction", "input", "output")
CATEGORIES = {"task": "task_distribution", "task_category": "task_category_distribution", "source": "source_distribution", "consulting_category": "category_distribution"}


def histograms(records: DataFrame) -> DataFrame:
    """field, value, n and first (where the value first stands), of all category fields in one pass."""
    pairs = F.explode(F.array(*(F.struct(F.lit(c).alias("field"), F.coalesce(F.col(c), F.lit("")).alias("value")) for c in CATEGORIES)))
    return records.select("seq", pairs.alias("p")).groupBy("p.field", "p.value").agg(F.count(F.lit(1)).alias("n"), F.min("seq").alias("first"))


def histogram(records: DataFrame, column: str) -> DataFrame:
    """value and n of one category, in the order of first appearance."""
    return records.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"), F.min("seq").alias("first")).orderBy("first").select("value", "n")


def _sizes(name: str) -> dict:
    text = F.coalesce(F.col(name), F.lit(""))
    return {"char": F.length(text), "word": word_count(text)}


def field_stats(records: DataFrame) -> DataFrame:
    """One row for each text field: count, empty_count, and least, largest, sum and upper median of characters and words."""
    sizes = F.explode(F.array(*(F.struct(F.lit(c).alias("field"), *(x.alias(k) for k, x in _sizes(c).items())) for c in FIELDS)))
    rows = records.select(sizes.alias("s")).select("s.*")
    upper = lambda c: F.expr(f"percentile_disc(0.5) WITHIN GROUP (ORDER BY {c} DESC)")
    found = [F.count(F.lit(1)).alias("count"), F.count_if(F.col("char") == 0).alias("empty_count")]
    for c in ("char", "word"):
        found += [F.min(c).alias(f"{c}_min"), F.max(c).alias(f"{c}_max"), F.sum(c).alias(f"{c}_sum"), upper(c).alias(f"{c}_median")]
    return rows.groupBy("field").agg(*found)


def profile(records: DataFrame, stage: str) -> dict:
    """The profile as one dict; rounding is done here, half to even on the binary value."""
    out: dict = {"stage": stage, "timestamp": datetime.now().isoformat(), "total_records": 0, "field_stats": {}}
    for r in field_stats(records).collect():
        out["total_records"] = r["count"]
        size = lambda c, r=r: {"min": r[f"{c}_min"], "max": r[f"{c}_max"], "mean": round(r[f"{c}_sum"] / r["count"], 1), "median": r[f"{c}_median"]}
        out["field_stats"][r.field] = {"count": r["count"], "empty_count": r.empty_count, "empty_ratio": round(r.empty_count / r["count"], 4), "char_len": size("char"), "word_count": size("word")}
    out["field_stats"] = {c: out["field_stats"][c] for c in FIELDS if c in out["field_stats"]}
    values = histograms(records).orderBy("field", "first").collect()
    for column, name in CATEGORIES.items():
        out[name] = {r.value: r.n for r in values if r.field == column}
    return out


def summary(found: dict) -> str:
    """A profile in a few lines, for the log."""
    lines = [f"[{found['stage']}] {found['total_records']} records"]
    for name, s in found["field_stats"].items():
        lines.append(f"  {name}: {s['empty_count']} empty, characters {s['char_len']['min']}-{s['char_len']['max']} (mean {s['char_len']['mean']}, median {s['char_len']['median']}), words mean {s['word_count']['mean']}")
    lines += [f"  {value or '(none)'}: {n}" for value, n in found["task_distribution"].items()]
    return "\n".join(lines)
