"""Quality checks as one Column: the first reason for which a record goes, else null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import Quality
from .text import bound, has_words, strip


def repetition(x: Column) -> Column:
    """The share of the commonest sentence among a text's sentences; 0 for none or one.

    Where all differ, the commonest stands once. Else they are sorted: equal sentences stand together, so one pass counts the longest run.
    """

    def step(state: Column, s: Column) -> Column:
        run = F.when(state["last"] == s, state["run"] + 1).otherwise(1)
        return F.struct(s.alias("last"), run.alias("run"), F.greatest(state["best"], run).alias("best"))

    def share(cut: Column) -> Column:
        start = F.struct(F.lit(None).cast("string").alias("last"), F.lit(0).alias("run"), F.lit(0).alias("best"))
        best = F.aggregate(F.array_sort(cut), start, step, lambda s: s["best"])
        most = F.when(F.size(F.array_distinct(cut)) == F.size(cut), 1).otherwise(best)
        return F.when(F.size(cut) > 1, most / F.size(cut)).otherwise(0.0)

    return bound(F.filter(F.transform(F.split(x, r"[.!?\n]"), strip), lambda s: s != ""), share)


def drop_reason(rules: Quality, instruction: str = "instruction", input_: str = "input", output: str = "output", task: str = "task") -> Column:
    """Limits themselves pass. Arms are evaluated in order, so costly checks see few rows."""
    a, b, c = F.col(instruction), F.col(input_), F.col(output)
    short = F.col(task).isin(*rules.short_answer_tasks) if rules.short_answer_tasks else F.lit(False)
    kind = F.when(short, "qa").otherwise("default")
    named = lambda reason: F.concat(F.lit(f"{reason}("), kind, F.lit(")"))
    checks: list[tuple[Column, Column]] = []
    if rules.drop_empty_fields:
        checks.append(((a == "") | (b == "") | (c == ""), F.lit("empty_field")))
    checks += [
        (F.length(a) < rules.min_instruction, F.lit("instruction_too_short")),
        (F.length(b) < rules.min_input, F.lit("input_too_short")),
        (F.length(c) < F.when(short, rules.short_min_output).otherwise(rules.min_output), named("output_too_short")),
        (F.length(b) > rules.max_input, F.lit("input_too_long")),
        (F.length(c) > rules.max_output, F.lit("output_too_long")),
        (~F.when(short, has_words(c, rules.short_min_output_words)).otherwise(has_words(c, rules.min_output_words)), named("output_too_few_words")),
    ]
    if rules.drop_input_equals_output:
        checks.append((strip(b) == strip(c), F.lit("input_equals_output")))
    if rules.max_repetition > 0:
        checks.append((repetition(c) > rules.max_repetition, F.lit("output_too_repetitive")))
    (first, reason), *rest = checks
    out = F.when(first, reason)
    for check, reason in rest:
        out = out.when(check, reason)
    return out.otherwise(F.lit(None).cast("string"))
