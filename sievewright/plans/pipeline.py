"""The whole preparation of a split, of both splits, and the chat conversion."""

from __future__ import annotations

import argparse
import json
import logging
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from ..config import Settings
from ..operators import cleaning, dedup, filtering, personal_data, profiling, rows
from ..sources import files, nested_json
from ..tables import written

log = logging.getLogger("sievewright")


def set_up_log(settings: Settings) -> None:
    """Console, and a file if one is named; calling it again adds nothing."""
    log.setLevel(settings.log_level)
    if not log.handlers:
        log.addHandler(logging.StreamHandler())
        if settings.log_file:
            log.addHandler(logging.FileHandler(settings.log_file, encoding="utf-8"))


@dataclass
class SplitResult:
    """What a split gives: the records kept, with _branch and seq as the output's order, and all findings."""

    kept: DataFrame
    judged: DataFrame
    findings: DataFrame


def prepare(records: DataFrame, settings: Settings) -> SplitResult:
    """clean, personal data, filter, de-duplicate. Cleaned and judged records are written, as several plans read them: as one table, unless masking changes the texts that are judged."""
    found = personal_data.with_findings(cleaning.clean_records(records, settings.cleaning), settings.personal_data)
    if settings.personal_data.action == "mask":
        found = written(found, "found")
        judged = written(filtering.with_reason(personal_data.act(found, settings.personal_data), settings.quality), "judged")
    else:
        both = written(filtering.with_reason(found, settings.quality), "judged")
        found, judged = both.drop("drop_reason"), personal_data.act(both, settings.personal_data)
    return SplitResult(dedup.routed(filtering.survivors(judged), settings.dedup), judged, found)


def run_split(spark: SparkSession, folder: str, split: str, settings: Settings) -> DataFrame | None:
    """One split from its folder to its files and reports; the instruction rows, or None if there are no files."""
    records, errors = nested_json.load(spark, folder)
    log.info("[%s] %d JSON files in %s", split, len(nested_json.json_files(spark, folder)), folder)
    if records is None:
        log.warning("[%s] no JSON files in %s", split, folder)
        return None
    for r in errors.collect():
        log.error("[%s] unreadable: %s", split, r.path)
    records = written(records, "records")
    report = lambda name: f"{settings.report_dir}/{name}.json"
    raw = profiling.profile(records, f"{split}_01_raw")
    files.write_report(raw, report(f"eda_{split}_01_raw"))
    log.info(profiling.summary(raw))
    result = prepare(records, settings)
    files.write_jsonl(personal_data.findings_report(result.findings), f"{settings.report_dir}/pii_report_{split}")
    for r in personal_data.type_counts(result.findings).collect():
        log.info("[%s] findings %s: %d", split, r.type, r["count"])
    filtered = filtering.report_values(result.judged)
    files.write_report(filtered, report(f"filter_report_{split}"))
    log.info("[%s] %s", split, filtered)
    kept = written(result.kept, "kept")
    done = profiling.profile(kept, f"{split}_02_processed")
    files.write_report(done, report(f"eda_{split}_02_processed"))
    log.info(profiling.summary(done))
    out = kept.select("_branch", "seq", *rows.instruction_rows(kept, settings.output.metadata).columns)
    if settings.output.format == "jsonl":
        files.write_jsonl(out.orderBy("_branch", "seq").drop("_branch", "seq"), f"{settings.output_dir}/{split}.jsonl")
    else:
        files.write_json_array(out, f"{settings.output_dir}/{split}.json", ["_branch", "seq"])
    return out


def run_pipeline(spark: SparkSession, settings: Settings | None = None) -> dict[str, int]:
    """Both splits, one after the other, never mixed; the rows of each (0 if it has no files)."""
    settings = settings or Settings()
    set_up_log(settings)
    counts = {}
    for split, folder in (("train", settings.train_dir), ("val", settings.val_dir)):
        out = run_split(spark, folder, split, settings)
        counts[split] = out.count() if out is not None else 0
    log.info("rows: %s, together %d", counts, sum(counts.values()))
    return counts


def convert_to_chat(spark: SparkSession, source: str, target: str, one_file: bool = True) -> dict[str, int]:
    """Chat rows of a file of instruction rows; how many there were, were converted and skipped."""
    found = files.read_instruction_rows(spark, source)
    counts = rows.chat_counts(found).first().asDict()
    files.write_jsonl(rows.chat_rows(found.orderBy("pos")), target, one_file)
    log.info("%s: %s", source, counts)
    return counts


def convert_splits(spark: SparkSession, base: str, names: dict[str, str] | None = None) -> dict[str, dict[str, int]]:
    """Both splits' instruction rows under base as chat rows."""
    names = names or {"train.json": "train_con.json", "val.json": "valid_con.json"}
    return {source: convert_to_chat(spark, f"{base}/{source}", f"{base}/{target}") for source, target in names.items()}


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Prepare instruction corpora.")
    parser.add_argument("--config", help="a JSON file of settings")
    parser.add_argument("--chat", action="store_true", help="convert the output to chat rows too")
    given = parser.parse_args(arguments)
    settings = Settings.of(json.loads(Path(given.config).read_text(encoding="utf-8"))) if given.config else Settings()
    spark = SparkSession.builder.appName("sievewright").getOrCreate()
    run_pipeline(spark, settings)
    if given.chat:
        convert_splits(spark, settings.output_dir)


if __name__ == "__main__":
    main()
