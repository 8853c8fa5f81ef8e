"""The stateless stages on streams, and exact de-duplication by arrival.

Cleaning, personal data and the quality filter look at one record at a time, so
the batch operators run unchanged. Exact copies are told by their key's hash within
a watermark: the first to arrive stays, which need not be the first by seq.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import Settings
from ..operators import cleaning, dedup, filtering, personal_data, rows


def prepared(records: DataFrame, settings: Settings | None = None) -> DataFrame:
    """A stream of records, cleaned, treated for personal data and filtered."""
    settings = settings or Settings()
    found = personal_data.with_findings(cleaning.clean_records(records, settings.cleaning), settings.personal_data)
    return filtering.survivors(filtering.with_reason(personal_data.act(found, settings.personal_data), settings.quality))


def first_arrivals(records: DataFrame, time: str, delay: str, mode: str = "instruction_output") -> DataFrame:
    """The first record of each key; state is kept for as long as the watermark says."""
    keyed = records.withColumn("_key", F.sha2(dedup.key(mode), 256)).withWatermark(time, delay)
    return keyed.dropDuplicatesWithinWatermark(["_key"]).drop("_key")


def chat_stream(records: DataFrame) -> DataFrame:
    return rows.chat_rows(records)


def reason_counts(records: DataFrame, time: str, window: str, delay: str, settings: Settings | None = None) -> DataFrame:
    """How many records go for which reason, in windows of event time."""
    judged = filtering.with_reason(records, (settings or Settings()).quality).withWatermark(time, delay)
    return judged.groupBy(F.window(time, window), "drop_reason").count()
