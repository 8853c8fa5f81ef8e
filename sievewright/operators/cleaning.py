"""Cleaning of records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import Cleaning
from ..functions import text

FIELDS = ("instruction", "input", "output", "consulting_content")


def clean_records(records: DataFrame, rules: Cleaning = Cleaning()) -> DataFrame:
    """records with their text fields (those that are there) cleaned; null becomes empty."""
    return records.withColumns({c: text.clean(F.coalesce(F.col(c), F.lit("")), rules) for c in FIELDS if c in records.columns})
