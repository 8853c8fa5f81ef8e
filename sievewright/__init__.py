"""Spark-first preparation of instruction-tuning corpora."""

__version__ = "0.1.0"
