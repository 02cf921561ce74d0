"""The profile of a file of training rows."""

from __future__ import annotations

from pyspark.sql import SparkSession

from ..operators.chat_rows import check_rows, profile
from ..sources.json_lines import read_lines


def profile_file(spark: SparkSession, path: str, max_rows: int | None = None) -> dict:
    """Counts, average lengths and histograms of the first max_rows lines (all without it)."""
    return {"file": path} | profile(check_rows(read_lines(spark, path, max_rows))).first().asDict(True)
