"""Training rows as a stream: the batch checks over files as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import stable_hash
from ..operators.chat_rows import check_rows


def stream_rows(spark: SparkSession, path: str, max_files: int = 64) -> DataFrame:
    """Checked rows of every JSON-lines file that arrives in a folder, with arrival time and content hash."""
    lines = spark.readStream.option("maxFilesPerTrigger", max_files).text(path).withColumn("arrived", F.current_timestamp())
    return check_rows(lines).withColumn("content_hash", stable_hash(F.col("assistant")))


def stream_first_rows(rows: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Good rows whose (hash, prompt) was not seen before within the delay; state older than it is dropped."""
    return rows.filter("not bad").withWatermark("arrived", delay).dropDuplicatesWithinWatermark(["content_hash", "user"])


__all__ = ["stream_first_rows", "stream_rows"]
