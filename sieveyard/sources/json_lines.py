"""JSON lines in and out, and small JSON files."""

from __future__ import annotations

import dataclasses
import json
import logging
import re
from collections.abc import Sequence
from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.chat import first_of, training_text

LOG = logging.getLogger(__name__)

MESSAGES = "array<struct<role string, content string>>"
#: Of the model-ready input: what its filters read; whole rows stay as text beside it.
MODEL_READY = f"messages {MESSAGES}, metadata struct<content_hash string, category string, difficulty string, extraction_diagnostics struct<missing_symbols array<string>>>"
#: Of the final rows: fields and order of the external format.
TRAINING = (
    f"messages {MESSAGES}, metadata struct<scene_name string, category string, objects array<string>, animations array<string>, difficulty string, source_repo string, source_path string, "
    "line_start int, line_end int, quality_score double, tags array<string>, complexity struct<line_count int, object_count int, animation_count int, call_count int, has_construct boolean>, "
    "validation struct<status string, warnings array<string>, errors array<string>>, content_hash string, "
    "extraction_diagnostics struct<included_dependency_symbols array<string>, missing_symbols array<string>, dependency_tree map<string, array<string>>>>"
)


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def read_files(spark: SparkSession, paths: Sequence[str | None]) -> DataFrame:
    """(part, file, block, at, value): the lines of all paths, each a file or a folder of part files, read at once; part is the path's place in the list.

    (part, file, block, at) is the order of the lines: files by name, blocks by their start. Spark deals files to tasks by size,
    so the numbers of rows alone would not say it. None and missing paths have no lines.
    """
    known = {k: _qualified(spark, p) for k, p in enumerate(paths) if p and _exists(spark, p)}
    for p in (p for k, p in enumerate(paths) if k not in known and p):
        LOG.warning("no such file: %s", p)
    if not known:
        return spark.createDataFrame([], "part int, file string, block long, at long, value string")
    lines = spark.read.text([re.sub(r"([\\{}\[\]*?])", r"\\\1", p) for p in dict.fromkeys(known.values())])  # names, not patterns
    name = F.regexp_replace(F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))), "^file:///", "file:/")
    lines = lines.select(name.alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"), "value")
    fits = [F.when((F.col("file") == p) | F.col("file").startswith(p + "/"), F.lit(k)) for k, p in known.items()]
    return lines.select(F.explode(F.array_compact(F.array(*fits))).alias("part"), "file", "block", "at", "value")


def _qualified(spark: SparkSession, path: str) -> str:
    """A path as file listings show it."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    own = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(p).toString()
    return own.replace("file:///", "file:/", 1)


def source_files(spark: SparkSession, folder: str, split: str) -> str | None:
    """Where a processed source holds a split: <folder>/<split>.jsonl, or the split folder that extract() writes."""
    for place in (f"{folder}/{split}.jsonl", f"{folder}/dataset/split={split}", f"{folder}/split={split}"):
        if _exists(spark, place):
            return place
    return None


def parse_lines(lines: DataFrame, schema: str = MODEL_READY) -> DataFrame:
    """lines with the fields of `value`; blank and malformed ones are left out."""
    row = F.from_json("value", f"{schema}, _bad string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})
    own = lines.filter(F.trim("value") != "").withColumn("row", row).filter("row is not null and row._bad is null")
    return own.select(*lines.columns, "row.*").drop("_bad")


def read_jsonl(spark: SparkSession, path: str, schema: str = MODEL_READY) -> DataFrame:
    """Rows of well-formed lines; blank and malformed ones are left out, a missing file is empty. Column `value` keeps the line."""
    return parse_lines(read_files(spark, [path]).select("value"), schema)


def read_lines(spark: SparkSession, path: str, max_rows: int | None = None) -> DataFrame:
    """(line_no, value): every line, blank ones too, numbered from 1 in the order of files by name and of lines in them; the first max_rows of them.

    A table of one row for each block of a file says how many lines come before it; a block's lines have successive numbers.
    """
    lines = read_files(spark, [path])
    sizes = lines.groupBy("file", "block").agg(F.count("*").alias("n"), F.min("at").alias("first"))
    before = sizes.select("file", "block", (F.sum("n").over(W.orderBy("file", "block")) - F.col("n") - F.col("first") + 1).alias("shift"))
    numbered = lines.join(before, ["file", "block"]).select((F.col("at") + F.col("shift")).alias("line_no"), "value")
    return numbered if max_rows is None else numbered.filter(F.col("line_no") <= max_rows)


def training_texts(spark: SparkSession, path: str, rows: int | None = None) -> DataFrame:
    """(line_no, text) of the first rows of a file of training rows: read, head, text, as a trainer takes them."""
    own = parse_lines(read_lines(spark, path), TRAINING)
    taken = own if rows is None else own.orderBy("line_no").limit(rows)
    return taken.select("line_no", training_text(first_of(F.col("messages"), "user"), first_of(F.col("messages"), "assistant")).alias("text"))


def read_training(spark: SparkSession, train: str, validation: str, schema: str = TRAINING) -> dict[str, DataFrame]:
    return {"train": spark.read.schema(schema).json(train), "validation": spark.read.schema(schema).json(validation)}


def write_splits(rows: DataFrame, path: str) -> None:
    """One folder for each split, of JSON lines; nulls are written out, other scripts stay as they are."""
    rows.write.mode("overwrite").option("ignoreNullFields", False).partitionBy("split").json(path)


def write_rows(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def json_default(value: Any) -> Any:
    """Dataclasses as objects, paths as text; anything else is an error."""
    if dataclasses.is_dataclass(value) and not isinstance(value, type):
        return dataclasses.asdict(value)
    if isinstance(value, Path):
        return str(value)
    raise TypeError(f"not JSON: {type(value).__name__}")


def write_json(spark: SparkSession, path: str, payload: Any) -> None:
    """A small object, pretty-printed, through Spark's file system: the path may be in any store."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    out = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(p, True)
    try:
        out.write(bytearray(json.dumps(payload, indent=2, ensure_ascii=False, default=json_default).encode()))
    finally:
        out.close()


def load_config(path: str, kind: type) -> Any:
    """A dataclass from a JSON object."""
    return kind(**json.loads(Path(path).read_text(encoding="utf-8")))
