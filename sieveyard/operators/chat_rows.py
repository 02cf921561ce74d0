"""Chat examples, instruction rows, and the profile of a training set."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.chat import filled, first_of, pair, training_text

ROW_SCHEMA = "messages array<struct<role string, content string>>, metadata string"


def to_chat_examples(scenes: DataFrame) -> DataFrame:
    """A row for each scene and prompt: messages and nested metadata.

    scenes: prompts, assistant_code, md (metadata struct), validation, content_hash, dependency_tree, missing_symbols.
    """
    meta = F.struct(
        "md.*",
        F.struct("validation.status", "validation.warnings", "validation.errors").alias("validation"),
        "content_hash",
        F.struct(F.col("dependency_names").alias("included_dependency_symbols"), "missing_symbols", "dependency_tree").alias("extraction_diagnostics"),
    )
    rows = scenes.select(F.posexplode("prompts").alias("variant", "prompt"), *scenes.columns)
    return rows.select(pair(F.col("prompt"), F.col("assistant_code")).alias("messages"), meta.alias("metadata"), "prompt", "variant")


def to_instructions(examples: DataFrame) -> DataFrame:
    """instruction, input (empty), output, beside messages and metadata."""
    return examples.select(first_of(F.col("messages"), "user").alias("instruction"), F.lit("").alias("input"), first_of(F.col("messages"), "assistant").alias("output"), "messages", "metadata")


def to_json_rows(examples: DataFrame) -> DataFrame:
    """One JSON text a row; nulls are written out."""
    return examples.select(F.to_json(F.struct("messages", "metadata"), {"ignoreNullFields": "false"}).alias("value"))


def to_training_text(examples: DataFrame) -> DataFrame:
    return examples.select(training_text(first_of(F.col("messages"), "user"), first_of(F.col("messages"), "assistant")).alias("text"))


def check_rows(lines: DataFrame, value: str = "value") -> DataFrame:
    """lines with user, assistant, category, difficulty and `bad`.

    A row is good if it is a JSON object with messages and metadata, and its first user and assistant
    messages are neither missing nor blank. Blank lines are bad rows.
    """
    row = F.from_json(F.col(value), ROW_SCHEMA, {"mode": "PERMISSIVE"})
    out = lines.withColumn("__row", row)
    out = out.withColumns({"user": first_of(F.col("__row.messages"), "user"), "assistant": first_of(F.col("__row.messages"), "assistant")})
    meta = F.from_json("__row.metadata", "map<string,string>")
    whole = F.coalesce(F.col("__row.metadata").rlike(r"^\s*\{"), F.lit(False))
    good = filled(F.col("user")) & filled(F.col("assistant")) & whole
    names = {k: F.when(F.map_contains_key(meta, k), F.coalesce(meta[k], F.lit("None"))).otherwise("unknown") for k in ("category", "difficulty")}
    return out.withColumns({"bad": ~F.coalesce(good, F.lit(False)), **names}).drop("__row")


def profile(checked: DataFrame) -> DataFrame:
    """One row: rows_checked, bad_rows, average lengths to two places, the longest code, and histograms as maps.

    A row whose metadata is no object is bad, yet its lengths count, as they do in the source format's checker.
    """
    has_text = filled(F.col("user")) & filled(F.col("assistant"))
    prompt, code = F.when(has_text, F.length("user")), F.when(has_text, F.length("assistant"))
    totals = checked.agg(
        F.count("*").alias("rows_checked"), F.count_if("bad").alias("bad_rows"),
        F.coalesce(F.bround(F.avg(prompt), 2), F.lit(0.0)).alias("avg_prompt_chars"), F.coalesce(F.bround(F.avg(code), 2), F.lit(0.0)).alias("avg_code_chars"),
        F.coalesce(F.max(code), F.lit(0)).cast("long").alias("max_code_chars"),
    )
    for name, plural in (("category", "categories"), ("difficulty", "difficulties")):
        counts = checked.filter("not bad").groupBy(name).agg(F.count("*").alias("n"))
        totals = totals.crossJoin(counts.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(name, "n")))).alias(plural)))
    return totals
