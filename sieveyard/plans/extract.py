"""Repositories to chat rows: scan, parse, describe, check, prompt, dedup, split, report, write."""

from __future__ import annotations

import logging
import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.chat_rows import to_chat_examples
from ..operators.code_units import parse_files, scenes
from ..operators.curation import integrity_report, keep_first, split_by_hash, split_rows
from ..operators.metadata import usable, with_metadata, with_prompts, with_validation
from ..sources.code_files import read_code, walk
from ..sources.json_lines import write_json, write_splits
from ..sources.shared import written
from .config import ExtractConfig

LOG = logging.getLogger(__name__)


@dataclass
class Stages:
    """The plan's tables; parsed and valid are written, the others lazy."""

    parsed: DataFrame
    scenes: DataFrame
    valid: DataFrame
    examples: DataFrame
    kept: DataFrame
    split: DataFrame


def plan(files: DataFrame, config: ExtractConfig) -> Stages:
    """All stages over files (path, source). Order is by path component, line and prompt variant throughout.

    Parsed files and valid scenes are written to the shared folder: files are read and parsed once, whatever is asked of them.
    """
    parsed = written(parse_files(files, config.scene_base_names, config.include_module_dependencies), "parsed")
    found = scenes(parsed)
    described = with_validation(with_metadata(found, config.source_repo), config.strict_dependency_validation)
    valid = written(with_prompts(usable(described, config.min_quality_score), config.prompt_augmentation_count, config.seed), "valid")
    examples = to_chat_examples(valid).withColumns({
        "content_hash": F.col("metadata.content_hash"), "place": F.struct(F.split("metadata.source_path", "/").alias("path"), F.col("metadata.line_start").alias("line"), "variant"),
    })
    kept = keep_first(examples, ["content_hash", "prompt"], ["place"])
    named = kept.withColumn("seq", F.concat_ws("|", "metadata.source_path", F.col("metadata.line_start").cast("string"), F.col("variant").cast("string")))
    options = (config.validation_ratio, config.test_ratio, config.seed)
    split = split_by_hash(named, "content_hash", "seq", *options) if config.split_by_content_hash else split_rows(named, "seq", *options)
    return Stages(parsed, found, valid, examples, kept, split)


def statistics(spark: SparkSession, stages: Stages) -> DataFrame:
    """One row of counters and two histograms (of valid scenes, before dedup): one sum over each written stage."""
    error = F.col("error")
    out = stages.parsed.agg(
        F.count("*").alias("scanned_files"), F.count_if(error.isNull()).alias("parsed_files"), F.count_if(error.isNotNull()).alias("failed_files"),
        F.coalesce(F.sum(F.size("units")), F.lit(0)).cast("long").alias("discovered_scenes"),
    )
    kinds = stages.valid.groupBy("category", "difficulty").agg(F.count("*").alias("n"), F.sum(F.size("prompts")).alias("examples"))
    kinds = kinds.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("valid_scenes"), F.coalesce(F.sum("examples"), F.lit(0)).alias("__all"), F.collect_list(F.struct("category", "difficulty", "n")).alias("__kinds"))
    out = out.crossJoin(kinds).crossJoin(stages.kept.agg(F.count("*").alias("exported_examples"))).withColumn("duplicates_removed", F.col("__all") - F.col("exported_examples"))
    for name, plural in (("category", "categories"), ("difficulty", "difficulties")):
        names = F.array_sort(F.array_distinct(F.col(f"__kinds.{name}")))
        out = out.withColumn(plural, F.map_from_entries(F.transform(names, _sum_of(name))))
    return out.drop("__all", "__kinds")


def _sum_of(name: str):
    def entry(value: Column) -> Column:
        own = F.filter("__kinds", lambda k: k[name] == value)
        return F.struct(value.alias(name), F.aggregate(own, F.lit(0).cast("long"), lambda a, k: a + k["n"]).alias("n"))

    return entry


def extract(spark: SparkSession, config: ExtractConfig) -> dict[str, str]:
    """Run the plan and write split folders, statistics and the integrity report; leakage raises before anything is written."""
    config.validate()
    began = time.monotonic()
    scan = walk(config.normalized_input_paths(), config.ignore_dirs)
    stages = plan(read_code(spark, config.normalized_input_paths(), config.ignore_dirs, config.batch_size, config.max_workers), config)
    split = written(stages.split.select("messages", "metadata", "content_hash", "split"), "split")
    report = integrity_report(split, "content_hash", by_hash=config.split_by_content_hash).first().asDict(True)
    if config.enforce_split_integrity and report["leakage_count"]:
        raise ValueError(f"split leakage: {report['leakage_count']} hashes")
    stats = statistics(spark, stages).first().asDict(True) | {"skipped_directories": scan.skipped_directories, "scan_duration_seconds": scan.seconds}
    LOG.info("extracted %s scenes in %.1f s", stats["valid_scenes"], time.monotonic() - began)
    write_splits(split.select("messages", "metadata", "split"), f"{config.output_dir}/dataset")
    write_json(spark, f"{config.output_dir}/stats.json", stats)
    write_json(spark, f"{config.output_dir}/split_integrity_report.json", report)
    return {"dataset": f"{config.output_dir}/dataset", "stats": f"{config.output_dir}/stats.json", "report": f"{config.output_dir}/split_integrity_report.json"}


__all__ = ["Stages", "extract", "plan", "statistics"]
