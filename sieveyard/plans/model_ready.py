"""Several processed sources to one model-ready set."""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.curation import SPLITS, exclusion_reason, head, integrity_report
from ..sources.json_lines import parse_lines, read_files, source_files, write_json
from ..sources.shared import written


def classify(rows: DataFrame) -> DataFrame:
    """rows (metadata struct) with content_hash and reason: null for those that stay."""
    own = rows.withColumn("content_hash", F.col("metadata.content_hash"))
    return own.withColumn("reason", exclusion_reason(F.col("content_hash"), F.col("metadata.extraction_diagnostics.missing_symbols")))


def with_tag(rows: DataFrame, key: str = "model_ready_source", tag: str = "model_ready_source") -> DataFrame:
    """rows whose `value`, a JSON object, has the column `tag` as `key` of its metadata: set anew or overwritten in place.

    The line is read and written as JSON, so names and values of any characters are safe, and other fields keep their order.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for line, name in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                row = json.loads(line)
                row["metadata"][key] = name
                out.append(json.dumps(row, ensure_ascii=False))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], names=["rest", "value"])

    others = [c for c in rows.columns if c != "value"]
    own = rows.select(F.struct(*[F.col(f"`{c}`") for c in others]).alias("rest"), "value", F.col(tag).alias("tag"))
    kind = own.select("rest", "value").schema
    return own.mapInArrow(run, kind).select("rest.*", "value")


def build_model_ready(spark: SparkSession, processed_dir: str, output_dir: str, sources: Sequence[str], train_small_rows: int = 512) -> dict:
    """Union all sources by split, leave out rows without hash or with missing symbols, and write splits, a head of train, statistics and report.

    A source is what extract() wrote (its folder of split folders) or a folder of train.jsonl, validation.jsonl and test.jsonl; a split that
    is not there is empty. All files are read at once. Everything is written first; leakage raises afterwards. Returns the statistics.
    """
    places = [(split, source) for split in SPLITS for source in sources]
    paths = [source_files(spark, f"{processed_dir}/{source}", split) for split, source in places]
    lines = read_files(spark, paths)  # part, file, block, at, value
    names = F.array(*[F.struct(F.lit(split).alias("split"), F.lit(source).alias("model_ready_source")) for split, source in places])
    rows = classify(parse_lines(lines)).withColumn("__p", names[F.col("part")]).select("value", "content_hash", "reason", "part", "file", "block", "at", "__p.*")
    rows = written(rows, "model-ready")
    order = ["part", "file", "block", "at"]
    counts = rows.groupBy("split", "reason").count().collect()  # a row for each split and reason
    kept = rows.filter("reason is null")
    tagged = with_tag(kept)
    for split in SPLITS:
        tagged.filter(F.col("split") == split).orderBy(*order).select("value").write.mode("overwrite").text(f"{output_dir}/{split}")
    small = with_tag(head(kept.filter("split = 'train'"), train_small_rows, order))
    small.orderBy(*order).select("value").write.mode("overwrite").text(f"{output_dir}/train_small")
    per_split = {s: sum(r["count"] for r in counts if r.split == s and r.reason is None) for s in SPLITS}
    stats = {
        "sources": list(sources), "splits": per_split, "totalRows": sum(r["count"] for r in counts), "exportedRows": sum(per_split.values()), "trainSmallRows": min(train_small_rows, per_split["train"]),
        "excluded": {k: sum(r["count"] for r in counts if r.reason == k) for k in ("missing_symbols", "missing_hash")},
    }
    report = integrity_report(kept, "content_hash").first().asDict(True)
    write_json(spark, f"{output_dir}/stats.json", stats)
    write_json(spark, f"{output_dir}/split_integrity_report.json", report)
    if report["leakage_count"]:
        raise ValueError(f"split leakage: {report['leakage_count']} hashes")
    return stats
