"""Command line: python -m sieveyard extract | model-ready | profile."""

from __future__ import annotations

import argparse
import json
import logging

from pyspark.sql import SparkSession

from .plans.config import ExtractConfig
from .plans.extract import extract
from .plans.model_ready import build_model_ready
from .plans.profile import profile_file
from .sources.shared import ship_package


def arguments() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="sieveyard")
    top.add_argument("--verbose", action="store_true", help="the same as --log-level DEBUG")
    top.add_argument("--log-level", default="INFO", choices=("DEBUG", "INFO", "WARNING", "ERROR"))
    commands = top.add_subparsers(dest="command", required=True)
    e = commands.add_parser("extract", help="repositories to chat rows")
    e.add_argument("input_paths", nargs="+")
    e.add_argument("--output-dir", required=True)
    e.add_argument("--source-repo")
    for name, kind in (("max-workers", int), ("batch-size", int), ("validation-ratio", float), ("test-ratio", float), ("seed", int), ("min-quality-score", float), ("prompt-augmentation-count", int)):
        e.add_argument(f"--{name}", type=kind)
    e.add_argument("--row-wise-split", action="store_true", help="split rows, not contents")
    e.add_argument("--allow-leakage", action="store_true")
    e.add_argument("--no-module-dependencies", action="store_true")
    e.add_argument("--strict-dependency-validation", action="store_true")
    m = commands.add_parser("model-ready", help="several processed sources to one set")
    m.add_argument("processed_dir")
    m.add_argument("output_dir")
    m.add_argument("--sources", nargs="+", required=True)
    m.add_argument("--train-small-rows", type=int, default=512)
    p = commands.add_parser("profile", help="counts and lengths of a file of training rows")
    p.add_argument("path")
    p.add_argument("--max-rows", type=int)
    return top


def config(args: argparse.Namespace) -> ExtractConfig:
    names = ("source_repo", "max_workers", "batch_size", "validation_ratio", "test_ratio", "seed", "min_quality_score", "prompt_augmentation_count")
    given = {n: getattr(args, n) for n in names if getattr(args, n) is not None}
    return ExtractConfig(
        tuple(args.input_paths), args.output_dir, split_by_content_hash=not args.row_wise_split, enforce_split_integrity=not args.allow_leakage,
        include_module_dependencies=not args.no_module_dependencies, strict_dependency_validation=args.strict_dependency_validation, **given,
    )


def main(argv: list[str] | None = None) -> None:
    args = arguments().parse_args(argv)
    logging.basicConfig(level=logging.DEBUG if args.verbose else args.log_level, format="%(levelname)s %(name)s: %(message)s")
    spark = SparkSession.builder.appName("sieveyard").getOrCreate()
    ship_package(spark)
    if args.command == "extract":
        out = extract(spark, config(args))
    elif args.command == "model-ready":
        out = build_model_ready(spark, args.processed_dir, args.output_dir, args.sources, args.train_small_rows)
    else:
        out = profile_file(spark, args.path, args.max_rows)
    print(json.dumps(out, indent=2, ensure_ascii=False))


if __name__ == "__main__":
    main()
