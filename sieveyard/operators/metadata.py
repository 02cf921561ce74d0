"""Metadata, validation and the quality filter of scenes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import rules as R
from ..functions.prompts import description, prompts
from ..functions.text import ordered_unique
from .code_units import syntax_error

#: Any of these in the code counts as an import of the library.
IMPORT_TOKENS = ("from manim import", "import manim", "manim_imports_ext")


def with_metadata(scenes: DataFrame, source_repo: str | None = None, rules: R.RuleSet = R.RuleSet(), objects: tuple[str, ...] = R.OBJECTS) -> DataFrame:
    """scenes with `md`, the metadata struct in its output order."""
    own = scenes.withColumns({"objects": R.of_vocabulary(F.col("calls"), objects), "animations": ordered_unique(F.col("animations"))})
    own = own.withColumns({
        "tags": R.tags(F.col("objects"), F.col("animations"), F.col("bases"), F.col("assistant_code"), rules),
        "complexity": R.complexity(F.col("line_start"), F.col("line_end"), F.col("objects"), F.col("animations"), F.col("calls"), F.col("has_construct")),
    })
    c = "complexity"
    points = R.score(*[F.col(f"{c}.{k}") for k in ("line_count", "object_count", "animation_count", "call_count")], rules)
    own = own.withColumns({
        "category": R.category(F.col("tags"), rules), "difficulty": R.difficulty(points, rules), "source_repo": F.lit(source_repo).cast("string"),
        "quality_score": R.quality(F.col("has_construct"), F.size("objects"), F.size("animations"), F.col(f"{c}.line_count"), F.col("assistant_code"), rules),
    })
    fields = ("scene_name", "category", "objects", "animations", "difficulty", "source_repo", "source_path", "line_start", "line_end", "quality_score", "tags", "complexity")
    return own.withColumn("md", F.struct(*fields))


def with_validation(scenes: DataFrame, strict: bool = False) -> DataFrame:
    """scenes with `validation`: valid, status (valid or failed), errors, warnings. Static checks alone; extracted code is never run.

    Checks that would run or render the code have no place here: their status `incompatible` is never given.
    """
    missing = F.when(F.size("missing_symbols") > 0, F.concat(F.lit("Unresolved dependency symbols: "), F.array_join("missing_symbols", ", "))) if strict else F.lit(None).cast("string")
    errors = F.array_compact(F.array(
        syntax_error(F.col("assistant_code")),
        F.when(~F.col("has_construct"), "Scene class has no construct() method."),
        F.when(F.coalesce(F.col("scene_name"), F.lit("")) == "", "Scene name is empty."),
        missing,
    ))
    imported = F.lit(False)
    for token in IMPORT_TOKENS:
        imported |= F.col("assistant_code").contains(token)
    warnings = F.array_compact(F.array(F.when(~imported, "No explicit Manim import found.")))
    own = scenes.withColumns({"__errors": errors, "__warnings": warnings})
    valid = F.size("__errors") == 0
    return own.withColumn("validation", F.struct(valid.alias("valid"), F.when(valid, "valid").otherwise("failed").alias("status"), F.col("__errors").alias("errors"), F.col("__warnings").alias("warnings"))).drop("__errors", "__warnings")


def usable(scenes: DataFrame, min_quality: float = 0.35) -> DataFrame:
    return scenes.filter(F.col("validation.valid") & (F.col("quality_score") >= F.lit(float(min_quality))))


def with_prompts(scenes: DataFrame, count: int = 0, seed: int = 42) -> DataFrame:
    """scenes with `description` and `prompts`; a scene draws its templates by path, line and seed."""
    text = description(F.col("category"), F.col("objects"), F.col("animations"), F.col("scene_name"))
    key = F.concat_ws("|", "source_path", F.col("line_start").cast("string"))
    return scenes.withColumn("description", text).withColumn("prompts", prompts(F.col("category"), F.col("description"), key, count, seed))
