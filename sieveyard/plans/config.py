"""Settings of the extraction plan."""

from __future__ import annotations

import os
from dataclasses import dataclass

from ..operators.code_units import SCENE_BASES
from ..sources.code_files import IGNORED


@dataclass(frozen=True)
class ExtractConfig:
    input_paths: tuple[str, ...]
    output_dir: str
    source_repo: str | None = None
    max_workers: int = 4  # tasks that read and parse files, at least, if there are so many files
    batch_size: int = 256
    validation_ratio: float = 0.05
    test_ratio: float = 0.05
    seed: int = 42
    min_quality_score: float = 0.35
    prompt_augmentation_count: int = 0
    split_by_content_hash: bool = True
    enforce_split_integrity: bool = True
    include_module_dependencies: bool = True
    strict_dependency_validation: bool = False
    ignore_dirs: tuple[str, ...] = tuple(IGNORED)
    scene_base_names: tuple[str, ...] = tuple(SCENE_BASES)

    def normalized_input_paths(self) -> list[str]:
        return [os.path.realpath(os.path.expanduser(p)) for p in self.input_paths]

    def validate(self) -> None:
        """Raise ValueError with every reason why these settings can't run."""
        ratios = (("validation_ratio", self.validation_ratio), ("test_ratio", self.test_ratio))
        reasons = [f"{name} must be in [0, 1)" for name, x in ratios if not 0 <= x < 1]
        reasons += [f"{name} must be >= {least}" for name, x, least in (("max_workers", self.max_workers, 1), ("batch_size", self.batch_size, 1), ("prompt_augmentation_count", self.prompt_augmentation_count, 0)) if x < least]
        if not self.input_paths:
            reasons.append("at least one input path is required")
        if self.validation_ratio + self.test_ratio >= 1:
            reasons.append("validation_ratio + test_ratio must be < 1")
        if reasons:
            raise ValueError("; ".join(reasons))
