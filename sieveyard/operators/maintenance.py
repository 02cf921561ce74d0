"""Which clean-up targets may be touched; nothing is deleted here."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Top folders that a clean-up leaves alone.
PROTECTED = ("src", "configs", "docs", "examples", "scripts", "tests")


def safety_reason(root: Column, path: Column, exists: Column, relative: Column) -> Column:
    """Why a target is skipped: outside the root, missing, empty, or protected; null if it may go."""
    parts = F.filter(F.split(relative, "/"), lambda p: (p != "") & (p != "."))
    inside = (path == root) | path.startswith(F.concat(F.rtrim(root, F.lit("/")), F.lit("/")))
    kept = F.get(parts, F.lit(0)).isin(*PROTECTED) & ~F.array_contains(parts, "__pycache__")
    return F.when(~inside, F.concat(F.lit("outside workspace: "), path)).when(~exists, "missing").when(F.size(parts) == 0, "empty target").when(kept, "protected source/configuration path")
