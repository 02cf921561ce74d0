"""Code files as a Spark source: Spark's own file sources skip names that begin with _ or . and so lose modules."""

from __future__ import annotations

import logging
import os
import time
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

LOG = logging.getLogger(__name__)

# Folders that no scan enters.
IGNORED = (
    ".git", ".hg", ".svn", ".mypy_cache", ".pytest_cache", ".ruff_cache", "__pycache__", ".venv", "venv", "env", ".env", "node_modules",
    "site-packages", "dist", "build", "vendor", "media", "partial_movie_files",
)


@dataclass
class Scan:
    """What a walk found: absolute paths, folders not entered, seconds."""

    files: list[str] = field(default_factory=list)
    skipped_directories: int = 0
    seconds: float = 0.0


def is_candidate(path: str, ignored: Sequence[str] = IGNORED) -> bool:
    """A .py file whose name has no leading dot and that lies in no ignored folder, however far up."""
    parts = path.split("/")
    return path.endswith(".py") and not parts[-1].startswith(".") and not set(parts) & set(ignored)


def walk(roots: Sequence[str], ignored: Sequence[str] = IGNORED) -> Scan:
    """All candidate files under the roots, sorted by path component, once each.

    Ignored folders are left out before they are entered, and unreadable ones count as skipped. A root
    may be a file; a missing one is warned about. Symbolic links to folders are followed once.
    """
    began, out, entered, found = time.monotonic(), Scan(), set(), set()
    for root in dict.fromkeys(os.path.realpath(os.path.expanduser(r)) for r in roots):
        if os.path.isfile(root):
            found |= {root} if is_candidate(root, ignored) else set()
            continue
        if not os.path.isdir(root):
            LOG.warning("input path does not exist: %s", root)
            continue

        def unreadable(_: OSError) -> None:
            out.skipped_directories += 1

        for folder, folders, files in os.walk(root, onerror=unreadable, followlinks=True):
            kept = [d for d in folders if d not in ignored and os.path.realpath(f"{folder}/{d}") not in entered]
            out.skipped_directories += sum(d in ignored for d in folders)
            entered |= {os.path.realpath(f"{folder}/{d}") for d in kept}
            folders[:] = kept
            found |= {p for p in (f"{folder}/{f}" for f in files) if is_candidate(p, ignored)}
    out.files = sorted(found, key=lambda p: p.split("/"))
    out.seconds = time.monotonic() - began
    return out


def batches(paths: Sequence[str], size: int = 256) -> Iterator[list[str]]:
    for at in range(0, len(paths), size):
        yield list(paths[at : at + size])


def decode(data: bytes) -> str:
    """UTF-8, else Latin-1, which reads anything; line ends become \\n. A byte-order mark stays a character."""
    try:
        text = data.decode("utf-8")
    except UnicodeDecodeError:
        text = data.decode("latin-1")
    return text.replace("\r\n", "\n").replace("\r", "\n")


@dataclass
class _Files(InputPartition):
    paths: list[str]


class _Reader(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.roots = [p for p in options.get("roots", options.get("path", "")).split("\n") if p]
        self.ignored = options["ignored"].split("\n") if "ignored" in options else IGNORED
        self.size, self.tasks = int(options.get("batchsize", 256)), int(options.get("tasks", 1))

    def partitions(self) -> Sequence[InputPartition]:
        files = walk(self.roots, self.ignored).files
        return [_Files(b) for b in batches(files, max(1, min(self.size, len(files) // self.tasks)))] or [_Files([])]

    def read(self, partition: _Files) -> Iterator[tuple[str, str]]:
        for path in partition.paths:
            with open(path, "rb") as f:
                yield path, decode(f.read())


class CodeFiles(DataSource):
    """format("pycode"): rows (path, source). Folders are walked once, on the driver; files are read by tasks of at most batchSize files, at least `tasks` of them if there are so many files."""

    @classmethod
    def name(cls) -> str:
        return "pycode"

    def schema(self) -> str:
        return "path string, source string"

    def reader(self, schema) -> DataSourceReader:
        return _Reader({k.lower(): v for k, v in self.options.items()})


def read_code(spark: SparkSession, roots: Sequence[str], ignored: Sequence[str] | None = None, batch_size: int = 256, tasks: int = 1) -> DataFrame:
    """(path, source) of every candidate file under roots that all nodes can read."""
    spark.dataSource.register(CodeFiles)
    reader = spark.read.format("pycode").option("roots", "\n".join(roots)).option("batchSize", str(batch_size)).option("tasks", str(tasks))
    return (reader.option("ignored", "\n".join(ignored)) if ignored is not None else reader).load()


def candidates(paths: DataFrame, path: str = "path", ignored: Sequence[str] = tuple(IGNORED)) -> DataFrame:
    """The candidate rows of a table of paths: the same rule as an expression."""
    parts = F.split(path, "/")
    return paths.filter(F.col(path).endswith(".py") & ~F.element_at(parts, -1).startswith(".") & ~F.arrays_overlap(parts, F.array(*map(F.lit, ignored))))
