"""Code units: parse Python files, find scene classes, and resolve what they need from their module. Code is never run."""

from __future__ import annotations

import ast
import builtins
import warnings
from collections import deque
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.rules import ANIMATIONS
from ..functions.text import build_code, stable_hash

# Base classes of scenes (any name that ends in Scene counts, too), and the import that stands in for none.
SCENE_BASES = (
    "Scene", "ThreeDScene", "MovingCameraScene", "GraphScene", "LinearTransformationScene", "VectorScene", "ZoomedScene",
    "SpecialThreeDScene", "InteractiveScene", "TeacherStudentsScene", "PiCreatureScene",
)
STAND_IN_IMPORT, IMPORT_WORD = "from manim import *", "manim"

_IMPORT_T = pa.struct([("module", pa.string()), ("names", pa.list_(pa.string())), ("alias", pa.string())])
_STRINGS = pa.list_(pa.string())
_UNIT_T = pa.struct([
    ("scene_name", pa.string()), ("bases", _STRINGS), ("has_construct", pa.bool_()), ("line_start", pa.int32()), ("line_end", pa.int32()),
    ("class_code", pa.string()), ("construct_code", pa.string()), ("imports_code", pa.string()), ("dependency_code", pa.string()),
    ("calls", _STRINGS), ("dependency_names", _STRINGS), ("dependency_tree", pa.map_(pa.string(), _STRINGS)), ("missing_symbols", _STRINGS),
])
IMPORTS = "array<struct<module: string, names: array<string>, alias: string>>"
UNITS = ("array<struct<scene_name: string, bases: array<string>, has_construct: boolean, line_start: int, line_end: int, class_code: string, construct_code: string, "
         "imports_code: string, dependency_code: string, calls: array<string>, dependency_names: array<string>, dependency_tree: map<string, array<string>>, missing_symbols: array<string>>>")  # fmt: skip


def _unique(names: Iterable[str]) -> list[str]:
    return [n for n in dict.fromkeys(names) if n]


def base_name(node: ast.expr) -> str:
    """Dotted name of a base class; calls and subscripts count as what they are applied to, other forms as their dump."""
    suffix = ""
    while True:
        match node:
            case ast.Name(id=name):
                return name + suffix
            case ast.Attribute(value=inner, attr=attr):
                node, suffix = inner, f".{attr}{suffix}"
            case ast.Subscript(value=inner) | ast.Call(func=inner):
                node = inner
            case _:
                return ast.dump(node) + suffix


def called_name(node: ast.expr) -> str | None:
    """Last part of a call target's name, or None for what has none."""
    while isinstance(node, ast.Call | ast.Subscript):
        node = node.func if isinstance(node, ast.Call) else node.value
    return node.attr if isinstance(node, ast.Attribute) else node.id if isinstance(node, ast.Name) else None


def segment(source: str, node: ast.AST) -> str:
    """A node's text; decorators stand outside a definition's."""
    return ast.get_source_segment(source, node) or ast.unparse(node) or ""


def loaded(node: ast.AST) -> list[str]:
    """Names read below a node, breadth first, once each."""
    return _unique(n.id for n in ast.walk(node) if isinstance(n, ast.Name) and isinstance(n.ctx, ast.Load))


def bound(node: ast.AST) -> set[str]:
    """Names that a class binds anywhere below it. Positional-only and lambda parameters do not count."""
    names: set[str] = set()
    for n in ast.walk(node):
        match n:
            case ast.Name(id=name, ctx=ast.Store() | ast.Del()):
                names.add(name)
            case ast.FunctionDef(name=name, args=a) | ast.AsyncFunctionDef(name=name, args=a):
                names |= {name, *(x.arg for x in [*a.args, *a.kwonlyargs, a.vararg, a.kwarg] if x)}
            case ast.ClassDef(name=name) | ast.ExceptHandler(name=str(name)):
                names.add(name)
    return names


@dataclass
class Module:
    """What resolution needs of a parsed file, gathered once for all its classes."""

    source: str
    tree: ast.Module

    def __post_init__(self) -> None:
        self.imports: list[tuple[str | None, list[str], str | None]] = []
        for n in ast.walk(self.tree):
            if isinstance(n, ast.Import):
                self.imports += [(a.name, [a.name], a.asname) for a in n.names]
            elif isinstance(n, ast.ImportFrom):
                self.imports.append((n.module, [a.name for a in n.names], None))
        self.wildcard = any("*" in names for _, names, _ in self.imports)
        self.imported = {alias or name.partition(".")[0] for _, names, alias in self.imports for name in names if name != "*"}
        self.definitions: list[tuple[str, ast.stmt]] = []  # in source order: the last of a name wins
        for n in self.tree.body:
            match n:
                case ast.FunctionDef(name=name) | ast.AsyncFunctionDef(name=name) | ast.ClassDef(name=name):
                    self.definitions.append((name, n))
                case ast.Assign(targets=targets):
                    self._bind(targets, n)
                case ast.AnnAssign(target=target) | ast.AugAssign(target=target):
                    self._bind([target], n)

    def _bind(self, targets: list[ast.expr], statement: ast.stmt) -> None:
        self.definitions += [(n.id, statement) for t in targets for n in ast.walk(t) if isinstance(n, ast.Name)]

    def imports_code(self) -> str:
        own = [segment(self.source, n) for n in self.tree.body if isinstance(n, ast.Import | ast.ImportFrom)]
        return "\n".join(_unique(own if any(IMPORT_WORD in x for x in own) else [STAND_IN_IMPORT, *own]))

    def resolve(self, cls: ast.ClassDef) -> tuple[list[ast.stmt], dict[str, list[str]], list[str]]:
        """(statements needed, in source order; each needed name's own needs; names found nowhere).

        Breadth-first over the module's symbols. A name's needs are those not yet taken when its turn comes.
        """
        symbols = dict(d for d in self.definitions if d[0] != cls.name or not isinstance(d[1], ast.FunctionDef | ast.AsyncFunctionDef | ast.ClassDef))
        local, wanted = bound(cls), loaded(cls)
        queue, tree = deque(n for n in wanted if n in symbols and n not in local), {}
        while queue:
            name = queue.popleft()
            if name not in tree:
                tree[name] = []  # taken, so that it does not need itself
                tree[name] = [n for n in loaded(symbols[name]) if n in symbols and n not in tree]
                queue.extend(tree[name])
        taken = {id(symbols[n]) for n in tree}
        known = {*symbols, *self.imported, *local, *dir(builtins), cls.name, "self", "cls"}
        missing = [] if self.wildcard else sorted(n for n in wanted if n not in known and not n.startswith("_"))
        return [n for n in self.tree.body if id(n) in taken], tree, missing

    def units(self, scene_bases: Iterable[str], with_dependencies: bool) -> list[dict]:
        """One record for each top-level class with a scene base."""
        found, named = [], set(scene_bases)
        imports = self.imports_code()
        for cls in (n for n in self.tree.body if isinstance(n, ast.ClassDef)):
            bases = [base_name(b) for b in cls.bases]
            if not any(b in named or b.endswith("Scene") for b in bases):
                continue
            construct = next((n for n in cls.body if isinstance(n, ast.FunctionDef) and n.name == "construct"), None)
            statements, tree, missing = self.resolve(cls) if with_dependencies else ([], {}, [])
            found.append({
                "scene_name": cls.name, "bases": bases, "has_construct": construct is not None, "line_start": cls.lineno, "line_end": cls.end_lineno or cls.lineno,
                "class_code": segment(self.source, cls), "construct_code": construct and segment(self.source, construct), "imports_code": imports,
                "dependency_code": "\n\n".join(_unique(segment(self.source, n) for n in statements)),
                "calls": _unique(called_name(n.func) or "" for n in ast.walk(cls) if isinstance(n, ast.Call)),
                "dependency_names": list(tree), "dependency_tree": list(tree.items()), "missing_symbols": missing,
            })
        return found


def parse(source: str | None, scene_bases: Iterable[str] = SCENE_BASES, with_dependencies: bool = True) -> tuple[str | None, list[dict], list[dict]]:
    """(syntax error or None, imports, units) of a file's text."""
    try:
        with warnings.catch_warnings():
            warnings.simplefilter("ignore")
            module = Module(source or "", ast.parse(source or "", type_comments=True))
    except SyntaxError as e:
        return str(e), [], []
    return None, [{"module": m, "names": n, "alias": a} for m, n, a in module.imports], module.units(scene_bases, with_dependencies)


def parse_files(files: DataFrame, scene_bases: Iterable[str] = tuple(SCENE_BASES), with_dependencies: bool = True) -> DataFrame:
    """(path, error, imports, units) of files (path, source): one row a file, no shuffle. Syntax trees stay in the worker."""
    bases = tuple(scene_bases)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 64):
                batch = whole.slice(at, 64)
                errors, imports, units = zip(*[parse(s, bases, with_dependencies) for s in batch.column(1).to_pylist()], strict=True)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(errors, pa.string()), pa.array(imports, pa.list_(_IMPORT_T)), pa.array(units, pa.list_(_UNIT_T))], names=["path", "error", "imports", "units"]
                )

    return files.select("path", "source").mapInArrow(run, f"path string, error string, imports {IMPORTS}, units {UNITS}")


def scenes(parsed: DataFrame, animations: Iterable[str] = ANIMATIONS) -> DataFrame:
    """One row for each unit, with its assembled code, hash and animations."""
    rows = parsed.filter("error is null").select("path", F.posexplode("units").alias("unit_no", "u")).select(F.col("path").alias("source_path"), "unit_no", "u.*")
    rows = rows.withColumn("assistant_code", build_code(F.col("imports_code"), F.col("dependency_code"), F.col("class_code")))
    known = list(animations)
    return rows.withColumns({"content_hash": stable_hash(F.col("assistant_code")), "animations": F.filter("calls", lambda c: c.isin(*known))})


def imports(parsed: DataFrame) -> DataFrame:
    """One row for each import of each file."""
    return parsed.select("path", F.explode("imports").alias("i")).select("path", "i.*")


def syntax_error(code: Column) -> Column:
    """The message of a syntax error, or null; without type comments, as a plain parse has it."""

    @F.arrow_udf("string")
    def check(texts: pa.Array) -> pa.Array:
        return pa.array([_message(t.as_py()) for t in texts], pa.string())

    return check(code)


def _message(text: str | None) -> str | None:
    try:
        with warnings.catch_warnings():
            warnings.simplefilter("ignore")
            ast.parse(text or "")
    except SyntaxError as e:
        return f"Syntax error: {e}"
    return None


def register(spark: SparkSession) -> None:
    """Make extract_scenes(path, source) a table function for SQL: SELECT ... FROM files, LATERAL extract_scenes(path, source)."""

    class ExtractScenes:
        def eval(self, path: str, source: str):
            for u in parse(source)[2]:
                yield u["scene_name"], u["bases"], u["has_construct"], u["line_start"], u["line_end"], u["class_code"], u["dependency_names"], u["missing_symbols"]

    kinds = "scene_name string, bases array<string>, has_construct boolean, line_start int, line_end int, class_code string, dependency_names array<string>, missing_symbols array<string>"
    spark.udtf.register("extract_scenes", F.udtf(ExtractScenes, returnType=kinds))


def reachable(edges: DataFrame, seeds: DataFrame, max_depth: int = 50) -> DataFrame:
    """(scope, name, depth): what seeds (scope, name) reach over edges (scope, src, dst), by a recursive query.

    Cycles end at max_depth; a name has its least depth.
    """
    spark = edges.sparkSession
    edges.createOrReplaceTempView("__edges")
    seeds.createOrReplaceTempView("__seeds")
    return spark.sql(f"""
        WITH RECURSIVE reach(scope, name, depth) AS (
          SELECT scope, name, 0 FROM __seeds
          UNION ALL
          SELECT r.scope, e.dst, r.depth + 1 FROM reach r JOIN __edges e ON e.scope = r.scope AND e.src = r.name WHERE r.depth < {int(max_depth)}
        )
        SELECT scope, name, min(depth) AS depth FROM reach GROUP BY scope, name
    """)
