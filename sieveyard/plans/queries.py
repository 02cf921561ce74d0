"""The engine's queries over the driver's tables, and over inline code, each with its SQL."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import rules as R
from ..functions.chat import pair, training_text
from ..functions.prompts import prompts
from ..functions.text import ordered_unique, readable_join, split_identifier, stable_hash
from ..operators import curation as C
from ..operators.chat_rows import check_rows, profile, to_chat_examples, to_instructions
from ..operators.code_units import imports, parse_files, reachable, scenes
from ..operators.maintenance import safety_reason
from ..operators.metadata import with_metadata, with_prompts, with_validation
from ..sources.code_files import read_code
from ..sources.json_lines import MESSAGES, read_files, read_jsonl, read_lines, write_rows
from ..sources.json_lines import training_texts as head_texts
from ..sources.shared import local_path, new_folder, written
from .config import ExtractConfig
from .extract import extract, plan, statistics
from .model_ready import build_model_ready

#: Two scenes in one file, and one that needs a helper, a constant and a base class of its module.
WAVES = '''from manim import *
import numpy as np


class SineWaveScene(Scene):
    def construct(self):
        axes = Axes(x_range=[-3, 3], y_range=[-1, 1])
        graph = axes.plot(lambda x: np.sin(x), color=BLUE)
        self.play(Create(axes), Create(graph))
        self.wait()


class RotatingSquareScene(Scene):
    def construct(self):
        square = Square()
        self.play(Rotate(square))
'''
HELPERS = '''import manim as m
SCALE = 2

def make_label(t):
    return m.Text(t).scale(SCALE)

class HelperScene(m.Scene):
    pass

class MainScene(HelperScene):
    def construct(self):
        self.add(make_label("x"), unknown_thing)
'''
BROKEN = "class Broken(Scene:\n    pass\n"

#: One module for each habit of sources that resolution and validation must take.
MODULES = {
    "alias.py": "import numpy as np\nfrom math import pi as p, tau\nclass Alias(Scene):\n    def construct(self):\n        self.add(np.array([p, tau]), pi)\n",
    "bom.py": "\ufeffx = 1\n",
    "branch.py": "import manim\nif True:\n    K = 1\n    class Hidden(Scene): pass\nclass Seen(Scene):\n    def construct(self):\n        self.add(K)\n",
    "decorated.py": "from manim import *\n@deco\nclass Deco(Scene):\n    def construct(self):\n        self.wait()\n",
    "empty.py": "",
    "error.py": "class Broken(Scene:\n    pass\n",
    "future.py": "from __future__ import annotations\nfrom manimlib import *\nclass Future(MyScene[int]):\n    def construct(self):\n        self.play(Create(undefined))\n",
    "late.py": "class Late(Scene):\n    async def construct(self):\n        pass\n",
    "mutual.py": (
        "import manim\nclass Outer(manim.Scene):\n    class Inner(Scene):\n        def construct(self): pass\n    def construct(self):\n        self.add(helper(1))\n"
        "def helper(n):\n    return other(n)\ndef other(n):\n    return helper(n - STEP)\nSTEP = 1\n"
    ),
    "unpack.py": "import manim\na, (b, c) = 1, (2, 3)\nb += 1\nclass Unpack(manim.ThreeDScene):\n    def construct(self):\n        self.add(a, b, c)\n",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def hashed(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", "lang", "source", stable_hash(F.col("text")).alias("content_hash"))


def hashed_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """hashed() written down: what reads it more than once does not hash the texts again."""
    return written(hashed(spark, sf_dir), "hashed")


def code(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([("lib/waves.py", WAVES), ("lib/helpers.py", HELPERS), ("lib/broken.py", BROKEN)], "path string, source string")


def long(c: Column, name: str) -> Column:
    return c.cast("long").alias(name)


def stable_hash_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hashed(spark, sf_dir).select("doc_id", "content_hash")


def dedup_keep_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.keep_first(hashed(spark, sf_dir), ["content_hash", "lang"], ["doc_id"]).select("doc_id", "lang", "content_hash")


def dedup_removed_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = hashed(spark, sf_dir).groupBy("content_hash", "lang").agg(F.count("*").alias("n"))
    return groups.agg(F.sum("n").alias("rows_in"), F.sum(F.col("n") - 1).alias("removed"))


def split_by_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.split_by_hash(hashed_once(spark, sf_dir), "content_hash", "doc_id").select("doc_id", "content_hash", "split")


def split_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_by_hash(spark, sf_dir).groupBy("split").agg(F.count("*").alias("rows"), F.countDistinct("content_hash").alias("groups"))


def legacy_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.split_rows(hashed(spark, sf_dir), "doc_id").select("doc_id", "split")


def legacy_split_leakage(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = C.split_rows(hashed_once(spark, sf_dir), "doc_id")
    return C.leaking_hashes(rows, "content_hash").select("content_hash", "n", F.array_join("places", ",").alias("places"))


def split_integrity(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = split_by_hash(spark, sf_dir)
    leaks = C.leaking_hashes(rows, "content_hash").agg(F.count("*").alias("leakage_count"))
    return C.split_statistics(rows, "content_hash").crossJoin(leaks)


def cross_source_leakage(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = C.leaking_hashes(hashed(spark, sf_dir), "content_hash", "source")
    return found.select("content_hash", F.col("n").alias("sources"), F.element_at("places", 1).alias("first_source"))


def curation_split_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = written(C.keep_first(hashed(spark, sf_dir), ["content_hash", "lang"], ["doc_id"]), "kept")
    rows = C.split_by_hash(kept, "content_hash", "doc_id")
    return C.split_statistics(rows, "content_hash")


def _reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with a reason: those without a label have no hash here, those of low quality miss symbols."""
    labels = table(spark, sf_dir, "labels")
    rows = hashed(spark, sf_dir).join(labels, "doc_id", "left")
    missing = F.when(F.col("quality") == 0, F.array(F.lit("quality"))).otherwise(F.array().cast("array<string>"))
    known = F.when(F.col("quality").isNotNull(), F.col("content_hash"))
    return rows.withColumn("reason", C.exclusion_reason(known, missing))


def model_ready_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _reasons(spark, sf_dir).groupBy("source", F.coalesce("reason", F.lit("kept")).alias("reason")).agg(F.count("*").alias("n"))


def model_ready_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All sources, three splits, in order; every row that stays tagged."""
    split = C.split_by_hash(written(_reasons(spark, sf_dir), "reasons"), "content_hash", "doc_id")
    return C.tag_parts(split).filter("reason is null").select("doc_id", "split", "model_ready_source", "part")


def train_small(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = C.split_by_hash(written(_reasons(spark, sf_dir), "reasons"), "content_hash", "doc_id").filter("reason is null")
    return C.head(rows.filter("split = 'train'"), 512, ["doc_id"]).select("doc_id", "content_hash")


def sample_heads(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = split_by_hash(spark, sf_dir)
    train = C.head(rows.filter("split = 'train'"), 128, ["doc_id"])
    return train.unionByName(C.head(rows.filter("split = 'validation'"), 32, ["doc_id"])).select("doc_id", "split")


def _first_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each conversation's first user and assistant text: min by turn, summed in part before the shuffle."""
    turns = table(spark, sf_dir, "conversations")
    first = lambda role: F.min_by(F.when(F.col("role") == role, F.col("text")), F.when(F.col("role") == role, F.col("turn")))
    return turns.groupBy("conv_id").agg(first("user").alias("user"), first("assistant").alias("assistant"), F.count("*").alias("turns"))


def chat_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _first_messages(spark, sf_dir).withColumn("messages", pair(F.col("user"), F.col("assistant")))
    return rows.select("conv_id", F.inline("messages"))


def instruction_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _first_messages(spark, sf_dir).withColumns({"messages": pair(F.col("user"), F.col("assistant")), "metadata": F.struct("conv_id")})
    return to_instructions(rows).select("metadata.conv_id", "instruction", "input", "output")


def training_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _first_messages(spark, sf_dir).select("conv_id", training_text(F.col("user"), F.col("assistant")).alias("text"))


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as JSON lines, with the first user and assistant message; a missing one is left out."""
    rows = _first_messages(spark, sf_dir)
    messages = F.filter(pair(F.col("user"), F.col("assistant")), lambda m: m["content"].isNotNull())
    meta = F.struct(F.when(F.col("turns") > 5, "long").alias("category"), F.when(F.col("conv_id") % 2 == 0, "even").otherwise("odd").alias("difficulty"))
    return rows.select("conv_id", F.to_json(F.struct(messages.alias("messages"), meta.alias("metadata"))).alias("value"))


def bad_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return check_rows(_lines(spark, sf_dir)).select("conv_id", "bad")


def training_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = profile(check_rows(_lines(spark, sf_dir)))
    return out.select(
        "rows_checked", "bad_rows", F.col("max_code_chars"), long(F.col("categories")["long"], "long_rows"), long(F.col("categories")["unknown"], "unknown_rows"),
        long(F.col("difficulties")["even"], "even_rows"), long(F.col("difficulties")["odd"], "odd_rows"),
        "avg_prompt_chars", "avg_code_chars",
    )


def identifiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = table(spark, sf_dir, "part").select("p_name").distinct().unionByName(table(spark, sf_dir, "customer").select(F.col("c_name").alias("p_name")))
    inline = spark.createDataFrame([(n,) for n in ("SineWaveScene", "HTTPServer", "my_scene2D", "already words", "A", "")], "p_name string")
    return names.unionByName(inline).select(F.col("p_name").alias("name"), split_identifier(F.col("p_name")).alias("words"))


def brand_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three largest sizes of each brand as a phrase."""
    sizes = table(spark, sf_dir, "part").select("p_brand", "p_size").distinct()
    listed = F.transform(F.slice(F.sort_array(F.collect_list("p_size"), False), 1, 3), lambda s: s.cast("string"))
    return sizes.groupBy("p_brand").agg(readable_join(listed).alias("label"))


#: The rules with words that the driver's texts have.
TEXT_RULES = R.RuleSet(
    tags=(R.TagRule("english", words=(" the ", " and ")), R.TagRule("german", words=(" der ", " und ")), R.TagRule("french", words=(" les ", " une ")), R.TagRule("licensed", words=("license",)), R.TagRule("marked", words=("%%%",))),
    categories=(("licensed", "legal"), ("marked", "junk"), ("german", "de"), ("french", "fr"), ("english", "en")),
)


def _tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    none = F.array().cast("array<string>")
    docs = table(spark, sf_dir, "documents")
    return docs.withColumn("tags", R.tags(none, none, none, F.col("text"), TEXT_RULES)).withColumn("category", R.category(F.col("tags"), TEXT_RULES))


def keyword_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tagged(spark, sf_dir).select("doc_id", F.array_join("tags", ",").alias("tags"))


def category_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tagged(spark, sf_dir).groupBy("category").agg(F.count("*").alias("n"))


def _measured(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    lines = F.size(F.split("text", "\n"))
    return docs.select("doc_id", "text", lines.alias("lines"), (F.col("n_chars") % 7).alias("objects"), (F.col("n_chars") % 5).alias("moves"), (F.col("n_chars") % 23).alias("calls"))


def difficulty_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = R.score(F.col("lines"), F.col("objects"), F.col("moves"), F.col("calls"))
    return _measured(spark, sf_dir).groupBy(R.difficulty(points).alias("difficulty")).agg(F.count("*").alias("n"))


def quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = R.RuleSet(import_marks=("license", "License"))
    value = R.quality(F.col("calls") > 3, F.col("objects"), F.col("moves"), F.col("lines"), F.col("text"), rules)
    return _measured(spark, sf_dir).select("doc_id", value.alias("quality_score"))


def ordered_unique_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    roles = F.transform(F.array_sort(F.collect_list(F.struct("turn", "role"))), lambda t: t["role"])
    return turns.groupBy("conv_id").agg(F.array_join(ordered_unique(roles), ",").alias("roles"))


EDGES = [("m", "a", "b"), ("m", "b", "c"), ("m", "c", "a"), ("m", "a", "d"), ("m", "d", "d"), ("m", "x", "y"), ("n", "a", "z")]


def dependency_closure(spark: SparkSession, sf_dir: str) -> DataFrame:
    edges = spark.createDataFrame(EDGES, "scope string, src string, dst string")
    return reachable(edges, spark.createDataFrame([("m", "a"), ("n", "a")], "scope string, name string"), 8).select("scope", "name", F.col("depth").cast("long").alias("depth"))


def missing_symbols(spark: SparkSession, sf_dir: str) -> DataFrame:
    used = spark.createDataFrame([("m", n) for n in ("a", "b", "print", "q", "_hidden")], "scope string, name string")
    known = spark.createDataFrame([("m", n) for n in ("a", "print")], "scope string, name string")
    return used.join(known, ["scope", "name"], "left_anti").filter(~F.col("name").startswith("_"))


def _scenes(spark: SparkSession) -> DataFrame:
    return with_prompts(with_validation(with_metadata(scenes(parse_files(code(spark))), "sample")))


def scene_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = scenes(parse_files(code(spark)))
    return rows.select("source_path", "scene_name", "line_start", "line_end", F.array_join("calls", ",").alias("calls"), F.array_join("dependency_names", ",").alias("needs"), F.array_join("missing_symbols", ",").alias("missing"), "content_hash")


def scene_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scenes(spark).select("scene_name", F.array_join("tags", ",").alias("tags"), "category", "difficulty", "quality_score", "validation.status")


def scene_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scenes(spark).select("scene_name", F.explode("prompts").alias("prompt"))


def parse_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_files(code(spark)).select("path", F.col("error").isNotNull().alias("failed"), long(F.size("units"), "units"), long(F.size("imports"), "imports"))


def extract_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = statistics(spark, plan(code(spark), ExtractConfig(("lib",), "out")))
    return out.select("scanned_files", "parsed_files", "failed_files", "discovered_scenes", "valid_scenes", "exported_examples", "duplicates_removed", long(F.col("categories")["graphs"], "graphs"))


def jsonl_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as chat rows, written as JSON lines to the shared folder and read again."""
    own = table(spark, sf_dir, "documents").select("doc_id", "lang", "text", stable_hash(F.col("text")).alias("content_hash"))
    rows = own.select(pair(F.col("lang"), F.col("text")).alias("messages"), F.struct("content_hash", "doc_id").alias("metadata"))
    path = new_folder(spark, "jsonl")
    write_rows(rows, path)
    back = read_jsonl(spark, path, f"messages {MESSAGES}, metadata struct<content_hash string, doc_id long>")
    text = F.element_at("messages", 2)["content"]
    return back.select("metadata.doc_id", text.alias("text"), (stable_hash(text) == F.col("metadata.content_hash")).alias("same"))


def jsonl_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as lines, written and read: without an assistant's text the line is blank, without a user's it is broken, and both are left out."""
    own = _lines(spark, sf_dir).join(_first_messages(spark, sf_dir).select("conv_id", "user", "assistant"), "conv_id")
    row = F.to_json(F.struct(pair(F.col("user"), F.col("assistant")).alias("messages"), F.struct(F.col("conv_id").cast("string").alias("content_hash")).alias("metadata")))
    path = new_folder(spark, "lines")
    own.select(F.when(F.col("assistant").isNull(), " ").when(F.col("user").isNull(), "{broken").otherwise(row).alias("value")).write.text(path)
    back = read_jsonl(spark, path)
    return back.select(F.col("metadata.content_hash").cast("long").alias("conv_id"), F.element_at("messages", 2)["content"].alias("text"), F.col("metadata.category").alias("category"))


def line_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as one line each, in order of their ids, over several files; numbered again from the files."""
    path = new_folder(spark, "numbered")
    table(spark, sf_dir, "documents").orderBy("doc_id").select(F.regexp_replace("text", r"[\r\n]+", " ").alias("value")).write.text(path)
    return read_lines(spark, path).select("line_no", long(F.length("value"), "chars"))


def prompt_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The primary prompt and two drawn templates for each part."""
    parts = table(spark, sf_dir, "part")
    kind = F.when(F.col("p_size") < 10, "graphs").when(F.col("p_size") < 20, "geometry").when(F.col("p_size") < 30, "text").otherwise("general")
    drawn = prompts(kind, F.col("p_name"), F.col("p_partkey").cast("string"), 2, 42)
    return parts.select("p_partkey", F.posexplode(drawn).alias("k", "prompt")).select("p_partkey", long(F.col("k"), "variant"), "prompt")


def _modules(spark: SparkSession) -> DataFrame:
    return parse_files(spark.createDataFrame(list(MODULES.items()), "path string, source string"))


def module_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = {"bases": "bases", "calls": "calls", "needs": "dependency_names", "missing": "missing_symbols"}
    return scenes(_modules(spark)).select("source_path", "scene_name", "has_construct", "line_start", "line_end", *[F.array_join(c, ",").alias(name) for name, c in listed.items()])


def module_imports(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imports(_modules(spark)).select("path", "module", F.array_join("names", ",").alias("names"), "alias")


def module_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Strict checks: status, errors and warnings."""
    rows = with_validation(with_metadata(scenes(_modules(spark))), strict=True)
    return rows.select("scene_name", "validation.status", F.array_join("validation.errors", " | ").alias("errors"), F.array_join("validation.warnings", " | ").alias("warnings"))


def scene_chat_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole chat rows: messages, and the nested metadata's parts."""
    m = "metadata"
    names = {"objects": f"{m}.objects", "animations": f"{m}.animations", "included": f"{m}.extraction_diagnostics.included_dependency_symbols", "missing": f"{m}.extraction_diagnostics.missing_symbols"}
    counts = [long(F.col(f"{m}.complexity.{k}"), k) for k in ("line_count", "object_count", "animation_count", "call_count")]
    tree = F.array_join(F.transform(F.map_entries(f"{m}.extraction_diagnostics.dependency_tree"), lambda e: F.concat(e["key"], F.lit(">"), F.array_join(e["value"], "+"))), ",")
    rows = to_chat_examples(_scenes(spark))
    return rows.select(
        f"{m}.scene_name", F.array_join(F.transform("messages", lambda x: x["role"]), ",").alias("roles"), F.element_at("messages", 1)["content"].alias("prompt"),
        (stable_hash(F.element_at("messages", 2)["content"]) == F.col(f"{m}.content_hash")).alias("hash_of_code"), f"{m}.source_repo", *counts, f"{m}.complexity.has_construct", f"{m}.validation.status",
        *[F.array_join(c, ",").alias(name) for name, c in names.items()], tree.alias("tree"),
    )


def model_ready_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two small repositories extracted, and what that wrote united to a model-ready set: its counters."""
    root = local_path(new_folder(spark, "chain"))
    for name, modules in (("one", {"waves.py": WAVES}), ("two", MODULES | {"helpers.py": HELPERS, "again.py": WAVES})):
        folder = Path(root) / "repos" / name
        folder.mkdir(parents=True)
        for file, text in modules.items():
            (folder / file).write_text(text, encoding="utf-8")
        extract(spark, ExtractConfig((str(folder),), f"{root}/processed/{name}", source_repo=name))
    stats = build_model_ready(spark, f"{root}/processed", f"{root}/set", ["one", "two", "absent"], 4)
    lines = read_files(spark, [f"{root}/set/{split}" for split in C.SPLITS])
    tags = lines.select(F.get_json_object("value", "$.metadata.model_ready_source").alias("source"))
    out = tags.groupBy("source").agg(F.count("*").alias("rows"))
    return out.withColumns({"total": F.lit(stats["totalRows"]).cast("long"), "missing_symbols": F.lit(stats["excluded"]["missing_symbols"]).cast("long"), "small": F.lit(stats["trainSmallRows"]).cast("long")})


def repo_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A small tree of files: which are read, by their place in it."""
    root = Path(local_path(new_folder(spark, "tree")))
    for name in ("a.py", "_2018/b.py", "sub/__init__.py", ".hid/c.py", ".x.py", "node_modules/d.py", "sub/build/e.py", "f.PY", "g.txt"):
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_text("x = 1\n")
    return read_code(spark, [str(root)]).select(F.substring("path", F.lit(len(str(root)) + 2), F.lit(1000)).alias("file"), long(F.length("source"), "chars"))


def source_decoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files in other encodings and with other line ends, as they are read."""
    root = Path(local_path(new_folder(spark, "encodings")))
    root.mkdir(parents=True)
    for name, data in (("latin.py", b"s = '\xe9'\r\n"), ("crlf.py", b"a\r\nb\rc\n"), ("bom.py", b"\xef\xbb\xbfx\n"), ("utf.py", "é漢\n".encode())):
        (root / name).write_bytes(data)
    return read_code(spark, [str(root)]).select(F.substring("path", F.lit(len(str(root)) + 2), F.lit(1000)).alias("file"), "source")


def training_head(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations written as training rows in order, and the text of the first 128, as a trainer takes them."""
    rows = _first_messages(spark, sf_dir).orderBy("conv_id")
    path = new_folder(spark, "training")
    write_rows(rows.select(pair(F.col("user"), F.col("assistant")).alias("messages"), F.struct(F.col("conv_id").cast("string").alias("content_hash")).alias("metadata")), path)
    return head_texts(spark, path, 128).select("line_no", "text")


def cleanup_safety(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = [("/w", "/w/src/core", True, "src/core"), ("/w", "/x/out", True, "../x/out"), ("/w", "/w/out", False, "out"), ("/w", "/w", True, ""), ("/w", "/w/out", True, "out"), ("/w", "/w/src/__pycache__", True, "src/__pycache__")]
    df = spark.createDataFrame(rows, "root string, path string, there boolean, relative string")
    return df.select("path", "there", safety_reason(F.col("root"), F.col("path"), F.col("there"), F.col("relative")).alias("reason"))


QUERIES = {
    f.__name__: f
    for f in (
        curation_split_report, stable_hash_docs, dedup_keep_first, dedup_removed_count, split_by_hash, split_sizes, legacy_split, legacy_split_leakage, split_integrity, cross_source_leakage,
        model_ready_reasons, model_ready_union, train_small, sample_heads, chat_examples, instruction_rows, training_texts, bad_rows, training_profile, identifiers, brand_labels, keyword_tags,
        category_counts, difficulty_histogram, quality_scores, ordered_unique_roles, dependency_closure, missing_symbols, scene_extract, scene_metadata, scene_prompts, parse_report,
        extract_statistics, jsonl_roundtrip, repo_scan, cleanup_safety, jsonl_lines, line_numbers, source_decoding, training_head, prompt_variants, module_units, module_imports, module_validation, scene_chat_rows, model_ready_chain,
    )
}
